"""Line deduplication by a deletion-neighbourhood join.

A line is dropped where an earlier line of the corpus is equal, or within one
edit (a character inserted, removed or replaced) for lines of at least
``MIN_FUZZY`` characters.  Earlier means a smaller id, then a smaller line number.

The variants of a line are the line itself and the line without one character.
Two lines within one edit have a variant in common: the shorter line is a
variant of the longer, or both lose a character at the same place.  Variants are
joined as 64-bit hashes; each shared variant hands its earliest line on to the
others, so a variant shared by many lines costs no pairs.  What is handed on is
then verified by edit distance on the lines themselves.

Variants are emitted only where they can meet: with one edit, all but one of
four parts of a line stay equal, so each line first emits hashes of itself
without one part (aligned at both ends), and only parts that some other line
leaves open too are varied.

Defined results: a null text has no lines and stays null; lines without a word
are never dropped; a text whose lines are all dropped becomes empty.  Rows that
repeat id and text are one document and get the same result; rows with equal
ids and different texts are ordered by a hash of the text; null ids come last.
Extra columns stay as they are.  Lines of any length are handled whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kintsugi.llm.common import GROUP, bit_table, code_points, in_table, mixed, parts_of, slices, stored, text_groups

#: Lines shorter than this are only compared for equality.
MIN_FUZZY = 20
PARTS = 4
#: Bits of the tables that tell tasks which keys and lines matter.
FILTER_BITS = 24

_B = 0x9E3779B97F4A7C15
_INVERSE = pow(_B, -1, 1 << 64)
_K = [np.uint64(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


@lru_cache(maxsize=2)
def _first_powers(base: int) -> np.ndarray:
    out = np.full(2 * GROUP, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _powers(base: int, n: int) -> np.ndarray:
    """The powers of ``base`` up to the n-th; those that an ordinary group of texts needs are kept."""
    known = _first_powers(base)
    if n < len(known):
        return known[:n + 1]
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Lines:
    """The lines of several texts with O(1) hashes of any stretch of them, which are made when first asked for."""

    def __init__(self, texts: list[str]):
        codes, offsets = code_points(texts)
        self.codes = codes
        breaks = np.flatnonzero(codes == 10)
        of_break = np.searchsorted(offsets, breaks, side="right") - 1
        begin = np.concatenate((offsets[:-1], breaks + 1))
        doc = np.concatenate((np.arange(len(texts)), of_break))
        order = np.lexsort((begin, doc))
        self.begin, self.doc = begin[order], doc[order]
        first = np.searchsorted(self.doc, np.arange(len(texts) + 1))
        self.number = np.arange(len(self.doc)) - first[self.doc]
        self.end = np.append(self.begin[1:] - 1, 0)
        self.end[first[1:] - 1] = offsets[1:]
        self.size = self.end - self.begin
        letters = np.concatenate(([0], np.cumsum(~((codes == 32) | ((codes >= 9) & (codes <= 13))))))
        self.blank = letters[self.end] == letters[self.begin]
        # what tells lines apart; the polynomials above only find lines that may be near each other
        self.hash = np.array([xxhash.xxh3_64_intdigest(line) for t in texts for line in t.encode("utf-8", "surrogatepass").split(b"\n")],
                             np.uint64).astype(np.int64)

    @cached_property
    def power(self) -> np.ndarray:
        return _powers(_B, len(self.codes))

    @cached_property
    def inverse(self) -> np.ndarray:
        return _powers(_INVERSE, len(self.codes))

    @cached_property
    def upto(self) -> np.ndarray:
        value = mixed(self.codes.astype(np.uint64) + np.uint64(1)) * self.power[:-1]
        return np.concatenate((np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)))

    @cached_property
    def raw(self) -> np.ndarray:
        return self.stretch(self.begin, self.end)

    def stretch(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.upto[b] - self.upto[a]) * self.inverse[a]

    @staticmethod
    def named(raw: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Signed 64-bit name of a string from its polynomial and length."""
        return mixed(raw * _K[0] + size.astype(np.uint64)).astype(np.int64)

    def open_parts(self, which: np.ndarray):
        """(line, shorter length, part, key) for each way to leave out a part of the given lines."""
        for drop in (0, 1):  # the line as the shorter or equal one, as the longer one
            length = self.size[which] - drop
            fit = which[length >= MIN_FUZZY]
            length = self.size[fit] - drop
            for part in range(PARTS):
                head, tail = length * part // PARTS, length - length * (part + 1) // PARTS
                a, b = self.begin[fit], self.end[fit]
                key = mixed(self.stretch(a, a + head) * _K[1] + mixed(self.stretch(b - tail, b)) * _K[2]
                            + (length * PARTS + part).astype(np.uint64) * _K[3]).astype(np.int64)
                yield fit, length, part, drop, key

    def variants(self, table: np.ndarray, which: np.ndarray):
        """(key, role, line): role 0 for a character replaced at a place, 1 for the line itself, 2 for the line without a character."""
        for fit, length, part, drop, key in self.open_parts(which):
            hit = in_table(table, key)
            fit, length = fit[hit], length[hit]
            if not len(fit):
                continue
            head = length * part // PARTS
            count = length * (part + 1) // PARTS - head + drop
            line = np.repeat(fit, count)
            place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(head, count)
            a, b = self.begin[line], self.end[line]
            rest = self.stretch(a, a + place) + self.stretch(a + place + 1, b) * self.power[place]
            name = self.named(rest, self.size[line] - 1)
            if drop:
                yield name, 2, line
            else:
                yield mixed(name.astype(np.uint64) * _K[1] + place.astype(np.uint64)).astype(np.int64), 0, line
                yield self.named(self.raw[fit], self.size[fit]), 1, fit

    def text(self, line: int) -> str:
        return self.codes[self.begin[line]:self.end[line]].tobytes().decode("utf-32-le", "surrogatepass")


def _batch(columns: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def _each(batches: Iterator[pa.RecordBatch], text: int = 0) -> Iterator[tuple[int, pa.RecordBatch, Lines]]:
    for batch in parts_of(batches, text):
        for first, group in text_groups(batch.column(text).to_pylist()):
            yield first, batch, Lines(group)


def _fresh(lines: Lines, seen: set[int]) -> np.ndarray:
    """Lines with a word that this task has not met yet."""
    wanted = np.flatnonzero(~lines.blank & (lines.size >= MIN_FUZZY))
    names = lines.hash[wanted].tolist()
    return wanted[np.fromiter((h not in seen and not seen.add(h) for h in names), bool, len(names))]


def _keys(texts: DataFrame) -> DataFrame:
    def run(batches):
        seen: set[int] = set()
        for _, _, lines in _each(batches):
            for fit, _, _, _, key in lines.open_parts(_fresh(lines, seen)):
                yield _batch([key, lines.hash[fit]], ["k", "h"])

    return texts.mapInArrow(run, "k long, h long")


def _variants(texts: DataFrame, table) -> DataFrame:
    def run(batches):
        seen: set[int] = set()
        for _, _, lines in _each(batches):
            for key, role, line in lines.variants(table.value, _fresh(lines, seen)):
                yield _batch([key, np.full(len(key), role, np.int32), lines.hash[line]], ["v", "role", "h"])

    return texts.mapInArrow(run, "v long, role int, h long")


def _texts(texts: DataFrame, table) -> DataFrame:
    def run(batches):
        seen: set[int] = set()
        for _, _, lines in _each(batches):
            which = _fresh(lines, seen)
            which = which[in_table(table.value, lines.hash[which])]
            yield pa.RecordBatch.from_arrays([pa.array(lines.hash[which]), pa.array([lines.text(i) for i in which.tolist()], pa.string())],
                                             names=["h", "line"])

    return texts.mapInArrow(run, "h long, line string").groupBy("h").agg(F.first("line").alias("line"))


def _places(docs: DataFrame) -> DataFrame:
    """(id, r, no, h) of every line with a word."""
    id_type = dict(docs.dtypes)["id"]

    def run(batches):
        for first, batch, lines in _each(batches, 2):
            which = ~lines.blank
            row = pa.array(first + lines.doc[which])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), batch.column(1).take(row), pa.array(lines.number[which]), pa.array(lines.hash[which])],
                names=["id", "r", "no", "h"])

    return docs.mapInArrow(run, f"id {id_type}, r long, no long, h long")


def _place() -> F.Column:
    return F.struct(F.col("id").isNull().alias("late"), "id", "r", "no")


def _near(texts: DataFrame, firsts: DataFrame) -> DataFrame:
    """(h): lines for which an earlier line is one edit away."""
    spark = texts.sparkSession
    share = lambda df: spark.sparkContext.broadcast(bit_table(df, FILTER_BITS))
    keys = _keys(texts).groupBy("k").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi")
    same = Window.partitionBy("v")
    shared = _variants(texts, share(keys)).withColumns({"lo": F.min("h").over(same), "hi": F.max("h").over(same)}).where("lo <> hi")
    members = stored(shared.select("v", "role", "h").distinct().join(firsts.select("h", "first"), "h"))
    earliest = members.groupBy("v").agg(*[F.min(F.when(F.col("role") == k, F.struct("first", "h"))).alias(f"e{k}")
                                          for k in range(3)])
    met = members.join(earliest, "v").withColumn(
        "e", F.when(F.col("role") == 0, F.col("e0")).when(F.col("role") == 1, F.col("e2")).otherwise(F.col("e1")))
    handed = stored(met.where("e.first < first").groupBy("h").agg(F.min("e").alias("e")).select("h", F.col("e.h").alias("g")))
    lines = _texts(texts, share(handed.select(F.explode(F.array("h", "g")).alias("k"))))
    both = handed.join(lines, "h").join(lines.select(F.col("h").alias("g"), F.col("line").alias("other")), "g")
    return both.where(F.levenshtein("line", "other", 1) >= 0).select("h")


def dropped_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, r, numbers): for each document (id and hash ``r`` of id and text) the numbers of its dropped lines."""
    docs = df.select(F.col(id_col).alias("id"), _row_hash(id_col, text_col).alias("r"),
                     F.col(text_col).cast("string").alias("text")).where("text is not null")
    places = stored(_places(docs))
    firsts = stored(places.groupBy("h").agg(F.min(_place()).alias("first"), F.count(F.lit(1)).alias("n")))
    near = _near(docs.select("text"), firsts).withColumn("near", F.lit(True))
    acts = stored(firsts.join(near, "h", "left").where("n > 1 or near"))
    hit = places.join(acts, "h").where(F.col("near") | (F.col("first") < _place()))
    return hit.groupBy("id", "r").agg(F.array_sort(F.collect_set("no")).alias("numbers"))


def _row_hash(id_col: str, text_col: str) -> F.Column:
    return F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string"))


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with dropped lines taken out of the text, and ``n_lines``, ``n_dropped``."""
    drops = dropped_lines(df, id_col, text_col)

    @F.arrow_udf("struct<text:string,n:long>")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, numbers in batches:
            done, first = [], 0
            for part in slices(texts):
                gone = numbers.slice(first, len(part))
                first += len(part)
                changed = pc.fill_null(pc.greater(pc.list_value_length(gone), 0), False)
                kept = []
                for t, out in zip(part.filter(changed).to_pylist(), gone.filter(changed).to_pylist(), strict=True):
                    out = set(out)
                    kept.append("\n".join(x for i, x in enumerate(t.split("\n")) if i not in out))
                count = pc.fill_null(pc.add(pc.count_substring(part, "\n").cast(pa.int64()), 1), 0)
                text = pc.replace_with_mask(part, changed, pa.array(kept, part.type)) if kept else part
                done.append(pa.StructArray.from_arrays([text, count], names=["text", "n"]))
            yield pa.concat_arrays(done) if done else pa.array([], pa.struct([("text", texts.type), ("n", pa.int64())]))

    keyed = df.withColumns({"__id": F.col(id_col), "__r": _row_hash(id_col, text_col)})
    drops = drops.select(F.col("id").alias("__drop_id"), F.col("r").alias("__r"), F.col("numbers").alias("__gone"))
    met = keyed.join(drops, (keyed["__r"] == drops["__r"]) & keyed["__id"].eqNullSafe(drops["__drop_id"]), "left") \
        .drop(drops["__r"])
    # non-deterministic to Spark: else a filter on its result runs it a second time, in one more worker for each task
    done = met.withColumn("__cut", cut.asNondeterministic()(F.col(text_col).cast("string"), F.col("__gone")))
    return done.withColumns({text_col: F.col("__cut.text"), "n_lines": F.col("__cut.n"),
                             "n_dropped": F.coalesce(F.size("__gone").cast("long"), F.lit(0))}) \
        .withColumn("n_dropped", F.greatest("n_dropped", F.lit(0).cast("long"))) \
        .drop("__id", "__r", "__drop_id", "__gone", "__cut")


def dedup_sql(table: str = "documents") -> str:
    """The query's result as DuckDB SQL: near pairs share all but one half of the shorter line."""
    half = "CAST(floor(m / 2) AS BIGINT)"
    return rf"""
    WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                      unnest(range(len(string_split(text, chr(10))))) AS no FROM {table} WHERE text IS NOT NULL),
    w AS (SELECT * FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
    f AS (SELECT line, length(line) AS n, min((doc_id, no)) AS first FROM w GROUP BY line),
    k AS (SELECT *, unnest([n, n - 1]) AS m FROM f WHERE n >= {MIN_FUZZY}),
    h AS (SELECT line, n, m, first, 'a' || left(line, {half}) AS part FROM k WHERE m >= {MIN_FUZZY}
          UNION ALL SELECT line, n, m, first, 'z' || right(line, {half}) FROM k WHERE m >= {MIN_FUZZY}),
    p AS (SELECT DISTINCT a.line, a.n, b.line AS other, b.n AS o FROM h a JOIN h b USING (m, part)
          WHERE a.first > b.first AND a.line <> b.line AND abs(a.n - b.n) <= 1 AND least(a.n, b.n) = m),
    near AS (SELECT DISTINCT line FROM p WHERE len(list_filter(range(greatest(n, o)), lambda i:
             CASE WHEN n = o THEN left(line, i) = left(other, i) AND right(line, n - 1 - i) = right(other, n - 1 - i)
                  WHEN n < o THEN left(other, i) || right(other, o - 1 - i) = line
                  ELSE left(line, i) || right(line, n - 1 - i) = other END)) > 0),
    gone AS (SELECT w.doc_id, w.no FROM w JOIN f USING (line) LEFT JOIN near USING (line)
             WHERE near.line IS NOT NULL OR (w.doc_id, w.no) > f.first)
    SELECT l.doc_id, count(*) AS n_lines, count(gone.no) AS n_dropped,
           sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.no) FILTER (gone.no IS NULL), '')) AS kept_sha256
    FROM l LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.no = l.no GROUP BY l.doc_id"""
