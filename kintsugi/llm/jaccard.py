"""Jaccard join on word shingles by vertical partitioning of the global order.

Every text becomes the set of its distinct 5-word shingles (64-bit hashes).
Texts with equal sets form one class; only classes are compared.  The global
order puts rare shingles first: a fixed-size table of counts over the whole
corpus marks slots that hold frequent shingles, and shingles are ordered by
(frequent, hash).  Two sets with an overlap of c share SHARED shingles among the
first ``n - c + SHARED`` of each, so classes meet in the buckets of those.

Each class is first compared with one hub only, which joins dense groups with as
many comparisons as members.  Then all pairs that share enough of their first
shingles and are still in different components are compared, so no link between
different texts that could join two components is missed.

A comparison cuts the global order into fragments: each pair's overlap is
counted fragment by fragment, as separate rows, and summed per pair.

Defined results: a null text, an empty text and a text of blanks have the empty
set, which links with nothing.  Rows that share an id, and repeated rows, are
linked like any others; a null id never becomes a component's id unless all
are null.  Extra columns do not matter: results carry id, size and component.
Hashes have 64 bits; distinct shingles of a corpus of m are confused with a
chance below m^2 / 2^64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kintsugi.llm.common import bit_table, code_points, connected, in_table, mixed, parts_of, slices, stored_bare, text_groups, text_of, word_hashes

WIDTH = 5
#: Similarity, in percent of the union.
PERCENT = 75
#: Slots (2^bits) of the table of counts and of the filter for classes.
SLOT_BITS = 18
FILTER_BITS = 24
#: Fragments of the order: 2^bits for rare and as many for frequent shingles.
FRAGMENT_BITS = 2
#: First shingles that a pair must have in common to be compared.
SHARED = 3

_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_LOWER = np.arange(128, dtype=np.uint32)
_LOWER[65:91] += 32


def shingle_sets(texts: list[str], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text as 63-bit numbers, sorted, and the offsets per text."""
    codes, offsets = code_points(texts)
    low = codes.copy()
    plain = codes < 128
    low[plain] = _LOWER[codes[plain]]
    words, _, first = word_hashes(low, offsets)
    count = np.diff(first)
    doc = np.repeat(np.arange(len(texts)), count)
    m = max(0, len(words) - width + 1)
    h = np.zeros(m, np.uint64)
    for k in range(width):
        h = h * _STEP + words[k:k + m]
    whole = doc[:m] == doc[width - 1:width - 1 + m]
    h, doc = mixed(h[whole]), doc[:m][whole]
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):  # the whole sequence is the only shingle
        extra = []
        for d in short:
            x = np.array([count[d]], np.uint64)
            for w in words[first[d]:first[d + 1]]:
                x = x * _STEP + w
            extra.append(mixed(x)[0])
        at = np.searchsorted(doc, short)
        h, doc = np.insert(h, at, np.array(extra, np.uint64)), np.insert(doc, at, short)
    token = (h >> np.uint64(1)).astype(np.int64)
    ends = np.searchsorted(doc, np.arange(len(texts) + 1)).tolist()
    for a, b in zip(ends, ends[1:]):  # a sort for each text: short ones are sorted much faster than all together
        token[a:b].sort()
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (doc[1:] != doc[:-1])
    token, doc = token[new], doc[new]
    return token, np.searchsorted(doc, np.arange(len(texts) + 1))


def set_keys(token: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit key of each set; 0 for the empty set."""
    size = np.diff(offsets)
    upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(token.astype(np.uint64)), dtype=np.uint64)))
    key = mixed(upto[offsets[1:]] - upto[offsets[:-1]] + size.astype(np.uint64) * _STEP) | np.uint64(1)
    return np.where(size > 0, key, np.uint64(0)).astype(np.int64)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sets and keys of the texts of a task, in bounded groups, each set once."""
    seen: set[int] = set()
    for batch in parts_of(batches):
        for _, group in text_groups(batch.column(0).to_pylist()):
            token, offsets = shingle_sets(group)
            keys = set_keys(token, offsets)
            fresh = [k != 0 and k not in seen and not seen.add(k) for k in keys.tolist()]
            keep = np.repeat(fresh, np.diff(offsets))
            size = np.diff(offsets)[fresh]
            yield token[keep], np.concatenate(([0], np.cumsum(size))), keys[fresh]


def keyed(df: DataFrame, text_col: str = "text", table=None) -> DataFrame:
    """``df`` with ``n_shingles`` and ``set_key`` (null for the empty set), and with a broadcast
    :func:`bit_table` also ``in_table``, whether the key is in it (never for the empty set)."""

    @F.arrow_udf("struct<n:long,k:long,hit:boolean>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [(np.diff(o), set_keys(t, o)) for t, o in
                     (shingle_sets(g) for part in slices(batch) for _, g in text_groups(part.to_pylist()))]
            n = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
            k = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
            hit = in_table(table.value, k) & (n > 0) if table is not None else np.zeros(len(k), bool)
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(k, pa.int64(), mask=n == 0), pa.array(hit)],
                                             names=["n", "k", "hit"])

    # non-deterministic to Spark: else a filter on its result runs it a second time, in one more worker for each task
    got = df.withColumn("__set", run.asNondeterministic()(text_of(text_col)))
    found = {"n_shingles": F.col("__set.n"), "set_key": F.col("__set.k")} | ({"in_table": F.col("__set.hit")} if table is not None else {})
    return got.withColumns(found).drop("__set")


def _frequent_slots(texts: DataFrame, bits: int) -> np.ndarray:
    """Slots of the shingle hash that hold more than chance would put there."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.int64)
        for token, _, _ in _batches(batches):
            total += np.bincount(token >> (63 - bits), minlength=1 << bits)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["slot", "n"])

    got = texts.mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(1 << bits)
    total[got["slot"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    mean = np.median(total)
    return total > mean + 6 * np.sqrt(mean) + 8


def _ranked(token: np.ndarray, offsets: np.ndarray, frequent: np.ndarray, bits: int):
    """Tokens of each set in the global order, whether each is frequent, and its place in its set."""
    late = frequent[token >> (63 - bits)]
    size = np.diff(offsets)
    doc = np.repeat(np.arange(len(size)), size)
    upto = np.concatenate(([0], np.cumsum(late)))  # each set is sorted: its rare tokens go first, in the same order
    behind = upto[:-1] - upto[offsets[:-1]][doc]
    rare = (size - np.diff(upto[offsets]))[doc]
    before = np.repeat(offsets[:-1], size)
    own = np.arange(len(token)) - before
    place = before + np.where(late, rare + behind, own - behind)
    ranked, marks = np.empty_like(token), np.empty_like(late)
    ranked[place], marks[place] = token, late
    return ranked, marks, own, doc


def _prefixes(texts: DataFrame, frequent, percent: int, bits: int) -> DataFrame:
    """(token, k, n, place) for the first shingles of each set in the global order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for token, offsets, keys in _batches(batches):
            token, _, place, doc = _ranked(token, offsets, frequent.value, bits)
            size = np.diff(offsets)
            first = np.minimum(size, size - -(-size * percent // 100) + SHARED)
            keep = place < first[doc]
            doc = doc[keep]
            yield pa.RecordBatch.from_arrays([pa.array(token[keep]), pa.array(keys[doc]), pa.array(size[doc]), pa.array(place[keep])],
                                             names=["token", "k", "n", "place"])

    return texts.mapInArrow(run, "token long, k long, n long, place long")


def _segments(texts: DataFrame, wanted, frequent, bits: int) -> DataFrame:
    """(k, fragment, tokens) of the sets whose key is in the filter, dealt by k and fragment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for token, offsets, keys in _batches(batches):
            asked = in_table(wanted.value, keys)
            if not asked.any():
                continue
            token, late, _, doc = _ranked(token, offsets, frequent.value, bits)
            keep = asked[doc]
            token, late, doc = token[keep], late[keep], doc[keep]
            fragment = (late.astype(np.int64) << FRAGMENT_BITS) | (token >> (63 - FRAGMENT_BITS))
            begin = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (fragment[1:] != fragment[:-1]))))
            lists = pa.ListArray.from_arrays(pa.array(np.append(begin, len(token)), pa.int32()), pa.array(token))
            yield pa.RecordBatch.from_arrays([pa.array(keys[doc[begin]]), pa.array(fragment[begin]), lists],
                                             names=["k", "fragment", "tokens"])

    return texts.mapInArrow(run, "k long, fragment long, tokens array<long>") \
        .repartition("k", "fragment").dropDuplicates(["k", "fragment"])


def _links(pairs: DataFrame, texts: DataFrame, frequent, bits: int, percent: int) -> DataFrame:
    """The pairs (a, b, na, nb) whose overlap, counted per fragment and summed, is large enough.
    Pairs are cut into fragments first: both joins then have the keys by which segments are dealt, which travel once."""
    wanted = bit_table(pairs.select(F.explode(F.array("a", "b")).alias("k")), FILTER_BITS)
    segments = _segments(texts, texts.sparkSession.sparkContext.broadcast(wanted), frequent, bits)
    cut = pairs.withColumn("fragment", F.explode(F.expr(f"sequence(0L, {(2 << FRAGMENT_BITS) - 1}L)")))
    left = segments.select(F.col("k").alias("a"), "fragment", F.col("tokens").alias("left"))
    right = segments.select(F.col("k").alias("b"), "fragment", F.col("tokens").alias("right"))
    partial = cut.join(left, ["a", "fragment"]).join(right, ["b", "fragment"]) \
        .select("a", "b", "na", "nb", F.size(F.array_intersect("left", "right")).alias("overlap"))
    return partial.groupBy("a", "b", "na", "nb").agg(F.sum("overlap").alias("overlap")) \
        .where(F.expr(f"100 * overlap >= {percent} * (na + nb - overlap)")).select("a", "b")


def linked_classes(texts: DataFrame, percent: int = PERCENT, slot_bits: int = SLOT_BITS) -> DataFrame:
    """(node, label) for every set that links with another one."""
    spark = texts.sparkSession
    frequent = spark.sparkContext.broadcast(_frequent_slots(texts, slot_bits))
    same = Window.partitionBy("token")
    buckets = _prefixes(texts, frequent, percent, slot_bits).withColumns({"lo": F.min("k").over(same), "hi": F.max("k").over(same)})
    members = stored_bare(buckets.where("lo <> hi").drop("lo", "hi").distinct())
    shares = members.groupBy("k", "n").agg((F.count(F.lit(1)) / F.col("n")).alias("hub"))
    members = stored_bare(members.select("token", "k", "place").join(shares, "k"))
    stars = stored_bare(_stars(members, percent))
    found = stored_bare(_links(stars, texts, frequent, slot_bits, percent))
    labels = connected(found)
    rest = stored_bare(_open_pairs(members, labels, percent).join(stars.select("a", "b"), ["a", "b"], "left_anti"))
    more = stored_bare(_links(rest, texts, frequent, slot_bits, percent))
    if not more.limit(1).count():
        return labels
    return connected(found.union(more))


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members with their labels, in buckets that hold several."""
    mine = members.join(labels.withColumnRenamed("node", "k"), "k", "left") \
        .withColumn("label", F.coalesce("label", "k"))
    split = mine.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    return mine.join(split.select("token"), "token")


def _stars(members: DataFrame, percent: int) -> DataFrame:
    """For each set the hub, another set, that heads most of its buckets: (a, b, na, nb).
    A bucket's hub is the set with the largest share of its shingles in shared buckets, which the
    middle of a group of near copies has."""
    mine = members.select("token", F.struct("hub", "k", "n").alias("own"))
    one = mine.groupBy("token").agg(F.max("own").alias("one"))
    two = mine.join(one, "token").where("own.k <> one.k").groupBy("token", "one").agg(F.max("own").alias("two"))
    met = mine.join(two, "token").select("own.k", "own.n", F.when(F.col("own.k") == F.col("one.k"), F.col("two")).otherwise(F.col("one")).alias("h"))
    counted = met.groupBy("k", "n", "h").agg(F.count(F.lit(1)).alias("n_shared")) \
        .groupBy("k", "n").agg(F.max(F.struct("n_shared", "h")).alias("best"))
    low = F.col("k") < F.col("best.h.k")
    pairs = counted.select(F.least("k", "best.h.k").alias("a"), F.greatest("k", "best.h.k").alias("b"),
                           F.when(low, F.col("n")).otherwise(F.col("best.h.n")).alias("na"),
                           F.when(low, F.col("best.h.n")).otherwise(F.col("n")).alias("nb"))
    return pairs.where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)").distinct()


def _open_pairs(members: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b, na, nb) of different components that share enough of their first shingles: sets with
    an overlap of c share ``SHARED`` of their first n - c + SHARED shingles (or all c of them)."""
    open_ = stored_bare(_open(members, labels))
    one = open_.select("token", F.col("k").alias("a"), F.col("n").alias("na"), F.col("place").alias("pa"), F.col("label").alias("la"))
    two = open_.select("token", F.col("k").alias("b"), F.col("n").alias("nb"), F.col("place").alias("pb"), F.col("label").alias("lb"))
    overlap = f"ceil({percent} * (na + nb) / {100 + percent}.0)"
    near = (f"a < b and la <> lb and 100 * least(na, nb) >= {percent} * greatest(na, nb) "
            f"and pa < na - {overlap} + {SHARED} and pb < nb - {overlap} + {SHARED}")
    return one.join(two, "token").where(near) \
        .groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("n_shared")) \
        .where(f"n_shared >= least({SHARED}, {overlap})").select("a", "b", "na", "nb")


def components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, classes): each row's doc_id, ``n_shingles`` and ``set_key``; each set's ``set_key``, number of
    rows, smallest id, ``component_id`` (smallest id that can be reached) and ``label`` (one per component)."""
    rows = stored_bare(keyed(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")))
                  .drop("text"))
    sets = rows.where("set_key is not null").groupBy("set_key") \
        .agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("n_rows"))
    labels = linked_classes(df.select(text_of(text_col).alias("text")))
    named = sets.join(labels.withColumnRenamed("node", "set_key"), "set_key", "left") \
        .withColumn("label", F.coalesce("label", "set_key"))
    of_label = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
    return rows, named.join(of_label, "label")


def join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, n_shingles, component_id."""
    rows, classes = components(df, id_col, text_col)
    return rows.join(classes.select("set_key", "component_id"), "set_key", "left") \
        .select("doc_id", "n_shingles", F.when(F.col("set_key").isNull(), F.col("doc_id"))
                .otherwise(F.col("component_id")).alias("component_id"))


def representatives(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` without near duplicates: of each component the row with the smallest id stays
    (one of them if several have it, or if none has an id), and every row with an empty set."""
    _, classes = components(df, id_col, text_col)
    grouped = stored_bare(classes.where("n_rows > 1 or not (least_id <=> component_id)").select("set_key", "component_id", "label"))
    table = df.sparkSession.sparkContext.broadcast(bit_table(grouped.select(F.col("set_key").alias("k")), FILTER_BITS))
    named = keyed(df.select(F.struct("*").alias("__row"), F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text")), "__text", table)
    met = named.where("in_table").join(grouped, "set_key", "left")
    alone = met.where("label is null")
    best = met.where("label is not null and __id <=> component_id").dropDuplicates(["label"])
    return named.where("not in_table").select("__row.*").union(alone.select("__row.*")).union(best.select("__row.*"))


def join_sql(table: str = "documents") -> str:
    """:func:`join` as DuckDB SQL, by comparing all pairs that share a shingle."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') AS ws FROM {table}),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {WIDTH} THEN [array_to_string(ws, ' ')]
          ELSE list_transform(range(1, len(ws) - {WIDTH - 2}), lambda i: array_to_string(ws[i:i + {WIDTH - 1}], ' ')) END) AS shingle FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
    e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= {PERCENT} * (x.n + y.n - common)),
    r(doc_id, reached) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reached)
    SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reached) AS component_id FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id"""
