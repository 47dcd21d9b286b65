"""Exact substring deduplication: repeated byte strings of a minimum length.

Texts are UTF-8 bytes.  Every byte inside a string of ``LENGTH`` bytes that also
starts anywhere else in the corpus (in another text or in the same one,
overlaps included) is removed.

1. Copies of whole texts are counted by hash; of each only one takes part below.
2. Anchors: in every stretch of LENGTH bytes, the k-gram with the smallest hash.
   Equal stretches have equal anchors, so only anchors whose k-gram occurs
   twice matter.  An anchor's context holds all stretches it can stand for.
   Contexts that occur twice are repeated as a whole and need no bytes.
3. Other contexts of repeated anchors are brought together by anchor and go
   through a Burrows-Wheeler transform in pools of bounded size, over symbols of
   eight bytes cut in step with the anchor.  Breadth-first backward extension
   derives the common prefixes by increasing value: level by level, rows part
   where the rows they extend have parted, and it stops at the number of whole
   symbols that every repeated stretch holds.  The bytes at both ends are then
   compared for each of the eight phases.
   An anchor with more contexts than a pool holds is never put into one task:
   its stretches are grouped by hash across the cluster instead.
4. The found intervals go back to their texts, which drop the covered bytes.

Defined results: a null text counts as empty; texts shorter than LENGTH keep all
bytes; repeated rows are copies of each other and are removed.  Texts of any
length are handled in blocks.  Equality is judged by 64-bit hashes for anchors,
contexts and whole texts, by the bytes inside pools (ends by hash).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kintsugi.llm.common import bit_table, in_table, mixed, stored, table_filter, text_of

LENGTH = 200
GRAM = 64
#: Anchors that a stretch can have; bytes of text handled at once.
SPAN = LENGTH - GRAM + 1
BLOCK = 1 << 18
#: Contexts of one anchor that may share a pool; bytes of a pool.
POOL_ROWS = 20_000
POOL_BYTES = 2 << 20
TABLE_BITS = 24
SYMBOL = 8
#: Whole symbols that any stretch holds.
WHOLE = LENGTH // SYMBOL - 1

_B = 0x9E3779B97F4A7C15
_TOP = np.uint64((1 << 64) - 1)
_K = np.uint64(0xC2B2AE3D27D4EB4F)
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _sliding(values: np.ndarray, width: int, pick, fill) -> np.ndarray:
    """``pick`` over each ``width`` values from a place on, by doubling."""
    out, n = values, 1
    while n < width:
        step = min(n, width - n)
        ahead = np.full_like(out, fill)
        ahead[:-step or None] = out[step:]
        out, n = pick(out, ahead), n + step
    return out


def _segments(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of the joined texts: (bytes, text of each byte's own, begin and end of that
    text within the block's frame, mask of the anchors this block answers for)."""
    group, size, first = [], 0, 0
    for i, t in enumerate(texts):
        if group and size + len(t) > BLOCK:
            yield from _blocks(group, first)
            group, size, first = [], 0, i
        group.append(t)
        size += len(t)
    if group:
        yield from _blocks(group, first)


def _blocks(group: list[bytes], first: int):
    data = np.frombuffer(b"".join(group), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in group])))
    halo = 2 * LENGTH
    for a in range(0, max(len(data), 1), 2 * BLOCK):
        b = min(a + 2 * BLOCK, len(data))
        lo, hi = max(0, a - halo), min(len(data), b + halo)
        if hi <= lo:
            continue
        at = np.arange(lo, hi)
        text = np.searchsorted(offsets, at, side="right") - 1
        yield data[lo:hi], first + text, offsets[text] - lo, offsets[text + 1] - lo, (at >= a) & (at < b)


class Anchors:
    """The anchors of some texts, with their contexts."""

    def __init__(self, data, text, begin, end, own):
        n = len(data)
        at = np.arange(n)
        upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * _powers(_B, n)[:n], dtype=np.uint64)))
        inverse = _powers(pow(_B, -1, 1 << 64), n)

        def named(a, b):
            return mixed((upto[b] - upto[a]) * inverse[a] + (b - a).astype(np.uint64) * _K)

        whole = (at + GRAM <= np.minimum(end, n)) & (begin <= at)
        gram = np.full(n, _TOP)
        gram[whole] = named(at[whole], at[whole] + GRAM)
        least = _sliding(gram, SPAN, np.minimum, _TOP)
        least[at + LENGTH > np.minimum(end, n)] = 0
        covering = _sliding(least[::-1], SPAN, np.maximum, np.uint64(0))[::-1]
        self.place = np.flatnonzero((covering == gram) & whole & own)
        p = self.place
        self.low, self.high = np.maximum(p - (SPAN - 1), begin[p]), np.minimum(p + LENGTH, end[p])
        self.data, self.text = data, text[p]
        self.anchor = gram[p].astype(np.int64)
        self.context = (named(self.low, self.high) ^ mixed((p - self.low).astype(np.uint64) + _K)).astype(np.int64)
        self.pos = p - begin[p]


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in parts of few rows, so that Python objects exist for those only."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, Anchors]]:
    """Keys and anchors of the texts of a task, each text once."""
    seen: set[int] = set()
    for batch in _parts(batches):
        keys, texts = [], []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if key not in seen:
                seen.add(key)
                keys.append(key)
                texts.append(text.encode())
        keys = np.array(keys, np.int64)
        for block in _segments(texts):
            found = Anchors(*block)
            if len(found.place):
                yield keys, found


def _occurrences(docs: DataFrame) -> DataFrame:
    def run(batches):
        for keys, found in _each(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.anchor), pa.array(found.context), pa.array(keys[found.text]), pa.array(found.pos, pa.int32()),
                 pa.array(found.place - found.low, pa.int16()), pa.array(found.high - found.place, pa.int16())],
                names=["anchor", "context", "key", "pos", "l", "r"])

    return docs.mapInArrow(run, "anchor long, context long, key long, pos int, l short, r short")


def _contexts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of the wanted contexts (anchor, context, key, pos, l, r).  Texts meet the list of
    their contexts by key; texts that have none are left out by a bit table, copies by task."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(bit_table(wanted.select(F.col("key").alias("k")), TABLE_BITS))

    def once(batches):
        seen: set[int] = set()
        for batch in _parts(batches):
            keys = batch.column(0).to_numpy()
            fresh = [hit and k not in seen and not seen.add(k) for hit, k in zip(in_table(table.value, keys).tolist(), keys.tolist(), strict=True)]
            yield batch.filter(pa.array(fresh, pa.bool_()))

    def cut(batches):
        seen: set[int] = set()
        for batch in _parts(batches, 100):
            for key, text, places in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if key in seen:
                    continue
                seen.add(key)
                data = text.encode()
                got = [(p["anchor"], p["context"], key, p["pos"], p["l"], data[p["pos"] - p["l"]:p["pos"] + p["r"]]) for p in places]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int16(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(list(x), kind) for x, kind in zip(zip(*got, strict=True), kinds, strict=True)],
                                                 names=["anchor", "context", "key", "pos", "l", "bytes"])

    lists = wanted.groupBy("key").agg(F.collect_list(F.struct("anchor", "context", "pos", "l", "r")).alias("places"))
    texts = docs.mapInArrow(once, "key long, text string")
    return texts.join(lists, "key").select("key", "text", "places") \
        .mapInArrow(cut, "anchor long, context long, key long, pos int, l short, bytes binary")


def bounded_groups(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the suffixes of ``symbols`` (small integers): their places in sorted order, and for each
    row the number of its group with a common prefix of ``depth`` and of ``depth + 1`` symbols."""
    n = len(symbols)
    rank, h = symbols.astype(np.int64), 1
    while h < 2 * (depth + 1):
        after = np.zeros(n, np.int64)
        after[:-h] = rank[h:] + 1
        _, new = np.unique(rank * (n + 2) + after, return_inverse=True)
        rank, h = new.astype(np.int64), 2 * h
        if rank.max() == n - 1:
            break
    rows = np.argsort(rank, kind="stable")
    bwt = symbols[rows - 1]  # the symbol before each suffix, the last one before the first
    extended = np.argsort(bwt, kind="stable")  # the row that each row extends to the left
    first = bwt[extended]
    part = np.ones(n, bool)  # rows that differ from the one above within the level's prefix
    part[1:] = first[1:] != first[:-1]
    open_ = np.flatnonzero(~part)
    levels = []
    for level in range(1, depth + 2):
        group = np.cumsum(part)
        if level >= depth:
            levels.append(group)
        if level <= depth and len(open_):
            parted = group[extended[open_]] != group[extended[open_ - 1]]
            part = part.copy()
            part[open_[parted]] = True
            open_ = open_[~parted]
    return rows, levels[0], levels[1]


def repeated_stretches(contexts: list[bytes], shift: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First begin and last end of the stretches of LENGTH bytes in each context that
    occur at two places of the corpus (-1: none).  ``shift``: the anchor's offset; ``where``: the
    name of the place of each context's first byte."""
    count = len(contexts)
    size = np.fromiter(map(len, contexts), np.int64, count)
    lead = (-shift) % SYMBOL  # filling before, so that the anchor begins a symbol
    blocks = -(-(lead + size) // SYMBOL)
    start = np.cumsum(blocks + 1) - blocks - 1  # one symbol more as a separator
    flat = np.zeros(int((blocks + 1).sum()) * SYMBOL, np.uint8)
    spot = np.repeat(start * SYMBOL + lead - (np.cumsum(size) - size), size) + np.arange(size.sum())
    flat[spot] = np.frombuffer(b"".join(contexts), np.uint8)
    value = flat.view(">u8").astype(np.uint64)
    total = len(value)
    owner = np.repeat(np.arange(count), blocks + 1)
    inner = (np.arange(total) - start[owner]) * SYMBOL - lead[owner]  # offset of the symbol in its context
    full = (inner >= 0) & (inner + SYMBOL <= size[owner])
    symbols = np.empty(total, np.int64)
    apart = np.flatnonzero(~full)
    symbols[apart] = np.arange(len(apart))
    names, inverse = np.unique(value[full], return_inverse=True)
    symbols[full] = inverse + len(apart)
    rows, group, longer = bounded_groups(symbols, WHOLE)
    begin, end = np.full(count, 1 << 30), np.full(count, -1)

    def settle(at: np.ndarray, key: np.ndarray, offset: np.ndarray) -> None:
        """Stretches that begin ``offset`` into their context, equal where keys are."""
        if not len(at):
            return
        who = owner[at]
        place = where[who] + offset.astype(np.uint64) * _K
        order = np.argsort(key, kind="stable")
        key, place, who, offset = key[order], place[order], who[order], offset[order]
        cut = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        two = np.minimum.reduceat(place, cut) != np.maximum.reduceat(place, cut)
        hit = np.repeat(two, np.diff(np.append(cut, len(key))))
        np.minimum.at(begin, who[hit], offset[hit])
        np.maximum.at(end, who[hit], offset[hit] + LENGTH)

    def together(groups: np.ndarray) -> np.ndarray:
        same = groups[1:] == groups[:-1]
        return np.flatnonzero(np.concatenate(([False], same)) | np.concatenate((same, [False])))

    some = together(longer)
    at = rows[some]
    fits = full[at] & (inner[at] + LENGTH <= size[owner[at]])
    settle(at[fits], longer[some][fits], inner[at][fits])
    some = together(group)
    at, named = rows[some], mixed(group[some].astype(np.uint64) + _K)
    for tail in range(1, SYMBOL):
        head = SYMBOL - tail
        offset = inner[at] - head
        fits = full[at] & (offset >= 0) & (offset + LENGTH <= size[owner[at]])
        a = at[fits]
        ends = (value[a - 1] << np.uint64(8 * tail)) | (value[a + WHOLE] >> np.uint64(8 * head))
        settle(a, mixed(ends ^ named[fits]), offset[fits])
    return np.where(end < 0, -1, begin), end


def _pool_intervals(contexts: DataFrame) -> DataFrame:
    """(context, left, right): how far repeated stretches reach from the anchor."""

    def solved(rows: list[tuple]) -> pa.RecordBatch:
        anchor, context, key, pos, l, data = map(list, zip(*rows, strict=True))
        shift = np.array(l, np.int64)
        begin, end = repeated_stretches(data, shift, _place_names(np.array(key, np.int64), np.array(pos, np.int64) - shift))
        hit = end >= 0
        return pa.RecordBatch.from_arrays([pa.array(np.array(context, np.int64)[hit]), pa.array((shift - begin)[hit], pa.int32()),
                                           pa.array((end - shift)[hit], pa.int32())], names=["context", "left", "right"])

    def run(batches):
        rows, size = [], 0
        for batch in _parts(batches):
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if size > POOL_BYTES and row[0] != rows[-1][0]:
                    yield solved(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[5])
        if rows:
            yield solved(rows)

    return contexts.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, "context long, left int, right int")


def _place_names(key: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Names of corpus places; a step of one byte adds a constant."""
    return mixed(key.astype(np.uint64)) + pos.astype(np.uint64) * _K


def _hashed_intervals(contexts: DataFrame) -> DataFrame:
    """The same for anchors with too many contexts for a pool: stretches meet by hash."""

    def run(batches):
        for batch in _parts(batches):
            data = batch.column(5).to_pylist()
            context, key, pos, shift = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2, 3, 4))
            flat = np.frombuffer(b"".join(data), np.uint8)
            size = np.fromiter(map(len, data), np.int64, len(data))
            upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[flat] * _powers(_B, len(flat))[:len(flat)], dtype=np.uint64)))
            count = np.maximum(size - LENGTH + 1, 0)
            who = np.repeat(np.arange(len(data)), count)
            offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            a = (np.cumsum(size) - size)[who] + offset
            name = mixed((upto[a + LENGTH] - upto[a]) * _powers(pow(_B, -1, 1 << 64), len(flat))[a])
            place = _place_names(key[who], pos[who] - shift[who] + offset)
            yield pa.RecordBatch.from_arrays(
                [pa.array(name.astype(np.int64)), pa.array(context[who]), pa.array(place.astype(np.int64)),
                 pa.array(shift[who] - offset, pa.int32())], names=["stretch", "context", "place", "left"])

    rows = contexts.mapInArrow(run, "stretch long, context long, place long, left int")
    twice = rows.groupBy("stretch").agg(F.min("place").alias("lo"), F.max("place").alias("hi")).where("lo <> hi")
    return rows.join(twice.select("stretch"), "stretch").groupBy("context") \
        .agg(F.max("left").alias("left"), (F.lit(LENGTH) - F.min("left")).cast("int").alias("right"))


def removed_spans(df: DataFrame, text_col: str = "text", pool_rows: int = POOL_ROWS) -> tuple[DataFrame, DataFrame]:
    """(key, check) of the texts that occur twice and go whole; (key, spans): the intervals that go from the others."""
    spark = df.sparkSession
    docs = df.select(*_identity(text_col), text_of(text_col).alias("text")).where(F.octet_length("text") >= LENGTH)
    copies = stored(docs.groupBy("key", "check").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "check"))
    rows = docs.select("key", "text")
    same = Window.partitionBy("anchor")
    kept = stored(_occurrences(rows).withColumns({"n": F.count(F.lit(1)).over(same), "lo": F.min("context").over(same),
                                                  "hi": F.max("context").over(same)})
                  .where("n > 1").withColumn("varied", F.col("lo") != F.col("hi")).drop("n", "lo", "hi"))
    contexts = kept.groupBy("anchor", "context", "varied") \
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "pos", "l", "r")).alias("at"))
    contexts = stored(contexts.select("anchor", "context", "varied", "n", "at.*"))
    varied = contexts.where("varied")
    hot = varied.groupBy("anchor").count().where(F.col("count") > pool_rows).select(F.col("anchor").alias("k"))
    crowded = spark.sparkContext.broadcast(bit_table(hot, TABLE_BITS))
    cut = _contexts(rows, varied.select("anchor", "context", "key", "pos", "l", "r"))
    if crowded.value.any():
        cut = stored(cut.withColumn("crowded", table_filter(crowded, "anchor")))
        found = _pool_intervals(cut.where("not crowded").drop("crowded")) \
            .union(_hashed_intervals(cut.where("crowded").drop("crowded")))
    else:
        found = _pool_intervals(cut)
    again = contexts.where("n > 1").select("context", F.col("l").cast("int").alias("left"), F.col("r").cast("int").alias("right"))
    reach = found.union(again).groupBy("context").agg(F.max("left").alias("left"), F.max("right").alias("right"))
    spans = kept.join(reach, "context").groupBy("key") \
        .agg(F.collect_list(F.struct((F.col("pos") - F.col("left")).alias("a"), (F.col("pos") + F.col("right")).alias("b"))).alias("spans"))
    return copies, stored(spans)


def _identity(text_col: str) -> list[F.Column]:
    text = text_of(text_col)
    return [F.xxhash64(text).alias("key"), F.hash(text, F.octet_length(text)).alias("check")]


def dedup(df: DataFrame, text_col: str = "text", pool_rows: int = POOL_ROWS) -> DataFrame:
    """``df`` with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (the remaining bytes)."""
    copies, spans = removed_spans(df, text_col, pool_rows)

    @F.arrow_udf("struct<n_bytes:long,n_removed:long,n_spans:long,kept:binary>")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, wholes, lists in ([c.slice(first, 500) for c in columns] for columns in batches
                                     for first in range(0, len(columns[0]), 500)):
            out = []
            begins, ends = lists.flatten().field("a"), lists.flatten().field("b")
            upto = np.concatenate(([0], np.cumsum(np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64))))
            begins, ends = begins.to_numpy(zero_copy_only=False), ends.to_numpy(zero_copy_only=False)
            for i, (text, whole) in enumerate(zip(texts.to_pylist(), wholes.to_pylist(), strict=True)):
                data = text.encode()
                if whole:
                    out.append((len(data), len(data), 1, b""))
                    continue
                a, b = begins[upto[i]:upto[i + 1]], ends[upto[i]:upto[i + 1]]
                if not len(a):
                    out.append((len(data), 0, 0, data))
                    continue
                order = np.argsort(a, kind="stable")
                a, b = a[order], np.maximum.accumulate(b[order])
                new = np.concatenate(([True], a[1:] > b[:-1]))
                a, b = a[new].tolist(), b[np.append(np.flatnonzero(new)[1:] - 1, len(b) - 1)].tolist()
                kept = b"".join(data[x:y] for x, y in zip([0, *b], [*a, len(data)], strict=True))
                out.append((len(data), len(data) - len(kept), len(a), kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.StructArray.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)],
                                             names=["n_bytes", "n_removed", "n_spans", "kept"])

    named = df.withColumns({f"__{k}": c for k, c in zip(("key", "check"), _identity(text_col), strict=True)})
    keys = copies.select("key").union(spans.select("key")).select(F.col("key").alias("k"))
    table = df.sparkSession.sparkContext.broadcast(bit_table(keys, TABLE_BITS))
    named = named.withColumn("__hit", table_filter(table, "__key"))
    text, zero = text_of(text_col), F.lit(0).cast("long")
    whole = named.where("not __hit").withColumn("__n", F.octet_length(text).cast("long")) \
        .withColumns({"kept": text.cast("binary"), "n_removed": zero, "n_spans": zero, "n_bytes": F.col("__n")})
    copies = copies.withColumn("__whole", F.lit(True)).toDF("__key", "__check", "__whole")
    met = named.where("__hit").join(copies, ["__key", "__check"], "left").join(spans.toDF("__key", "__spans"), "__key", "left")
    none = F.array().cast("array<struct<a:int,b:int>>")
    done = met.withColumn("__cut", cut(text, F.coalesce("__whole", F.lit(False)), F.coalesce("__spans", none))) \
        .withColumns({c: F.col(f"__cut.{c}") for c in ("n_bytes", "n_removed", "n_spans", "kept")})
    columns = [c for c in done.columns if not c.startswith("__")]
    return whole.select(columns).union(done.select(columns))
