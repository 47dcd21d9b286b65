"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kintsugi.session import materialize

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Code points of text handled at once inside a task; bounds numpy's memory.
PIECE = 1 << 20
# Code points of several texts handled together: arrays of eight bytes a code point stay small beside the heap.
GROUP = 1 << 18

#: Characters that separate words: blank, tab, line feed, VT, FF, CR.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def text_of(name: str = "text") -> Column:
    """The text column with null read as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one uint32 array and the offset where each begins (and the end)."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, offsets


def text_groups(texts: list[str], size: int = GROUP) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``size`` code points together: (index of the first, texts)."""
    first, group, total = 0, [], 0
    for i, t in enumerate(texts):
        if group and total + len(t) > size:
            yield first, group
            first, group, total = i, [], 0
        group.append(t)
        total += len(t)
    if group:
        yield first, group


_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64(0xC2B2AE3D27D4EB4F)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_BLANK = np.zeros(33, bool)
_BLANK[[32, *range(9, 14)]] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit hashes with their bits spread."""
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def is_blank(codes: np.ndarray) -> np.ndarray:
    """Whether each code point separates words (see ``WORD_PATTERN``)."""
    return _BLANK[np.minimum(codes, 32)] & (codes <= 32)


def word_hashes(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of several texts (see ``WORD_PATTERN``): their 64-bit hashes, their
    lengths, and the number of the first word of each text (and the end).

    A word's hash sums a mixed number per character and place.  (A polynomial modulo 2^64 has
    equal values for some regular words of a few hundred characters, whatever its base.)"""
    inside = ~is_blank(codes)
    in_word = np.concatenate(([False], inside, [False]))
    cut = np.zeros(len(codes) + 1, bool)
    cut[offsets] = True
    begins = np.flatnonzero(inside & (~in_word[:-2] | cut[:-1]))
    ends = np.flatnonzero(inside & (~in_word[2:] | cut[1:])) + 1
    length = ends - begins
    first_word = np.searchsorted(begins, offsets)
    if not len(begins):
        return np.zeros(0, np.uint64), length, first_word
    position = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    placed = mixed(codes[inside].astype(np.uint64) * _BASE + position.astype(np.uint64) * _PLACE)
    words = mixed(np.add.reduceat(placed, np.cumsum(length) - length))
    return words + mixed(length.astype(np.uint64)), length, first_word


@lru_cache(maxsize=1)
def _trim():
    """The C library's call that returns free memory to the system, where it has one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):
        return lambda _: 0


def give_back() -> None:
    """Returns this worker's free memory to the system: workers live on between tasks and stages, and what numpy
    and Arrow keep for later would add up beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def slices(batch: pa.Array, size: int = 4 * GROUP) -> Iterator[pa.Array]:
    """Slices of a string or list column of about ``size`` bytes or elements each, so
    that Python objects exist for a part of an Arrow batch only."""
    length = pc.list_value_length(batch) if pa.types.is_list(batch.type) else pc.binary_length(batch)
    upto = np.cumsum(pc.fill_null(length, 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(batch):
        done = upto[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(upto, done + size, side="right")))
        yield batch.slice(first, last - first)
        first = last
    give_back()


def parts_of(batches: Iterator[pa.RecordBatch], text: int = 0) -> Iterator[pa.RecordBatch]:
    """The batches cut by the size of a text column (see :func:`slices`)."""
    for batch in batches:
        first = 0
        for part in slices(batch.column(text)):
            yield batch.slice(first, len(part))
            first += len(part)
    give_back()


def small_batches(spark: SparkSession) -> None:
    """Whole texts travel in Arrow batches, which the JVM and the workers hold beside the heap: 2000 rows
    in each where the session has Spark's default."""
    if spark.conf.get(ARROW_ROWS, "10000") == "10000":
        spark.conf.set(ARROW_ROWS, "2000")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as a Parquet table in the shared checkpoint folder and read back,
    so that later steps neither repeat its work nor depend on executors that may be lost."""
    return materialize(df)


def stored_bare(df: DataFrame) -> DataFrame:
    """As :func:`stored`, and the write's shuffle files go when it ends.  Spark else keeps them until the driver
    happens to collect its garbage, so that a chain of steps holds the shuffles of all of them on disk."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLES_GO, None)
    conf.set(SHUFFLES_GO, "true")
    try:
        return stored(df)
    finally:
        conf.unset(SHUFFLES_GO) if before is None else conf.set(SHUFFLES_GO, before)


def bit_table(keys: DataFrame, bits: int) -> np.ndarray:
    """A table of 2^bits bits (as bytes) with the low bits of all keys (column k)
    set.  Spark packs the bits, so at most 2^bits / 64 rows reach the driver,
    whatever the number of keys; a full table only stops filtering."""
    words = keys.select(F.col("k").bitwiseAND((1 << bits) - 1).alias("slot")) \
        .select(F.expr("slot div 64").alias("word"), F.expr("shiftleft(1L, cast(slot % 64 as int))").alias("bit")) \
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    table = np.zeros((1 << bits) // 64, np.int64)
    table[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return table.view(np.uint8)


def in_table(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the low bits of each key are set in a :func:`bit_table`."""
    slot = keys & (len(table) * 8 - 1)
    return (table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0


def table_filter(table, key: Column | str) -> Column:
    """Whether a long column is in a broadcast :func:`bit_table`."""

    @F.arrow_udf("boolean")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(in_table(table.value, batch.to_numpy(zero_copy_only=False).astype(np.int64)))

    return run(F.col(key) if isinstance(key, str) else key)


def connected(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (columns a, b): the label is the
    smallest node that can be reached.  Labels spread along edges and jump to the
    label of their label, so the rounds grow with the logarithm of a chain's length."""
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")) \
        .withColumn("label", F.least("node", "label"))
    while True:
        labels = stored(labels)
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b") \
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        spread = labels.join(near, "node").select("node", F.col("label").alias("before"),
                                                   F.least("label", "near").alias("label"))
        to = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = stored(spread.join(to, "label").select("node", "before", F.least("label", "further").alias("label")))
        if not moved.where("label <> before").limit(1).count():
            return moved.select("node", "label")
        labels = moved.select("node", "label")
