"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit check.

Texts and benchmark items become sequences of words (runs of letters and digits
in lower case; letters of scripts that put no blanks between words are a word each).
A document is contaminated where a stretch of its words is
within ``share`` of an item's length in word edits (insert, remove, replace).

Every word position is a window as long as the items of a length class.  An edit
changes at most three word triples, and the closest stretch begins with one of an
item's first words, so windows that begin otherwise, or have too few triples of
the items of their class, cannot be the closest within the bound and are passed over.  The others, like the items, take the CGK random walk: step j
writes the current word and moves on if a random bit of (word, j) says so, which
turns few edits into few differing places.  Each repetition samples places of a
walk of its own as the LSH key; the number of repetitions is what a simulation
at the bound needs for the target recall, however many that are.  Long items drift
further, so their keys sample fewer places: the windows that are left are few by then.  Windows whose key is some item's are
joined with the items and verified by an exact edit distance.

Only bit tables of fixed size are broadcast; candidates meet the items in a
Spark join, so the benchmark may grow.

Defined results: a null or empty text contains nothing; null items and items without
a word are in no text.  Items too short for an edit (under 7 words at the default share)
are found where their words stand in a row, so an item of one word is in every text that
has the word; ``min_words`` leaves shorter items out where a caller asks for that.
Repeated rows, and rows that share an id, get one result per id and item.
Repeated items are reported each.  Extra columns do not matter.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kintsugi.llm.common import bit_table, code_points, in_table, mixed, parts_of, stored, table_filter, text_groups, word_hashes

#: Largest number of word edits, as a share of an item's words.
SHARE = 0.15
#: Share of the passages with the most allowed edits that should be found.
RECALL = 0.98
#: Most sampled places of a key; repetitions above which a class samples fewer; windows of a simulation.
SAMPLES = 3
FEWER_AT = 48
TRIALS = 400
#: Ratio between length classes.
RATIO = 1.25
#: Stands for all length classes in names: what no class has is looked up once.
ANY = 1 << 20
TRIPLE_BITS = 22
KEY_BITS = 24
_PAD = np.uint64(0x27D4EB2F165667C5)
_SALT = np.uint64(0x9E3779B97F4A7C15)
_WORD = (1 << 64) - 1


_ALONE = np.uint32(1 << 31)
#: Beginnings of the Unicode names of letters in scripts without blanks between words.
UNSPACED = ("CJK ", "HIRAGANA ", "KATAKANA ", "THAI ", "LAO ", "KHMER ", "MYANMAR ", "TIBETAN ")


@lru_cache(maxsize=1)
def _word_table() -> np.ndarray:
    """Lower-case code point of letters and digits, marked where it is a word alone; a blank for all else."""
    table = np.full(0x110000, 32, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalnum():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
            if i > 0x0E00 and unicodedata.name(c, "").startswith(UNSPACED):
                table[i] |= _ALONE
    return table


def sequences(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, and the number of the first word of each (and the end)."""
    codes, offsets = code_points(texts)
    codes = _word_table()[codes]
    alone = codes >= _ALONE
    if alone.any():  # blanks on both sides
        size = np.where(alone, 3, 1)
        ends = np.concatenate(([0], np.cumsum(size)))
        spaced = np.full(ends[-1], 32, np.uint32)
        spaced[ends[:-1] + alone] = codes & ~_ALONE
        codes, offsets = spaced, ends[offsets]
    words, _, first = word_hashes(codes, offsets)
    return words, first


def triples(words: np.ndarray) -> np.ndarray:
    """A hash of the word triple that begins at each word but the last two."""
    n = max(0, len(words) - 2)
    return mixed((words[:n] * _SALT + words[1:n + 1]) * _SALT + words[2:n + 2])


def class_names(hashes: np.ndarray, c: int, head: bool = False) -> np.ndarray:
    """Names of triples, or of words that items begin with, in a length class."""
    return mixed(hashes ^ mixed(np.full(1, 2 * c + head + 1, np.uint64))).astype(np.int64)


def length_class(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log(np.maximum(n, 1)) / math.log(RATIO) + 1e-9).astype(np.int64)


def class_lengths(c: int) -> tuple[int, int]:
    """Smallest and largest length of a class."""
    n = np.arange(1, int(RATIO ** (c + 1)) + 2)
    own = n[length_class(n) == c]
    return int(own[0]), int(own[-1])


def edits_allowed(n: int, share: float) -> int:
    return int(n * share + 1e-9)


def walk_keys(words: np.ndarray, start: np.ndarray, stop: np.ndarray, length: int, repetition: int,
              samples: int = SAMPLES) -> np.ndarray:
    """The LSH key of the window ``words[start:stop]`` in one repetition."""
    steps = 2 * length
    rng = np.random.default_rng([length, repetition])
    sampled = set(rng.choice(steps, min(samples, steps), replace=False).tolist())
    salts = rng.integers(1, 2**63, max(sampled) + 1, dtype=np.uint64)
    at = start.copy()
    key = np.full(len(start), (repetition + 1) * int(_SALT) + length & _WORD, np.uint64)
    last = max(len(words) - 1, 0)
    for j in range(max(sampled) + 1):
        word = np.where(at < stop, words[np.minimum(at, last)], _PAD) if len(words) else np.full(len(at), _PAD)
        if j in sampled:
            key = mixed(key ^ word) + _SALT
        at += (mixed(word ^ salts[j]) >> np.uint64(63)).astype(np.int64)
    return mixed(key).astype(np.int64)


def _edited(rng: np.random.Generator, words: np.ndarray, edits: int) -> np.ndarray:
    """``words`` after random edits (each inserts, removes or replaces), filled up to the same length by others."""
    place, kind = rng.choice(len(words), edits, replace=False), rng.integers(0, 3, edits)
    size = np.ones(len(words), np.int64)
    size[place[kind == 0]], size[place[kind == 1]] = 2, 0
    new = np.repeat(words, size)
    fresh = (np.cumsum(size) - size)[place[kind != 1]]  # the first of two copies, or the word itself
    new[fresh] = rng.integers(1, 2**63, len(fresh), dtype=np.uint64)
    return np.concatenate((new, rng.integers(1, 2**63, len(words), dtype=np.uint64)))[:len(words)]


@lru_cache(maxsize=256)
def repetitions(length: int, edits: int, target: float, samples: int = SAMPLES) -> int:
    """Repetitions after which the share ``target`` of simulated windows with ``edits`` random edits has met."""
    if not edits:
        return 1
    rng = np.random.default_rng([length, edits])
    own = rng.integers(1, 2**63, (TRIALS, length), dtype=np.uint64)
    other = np.concatenate([_edited(rng, row, edits) for row in own])
    own, stop = own.ravel(), np.arange(1, TRIALS + 1) * length
    met, r = np.zeros(TRIALS, bool), 0
    while met.mean() < target:
        met |= walk_keys(own, stop - length, stop, length, r, samples) == walk_keys(other, stop - length, stop, length, r, samples)
        r += 1
        if r > FEWER_AT and samples > 1:  # see class_plan
            break
    return r


@lru_cache(maxsize=256)
def class_plan(c: int, share: float, recall: float) -> tuple[int, int]:
    """(samples, repetitions) of a length class: the most samples whose repetitions reach the target
    without passing ``FEWER_AT``; single samples are repeated as often as it takes."""
    low, high = class_lengths(c)
    for samples in range(SAMPLES, 0, -1):
        found = repetitions(low, edits_allowed(high, share), recall, samples)
        if found <= FEWER_AT:
            break
    return samples, found


def closest(items: list[np.ndarray], windows: list[np.ndarray], spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of equal item length: fewest edits between the item and any stretch of its window that begins
    within the first ``span + 1`` words, and where the first such stretch begins."""
    n, m, w = len(items), len(items[0]), max(map(len, windows))
    item = np.stack(items)
    window = np.zeros((n, w), np.int64)
    valid = np.zeros((n, w), bool)
    for i, x in enumerate(windows):
        window[i, :len(x)], valid[i, :len(x)] = x, True
    one = w + 1  # a cell is its edits times this, plus the word where its stretch begins
    step, size = np.arange(w + 1), valid.sum(axis=1)
    begin = np.minimum(step, np.minimum(spans, size)[:, None])
    row = begin + (step - begin) * one
    for i in range(m):
        other = ((window != item[:, i:i + 1]) | ~valid) * one
        now = np.concatenate((row[:, :1] + one, np.minimum(row[:, 1:] + one, row[:, :-1] + other)), axis=1)
        row = np.minimum.accumulate(now - step * one, axis=1) + step * one
    best = np.where(step <= size[:, None], row, (m + w) * one).min(axis=1)
    return best // one, best % one


def edit_distances(items: list[np.ndarray], windows: list[np.ndarray]) -> np.ndarray:
    """Fewest edits between each item and any beginning of its window, for pairs of equal item length."""
    return closest(items, windows, np.zeros(len(items), np.int64))[0]


def item_words(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", min_words: int = 1) -> DataFrame:
    """(item, cls, words): the words and length class of every item that is searched."""
    id_type = dict(benchmark.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, first = sequences(batch.column(1).to_pylist())
            keep = np.flatnonzero(np.diff(first) >= max(1, min_words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep)), pa.array(length_class(np.diff(first)[keep]), pa.int64()),
                 pa.array([words[first[i]:first[i + 1]].astype(np.int64) for i in keep.tolist()], pa.list_(pa.int64()))],
                names=["item", "cls", "words"])

    rows = benchmark.select(F.col(id_col).alias("item"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    return rows.mapInArrow(run, f"item {id_type}, cls long, words array<long>")


def item_keys(items: DataFrame, plan: dict[int, tuple[int, int]], share: float = SHARE) -> DataFrame:
    """``items`` with the ``names`` of their triples and first words, and their ``keys``;
    ``plan`` gives the samples and repetitions of each length class."""
    id_type = dict(items.dtypes)["item"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, keys = [], []
            for c, words in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                own, low, start = np.array(words, np.int64).astype(np.uint64), class_lengths(c)[0], np.zeros(1, np.int64)
                samples, repeats = plan[c]
                keys.append([int(walk_keys(own, start, start + low, low, r, samples)[0]) for r in range(repeats)])
                heads = own[:edits_allowed(len(own), share) + 1]
                names.append(np.concatenate([x for k in (c, ANY) for x in (class_names(triples(own), k), class_names(heads, k, True))]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.list_(pa.int64())), pa.array(keys, pa.list_(pa.int64()))],
                names=["item", "cls", "words", "names", "keys"])

    return items.mapInArrow(run, f"item {id_type}, cls long, words array<long>, names array<long>, keys array<long>")


def _candidates(docs: DataFrame, plan: dict[int, tuple[int, int]], names, keys, share: float) -> DataFrame:
    """(id, place, span, keys, window): windows with keys that some item may have.  Windows of a length class that
    begin within its edits of each other are one row, whose stretches begin at ``place`` or up to ``span`` words later."""
    id_type = dict(docs.dtypes)["id"]
    classes = [(c, low, high, edits_allowed(high, share), *plan[c]) for c in sorted(plan) for low, high in [class_lengths(c)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches, 1):
            for at, group in text_groups(batch.column(1).to_pylist()):
                words, first = sequences(group)
                doc = np.repeat(np.arange(len(group)), np.diff(first))
                end, three = first[1:][doc], triples(words)
                heads = np.flatnonzero(in_table(names.value, class_names(words, ANY, True)))
                shared = np.flatnonzero(in_table(names.value, class_names(three, ANY)))
                for c, low, high, most, samples, repeats in classes:
                    start = heads[in_table(names.value, class_names(words[heads], c, True))]
                    known = shared[in_table(names.value, class_names(three[shared], c))]
                    stop = np.minimum(start + low, end[start])
                    enough = np.searchsorted(known, np.maximum(stop - 2, start)) - np.searchsorted(known, start) >= low - 2 - 3 * most
                    start, stop = start[enough], stop[enough]
                    hits = [(start[hit], key[hit]) for key in (walk_keys(words, start, stop, low, r, samples) for r in range(repeats))
                            for hit in [in_table(keys.value, key)] if hit.any()] if len(start) else []
                    if not hits:
                        continue
                    s, k = (np.concatenate(x) for x in zip(*hits, strict=True))
                    order = np.argsort(s, kind="stable")
                    s, k = s[order], k[order]
                    apart = (s[1:] - s[:-1] > most) | (doc[s[1:]] != doc[s[:-1]]) | (s[1:] // high != s[:-1] // high) & (s[1:] != s[:-1])
                    begin = np.flatnonzero(np.concatenate(([True], apart)))
                    span = s[np.append(begin[1:], len(s)) - 1] - s[begin]
                    s, row = s[begin], np.cumsum(np.concatenate(([0], apart)))
                    order = np.lexsort((k, row))  # each key once a row: the window travels with every one of them
                    k, row = k[order], row[order]
                    once = np.concatenate(([True], (k[1:] != k[:-1]) | (row[1:] != row[:-1])))
                    k, begin = k[once], np.searchsorted(row[once], np.arange(len(s)))
                    size = np.minimum(s + span + high + most, end[s]) - s
                    spot = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(s, size)
                    ends = np.concatenate(([0], np.cumsum(size)))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(at + doc[s])), pa.array(s - first[doc[s]]), pa.array(span),
                         pa.ListArray.from_arrays(pa.array(np.append(begin, len(k)), pa.int32()), pa.array(k)),
                         pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(words[spot].astype(np.int64)))],
                        names=["id", "place", "span", "keys", "window"])

    return docs.mapInArrow(run, f"id {id_type}, place long, span long, keys array<long>, window array<long>")


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         share: float = SHARE, recall: float = RECALL, min_words: int = 1) -> DataFrame:
    """(id, item, place, n_words, edits): each item that a document contains,
    at its closest (then first) place, counted in words."""
    spark = docs.sparkSession
    words = stored(item_words(benchmark, min_words=min_words))
    # length classes are as many as the logarithm of the longest item
    plan = {r["cls"]: class_plan(r["cls"], share, recall) for r in words.select("cls").distinct().collect()}
    items = stored(item_keys(words, plan, share))
    names = spark.sparkContext.broadcast(bit_table(items.select(F.explode("names").alias("k")), TRIPLE_BITS))
    keys = spark.sparkContext.broadcast(bit_table(items.select(F.explode("keys").alias("k")), KEY_BITS))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    found = _candidates(rows, plan, names, keys, share)
    by_key = items.select("item", "words", F.explode("keys").alias("key")).distinct()
    met = found.select("id", "place", "span", "window", F.explode("keys").alias("key")).join(by_key, "key") \
        .select("id", "place", "span", "window", "item", "words").distinct() \
        .repartition("id", "item")  # distances are for other tasks, which need no worker for the windows too

    @F.arrow_udf("struct<edits:int,place:long>")
    def distance(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for words, windows, places, spans in batches:
            a, b = ([np.asarray(x, np.int64) for x in col.to_pylist()] for col in (words, windows))
            span, begin = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (spans, places))
            out = np.zeros(len(a), np.int32)
            by_size: dict[int, list[int]] = {}
            for i, x in enumerate(a):
                by_size.setdefault(len(x), []).append(i)
            for size, every in by_size.items():
                every.sort(key=lambda i: span[i])
                reach = size + edits_allowed(size, share)
                step = max(1, (1 << 20) // (size + int(span[every[-1]]) + 1))
                for k in range(0, len(every), step):
                    some = every[k:k + step]
                    out[some], start = closest([a[i] for i in some], [b[i][:span[i] + reach] for i in some], span[some])
                    begin[some] += start
            yield pa.StructArray.from_arrays([pa.array(out), pa.array(begin)], names=["edits", "place"])

    # non-deterministic to Spark: else a filter on its result runs it a second time, in one more worker for each task
    checked = met.withColumn("best", distance.asNondeterministic()("words", "window", "place", "span")).withColumn("n_words", F.size("words").cast("long")) \
        .where(F.col("best.edits") <= F.floor(F.col("n_words") * F.lit(share) + F.lit(1e-9)))
    return checked.groupBy("id", "item").agg(F.min(F.struct("best.edits", "best.place")).alias("best"), F.first("n_words").alias("n_words")) \
        .select("id", "item", F.col("best.place").alias("place"), F.col("n_words").cast("int").alias("n_words"), F.col("best.edits").alias("edits"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          share: float = SHARE, recall: float = RECALL, min_words: int = 1) -> DataFrame:
    """The rows of ``docs`` that contain no item of the benchmark.  Rows are told apart by a hash of id and text."""
    r = F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    found = stored(find(docs.select(r.alias("r"), F.col(text_col).alias("text")), benchmark, "r", "text", share, recall, min_words)
                   .select(F.col("id").alias("__r")).distinct())
    table = docs.sparkSession.sparkContext.broadcast(bit_table(found.select(F.col("__r").alias("k")), KEY_BITS))
    named = docs.select(F.struct("*").alias("__row"), r.alias("__r"))
    hit = named.withColumn("__hit", table_filter(table, "__r"))
    return hit.where("not __hit").select("__row.*").union(hit.where("__hit").join(found, "__r", "left_anti").select("__row.*"))
