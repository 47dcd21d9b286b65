"""Quality by neighbours: similarity-weighted votes of labelled texts in a latent-semantic space.

A text becomes counts of its hashed character n-grams and of the n-grams of its
shape (letters and digits as classes, a word like the one before it marked as
repeated), with the text's ends marked, damped by a logarithm and weighed by how
few of the labelled texts hold them.  The leading singular vectors of the labelled texts'
weights span the latent space.  The labelled vectors are broadcast; each task
multiplies blocks of its own texts' unit vectors with all of them, which gives
every cosine exactly, and the most similar ones vote for their label with their
similarity as weight.

The labelled texts are a sample bounded by ``per_label`` rows of each label (the
rows with the smallest hash of their id); each label's votes are weighed by how
many rows of it one sampled row stands for, so the sample's mixture does not
shift the scores.  Model size: at most ``2 * per_label`` texts, ``2 * 2**bits``
buckets, ``dims`` dimensions.

Defined results: a null text counts as empty.  A text without any similar
labelled text (cosine above 0) scores the share of label 1 among all labelled
rows; without labelled rows every score is 0.5.  Labels other than 0 and 1, and
null labels or texts, teach nothing.  Neighbours as similar as the last one
also vote, so ties do not depend on order.  Repeated rows count as often as
they occur.  Texts over one million code points are counted in pieces of that
size whose counts are added.  Input columns that carry an output's name are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kintsugi.llm.common import PIECE, code_points, is_blank, slices, text_of, word_hashes

#: Labelled rows kept of each label, nearest neighbours that vote, and the score from which a text counts as good.
PER_LABEL, NEIGHBOURS, THRESHOLD = 1500, 10, 0.3
ORDERS, SHAPE_ORDERS, BITS, DIMS = (1, 2, 3), (1, 2, 3, 4), 11, 48
#: Texts whose cosines are computed together, and the decimals of a score.
ROWS, DIGITS = 256, 6
_END, _AGAIN = np.uint32(0x110000), np.uint32(0x110001)


@lru_cache(maxsize=1)
def _shapes() -> np.ndarray:
    """The sign of every code point: one for small letters, capitals, other letters and digits each; others are their own."""
    table = np.arange(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalnum():
            table[i] = ord("a") if c.islower() else ord("A") if c.isupper() else ord("0") if c.isdigit() else ord("x")
    return table


def _hashed(codes: np.ndarray, order: int, bits: int) -> np.ndarray:
    """Bucket of the n-gram that begins at each place."""
    n = len(codes) - order + 1
    h = np.full(n, order * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
    for k in range(order):
        h ^= codes[k:k + n]
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
    return h >> np.uint32(32 - bits)


def _signs(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The texts' shapes; a word like the one before it has the sign of repetition instead of its first one's."""
    signs = _shapes()[codes]
    words, length, first_word = word_hashes(codes, offsets)
    if len(words):
        again = np.concatenate(([False], (words[1:] == words[:-1]) & (length[1:] == length[:-1])))
        again[first_word[:-1][first_word[:-1] < len(words)]] = False
        inside = ~is_blank(codes)
        in_word = np.concatenate(([False], inside[:-1]))
        in_word[offsets[:-1][offsets[:-1] < len(codes)]] = False
        signs[np.flatnonzero(inside & ~in_word)[again]] = _AGAIN
    return signs


def counts(texts: list[str], orders: tuple[int, ...] = ORDERS, shape_orders: tuple[int, ...] = SHAPE_ORDERS,
           bits: int = BITS) -> np.ndarray:
    """Occurrences of each bucket's n-grams: texts x (buckets of the text, then of its shape).  Every text stands
    between two end marks."""
    table = np.zeros((len(texts), 2 << bits), np.float32)
    for first, last in _groups(texts):
        group = texts[first:last]
        codes, offsets = code_points(group)
        size = np.diff(offsets) + 2
        upto = np.concatenate(([0], np.cumsum(size)))
        inner = np.ones(upto[-1], bool)
        inner[upto[:-1]] = inner[upto[1:] - 1] = False
        owner = np.repeat(np.arange(len(group), dtype=np.int64), size)
        flat = np.zeros(len(group) * (2 << bits), np.int64)
        for half, (signs, all_orders) in enumerate(((codes, orders), (_signs(codes, offsets), shape_orders))):
            marked = np.full(upto[-1], _END, np.uint32)
            marked[inner] = signs
            # a long text's pieces overlap by the longest n-gram less one: no n-gram is lost or counted twice
            for begin in range(0, len(marked), PIECE):
                for order in all_orders:
                    part = marked[begin:begin + PIECE + order - 1]
                    if len(part) < order:
                        continue
                    own = owner[begin:begin + len(part)]
                    bucket = _hashed(part, order, bits)
                    same = own[:len(bucket)] == own[order - 1:]
                    slot = (2 * own[:len(bucket)] + half << bits) + bucket
                    flat += np.bincount(slot[same], minlength=len(flat))
        table[first:last] = flat.reshape(len(group), -1)
    return table


def _groups(texts: list[str], rows: int = ROWS) -> Iterator[tuple[int, int]]:
    """Runs of at most ``rows`` texts and about PIECE code points."""
    first = total = 0
    for i, t in enumerate(texts):
        if i > first and (i - first >= rows or total + len(t) > PIECE):
            yield first, i
            first, total = i, 0
        total += len(t)
    if first < len(texts):
        yield first, len(texts)


@dataclass(frozen=True)
class Neighbours:
    """The labelled vectors (unit rows), their labels and vote weights, and what maps counts to vectors."""
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    idf: np.ndarray
    space: np.ndarray
    prior: float
    k: int
    orders: tuple[int, ...]
    shape_orders: tuple[int, ...]
    bits: int


def _unit(rows: np.ndarray) -> np.ndarray:
    size = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    return rows / np.where(size > 0, size, 1)[:, None]


def _leading(rows: np.ndarray, dims: int, rounds: int = 6) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration from a fixed start."""
    dims = min(dims, *rows.shape)
    base = np.random.default_rng(0).standard_normal((rows.shape[1], min(dims + 16, rows.shape[1]))).astype(rows.dtype)
    for _ in range(rounds):
        base, _ = np.linalg.qr(rows.T @ (rows @ base))
    _, _, turn = np.linalg.svd(rows @ base, full_matrices=False)
    return (base @ turn.T)[:, :dims]


def weighed(table: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Damped counts with their weights; the text's half and the shape's half both at length 1."""
    rows = np.log1p(table) * idf
    half = rows.shape[1] // 2
    return np.hstack((_unit(rows[:, :half]), _unit(rows[:, half:])))


def fit(table: np.ndarray, labels: np.ndarray, totals: dict[int, int], dims: int = DIMS, k: int = NEIGHBOURS,
        orders: tuple[int, ...] = ORDERS, shape_orders: tuple[int, ...] = SHAPE_ORDERS, bits: int = BITS) -> Neighbours:
    """The model from counts of labelled texts and the number of all labelled rows per label."""
    everything = sum(totals.values())
    prior = totals.get(1, 0) / everything if everything else 0.5
    idf = (np.log((1 + len(table)) / (1 + (table > 0).sum(axis=0))) + 1).astype(np.float32)
    rows = weighed(table, idf)
    space = _leading(rows, dims) if len(rows) else np.zeros((table.shape[1], 0), np.float32)
    weights = np.array([totals[int(x)] / (labels == x).sum() for x in labels], np.float64)
    return Neighbours(_unit(rows @ space).astype(np.float32), labels.astype(np.int8), weights, idf, space.astype(np.float32),
                      prior, k, orders, shape_orders, bits)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
          per_label: int = PER_LABEL, dims: int = DIMS, k: int = NEIGHBOURS, orders: tuple[int, ...] = ORDERS,
          shape_orders: tuple[int, ...] = SHAPE_ORDERS, bits: int = BITS) -> Neighbours:
    """The model from the labelled texts: ``labels`` holds ids and labels, ``docs`` ids and texts.

    Only ids meet in the join; the texts of the sample alone are read further, and tasks turn them to counts."""
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("label in (0, 1)")
    known = marked.join(docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id")), "id")
    order = F.struct(F.xxhash64("id"), "id")
    # per label, its rows and the smallest hashes: k smallest by bounded partial aggregates of each task
    totals = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    ids = None
    for label in sorted(totals):
        of = known.where(F.col("label") == label).distinct().orderBy(order).limit(per_label)
        ids = of if ids is None else ids.union(of)
    if ids is None:
        return fit(np.zeros((0, 2 << bits), np.float32), np.zeros(0, int), {}, dims, k, orders, shape_orders, bits)
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null") \
        .join(F.broadcast(ids), "id").select("id", "label", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in slices(batch.column(2)):
                texts = part.to_pylist()
                for first, last in _groups(texts):
                    table = counts(texts[first:last], orders, shape_orders, bits)
                    row, slot = np.nonzero(table)
                    ends = np.searchsorted(row, np.arange(len(table) + 1)).astype(np.int32)
                    at = slice(done + first, done + last)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0)[at].cast(pa.string()), batch.column(1)[at],
                         pa.ListArray.from_arrays(ends, pa.array(slot.astype(np.int32))),
                         pa.ListArray.from_arrays(ends, pa.array(table[row, slot]))], names=["id", "label", "slots", "counts"])
                done += len(part)

    # at most 2 * per_label rows (more only where ids repeat, which the limit below cuts) of at most 2^bits entries
    got = picked.mapInArrow(count, "id string, label int, slots array<int>, counts array<float>") \
        .orderBy("label", F.xxhash64("id"), "id", "slots", "counts").limit(2 * per_label).toArrow()
    table = np.zeros((got.num_rows, 2 << bits), np.float32)
    for i, (slots, n) in enumerate(zip(got["slots"], got["counts"], strict=True)):
        table[i, slots.values.to_numpy()] = n.values.to_numpy()
    return fit(table, got["label"].to_numpy(), totals, dims, k, orders, shape_orders, bits)


def scores(texts: list[str], model: Neighbours) -> np.ndarray:
    """Share of label 1 among the votes of each text's neighbours."""
    out = np.full(len(texts), model.prior)
    k = min(model.k, len(model.vectors))
    if not k:
        return out
    for first, last in _groups(texts):
        own = _unit(weighed(counts(texts[first:last], model.orders, model.shape_orders, model.bits), model.idf) @ model.space)
        # rounded, so that a block's shape does not decide which of two equal neighbours votes
        cosine = np.round((own @ model.vectors.T).astype(np.float64), DIGITS)
        least = -np.partition(-cosine, k - 1, axis=1)[:, k - 1:k]
        vote = np.where((cosine >= least) & (cosine > 0), cosine, 0) * model.weights
        total = vote.sum(axis=1)
        good = vote @ (model.labels == 1)
        out[first:last] = np.where(total > 0, good / np.where(total > 0, total, 1), model.prior)
    return np.clip(np.round(out, DIGITS), 0, 1)


def rate(df: DataFrame, model: Neighbours, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with ``score`` (0 to 1) and ``predicted`` (1 from the threshold on)."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [scores(part.to_pylist(), shared.value) for part in slices(batch)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return df.withColumn("score", run(text_of(text_col))) \
        .withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether the document is in the fifth that teaches nothing: crc32 of its id as text, modulo 5, is 0."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0
