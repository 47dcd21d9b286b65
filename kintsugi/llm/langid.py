"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts come from one distributed pass over every labelled row; each
task keeps one dense count vector per language and Spark adds the vectors up.
The log-probability matrix (languages x buckets, both bounded by parameters)
is broadcast; scoring gathers each n-gram's log-probabilities and sums them per
document in numpy.

The posterior only compares the learned languages.  Whether a text is in any of
them shows in its mean log-likelihood per n-gram, which does not grow with the
text: ``with_limits`` takes each language's usual value and its spread from all
labelled rows, and texts far below it (with more room for short ones) are in no
known language.

Defined results: a null text, an empty text and a text without any letter give
``und`` with score 0.  Rows whose text or language is null teach nothing.  With
no labelled row at all every prediction is ``und``.  Repeated rows count as
often as they occur.  Columns of the input that carry an output's name are
replaced.  Texts over one million code points are scored in pieces of that
size whose log-likelihoods are added.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kintsugi.llm.common import PIECE, code_points, parts_of, slices, text_groups

UNDETERMINED = "und"
#: A text may lie so many spreads (median less first quartile, at least the given one) of its language's rows
#: below their median, and so many standard errors of its own mean.
SPREADS = 10.0
LEAST_SPREAD = 0.1
ERRORS = 4.0
#: Steps per unit of the histograms of mean log-likelihoods.
_FINE = 1000


@dataclass(frozen=True)
class LangModel:
    """Languages in sorted order, log priors, and log-probabilities (buckets x languages); with limits, the least
    usual mean log-likelihood per n-gram of each language, and the standard deviation of one n-gram."""
    languages: tuple[str, ...]
    log_prior: np.ndarray
    log_prob: np.ndarray
    orders: tuple[int, ...]
    lowest: np.ndarray | None = None
    deviation: np.ndarray | None = None


@lru_cache(maxsize=1)
def _letter_table() -> np.ndarray:
    """Lower-case code point of every letter; 0 for anything else."""
    table = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters in lower case with every run of other characters as one blank:
    code array, offsets per text, and whether a text has any letter."""
    codes, offsets = code_points(texts)
    low = _letter_table()[codes]
    is_letter = low > 0
    keep = is_letter.copy()
    if len(keep):
        keep[1:] |= is_letter[:-1]
        starts = offsets[:-1][offsets[:-1] < len(codes)]
        keep[starts] = is_letter[starts]
    low[~is_letter] = 32
    upto = np.concatenate(([0], np.cumsum(keep)))
    letters = np.concatenate(([0], np.cumsum(is_letter)))
    return low[keep], upto[offsets], letters[offsets[1:]] > letters[offsets[:-1]]


def _buckets(codes: np.ndarray, order: int, bits: int) -> np.ndarray:
    """Bucket of the n-gram that begins at each position."""
    n = max(0, len(codes) - order + 1)
    h = np.full(n, order * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
    for k in range(order):
        h ^= codes[k:k + n]
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
    return h >> np.uint32(32 - bits)


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang",
          orders: tuple[int, ...] = (1, 2, 3), bits: int = 15,
          alpha: float = 0.5, max_languages: int = 256) -> LangModel:
    """Fit the model on all rows of ``df`` with text and language.

    The model has at most ``max_languages * 2**bits`` numbers; more languages
    than that are an error, never dropped."""
    rows = df.select(F.col(text_col).cast("string").alias("text"),
                     F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    priors = {r["lang"]: r["n"] for r in
              rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(max_languages + 1).collect()}
    if len(priors) > max_languages:
        raise ValueError(f"more than {max_languages} languages; raise max_languages")
    languages = tuple(sorted(priors))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in parts_of(batches):
            by_lang: dict[str, list[str]] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by_lang.setdefault(lang, []).extend(text[i:i + PIECE] for i in range(0, len(text), PIECE))
            for lang, texts in by_lang.items():
                total = held.setdefault(lang, np.zeros(1 << bits, np.int64))
                for _, group in text_groups(texts):
                    codes, offsets, _ = _letters(group)
                    for order in orders:
                        total += np.bincount(_within(codes, offsets, order, bits), minlength=1 << bits)
        for lang, total in held.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(total[at], pa.int64())],
                names=["lang", "bucket", "n"])

    counts = (rows.mapInArrow(count, "lang string, bucket long, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    table = np.zeros((1 << bits, len(languages)), np.float64)
    got = counts.toPandas()
    if len(got):
        column = {lang: i for i, lang in enumerate(languages)}
        table[got["bucket"].to_numpy(), got["lang"].map(column).to_numpy()] = got["n"].to_numpy()
    log_prob = np.log(table + alpha) - np.log(table.sum(axis=0, keepdims=True) + alpha * (1 << bits))
    total = sum(priors.values())
    return LangModel(languages, np.log([priors[x] / total for x in languages]) if total else np.zeros(0),
                     log_prob.astype(np.float32), tuple(orders))


def with_limits(df: DataFrame, model: LangModel, text_col: str = "text", lang_col: str = "lang") -> LangModel:
    """The model with the limits of its languages, from all rows of ``df`` with text and language."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    rows = df.select(F.col(text_col).cast("string").alias("text"),
                     F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        column = {lang: i for i, lang in enumerate(shared.value.languages)}
        for batch in parts_of(batches):
            sums, n, any_letter = _sums(batch.column(0).to_pylist(), shared.value)
            own = np.array([column.get(x, -1) for x in batch.column(1).to_pylist()], np.int64)
            at = np.flatnonzero(any_letter & (own >= 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[at]), pa.array(np.rint(sums[at, own[at]] / n[at] * _FINE).astype(np.int64))], names=["lang", "step"])

    got = rows.mapInArrow(place, "lang long, step long").groupBy("lang", "step").agg(F.count(F.lit(1)).alias("n")).toPandas()
    lowest = np.full(len(model.languages), -np.inf)
    for lang, mine in got.sort_values("step").groupby("lang"):
        upto = mine["n"].cumsum().to_numpy()
        low, middle = (mine["step"].to_numpy()[np.searchsorted(upto, q * upto[-1])] / _FINE for q in (0.25, 0.5))
        lowest[lang] = middle - SPREADS * max(middle - low, LEAST_SPREAD)
    log_prob = model.log_prob.astype(np.float64)
    weight = np.exp(log_prob)
    mean = (weight * log_prob).sum(axis=0)
    return replace(model, lowest=lowest, deviation=np.sqrt(np.maximum((weight * log_prob ** 2).sum(axis=0) - mean ** 2, 0)))


def _within(codes: np.ndarray, offsets: np.ndarray, order: int, bits: int) -> np.ndarray:
    """Buckets of the n-grams that do not cross from one text into the next."""
    all_ = _buckets(codes, order, bits)
    crosses = np.zeros(len(codes) + 1, bool)
    for back in range(1, order):
        crosses[np.maximum(offsets[1:] - back, 0)] = True
    return all_[~crosses[:len(all_)]]


def _sums(texts: list[str | None], model: LangModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-likelihood of each text in each language, its number of n-grams, and whether it has any letter."""
    n_lang, bits = len(model.languages), int(math.log2(max(1, model.log_prob.shape[0])))
    owner, pieces = [], []
    for i, t in enumerate(texts):
        for k in range(0, len(t or ""), PIECE):
            owner.append(i)
            pieces.append(t[k:k + PIECE])
    sums, n_grams = np.zeros((len(texts), n_lang)), np.zeros(len(texts), np.int64)
    any_letter = np.zeros(len(texts), bool)
    for first, group in text_groups(pieces):
        codes, offsets, has = _letters(group)
        docs = np.asarray(owner[first:first + len(group)])
        np.logical_or.at(any_letter, docs, has)
        for order in model.orders:
            buckets = _buckets(codes, order, bits)
            begin, end = offsets[:-1], np.maximum(offsets[1:] - order + 1, offsets[:-1])
            full = end > begin
            if not full.any():
                continue
            np.add.at(n_grams, docs, end - begin)
            cuts = np.column_stack((begin[full], end[full])).ravel()
            for lang in range(n_lang):
                value = np.append(model.log_prob[:, lang][buckets], np.float32(0)).astype(np.float64)
                np.add.at(sums[:, lang], docs[full], np.add.reduceat(value, np.minimum(cuts, len(buckets)))[::2])
    return sums, n_grams, any_letter


def score(texts: list[str | None], model: LangModel) -> tuple[list[str], np.ndarray]:
    """Predicted language and its posterior probability for each text."""
    return judge(texts, model)[:2]


def judge(texts: list[str | None], model: LangModel) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Predicted language, its posterior probability, and whether the text is as likely in it as its texts are
    (always, for a model without limits; never, without a prediction)."""
    sums, n, any_letter = _sums(texts, model)
    if not model.languages:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
    joint = sums + model.log_prior
    best = joint.argmax(axis=1)
    posterior = 1.0 / np.exp(joint - joint.max(axis=1, keepdims=True)).sum(axis=1)
    known = any_letter.copy()
    if model.lowest is not None:
        n = np.maximum(n, 1)
        # n-grams of all orders overlap: a text has about as many independent ones as letters
        room = ERRORS * model.deviation[best] * np.sqrt(len(model.orders) / n)
        known &= sums[np.arange(len(texts)), best] / n >= model.lowest[best] - room
    return ([model.languages[b] if ok else UNDETERMINED for b, ok in zip(best, any_letter, strict=True)],
            np.where(any_letter, posterior, 0.0), known)


def predict(df: DataFrame, model: LangModel, text_col: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score`` (0 to 1), and ``known_lang`` for a model with limits."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double,known_lang:boolean>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            langs, scores, known = [], [np.zeros(0)], [np.zeros(0, bool)]
            for part in slices(batch):
                found = judge(part.to_pylist(), shared.value)
                langs += found[0]
                scores.append(found[1])
                known.append(found[2])
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(np.concatenate(scores)), pa.array(np.concatenate(known))],
                                             names=["lang_pred", "score", "known_lang"])

    names = ["lang_pred", "score"] + ["known_lang"] * (model.lowest is not None)
    got = df.withColumn("__lang", run(F.col(text_col).cast("string")))
    return got.withColumns({x: F.col(f"__lang.{x}") for x in names}).drop("__lang")


def fold(id_col: str = "doc_id") -> Column:
    """The document's fold: crc32 of its id as text, modulo 4; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


def rejects(min_score: float = 0.5) -> Column:
    """Whether a document predicted with limits is in no known language: no letters, no language likelier than
    all others together, or a text too unlikely for the likeliest language."""
    return (F.col("lang_pred") == UNDETERMINED) | (F.col("score") < min_score) | ~F.col("known_lang")
