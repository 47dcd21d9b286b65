"""Byte-level BPE: a transducer lexicon for frequent words, exact merges for the rest.

``frequent_words`` counts the letter words of the whole corpus in Spark and keeps
the most frequent ones (a bounded number, by parameter).  The driver merges
those exactly and compiles them with their ids into a minimal acyclic
transducer, which tasks memory-map.  Encoding cuts a text into pieces as the
tokenizer's pattern does, with numpy over Unicode classes; distinct pieces go
through the transducer, all that it does not hold is merged exactly.  Results
do not depend on the lexicon.

Defined results: a null text counts as empty and has no ids; the special token's
string in a text becomes its id; a null list of ids decodes to the empty text,
null or unknown ids are an error.  Texts of any length are encoded whole.
Repeated rows get equal results.  Input columns that carry an output's name are
replaced.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kintsugi.llm.common import code_points, mixed, slices, stored, text_groups, text_of
from kintsugi.llm.transducer import Transducer, compile_transducer

#: Distinct pieces whose ids a Python worker keeps at hand.
MEMO = 150_000
_LETTER, _NUMBER, _SPACE, _OTHER = 1, 2, 3, 4

#: Letters and numbers of Unicode 16 that older Unicode tables lack, first to last.
LETTERS_16 = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
    (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
    (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5F0))
NUMBERS_16 = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))
#: White space besides the categories Zs, Zl and Zp.
WHITE = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x85)
#: What may follow an apostrophe as a piece of its own.
SHORT_ENDS = ("s", "t", "re", "ve", "m", "ll", "d")


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    table = np.full(0x110000, _OTHER, np.uint8)
    of = {"L": _LETTER, "N": _NUMBER, "Z": _SPACE}
    for i in range(0x110000):
        kind = of.get(unicodedata.category(chr(i))[0])
        if kind:
            table[i] = kind
    for ranges, kind in ((LETTERS_16, _LETTER), (NUMBERS_16, _NUMBER)):
        for a, b in ranges:
            table[a:b + 1] = kind
    table[list(WHITE)] = _SPACE
    return table


@lru_cache(maxsize=1)
def _byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@dataclass
class Vocabulary:
    """What a byte-level BPE file holds: the bytes of each id and the merges."""
    pieces: dict[int, bytes]
    single: list[int]
    merges: dict[int, int]  # left id << 32 | right id -> rank
    merged: list[int]  # rank -> id
    special: dict[str, int]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        to_byte = _byte_characters()
        ids = {bytes(to_byte[c] for c in token): i for token, i in data["model"]["vocab"].items()}
        special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        pieces = {i: b for b, i in ids.items()} | {i: s.encode() for s, i in special.items()}
        merges, merged = {}, []
        for rank, pair in enumerate(data["model"]["merges"]):
            a, b = (bytes(to_byte[c] for c in t) for t in (pair.split(" ") if isinstance(pair, str) else pair))
            merges[ids[a] << 32 | ids[b]] = rank
            merged.append(ids[a + b])
        return cls(pieces, [ids[bytes([b])] for b in range(256)], merges, merged, special)

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece: the pair of lowest rank first, leftmost first."""
        if len(piece) > 200:
            return self._merge_long(piece)
        parts = [self.single[b] for b in piece]
        get, none = self.merges.get, len(self.merged)
        ranks = [get(a << 32 | b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            parts[i:i + 2] = [self.merged[best]]
            del ranks[i]
            if i:
                ranks[i - 1] = get(parts[i - 1] << 32 | parts[i], none)
            if i < len(ranks):
                ranks[i] = get(parts[i] << 32 | parts[i + 1], none)
        return parts

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap over a linked list, for pieces of any length."""
        parts = [self.single[b] for b in piece]
        n = len(parts)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []

        def offer(i: int) -> None:
            j = right[i]
            if j < n and (rank := self.merges.get(parts[i] << 32 | parts[j])) is not None:
                heapq.heappush(heap, (rank, i, parts[i], parts[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = right[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j], right[i] = self.merged[rank], -1, right[j]
            if right[j] < n:
                left[right[j]] = i
            if left[i] >= 0:
                offer(left[i])
            offer(i)
        return [p for p in parts if p >= 0]


class Merger:
    """The exact merges of many short pieces at a time: a matrix of ids, one piece a row.  Each round takes every row's
    pair of lowest rank (the leftmost of equal ones), as ``Vocabulary.merge`` does for one piece."""

    #: Longest piece in bytes; longer ones are merged one by one.
    WIDEST = 32

    def __init__(self, vocabulary: Vocabulary):
        self.single = np.array(vocabulary.single, np.int64)
        self.merged = np.array(vocabulary.merged, np.int64)
        self.none = len(self.merged)
        keys = np.fromiter(vocabulary.merges.keys(), np.int64, len(vocabulary.merges))
        ranks = np.fromiter(vocabulary.merges.values(), np.int64, len(vocabulary.merges))
        # an open table of pairs: a pair stands in the first free slot from its own on
        self.mask = (1 << (4 * len(keys) + 8).bit_length()) - 1
        self.keys, self.ranks = np.full(self.mask + 1, -1, np.int64), np.zeros(self.mask + 1, np.int64)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = np.flatnonzero(self.keys[slot[todo]] < 0)
            _, first = np.unique(slot[todo[free]], return_index=True)
            put = todo[free[first]]
            self.keys[slot[put]], self.ranks[slot[put]] = keys[put], ranks[put]
            todo = np.setdiff1d(todo, put, assume_unique=True)
            slot[todo] = slot[todo] + 1 & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return mixed(keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.int64) & self.mask

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair; of one that never merges, or without a right part (-1), the number of merges."""
        out = np.full(left.shape, self.none, np.int64)
        todo = np.flatnonzero(right.ravel() >= 0)
        keys = left.ravel()[todo] << 32 | right.ravel()[todo]
        slot, flat = self._slot(keys), out.reshape(-1)
        while len(todo):
            there = self.keys[slot]
            hit = there == keys
            flat[todo[hit]] = self.ranks[slot[hit]]
            on = np.flatnonzero(~hit & (there >= 0))
            todo, keys, slot = todo[on], keys[on], slot[on] + 1 & self.mask
        return out

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece (of at most ``WIDEST`` bytes) as int32 bytes."""
        size = np.array([len(p) for p in pieces], np.int64)
        out: list[bytes] = [b""] * len(pieces)
        least = 0
        for width in (8, 16, self.WIDEST):
            which = np.flatnonzero((size > least) & (size <= width))
            for some in np.array_split(which, -(-len(which) // 8192)) if len(which) else ():
                for i, ids in zip(some.tolist(), self._rows([pieces[i] for i in some.tolist()], size[some], width), strict=True):
                    out[i] = ids
            least = width
        return out

    def _rows(self, pieces: list[bytes], size: np.ndarray, width: int) -> Iterator[bytes]:
        column = np.arange(width)
        ids = np.full((len(pieces), width + 1), -1, np.int64)
        ids[:, :width][column < size[:, None]] = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        ranks = np.full((len(pieces), width + 1), self.none, np.int64)
        ranks[:, :width] = self.rank(ids[:, :-1], ids[:, 1:])
        active = np.arange(len(pieces))
        while len(active):
            best = ranks[active].argmin(axis=1)
            rank = ranks[active, best]
            going = rank < self.none
            active, best, rank = active[going], best[going], rank[going]
            if not len(active):
                break
            row = np.arange(len(active))
            own = ids[active]
            own[row, best] = self.merged[rank]
            own[:, :-1] = np.take_along_axis(own, column + (column > best[:, None]), axis=1)
            own[:, -1] = -1
            near = ranks[active]
            near[:, :-1] = np.take_along_axis(near, column + (column >= best[:, None]), axis=1)
            near[row, best] = self.rank(own[row, best], own[row, best + 1])
            left = np.flatnonzero(best > 0)
            near[left, best[left] - 1] = self.rank(own[left, best[left] - 1], own[left, best[left]])
            ids[active], ranks[active] = own, near
        filled = ids >= 0
        data = ids[filled].astype(np.int32).tobytes()
        ends = (4 * np.cumsum(filled.sum(axis=1))).tolist()
        return (data[a:b] for a, b in zip([0, *ends], ends, strict=False))


def piece_starts(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin in the joined code points of several texts.

    Runs of letters, numbers and other signs are pieces, each with one blank
    before it; of white space before a piece the last character stands alone
    (or, as a blank, joins the piece); an apostrophe with a short ending is a
    piece where it does not follow other signs."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    kind = _classes()[codes]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    start = first[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # the last white space before something else in the same text
    last = np.flatnonzero((kind[:-1] == _SPACE) & (kind[1:] != _SPACE) & ~first[1:n])
    start[last] = True
    start[last[codes[last] == 32] + 1] = False
    quote = np.flatnonzero(codes == 0x27)
    if len(quote):
        before = np.where(first[quote], 0, kind[quote - 1])
        quote = quote[(before != _OTHER) & ~((before == _SPACE) & (codes[quote - 1] == 32) & ~first[quote])]
        padded = np.concatenate((codes, np.zeros(2, codes.dtype)))
        for end in SHORT_ENDS:
            hit = np.ones(len(quote), bool)
            for k, c in enumerate(end, 1):
                hit &= (padded[quote + k] == ord(c)) & ~first[np.minimum(quote + k, n)]
            at = quote[hit]
            start[at + 1] = False
            after = at + len(end) + 1
            start[after[after < n]] = True
    return np.flatnonzero(start)


class Encoder:
    """Encodes texts with a vocabulary and a compiled lexicon."""

    def __init__(self, vocabulary: Vocabulary, lexicon: bytes):
        self.vocabulary, self.lexicon = vocabulary, Transducer(lexicon)
        self.merger = Merger(vocabulary)
        self.memo: dict[bytes, bytes] = {}

    def _learn(self, pieces: set[bytes]) -> None:
        """Puts the ids of the pieces into the memo, which starts afresh when it is full."""
        todo = list(pieces.difference(self.memo))
        if len(self.memo) + len(todo) > MEMO:
            self.memo.clear()
            todo = list(pieces)
        rest = []
        for piece, ids in zip(todo, self.lexicon.lookup(todo), strict=True):
            if ids is not None:
                self.memo[piece] = ids.tobytes()
            elif len(piece) > Merger.WIDEST:
                self.memo[piece] = np.array(self.vocabulary.merge(piece), np.int32).tobytes()
            else:
                rest.append(piece)
        self.memo.update(zip(rest, self.merger.merge(rest), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as int32 bytes."""
        parts, owner = [], []  # texts cut at special tokens
        special = self.vocabulary.special
        for i, t in enumerate(texts):
            spans = [t]
            for token in special:
                if token in t:
                    spans = [y for x in spans for y in ([x] if x in special else _around(x, token))]
            parts += spans
            owner += [i] * len(spans)
        out: list[list[bytes]] = [[] for _ in texts]
        for first, group in text_groups(parts):
            plain = ["" if t in special else t for t in group]
            codes, offsets = code_points(plain)
            starts = piece_starts(codes, offsets)
            width = 1 + (codes >= 0x80).astype(np.int8) + (codes >= 0x800) + (codes >= 0x10000)
            at = np.concatenate(([0], np.cumsum(width)))
            data = "".join(plain).encode()
            cuts = at[np.append(starts, len(codes))].tolist()
            pieces = [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
            self._learn(set(pieces))
            memo = self.memo
            ids = [memo[p] for p in pieces]
            bounds = np.searchsorted(starts, offsets).tolist()
            for k, t in enumerate(group):
                if t in special:
                    out[owner[first + k]].append(np.int32(special[t]).tobytes())
                elif bounds[k + 1] > bounds[k]:
                    out[owner[first + k]].append(b"".join(ids[bounds[k]:bounds[k + 1]]))
        return [b"".join(x) for x in out]


def decoded(ids: list[int], pieces: dict[int, bytes]) -> str:
    """The text that ids stand for; bytes that are no UTF-8 become replacement characters."""
    return b"".join([pieces[i] for i in ids]).decode("utf-8", "replace")


def _around(text: str, token: str) -> list[str]:
    out = []
    for part in text.split(token):
        out += [part, token]
    return [x for x in out[:-1] if x]


def frequent_words(df: DataFrame, text_col: str = "text", size: int = 50_000, least: int = 16) -> list[str]:
    """At most ``size`` letter words of the whole corpus, each with the blank before it: those that
    occur at least ``least`` times, from the count on (in steps of a hundredth) at which they are few enough."""
    words = df.select(F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(r"( ?\p{L}+)"), F.lit(1))).alias("word"))
    counted = stored(words.where("length(word) <= 64").groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
                     .withColumn("step", F.floor(F.log(1.01, F.col("n").cast("double")))))
    taken, lowest = 0, None
    for r in sorted(counted.groupBy("step").count().collect(), reverse=True):
        taken += r["count"]
        if taken > size:
            break
        lowest = r["step"]
    if lowest is None:
        return []
    return sorted(r["word"] for r in counted.where(F.col("step") >= lowest).select("word").collect())


def compile_lexicon(vocabulary: Vocabulary, words: list[str]) -> bytes:
    """The frequent words with their ids as a transducer; words that are several pieces are left out."""
    entries = {}
    for word in words:
        codes, offsets = code_points([word])
        if len(piece_starts(codes, offsets)) == 1:
            entries[word.encode()] = tuple(vocabulary.merge(word.encode()))
    return compile_transducer(entries)


_OPEN: dict[str, Encoder] = {}


def _encoder(key: str, shared) -> Encoder:
    """One encoder for each vocabulary and lexicon in a Python worker."""
    if key not in _OPEN:
        _OPEN.clear()
        _OPEN[key] = Encoder(*shared.value)
    return _OPEN[key]


class Tokenizer:
    """A vocabulary file and a lexicon, ready for use on DataFrames of one session."""

    def __init__(self, spark, path: str, words: list[str] = ()):
        vocabulary = Vocabulary.load(path)
        lexicon = compile_lexicon(vocabulary, list(words))
        self.key = hashlib.sha256(lexicon + path.encode()).hexdigest()
        self.pieces = spark.sparkContext.broadcast(vocabulary.pieces)
        self.shared = spark.sparkContext.broadcast((replace(vocabulary, pieces={}), lexicon))

    def encode(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        """``df`` with ``ids``, the token ids of each text."""
        key, shared = self.key, self.shared

        @F.arrow_udf("array<int>")
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            from kintsugi.llm import bpe  # the worker's own module, which keeps encoders between tasks
            encoder = bpe._encoder(key, shared)
            for part in (x for batch in batches for x in slices(batch)):
                found = encoder.encode(part.to_pylist())
                ends = np.concatenate(([0], np.cumsum([len(x) // 4 for x in found])))
                values = pa.array(np.frombuffer(b"".join(found), np.int32))
                yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)

        return df.withColumn("ids", run(text_of(text_col)))

    def decode(self, df: DataFrame, ids_col: str = "ids") -> DataFrame:
        """``df`` with ``decoded``, the text that the ids stand for."""
        shared = self.pieces

        @F.arrow_udf("string")
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            pieces = shared.value
            for part in (x for batch in batches for x in slices(batch)):
                values, ends = part.values.to_numpy(), part.offsets.to_numpy()
                yield pa.array([decoded(values[a:b].tolist(), pieces) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.string())

        return df.withColumn("decoded", run(F.coalesce(F.col(ids_col), F.array().cast("array<int>"))))
