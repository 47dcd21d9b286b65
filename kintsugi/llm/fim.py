"""Fill-in-middle: cut a text in three and put the middle last.

A text is a row of units (code points, words with the blanks behind them, or
lines).  Its UTF-8 form is divided into blocks of fixed size; two Fenwick trees
over the blocks hold how many units and how many code points begin in each.  A
cut after k units descends the unit tree by binary lifting to the block where
unit k begins, taking along the code points before it, and finds the byte inside
that block.  Every text of a slice of an Arrow batch descends at the same time.

The cuts, the order of the pieces and whether a text is transformed at all come
from a digest of the seed and the row's id, so they do not depend on the layout.

Defined results: a null text counts as empty; an empty text is plain, and so is
one that contains a marker.  A null id counts as empty text in the digest.
Repeated ids are cut at the same places of equal texts.  Texts of any length are
handled whole, one alone at a time where it exceeds a slice.  A text of fewer
units than there are pieces has empty pieces.  Input columns that carry an
output's name are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kintsugi.llm.common import slices, text_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 texts, how many are transformed, and how many of these have their suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20
#: Bytes of a block.
BLOCK = 256

_FIELDS = {"n_units": pa.int64(), "n_chars": pa.int64(), "prefix_chars": pa.int64(), "middle_chars": pa.int64(), "output": pa.string()}
_STRUCT = pa.struct(list(_FIELDS.items()))
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True


def _raw(batch: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each row's begin (and the end)."""
    wide = batch.cast(pa.large_binary())
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset:wide.offset + len(wide) + 1]
    data = wide.buffers()[2]
    codes = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return codes, offsets - offsets[0]


def char_starts(codes: np.ndarray) -> np.ndarray:
    """Whether a code point begins at each byte of UTF-8."""
    return codes & 0xC0 != 0x80


def unit_starts(codes: np.ndarray, offsets: np.ndarray, unit: str) -> np.ndarray:
    """Whether a unit begins at each byte."""
    if unit == "char":
        return char_starts(codes)
    before = np.empty_like(codes)
    before[:1], before[1:] = 0, codes[:-1]
    if unit == "word":
        found = ~_BLANK[codes] & _BLANK[before]
    elif unit == "line":
        found = before == 10
    else:
        raise ValueError(f"unknown unit {unit!r}: char, word or line")
    found[offsets[:-1][np.diff(offsets) > 0]] = True
    return found


class BlockTrees:
    """Fenwick trees over the blocks of several texts, one after another in flat arrays."""

    def __init__(self, codes: np.ndarray, offsets: np.ndarray, unit: str, block: int = BLOCK):
        self.offsets, self.block = offsets, block
        self.units, self.chars = unit_starts(codes, offsets, unit), char_starts(codes)
        size = np.diff(offsets)
        self.n_blocks = -(-size // block)
        self.first = np.concatenate(([0], np.cumsum(self.n_blocks)))
        number = np.arange(self.first[-1]) - np.repeat(self.first[:-1], self.n_blocks)
        begin = np.repeat(offsets[:-1], self.n_blocks) + number * block
        node = number + 1
        self.unit_tree = self._tree(self.units, begin, node)
        self.char_tree = self._tree(self.chars, begin, node)
        self.n_units = self._total(self.units)
        self.n_chars = self._total(self.chars)

    def _tree(self, marks: np.ndarray, begin: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Node i of a tree covers the last lowbit(i) blocks up to block i."""
        if not len(begin):
            return np.zeros(0, np.int64)
        upto = np.concatenate(([0], np.cumsum(np.add.reduceat(marks, begin, dtype=np.int64))))
        at = np.arange(len(node))
        return upto[at + 1] - upto[at + 1 - (node & -node)]

    def _total(self, marks: np.ndarray) -> np.ndarray:
        upto = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
        return upto[self.offsets[1:]] - upto[self.offsets[:-1]]

    def cut(self, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per text, the byte (in the flat array) and the number of code points after so many units."""
        left = after.astype(np.int64)
        passed = np.zeros(len(left), np.int64)
        chars = np.zeros(len(left), np.int64)
        step = 1 << int(self.n_blocks.max(initial=0)).bit_length()
        while step := step >> 1:
            to = passed + step
            inside = np.flatnonzero(to <= self.n_blocks)
            node = self.first[inside] + to[inside] - 1
            go = self.unit_tree[node] <= left[inside]
            moved, node = inside[go], node[go]
            left[moved] -= self.unit_tree[node]
            chars[moved] += self.char_tree[node]
            passed[moved] += step
        # the text's end, unless a block is left: then the place is the one where its unit number `left` begins
        place = self.offsets[1:].copy()
        here = np.flatnonzero(passed < self.n_blocks)
        if len(here):
            begin = self.offsets[here] + passed[here] * self.block
            span = begin[:, None] + np.arange(self.block)
            valid = span < self.offsets[here + 1][:, None]
            span = np.minimum(span, len(self.units) - 1)
            nth = np.cumsum(self.units[span] & valid, axis=1, dtype=np.int32)
            at = (nth > left[here][:, None]).argmax(axis=1)
            before = np.cumsum(self.chars[span], axis=1, dtype=np.int32) - self.chars[span]
            chars[here] += before[np.arange(len(here)), at]
            place[here] = begin + at
        return place, chars


def _forms(batch: pa.Array, low: pa.Array, high: pa.Array, form: pa.Array, unit: str) -> pa.StructArray:
    codes, offsets = _raw(batch)
    trees = BlockTrees(codes, offsets, unit)
    picks = [x.to_numpy(zero_copy_only=False).astype(np.int64) % (trees.n_units + 1) for x in (low, high)]
    first, first_chars = trees.cut(np.minimum(*picks))
    second, second_chars = trees.cut(np.maximum(*picks))
    data = memoryview(codes)
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    out = []
    rows = zip(form.to_pylist(), offsets[:-1].tolist(), first.tolist(), second.tolist(), offsets[1:].tolist(), strict=True)
    for kind, a, b, c, d in rows:
        if kind == "psm":
            out.append(b"".join((p, data[a:b], s, data[c:d], m, data[b:c])))
        elif kind == "spm":
            out.append(b"".join((s, data[c:d], p, data[a:b], m, data[b:c])))
        else:
            out.append(bytes(data[a:d]))
    plain = np.array([x == "plain" for x in form.to_pylist()], bool)
    return pa.StructArray.from_arrays(
        [pa.array(trees.n_units), pa.array(trees.n_chars), pa.array(first_chars, mask=plain),
         pa.array(second_chars - first_chars, mask=plain), pa.array(out, pa.binary()).view(pa.string())],
        names=list(_FIELDS))


def transform(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "char", seed: str = "1",
              transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """``df`` with ``form`` (plain, psm or spm), ``output``, ``n_units``, ``n_chars``, and the code points of
    prefix and middle (null where plain)."""
    if unit not in ("char", "word", "line"):
        raise ValueError(f"unknown unit {unit!r}: char, word or line")
    text = text_of(text_col)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    h1, h2, h3, h4 = (F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4))
    keep = (text == "") | F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE)) \
        | (h3 % 100 >= transformed)
    form = F.when(keep, "plain").when(h4 % 100 < suffix_first, "spm").otherwise("psm")

    @F.arrow_udf("struct<n_units:long,n_chars:long,prefix_chars:long,middle_chars:long,output:string>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, *rest in batches:
            done, parts = 0, []
            for part in slices(texts):
                parts.append(_forms(part, *(x.slice(done, len(part)) for x in rest), unit))
                done += len(part)
            yield pa.concat_arrays(parts) if parts else pa.array([], _STRUCT)

    got = df.withColumn("__form", form)
    got = got.withColumn("__fim", run(text, h1, h2, F.col("__form")))
    return got.withColumns({x: F.col(f"__fim.{x}") for x in _FIELDS} | {"form": F.col("__form")}).drop("__fim", "__form")


def restored(output: Column | str = "output", form: Column | str = "form") -> Column:
    """The text that was transformed.  No piece contains a marker and no marker overlaps another, so the first
    of each is the one that was put there."""
    output, form = (F.col(x) if isinstance(x, str) else x for x in (output, form))

    def between(begin: str, end: str | None) -> Column:
        start = F.instr(output, begin) + len(begin)
        size = F.instr(output, end) - start if end else F.length(output)
        return F.substr(output, start, size)

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def transform_sql(table: str = "documents") -> str:
    """The digests of ``op12_fim`` as DuckDB SQL."""
    marks = " OR ".join(f"contains(text, '{x}')" for x in (PREFIX, SUFFIX, MIDDLE))
    return f"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
                      sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM {table}),
    u AS (SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS c2,
                 CAST('0x' || h[17:24] AS BIGINT) % 100 AS r3, CAST('0x' || h[25:32] AS BIGINT) % 100 AS r4 FROM t),
    c AS (SELECT doc_id, n, text, least(c1, c2) AS a, greatest(c1, c2) AS b,
                 CASE WHEN text = '' OR {marks} OR r3 >= {TRANSFORMED} THEN 'plain'
                      WHEN r4 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form FROM u),
    p AS (SELECT *, substring(text, 1, a) AS pre, substring(text, a + 1, b - a) AS mid, substring(text, b + 1) AS suf FROM c)
    SELECT doc_id, CAST(n AS BIGINT) AS n, form,
           CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
           sha256(CASE form WHEN 'psm' THEN '{PREFIX}' || pre || '{SUFFIX}' || suf || '{MIDDLE}' || mid
                            WHEN 'spm' THEN '{SUFFIX}' || suf || '{PREFIX}' || pre || '{MIDDLE}' || mid ELSE text END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM p"""
