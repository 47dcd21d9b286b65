"""Quality rules: how much of a text lies inside repeated n-grams and lines.

Words are hashed with a polynomial over their code points; an n-gram's rolling
hash combines the hashes of its n words.  For several n, numpy finds the
n-grams of a document that occurred in it before and measures the share of the
word characters they cover; repeated lines are measured alike.

Defined results: a null text counts as empty; an empty text has no words and
fails the base rule.  Texts of any length are handled whole (a text longer
than the grouping size is handled on its own).  Hashes have 64 bits; two
different n-grams of one document are taken as equal with a chance below
n^2 / 2^64.  Repeated rows get equal results.  Input columns that carry an
output's name are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kintsugi.llm.common import code_points, mixed, slices, text_groups, text_of, word_hashes

#: Largest share of word characters inside n-grams seen before in the text.
NGRAM_SHARES = {5: 0.15, 7: 0.13, 10: 0.10}
#: Largest share of characters in lines seen before in the text.
LINE_SHARE = 0.20

_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_DOC = np.uint64(0x9E3779B97F4A7C15)

COLUMNS = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long",
           "n_repeat_words": "long", "base_failed": "boolean", "kept": "boolean",
           "dup_line_share": "double"} | {f"dup_{n}gram_share": "double" for n in NGRAM_SHARES}

_SYMBOLS = np.zeros(129, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def _seen(keys: np.ndarray, first_too: bool) -> np.ndarray:
    """Whether an equal key stands earlier (or, with ``first_too``, anywhere else)."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), bool)
    out[order[1:]] = same
    if first_too:
        out[order[:-1]] |= same
    return out


def _covered(hits: np.ndarray, n: int, n_words: int) -> np.ndarray:
    """Words inside the marked n-word windows."""
    edge = np.zeros(n_words + 1, np.int32)
    at = np.flatnonzero(hits)
    np.add.at(edge, at, 1)
    np.subtract.at(edge, at + n, 1)
    return np.cumsum(edge[:-1]) > 0


def measure(texts: list[str]) -> dict[str, np.ndarray]:
    """The columns of ``COLUMNS`` for each text."""
    codes, offsets = code_points(texts)
    n_docs = len(texts)
    symbols = np.concatenate(([0], np.cumsum(_SYMBOLS[np.minimum(codes, 128)])))
    words, length, first_word = word_hashes(codes, offsets)
    doc = np.repeat(np.arange(n_docs), np.diff(first_word))
    n_words = np.diff(first_word)
    upto = np.concatenate(([0], np.cumsum(length)))
    word_chars = upto[first_word[1:]] - upto[first_word[:-1]]

    def windows(n: int, first_too: bool) -> np.ndarray:
        """Words covered by n-word windows that occur again in the same text."""
        m = max(0, len(words) - n + 1)
        h = np.zeros(m, np.uint64)
        for k in range(n):
            h = h * _STEP + words[k:k + m]
        whole = doc[:m] == doc[n - 1:n - 1 + m]
        at = np.flatnonzero(whole)
        hits = np.zeros(m, bool)
        hits[at] = _seen(mixed(h[at] + doc[at].astype(np.uint64) * _DOC), first_too)
        return _covered(hits, n, len(words))

    def per_doc(marked: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(marked if weight is None else marked * weight)))
        return total[first_word[1:]] - total[first_word[:-1]]

    repeat_words = per_doc(windows(3, True))
    dup_lines = np.zeros(n_docs, np.int64)
    dup_line_chars = np.zeros(n_docs, np.int64)
    line_chars = np.zeros(n_docs, np.int64)
    for i, t in enumerate(texts):
        seen: set[str] = set()
        for line in t.split("\n"):
            line_chars[i] += len(line)
            if line in seen:
                dup_lines[i] += 1
                dup_line_chars[i] += len(line)
            elif line.strip(" \t\n\v\f\r"):
                seen.add(line)
    out = {"n_words": n_words, "word_chars": word_chars,
           "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
           "n_dup_lines": dup_lines, "n_repeat_words": repeat_words}
    out["base_failed"] = (n_words < 50) | (100 * repeat_words > 50 * n_words)
    out["dup_line_share"] = dup_line_chars / np.maximum(line_chars, 1)
    bad = out["dup_line_share"] > LINE_SHARE
    for n, most in NGRAM_SHARES.items():
        share = per_doc(windows(n, False), length) / np.maximum(word_chars, 1)
        out[f"dup_{n}gram_share"] = share
        bad |= share > most
    out["kept"] = ~(out["base_failed"] | bad)
    return out


def rate(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the measured columns and the verdict ``kept``."""
    fields = list(COLUMNS)
    kinds = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}

    @F.arrow_udf("struct<" + ",".join(f"{k}:{v}" for k, v in COLUMNS.items()) + ">")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [measure(group) for part in slices(batch) for _, group in text_groups(part.to_pylist())]
            yield pa.StructArray.from_arrays(
                [pa.array(np.concatenate([p[f] for p in parts]) if parts else [], kinds[COLUMNS[f]]) for f in fields],
                names=fields)

    got = df.withColumn("__quality", run(text_of(text_col)))
    return got.withColumns({f: F.col(f"__quality.{f}") for f in fields}).drop("__quality")


def rate_sql(table: str = "documents") -> str:
    """doc_id, the base columns and the verdict as DuckDB SQL."""
    grams, covers, shares = [], [], []
    for n, most in NGRAM_SHARES.items():
        grams.append(f"g{n} AS (SELECT doc_id, p, row_number() OVER (PARTITION BY doc_id, g ORDER BY p) AS nth FROM ("
                     f"SELECT doc_id, p, list(w) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING) AS g FROM w)"
                     f" WHERE len(g) = {n})")
        covers.append(f"c{n} AS (SELECT doc_id, sum(length(w)) AS chars FROM w JOIN (SELECT DISTINCT doc_id, p + unnest(range({n})) AS p"
                      f" FROM g{n} WHERE nth > 1) USING (doc_id, p) GROUP BY doc_id)")
        shares.append(f"coalesce(c{n}.chars, 0) / greatest(word_chars, 1) <= {most}")
    words = r"[^\x20\x09-\x0D]+"
    return rf"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM {table}),
    l AS (SELECT doc_id, regexp_extract_all(text, '{words}') AS ws, text FROM t),
    w AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS p FROM l),
    b AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
                 CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols FROM l),
    g3 AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS n FROM (
           SELECT doc_id, p, list(w) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS g FROM w) WHERE len(g) = 3),
    r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, p + unnest(range(3)) AS p FROM g3 WHERE n > 1) GROUP BY doc_id),
    {", ".join(grams + covers)},
    s AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY no) AS nth FROM (
          SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS no FROM t)),
    d AS (SELECT doc_id, count_if(nth > 1 AND regexp_matches(line, '{words}')) AS n, sum(length(line)) AS chars,
                 coalesce(sum(length(line)) FILTER (nth > 1 AND regexp_matches(line, '{words}')), 0) AS again FROM s GROUP BY doc_id),
    f AS (SELECT b.*, CAST(coalesce(d.n, 0) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
                 n_words < 50 OR 100 * coalesce(r.n, 0) > 50 * n_words AS base_failed, d.again / greatest(d.chars, 1) AS line_share
          FROM b LEFT JOIN r USING (doc_id) LEFT JOIN d USING (doc_id))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND line_share <= {LINE_SHARE} AND {" AND ".join(shares)} AS kept
    FROM f {" ".join(f"LEFT JOIN c{n} USING (doc_id)" for n in NGRAM_SHARES)}"""
