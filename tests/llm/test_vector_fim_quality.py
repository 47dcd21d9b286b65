"""Vector codes, fill-in-middle and neighbour votes against brute force and defined edge cases."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kintsugi.llm import fim, knnquality, vectorcodes
from tests.conftest import SF_SMALL

NAN, INF = float("nan"), float("inf")


# --- vector codes -------------------------------------------------------------------------------------------------

def plain_codes(rows, parts, entries, rounds, scale):
    """(row, code, error) of the kept rows, and the codebooks, point by point in Python integers."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    width = -(-max((len(r[1]) for r in kept), default=0) // parts)
    vectors = [[int(np.floor(x * scale)) for x in r[1]] + [0] * (width * parts - len(r[1])) for r in kept]
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for v in vectors]
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:entries]
    books = [[cut[i][p] for i in first] for p in range(parts)]

    def nearest(p, point):
        return min((sum((a - b) ** 2 for a, b in zip(point, e, strict=True)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(p, c[p])[1], []).append(c[p])
            books[p] = [[sum(x) // len(groups[i]) for x in zip(*groups[i], strict=True)] if i in groups else e for i, e in enumerate(books[p])]
    out = []
    for r, c in zip(kept, cut, strict=True):
        found = [nearest(p, c[p]) for p in range(parts)]
        out.append((r[0], r[2], bytes(i for _, i in found), sum(d for d, _ in found)))
    return out, ",".join(str(x) for b in books for e in b for x in e)


def vectors(n, dims, seed, spread=0.2):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(np.float32(x)) for x in rng.normal(0, spread, dims)], f"l{i % 3}") for i in rng.permutation(n)]


@pytest.mark.parametrize(("rows", "parts", "entries", "block"), [
    (vectors(700, 12, 1), 4, 16, 8),
    (vectors(90, 20, 2, 3.0), 2, 64, 32),
    # repeated ids and rows, nulls, not a number, infinite, short, empty and constant vectors
    ([*vectors(40, 5, 3), *vectors(40, 5, 3), (None, [0.1] * 5, None), (7, None, "x"), (8, [0.1, None], "x"), (9, [NAN, 1.0], "x"),
      (10, [INF], "x"), (11, [], None), (12, [0.5, 0.25], "x"), *((i, [0.0] * 5, "c") for i in range(20))], 3, 8, 4),
])
def test_codes_equal_plain_rounds(spark, rows, parts, entries, block):
    df = spark.createDataFrame(rows, "id long, v array<double>, label string") \
        .withColumns({"code": F.lit("?"), "error": F.lit(-1), "n": F.lit(5), "rest": F.lit(6)})
    coded, books = vectorcodes.compress(df, "id", "v", parts=parts, entries=entries, block=block)
    assert set(coded.columns) == {"id", "label", "n", "rest", "code", "error"}
    got = sorted(((r.id, r.label, bytes(r.code), r.error) for r in coded.collect()), key=str)
    expected, listed = plain_codes(rows, parts, entries, vectorcodes.ROUNDS, vectorcodes.SCALE)
    assert got == sorted(expected, key=str)
    assert books.listed() == listed


def test_codes_of_an_empty_table_and_of_too_large_numbers(spark):
    df = spark.createDataFrame([(1, [NAN]), (2, None)], "vec_id long, embedding array<double>")
    coded, books = vectorcodes.compress(df)
    assert coded.count() == 0 and coded.columns == ["vec_id", "code", "error"] and books.listed() == ""
    with pytest.raises(ValueError, match="64 bits"):
        vectorcodes.compress(spark.createDataFrame([(1, [1e300])], "vec_id long, embedding array<double>"))


def test_shortlists_keep_every_nearest_entry_and_drop_most():
    rng = np.random.default_rng(4)
    points = np.floor(rng.normal(0, 40, (6000, 2))).astype(np.int64)
    entries = np.concatenate((points[:40], points[:5]))
    blocks = vectorcodes.Blocks.build(points, 16)
    lists = vectorcodes.shortlists(blocks.low, blocks.high, entries)
    distance = ((blocks.points[:, None] - entries) ** 2).sum(-1)
    tied = distance == distance.min(axis=1, keepdims=True)
    assert (lists[np.arange(len(points)) // 16] | ~tied).all()
    assert lists.sum(axis=1).mean() < 8 and (lists.sum(axis=1) == 1).any()
    assert (blocks.total == np.add.reduceat(blocks.points, np.arange(0, 6000, 16))).all()


def test_curve_visits_every_cell_of_a_grid_by_single_steps():
    for width, side in ((2, 16), (3, 8), (5, 4)):
        grid = np.stack(np.meshgrid(*[np.arange(side)] * width, indexing="ij"), -1).reshape(-1, width)
        place = vectorcodes.hilbert(grid)
        assert len(np.unique(place)) == len(grid)
        assert (np.abs(np.diff(grid[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


# --- fill in the middle -------------------------------------------------------------------------------------------

PARTS = ["a", "é", "日", "😀", " ", "\n", "\t", "word ", "<P", "<S>", "x" * 300, "日本語" * 90, "\x85", "　"]


def plain_units(text, unit):
    if unit == "char":
        return list(text)
    out = []
    for i, c in enumerate(text):
        before = text[i - 1] if i else None
        begins = i == 0 or (before in " \t\n\v\f\r" and c not in " \t\n\v\f\r" if unit == "word" else before == "\n")
        if begins:
            out.append("")
        out[-1] += c
    return out


@pytest.mark.parametrize("unit", ["char", "word", "line"])
def test_cuts_equal_a_plain_count(unit):
    rng = random.Random(6)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 60))) for _ in range(300)] + ["", "x" * 256, "é" * 128, "日" * 5000, " "]
    batch = pa.array(["skipped", *texts]).slice(1)
    codes, offsets = fim._raw(batch)
    for block in (3, 256):
        trees = fim.BlockTrees(codes, offsets, unit, block)
        units = [plain_units(t, unit) for t in texts]
        assert trees.n_units.tolist() == [len(u) for u in units]
        for share in (0, 0.3, 0.77, 1):
            after = np.array([int(share * len(u)) for u in units])
            place, chars = trees.cut(after)
            heads = ["".join(u[:k]) for u, k in zip(units, after, strict=True)]
            assert (place - offsets[:-1]).tolist() == [len(h.encode()) for h in heads]
            assert chars.tolist() == [len(h) for h in heads]


def plain_form(doc_id, text):
    """Form and output by slicing the text."""
    text, n = text or "", len(text or "")
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_forms_and_round_trip_on_odd_rows(spark):
    rng = random.Random(8)
    rows = [(i, "".join(rng.choices(PARTS, k=rng.randint(0, 30)))) for i in range(300)]
    rows += [(None, "no id"), (1, None), (2, ""), (3, "twice"), (3, "twice"), (4, "very long; 日" * 300_000), (5, "has <M> in it")]
    df = spark.createDataFrame(rows, "doc_id long, text string") \
        .withColumns({c: F.lit(9) for c in ("form", "output", "n_units", "n_chars", "prefix_chars")})
    got = fim.transform(df).withColumn("back", fim.restored())
    assert set(got.columns) == {*df.columns, "middle_chars", "back"}
    found = got.collect()
    expected = [(i, t, *plain_form(i, t)) for i, t in rows]
    assert sorted(((r.doc_id, r.text, r.n_chars, r.form, r.prefix_chars, r.middle_chars, r.output) for r in found), key=str) == sorted(expected, key=str)
    assert all(r.back == (r.text or "") for r in found)
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    assert fim.transform(df.limit(0)).count() == 0


def test_forms_by_words_and_lines_restore(spark):
    rows = [(i, "one two\n  three\nfour　x" * (i % 5 + 1)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for unit in ("word", "line"):
        found = fim.transform(df, unit=unit, transformed=100, suffix_first=50).withColumn("back", fim.restored()).collect()
        assert all(r.back == r.text and r.form != "plain" for r in found)
        blanks = " \t\n" if unit == "word" else "\n"
        cuts = [r.prefix_chars for r in found] + [r.prefix_chars + r.middle_chars for r in found]
        assert all(k in (0, r.n_chars) or r.text[k - 1] in blanks for k, r in zip(cuts, found * 2, strict=True))
    with pytest.raises(ValueError, match="unknown unit"):
        fim.transform(df, unit="token")


# --- neighbour votes ----------------------------------------------------------------------------------------------

def test_counts_equal_plain_ngrams():
    texts = ["", "ab", "Hey hey hey", "日本 日本 x", "A.\nA.\nb 12 12"]
    got = knnquality.counts(texts, (1, 2), (), 18)
    for i, t in enumerate(texts):
        marked = [0x110000, *map(ord, t), 0x110000]
        plain = [tuple(marked[k:k + n]) for n in (1, 2) for k in range(len(marked) - n + 1)]
        found = got[i][got[i] > 0]
        assert sorted(found.tolist()) == sorted(float(plain.count(g)) for g in set(plain))
    # pieces: every n-gram of a text over the piece size is counted once
    long = "".join(random.Random(1).choices("abc de", k=2 * knnquality.PIECE + 77))
    assert knnquality.counts([long], (3,), (2,), 8).sum() == 2 * len(long) + 1


def test_repeated_words_show_in_the_shape():
    codes, offsets = knnquality.code_points(["go go Go go", "go", "", "go ab"])
    signs = knnquality._signs(codes, offsets)
    assert np.flatnonzero(signs == knnquality._AGAIN).tolist() == [3]
    assert [chr(x) for x in signs[:3]] == ["a", "a", " "]


def test_scores_equal_a_plain_vote():
    rng = random.Random(9)
    good = [" ".join(rng.choices(["the", "cat", "sat", "on", "mats", "today"], k=rng.randint(3, 40))) + "." for _ in range(60)]
    bad = [" ".join(rng.choices(["BUY!!", "$$$", "WIN!!", "NOW##"], k=rng.randint(3, 40))) for _ in range(30)]
    labels = np.array([1] * 60 + [0] * 30)
    model = knnquality.fit(knnquality.counts(good + bad), labels, {1: 600, 0: 30}, dims=8, k=7)
    texts = [*good[:5], *bad[:5], "the cat WIN!! $$$", "", "zzz", good[0]]
    got = knnquality.scores(texts, model)
    table = np.log1p(knnquality.counts(texts)) * model.idf
    half = table.shape[1] // 2
    for i in range(len(texts)):
        pair = [x / max(np.linalg.norm(x), 1e-30) for x in (table[i, :half], table[i, half:])]
        v = np.concatenate(pair) @ model.space
        cosine = [round(float(v @ u) / max(float(np.linalg.norm(v)), 1e-30), knnquality.DIGITS) for u in model.vectors]
        least = sorted(cosine)[-7]
        votes = [(c * (10 if y else 1), y) for c, y in zip(cosine, labels, strict=True) if c >= least and c > 0]
        plain = sum(w for w, y in votes if y) / sum(w for w, _ in votes) if votes else 600 / 630
        assert got[i] == pytest.approx(plain, abs=2e-4)
    assert got[0] == got[-1] and got[:5].min() > 0.9 and got[5:10].max() < 0.3


def test_quality_on_odd_rows_and_without_labels(spark):
    rows = [(1, "The cat sat on the mat today."), (2, "BUY!! NOW!! $$$"), (3, None), (4, ""), (None, "The cat"), (1, "The cat sat on the mat today."),
            (5, "word " * 300_000), (6, "BUY!! WIN!!")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(9) for c in ("score", "predicted", "quality")})
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, None), (6, 7), (99, 0), (None, 1)], "doc_id long, quality int")
    found = knnquality.rate(df, knnquality.train(df, labels)).collect()
    assert len(found) == 8 and all(0 <= r.score <= 1 and r.predicted == (r.score >= knnquality.THRESHOLD) for r in found)
    assert {r.predicted for r in found if r.doc_id == 1} == {1} and {r.predicted for r in found if r.doc_id in (2, 6)} == {0}
    untaught = knnquality.train(df, labels.limit(0))
    assert {r.score for r in knnquality.rate(df, untaught).collect()} == {0.5}
    assert knnquality.rate(df.limit(0), untaught).count() == 0


def test_sample_is_bounded_and_votes_are_weighed(spark):
    rows = [(i, f"text {i} " + ("good words here" if i % 10 else "BAD!! $$$")) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = df.select("doc_id", F.when(F.col("doc_id") % 10 == 0, 0).otherwise(1).alias("quality"))
    model = knnquality.train(df, labels, per_label=30)
    assert len(model.labels) == 60 and model.prior == 0.9
    assert set(np.round(model.weights[model.labels == 1], 6)) == {12.0} and set(np.round(model.weights[model.labels == 0], 6)) == {round(40 / 30, 6)}


def test_quality_of_held_out_documents(spark):
    where = SF_SMALL.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{where}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{where}/labels.parquet").select("doc_id", "quality")
    model = knnquality.train(docs, labels.where(~knnquality.held_out()))
    rated = knnquality.rate(docs, model).join(labels, "doc_id").where(knnquality.held_out()).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rated)
    assert np.mean([r.predicted == r.quality for r in rated]) >= 0.93
    good, bad = ([r.score for r in rated if r.quality == q] for q in (1, 0))
    assert np.mean([(g > b) + (g == b) / 2 for g in good for b in bad]) >= 0.97
