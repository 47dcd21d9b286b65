"""Regular texts on which polynomial hashes modulo 2^64 agree, whatever their base."""

import hashlib
import random

import numpy as np
import pytest

from kintsugi.llm import bpe, common, jaccard, linededup, quality, substrings
from kintsugi.llm.queries import vocabulary_path


def thue_morse(n, a="a", b="b"):
    return "".join(a if i.bit_count() % 2 == 0 else b for i in range(n))


def test_word_hashes_tell_regular_words_apart():
    for k in range(4, 17):
        words = [thue_morse(1 << k), thue_morse(1 << k, "b", "a"), thue_morse((1 << k) - 1), "a" * (1 << k), "ab" * (1 << k - 1)]
        found, length, _ = common.word_hashes(*common.code_points([" ".join(words)]))
        assert len(set(found.tolist())) == len(words) and length.tolist() == [len(w) for w in words]


@pytest.mark.parametrize("n", [1024, 65536])
def test_lines_and_documents_that_differ_stay(spark, n):
    one, other = thue_morse(n), thue_morse(n, "b", "a")
    lines = spark.createDataFrame([(1, one), (2, other), (3, one)], "doc_id long, text string")
    kept = {r.doc_id: (r.n_dropped, r.text) for r in linededup.dedup(lines).collect()}
    assert kept == {1: (0, one), 2: (0, other), 3: (1, "")}
    groups = {r.doc_id: r.component_id for r in jaccard.join(lines).collect()}
    assert groups == {1: 1, 2: 2, 3: 1}
    assert quality.measure([f"x {one} y . x {other} y"])["n_repeat_words"].tolist() == [0]
    assert quality.measure([f"x {one} y . x {one} y"])["n_repeat_words"].tolist() == [6]


def test_substrings_of_regular_texts(spark):
    texts = [thue_morse(2048), thue_morse(2048, "b", "a"), "x" + thue_morse(700, "c", "d")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.n_removed, hashlib.sha256(r.kept).hexdigest()) for r in substrings.dedup(df).collect()}
    places = {}
    for i, t in enumerate(texts):
        for k in range(len(t) - 199):
            places.setdefault(t[k:k + 200], []).append((i, k))
    gone = {(i, k + j) for at in places.values() if len(at) > 1 for i, k in at for j in range(200)}
    for i, t in enumerate(texts):
        kept = "".join(c for k, c in enumerate(t) if (i, k) not in gone)
        assert found[i] == (len(t) - len(kept), hashlib.sha256(kept.encode()).hexdigest())


def test_merges_of_many_pieces_equal_those_of_one():
    vocabulary = bpe.Vocabulary.load(vocabulary_path())
    merger = bpe.Merger(vocabulary)
    rng = random.Random(11)
    pieces = [bytes(rng.choices(rng.choice([b" aeinrst", b"0123456789", b"\xc3\xa9\xe6\x97\xa5=-", bytes(range(256))]), k=rng.randint(1, bpe.Merger.WIDEST)))
              for _ in range(20_000)] + [b"a" * k for k in range(1, bpe.Merger.WIDEST + 1)]
    assert [np.frombuffer(x, np.int32).tolist() for x in merger.merge(pieces)] == [vocabulary.merge(p) for p in pieces]
    assert merger.merge([]) == [] and merger.merge([b""]) == [b""]
