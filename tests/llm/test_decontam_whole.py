"""Decontamination against brute force; short items, scripts without blanks, long items."""

import random
import re

import numpy as np
import pytest

from kintsugi.llm import decontam


def _plain_words(text):
    return re.findall(r"[^\W_]+", text.lower())


def _fewest_edits(item, words):
    """Edits between the item and the closest stretch of the words."""
    row = np.zeros(len(words) + 1, int)
    step = np.arange(len(words) + 1)
    for w in item:
        other = np.array([x != w for x in words], int)
        now = np.concatenate(([row[0] + 1], np.minimum(row[1:] + 1, row[:-1] + other)))
        row = np.minimum.accumulate(now - step) + step
    return int(row.min())


def _edit(rng, words, edits, vocabulary):
    out = list(words)
    for _ in range(edits):
        i, kind = rng.randrange(len(out)), rng.randrange(3)
        out[i:i + 1] = [[rng.choice(vocabulary), out[i]], [], [rng.choice(vocabulary)]][kind]
    return out


def test_equals_brute_force_on_texts_of_few_words(spark):
    rng = random.Random(21)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 7, 9, 14, 25, 50]))]) for i in range(60)]
    docs = []
    for d in range(250):
        text = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 120))]
        if d % 2:
            words = items[rng.randrange(60)][1]
            passage = _edit(rng, words, rng.randint(0, decontam.edits_allowed(len(words), decontam.SHARE)), vocabulary)
            at = rng.randrange(len(text) + 1)
            text[at:at] = passage
        docs.append((d, " ".join(text)))
    want = {}
    for d, text in docs:
        for i, words in items:
            edits = _fewest_edits(words, _plain_words(text)) if text else len(words)
            if edits <= decontam.edits_allowed(len(words), decontam.SHARE):
                want[d, i] = edits
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.id, r.item): r.edits for r in decontam.find(df, bench).collect()}
    assert all(want[k] == e for k, e in got.items())  # nothing but what is there, at its closest place
    assert {k for k, e in want.items() if not e} <= set(got)  # every exact copy, however short
    assert len(got) >= 0.98 * len(want) and len(want) > 250


def test_short_items_and_scripts_without_blanks(spark):
    bench = [(1, "what is two plus"), (2, "\u5317\u4eac\u662f\u4e2d\u56fd\u7684\u9996\u90fd\u4f46\u4e0a\u6d77\u66f4\u5927\u4e00\u4e9b"),
             (3, "\u0e01\u0e02\u0e04"), (4, "?!"), (5, ""), (6, "unicorn")]
    docs = [(1, "tell me: What IS two-plus two"), (2, "\u6211\u77e5\u9053" + bench[1][1] + "\u3002\u5bf9\u5417"),
            (3, bench[1][1][:6] + "\u5f88" + bench[1][1][7:]), (4, bench[1][1][:7]), (5, "x\u0e01\u0e02\u0e04y"), (6, "two plus what is"),
            (7, "a Unicorn."), (8, "unicorns"), (9, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(bench, "item_id long, text string")
    assert {(r.id, r.item) for r in decontam.find(df, items).collect()} == {(1, 1), (2, 2), (3, 2), (5, 3), (7, 6)}
    assert {r.item for r in decontam.find(df, items, min_words=5).collect()} == {2}
    assert sorted(r.doc_id for r in decontam.clean(df, items).collect()) == [4, 6, 8, 9]


@pytest.mark.parametrize("length", [500, 2000])
def test_long_items_at_the_bound(spark, length):
    rng = random.Random(length)
    vocabulary = [f"w{i}" for i in range(20000)]
    items = [[rng.choice(vocabulary) for _ in range(length)] for _ in range(10)]
    filler = [rng.choice(vocabulary) for _ in range(300)]
    docs = [(k, " ".join(filler + _edit(rng, items[k % 10], decontam.edits_allowed(length, decontam.SHARE), vocabulary) + filler))
            for k in range(40)]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    found = {(r.id, r.item) for r in decontam.find(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert found <= {(k, k % 10) for k in range(40)} and len(found) >= 38


def test_every_class_reaches_its_target():
    for c in {int(decontam.length_class(np.array([n]))[0]) for n in (7, 20, 60, 331)}:
        samples, repeats = decontam.class_plan(c, decontam.SHARE, decontam.RECALL)
        low, high = decontam.class_lengths(c)
        assert decontam.repetitions(low, decontam.edits_allowed(high, decontam.SHARE), decontam.RECALL, samples) == repeats
        assert repeats <= decontam.FEWER_AT or samples == 1
