"""Passes over the texts make only what they use."""

import numpy as np

from kintsugi.llm import jaccard, linededup

TEXTS = ["a line that is long enough to vary\nshort\n\na line that is long enough to vary", "", "x", "one two three four five six",
         "b a b a b a b a"]


def test_hashes_of_stretches_are_made_when_asked_for():
    lines = linededup.Lines(TEXTS)
    assert not {"power", "inverse", "upto", "raw"} & set(vars(lines))
    same = lines.raw[lines.hash == lines.hash[0]]
    assert len(same) == 2 and same[0] == same[1]
    assert "upto" in vars(lines)


def test_lines_are_numbered_in_one_pass(spark):
    df = spark.createDataFrame(list(enumerate([*TEXTS, None, TEXTS[0]])), "doc_id long, text string")
    got = {r.doc_id: r for r in linededup.dedup(df).collect()}
    assert (got[0].text, got[0].n_lines, got[0].n_dropped) == ("a line that is long enough to vary\nshort\n", 4, 1)
    assert (got[6].text, got[6].n_lines, got[6].n_dropped) == ("", 4, 3) and (got[5].text, got[5].n_lines, got[5].n_dropped) == (None, 0, 0)
    assert (got[1].text, got[1].n_lines, got[1].n_dropped) == ("", 1, 0)
    drops = linededup.dropped_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in drops


def test_sets_are_sorted_and_rare_shingles_go_first():
    token, offsets = jaccard.shingle_sets(TEXTS)
    sets = [token[a:b] for a, b in zip(offsets, offsets[1:])]
    assert [len(s) for s in sets][1:] == [0, 1, 2, 2]
    assert all((s[1:] > s[:-1]).all() for s in sets)
    frequent = np.arange(1 << 4) % 2 == 1
    ranked, late, place, doc = jaccard._ranked(token, offsets, frequent, 4)
    order = np.lexsort((token, frequent[token >> 59], doc))
    assert (ranked == token[order]).all() and (late == frequent[ranked >> 59]).all()
    assert (place == np.arange(len(token)) - offsets[doc]).all()
