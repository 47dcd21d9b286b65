"""The pipeline's tasks hold one Python worker each: an executor's memory holds as many as its stages ever ran at once."""

import re

import pytest

import corpus_pipeline
from kintsugi.llm import common, decontam, jaccard

LINE = "this is line {} of some text that two of the documents have in common"
TEXTS = ["\n".join(LINE.format(i) for i in range(9)), "\n".join(LINE.format(i) for i in range(9)) + "\nand one more",
         "quite another text with words of its own, of which there are some", "", None]


def chained(df) -> int:
    """Most Python evaluations of a plan that run in the same tasks."""
    above, most = [], 0
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        prefix = re.match(r"[ :]*(?:[+*]- )?", line).group()
        node = re.sub(r"^\*\(\d+\) ", "", line[len(prefix):])
        while above and above[-1][0] >= len(prefix):
            above.pop()
        n = above[-1][1] if above else 0
        n = 0 if re.match(r"(Broadcast)?Exchange", node) else n + bool(re.match(r"ArrowEvalPython|MapInArrow", node))
        above.append((len(prefix), n))
        most = max(most, n)
    return most


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "web", len(t or "")) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


def test_line_dedup_filters_without_a_second_worker(spark, docs):
    got = corpus_pipeline.drop_repeated_lines(spark, docs, "")
    assert chained(got) == 1
    assert {r.doc_id: r.text for r in got.collect()} == {0: LINE.format(0), 1: "and one more", 2: TEXTS[2], 3: "", 4: None}


def test_representatives_match_without_a_second_worker(docs):
    got = jaccard.representatives(docs)
    assert chained(got) == 1
    assert sorted(r.doc_id for r in got.collect()) == [0, 2, 3, 4]


def test_tokens_are_stored_before_they_are_decoded(spark, docs):
    got = corpus_pipeline.tokenize(spark, docs, "")
    assert chained(got) == 1
    assert {r.doc_id: (r.n_tokens > 0, r.round_trip) for r in got.collect()} == {i: (bool(t), True) for i, t in enumerate(TEXTS)}


def test_distances_are_made_in_other_tasks_than_windows(spark, docs):
    items = spark.createDataFrame([(7, TEXTS[2])], "item_id long, text string")
    found = decontam.find(docs, items)
    assert chained(found) == 1 and [(r.id, r.item, r.edits) for r in found.collect()] == [(2, 7, 0)]
    assert chained(found.select("id").distinct()) == 1


def test_each_stage_sends_few_texts_at_a_time(spark, docs):
    before = spark.conf.get(common.ARROW_ROWS)
    try:
        for rows, expected in (("10000", "2000"), ("64", "64")):
            for _, stage in corpus_pipeline.STAGES[1:3]:
                spark.conf.set(common.ARROW_ROWS, rows)
                stage(spark, docs, "")
                assert spark.conf.get(common.ARROW_ROWS) == expected
    finally:
        spark.conf.set(common.ARROW_ROWS, before)
