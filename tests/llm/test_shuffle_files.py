"""Steps of the Jaccard join leave no shuffle files behind, and its token lists travel once before they meet."""

import os
import re
import time

from pyspark.sql import functions as F

from kintsugi.llm import common, jaccard

WORDS = [f"word{i}" for i in range(60)]
TEXTS = [" ".join(WORDS), " ".join(WORDS[1:]), " ".join(WORDS[:-1]), " ".join(reversed(WORDS)), " ".join(reversed(WORDS[2:])), "alone", "", None]


def shuffle_files(spark) -> set[str]:
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {name for at in dirs for _, _, names in os.walk(at) for name in names if name.startswith("shuffle_")}


def left_behind(spark, before: set[str]) -> set[str]:
    """New shuffle files that are still there when Spark has had time to remove them."""
    for _ in range(50):
        if not (found := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return found


def test_a_stored_step_leaves_no_shuffle_files(spark):
    frame = spark.range(5000).groupBy((F.col("id") % 100).alias("k")).agg(F.sum("id").alias("s"))
    for setting in (None, "false"):
        if setting:
            spark.conf.set(common.SHUFFLES_GO, setting)
        try:
            before = shuffle_files(spark)
            kept = common.stored_bare(frame)
            assert not left_behind(spark, before)
            assert sorted(kept.collect()) == sorted(frame.collect())
            assert spark.conf.get(common.SHUFFLES_GO, None) == setting
        finally:
            spark.conf.unset(common.SHUFFLES_GO)


def test_segments_are_dealt_once(spark):
    texts = spark.createDataFrame([(t,) for t in TEXTS if t], "text string")
    token, offsets = jaccard.shingle_sets(TEXTS[:5])
    keys, sizes = jaccard.set_keys(token, offsets).tolist(), (offsets[1:] - offsets[:-1]).tolist()
    near = [(0, 1), (0, 2), (1, 2), (3, 4), (0, 3), (1, 4)]
    pairs = spark.createDataFrame([(keys[a], keys[b], sizes[a], sizes[b]) for a, b in near], "a long, b long, na long, nb long")
    frequent = spark.sparkContext.broadcast(jaccard._frequent_slots(texts, 8))
    got = jaccard._links(pairs, texts, frequent, 8, 75)
    assert {(keys.index(r.a), keys.index(r.b)) for r in got.collect()} == set(near[:4])
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    # pairs, pairs with the left lists, sums; and the segments of either side, whose plans are equal
    assert len(re.findall(r"\bExchange hash", plan)) == 5
    assert len(re.findall(r"\bExchange hash.*REPARTITION_BY_COL", plan)) == 2


def test_hubs_and_components_are_as_by_hand(spark):
    rows = [(1, 10, 5, 0, 0.2), (1, 20, 5, 0, 0.8), (1, 30, 5, 0, 0.5), (2, 20, 5, 1, 0.8), (2, 30, 5, 1, 0.5), (3, 10, 5, 2, 0.2), (3, 40, 50, 0, 0.9)]
    members = spark.createDataFrame(rows, "token long, k long, n long, place long, hub double")
    assert sorted(tuple(r) for r in jaccard._stars(members, 75).collect()) == [(20, 30, 5, 5)]
    members = members.where("token < 3")
    assert sorted(tuple(r) for r in jaccard._stars(members, 75).collect()) == [(10, 20, 5, 5), (20, 30, 5, 5)]
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard.join(docs).collect()} == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 5, 6: 6, 7: 7}
