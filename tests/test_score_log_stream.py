import os
import tempfile

import pytest
from pyspark.sql import functions as F

from kintsugi.operators import actionlog, score
from kintsugi.sources import fixtures as fx
from kintsugi.sources import runlog
from kintsugi.streaming import monitors


def test_rubric_and_blend(spark):
    facts = spark.createDataFrame([(98,)], "rows long")
    rub = score.Rubric([score.Check("a", 0.5, F.lit(1.0)),
                        score.Check("rows", 0.5, score.row_credit(F.col("rows"), F.lit(100), 2))])
    assert rub.total(facts).first().score == 1.0
    pts = {r.check_name: r.points for r in rub.points(facts).collect()}
    assert pts == {"a": 0.5, "rows": 0.5}
    gated = score.Rubric([score.Check("a", 1.0, F.lit(1.0))], gate=F.col("rows") < 99)
    assert gated.total(facts).first().score == 0.0
    row = facts.select(score.final_blend(F.lit(0.5), F.lit(1.0)).alias("x")).first()
    assert row.x == 0.575


def test_penalty_bands(spark):
    df = spark.createDataFrame([(s,) for s in (8, 9, 14, 15, 18, 19)], "step long")
    got = [r[0] for r in df.select(actionlog.step_penalty(F.col("step"), 20)).collect()]
    assert got == [0.0, 0.1, 0.1, 0.2, 0.2, 0.4]
    c = spark.createDataFrame([(20.0,), (30.0,), (100.0,)], "c double")
    assert [r[0] for r in c.select(actionlog.cost_penalty(F.col("c"))).collect()] == \
        pytest.approx([0.0, 0.15, 0.30])


def test_session_end_rules(spark):
    rows = [(1, i, f"2024-01-01 00:00:{i:02d}", a, v, "{}") for i, (a, v) in enumerate(
        [("inspect_column", True), ("bogus", False), ("finish", True), ("cast_type", True)])]
    log = spark.createDataFrame(rows, "session_id long, event_id long, ts string, action_type string, "
                                      "valid boolean, params_json string") \
        .withColumn("ts", F.col("ts").cast("timestamp"))
    a = actionlog.annotate(log, max_steps=20)
    got = {r.event_id: (r.step, r.cum_cost, r.cum_invalid, r.active) for r in a.collect()}
    assert got == {0: (1, 0.5, 0, True), 1: (2, 1.5, 1, True), 2: (3, 1.5, 1, True), 3: (4, 2.5, 1, False)}
    end = actionlog.session_end(a).first()
    assert (end.end_step, end.ended_by, end.ignored_actions) == (3, "finish", 1)
    lines = [r.line for r in actionlog.audit(a).orderBy("step").collect()]
    assert lines[0] == "[Step 01] inspect_column({}) → OK: inspect_column"


def test_runlog_round_trip(spark):
    lines = spark.createDataFrame([
        ("[START] task=easy env=e model=m",),
        ("[STEP] step=1 action=check_nulls reward=0.25 done=false error=null",),
        ("[STEP] step=2 action=finish reward=0.90 done=true error=boom",),
        ("[END] success=true steps=2 score=0.90 rewards=0.25,0.90",)], "line string")
    steps = runlog.parse_steps(lines).collect()
    assert [(s.step, s.action, s.reward, s.done, s.error) for s in steps] == \
        [(1, "check_nulls", 0.25, False, None), (2, "finish", 0.9, True, "boom")]
    end = runlog.parse_ends(lines).first()
    assert (end.success, end.steps, end.rewards) == (True, 2, [0.25, 0.9])
    txt = spark.createDataFrame([("```json\n{\"action_type\": \"finish\", \"parameters\": {}}\n```",),
                                 ("sure: {\"action_type\": \"audit_log\"} ok",), ("nothing",)], "t string")
    got = [r[0] for r in txt.select(runlog.extract_action(F.col("t"))["action_type"]).collect()]
    assert got == ["finish", "audit_log", None]


def test_streams_equal_batch(spark, tables):
    src = tempfile.mkdtemp(prefix="kintsugi-stream-src-")
    ev = fx.events_gappy(tables)
    ev.write.mode("overwrite").parquet(os.path.join(src, "events"))
    stream = spark.readStream.schema(ev.schema).parquet(os.path.join(src, "events"))
    ck = tempfile.mkdtemp(prefix="kintsugi-stream-ck-")
    batch = sorted(map(tuple, monitors.contract_monitor(ev).collect()))
    # complete mode: every window, equal to the batch result
    got = monitors.run_available_now(monitors.contract_monitor(stream), "monitor_out", ck, mode="complete")
    assert sorted(map(tuple, got.collect())) == batch
    # append mode emits a window once the watermark has passed it: a subset, equal row for row
    appended = monitors.run_available_now(monitors.contract_monitor(stream), "monitor_app",
                                          tempfile.mkdtemp(prefix="kintsugi-stream-ck-"))
    rows = sorted(map(tuple, appended.collect()))
    assert rows and set(rows) <= set(batch)

    log = fx.action_log(tables)
    log.write.mode("overwrite").parquet(os.path.join(src, "log"))
    lstream = spark.readStream.schema(log.schema).parquet(os.path.join(src, "log"))
    got = monitors.run_available_now(monitors.session_budget(lstream), "budget_out",
                                     tempfile.mkdtemp(prefix="kintsugi-stream-ck-"), mode="complete")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, monitors.session_budget(log).collect()))

    dup = ev.unionByName(ev.filter(F.col("event_id") % 5 == 1))
    dup.write.mode("overwrite").parquet(os.path.join(src, "dup"))
    dstream = spark.readStream.schema(dup.schema).parquet(os.path.join(src, "dup"))
    got = monitors.run_available_now(monitors.dedup_events(dstream, ["event_id"]), "dedup_out",
                                     tempfile.mkdtemp(prefix="kintsugi-stream-ck-"))
    assert got.count() == ev.count()

    en = monitors.run_available_now(monitors.enrich_events(stream, fx.users(tables), "user_id"),
                                    "enrich_out", tempfile.mkdtemp(prefix="kintsugi-stream-ck-"))
    assert en.count() == ev.count()
