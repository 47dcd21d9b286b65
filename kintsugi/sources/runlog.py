"""Text sources: agent run logs and actions embedded in model output.

Run-log lines look like::

    [START] task=<t> env=<e> model=<m>
    [STEP] step=<n> action=<a> reward=<r> done=<true|false> error=<msg|null>
    [END] success=<true|false> steps=<n> score=<s> rewards=<r1,r2,...>

Parsing is ``regexp_extract`` over ``spark.read.text`` lines: JVM-side,
splittable, one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Run-log line layouts.
STEP_LINE = "[STEP] step=%d action=%s reward=%.2f done=%s error=%s"
STEP_RE = r"^\[STEP\] step=(\d+) action=(\S+) reward=(-?[0-9.]+) done=(true|false) error=(.*)$"
START_RE = r"^\[START\] task=(\S+) env=(\S+) model=(\S+)$"
END_RE = r"^\[END\] success=(true|false) steps=(\d+) score=(-?[0-9.]+) rewards=(\S*)$"

ACTION_SCHEMA = "struct<action_type:string,parameters:map<string,string>>"


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "line")


def format_step_lines(df: DataFrame, step: str, action: str, reward: str, done: Column,
                      error: Column) -> Column:
    return F.format_string(STEP_LINE, F.col(step), F.col(action), F.col(reward),
                           F.when(done, F.lit("true")).otherwise(F.lit("false")),
                           F.coalesce(error, F.lit("null")))


def parse_steps(lines: DataFrame, col: str = "line") -> DataFrame:
    """Keep ``[STEP]`` lines and split them into typed fields."""
    c = F.col(col)
    g = lambda i: F.regexp_extract(c, STEP_RE, i)
    err = g(5)
    return lines.filter(c.rlike(STEP_RE)).select(
        *[x for x in lines.columns if x != col],
        g(1).cast("long").alias("step"), g(2).alias("action"),
        g(3).cast("double").alias("reward"), (g(4) == "true").alias("done"),
        F.when(err == "null", F.lit(None).cast("string")).otherwise(err).alias("error"))


def parse_starts(lines: DataFrame, col: str = "line") -> DataFrame:
    """Keep ``[START]`` lines and split them into task, env and model."""
    c = F.col(col)
    return lines.filter(c.rlike(START_RE)).select(
        *[x for x in lines.columns if x != col],
        *[F.regexp_extract(c, START_RE, i).alias(name) for i, name in enumerate(("task", "env", "model"), 1)])


def line_kinds(lines: DataFrame, col: str = "line") -> DataFrame:
    """Number of lines of each kind, ``unmatched`` for those that fit no layout."""
    c = F.col(col)
    kind = F.when(c.rlike(START_RE), "start").when(c.rlike(STEP_RE), "step").when(c.rlike(END_RE), "end").otherwise("unmatched")
    return lines.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n_lines"))


def parse_ends(lines: DataFrame, col: str = "line") -> DataFrame:
    c = F.col(col)
    g = lambda i: F.regexp_extract(c, END_RE, i)
    return lines.filter(c.rlike(END_RE)).select(
        *[x for x in lines.columns if x != col],
        (g(1) == "true").alias("success"), g(2).cast("long").alias("steps"),
        g(3).cast("double").alias("score"),
        F.transform(F.split(g(4), ","), lambda x: x.cast("double")).alias("rewards"))


def extract_action(text: Column) -> Column:
    """Parse the JSON action in model output: inside a code fence, or from
    the first ``{`` to the last ``}``.  Unparsable text gives NULL."""
    body = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    return F.when(body == "", F.lit(None).cast(ACTION_SCHEMA)).otherwise(
        F.from_json(body, ACTION_SCHEMA))
