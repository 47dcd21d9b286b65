"""Disclosing terms against a plain count, and the plan that finds their places."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from kintsugi.llm import pii

regex = pytest.importorskip("regex")
NAMES = ["Zanzibarov", "Li", "Smith-Jones", "Ñandú", "of", "desk"]


def corpus(n=150):
    rng = random.Random(12)
    rows = []
    for i in range(n):
        words = rng.choices(["the", "desk", "of", "plain-text", "ab", "x", "Straße", "9lives", "a.b"], k=rng.randint(0, 60))
        who = rng.randrange(9)
        if who < 5:
            name = NAMES[who]
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randint(0, len(words)), f"{rng.choice([name, name.upper(), ''])} boss{who}@corp.example {rng.choice([name, 'call'])}")
        elif who == 5:
            words.insert(rng.randint(0, len(words)), rng.choice(NAMES))
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(words)))
    return rows


def plain_terms(rows, spans):
    """(doc, start, kind, end) of all term spans, counted in Python from the base spans."""
    term, context = regex.compile(pii.TERM), regex.compile(pii.CONTEXT_TERM)
    n, both, entities = len(rows), {}, {}
    for i, text in rows:
        for start, kind, end in spans[i]:
            entity = (kind, text[start:end])
            entities.setdefault(entity, set()).add(i)
            begin = max(start - pii.CONTEXT, 0) - 1
            around = (" " if begin < 0 else "") + text[max(begin, 0):end + pii.CONTEXT + 2]
            around = around.ljust(min(start, pii.CONTEXT) + 1 + end - start + pii.CONTEXT + 2)
            for m in context.finditer(around):
                both.setdefault((entity, m.group().lower()), set()).add(i)
    holds = {}
    for i, text in rows:
        for m in term.finditer(text):
            holds.setdefault(m.group().lower(), set()).add(i)
    kinds = {}
    for (entity, t), docs in both.items():
        if len(docs) >= pii.SUPPORT and len(holds.get(t, ())) >= pii.SUPPORT and len(entities[entity]) < n:
            content = -math.log2(len(entities[entity]) / n)
            share = math.log2(len(docs) * n / (len(holds[t]) * len(entities[entity]))) / content
            if share >= pii.GENERALISE:
                kinds[t] = min(kinds.get(t, 9), 4 if share >= pii.REMOVE else 5)
    return sorted((i, m.start(), kinds[m.group().lower()], m.end()) for i, text in rows for m in term.finditer(text) if m.group().lower() in kinds)


def test_term_spans_equal_a_plain_count(spark):
    rows = corpus()
    found = pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    base = {r.doc_id: [(s.start, s.kind, s.end) for s in r.spans if s.kind < 4] for r in found}
    got = sorted((r.doc_id, s.start, s.kind, s.end) for r in found for s in r.spans if s.kind >= 4)
    expected = plain_terms(rows, base)
    assert got == expected
    assert len({rows[i][1][a:b].lower() for i, a, _, b in got}) >= 3


def lambda_bodies(plan):
    for at in re.finditer(r"lambdafunction\(", plan):
        depth, end = 1, at.end()
        while depth and end < len(plan):
            depth += {"(": 1, ")": -1}.get(plan[end], 0)
            end += 1
        yield plan[at.end():end]


def test_no_pattern_runs_inside_a_lambda(spark):
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    spark.conf.set("spark.sql.maxPlanStringLength", str(1 << 24))
    docs = spark.createDataFrame(corpus(20), "id long, text string").withColumn("r", F.col("id"))
    terms = spark.createDataFrame([("desk", 4)], "term string, kind int")
    plan = pii._occurrences(docs, terms)._jdf.queryExecution().optimizedPlan().toString()
    bodies = list(lambda_bodies(plan))
    assert bodies and not any("regexp" in b or "split(" in b for b in bodies)


def test_texts_with_many_terms_take_linear_time(spark):
    """Thousands of documents, long ones among them, hold disclosing terms."""
    filler = "Some plain words, and more of them. " * 400
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(
        F.col("id") % 50 == 0, F.concat(F.lit("Ask Zanzibarov at boss@corp.example. "), F.lit(filler), F.col("id").cast("string"), F.lit(" Zanzibarov")))
        .otherwise(F.concat(F.lit("Nothing here, number "), F.col("id").cast("string"))).alias("text"))
    found = pii.sanitise(docs).select(F.size(F.filter("spans", lambda s: s["kind"] >= 4)).alias("n")).groupBy("n").count().collect()
    assert {r.n for r in found if r["count"] == 100} and min(r.n for r in found if r.n) >= 2
