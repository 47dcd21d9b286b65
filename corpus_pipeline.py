"""The corpus pipeline: stages that turn ``documents`` into token ids.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor
kept and returns a DataFrame; ``run`` writes each stage's rows as Parquet into
the shared folder and reads them back for the next one.

Nulls, empty and very long texts, ties, repeated rows and empty tables have the
results that the operators' modules define; extra columns pass through to the
last stage.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kintsugi.llm import bpe, common, decontam, jaccard, langid, linededup
from kintsugi.llm.queries import vocabulary_path


def _stage(fn):
    """A stage sets its session up by itself: stages run one by one too, without ``run`` or the entry."""
    @functools.wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.small_batches(spark)
        return fn(spark, docs, sf_dir)
    return run


@_stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose text is in a known language.  The model and
    its limits come from the labelled rows of its input outside fold 2."""
    labelled = docs.where(langid.fold() != 2)
    model = langid.with_limits(labelled, langid.train(labelled))
    return langid.predict(docs, model).where(~langid.rejects()).select(docs.columns)


@_stage
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that are equal, or one edit away, to an earlier line of the corpus.
    ``n_chars`` follows the text; documents left without any word go."""
    lines = linededup.dedup(docs)
    changed = F.col("n_dropped") > 0
    kept = lines.where(~changed | F.col("text").rlike(common.WORD_PATTERN))
    return kept.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))) \
        .select(docs.columns)


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, the one with the smallest id."""
    return jaccard.representatives(docs)


@_stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that contain an item of the benchmark."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_stage
def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, and whether they decode to its text.  The ids are stored in
    between, so that no task holds two Python workers."""
    tokenizer = bpe.Tokenizer(spark, vocabulary_path(), bpe.frequent_words(docs))
    coded = tokenizer.decode(common.stored(tokenizer.encode(docs.select("doc_id", "lang", "source", "text"))))
    same = F.col("decoded") == common.text_of("text")
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("jaccard", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("bpe", tokenize),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir))
    return docs
