"""Catalogue queries of this package: one per operator, and their DuckDB SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kintsugi.llm import bpe, common, decontam, fim, html, jaccard, knnquality, langid, linededup, pii, quality, substrings, urlfilter, \
    vectorcodes


def vocabulary_path() -> str:
    """The vocabulary file of the installed public tokenizers."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def token_digests() -> list[Column]:
    """Number and digest of the token ids in ``ids``."""
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return [F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    tokenizer = bpe.Tokenizer(spark, vocabulary_path(), bpe.frequent_words(docs))
    coded = tokenizer.decode(tokenizer.encode(docs))
    return coded.select("doc_id", *token_digests(), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.sanitise(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] < len(pii.PATTERNS))
    counts = [pii.count_of(i).alias(f"n_{kind}") for i, kind in enumerate(pii.PATTERNS)]
    return found.select("doc_id", *counts, F.sha2(pii.listed(base), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"))


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "place", "n_words", "edits")


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_table(spark, sf_dir, "pages").select("page_id", "html")).select("page_id", "text")


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = substrings.dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = linededup.dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.where(langid.fold() != 2))
    held = F.coalesce(langid.fold() == 2, F.lit(False)).alias("held_out")
    return langid.predict(docs.drop("lang"), model).select("doc_id", held, "lang_pred", "score")


def op9_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(pages).select("page_id", "host", "path", "rule", "verdict")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.rate(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_vectorcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vectorcodes.compress(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    rows = common.stored(coded.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label"))
    per_label = rows.groupBy(F.col("label").alias("l")).agg(F.sum("error").alias("label_error"))
    digest = hashlib.sha256(books.listed().encode()).hexdigest()
    return rows.join(per_label, F.col("label").eqNullSafe(F.col("l"))) \
        .select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fim.transform(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", F.col("n_chars").alias("n"), "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"), F.sha2(fim.restored(), 256).alias("restored_sha256"))


def op13_knnquality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(knnquality.held_out(), F.lit(False))
    model = knnquality.train(docs, _table(spark, sf_dir, "labels").where(~held), "quality")
    return knnquality.rate(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_pii": op2_pii,
    "op3_jaccard": op3_jaccard,
    "op4_decontam": op4_decontam,
    "op5_html": op5_html,
    "op6_substrings": op6_substrings,
    "op7_linededup": op7_linededup,
    "op8_langid": op8_langid,
    "op9_urlfilter": op9_urlfilter,
    "op10_quality": op10_quality,
    "op11_vectorcodes": op11_vectorcodes,
    "op12_fim": op12_fim,
    "op13_knnquality": op13_knnquality,
}

ORACLE: dict[str, str] = {
    "op3_jaccard": jaccard.join_sql(),
    "op7_linededup": linededup.dedup_sql(),
    "op9_urlfilter": urlfilter.judge_sql(),
    "op10_quality": quality.rate_sql(),
    "op11_vectorcodes": vectorcodes.compress_sql(),
    "op12_fim": fim.transform_sql(),
}
