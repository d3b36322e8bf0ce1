"""The registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loquent.llm import (
    bpe,
    classifier,
    exact,
    katz,
    langid,
    mixing,
    pii,
    quality,
    simhash,
    toxicity,
    variants,
    warc,
    whitening,
)
from loquent.llm.common import table
from loquent.session import write_out

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def documents(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text", *more)


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the identifier as text, modulo ``divisor``; null counts as ''."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % divisor


@query("op2_simhash")
def op2_simhash(spark, folder):
    found = simhash.near_duplicates(documents(spark, folder))
    return found.select(
        "doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id"
    )


@query("op3_bpe")
def op3_bpe(spark, folder):
    return bpe.round_trip(documents(spark, folder)).drop("text")


@query("op6_exact_dedup")
def op6_exact_dedup(spark, folder):
    found = exact.exact_duplicates(documents(spark, folder), largest=True)
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


@query("op7_mixing")
def op7_mixing(spark, folder):
    return mixing.mix(documents(spark, folder, "source"))


@query("op9_langid")
def op9_langid(spark, folder):
    docs = documents(spark, folder, "lang")
    learned = remainder(F.col("doc_id"), 3) != 1
    model = langid.fit(langid.sample(docs, learned))
    held = (~learned).alias("held_out")
    return langid.predict(docs.select("doc_id", "text", held), model).drop("text")


@query("op10_toxicity")
def op10_toxicity(spark, folder):
    docs = documents(spark, folder)
    model = toxicity_model(spark, folder, docs)
    held = (remainder(F.col("doc_id"), 5) == 0).alias("held_out")
    scored = toxicity.score(docs.select("doc_id", "text", held), model).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def toxicity_model(spark: SparkSession, folder: str, docs: DataFrame) -> toxicity.Model:
    """Learned from the labels of rows whose remainder by 5 is not 0."""
    labels = table(spark, folder, "labels")
    usable = remainder(F.col("doc_id"), 5) != 0
    return toxicity.fit(toxicity.sample(docs, labels, usable))


@query("op4_quality")
def op4_quality(spark, folder):
    stats = quality.with_figures(documents(spark, folder)).drop("text")
    stats = write_out(stats, "figures")
    rules = quality.fit(stats, table(spark, folder, "labels"))
    failed = quality.base_failed()
    return stats.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & quality.verdict(rules)).alias("kept"),
    )


@query("op5_pii")
def op5_pii(spark, folder):
    found = pii.find_personal(documents(spark, folder))
    counts = [
        F.size(F.filter("base", pii.of_kind(k))).cast("long").alias(f"n_{k}")
        for k in pii.KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"),
        pii.joined(F.col("found")).alias("spans"),
    )


@query("op1_warc")
def op1_warc(spark, folder):
    records = warc.archive_pages(table(spark, folder, "pages"))
    return records.select(
        warc.page_id("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_id("refers_to").alias("refers_to"),
    )


@query("op8_katz")
def op8_katz(spark, folder):
    return katz.score(documents(spark, folder), remainder(F.col("doc_id"), 10) == 0)


@query("op11_whitening")
def op11_whitening(spark, folder):
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(rows)
    error, n, shares = 0.0, 0, [0.0]
    if model is not None:
        error = whitening.identity_error(rows, model)
        n, shares = model.n, model.shares(whitening.COMPONENTS)
    found = whitening.whiten(rows, model, keep=["vec_id"]).select(
        F.col("row.vec_id").alias("vec_id"),
        F.expr("try_cast(deviation AS BIGINT)").alias("deviation"),
        F.posexplode("whitened").alias("at", "whitened"),
    )
    explained = F.get(F.array(*[F.lit(s) for s in shares]), F.col("at"))
    return found.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained.alias("explained"),
        F.lit(error).alias("identity_error"),
    )


@query("op12_quality_classifier")
def op12_quality_classifier(spark, folder):
    docs = documents(spark, folder)
    labels = table(spark, folder, "labels")
    model = classifier.fit(
        classifier.sample(docs, labels, remainder(F.col("doc_id"), 5) != 0)
    )
    held = (remainder(F.col("doc_id"), 5) == 0).alias("held_out")
    scored = classifier.score(docs.select("doc_id", "text", held), model).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query("op13_variants")
def op13_variants(spark, folder):
    return variants.variants(variants.slipped_words(documents(spark, folder)))
