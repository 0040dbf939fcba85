"""The registered queries: name -> (Spark job, equivalent SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import (
    bpe, chat, collocations, decontaminate, exact_dedup, language, merkle, near_dup, pii, quality, substring_dedup, token_store, url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(job):
        QUERIES[name] = job
        if oracle:
            ORACLES[name] = oracle
        return job
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op6_quality_rules")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "s.n_words", "s.word_chars", "s.n_symbols", "s.n_dup_lines",
                         "s.n_repeat_words", "s.base_failed", "kept")


#: Only for the registered query and the pipeline; a real job takes its key from its secrets.
DEMONSTRATION_KEY = "not a secret"


@query("op1_pii_pseudonyms")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymize(docs, DEMONSTRATION_KEY, found="kinds")


@query("op5_perspective_rotation", chat.ORACLE)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = chat.rotate(table(spark, sf_dir, "conversations"))
    written = F.transform("spans", lambda s: F.concat_ws("+", s["start"].cast("string"), s["length"].cast("string")))
    return views.withColumn("spans", F.array_join(written, " "))


@query("op10_url_sweep", url_filter.ORACLE)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(url_filter.RULES), "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


@query("op7_benchmark_hits", decontaminate.ORACLE)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Of the vocabulary that the registered queries use.
END_ID = 2


def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query("op8_token_store")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-ids")
    token_store.write_tokens(table(spark, sf_dir, "documents"), path, vocabulary(), END_ID)
    return token_store.read_digests(spark, path)


@query("op9_bpe_chunk_reuse")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary())


@query("op3_near_duplicates", near_dup.ORACLE)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op2_substring_dedup", substring_dedup.ORACLE)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query("op4_language_fusion")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with all evidence; documents by their text and, in the place of a host, their source."""
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    model = language.train(docs)
    plain = docs.select("doc_id", F.col("source").alias("host"), F.lit("").alias("declared"), "text")
    of_pages = language.identify(language.evidence(pages), model)
    of_docs = language.identify(plain, model, key="doc_id")
    return of_pages.unionByName(of_docs, allowMissingColumns=True).select("page_id", "doc_id", "lang", "confidence")


@query("op13_merkle_manifest", merkle.ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the contract every seventh document, by checksum, is found with one character more than it had."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    longer = F.col("n_chars").cast("decimal(20,0)") + F.lit(1).cast("decimal(20,0)")
    return merkle.manifest(table(spark, sf_dir, "documents"), tampered, {"n_chars": longer})


@query("op11_patricia_owners", exact_dedup.ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.owners(table(spark, sf_dir, "documents"))


@query("op12_phrase_stripes", collocations.ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))
