"""The registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairtally.llm import extract, flatgraph, langid, lm, merkle, minhash, mixing, packing, quality, repair, toxicity, urls, warc
from fairtally.llm.common import ascii_lower, remainder, table
from fairtally.llm.oracles import ORACLES

URL_RULES = [
    urls.UrlRule("allow", "com", "/"),
    urls.UrlRule("block", "example.com", "/en/"),
    urls.UrlRule("allow", "www.example.com", "/en/"),
    urls.UrlRule("block", "net", "/es/"),
    urls.UrlRule("block", "net", "/fr/"),
]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    chosen = mixing.select_mixture(docs, mixing.default_tree(docs))
    return chosen.select(F.col("row.doc_id").alias("doc_id"), *mixing.LEVELS, "n_tokens", "epochs")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = urls.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"), remainder("doc_id", 7) == 2)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read_warc(warc.write_warc(table(spark, sf_dir, "pages")), with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_text(table(spark, sf_dir, "pages"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(remainder("doc_id", 3) != 1))
    found = langid.identify(docs, model).withColumn("doc_id", F.col("row.doc_id"))
    return found.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "rejected")


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "quality",
    )


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatgraph.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repair.damaged(table(spark, sf_dir, "conversations"))
    return repair.repair_conversations(rows, present=F.col("present"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    values = {c: F.col(c) for c in merkle.COLUMNS}
    tampered = F.when(
        remainder("doc_id", 5) == 0, merkle.leaf_digest(values | {"text": ascii_lower(F.col("text").cast("string"))})
    )
    proved = merkle.proofs(merkle.build_manifest(docs, carry={"tampered": tampered}))
    folded = merkle.fold(F.coalesce("carried.tampered", "leaf"), F.col("path"))
    return proved.select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sample = toxicity.labelled_sample(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 4) != 2)
    scored = toxicity.score_documents(docs, toxicity.fit(sample))
    return scored.select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


__all__ = ["ORACLES", "QUERIES"]

QUERIES = {q.__name__: q for q in (op1_mixing, op2_url_filters, op3_lm_scoring, op4_warc, op5_html_extraction, op6_best_fit_packing, op7_language_id, op8_minhash_near_dedup, op9_quality_rules, op10_embedding_near_dedup, op11_structure_repair, op12_merkle, op13_toxicity)}
