"""The thirteen operators on their tables: queries and, where it can say it, SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from stationflow.llm import boilerplate, importance, jaccard, negatives, neighbours, packing, substrings, suffixtree, tiling, toxicity, urlrules, warc, whitening
from stationflow.llm.staging import new_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that are kept."""
    found = importance.importance(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.filter("kept").select("doc_id", "log_weight", "resample_key")


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that hold a test item, with the items."""
    found = tiling.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.groupBy("doc_id").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("coverage").alias("coverage"), F.sum(F.size("tiles")).alias("n_tiles"))


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = substrings.remove_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, folder, "documents"), n=3, share=90)


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return boilerplate.drop_boilerplate(table(spark, folder, "documents")).select("doc_id", "source", "n_lines", "n_dropped", "text")


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_warc_index(spark: SparkSession, folder: str) -> DataFrame:
    archives = new_folder(spark, "warc")
    warc.write_archives(table(spark, folder, "pages"), archives)
    index = warc.merged_index(warc.read_runs(spark, archives))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured")


def op8_embedding_links(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.near_links(table(spark, folder, "embeddings"))


def op9_suffix_tree(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2
    return suffixtree.scores(table(spark, folder, "documents"), held_out)


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"), held_out)


#: Given rules, host and path, and what they say.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def op11_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    """A page whose document is labelled of low quality or toxic is one to block; rules are mined from all tokens of every URL."""
    pages = table(spark, folder, "pages")
    bad = (F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False)))
    labels = table(spark, folder, "labels").filter("quality IS NOT NULL OR toxic IS NOT NULL")
    mined = urlrules.mine(pages, labels, "page_id", "url", "doc_id", bad, width=None)
    return urlrules.judge(pages, mined, "page_id", "url", URL_RULES)


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    dealt = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, folder, "embeddings").withColumn("label", dealt)
    return negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


QUERIES = {f.__name__: f for f in (op1_importance_resampling, op2_decontamination, op3_substring_dedup, op4_jaccard_join, op5_line_dedup, op6_warc_index, op7_packing, op8_embedding_links, op9_suffix_tree, op10_toxicity, op11_url_rules, op12_embedding_whitening, op13_hard_negatives)}
SQL = {"op5_line_dedup": boilerplate.boilerplate_sql("documents"), "op11_url_rules": urlrules.url_sql("pages", "labels", URL_RULES), "op13_hard_negatives": negatives.negatives_sql("embeddings")}
