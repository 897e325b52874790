"""The registered queries: each operator over its whole table, reduced to the columns agreed on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainledger.llm import clusters, collocations, decontaminate, jaccard, licenses, linededup, lm, packing, quality, sharding, simhash, tokenfiles, warc
from rainledger.llm.common import ship, table
from rainledger.llm.tokens import default_tokenizer
from rainledger.session import scratch


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), default_tokenizer(), capacity=1024, end_id=2)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens")
    tokenfiles.write_token_files(documents(spark, sf_dir), path, default_tokenizer(), end_id=0)
    return tokenfiles.with_crc32(tokenfiles.read_token_files(spark, path))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    path = scratch(spark, "warc")
    # pages carry no time: 2024 began with page 0, and a second passed from page to page
    captured = F.timestamp_seconds(F.lit(1_704_067_200) + F.coalesce("page_id", F.lit(0)))
    warc.write_archives(pages, path, captured)
    index = warc.merge_runs(warc.read_runs(spark, path))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    rows = docs.withColumn("row", F.monotonically_increasing_id())
    return quality.verdicts(rows, "row", carry=("doc_id",)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.deduplicated(documents(spark, sf_dir))
    words = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["n_words"])
    return found.select(
        "doc_id", F.size("removed").cast("long").alias("n_removed"), words.alias("removed_words"), "removed", "text"
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), width=4, threshold=4)


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(documents(spark, sf_dir))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = documents(spark, sf_dir).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    return sharding.shard_table(rows, "doc_id", 8, ["doc_id", "text_crc32", "size"])


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = table(spark, sf_dir, "benchmark")
    found = decontaminate.find_occurrences(documents(spark, sf_dir), benchmark, keep_text=False)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    listed = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", listed), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(documents(spark, sf_dir), "doc_id", "text", width=5, percent=80)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return collocations.collocations(table(spark, sf_dir, "documents"), "text", "lang", least=100, width=5, top=2000)


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return clusters.cluster(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", dims=64, k=40, rounds=5)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_token_files": op2_token_files,
    "op3_warc": op3_warc,
    "op4_quality_rules": op4_quality_rules,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_license_scan": op6_license_scan,
    "op7_simhash": op7_simhash,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_sharding": op9_sharding,
    "op10_decontamination": op10_decontamination,
    "op11_jaccard_join": op11_jaccard_join,
    "op12_collocations": op12_collocations,
    "op13_centroid_clustering": op13_centroid_clustering,
}
