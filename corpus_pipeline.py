"""A training corpus from documents: filter, drop near copies, drop repeats, decontaminate, pack.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last keep the columns
of documents. Whoever runs them writes each result before the next stage begins and gives that what
was written; ``run`` does so in the shared scratch folder, so a lost executor never costs an earlier
stage. A stage that begins deletes the tables the stage before it worked with.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainledger.llm import decontaminate, linededup, packing, quality, simhash
from rainledger.llm.common import collected, discard, ship, table
from rainledger.llm.tokens import default_tokenizer
from rainledger.session import scratch

_worked_with: list[str] = []


def _with_length(docs: DataFrame) -> DataFrame:
    """``n_chars``, where there is one, of the texts as they are now."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stage(function: Stage) -> Stage:
    @wraps(function)
    def begin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        discard(spark, _worked_with)
        with collected(_worked_with):
            return function(spark, docs, sf_dir)

    return begin


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the counts or are depleted go; lines that a host's documents share leave the others."""
    return _with_length(quality.filtered(docs))


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.one_of_each(docs)


@_stage
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has leave the later ones; documents with no word left go."""
    mark = "removed"
    while mark in {c.lower() for c in docs.columns}:
        mark = f"_{mark}"
    left = linededup.deduplicated(docs, span_col=mark)
    words = F.size(F.filter(F.split("text", r"\s+"), lambda w: w != "")) > 0
    return _with_length(left.where((F.size(mark) == 0) | words).select(docs.columns))


@_stage
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of ten words of a benchmark item go."""
    return decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


@_stage
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids and places in sequences of at most 1024 tokens."""
    return packing.pack(docs, default_tokenizer(), capacity=1024, end_id=2, with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

#: Tokenizing and packing cannot be expressed in SQL; a plain version is in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        result, path = stage(spark, docs, sf_dir), scratch(spark, name.replace(" ", "-"))
        result.write.option("compression", "zstd").parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        discard(spark, before)
        before = [path]
    discard(spark, _worked_with)
    return docs
