"""The corpus pipeline: five operators, one after another, over the documents.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; what it decides takes
effect. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podwatch.llm.decontaminate import contaminated
from podwatch.llm.line_dedup import line_dedup
from podwatch.llm.near_dedup import near_duplicates
from podwatch.llm.packing import packed
from podwatch.llm.quality import quality_scores
from podwatch.llm.queries import op10_columns, table, tokenizer_path
from podwatch.llm.scratch import Scratch


# Ids that are sent to every executor instead of shuffling the texts, some 100 MB there. Beyond, a join shuffles.
BROADCAST_IDS = 2_000_000


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents but those whose doc_id is in ``ids``; a document without doc_id stays."""
    ids = Scratch(docs.sparkSession, "without").written(ids.select(F.col("doc_id").alias("gone")).distinct(), "ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, docs["doc_id"] == ids["gone"], "left_anti")


def _wrapped(docs: DataFrame) -> DataFrame:
    """doc_id, text and the whole row, so that no column of the documents clashes with an operator's."""
    return docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    scores = quality_scores(_wrapped(docs), table(spark, sf_dir, "labels"), keep_text=True)
    return scores.where("predicted = 1").select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that others hold; n_chars follows the text."""
    found = line_dedup(_wrapped(docs)).select("row.*", F.col("kept_text").alias("kept text of the row"))
    of = {"text": F.col("`kept text of the row`"), "n_chars": F.length("`kept text of the row`").cast("long")}
    return found.select(*(of.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest doc_id."""
    return _without(docs, near_duplicates(docs).where("not kept"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return _without(docs, contaminated(docs, table(spark, sf_dir, "benchmark")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    return op10_columns(packed(docs, tokenizer_path("byte_bpe_50k.json")))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("packing", packing),
]

# Minimum hashing, a fitted model and a tokenizer: tested against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.written(stage(spark, docs, sf_dir), name)
        if k:
            scratch.drop(STAGES[k - 1][0])
    return docs
