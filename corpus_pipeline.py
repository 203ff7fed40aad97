"""From raw documents to packed training sequences, stage by stage.

Each stage calls one operator on the stored rows of the stage before. All but the last
return the columns that documents have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm.common import stored
from tillstar.llm.mixing import mix
from tillstar.llm.nbsvm import THRESHOLD, fit, score
from tillstar.llm.queries import packed
from tillstar.llm.secret_scan import scan_secrets
from tillstar.llm.simhash import keep_one, near_duplicates
from tillstar.shared import scratch


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score(docs, fit(docs, labels), into="__score")
    return scored.where(F.col("__score") >= THRESHOLD).drop("__score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return keep_one(docs, near_duplicates(docs))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret becomes its kind in brackets; no document goes."""
    masked = scan_secrets(docs, into="__spans", mask=True)
    length = F.when(F.size("__spans") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", length.cast("long")).drop("__spans")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for."""
    return mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document with its token ids and its place in a sequence."""
    return packed(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

# SQL has neither the learned model nor the 64-bit hash; tests hold the stages against
# brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents.

    The result is read from tables in the shared folder, which stay there: ``write`` stores
    it and removes them.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage{k}")
    return docs


def write(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Store the result as Parquet; nothing of the run stays in the shared folder."""
    with scratch(spark):
        run(spark, sf_dir).write.parquet(path)
