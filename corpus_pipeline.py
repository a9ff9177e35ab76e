"""From raw documents to token files: quality, near copies, leaks, mixture, tokens.

Every stage but the last returns the columns of ``documents`` as they came, in their
order. Columns that are not named here pass through. An empty table passes through.
Every stage writes its documents and returns that table; whole texts go to tasks in small batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentgrid.llm import quality_gam, queries
from rentgrid.llm.decontaminate import contamination
from rentgrid.llm.jaccard_join import near_duplicates
from rentgrid.llm.raking import mix
from rentgrid.llm.shared import keep, small_batches
from rentgrid.llm.token_files import read_documents, write_token_files


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. Null and empty texts are scored like any other."""
    with small_batches(spark):
        model = queries.quality_model(docs, _table(spark, sf_dir, "labels"))
        scored = quality_gam.score(docs, model)
        return keep(scored.where(F.col("score") >= queries.PREDICT_AT).select("row.*"), "quality")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, that of the smallest id.

    Rows without an id, and texts without words, stay. Of repeated rows of one id and text
    one stays; an id of several texts stays if one of them does.
    """
    found = near_duplicates(docs).groupBy("id").agg(
        F.max("component_id").alias("c"), F.count("*").alias("n")
    ).where("id is not null")
    marked = keep(found.where("c < id or n > 1").select(F.col("id").alias("_id"), (F.col("c") < F.col("id")).alias("_gone")), "marked")
    same = docs["doc_id"] == marked["_id"]
    left = docs.join(marked.where("_gone"), same, "left_anti")
    repeated = marked.where("not _gone")
    if repeated.isEmpty():
        return keep(left, "near_copies")
    again = left.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return keep(left.join(repeated, same, "left_anti").unionByName(again), "near_copies")


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts; a text of nothing else goes."""
    found = contamination(docs, _table(spark, sf_dir, "benchmark"))
    rest = found.where((F.col("n_hit") == 0) | (F.col("n_hit") < F.col("n_words")))
    new = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("n_hit") > 0, F.length("clean")).otherwise(F.col("row.n_chars")).cast(
            docs.schema["n_chars"].dataType
        )
    with small_batches(spark):
        return keep(rest.select(*(new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns)), "leaks")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens meet the raked shares of source, language and topic."""
    return keep(mix(docs).where("kept").select("row.*"), "mixture")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files of all documents, and what is read back from them per document."""
    return read_documents(write_token_files(docs, queries.tokenizer_path(), queries.END_ID))


STAGES = [
    ("quality", quality), ("near_copies", near_copies), ("leaks", leaks), ("mixture", mixture), ("tokens", tokens),
]
ORACLE_SQL = None  # trained model and tokenizer: see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
