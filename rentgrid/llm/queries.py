"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ngram_trie, oracle, quality_gam, toxicity_fm
from .chat_repair import formatted
from .decontaminate import contamination
from .jaccard_join import near_duplicates
from .labels import held_out
from .learned_partitions import nearest
from .licence_texts import TEMPLATES
from .licenses import THRESHOLD, licenses
from .near_vectors import near_vectors
from .periodic_runs import periodic_runs
from .raking import DIMENSIONS, mix
from .structure_repair import fingerprints, repaired
from .token_files import read_documents, write_token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")

PREDICT_AT = 0.3


def _classified(found: DataFrame, out: Column) -> DataFrame:
    return found.select(
        "row.doc_id", out.alias("held_out"), "score", (F.col("score") >= PREDICT_AT).cast("int").alias("predicted")
    )


def quality_model(docs: DataFrame, labels: DataFrame) -> quality_gam.Gam:
    return quality_gam.train(docs, labels, learn=lambda c: ~held_out(c, 5, 0))


@query()
def op3_quality_gam(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = quality_model(docs, _table(spark, folder, "labels"))
    return _classified(quality_gam.score(docs, model, with_text=False), held_out(F.col("row.doc_id"), 5, 0))


@query(oracle.VECTORS)
def op2_inverted_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(_table(spark, folder, "embeddings"))


@query()
def op4_ngram_trie(spark: SparkSession, folder: str) -> DataFrame:
    out = held_out(F.col("doc_id"), 7, 2)
    found = ngram_trie.scores(_table(spark, folder, "documents").select("doc_id", "text"), ~out)
    return found.select(
        F.col("id").alias("doc_id"), (~F.col("learnt")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score",
    )


@query(oracle.MIXED)
def op5_source_raking(spark: SparkSession, folder: str) -> DataFrame:
    found = mix(_table(spark, folder, "documents").select("doc_id", "text", "source", "lang"))
    return found.select(
        "row.doc_id", *DIMENSIONS, "n_tokens", F.round("factor", 6).alias("factor"),
        F.round("probability", 6).alias("probability"), "kept",
    )


@query()
def op6_toxicity_fm(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity_fm.train(docs, _table(spark, folder, "labels"), learn=lambda c: ~held_out(c, 4, 2))
    return _classified(toxicity_fm.score(docs, model, with_text=False), held_out(F.col("row.doc_id"), 4, 2))


@query(oracle.JACCARD)
def op7_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(_table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")

END_ID = 2


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return read_documents(write_token_files(docs, tokenizer_path(), END_ID))


@query(oracle.LEAKS)
def op8_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = contamination(docs, _table(spark, folder, "benchmark"), texts=False)
    return found.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query()
def op9_chat_repair(spark: SparkSession, folder: str) -> DataFrame:
    return formatted(_table(spark, folder, "conversations"))


@query(oracle.licensed(TEMPLATES, THRESHOLD))
def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses(_table(spark, folder, "documents").select("doc_id", "text"))
    names = F.array_sort(F.array_distinct("found.license"))
    return found.select(
        "row.doc_id", F.size("found").cast("long").alias("n_matches"), F.array_join(names, ",").alias("licenses"),
        F.round(F.array_max("found.dice"), 6).alias("best_dice"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Turns dropped, emptied, cut, repeated or given to the user, by a hash of their place."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace(spaced("text"), "[.!?]", ""))
    rows = turns.select("*", h.alias("h")).where("h <> 0").select(
        "conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(spaced("role")).alias("role"),
        text.otherwise(spaced("text")).alias("text"), "h",
    )
    copies = F.when(F.col("h") == 3, 2).otherwise(1)
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("h", "copy")


EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


@query(oracle.STRUCTURE)
def op11_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    found = repaired(damaged(turns))
    texts = fingerprints(found.turns).withColumnRenamed("conv_id", "_id")
    every = turns.select(F.col("conv_id").alias("_conv")).distinct()
    report = found.report
    out = every.join(report, every["_conv"].eqNullSafe(report["conv_id"]), "left").drop("conv_id")
    out = out.join(texts, out["_conv"].eqNullSafe(texts["_id"]), "left")
    figures = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select(
        F.col("_conv").alias("conv_id"), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in figures),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"),
    )


def looped(id: Column, text: Column) -> Column:
    """The text of every tenth id with its words from a place on replaced by a loop."""
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"))
    h = F.crc32(id.cast("string").cast("binary"))

    def loop(w: Column) -> Column:
        n, g = F.size(w), F.floor(h / 10)
        a = g % n
        p = F.floor((n - a) / (g % 8 + 3)) + 1
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, place(i).cast("int")))

    made = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, F.array_join(loop(w), " ")).otherwise(""))
    return F.when((h % 10 == 0) & text.isNotNull(), made[0]).otherwise(text)


@query(oracle.RUNS)
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = periodic_runs(docs.withColumn("text", looped(F.col("doc_id"), F.col("text"))))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("n"), (-r.start).alias("s"), (-r.period).alias("p"))))
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r.start, r.length, r.period))
    out = found.select("row.doc_id", "runs", "collapsed", longest.alias("best"))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"),
        F.col("best.n").alias("length"), (-F.col("best.p")).alias("period"),
        F.expr("(1000 * best.n) div -best.p").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query()
def op13_learned_partitions(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(_table(spark, folder, "embeddings"), asks=lambda id: id % 20 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
