"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed per cell (source, language, topic). Each round scales the cells so that
the token totals of one dimension after the other meet that dimension's target shares
(raking). A document's probability is its cell's factor over the largest factor, so the
expected token shares of the sample are the raked ones, and no document is repeated. The
draw is a hash of the document's id: the same on every run and after lost executors.

Documents are aggregated to cells with map-side combine, so a source of a third of all
rows is a few rows per task. Rounds work on cells only; each step's cells are written, so
plans stay small, and the join of factors to documents is sized by Spark from that table.

Null values of a dimension are a value of their own. Null and empty texts have no tokens
and take their cell's factor; a value without tokens has factor 1. Rows of one id share
their fate. An empty table gives no rows. Target shares of values that do not occur are
spread over the others; values without a target keep their own share of what is left.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import keep, release_shuffles

ROUNDS = 8
# Target shares are present shares to these powers: a large source gives way to small
# ones, while the mix of languages and topics stays what it is.
POWERS = {"source": 0.85}
DIMENSIONS = ("source", "lang", "topic")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def form_topic(text: Column) -> Column:
    """A topic by a text's form, where documents carry none."""
    return (
        F.when(text.isNull() | (text == ""), "empty").when(text.contains(" | "), "tables")
        .when(text.contains("http") | text.contains("@"), "links").when(text.contains("?"), "questions")
        .when(text.rlike("[0-9]{4}"), "figures").when(F.length(text) > 6000, "long").otherwise("prose")
    )


def tempered(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """Target shares in proportion to the present token share to a power: ``value, share``."""
    by = cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("m").cast("double").alias("t"))
    by = by.select("value", F.pow("t", F.lit(power)).alias("p"))
    total = by.agg(F.sum("p")).first()[0] or 1.0
    return by.select("value", (F.col("p") / total).alias("share"))


def fixed(cells: DataFrame, dimension: str, shares: Mapping[str, float]) -> DataFrame:
    """Given target shares: ``value, share``."""
    spark = cells.sparkSession
    wanted = spark.createDataFrame([(k, float(v)) for k, v in shares.items()], "wanted string, w double")
    by = cells.groupBy(F.col(dimension).cast("string").alias("value")).agg(F.sum("m").cast("double").alias("t"))
    both = by.join(wanted, F.col("value").eqNullSafe(F.col("wanted")), "left")
    own = F.when(F.col("w").isNull(), F.col("t"))
    free, given = both.agg(F.coalesce(F.sum(own), F.lit(0.0)), F.coalesce(F.sum("w"), F.lit(0.0))).first()
    left = max(0.0, 1 - given)
    share = F.coalesce(F.col("w"), F.col("t") / (free or 1.0) * left)
    return both.select("value", (share / ((given + left if free else given) or 1.0)).alias("share"))


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (dimensions, tokens ``m``) with ``factor``: every cell's tokens are multiplied by it."""
    now = keep(cells.select(*targets, "m", F.lit(1.0).alias("factor")), "cells")
    total = now.agg(F.coalesce(F.sum("m"), F.lit(0))).first()[0]
    shares = {d: keep(t.select(F.col("value").alias("_v"), (F.col("share") * float(total)).alias("_t")), "targets") for d, t in targets.items()}
    for _ in range(rounds):
        for d, target in shares.items():
            sums = now.groupBy(F.col(d).alias("_v")).agg(F.sum(F.col("m") * F.col("factor")).alias("_s"))
            steps = sums.join(target, sums["_v"].eqNullSafe(target["_v"])).select(
                sums["_v"], F.when(F.col("_s") > 0, F.col("_t") / F.col("_s")).otherwise(1.0).alias("_f")
            )
            scaled = now.join(steps, now[d].eqNullSafe(steps["_v"]))
            # each step's plan is small and dropped with it
            now = keep(scaled.select(*targets, "m", (F.col("factor") * F.col("_f")).alias("factor")), "cells")
    release_shuffles(now.sparkSession)
    return now


def draw(id: Column) -> Column:
    """A uniform number in [0, 1) that belongs to an id: 52 bits of its MD5."""
    digits = F.substring(F.md5(F.coalesce(id.cast("string"), F.lit("")).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / float(16**13)


def mix(
    docs: DataFrame, id: str = "doc_id", text: str = "text", dimensions: Mapping[str, Column] | None = None,
    powers: Mapping[str, float] = POWERS, shares: Mapping[str, Mapping[str, float]] | None = None, rounds: int = ROUNDS,
) -> DataFrame:
    """``row`` (struct of all input columns), dimensions, ``n_tokens``, ``factor``, ``probability``, ``kept``.

    ``dimensions``: name -> expression on ``docs``; by default its source and language,
    and the topic of its form. Targets are ``shares`` where given, else tempered ones.
    """
    dimensions = dict(dimensions or {"source": docs["source"], "lang": docs["lang"], "topic": form_topic(docs[text])})
    sized = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        *(e.cast("string").alias(d) for d, e in dimensions.items()), n_words(docs[text]).alias("n_tokens"),
    )
    cells = keep(sized.groupBy(*dimensions).agg(F.sum("n_tokens").alias("m")), "cells")
    given = shares or {}
    targets = {d: fixed(cells, d, given[d]) if d in given else tempered(cells, d, powers.get(d, 1.0)) for d in dimensions}
    raked = rake(cells, targets, rounds)
    top = raked.where("m > 0").agg(F.max("factor")).first()[0] or 1.0
    # a cell without tokens may lie above the largest that has some
    p = F.least(F.lit(1.0), F.col("factor") / F.lit(top))
    ready = keep(raked.select(*(F.col(d).alias(f"_{d}") for d in dimensions), "factor", p.alias("probability")), "factors")
    same = [sized[d].eqNullSafe(ready[f"_{d}"]) for d in dimensions]
    return sized.join(ready, same).select(
        "row", *dimensions, "n_tokens", "factor", "probability", (draw(F.col(f"row.{id}")) < F.col("probability")).alias("kept")
    )
