"""The plans that matter at scale: what is shuffled, pushed down and broadcast."""

import pytest
from pyspark.sql import functions as F

from rentgrid.binding.listings import ALPHA, RULES, listings
from rentgrid.operators import metrics
from rentgrid.plans.marts import below_threshold, ratio_thresholds, usable_listings
from rentgrid.plans.staging import stage_single_price

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def x(spark):
    return listings(spark, FOLDER)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_staging_shuffles_once_for_the_dedup(x):
    text = plan(stage_single_price(x.raw_alpha, x.rates, ALPHA, RULES))
    assert text.count("Exchange hashpartitioning") == 1
    assert "PushedFilters: [IsNotNull(l_linestatus), EqualTo(l_linestatus,F)]" in text
    assert "l_comment" not in text


def test_fact_shuffles_no_listing(x):
    usable = usable_listings(x.listings)
    limits = x.workspace.keep(ratio_thresholds(usable), "umbral")
    kept = below_threshold(usable, limits).join(x.places, "comuna", "left").join(
        x.rates, F.col("fecha_scraping") == F.col("fecha_dt"), "left"
    )
    text = plan(kept)
    assert "hashpartitioning" not in text and "SinglePartition" not in text
    assert text.count("BroadcastHashJoin") == 3
    assert "EqualTo(superficie_categoria,valida)" in text


def test_without_room_to_broadcast_the_fact_still_comes_out(spark, x):
    """Past Spark's size limit the same joins shuffle and give the same rows."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        usable = usable_listings(x.listings)
        kept = below_threshold(usable, ratio_thresholds(usable)).join(x.places, "comuna", "left")
        assert "BroadcastHashJoin" not in plan(kept)
        assert kept.count() == x.fact.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_quantiles_shuffle_no_listing(x):
    """Listings meet the few wanted buckets by a broadcast sized from their file."""
    text = plan(ratio_thresholds(usable_listings(x.listings)))
    assert text.count("BroadcastHashJoin") == 3
    assert "hashpartitioning(fuente" not in text
    assert "ObjectHashAggregate" not in text


def test_top_k_per_place_prunes_before_the_shuffle(x):
    text = plan(metrics.top_listings_to_contact(x.fact, x.place_figures, x.places))
    assert "row_number(), 5, Partial" in text


def test_trees_are_clustered_before_rows_grow_wide(x):
    text = plan(x.raw_of("alpha", lambda day: F.array(F.date_format(day, "yyyy-MM"))))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.index("Exchange hashpartitioning") > text.rindex("BroadcastHashJoin")


def test_dedup_keeps_no_map_of_a_tasks_rows_before_the_shuffle(x):
    text = plan(stage_single_price(x.alpha_raw, x.rates, ALPHA, RULES))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.index("Exchange hashpartitioning") > text.rindex("HashAggregate")


def test_copies_across_files_shuffle_a_row_once(x):
    from rentgrid.operators.profile import copies_across_files

    text = plan(copies_across_files(x.alpha_raw.withColumn("archivo", F.lit("a")), ALPHA.columns, "archivo"))
    assert text.count("Exchange hashpartitioning") == 1


def test_tasks_of_a_group_by_hold_a_bounded_number_of_rows(spark, monkeypatch):
    from rentgrid.sources import workspace

    monkeypatch.setattr(workspace, "ROWS_AT_ONCE", 100)
    rows = spark.range(1000).select((F.col("id") % 700).alias("k"), F.when(F.col("id") % 2 == 0, "x").alias("v"))
    spread = workspace.spread(rows, ["k", "v"])
    assert spread.rdd.getNumPartitions() == 10
    assert spread.distinct().count() == rows.distinct().count() == 700
    assert workspace.spread(rows.limit(0), ["k"]).count() == 0
    monkeypatch.setattr(workspace, "ROWS_AT_ONCE", 600_000)
    assert workspace.spread(rows, ["k"]).rdd.getNumPartitions() == 2
