"""Checks must find planted faults; profiles must count by hand-checked figures."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from listing_data import first
from rentgrid.operators import anomalies as an
from rentgrid.operators import profile as pf
from rentgrid.operators import quality as q
from rentgrid.sources.workspace import Workspace, shared_folder


def bad(check):
    return {r.check_name: r.n_bad for r in q.report(check).collect()}


def test_row_balance_checks(spark):
    a, b, big = spark.range(3), spark.range(2), spark.range(6)
    assert bad(q.union_row_conservation([a, b], spark.range(5))) == {"union_row_conservation": 0}
    assert bad(q.union_row_conservation([a, b], big)) == {"union_row_conservation": 1}
    assert bad(q.fact_not_larger(a, big)) == {"fact_not_larger": 0}
    assert bad(q.fact_not_larger(big, a)) == {"fact_not_larger": 3}
    assert bad(q.tables_non_empty({"x": a, "y": spark.range(0)})) == {
        "tables_non_empty:x": 0, "tables_non_empty:y": 1,
    }


def test_key_and_region_checks(spark):
    dim = spark.createDataFrame([(1, "A", "r"), (1, "B", "s")], "comuna_id long, comuna string, region string")
    assert bad(q.dimension_key_unique(dim, "comuna_id")) == {"dimension_key_unique": 1}
    two = spark.createDataFrame([("A", "r"), ("A", "s"), (None, "t")], "comuna string, region string")
    assert bad(q.one_region_per_place(two)) == {"one_region_per_place": 1}
    days = spark.createDataFrame([(date(2023, 1, 1), 1.0)] * 2, "fecha_dt date, valor_uf double")
    assert bad(q.rate_date_unique(days)) == {"rate_date_unique": 1}


def test_sentinel_consistency(spark):
    rows = [("centinela", 3.0, None), ("habitacion", None, 5), ("valida", None, None)]
    df = spark.createDataFrame(rows, "superficie_categoria string, superficie_m2 double, precio_clp long")
    assert bad(q.sentinel_consistency(df)) == {
        "sentinel_with_area": 1, "room_without_area": 1, "sentinel_without_price": 1,
    }


def test_calendar_covers(spark):
    fact = spark.createDataFrame([(date(2024, 1, 1),)] * 3 + [(date(2030, 1, 1),)] * 2, "d date")
    calendar = spark.createDataFrame([(date(2024, 1, 1),)], "fecha date")
    assert bad(q.calendar_covers(fact, calendar, "d")) == {"calendar_covers:d": 2}


def test_enforce_lists_failures_and_honours_tolerance(spark):
    checks = q.report(q.tables_non_empty({"x": spark.range(0), "y": spark.range(1)}))
    with pytest.raises(q.QualityError, match="tables_non_empty:x=1"):
        q.enforce(checks)
    q.enforce(checks, {"tables_non_empty:x"})


def test_known_rows_absent(spark):
    rows = [("x", "a"), ("x", "b"), ("x", "b"), ("y", "b"), (None, "b"), ("y", None)]
    fact = spark.createDataFrame(rows, "fuente string, id string")
    known = spark.createDataFrame([("x", "b"), ("x", "c"), ("y", "c"), ("z", "a"), ("y", None)], "fuente string, id string")
    assert bad(q.known_rows_absent(fact, known)) == {"known_rows_absent": 2}
    assert sorted(map(tuple, q.known_presence(fact, known).collect())) == [("x", 2, 1, 2), ("y", 2, 0, 0), ("z", 1, 0, 0)]
    assert bad(q.known_rows_absent(fact, known.limit(0))) == {"known_rows_absent": 0}


def test_a_large_fact_is_filtered_by_a_bloom_filter_of_the_known_ids(spark):
    """Spark adds it by size; here its size limits are lowered."""
    with Workspace(spark) as w:
        key = F.concat(F.lit("id-"), F.col("id")).alias("id")
        fact = w.keep(spark.range(20_000).select(F.lit("x").alias("fuente"), key), "fact")
        known = w.keep(spark.range(50).select(F.lit("x").alias("fuente"), key).where("id not in ('id-3')"), "known")
        settings = {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
        }
        before = {k: spark.conf.get(k) for k in settings}
        for k, v in settings.items():
            spark.conf.set(k, v)
        try:
            check = q.known_rows_absent(fact, known)
            assert "might_contain" in check._jdf.queryExecution().optimizedPlan().toString()
            assert check.first().n_bad == 49
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)


def test_pair_figures_equal_the_joined_ones(spark):
    """Per-key sums give what the join over all pairs would."""
    fact = spark.createDataFrame(
        [("a", "1", 2.0), ("a", "1", 4.0), ("a", "2", None), ("a", "3", 0.0), ("b", "1", 5.0)],
        "fuente string, id string, precio_uf_oficial double",
    )
    staged = spark.createDataFrame(
        [("a", "1", 3.0, "D"), ("a", "1", None, "D"), ("a", "1", 5.0, "C"), ("a", "2", 1.0, "D"),
         ("a", "3", 1.0, "D"), ("b", "1", 4.0, "D"), ("b", "9", 4.0, "D")],
        "fuente string, id string, precio_uf double, tipo string",
    )
    pairs = fact.join(staged, ["fuente", "id"])
    gap = F.try_divide(F.col("precio_uf") - F.col("precio_uf_oficial"), F.col("precio_uf_oficial"))
    want = pairs.where("precio_uf IS NOT NULL").groupBy("fuente").agg(F.round(F.avg(gap * 100), 2))
    got = q.indexed_price_gap(fact, staged)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    want = pairs.groupBy("tipo").count()
    got = q.constant_dimensions(fact, staged, ["tipo"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_copies_keys_and_collisions(spark, work):
    raw = first(spark, {}, {}, {"precio": "1"}, {"id": "A-2"}, {"id": "A-3", "comuna": None}, {"id": None}, {"id": None})
    rows = pf.collapsed(raw, raw.columns, work)
    assert rows.count() == 5 and rows.agg(F.sum("_n")).first()[0] == 7
    assert pf.exact_duplicate_count(rows).first()[0] == 2
    assert tuple(pf.duplicate_key_count(rows, "id").first()) == (7, 3, 4)
    most = dict(map(tuple, pf.key_collisions(rows, "id", ["precio", "comuna"]).collect()))
    assert most == {"precio": 2, "comuna": 1}
    other = first(spark, {}, {"id": "A-2"})
    alone = pf.key_collisions(pf.collapsed(other, other.columns, work), "id", ["precio"])
    assert list(map(tuple, alone.collect())) == [("precio", 0)]
    empty = pf.collapsed(raw.limit(0), raw.columns, work)
    assert pf.exact_duplicate_count(empty).first()[0] == 0
    assert tuple(pf.duplicate_key_count(empty, "id").first()) == (0, 0, 0)


def test_copies_follow_without_another_shuffle_of_the_source(spark, work):
    raw = work.keep(first(spark, {}, {}), "raw")
    plan = pf.exact_duplicate_count(pf.collapsed(raw, raw.columns, work))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "ReadSchema: struct<_n:bigint>" in plan


def test_copies_inside_and_between_files(spark):
    rows = [("a", None, "f1"), ("a", None, "f1"), ("a", None, "f2"), ("b", "1", "f1"), ("b", "1", "f2"), ("b", "1", "f3"),
            ("c", "1", "f1"), ("c", "1", None), ("d", "1", "f2"), ("d", "1", "f2")]
    df = spark.createDataFrame(rows, "x string, y string, archivo string")
    got = pf.copies_across_files(df, ["x", "y"], "archivo").first().asDict()
    assert got == {"n_filas": 10, "n_distintas": 4, "n_exactos": 2, "n_entre_archivos": 4, "n_filas_repartidas": 3}
    assert set(pf.copies_across_files(df.limit(0), ["x", "y"], "archivo").first()) == {0}


@pytest.fixture(scope="module")
def work(spark):
    with Workspace(spark) as w:
        yield w


def test_profiles_tolerate_bad_values(spark):
    raw = first(spark, {"precio": "abc", "fecha_scraping": "nope"}, {"precio": "-1"}, {"comuna": "x"})
    dates = {r.columna: r for r in pf.date_profile(raw, ["fecha_scraping"]).collect()}
    assert dates["fecha_scraping"].n_sin_parsear == 1
    assert dict(map(tuple, pf.nonpositive_counts(raw, ["precio"]).collect())) == {"precio": 1}
    assert tuple(pf.strip_profile(raw, "comuna").first()) == ("comuna", 2, 1, 2)
    nulls = {r.columna: (r.n_nulos, r.pct_nulos) for r in pf.null_profile(raw, ["comuna"]).collect()}
    assert nulls == {"comuna": (0, 0.0)}


def test_describe_and_tail(spark):
    raw = first(spark, *({"id": str(i), "precio": str(i), "divisa": "UF"} for i in range(1, 102)))
    row = pf.describe_numeric(raw, ["precio"], ["divisa"]).first()
    assert (row.n, row.media, row.minimo, row.q25, row.q50, row.q75, row.maximo) == (
        101, 51.0, 1.0, 26.0, 51.0, 76.0, 101.0
    )
    tail = pf.tail_report(raw, ["precio"], 0.9, Workspace(spark), "divisa").first()
    assert tuple(tail) == ("precio", "UF", 91.0, 101.0, 10)


def test_describe_several_columns_like_spark_itself(spark):
    values = ["1", "2.5", "-7", "-7", "1e9", "1e9", "abc", None, "NaN", "0", "-0.0", "1000000000.25"]
    rows = [{"id": str(i), "precio": v, "superficie_m2": str(i), "divisa": "UF" if i % 3 else None} for i, v in enumerate(values)]
    raw = first(spark, *rows, {"precio": None, "superficie_m2": None, "divisa": "USD"}, {"precio": "4", "superficie_m2": "x", "divisa": "CLP"})
    got = pf.describe_numeric(raw, ["precio", "superficie_m2"], ["divisa"])
    for column in ("precio", "superficie_m2"):
        v = pf.number(column)
        want = raw.groupBy("divisa").agg(
            F.count(v), F.avg(v), F.stddev_samp(v), F.min(v), *(F.percentile(v, p) for p in (0.25, 0.5, 0.75)), F.max(v)
        )
        want = {r[0]: tuple(r)[1:] for r in want.collect()}
        found = {r.divisa: tuple(r)[2:] for r in got.where(F.col("columna") == column).collect()}
        assert found.keys() == want.keys()
        for key, row in want.items():
            assert [x is None for x in found[key]] == [x is None for x in row]
            assert [x for x in found[key] if x is not None] == pytest.approx([x for x in row if x is not None], rel=1e-12)
    whole = {r.columna: r for r in pf.describe_numeric(raw, ["precio", "superficie_m2"]).collect()}
    assert whole["precio"].n == 10 and whole["superficie_m2"].n == 12
    assert pf.describe_numeric(raw.limit(0), ["precio"]).count() == 0


def test_spikes_of_a_table_of_suspects(spark, work):
    import random

    rng = random.Random(8)
    areas = [str(round(rng.uniform(0, 60), rng.choice([0, 0, 1, 2]))) for _ in range(900)] + ["25"] * 500 + ["abc", None, "-3.5"]
    suspects = [(5.0, 0.5), (25.0, 2.0), (25.0, 2.0), (25.5, 2.0), (999.0, 2.0), (-3.5, 0.1), (30.0, 7.5), (None, 1.0), (1.0, 0.0)]
    suspects += [(float(i) + 0.25, 0.5 + i % 3) for i in range(0, 60, 7)]
    df = spark.createDataFrame([(a,) for a in areas], "area string")
    got = an.spike_test_of(df, "area", spark.createDataFrame(suspects, "valor double, alcance double"), work)
    found = {r.valor: (r.n_exacto, r.n_vecinos) for r in got.collect()}
    numbers = [float(a) for a in areas if a not in ("abc", None)]
    want = {
        v: (numbers.count(v), sum(v - r <= a <= v + r and a != v for a in numbers)) for v, r in suspects if v is not None and r > 0
    }
    assert found == want and want[999.0] == (0, 0) and want[25.0][0] >= 500
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    none = spark.createDataFrame([], "valor double, alcance double")
    assert an.spike_test_of(df, "area", none, work).count() == 0


def test_spikes_and_neighbours(spark):
    areas = [5.0, 5.0, 5.4, 5.6, 250.0, 251.9, 248.0, 253.0]
    df = spark.createDataFrame([(a,) for a in areas], "area double")
    got = {r.valor: (r.n_exacto, r.n_vecinos) for r in an.spike_test(df, "area", [5, 250, 999]).collect()}
    assert got == {5.0: (2, 1), 250.0: (1, 2), 999.0: (0, 0)}


def test_top_rows_are_deterministic(spark):
    raw = first(spark, *({"id": f"A-{i}", "precio": str(100 + i // 2)} for i in range(10)))
    top = an.top_by_price(raw, "precio", ["id"], 3, ["id"])
    assert [r.id for r in top.collect()] == ["A-8", "A-9", "A-6"]
    ratio = an.top_by_ratio(raw, "precio", "superficie_m2", 4, ["id"])
    assert [tuple(r) for r in an.area_distribution(ratio).collect()] == [(50.0, 4)]


def test_workspace_uses_the_shared_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    workspace = Workspace(spark)
    assert workspace.keep(spark.range(7), "seven").count() == 7
    assert workspace.root.startswith(configured or shared_folder(spark))
    assert shared_folder(spark) == shared_folder(spark)


def test_shared_folder_is_the_named_one_or_below_the_warehouse():
    class Context:
        master = "yarn"

    class Session:
        conf = {"spark.sql.warehouse.dir": "s3a://b/warehouse/"}
        sparkContext = Context

    assert shared_folder(Session) == "s3a://b/warehouse/_work"
    Session.conf["spark.checkpoint.dir"] = "hdfs://x/work/"
    assert shared_folder(Session) == "hdfs://x/work"
    del Session.conf["spark.checkpoint.dir"]
    Session.conf["spark.sql.warehouse.dir"] = "file:/home/me/spark-warehouse"  # Spark's default
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session)
    Context.master = "local[4]"
    assert shared_folder(Session) == "file:/home/me/spark-warehouse/_work"
