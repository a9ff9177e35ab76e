"""CSV trees, payloads, tables, and the pipeline on small generated files."""

import json
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from listing_data import FIRST, SECOND
from rentgrid.config import Namespaces, PipelineConfig
from rentgrid.operators import quality as q
from rentgrid.sources.snapshots import Manifest, RunTables
from rentgrid.plans.pipeline import land_rate_series, run
from rentgrid.sources import csv_tree, rates, tables

MONTHS = [f"2023-{m:02d}" for m in range(1, 13)]


def write_source(root, source, months=MONTHS, header=None, place="  las   condes "):
    for month in months:
        folder = root / source.name / month[:4]
        folder.mkdir(parents=True, exist_ok=True)
        lines = [",".join(header or source.columns)]
        for i in range(4):
            values = dict(
                id=f"{source.name}-{month}-{i}", fuente=source.name, comuna=place, region="RM",
                precio=str(500_000 + i), divisa="CLP", superficie_m2="44.3",
                precio_clp=str(600_000 + i), precio_uf="17.2", superficie_total_m2="51.5",
                fecha_publicacion=f"{month}-01", fecha_scraping=f"{month}-15",
                tipo_propiedad="departamento", tipo_operacion="arriendo",
                contact_type="owner_direct" if i else "",
            )
            lines.append(",".join(values[c] for c in source.columns))
        lines.append(lines[-1])  # an exact copy
        (folder / f"{month}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")


def write_rates(root, days=365):
    root.mkdir(parents=True, exist_ok=True)
    points = [
        {"fecha": f"{date(2023, 1, 1) + timedelta(days=i)}T03:00:00.000Z", "valor": 35000.0 + i}
        for i in range(days)
    ]
    (root / "2023.json").write_text(json.dumps({"serie": points}), encoding="utf-8")


def config(root, warehouse, **changes):
    return PipelineConfig(
        raw_root=str(root), warehouse=str(warehouse), first=FIRST, second=SECOND,
        expected_years=(2023,), namespaces=Namespaces("t_raw", "t_staging", "t_marts"), **changes
    )


@pytest.fixture
def landing(spark, tmp_path):
    for source in (FIRST, SECOND):
        write_source(tmp_path / "raw", source)
    write_rates(tmp_path / "payloads")
    land_rate_series(spark, str(tmp_path / "payloads"), str(tmp_path / "raw" / "uf"), (2023,))
    return tmp_path


def test_scan_keeps_strings_and_files(spark, landing):
    raw = csv_tree.with_source_file(
        csv_tree.scan_csv_tree(spark, f"{landing}/raw/{FIRST.name}", FIRST.columns)
    )
    assert raw.count() == 60
    assert {t for n, t in raw.dtypes if n in FIRST.columns} == {"string"}
    row = raw.where("archivo_origen = '2023-03.csv'").first()
    assert (row.periodo_archivo, row.comuna) == ("2023-03", "  las   condes ")
    assert raw.where("contact_type IS NULL").count() == 12


def test_no_files_fails(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        csv_tree.scan_csv_tree(spark, str(tmp_path / "empty"))


def test_missing_column_fails(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id,fuente\n1,a\n")
    with pytest.raises(ValueError, match="comuna"):
        csv_tree.scan_csv_tree(spark, str(tmp_path), ["id", "comuna"])


def test_moved_columns_fail(spark, tmp_path):
    write_source(tmp_path, FIRST, MONTHS[:1])
    moved = [FIRST.columns[1], FIRST.columns[0], *FIRST.columns[2:]]
    write_source(tmp_path, FIRST, MONTHS[1:2], header=moved)
    with pytest.raises(Exception, match="(?i)header"):
        csv_tree.scan_csv_tree(spark, f"{tmp_path}/{FIRST.name}").collect()


def test_inventory_names_the_missing_month(spark, tmp_path):
    write_source(tmp_path, FIRST)
    write_source(tmp_path, SECOND, [m for m in MONTHS if m != "2023-07"])
    folders = {s.name: f"{tmp_path}/{s.name}" for s in (FIRST, SECOND)}
    missing = csv_tree.file_inventory(spark, folders, [2023]).collect()
    assert [tuple(r) for r in missing] == [(SECOND.name, "2023-07")]
    assert csv_tree.file_inventory(spark, folders, [2023, 2024]).count() == 25


def test_payload_checks(spark):
    good = json.dumps({"serie": [{"fecha": "2023-01-01T03:00:00Z", "valor": 1.5}]})
    bad = json.dumps({"serie": [{"fecha": "x", "valor": None}]})
    payloads = spark.createDataFrame([(good,), (bad,), ("{}",), ('{"serie": []}',)], "payload string")
    got = {r.check_name: r.n_bad for r in q.report(q.payload_quality(payloads)).collect()}
    assert got == {"payload_without_series": 2, "payload_bad_date": 1, "payload_null_value": 1}
    assert rates.flatten_payloads(payloads).count() == 2


def test_short_year_is_refused(spark, tmp_path):
    write_rates(tmp_path / "payloads", days=300)
    with pytest.raises(q.QualityError, match="year_coverage"):
        land_rate_series(spark, str(tmp_path / "payloads"), str(tmp_path / "uf"), (2023,))


def test_absent_year_is_refused(spark, tmp_path):
    write_rates(tmp_path / "payloads")
    with pytest.raises(q.QualityError, match="year_coverage"):
        land_rate_series(spark, str(tmp_path / "payloads"), str(tmp_path / "uf"), (2023, 2024))


def test_overwrite_table_is_idempotent(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_over")
    df = spark.range(5)
    for _ in range(2):
        tables.overwrite_table(df, "t_over", "numbers")
    assert tables.loaded_row_count(tables.scan_table(spark, "t_over", "numbers")) == 5


def test_pipeline_publishes_all_layers(spark, landing):
    cfg = config(landing / "raw", landing / "warehouse")
    for _ in range(2):  # a second run replaces, never adds
        run(spark, cfg)
    count = lambda ns, name: tables.scan_table(spark, ns, name).count()
    assert count("t_raw", FIRST.name) == 60
    assert count("t_staging", f"stg_{FIRST.name}") == 48
    assert count("t_staging", "stg_arriendos") == 96
    assert count("t_marts", "dim_comuna") == 1
    assert count("t_marts", "dim_calendario") == 1096
    fact = tables.scan_table(spark, "t_marts", "fct_arriendos")
    assert 0 < fact.count() <= 96
    assert fact.where(F.col("precio_uf_oficial").isNull()).count() == 0
    assert fact.columns == [
        "id", "fuente", "comuna_id", "contact_type", "superficie_m2", "fecha_publicacion",
        "fecha_scraping", "precio_clp", "precio_uf_oficial",
    ]


def test_failed_check_keeps_the_last_tables(spark, landing):
    cfg = config(landing / "raw", landing / "warehouse")
    run(spark, cfg)
    before = tables.scan_table(spark, "t_marts", "fct_arriendos").count()
    # listings of a month the rates do not cover: the fact would have NULL prices
    file = landing / "raw" / FIRST.name / "2023" / "2023-05.csv"
    file.write_text(file.read_text().replace("2023-05-15", "2024-05-15"))
    with pytest.raises(q.QualityError, match="no_null_prices:precio_uf_oficial=4"):
        run(spark, cfg)
    assert tables.scan_table(spark, "t_marts", "fct_arriendos").count() == before


def tables_of(spark):
    """What readers of the published names see, all layers."""
    names = {"t_raw": [FIRST.name, "uf"], "t_staging": ["stg_arriendos"], "t_marts": ["dim_comuna", "dim_calendario", "fct_arriendos"]}
    return {
        n: sorted(map(str, tables.scan_table(spark, ns, n).collect())) for ns, each in names.items() for n in each
    }


def snapshots_in(folder):
    return {p.name for p in folder.rglob("snapshot=*")}


def dearer(landing):
    """New listings: the first source has other prices and places."""
    for file in (landing / "raw" / FIRST.name).rglob("*.csv"):
        file.write_text(file.read_text().replace(",50000", ",90000").replace("las   condes", "vitacura"))


@pytest.mark.parametrize("step", ["second table", "last table", "before commit", "while cleaning"])
def test_a_run_that_fails_while_publishing_shows_nothing(spark, landing, monkeypatch, step):
    cfg = config(landing / "raw", landing / "warehouse")
    run(spark, cfg)
    before, held = tables_of(spark), snapshots_in(landing / "warehouse")
    dearer(landing)
    added = []
    add, commit, clean = RunTables._add, Manifest.commit, RunTables._clean

    def failing_add(self, namespace, name, table):
        add(self, namespace, name, table)
        added.append(name)
        if len(added) == {"second table": 2, "last table": len(self.written)}.get(step):
            raise OSError("lost")

    def failing_commit(self, *a):
        if step == "before commit":
            raise OSError("lost")
        return commit(self, *a)

    def failing_clean(self, *a):
        if step == "while cleaning":
            raise OSError("lost")
        return clean(self, *a)

    monkeypatch.setattr(RunTables, "_add", failing_add)
    monkeypatch.setattr(Manifest, "commit", failing_commit)
    monkeypatch.setattr(RunTables, "_clean", failing_clean)
    with pytest.raises(OSError):
        run(spark, cfg)
    monkeypatch.undo()
    if step == "while cleaning":  # the commit has been made: everything is new
        after = tables_of(spark)
        assert all(after[n] != before[n] for n in ("stg_arriendos", "dim_comuna", "fct_arriendos"))
        return
    assert tables_of(spark) == before
    assert snapshots_in(landing / "warehouse") == held
    run(spark, cfg)  # and the next run publishes all of it
    after = tables_of(spark)
    assert all(after[n] != before[n] for n in ("stg_arriendos", "dim_comuna", "fct_arriendos"))


def test_old_snapshots_are_removed(spark, landing):
    cfg = config(landing / "raw", landing / "warehouse")
    seen = []
    for _ in range(4):
        run(spark, cfg)
        seen.append(snapshots_in(landing / "warehouse"))
    assert [len(s) for s in seen] == [1, 2, 2, 2] and len(seen[0] | seen[1] | seen[2] | seen[3]) == 4
    assert len(list((landing / "warehouse" / "commits").glob("commit-*.json"))) == 2
    versions = spark.table("t_marts.fct_arriendos__snapshots").select("snapshot").distinct().count()
    assert versions == 2
    assert not list((landing / "warehouse").rglob("run-*"))


def test_views_read_one_snapshot_alone(spark, landing):
    cfg = config(landing / "raw", landing / "warehouse")
    for _ in range(2):
        run(spark, cfg)
    df = spark.table("t_marts.fct_arriendos")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "snapshot" in plan
    read = [p for p in df.inputFiles()]
    rows = spark.table("t_marts.fct_arriendos__snapshots").groupBy("snapshot").count().collect()
    assert read and len(rows) == 2 and {r["count"] for r in rows} == {df.count()}


def test_a_table_may_gain_columns_only(spark, tmp_path):
    def publish(df):
        with RunTables(spark, str(tmp_path / "w"), "t_gain_manifest") as t:
            t.write(df, "t_gain", "numbers")
            t.publish()

    publish(spark.range(3))
    publish(spark.range(4).withColumn("b", F.lit("x")))
    assert spark.table("t_gain.numbers").columns == ["id", "b"] and spark.table("t_gain.numbers").count() == 4
    with pytest.raises(TypeError, match="gain columns only"):
        publish(spark.range(5).select(F.col("id").cast("string"), F.lit("y").alias("b")))
    assert spark.table("t_gain.numbers").count() == 4
    with pytest.raises(ValueError, match="snapshot"):
        publish(spark.range(1).withColumn("snapshot", F.lit(1)))


def test_commits_of_two_writers_are_numbered(spark, tmp_path):
    a, b = (Manifest(spark, str(tmp_path / "w"), "t_two") for _ in range(2))
    a.register()
    assert a.commit(10, ["x"]) == 1
    assert b.store.create(f"{b.folder}/commit-000000000002.json", json.dumps({"seq": 2, "snapshot": 20, "tables": []}))
    assert not b.store.create(f"{b.folder}/commit-000000000002.json", "{}")
    assert a.commit(15, ["x"]) == 3
    assert spark.sql(f"SELECT {a.current()} AS s").first().s == 15
    assert a.forget(1) == [10, 20] and a.history() == [(3, 15)]


def test_missing_file_stops_the_run(spark, landing):
    (landing / "raw" / SECOND.name / "2023" / "2023-09.csv").unlink()
    with pytest.raises(q.QualityError, match="file_inventory_complete=1"):
        run(spark, config(landing / "raw", landing / "warehouse"))


def test_period_comes_from_the_file_or_its_folder(spark):
    from rentgrid.sources.csv_tree import period_of_path

    paths = {
        "s3a://b/2024-01/raw/a/2023/2023-04.csv": "2023-04", "/raw/2020-05/a/periodo=2023-04/part-0.csv": "2023-04",
        "/raw/2020-05/a/all.csv/x": None, "/raw/2020-05/a/b/part.csv": None,
    }
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert {r.p: r.q for r in df.select("p", period_of_path(F.col("p")).alias("q")).collect()} == paths


def test_files_per_period_do_not_follow_the_tasks(spark, tmp_path):
    from rentgrid.sources.csv_tree import write_csv_tree

    rows = spark.range(0, 4000, 1, 8).select("id", F.concat(F.lit("2023-0"), F.col("id") % 5 + 1).alias("periodo"))
    write_csv_tree(rows, str(tmp_path / "tree"), "periodo")
    files = list((tmp_path / "tree").rglob("*.csv"))
    assert len(files) <= 5


def test_packed_tree_reads_like_a_plain_one(spark, tmp_path):
    from rentgrid.sources.csv_tree import list_files, period_of_path, scan_csv_tree, with_source_file, write_csv_tree

    rows = spark.createDataFrame(
        [("1", " a ", "2023-01"), ("2", None, "2023-01"), ("3", 'x,"y', "2023-02"), ("4", "z", None)], "id string, v string, periodo string"
    )
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    write_csv_tree(rows, str(tmp_path / "tree"), "periodo", compression="gzip")
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    assert len(list((tmp_path / "tree").rglob("*.csv.gz"))) == 3 and not list((tmp_path / "tree").rglob("*.csv"))
    periods = list_files(spark, str(tmp_path / "tree")).select(period_of_path(F.col("path")).alias("p"))
    assert {r.p for r in periods.collect()} == {"2023-01", "2023-02", None}
    found = with_source_file(scan_csv_tree(spark, str(tmp_path / "tree"), ["id", "v"])).select("id", "v", "periodo_archivo")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, rows.collect()))
    packed = spark.createDataFrame([("/a/2023/2023-04.csv.gz",)], "p string").select(period_of_path(F.col("p")).alias("p"))
    assert packed.first().p == "2023-04"


def point(day, value):
    return {"fecha": f"{day}T03:00:00.000Z", "valor": value}


PAYLOADS = {
    "a": json.dumps({"serie": [point("2023-01-01", 1.5), point("2023-01-02", None), point("2023-01-03", "n/d"), point("x", 2)]}),
    "b": json.dumps({"serie": [point("2023-01-01", 9.0), point("2023-01-04", 4), point("2023-01-05", "5.5"), None, point("2023-01-06", "NaN")]}),
    "c": '{"serie": [', "d": "{}", "e": '{"serie": []}', "f": '{"serie": 7}', "g": "", "h": '{"serie": [{"fecha": "2023-01-07"}]}',
}


@pytest.fixture
def faulty(tmp_path):
    (tmp_path / "in").mkdir()
    for name, text in PAYLOADS.items():
        (tmp_path / "in" / f"{name}.json").write_text(text)
    return tmp_path


def test_landed_points_have_their_reason(spark, faulty):
    points = rates.landed_points(rates.read_payloads(spark, str(faulty / "in")))
    got = sorted((r.archivo[-6], -1 if r.posicion is None else r.posicion, r.motivo, r.contenido) for r in points.collect())
    assert got == [
        ("a", 0, None, None), ("a", 1, "valor_nulo", None), ("a", 2, "valor_invalido", None), ("a", 3, "fecha_invalida", None),
        ("b", 0, "fecha_repetida", None), ("b", 1, None, None), ("b", 2, None, None), ("b", 3, "fecha_invalida", None),
        ("b", 4, "valor_invalido", None), ("c", -1, "json_invalido", PAYLOADS["c"]), ("d", -1, "sin_serie", "{}"),
        ("e", -1, "serie_vacia", PAYLOADS["e"]), ("f", -1, "json_invalido", PAYLOADS["f"]), ("g", -1, got[-2][2], ""),
        ("h", 0, "valor_nulo", None),
    ]
    assert got[-2][2] in ("json_invalido", "sin_serie")


def test_faulty_points_stop_or_are_put_apart(spark, faulty):
    folders = [str(faulty / n) for n in ("in", "uf", "apart")]
    with pytest.raises(q.QualityError, match="payload:json_invalido"):
        land_rate_series(spark, *folders[:2], (2023,))
    assert not (faulty / "uf").exists()
    with pytest.raises(q.QualityError, match="year_coverage"):
        land_rate_series(spark, *folders[:2], (2023,), quarantine=folders[2])
    assert spark.read.parquet(folders[2]).count() == 12 and not (faulty / "uf").exists()
    for _ in range(2):  # landing again replaces both
        series = land_rate_series(spark, *folders[:2], (2023,), frozenset({"year_coverage"}), folders[2])
        assert sorted((r.fecha[:10], r.valor) for r in series.collect()) == [("2023-01-01", 1.5), ("2023-01-04", 4.0), ("2023-01-05", 5.5)]
        assert spark.read.parquet(folders[2]).count() == 12


def test_nothing_landed(spark):
    points = rates.landed_points(spark.createDataFrame([], "payload string, archivo string"))
    assert points.count() == 0
    assert {r.n_bad for r in q.landed_quality(points).collect()} == {0}
