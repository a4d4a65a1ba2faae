"""Properties of results and plans that must hold at any scale."""

import datetime as dt
import re
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sheafline.operators import comparison, intake, publish, season, sequences, station, weather
from sheafline.plans import QUERIES
from sheafline.plans.queries import SITE
from sheafline.plans.testdata import TestTables
from sheafline.sources import SCHEMAS, append_rows, merged_partitions, read_table, upsert_partitions, write_new


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(pattern, text):
    return len(re.findall(pattern, text))


@pytest.fixture(autouse=True)
def nothing_cached(spark):
    spark.catalog.clearCache()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|ArrowEval|InPandas", plan)


def test_all_cumuls_and_lags_share_one_exchange_and_sort(spark, sf_dir):
    flagged = weather.weather_day_flags(spark.createDataFrame([], SCHEMAS["weather"]))
    plan = plan_of(weather.weather_cumuls(flagged, lags=True))
    assert count(r"Exchange hashpartitioning", plan) <= 1
    assert count(r"\bSort \[", plan) <= 1


@pytest.mark.parametrize(
    "name",
    ["weather_trailing", "weather_cumuls", "weather_lags", "flux_day", "flux_week", "flux_week_until_next",
     "sequence_windows_day", "sequence_windows_week", "minmax_scale", "rank_correlation", "bro_station_features"],
)
def test_daily_series_are_never_gathered_in_one_task(spark, sf_dir, name):
    assert "SinglePartition" not in plan_of(QUERIES[name](spark, sf_dir))


@pytest.mark.parametrize(
    "name",
    ["season_features", "season_features_predict", "season_features_backtest", "midweek_ratio_lags",
     "intake_with_sowing", "bro_station_features", "data_checks", "weekly_profile"],
)
def test_the_delivery_table_is_read_once(spark, sf_dir, name):
    assert count(r"FileScan parquet \[[^\]]*l_", plan_of(QUERIES[name](spark, sf_dir))) == 1


def test_deliveries_are_reduced_before_a_grower_table_of_any_size(spark, sf_dir):
    small = QUERIES["bro_station_features"](spark, sf_dir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        large = QUERIES["bro_station_features"](spark, sf_dir)
        assert "BroadcastExchange" not in plan_of(large)
        assert plan_of(large).count("HashAggregate") == plan_of(small).count("HashAggregate")
        assert large.exceptAll(small).count() == 0 and large.count() == small.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_grower_is_split_in_the_row_level_join(spark):
    deliveries = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("prdcode"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 700).cast("int")).alias("liv_date"),
        (F.col("id") % 41).alias("liv_qty"),
    )
    growers = spark.range(5000).select(
        F.col("id").alias("code_adherent"), (F.col("id") % 9).alias("code_insee"), F.lit(1).alias("numero_station")
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = station.bro_grower_intake(deliveries, growers)
        rows = joined.collect()
        assert "SortMergeJoin(skew=true)" in plan_of(joined)
        assert len(rows) == 300_000
        assert sum(r["quantite_recolte"] for r in rows) == sum(i % 41 for i in range(300_000))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_branches_of_the_season_days_share_one_scan(spark, sf_dir):
    plan = plan_of(QUERIES["season_day"](spark, sf_dir))
    # the days are read from the checkpoint folder, the deliveries not again; nothing stays cached
    assert count(r"Scan ExistingRDD\[date_recolte", plan) >= 3
    assert count(r"FileScan parquet \[[^\]]*l_", plan) == count(r"InMemoryTableScan", plan) == 0


def test_one_scan_for_all_surfaces_and_models(spark, sf_dir):
    assert count(r"FileScan", plan_of(QUERIES["sowing_unpivot"](spark, sf_dir))) == 1
    plan = plan_of(QUERIES["model_comparison_weekly"](spark, sf_dir))
    assert count(r"FileScan parquet \[[^\]]*o_", plan) == 1


@pytest.mark.parametrize(
    "name, bound",
    [("weekly_profile", "1997-01-01"), ("season_features_predict", "2000-01-02"), ("model_comparison_weekly", "2000-01-02")],
)
def test_day_bounds_reach_the_scan(spark, sf_dir, name, bound):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert re.search(rf"PushedFilters: .*GreaterThanOrEqual\(l_shipdate,{bound}", plan)


def test_scans_read_the_needed_columns_only(spark, sf_dir):
    plan = plan_of(QUERIES["daily_intake"](spark, sf_dir))
    assert all(
        set(columns.split(",")) == {"l_quantity:double", "l_shipdate:timestamp_ntz"}
        for columns in re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    )


def test_daily_sums_keep_the_total(spark, sf_dir):
    t = TestTables(spark, sf_dir)
    everything = intake.deliveries_union(t.deliveries_archive(), t.deliveries())
    total = everything.agg(F.sum("quantite_recolte")).first()[0]
    assert intake.daily_intake(everything).agg(F.sum("quantite_recolte")).first()[0] == total
    assert everything.count() == t.deliveries_all().count()


def test_backtest_rows_are_training_rows(spark, sf_dir):
    train = QUERIES["season_features"](spark, sf_dir)
    backtest = QUERIES["season_features_backtest"](spark, sf_dir)
    assert len(train.columns) == 43
    assert backtest.exceptAll(train).count() == 0
    assert 0 < backtest.count() < train.count()


def test_pruned_cumuls_equal_the_full_table(spark, sf_dir):
    t = TestTables(spark, sf_dir)
    flagged = weather.weather_day_flags(t.weather(), site=SITE)
    names = [name for name, _ in season.INT_CUMULS]
    some = weather.weather_cumuls(flagged, names=names).select("date_reelle", *names)
    full = weather.weather_cumuls(flagged).select("date_reelle", *names)
    assert some.exceptAll(full).count() == 0


def test_tables_are_written_once_and_appended_to(spark, tmp_path):
    rows = spark.createDataFrame([(1, "cf", "i", "l", "p")], SCHEMAS["run_logs"])
    path = str(tmp_path / "run_logs")
    write_new(rows, path)
    append_rows(rows, path)
    assert read_table(spark, str(tmp_path), "run_logs").count() == 2
    with pytest.raises(Exception, match="(?i)exists"):
        write_new(rows, path)


def test_a_published_week_replaces_stored_days_in_a_new_table(spark, tmp_path):
    root = str(tmp_path)
    stored = spark.createDataFrame(
        [(dt.date(2021, 6, 12), 4, None), (dt.date(2021, 6, 14), 5, 30)], SCHEMAS["published_forecasts"]
    )
    write_new(stored, f"{root}/published_forecasts")
    daily = spark.createDataFrame([(dt.date(2021, 6, 14 + p), 10 + p) for p in range(6)], "jour date, pred long")
    week = spark.createDataFrame([(dt.date(2021, 6, 14), 75)], "jour date, pred long")
    new = publish.publish_forecast(daily, week, as_of="2021-06-10")
    table = publish.upsert_forecast(read_table(spark, root, "published_forecasts"), new)
    write_new(table, f"{root}/next/published_forecasts")
    rows = {r["jour"].day: (r["pred2"], r["pred1"]) for r in read_table(spark, f"{root}/next", "published_forecasts").collect()}
    assert rows == {12: (4, None), 14: (10, 75), 15: (11, None), 16: (12, None), 17: (13, None), 18: (14, None), 19: (15, None)}


def test_entry_runs():
    import __spark_entry__ as driver

    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert Path(driver.__file__).exists()


@pytest.mark.parametrize("gone", ["llm", "pipeline", "both"])
def test_queries_without_the_training_data_part(tmp_path, gone):
    root = Path(__file__).resolve().parent.parent
    skipped = {"llm": ("llm",), "pipeline": ("corpus_pipeline.py",), "both": ("llm", "corpus_pipeline.py")}[gone]
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "tests", "__pycache__", *skipped))
    script = "import __spark_entry__ as d; print(*sorted(d.queries())); print(*sorted(d.oracle_sql()))"
    run = subprocess.run([sys.executable, "-c", script], cwd=copy, capture_output=True, text=True, check=True, timeout=120)
    names, twins = (line.split() for line in run.stdout.strip().splitlines()[-2:])
    assert set(QUERIES) <= set(names) and set(QUERIES) <= set(twins)
    if gone != "pipeline":
        assert set(names) == set(QUERIES)


def test_other_missing_modules_are_not_swallowed(monkeypatch):
    import __spark_entry__ as driver

    def broken(name):
        raise ModuleNotFoundError("no numpy", name="numpy")

    monkeypatch.setattr(driver, "import_module", broken)
    with pytest.raises(ModuleNotFoundError):
        driver.queries()


STORED = "site int, jour date, pred2 long"


def _files(path):
    return {f: f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def test_an_upsert_rewrites_touched_days_only(spark, tmp_path):
    path = str(tmp_path / "forecasts")
    days = [dt.date(2021, 6, 7 + k) for k in range(10)]
    first = spark.createDataFrame([(s, d, 10 * s + k) for s in (1, 2) for k, d in enumerate(days)], STORED)
    # nothing stored yet
    upsert_partitions(first, path, keys=["site", "jour"], partition="jour")
    before = _files(path)
    update = spark.createDataFrame([(1, days[3], 900), (1, days[4], 901), (3, days[4], 902), (None, days[4], 1)], STORED)
    expected = {(s, d, 10 * s + k) for s in (1, 2) for k, d in enumerate(days) if (s, k) not in ((1, 3), (1, 4))}
    expected |= {(1, days[3], 900), (1, days[4], 901), (3, days[4], 902), (None, days[4], 1)}
    for _ in range(2):  # the same run again changes nothing
        upsert_partitions(update, path, keys=["site", "jour"], partition="jour")
        rows = [tuple(r) for r in spark.read.schema(STORED).parquet(path).select("site", "jour", "pred2").collect()]
        assert len(rows) == len(expected) and set(rows) == expected
    after = _files(path)
    touched = {f"jour={days[3]}", f"jour={days[4]}"}
    assert {f.parent.name for f in after.keys() - before.keys()} == touched
    assert {f: t for f, t in before.items() if f.parent.name not in touched} == {
        f: t for f, t in after.items() if f.parent.name not in touched
    }


def test_an_upsert_reads_touched_days_only(spark, tmp_path):
    path = str(tmp_path / "forecasts")
    days = [dt.date(2021, 6, 7 + k) for k in range(10)]
    stored = spark.createDataFrame([(1, d, k) for k, d in enumerate(days)], STORED)
    stored.write.partitionBy("jour").parquet(path)
    update = spark.createDataFrame([(1, days[2], 7)], STORED)
    merged = merged_partitions(update, path, keys=["site", "jour"], partition="jour")
    assert {tuple(r) for r in merged.collect()} == {(1, days[2], 7)}
    plan = plan_of(merged)
    assert re.search(r"PartitionFilters: \[[^]]*jour[^]]*2021-06-09", plan)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)
    with pytest.raises(ValueError, match="must hold the partition"):
        upsert_partitions(update, path, keys=["site"], partition="jour")


def test_a_long_series_is_ranked_by_many_tasks(spark):
    # nine rows in ten belong to one key
    rows = spark.range(100_000).selectExpr("if(id % 10 = 0, id % 7, 0) as k", "hash(id) * 1.0d as v", "hash(id, 1) * 1.0d as w")
    found = comparison.average_ranks(rows, "v", keys=["k"], ranges=16)
    windows = re.findall(r"Window \[[^\]]*\], \[([^\]]*)\]", plan_of(found))
    assert any("range" in w for w in windows)
    # what a task sorts is a range: none holds a large part of the hot key
    placed = rows.filter("k = 0").join(found, ["k", "v"])
    cuts = [(placed.filter(f"rank > {a} and rank <= {a + 90_000 / 16}")).count() for a in (0, 45_000)]
    assert all(c < 12_000 for c in cuts)
    rho = comparison.rank_correlation(rows, features=["v"], target="w", keys=["k"]).filter("k = 0").first()
    assert rho["n"] > 80_000 and abs(rho["rho"]) < 0.02


@pytest.mark.parametrize("anchored", ["start", "end"])
def test_windows_are_gathered_by_anchor_in_one_exchange(spark, anchored):
    rows = spark.range(3000).selectExpr("id % 3 as k", "cast(id as int) as o", "id * 1.0d as qte", "id * 2.0d as w")
    plan = plan_of(
        sequences.sequence_windows_day(rows, keys=["k"], order="o", features=["qte", "w"], target="qte", anchored=anchored)
    )
    assert count(r"Exchange ", plan) == 1
    assert not [line for line in plan.splitlines() if "Window [" in line and "collect_list" in line]


@pytest.mark.parametrize("name", ["minmax_scale_one_series", "minmax_inverse", "latest_window", "sequence_forecast", "rank_correlation"])
def test_derived_tables_are_read_once(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert count(r"FileScan", plan) == 0 and count(r"Scan ExistingRDD", plan) >= 1
