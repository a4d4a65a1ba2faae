"""Hand-worked small frames for the rules that decide whether results match."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from sheafline.functions import (
    TrailingSum,
    as_int,
    calendar_year,
    harvest_season,
    iso_week,
    percent_error,
    planting_season,
    ratio,
    season_day,
    sunday_weekday,
    trailing_sums,
)
from sheafline.operators import (
    calendar,
    comparison,
    forecast,
    intake,
    publish,
    quality,
    regression,
    scaling,
    season,
    sequences,
    station,
    weather,
    weekly,
)
from sheafline.sources import write_new

D = dt.date


def days(spark, *texts):
    return spark.createDataFrame([(D.fromisoformat(t),) for t in texts], "d date")


def column(df, name):
    return [row[name] for row in df.collect()]


def test_integer_casts_round_floats_half_even_and_decimals_half_up(spark):
    df = spark.sql("select x, cast(x as decimal(9,1)) as y from values (0.5D), (1.5D), (2.5D), (-2.5D) as t(x)")
    assert column(df.select(as_int(df, "x")), "x") == [0, 2, 2, -2]
    assert column(df.select(as_int(df, "y")), "y") == [1, 2, 3, -3]


def test_iso_week_keeps_the_calendar_year(spark):
    df = days(spark, "2021-01-01", "2021-01-04").select(
        iso_week(F.col("d")).alias("w"), calendar_year(F.col("d")).alias("y")
    )
    assert [tuple(r) for r in df.collect()] == [(53, 2021), (1, 2021)]


def test_sunday_is_weekday_zero(spark):
    df = days(spark, "2021-06-06", "2021-06-10").select(sunday_weekday(F.col("d")).alias("w"))
    assert column(df, "w") == [0, 4]


def test_division_by_zero_is_null(spark):
    df = spark.range(1).select(ratio(F.lit(1), F.lit(0)).alias("r"), percent_error(F.lit(3), F.lit(0)).alias("e"))
    assert tuple(df.first()) == (None, None)


def test_percent_error_rounds_half_up_in_decimal(spark):
    df = spark.range(1).select(percent_error(F.lit(112.345), F.lit(100.0)).alias("e"))
    assert df.first()["e"] == 12.35


def test_seasons_at_their_borders(spark):
    df = days(spark, "2010-01-01", "2016-08-31", "2016-09-01", "2017-08-31", "2017-09-01", "2022-05-14", "2022-05-15", "2024-09-01")
    d = F.col("d")
    got = df.select(
        harvest_season(d).alias("h"),
        harvest_season(d, last=2022, open_ended=True).alias("w"),
        planting_season(d).alias("p"),
    ).collect()
    assert [r["h"] for r in got] == [2015, 2015, 2016, 2016, 2017, 2021, 2021, None]
    assert [r["w"] for r in got] == [2015, 2015, 2016, 2016, 2017, 2021, 2021, 2022]
    assert [r["p"] for r in got] == [2015, 2015, 2017, 2018, 2018, 2022, None, None]


def test_season_of_a_missing_day_is_missing(spark):
    df = spark.sql("select cast(null as date) as d").select(
        harvest_season(F.col("d")).alias("h"), planting_season(F.col("d")).alias("p")
    )
    assert tuple(df.first()) == (None, None)


def test_season_day_counts_from_september(spark):
    df = days(spark, "2021-09-01", "2021-08-31").select(season_day(F.col("d")).alias("s"))
    assert column(df, "s") == [0, 364]


@pytest.mark.parametrize("exact", [True, False])
def test_trailing_sum_without_values_is_null(spark, exact):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([1, 2, 3])], "k int, o int, v int")
    out = trailing_sums(df, ["k"], "o", [TrailingSum("v", "s", start=3)], exact=exact).orderBy("o")
    assert column(out, "s") == [None, 1, 3]


def test_both_trailing_methods_agree_with_brute_force(spark):
    rng = random.Random(7)
    rows = [
        (k, o, None if rng.random() < 0.4 else rng.randrange(-9, 30))
        for k, n in ((1, 70), (2, 1), (3, 25))
        for o in range(n)
    ]
    sums = [TrailingSum("v", f"s{a}_{b}", start=a, end=b) for a, b in ((0, 0), (3, 0), (3, 1), (5, 5), (61, 1))]
    df = spark.createDataFrame(rows, "k int, o int, v int").repartition(3)
    expected = set()
    for k in (1, 2, 3):
        values = [v for key, _, v in rows if key == k]
        for i in range(len(values)):
            line = []
            for s in sums:
                frame = values[max(0, i - s.start) : max(0, i - s.end + 1)] if i - s.end >= 0 else []
                known = [v for v in frame if v is not None]
                line.append(sum(known) if known else None)
            expected.add((k, i, *line))
    for exact in (True, False):
        out = trailing_sums(df, ["k"], "o", sums, exact=exact).select("k", "o", *(s.name for s in sums))
        assert {tuple(r) for r in out.collect()} == expected


def test_fractional_measures_use_the_sliding_frame(spark):
    df = spark.createDataFrame([(1, i, 0.1 * i) for i in range(5)], "k int, o int, v double")
    out = trailing_sums(df, ["k"], "o", [TrailingSum("v", "s", start=2)])
    assert "__sum_v" not in out._jdf.queryExecution().analyzed().toString()


def test_live_rows_get_null_for_other_archive_columns(spark):
    archive = spark.sql("select date'2017-01-01' as date_recolte, 1L as code_adherent, 2L as quantite_recolte, 'x' as note")
    live = spark.sql("select date'2018-01-01' as date_recolte, 1L as code_adherent, 3L as quantite_recolte, 9 as other")
    out = intake.deliveries_union(archive, live)
    assert out.columns == archive.columns
    assert {r["note"] for r in out.collect()} == {"x", None}


def test_calendar_without_sundays(spark):
    out = intake.calendar_between(spark, "2021-06-07", "2021-06-20")
    assert out.count() == 12
    assert intake.calendar_between(spark, "2021-06-07", "2021-06-20", skip_sunday=False).count() == 14


def _weather(spark, start, values):
    rows = [(start + dt.timedelta(days=i), 1, v, v, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "date_reelle date, code_insee long, tmin long, tmax long, rr10 long")


def test_weeks_are_numbered_before_weeks_without_weather_are_dropped(spark):
    cal = intake.calendar_between(spark, "2021-05-31", "2021-06-20")
    deliveries = spark.createDataFrame(
        [(D(2021, 6, 1), 1, 5), (D(2021, 6, 8), 1, 7)], "date_recolte date, code_adherent long, quantite_recolte long"
    )
    sky = _weather(spark, D(2021, 6, 14), [1, 2, 3])
    out = intake.flux_week(deliveries.limit(0), deliveries, cal, sky, site=1).collect()
    assert [(r["id"], r["sem"], r["qte"], r["t_min"]) for r in out] == [(3, 24, None, 6)]


def test_next_week_lookup_passes_the_year_end(spark):
    flux = spark.createDataFrame(
        [(1, 51, 2021), (2, 52, 2021), (3, 1, 2022), (4, 2, 2022)], "id int, sem int, an int"
    )
    out = intake.flux_week_until_next(flux, as_of=D(2021, 12, 30))
    assert sorted(column(out, "id")) == [1, 2, 3]
    assert intake.flux_week_until_next(flux, as_of=D(2023, 1, 5)).count() == 0


def test_holiday_counts_only_if_worked(spark):
    holidays = days(spark, "2021-05-01", "2021-05-08").toDF("jour")
    deliveries = spark.createDataFrame(
        [(D(2021, 5, 8), 1, 4)], "date_recolte date, code_adherent long, quantite_recolte long"
    )
    out = weekly.weekly_worked_holidays(holidays, deliveries, as_of=D(2021, 6, 10))
    assert {(r["semaine"], r["nb_jr_ferie"]) for r in out.collect()} == {(17, None), (18, 1)}
    sky = _weather(spark, D(2021, 4, 26), [1] * 14)
    profile = weekly.weekly_profile(
        deliveries, sky, holidays, as_of=D(2021, 6, 10), site=1, annee=2021, semaine=53, mode="train"
    )
    assert {(r["week"], r["nombre_jours_feries"]) for r in profile.collect()} == {(17, 0), (18, 1)}


def test_flags_of_missing_weather_are_zero(spark):
    df = spark.sql("select 1L as code_insee, cast(null as bigint) as tmin, 20L as tmax, cast(null as bigint) as rr10")
    row = weather.weather_day_flags(df).first()
    assert [row[c] for c in ("gel", "froid", "arrosage", "pluieforte")] == [0, 0, 0, 0]
    assert (row["jourchaud"], row["jourdoux"], row["jourfroid"]) == (1, 1, 0)


def test_there_are_97_cumuls_of_one_row_more_than_named():
    sums = weather.cumul_sums()
    assert len(sums) == len({s.name for s in sums}) == 97
    assert all(s.start == int(s.name.removeprefix("cumulrr10" if s.source == "rr10" else "").strip("abcdefghijklmnopqrstuvwxyz")) + 1 for s in sums)


def test_only_the_surface_of_the_planting_year_counts(spark):
    surfaces = ", ".join(f"cast({y - 2015} as double) as surface_{y}" for y in range(2016, 2023))
    df = spark.sql(f"select 7L as code_adherent, 'v' as variete_norm, d as date_plantation, {surfaces} from values (date'2018-03-01'), (date'2015-03-01') as t(d)")
    rows = season.sowing_unpivot(df).collect()
    assert [(r["code_adherent"], r["annee"], r["qte_semis"]) for r in rows] == [("7", 2018, 36000.0)]


def test_week_over_first_september_has_a_row_per_season_and_repeats_its_days(spark):
    daily = spark.createDataFrame(
        [(D(2016, 8, 29), 10), (D(2016, 9, 1), 30), (D(2016, 9, 3), 60)], "date_recolte date, quantite_recolte long"
    )
    totals = spark.createDataFrame([(2015, 1000), (2016, 2000)], "saison int, qte_semis long")
    ratios = season.midweek_ratio_lags(daily)
    got = {(r["saison"], r["mi_week_quantite_recolte"], r["ratio"], r["mi_recolte_1"]) for r in ratios.collect()}
    assert got == {(2015, 10, 0.1, None), (2016, 30, 0.3, 10)}
    wide = season.weekly_features_to_day(daily, ratios, season.remaining_plants(daily, totals))
    assert wide.count() == 3 * 2 * 2
    intake_rows = daily.withColumn("qte_semis", F.lit(1.0))
    assert season.repeat_by_weekly_rows(intake_rows, totals).count() == 3 * 2 * 2
    only_one = totals.filter("saison = 2016")
    assert season.repeat_by_weekly_rows(intake_rows, only_one).count() == 3 * 2


def test_weather_windows_restart_in_january(spark):
    sky = _weather(spark, D(2020, 12, 30), [1, 2, 3, 4])
    out = {r["date_reelle"]: r["tmax_2j_sum"] for r in station.bro_weather_windows(sky).collect()}
    assert out == {D(2020, 12, 30): None, D(2020, 12, 31): 1, D(2021, 1, 1): None, D(2021, 1, 2): 3}


def _checks(spark, delivered, sown, listed, sky=()):
    def keyed(values, name):
        return spark.createDataFrame([(v,) for v in values], f"{name} long")

    weather_keys = spark.createDataFrame(list(sky), "code_insee long, date_reelle date")
    rows = quality.data_checks(
        keyed(delivered, "prdcode"), keyed(sown, "code_adherent"), keyed(listed, "code_adherent"), weather_keys
    ).collect()
    return {r["erreur"]: r["nbre"] for r in rows}


def test_unlisted_growers_are_counted_per_row(spark):
    day = D(2021, 1, 1)
    got = _checks(spark, [1, 2, 2, 9, None], [1, 5], [1], [(1, day), (1, day), (2, day), (None, day), (None, day)])
    assert got == {
        quality.LABEL_DELIVERIES_GROWERS: 3,
        quality.LABEL_SOWINGS_GROWERS: 1,
        quality.LABEL_DELIVERIES_SOWINGS: 3,
        quality.LABEL_WEATHER: 1,
    }


def test_a_null_in_the_list_hides_all_orphans(spark):
    got = _checks(spark, [1, 2], [2, None], [1, None])
    assert got[quality.LABEL_DELIVERIES_GROWERS] == 0
    assert got[quality.LABEL_DELIVERIES_SOWINGS] == 0


def test_an_empty_list_reports_every_row_with_a_grower(spark):
    got = _checks(spark, [1, 2, None], [], [])
    assert got[quality.LABEL_DELIVERIES_GROWERS] == 2
    assert got[quality.LABEL_SOWINGS_GROWERS] == 0


def test_models_share_weeks_and_a_missing_site_drops_the_day(spark):
    names = [c for pair in comparison.MODEL_COLUMNS.values() for c in pair]
    rows = [
        (D(2021, 5, 24), *[100] * 8),
        (D(2021, 5, 31), 1, 2, 3, 4, 5, None, 7, 8),
        (D(2021, 6, 1), 1, 2, 3, 4, 5, 6, 7, 8),
        (D(2021, 6, 7), 10, 20, 30, 40, 50, None, 70, 80),
    ]
    forecasts = spark.createDataFrame(rows, "jour date, " + ", ".join(f"{n} long" for n in names))
    deliveries = spark.createDataFrame([(D(2021, 6, 7), 5)], "liv_date date, liv_qty long")
    out = comparison.model_comparison_weekly(forecasts, deliveries, as_of=D(2021, 6, 10)).collect()
    assert [tuple(r) for r in out] == [(6, 14, 11, 30, None, 22), (30, 70, None, 150, 5, 23)]


def test_metrics_of_two_errors(spark):
    df = spark.createDataFrame([(12.0, 10.0), (16.0, 20.0), (5.0, None)], "p double, a double")
    row = comparison.forecast_metrics(df, predicted="p", actual="a").first()
    assert row["n"] == 2
    assert row["rmse"] == pytest.approx(math.sqrt(10))
    assert (row["mae"], row["mape"], row["mpe"]) == (3.0, pytest.approx(20.0), pytest.approx(0.0))


def test_rank_correlation_shares_tied_ranks(spark):
    df = spark.createDataFrame([(1, x, y) for x, y in ((1, 1), (2, 2), (2, 3), (5, 9))], "k int, x long, y long")
    row = comparison.rank_correlation(df, features=["x"], target="y", keys=["k"]).first()
    # ranks 1, 2.5, 2.5, 4 against 1, 2, 3, 4
    assert row["rho"] == pytest.approx(4.5 / math.sqrt(4.5 * 5))


def test_day_features_take_text_dates(spark):
    row = spark.createDataFrame(
        [("2021-06-12", 1, 2, 3, 4, 5, 6)], "jour string, qte int, t_min int, t_max int, ctmax int, ctmin int, cpluie int"
    )
    out = calendar.calendar_features_day(row).first()
    assert out["date_recolte"] == D(2021, 6, 12)
    assert out["samedis"] == 1
    assert out["weekday_cos"] == pytest.approx(math.cos(5 * 2 * math.pi / 7))
    assert out["annee_sin"] == pytest.approx(math.sin((163 + 265) * 2 * math.pi / 365.25))


def test_model_input_splits_target_and_exogenous(spark):
    row = spark.createDataFrame(
        [("2021-06-12", 1, 2, 3, 4, 5, 6)], "jour string, qte int, t_min int, t_max int, ctmax int, ctmin int, cpluie int"
    )
    parts = calendar.model_input(calendar.calendar_features_day(row))
    assert parts.target.columns == ["date_recolte", "qte"]
    assert len(parts.features.columns) == 14 and "qte" not in parts.exogenous.columns


def test_constant_and_missing_values_scale(spark):
    df = spark.createDataFrame([(1, 5, 1), (1, 5, 3), (1, 5, None)], "k int, a int, b int")
    for keys in ([], ["k"]):
        out = scaling.minmax_scale(df, ["a", "b"], keys=keys)
        assert column(out, "a") == [-1.0, -1.0, -1.0]
        assert sorted(column(out, "b"), key=str) == [-1.0, 1.0, None]


def test_inverse_scaling_restores_and_truncates(spark):
    df = spark.createDataFrame([(1, float(v)) for v in (-7, 2, 9)], "k int, a double")
    for keys in ([], ["k"]):
        stats = scaling.minmax_fit(df, ["a"], keys=keys)
        back = scaling.minmax_inverse(scaling.minmax_apply(df, stats, ["a"], keys=keys), stats, ["a"], keys=keys, truncate=False)
        assert sorted(column(back, "a")) == pytest.approx([-7, 2, 9])
    halves = spark.createDataFrame([(0.05,), (-0.85,)], "a double")
    stats = spark.createDataFrame([(-10.0, 10.0)], "min_a double, max_a double")
    assert column(scaling.minmax_inverse(halves, stats, ["a"]), "a") == [0, -8]


def _series(spark, n, missing=None):
    rows = [(1, i, None if i == missing else i, 100 + i) for i in range(n)]
    return spark.createDataFrame(rows, "k int, o int, qte int, w int")


def test_day_windows_keep_missing_values_and_drop_cut_futures(spark):
    out = sequences.sequence_windows_day(
        _series(spark, 27, missing=3), keys=["k"], order="o", features=["qte", "w"], target="qte"
    ).orderBy("sample").collect()
    # 12 + 8 and 18 + 8 are inside 0..26, the anchor 24 is cut
    assert [r["sample"] for r in out] == [12, 18]
    assert out[0]["past"][3] == [None, 103.0] and len(out[0]["past"]) == 12
    assert out[0]["future"] == [[115.0 + i] for i in range(6)]
    assert out[0]["target"] == [15.0 + i for i in range(6)]


def test_missing_target_stays_in_the_window(spark):
    out = sequences.sequence_windows_day(
        _series(spark, 21, missing=16), keys=["k"], order="o", features=["qte", "w"], target="qte"
    ).first()
    assert out["target"] == [15.0, None, 17.0, 18.0, 19.0, 20.0]


def test_week_windows_skip_the_running_week(spark):
    out = sequences.sequence_windows_week(
        _series(spark, 9), keys=["k"], order="o", features=["qte", "w"], target="qte"
    ).orderBy("sample").collect()
    assert [r["sample"] for r in out] == [7, 8]
    assert [row[0] for row in out[0]["past"]] == [0, 1, 2, 3, 4, 5]
    assert (out[0]["future"], out[0]["target"]) == ([[107.0]], [7.0])
    assert [r["is_score"] for r in sequences.latest_window(spark.createDataFrame(out), keys=["k"]).orderBy("sample").collect()] == [False, True]


def _mondays(quantities, first=D(2021, 1, 4), skip=()):
    weeks = enumerate(quantities)
    return [(1, first + dt.timedelta(days=7 * w), q) for w, q in weeks if w not in skip]


def test_least_squares_uses_two_weeks_before(spark):
    rows = _mondays([1, 5, 3, 11, 7, 23])
    row = forecast.series_least_squares(spark.createDataFrame(rows, "g int, lundi date, qte long"), key="g").first()
    assert (row["n"], row["slope"], row["intercept"]) == (4, pytest.approx(2.0), pytest.approx(1.0))


def test_two_weeks_before_is_a_date_not_a_row(spark):
    # the third week is missing: weeks 4 and 6 pair with 2 and 4, week 5 with nothing
    rows = _mondays([1, 5, 0, 11, 7, 23], skip=(2,))
    row = forecast.series_least_squares(spark.createDataFrame(rows, "g int, lundi date, qte long"), key="g").first()
    assert (row["n"], row["slope"], row["intercept"]) == (2, pytest.approx(2.0), pytest.approx(1.0))


def test_weeks_hold_together_over_the_turn_of_a_year(spark):
    days = [(D(2020, 12, 28), 1, 10), (D(2021, 1, 2), 1, 5), (D(2021, 1, 11), 1, 40), (D(2021, 1, 12), 1, 2)]
    deliveries = spark.createDataFrame(days, "date_recolte date, code_adherent long, quantite_recolte long")
    weekly_rows = forecast.weekly_series(deliveries, key="code_adherent")
    assert {(r["lundi"], r["qte"]) for r in weekly_rows.collect()} == {(D(2020, 12, 28), 15), (D(2021, 1, 11), 42)}
    assert forecast.series_least_squares(weekly_rows, key="code_adherent").first()["n"] == 1


def _model_table(spark, order, features, n, target, series=(1, 2)):
    """Series whose quantity follows tmax of the same row; the last row is 2021-06-19 or week 24."""
    rng = random.Random(3)
    end = D(2021, 6, 19)
    days = [end - dt.timedelta(days=k) for k in range(2 * n)]
    days = sorted(d for d in days if d.weekday() < 6)[-n:]
    rows = []
    for one in series:
        for i in range(n):
            values = {f: rng.uniform(-1, 1) for f in features}
            values["tmax"] = float(rng.randrange(0, 30))
            values["qte"] = target(values["tmax"])
            if "semaine" in values:
                values["semaine"] = float((24 - n + i) % 52 + 1)
            rows.append((one, days[i] if order == "date_recolte" else i, *(values[f] for f in features)))
    kind = "date" if order == "date_recolte" else "int"
    return spark.createDataFrame(rows, f"code_insee int, {order} {kind}, " + ", ".join(f"{f} double" for f in features))


AS_OF = D(2021, 6, 10)
COMING = [D(2021, 6, 14 + k) for k in range(6)]


@pytest.mark.parametrize("model", ["moments", "windows"])
def test_forecast_recovers_a_linear_relation(spark, model):
    def quantity(tmax):
        return 500.0 + 20.0 * tmax

    n = 1800 if model == "windows" else 700
    day = _model_table(spark, "date_recolte", calendar.DAY_FEATURES, n, quantity)
    week = _model_table(spark, "id", calendar.WEEK_FEATURES, 600, quantity)
    run = forecast.sequence_forecast if model == "moments" else forecast.window_regression_forecast
    rows = run(day, week, keys=["code_insee"], as_of=AS_OF).collect()
    got = {(r["code_insee"], r["kind"], r["jour"]): r["pred"] for r in rows}
    assert set(got) == {(s, "day", d) for s in (1, 2) for d in COMING} | {(s, "week", COMING[0]) for s in (1, 2)}
    assert all(r["position"] == (r["jour"].weekday() if r["kind"] == "day" else 0) for r in rows)
    known = {(r["code_insee"], r["date_recolte"]): r["qte"] for r in day.collect()}
    last = {r["code_insee"]: r["qte"] for r in week.filter("id = 599").collect()}
    for (series, kind, jour), value in got.items():
        assert value == pytest.approx(known[series, jour] if kind == "day" else last[series], rel=0.06)


def test_moments_add_up_and_give_the_least_squares(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(size=90) * 50 + 300, rng.uniform(-1, 1, 90), np.full(90, 7.0)])
    y = 40 + 3 * x[:, 0] - 90 * x[:, 1] + rng.normal(size=90)
    rows = [(i % 3, *map(float, x[i]), float(y[i])) for i in range(90)] + [(0, None, 0.0, 7.0, 1e9), (1, 1.0, 0.0, 7.0, None)]
    df = spark.createDataFrame(rows, "part int, a double, b double, c double, y double").withColumn("k", F.lit(1))
    features = ["a", "b", "c"]
    single = regression.moment_rows(df, features=features, target="y")
    parts = regression.merged_moments(single, keys=["k", "part"], features=features)
    for moments in (single, parts):
        merged = regression.merged_moments(moments, keys=["k"], features=features)
        model = regression.solved(merged, features=features, penalty=0.02).first()
        centered = x[:, :2] - x[:, :2].mean(axis=0)
        penalty = 0.02 * 90 * np.diag(((x[:, :2].max(axis=0) - x[:, :2].min(axis=0)) / 2) ** 2)
        expected = np.linalg.solve(centered.T @ centered + penalty, centered.T @ (y - y.mean()))
        assert model["trained"] == 90
        assert model["coefficients"] == pytest.approx([*expected, 0.0], rel=1e-9)
        assert model["mean"] == pytest.approx(y.mean())
    assert regression.solved(parts.filter("part = 0"), features=features, least=31).collect() == []


@pytest.mark.parametrize("model", ["moments", "windows"])
@pytest.mark.parametrize("more", range(6))
def test_scored_days_are_the_last_six_for_any_number_of_rows(spark, model, more):
    day = _model_table(spark, "date_recolte", calendar.DAY_FEATURES, 600 + more, lambda t: 10 * t)
    if model == "moments":
        scored = forecast.day_rows(day, keys=["code_insee"]).filter("is_score")
        assert {(r["code_insee"], r["position"], r["jour"]) for r in scored.collect()} == {
            (s, k, d) for s in (1, 2) for k, d in enumerate(COMING)
        }
        assert {r["run_step"] for r in scored.select("run_step").collect()} == {(AS_OF - D(1970, 1, 1)).days}
        return
    samples = sequences.sequence_windows_day(
        day, keys=["code_insee"], order="date_recolte", features=calendar.DAY_FEATURES, target="qte", anchored="end"
    )
    last = sequences.latest_window(samples, keys=["code_insee"]).filter("is_score").collect()
    assert [r["days"] for r in last] == [COMING, COMING]


def test_windows_are_anchored_at_the_start_or_the_end(spark):
    with pytest.raises(ValueError, match="anchored"):
        sequences.sequence_windows_day(_series(spark, 30), keys=["k"], order="o", features=["qte"], target="qte", anchored="top")


def test_training_knows_nothing_of_the_run_day_and_later(spark):
    day = _model_table(spark, "date_recolte", calendar.DAY_FEATURES, 700, lambda t: 500 + 20 * t)
    week = _model_table(spark, "id", calendar.WEEK_FEATURES, 200, lambda t: 500 + 20 * t)
    spoilt = F.when(F.col("date_recolte") >= F.lit(AS_OF), F.lit(1e6)).otherwise(F.col("qte"))
    later = day.withColumn("qte", spoilt)
    spoilt_weeks = week.withColumn("qte", F.when(F.col("id") >= 198, F.lit(1e6)).otherwise(F.col("qte")))
    args = {"keys": ["code_insee"], "as_of": AS_OF}
    before = forecast.sequence_forecast(day, week, **args).collect()
    after = forecast.sequence_forecast(later, spoilt_weeks, **args).collect()
    assert sorted(before) == sorted(after)


def test_rolling_origin_equals_a_fit_per_run(spark):
    day = _model_table(spark, "date_recolte", calendar.DAY_FEATURES, 160, lambda t: 500 + 20 * t + t * t, series=(1,))
    rows = forecast.day_rows(day, keys=["code_insee"])
    rolled = {(r["position"], r["step"]): r for r in forecast.rolling_origin(rows, keys=["code_insee"]).collect()}
    table = rows.collect()
    assert rolled
    # each run alone: its own row to predict, and what lies before its run day
    for row in (r for r in table if (r["position"], r["step"]) in rolled and r["step"] % 5 == 0):
        run = spark.createDataFrame(
            [
                tuple(t[:6]) + (t["step"] == row["step"],) + tuple(t[7:])
                for t in table
                if t["position"] == row["position"] and (t["step"] < row["run_step"] or t["step"] == row["step"])
            ],
            rows.schema,
        )
        models = forecast.fit_models(run, keys=["code_insee"])
        scored = run.filter("is_score").join(models, ["code_insee", "kind", "position"])
        one = scored.select("trained", regression.predicted(forecast.INPUTS).alias("pred")).first()
        got = rolled[row["position"], row["step"]]
        assert (got["trained"], got["pred"]) == (one["trained"], pytest.approx(one["pred"], rel=1e-9))


def test_stored_models_are_picked_by_date_and_predict_as_fitted(spark, tmp_path):
    day = _model_table(spark, "date_recolte", calendar.DAY_FEATURES, 400, lambda t: 500 + 20 * t)
    rows = forecast.day_rows(day, keys=["code_insee"])
    stored = forecast.model_versions(rows, keys=["code_insee"], run_dates=["2021-05-13", AS_OF, D(2021, 6, 17)])
    path = str(tmp_path / "models")
    write_new(stored, path)
    read = spark.read.parquet(path)
    assert {r["version"] for r in read.collect()} == {D(2021, 5, 13), AS_OF, D(2021, 6, 17)}
    picked = forecast.models_as_of(read, keys=["code_insee"], as_of=AS_OF)
    assert {r["version"] for r in picked.collect()} == {AS_OF}
    fitted = forecast.fit_models(rows, keys=["code_insee"])
    assert sorted(forecast.predict(rows, picked, keys=["code_insee"]).collect()) == sorted(
        forecast.predict(rows, fitted, keys=["code_insee"]).collect()
    )
    old = forecast.models_as_of(read, keys=["code_insee"], as_of="2021-06-09")
    assert {r["version"] for r in old.collect()} == {D(2021, 5, 13)}
    assert forecast.models_as_of(read, keys=["code_insee"], as_of="2021-05-12").collect() == []


def test_missing_inputs_have_no_effect_and_short_series_no_model(spark):
    week = _model_table(spark, "id", calendar.WEEK_FEATURES, 400, lambda t: 100.0)
    gap = (F.col("code_insee") == 2) & (F.col("id") == 399)
    week = week.withColumn("tmax", F.when(~gap, F.col("tmax")))
    short = _model_table(spark, "id", calendar.WEEK_FEATURES, 15, lambda t: 10 * t, series=(3,))
    rows = forecast.week_rows(week.unionByName(short), keys=["code_insee"], as_of=AS_OF)
    models = forecast.fit_models(rows, keys=["code_insee"])
    got = {r["code_insee"]: r["pred"] for r in forecast.predict(rows, models, keys=["code_insee"]).collect()}
    assert got == {1: 100, 2: 100, 3: None}


def test_the_option_on_whole_windows_does_not_predict_from_a_gap(spark):
    week = _model_table(spark, "id", calendar.WEEK_FEATURES, 400, lambda t: 10 * t)
    gap = (F.col("code_insee") == 2) & (F.col("id") == 399)
    week = week.withColumn("tmax", F.when(~gap, F.col("tmax")))
    day = _model_table(spark, "date_recolte", calendar.DAY_FEATURES, 1800, lambda t: 10 * t)
    rows = forecast.window_regression_forecast(day, week, keys=["code_insee"], as_of=AS_OF).filter("kind = 'week'").collect()
    assert {r["code_insee"]: r["pred"] is None for r in rows} == {1: False, 2: True}


def test_nothing_to_train_whole_windows_on_is_an_error(spark):
    day = _model_table(spark, "date_recolte", calendar.DAY_FEATURES, 40, lambda t: t)
    day = day.withColumn("tmin", F.lit(None).cast("double"))
    week = _model_table(spark, "id", calendar.WEEK_FEATURES, 40, lambda t: t)
    with pytest.raises(ValueError, match="no complete window"):
        forecast.window_regression_forecast(day, week, keys=["code_insee"], as_of=AS_OF)


def _daily(spark, values, first=D(2021, 6, 14)):
    rows = [(first + dt.timedelta(days=k), v) for k, v in enumerate(values)]
    return spark.createDataFrame(rows, "jour date, pred long")


def _week(spark, value, monday=D(2021, 6, 14)):
    return spark.createDataFrame([(monday, value)], "jour date, pred long")


def test_published_week_is_clamped_and_starts_on_monday(spark):
    out = publish.publish_forecast(_daily(spark, [5, -3, None, 1, 2, 3]), _week(spark, -4), as_of=D(2021, 6, 10)).orderBy("jour")
    rows = [tuple(r) for r in out.collect()]
    assert rows == [
        (D(2021, 6, 14), 5, -4), (D(2021, 6, 15), 0, None), (D(2021, 6, 16), 0, None),
        (D(2021, 6, 17), 1, None), (D(2021, 6, 18), 2, None), (D(2021, 6, 19), 3, None),
    ]


def test_publishing_needs_a_thursday_and_the_six_days_themselves(spark):
    with pytest.raises(ValueError):
        publish.publish_forecast(_daily(spark, [1] * 6), _week(spark, 4), as_of=D(2021, 6, 11))
    with pytest.raises(Exception, match="needs 6 days"):
        publish.publish_forecast(_daily(spark, [1] * 5), _week(spark, 4), as_of=D(2021, 6, 10)).collect()
    # six values of other days are no forecast of this week
    with pytest.raises(Exception, match="needs 6 days"):
        publish.publish_forecast(_daily(spark, [1] * 6, D(2021, 6, 12)), _week(spark, 4), as_of=D(2021, 6, 10)).collect()
    twice = _daily(spark, [1] * 6).unionByName(_daily(spark, [1]))
    with pytest.raises(Exception, match="needs 6 days"):
        publish.publish_forecast(twice, _week(spark, 4), as_of=D(2021, 6, 10)).collect()
    more = publish.publish_forecast(_daily(spark, range(8)), _week(spark, 4, D(2021, 6, 7)), as_of=D(2021, 6, 10)).collect()
    assert {(r["jour"].day, r["pred2"], r["pred1"]) for r in more} == {(14 + k, k, None) for k in range(6)}


def test_the_ledger_names_every_gap(spark):
    days = [COMING[0] + dt.timedelta(days=k - 30) for k in range(36)]
    table = [(s, d) for s in (1, 2) for d in days[:30]] + [(3, d) for d in days[:4]]
    weeks = spark.createDataFrame([(s, w) for s in (1, 2) for w in range(9)] + [(3, 1)], "site int, id int")
    values = {0: 5, 1: -3, 2: None}
    made = [(1, "day", COMING[k], v) for k, v in values.items()] + [(1, "week", COMING[0], -4)]
    forecasts = spark.createDataFrame(made, "site int, kind string, jour date, pred long")
    expected = spark.createDataFrame([(1,), (2,), (3,), (4,), (4,)], "site int")
    rows = publish.forecast_ledger(
        expected, forecasts, spark.createDataFrame(table, "site int, jour date"), weeks, as_of=AS_OF, keys=["site"]
    ).collect()
    assert len(rows) == 4 * 7
    found = {(r["site"], r["kind"], r["jour"].day): (r["published"], r["reason"]) for r in rows}
    assert [found[1, "day", 14 + k] for k in range(4)] == [(5, "forecast"), (0, "negative"), (0, "no model"), (None, "day missing")]
    assert found[1, "week", 14] == (-4, "forecast") and found[2, "week", 14] == (None, "week missing")
    assert {reason for (site, *_), (_, reason) in found.items() if site == 3} == {"too short"}
    assert {reason for (site, *_), (_, reason) in found.items() if site == 4} == {"unknown"}


def test_upsert_replaces_stored_days(spark):
    stored = spark.createDataFrame([(D(2021, 6, 13), 1, None), (D(2021, 6, 14), 2, 3)], "jour date, pred2 long, pred1 long")
    new = spark.createDataFrame([(D(2021, 6, 14), 9, 8)], "jour date, pred2 long, pred1 long")
    out = {tuple(r) for r in publish.upsert_forecast(stored, new).collect()}
    assert out == {(D(2021, 6, 13), 1, None), (D(2021, 6, 14), 9, 8)}


def test_log_rows_carry_epoch_seconds(spark):
    out = publish.run_log(spark.sql("select 'rmse 3' as log"), at=dt.datetime(2021, 6, 10), info="i", page="p").first()
    assert tuple(out) == (1623283200, "cf", "i", "rmse 3", "p")


def test_seasons_from_a_table_follow_the_rules_and_take_new_rows(spark):
    days = spark.sql("select explode(sequence(date'2014-01-01', date'2026-12-31')) as date_recolte")
    deliveries = days.selectExpr("date_recolte", "1L as code_adherent", "2L as quantite_recolte")
    by_rule = season.harvest_season_by_grower(deliveries)
    intervals = season.harvest_intervals(spark)
    by_table = season.harvest_season_by_grower(deliveries, seasons=intervals)
    assert sorted(by_rule.collect()) == sorted(by_table.select(*by_rule.columns).collect())
    more = spark.createDataFrame([(2024, D(2024, 9, 1), D(2025, 8, 31), 1), (1999, D(2024, 9, 1), D(2024, 8, 1), 0)], season.INTERVALS)
    longer = season.harvest_season_by_grower(deliveries, seasons=intervals.union(more))
    found = {r["date_recolte"]: r["saison"] for r in longer.collect()}
    assert (found[D(2024, 8, 31)], found[D(2024, 9, 1)], found[D(2025, 8, 31)], found[D(2025, 9, 1)]) == (2023, 2024, 2024, None)

    sowing = days.selectExpr("date_recolte as date_plantation", "1L as code_adherent", "2.0 as qte_semis")
    table = season.with_planting_season(sowing, seasons=season.planting_intervals(spark))
    assert sorted(season.with_planting_season(sowing).collect()) == sorted(table.collect())


@pytest.mark.parametrize("ranges", [1, 2, 7, 64])
def test_average_ranks_by_ranges_equal_a_sort(spark, ranges):
    rng = random.Random(8)
    values = {1: [rng.choice([0.0, -0.0, 1.5, rng.random()]) for _ in range(900)], 2: [4.0] * 5, 3: [None, None], 4: [1.0, None, -2.0]}
    df = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs], "k int, v double").repartition(5)
    found = {(r["k"], r["v"]): r["rank"] for r in comparison.average_ranks(df, "v", keys=["k"], ranges=ranges).collect()}
    for k, all_values in values.items():
        known = [v for v in all_values if v is not None]
        for v in set(known):
            assert found.pop((k, v)) == sum(x < v for x in known) + (known.count(v) + 1) / 2
    assert found == {}
