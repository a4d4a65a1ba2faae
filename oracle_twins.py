"""DuckDB twins of the registered queries, on the same parquet tables.

Each twin is a plain SQL statement over the base tables. ``VIEWS`` holds the source
tables and shared steps as named subqueries; a twin lists the ones it needs. The twins
state the meaning of an operator in the most direct way and share no code with it.
"""

from __future__ import annotations

SHIP = "(cast(l_shipdate as date) + 7670)"
ORDERED = "(cast(o_orderdate as date) + 7670)"
SITE = 1
SITES = (0, 1, 2, 3)
AS_OF = "date '2021-06-10'"

MEASURES = (
    "tmin", "tmax", "rr10", "etp", "probawind70", "probawind100", "probafrost",
    "probafog", "probarain", "gust10m", "wind10m", "sunhours",
)


def week_of(day: str) -> str:
    return f"cast(year({day}) as int) as annee, cast(weekofyear({day}) as int) as semaine"


def surface(year: int) -> str:
    return (
        f"case when year({ORDERED}) in ({year}, {year - 1}) and o_custkey % 3 <> 0 "
        f"then cast((o_custkey % 5) * 0.5 as double) end as surface_{year}"
    )


def season_case(day: str, last: int, beyond: str) -> str:
    start = f"(year({day}) - case when month({day}) < 9 then 1 else 0 end)"
    return (
        f"case when {day} < date '2016-09-01' then 2015 "
        f"when {start} > {last} then {beyond} else cast({start} as int) end"
    )


def planting_case(day: str) -> str:
    end = f"(year({day}) + case when month({day}) * 100 + day({day}) >= 515 then 1 else 0 end)"
    return (
        f"case when {day} < date '2016-09-01' then 2015 "
        f"when {end} <= 2022 then cast({end} as int) end"
    )


def rounded(x: str, places: int = 9) -> str:
    return f"cast(cast({x} as decimal(30,{places})) as double)"


def percent(pred: str, real: str) -> str:
    value = f"abs({pred} - {real}) / nullif(cast({real} as double), 0) * 100"
    return f"cast(round(cast({value} as decimal(30,10)), 2) as double)"


def trailing(source: str, name: str, start: int, end: str, partition: str = "code_insee") -> str:
    return (
        f"cast(sum({source}) over (partition by {partition} order by date_reelle "
        f"rows between {start} preceding and {end}) as bigint) as {name}"
    )


VIEWS: dict[str, str] = {
    "deliveries_all": f"""
        select {SHIP} as date_recolte, l_suppkey as code_adherent,
               cast(l_quantity as bigint) as quantite_recolte
        from lineitem""",
    "archive": "select * from deliveries_all where date_recolte < date '2018-01-01'",
    "live": "select * from deliveries_all where date_recolte >= date '2018-01-01'",
    "pred_deliveries": "select * from deliveries_all where date_recolte >= date '2021-01-01'",
    "grower_deliveries": """
        select code_adherent as prdcode, date_recolte as liv_date, quantite_recolte as liv_qty
        from deliveries_all""",
    "announced": f"""
        select o_custkey % 100 as code_adherent, cast(o_orderkey % 60 + 1 as bigint) as quantite_recolte,
               {ORDERED} as date_recolte from orders""",
    "calendar": f"""
        select jour from (select distinct {SHIP} as jour from lineitem
                          union select distinct {ORDERED} as jour from orders)
        where extract(dow from jour) > 0""",
    "holidays": f"""
        select distinct {ORDERED} as jour from orders
        where month({ORDERED}) * 100 + day({ORDERED})
              in (101, 501, 508, 714, 815, 1101, 1111, 1225)""",
    "weather_raw": f"""
        select d as date_reelle, code_insee,
               k % 36 - 5 - u % 9 as tmin, k % 36 - 2 as tmax,
               cast(case when u % 17 = 0 then -99 else greatest(u % 29 - 9, 0) end as bigint) as rr10,
               """
    + ",\n               ".join(
        f"case when k % 13 = {i} then -99 else u % {m} end as {name}"
        for i, (name, m) in enumerate(zip(MEASURES[3:], (8, 50, 40, 60, 70, 90, 110, 55, 15)))
    )
    + f"""
        from (select {ORDERED} as d, o_custkey % 4 as code_insee,
                     cast(sum(o_orderkey) as bigint) as k, cast(sum(o_custkey) as bigint) as u
              from orders group by 1, 2)""",
    "weather": "select date_reelle, code_insee, "
    + ", ".join(f"nullif({m}, -99) as {m}" for m in MEASURES)
    + " from weather_raw",
    "plantings": f"""
        select o_custkey % 100 as code_adherent, o_orderpriority as variete_norm,
               {ORDERED} as date_plantation, {", ".join(surface(y) for y in range(2016, 2023))}
        from orders""",
    "forecast_daily": f"""
        select {ORDERED} as jour, cast(sum(o_orderkey) % 900 + 200 as bigint) as dt
        from orders group by 1""",
    "delivery_counts": f"""
        select {week_of(SHIP)}, cast(count(*) as bigint) as apports_reportes,
               cast(case when sum(l_suppkey) % 9 = 0 then null
                         else count(*) + sum(l_suppkey) % 5 + 1 end as bigint) as apports_predits
        from lineitem group by 1, 2""",
    "forecast_final": f"""
        select {week_of(ORDERED)}, cast(sum(o_custkey) % 4000 + 500 as bigint) as pred
        from orders group by 1, 2 having sum(o_custkey) % 4 <> 0""",
    "growers": """
        select s_suppkey as code_adherent, cast(s_nationkey % 4 as bigint) as code_insee,
               cast(case when s_nationkey % 5 = 4 then null else s_nationkey % 7 end as bigint)
                 as numero_station
        from supplier where s_suppkey % 20 <> 7""",
    "sowings": f"""
        select o_custkey % 100 as code_adherent, cast(year({ORDERED}) as int) as annee,
               cast(sum(o_custkey % 50) as bigint) as quantite_initiale
        from orders where o_custkey % 100 <> 13 group by 1, 2""",
    "model_forecasts": f"""
        select jour, k % 101 as bro_pred_vg, u % 103 as bro_pred_cleder,
               k % 107 as pred_vg_fd_knn, u % 109 as pred_cleder_fd_knn,
               k % 113 as pred_vg_fd_xgb,
               case when u % 11 = 0 then null else u % 127 end as pred_cleder_fd_xgb,
               k % 131 as pred_vg_fd_keras, u % 137 as pred_cleder_fd_keras
        from (select {ORDERED} as jour, cast(sum(o_orderkey) as bigint) as k,
                     cast(sum(o_custkey) as bigint) as u
              from orders group by 1)""",
    # intake
    "daily": """
        select date_recolte, cast(sum(quantite_recolte) as bigint) as quantite_recolte
        from deliveries_all group by 1""",
    "spine": """
        select jour as date_recolte, quantite_recolte
        from calendar left join daily on jour = date_recolte""",
    "observed": "select date_reelle, code_insee, tmin, tmax, rr10, "
    + ", ".join(
        trailing(src, f"cumul{src}", n, "current row")
        for src, n in (("tmax", 38), ("tmin", 28), ("rr10", 28))
    )
    + " from weather",
    "site_days": f"""
        select s.code_insee, date_recolte, quantite_recolte, tmin, tmax, rr10,
               cumultmax, cumultmin, cumulrr10
        from spine cross join (select unnest([{", ".join(map(str, SITES))}]) as code_insee) s
        left join observed o on o.date_reelle = date_recolte and o.code_insee = s.code_insee""",
    "flux_day_sites": """
        select cast(code_insee as bigint) as code_insee, date_recolte as jour, quantite_recolte as qte,
               cast(tmin as int) as t_min, cast(tmax as int) as t_max,
               cast(cumultmax as int) as ctmax, cast(cumultmin as int) as ctmin,
               cast(cumulrr10 as int) as cpluie
        from site_days where date_recolte > date '2016-02-05'""",
    "site_weeks": f"""
        select *, row_number() over (partition by code_insee order by an, sem) as id
        from (select cast(code_insee as bigint) as code_insee, year(date_recolte) as an,
                     weekofyear(date_recolte) as sem, {", ".join(
                         f"sum({c}) as {n}" for c, n in (
                             ("quantite_recolte", "qte"), ("tmin", "t_min"), ("tmax", "t_max"),
                             ("rr10", "pluie"), ("cumultmax", "ctmax"), ("cumultmin", "ctmin"),
                             ("cumulrr10", "cpluie")))}
              from site_days where date_recolte >= date '2016-02-08' group by 1, 2, 3)""",
    "flux_week_sites": f"""
        select code_insee, cast(id as int) as id, cast(sem as int) as sem, cast(an as int) as an,
               cast(qte as bigint) as qte, {", ".join(
                   f"cast({c} as int) as {c}"
                   for c in ("t_min", "t_max", "pluie", "ctmax", "ctmin", "cpluie"))}
        from site_weeks where t_min is not null""",
    "flux_day_until": f"""
        select * from flux_day_sites
        where jour >= date '2016-02-11' and jour <= {AS_OF} + 10""",
    "flux_week_until": f"""
        select w.* from flux_week_sites w
        join (select code_insee, id as last_id from flux_week_sites
              where an = isoyear({AS_OF} + 7) and sem = week({AS_OF} + 7)) using (code_insee)
        where id <= last_id""",
    # weekly
    "weekly_weather": f"""
        select {week_of("date_reelle")}, {", ".join(
            f"cast(sum({m}) as bigint) as {m}" for m in ("tmax", "tmin", "rr10"))}
        from weather where code_insee = {SITE} group by 1, 2""",
    "weekly_count": f"""
        select {week_of("date_recolte")}, count(code_adherent) as nbr_apports,
               cast(sum(quantite_recolte) as bigint) as reel
        from live group by 1, 2""",
    "holiday_sums": f"""
        select jour, sum(quantite_recolte) as received
        from holidays left join live on jour = date_recolte
        where jour <= {AS_OF} group by 1""",
    "worked_holidays": f"""
        select {week_of("jour")},
               cast(sum(case when received is not null then 1 end) as bigint) as nb_jr_ferie
        from holiday_sums group by 1, 2""",
    "weekly_profile": """
        select w.semaine as week, w.annee as season, c.nbr_apports as nombre_apports,
               cast(coalesce(h.nb_jr_ferie, 0) as int) as nombre_jours_feries,
               cast(tmin as int) as t_min, cast(tmax as int) as t_max, cast(rr10 as double) as pluie
        from weekly_weather w
        left join weekly_count c on c.semaine = w.semaine and c.annee = w.annee
        left join worked_holidays h on h.semaine = w.semaine and h.annee = w.annee""",
    "weekly_forecast_error": f"""
        with p as (select {week_of("jour")}, sum(dt) as rf from forecast_daily
                   where jour >= date '2019-09-09' group by 1, 2),
             r as (select {week_of("date_recolte")}, sum(quantite_recolte) as reel from live
                   where date_recolte >= date '2019-09-09' group by 1, 2),
             n as (select * from delivery_counts where annee >= 2019),
             m as (select *, lag(tmin) over (order by semaine, annee) as dtmin,
                          lag(tmax) over (order by semaine, annee) as dtmax from weekly_weather)
        select m.annee as saison, m.semaine as sem, cast(rf as bigint) as pred,
               cast(reel as bigint) as qte_recolte, {percent("rf", "reel")} as er_pct,
               abs(apports_predits - apports_reportes) as dif_apports,
               abs((apports_reportes - apports_predits) / cast(apports_predits as double))
                 as quotient_apports,
               apports_predits as app_predits, apports_reportes as app_reportes,
               cast(dtmin as int) as dif_tmin, cast(dtmax as int) as dif_tmax,
               cast(tmin as int) as t_min, cast(tmax as int) as t_max
        from p left join r on r.semaine = p.semaine and r.annee = p.annee
        left join n on n.semaine = p.semaine and n.annee = p.annee
        left join m on m.semaine = p.semaine and m.annee = p.annee
        where apports_predits is not null""",
    "weekly_forecast": f"select {week_of('jour')}, cast(sum(dt) as bigint) as rf from forecast_daily group by 1, 2",
    "weather_weeks": """
        select w.*, c.nbr_apports, c.reel, f.rf, c.annee as count_annee, c.semaine as count_semaine
        from weekly_weather w
        left join weekly_count c on c.semaine = w.semaine and c.annee = w.annee
        left join weekly_forecast f on f.semaine = w.semaine and f.annee = w.annee""",
    # season
    "flags": """
        select *, (tmin < 0) is true as b_gel, (tmin < 5) is true as b_froid,
               (tmax < 10) is true as b_jf, (tmax < 5) is true as b_jtf,
               (tmax >= 15 and tmax <= 25) is true as b_jc, (tmax >= 15 and tmax <= 20) is true as b_jd,
               (rr10 > 0) is true as b_ar, (rr10 > 8) is true as b_pm, (rr10 > 15) is true as b_pf
        from weather""",
    "flagged": """
        select * exclude (b_gel, b_froid, b_jf, b_jtf, b_jc, b_jd, b_ar, b_pm, b_pf),
               cast(b_gel as int) as gel, cast(b_froid as int) as froid,
               cast(b_jf as int) as jourfroid, cast(b_jtf as int) as jourtresfroid,
               cast(b_jc as int) as jourchaud, cast(b_jd as int) as jourdoux,
               cast(b_ar as int) as arrosage, cast(b_pm as int) as pluiemoderee,
               cast(b_pf as int) as pluieforte
        from flags""",
    "sowing": " union all ".join(
        f"select cast(code_adherent as varchar) as code_adherent, variete_norm, date_plantation, "
        f"12000 * surface_{y} as qte_semis, cast({y} as int) as annee from plantings "
        f"where year(date_plantation) = {y} and surface_{y} is not null"
        for y in range(2016, 2023)
    ),
    "sowing_season": f"""
        select code_adherent, {planting_case("date_plantation")} as saison, sum(qte_semis) as qte_semis
        from sowing group by 1, 2""",
    "season_totals": f"""
        select {planting_case("date_plantation")} as saison, cast(sum(qte_semis * 3) as bigint) as qte_semis
        from sowing group by 1""",
    "harvest": f"""
        select date_recolte, {season_case("date_recolte", 2023, "null")} as saison, code_adherent,
               cast(sum(quantite_recolte) as bigint) as quantite_recolte
        from deliveries_all group by 1, 2, 3""",
    "intake_sowing": """
        select date_recolte, sum(s.qte_semis) as qte_semis,
               cast(sum(h.quantite_recolte) as bigint) as quantite_recolte
        from harvest h left join sowing_season s
          on s.saison = h.saison and s.code_adherent = cast(h.code_adherent as varchar)
        group by 1""",
    "midweek": f"""
        select {week_of("date_recolte")}, {season_case("date_recolte", 2022, "2022")} as saison,
               cast(sum(quantite_recolte) as bigint) as mi_week_quantite_recolte
        from deliveries_all where extract(dow from date_recolte) <= 4 group by 1, 2, 3""",
    "whole_week": f"""
        select {week_of("date_recolte")}, cast(sum(quantite_recolte) as bigint) as quantite_recolte
        from deliveries_all group by 1, 2""",
    "b1": "select *, "
    + ", ".join(
        f"lag({src}, {k}) over (order by annee, semaine, saison) as {name}_{k}"
        for name, src in (("ratio", "ratio"), ("mi_recolte", "mi_week_quantite_recolte"))
        for k in range(1, 6)
    )
    + """ from (select m.*, w.quantite_recolte,
                       cast(mi_week_quantite_recolte as double) / nullif(cast(w.quantite_recolte as double), 0)
                         as ratio
                from midweek m join whole_week w on w.annee = m.annee and w.semaine = m.semaine)""",
    "b2": f"""
        select s.saison, semaine, annee, quantite_recolte, t.qte_semis,
               cast(t.qte_semis - sum(quantite_recolte) over (
                 partition by s.saison order by annee, semaine
                 rows between unbounded preceding and 1 preceding) as bigint) as nbre_semis_restant
        from (select {season_case("date_recolte", 2022, "2022")} as saison, {week_of("date_recolte")},
                     cast(sum(quantite_recolte) as bigint) as quantite_recolte
              from deliveries_all group by 1, 2, 3) s
        join season_totals t on t.saison = s.saison""",
    "weekly_to_day": f"""
        select date_recolte, b1.saison, b1.semaine, mi_week_quantite_recolte, {", ".join(
            f"{n}_{k}" for n in ("mi_recolte", "ratio") for k in range(1, 6))}, nbre_semis_restant
        from (select date_recolte, {week_of("date_recolte")} from daily) d
        left join b1 on b1.semaine = d.semaine and b1.annee = d.annee
        left join b2 on b2.semaine = d.semaine and b2.annee = d.annee""",
    "season_days": """
        select i.date_recolte, quantite_recolte, qte_semis, saison, semaine,
               cast(dayofyear(i.date_recolte)
                    + case when dayofyear(i.date_recolte) < 244 then 365 else 0 end - 244 as int)
                 as jour_saison
        from intake_sowing i left join weekly_to_day w on w.date_recolte = i.date_recolte""",
    # station
    "grower_intake": """
        select prdcode as code_adherent, liv_qty as quantite_recolte, liv_date as date_recolte,
               cast(year(liv_date) as int) as annee, code_insee
        from grower_deliveries left join growers on code_adherent = prdcode""",
    "announced_intake": """
        select a.code_adherent, quantite_recolte, date_recolte, cast(year(date_recolte) as int) as annee, code_insee
        from announced a left join growers g on g.code_adherent = a.code_adherent""",
    "sowing_commune": """
        select code_insee, annee, cast(sum(quantite_initiale) as bigint) as quantite_initiale
        from sowings s left join growers g on g.code_adherent = s.code_adherent group by 1, 2""",
    "sowing_commune_recent": """
        select code_insee, annee, cast(sum(quantite_initiale) as bigint) as quantite_initiale
        from sowings s left join growers g on g.code_adherent = s.code_adherent
        where annee >= 2019 group by 1, 2""",
    "stations": "select distinct code_insee, numero_station from growers where numero_station is not null",
}

STATION_SUMS = (
    ("levee", "levee_brocolis_ideale", 11), ("tmax", "tmax_30j_sum", 31), ("tmax", "tmax_10j_sum", 11),
    ("tmax", "tmax_2j_sum", 3), ("rr10", "rr_17j_sum", 19), ("froid", "jour_froid_sum", 20),
)


def _weather_windows(where: str) -> str:
    sums = ", ".join(
        trailing(src, name, n, "1 preceding", "year(date_reelle), code_insee") for src, name, n in STATION_SUMS
    )
    return f"""
        select date_reelle, code_insee, tmin, tmax, rr10, {sums}
        from (select *, case when tmin < 5 then 1 else 0 end as froid,
                     case when tmax between 15 and 25 then 1 else 0 end as levee
              from weather {where})"""


VIEWS["windows"] = _weather_windows("")
VIEWS["windows_recent"] = _weather_windows("where date_reelle > date '2019-01-01'")


def _intake_commune(where: str, sowing: str, intake: str = "grower_intake") -> str:
    return f"""
        select a.*, quantite_initiale
        from (select code_insee, date_recolte, cast(sum(quantite_recolte) as bigint) as quantite_recolte,
                     annee from {intake} {where} group by 1, 2, 4) a
        left join {sowing} s on s.code_insee = a.code_insee and s.annee = a.annee"""


VIEWS["intake_commune"] = _intake_commune("", "sowing_commune")
VIEWS["intake_commune_recent"] = _intake_commune(
    "where date_recolte >= date '2019-01-01'", "sowing_commune_recent"
)
VIEWS["intake_commune_predict"] = _intake_commune(
    "where date_recolte > date '2022-01-01'", "sowing_commune_recent", "announced_intake"
)


def _weather_join(intake: str, windows: str) -> str:
    return f"""
        select i.*, {", ".join(f"w.{c}" for c in (
            "tmin", "tmax", "rr10", *(n for _, n, _ in STATION_SUMS)))}
        from (select distinct * from {intake}) i
        left join {windows} w on w.code_insee = i.code_insee and w.date_reelle = i.date_recolte"""


def _station_features(joined: str) -> str:
    averaged = (
        "tmax_30j_sum", "tmax_10j_sum", "tmax_2j_sum", "tmax", "rr10", "rr_17j_sum",
        "levee_brocolis_ideale", "jour_froid_sum",
    )
    return f"""
        select cast(numero_station as int) as numero_station, date_recolte,
               {", ".join(f"avg({c}) as {c}" for c in averaged)},
               cast(sum(quantite_initiale) as bigint) as quantite_initiale,
               cast(sum(quantite_recolte) as bigint) as quantite_recolte
        from {joined} j left join stations s on s.code_insee = j.code_insee group by 1, 2"""


for _suffix, _windows in (("", "windows"), ("_recent", "windows_recent"), ("_predict", "windows_recent")):
    VIEWS[f"joined{_suffix}"] = _weather_join(f"intake_commune{_suffix}", _windows)

# fixed values: suffixes of the trailing sums by measure
CUMULS = {
    "cumultmax": ("tmax", (2, 3, 4, 5, 7, 9, 13, 18, 22, 29, 38, 60)),
    "cumultmin": ("tmin", (2, 3, 4, 5, 8, 12, 19, 25, 29, 35, 60)),
    "cumulrr10": ("rr10", (2, 3, 4, 5, 7, 10, 17, 27, 37, 60)),
    "cumuljourfroid": ("jourfroid", (4, 7, 13, 18, 28, 35, 60)),
    "cumuljourchaud": ("jourchaud", (2, 4, 6, 8, 11, 17, 23, 33, 38, 60)),
    "cumuljourdoux": ("jourdoux", (4, 9, 13, 15, 26, 38, 60)),
    "cumularrosage": ("arrosage", (7, 17, 27, 37, 60)),
    "cumulgel": ("gel", (3, 4, 5, 6, 7, 38, 60)),
    "cumuljtf": ("jourtresfroid", (3, 4, 5, 6, 7, 38, 60)),
    "cumulpm": ("pluiemoderee", (3, 4, 5, 6, 7, 38, 60)),
    "cumulpf": ("pluieforte", (3, 4, 5, 6, 7, 38, 60)),
    "cumulfroid": ("froid", (3, 4, 5, 6, 7, 38, 60)),
}

# fixed values: measure, rows back, name
LAGS = (
    ("tmax", 1, "t1"), ("tmax", 2, "t2"), ("tmax", 4, "t4"),
    ("rr10", 1, "p1"), ("rr10", 2, "p2"), ("rr10", 4, "p4"), ("rr10", 7, "p7"),
)


def _lags() -> str:
    return ", ".join(
        f"lag({src}, {k}) over (partition by code_insee order by date_reelle) as {name}" for src, k, name in LAGS
    )


VIEWS["cumuls"] = (
    "select code_insee, date_reelle, tmax, tmin, rr10, jourchaud, jourdoux, arrosage, "
    + _lags()
    + ", "
    + ", ".join(
        trailing(src, f"{prefix}{k}", k + 1, "1 preceding")
        for prefix, (src, ks) in CUMULS.items()
        for k in ks
    )
    + " from flagged"
)

# fixed values: trailing sums shown as double and as int, by prefix of their names
DOUBLES = {
    "cumul_tmax": ("cumultmax", (7, 38, 60)), "cumul_tmin": ("cumultmin", (8, 35, 60)),
    "cumul_jourfroid": ("cumuljourfroid", (7, 35, 60)), "cumul_jourchaud": ("cumuljourchaud", (8, 38, 60)),
    "cumul_pluie": ("cumulrr10", (7, 37, 60)), "cumul_jourdoux": ("cumuljourdoux", (9, 38, 60)),
    "cumul_jour_de_pluie": ("cumularrosage", (7, 37, 60)),
}
INTS = {
    "gel": ("cumulgel", (7, 38, 60)), "jtf": ("cumuljtf", (7, 38, 60)), "pm": ("cumulpm", (7, 38, 60)),
    "pf": ("cumulpf", (7, 38, 60)), "fr": ("cumulfroid", (7, 38)), "df": ("cumulfroid", (60,)),
}


def _season_features(where: str) -> str:
    doubles = [f"cast({src}{k} as double) as {out}{k}" for out, (src, ks) in DOUBLES.items() for k in ks]
    ints = [f"cast({src}{k} as int) as {out}{k}" for out, (src, ks) in INTS.items() for k in ks]
    return f"""
        select d.date_recolte as liv_date, jour_saison as jr_saison, quantite_recolte as qte_recolte,
               cast(qte_semis as bigint) as quantite_initiale, cast(tmin as double) as t_min,
               cast(tmax as double) as t_max, cast(rr10 as double) as pluie,
               {", ".join(doubles + ints)}
        from season_days d
        left join (select * from cumuls where code_insee = {SITE}) c on c.date_reelle = d.date_recolte
        where {where}"""


# model inputs
PI2 = "(2 * pi())"
DAY_FEATURES = (
    "qte", "tmax", "tmin", "ctmin", "ctmax", "cpluie", "weekday_cos", "weekday_sin",
    "day_cos", "day_sin", "annee_cos", "annee_sin", "samedis",
)
WEEK_FEATURES = (
    "semaine", "qte", "tmin", "tmax", "pluie", "ctmax", "ctmin", "cpluie", "mois_cos",
    "mois_sin", "semaine_cos", "semaine_sin", "semaine_sin2",
)
VIEWS["day_features"] = f"""
    select code_insee, jour as date_recolte, qte, t_max as tmax, t_min as tmin, ctmin, ctmax, cpluie,
           cos((isodow(jour) - 1) * {PI2} / 7) as weekday_cos,
           sin((isodow(jour) + 4) * {PI2} / 7) as weekday_sin,
           cos(day(jour) * {PI2} / 30.5) as day_cos, sin(day(jour) * {PI2} / 30.5) as day_sin,
           cos((dayofyear(jour) + 315) * {PI2} / 365.25) as annee_cos,
           sin((dayofyear(jour) + 265) * {PI2} / 365.25) as annee_sin,
           cast(case when isodow(jour) = 6 then 1 else -1 end as int) as samedis
    from flux_day_until"""
VIEWS["week_features"] = f"""
    select code_insee, id, sem as semaine, qte, t_min as tmin, t_max as tmax, pluie, ctmax, ctmin, cpluie,
           cos(sem * {PI2} / 12) as mois_cos, sin(sem * {PI2} / 12) as mois_sin,
           cos(sem * {PI2} / 52.2) as semaine_cos, sin(sem * {PI2} / 52.2) as semaine_sin,
           sin((sem + 4) * {PI2} / 52.2) as semaine_sin2
    from flux_week_until"""
VIEWS["day_rows"] = """
    select *, row_number() over (partition by code_insee order by date_recolte) - 1 as i,
           count(*) over (partition by code_insee) as n
    from day_features"""
VIEWS["week_rows"] = """
    select *, row_number() over (partition by code_insee order by id) - 1 as i,
           count(*) over (partition by code_insee) as n
    from week_features"""
VIEWS["day_anchors"] = "select code_insee, i as sample from day_rows where i >= 12 and (i - 12) % 6 = 0 and i + 8 < n"
VIEWS["week_anchors"] = "select code_insee, i as sample from week_rows where i >= 7"



# forecasts: inputs of each target day and week, and ridge regressions on them
VIEWS["day_targets"] = """
    select r.code_insee, 'day' as kind, cast(5 - (r.n - 1 - r.i) % 6 as int) as position, r.date_recolte as jour,
           cast(r.date_recolte - date '1970-01-01' as int) as step,
           cast(a.date_recolte - date '1970-01-01' as int) as run_step, r.n - r.i <= 6 as is_score,
           cast(r.qte as double) as label, a.past as x0, coalesce(cast(b.qte as double), a.past) as x1,
           cast(r.tmax as double) as x2, cast(r.cpluie as double) as x3, r.annee_cos as x4, r.annee_sin as x5
    from day_rows r
    join (select *, avg(cast(qte as double)) over (partition by code_insee order by i rows between 12 preceding and 1 preceding) as past
          from day_rows) a
      on a.code_insee = r.code_insee and a.i = r.i - 3 - (5 - (r.n - 1 - r.i) % 6) and a.i >= 12
    left join day_rows b on b.code_insee = r.code_insee and b.date_recolte = r.date_recolte - 14"""
VIEWS["week_targets"] = """
    select r.code_insee, 'week' as kind, 0 as position,
           case when r.i = r.n - 1 and r.semaine = 24 then date '2021-06-14' end as jour,
           cast(r.id as int) as step, cast(r.id - 1 as int) as run_step, r.i = r.n - 1 as is_score,
           cast(r.qte as double) as label, r.past as x0, coalesce(cast(b.qte as double), r.past) as x1,
           cast(r.tmax as double) as x2, cast(r.pluie as double) as x3, r.semaine_cos as x4, r.semaine_sin2 as x5
    from (select *, avg(cast(qte as double)) over (partition by code_insee order by i rows between 7 preceding and 2 preceding) as past
          from week_rows) r
    left join week_rows b on b.code_insee = r.code_insee and b.id = r.id - 2
    where r.i >= 7"""
VIEWS["targets"] = "select * from day_targets union all by name select * from week_targets"
VIEWS["run_days"] = "select code_insee, kind, max(run_step) as run_day from targets where is_score group by 1, 2"
INPUTS = [f"x{i}" for i in range(6)]
KNOWN = " and ".join(f"{c} is not null" for c in (*INPUTS, "label"))


def _ridge(source: str, keys: str) -> str:
    """Per key the ridge regression of ``label``: n, mean, m0.., b0.. (features penalised by half their range)."""
    values = [*INPUTS, "label"]
    count = len(INPUTS)
    pairs = [(i, j) for i in range(count) for j in range(i, count + 1)]
    sums = ", ".join(f"sum({v}) as s{i}" for i, v in enumerate(values))
    products = ", ".join(f"sum({values[i]} * {values[j]}) as p{i}_{j}" for i, j in pairs)
    bounds = ", ".join(f"(max({v}) - min({v})) / 2 as h{i}" for i, v in enumerate(INPUTS))
    text = f"select {keys}, count(*) as n, {sums}, {products}, {bounds} from ({source}) where {KNOWN} group by {keys} having count(*) >= 12"

    def equation(i: int, j: int) -> str:
        fixed = f"h{i} = 0" + (f" or h{j} = 0" if j < count else "")
        penalty = f" + 0.01 * n * h{i} * h{i}" if i == j else ""
        return f"case when {fixed} then {'1.0' if i == j else '0.0'} else p{i}_{j} - s{i} * s{j} / n{penalty} end as a{i}_{j}"

    means = ", ".join(f"s{i} / n as m{i}" for i in range(count))
    kept = f"{keys}, n, mean, {', '.join(f'm{i}' for i in range(count))}"
    text = f"select {keys}, n, s{count} / n as mean, {means}, {', '.join(equation(i, j) for i, j in pairs)} from ({text})"
    for k in range(count - 1):
        rows = [
            f"a{i}_{j} - a{k}_{i} * a{k}_{j} / a{k}_{k} as a{i}_{j}" if i > k else f"a{i}_{j}" for i, j in pairs
        ]
        text = f"select {kept}, {', '.join(rows)} from ({text})"
    solved: list[str] = []
    for i in reversed(range(count)):
        minus = "".join(f" - a{i}_{j} * b{j}" for j in range(i + 1, count))
        text = f"select *, (a{i}_{count}{minus}) / a{i}_{i} as b{i} from ({text})"
        solved.append(f"b{i}")
    return f"select {kept}, {', '.join(solved)} from ({text})"


PREDICTED = "mean" + "".join(f" + coalesce(b{i} * (x{i} - m{i}), 0)" for i in range(len(INPUTS)))
QUANTITY = f"cast(trunc(round({PREDICTED}, 6)) as bigint)"
VIEWS["models"] = _ridge(
    "select t.* from targets t join run_days r on r.code_insee = t.code_insee and r.kind = t.kind where step < run_day",
    "code_insee, kind, position",
)
VIEWS["forecasts"] = f"""
    select t.code_insee, t.kind, t.position, t.jour, {QUANTITY} as pred
    from targets t left join models m on m.code_insee = t.code_insee and m.kind = t.kind and m.position = t.position
    where is_score"""
# every target with the fit of all targets that its run knew
VIEWS["origins"] = f"""
    select t.code_insee, t.kind, t.position, t.step, label, {PREDICTED} as pred
    from targets t join ({_ridge(
        "select q.code_insee, q.kind, q.position, q.step as origin, t.* exclude (code_insee, kind, position)"
        " from targets q join targets t on t.code_insee = q.code_insee and t.kind = q.kind"
        " and t.position = q.position and t.step < q.run_step",
        "code_insee, kind, position, origin",
    )}) m on m.code_insee = t.code_insee and m.kind = t.kind and m.position = t.position and m.origin = t.step
    where label is not null"""
VIEWS["stored_models"] = _ridge(
    f"select d.*, version from day_targets d join (select unnest([{AS_OF} - 56, {AS_OF} - 28, {AS_OF} - 7, {AS_OF} + 7]) as version)"
    " v on d.jour < version",
    "code_insee, kind, position, version",
)


TRIG = {c for c in (*DAY_FEATURES, *WEEK_FEATURES) if c.endswith(("_cos", "_sin", "_sin2"))}


def _shown(columns: tuple[str, ...], doubles: bool = False) -> str:
    return ", ".join(
        f"{rounded(c)} as {c}" if c in TRIG or doubles else c for c in columns
    )


def _sequence(rows: str, anchors: str, columns: tuple[str, ...], past: tuple[int, int], future: tuple[int, int]) -> str:
    def part(name: str, first: int, last: int) -> str:
        return f"""
            select a.code_insee, a.sample, '{name}' as part, cast(r.i - a.sample - ({first}) as int) as step,
                   {_shown(columns, doubles=True)}
            from {anchors} a join {rows} r on r.code_insee = a.code_insee
              and r.i between a.sample + ({first}) and a.sample + ({last})"""

    return f"select code_insee, cast(sample as int) as sample, * exclude (code_insee, sample) from ({part('past', *past)} union all {part('future', *future)})"


def _scaled(c: str, over: str) -> str:
    low, high = f"min({c}) over ({over})", f"max({c}) over ({over})"
    return (
        f"case when {c} is not null and {low} = {high} then -1.0 else "
        f"(cast({c} as double) - {low}) / nullif(cast({high} - {low} as double), 0) * 2 - 1 end"
    )


def _twin(body: str) -> str:
    """A statement with the views it needs, in definition order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name in VIEWS:
            if name in words and name not in needed:
                needed.add(name)
                visit(VIEWS[name])

    visit(body)
    order: list[str] = []

    def place(name: str) -> None:
        words = set(VIEWS[name].replace("(", " ").replace(")", " ").replace(",", " ").split())
        for other in VIEWS:
            if other in words and other in needed and other != name and other not in order:
                place(other)
        if name not in order:
            order.append(name)

    for name in sorted(needed):
        place(name)
    if not order:
        return body
    views = ",\n".join(f"{name} as ({VIEWS[name]})" for name in order)
    if body.lstrip().startswith("with"):
        body = f"select * from ({body})"
    return f"with {views}\n{body}"


FLUX_DAY = "jour, qte, t_min, t_max, ctmax, ctmin, cpluie"
FLUX_WEEK = "id, sem, an, qte, t_min, t_max, pluie, ctmax, ctmin, cpluie"
INVERTED = ("qte", "tmax", "tmin", "ctmin", "ctmax", "cpluie")

_BODIES: dict[str, str] = {
    "deliveries_union": "select * from archive union all select * from live",
    "daily_intake": "select * from daily",
    "calendar_spine": "select * from spine",
    "weather_trailing": f"select * from observed where code_insee = {SITE}",
    "weather_trailing_all_sites": "select * from observed",
    "flux_day": f"select {FLUX_DAY} from flux_day_sites where code_insee = {SITE} order by jour",
    "flux_day_sites": "select * from flux_day_sites",
    "flux_week": f"select {FLUX_WEEK} from flux_week_sites where code_insee = {SITE} order by an, sem",
    "flux_week_sites": "select * from flux_week_sites",
    "flux_day_until": f"select {FLUX_DAY} from flux_day_until where code_insee = {SITE} order by jour",
    "flux_week_until_next": f"select {FLUX_WEEK} from flux_week_until where code_insee = {SITE}",
    "weekly_delivery_count": "select annee, semaine, nbr_apports from weekly_count",
    "weekly_weather": "select * from weekly_weather",
    "weekly_worked_holidays": "select * from worked_holidays",
    "weekly_profile": "select * from weekly_profile where season <= 2021 and week <= 23",
    "weekly_profile_predict": "select * from weekly_profile where season = 2021 and week = 23",
    "weekly_forecast_error": "select * from weekly_forecast_error",
    "weekly_forecast_error_predict": "select * from weekly_forecast_error where saison = 2021 and sem = 23",
    "forecast_stat": f"""
        select s.annee, s.semaine, rf as pred_iter1, pred as pred_iter2, reel as quantite_recolte,
               {percent("rf", "reel")} as erreur_pct_iter1, {percent("pred", "reel")} as erreur_pct_iter2,
               tmin, diff_tmin, tmax, diff_tmax, rr10, apports_reportes, apports_predits,
               apports_predits - apports_reportes as diff_apports
        from (select *, tmin - lag(tmin) over (order by annee, semaine) as diff_tmin,
                     tmax - lag(tmax) over (order by annee, semaine) as diff_tmax
              from weather_weeks) s
        left join forecast_final f on f.semaine = s.semaine and f.annee = s.annee
        left join delivery_counts n on n.semaine = s.semaine and n.annee = s.annee
        where pred is not null order by 1, 2""",
    "frost_weighted_forecast": """
        select annee, semaine, rf, tmin,
               cast(case when tmin < 10 and previous < 30 then round(rf / 2.0)
                         when tmin < 10 and previous < 50 then round(rf / 1.5)
                         when tmin < 25 then round(rf / 1.4) else rf end as bigint) as pond,
               nbr_apports, nbr_apports - before as diff_apports, before as apports_semaine_derniere
        from (select *, lag(tmin) over (order by semaine, annee) as previous,
                     lag(nbr_apports) over (
                       order by count_annee nulls last, count_semaine nulls last, annee, semaine) as before
              from weather_weeks)""",
    "weather_day_flags": "select * from flagged",
    "weather_lags": f"select code_insee, date_reelle, tmax, rr10, {_lags()} from weather",
    "weather_cumuls": "select * from cumuls",
    "sowing_unpivot": "select * from sowing",
    "sowing_season": "select * from sowing_season",
    "sowing_season_totals": "select * from season_totals",
    "harvest_season_by_grower": "select * from harvest",
    "harvest_season_by_grower_predict": f"""
        select date_recolte, {season_case("date_recolte", 2023, "null")} as saison, code_adherent,
               cast(sum(quantite_recolte) as bigint) as quantite_recolte
        from pred_deliveries group by 1, 2, 3""",
    "harvest_season_by_table": "select * from harvest",
    "sowing_season_by_table": "select * from sowing_season",
    "intake_with_sowing": "select * from intake_sowing",
    "midweek_ratio_lags": "select * from b1",
    "remaining_plants": "select * from b2",
    "weekly_features_to_day": "select * from weekly_to_day",
    "season_day": "select * from season_days",
    "season_features": _season_features("d.date_recolte > date '2016-03-04'"),
    "season_features_predict": _season_features(
        f"d.date_recolte > {AS_OF} + 2 and d.date_recolte <= {AS_OF} + 10"
    ),
    "season_features_backtest": _season_features(
        "d.date_recolte > date '2016-03-04' and d.date_recolte < date '2021-01-01'"
    ),
    "bro_grower_intake": "select * from grower_intake",
    "bro_grower_intake_recent": "select * from grower_intake where date_recolte >= date '2019-01-01'",
    "bro_grower_intake_predict": "select * from announced_intake where date_recolte > date '2022-01-01'",
    "bro_weather_windows": "select * from windows",
    "bro_weather_windows_recent": "select * from windows_recent",
    "bro_sowing_by_commune": "select * from sowing_commune",
    "bro_sowing_by_commune_recent": "select * from sowing_commune_recent",
    "bro_intake_sowing": "select * from intake_commune",
    "bro_weather_join": "select * from joined",
    "bro_station_lookup": "select j.*, numero_station from joined j left join stations s on s.code_insee = j.code_insee",
    "bro_station_features": _station_features("joined"),
    "bro_station_features_recent": _station_features("joined_recent"),
    "bro_station_features_predict": _station_features("joined_predict"),
    "data_checks": """
        select count(prdcode) as nbre, 'adhérents dans apports non listés dans table producteurs' as erreur
        from grower_deliveries where prdcode not in (select code_adherent from growers)
        union all
        select count(code_adherent), 'adhérents dans semis non listés dans table producteurs'
        from sowings where code_adherent not in (select code_adherent from growers)
        union all
        select count(prdcode), 'adhérents dans apports non listés dans semis'
        from grower_deliveries where prdcode not in (select code_adherent from sowings)
        union all
        select count(*), 'doublons météo'
        from (select code_insee, date_reelle
              from (select code_insee, date_reelle from weather
                    union all select code_insee, date_reelle from weather where rr10 > 15)
              group by 1, 2 having count(code_insee) > 1)""",
    "sentinel_to_null": "select * from weather",
    "model_comparison_weekly": f"""
        with p as (select week(jour) as sem, {", ".join(f"sum({a} + {b}) as {n}" for n, a, b in (
            ("blend", "bro_pred_vg", "bro_pred_cleder"), ("knn", "pred_vg_fd_knn", "pred_cleder_fd_knn"),
            ("xgb", "pred_vg_fd_xgb", "pred_cleder_fd_xgb"),
            ("keras", "pred_vg_fd_keras", "pred_cleder_fd_keras")))}
                   from model_forecasts where year(jour) = 2021 and week(jour) >= 22
                   group by 1 order by 1 limit 3),
             a as (select week(liv_date) as sem, sum(liv_qty) as qte_reelle from grower_deliveries
                   where year(liv_date) = 2021 and week(liv_date) >= 22 group by 1 order by 1 limit 3)
        select {", ".join(f"cast({c} as bigint) as {c}" for c in ("blend", "knn", "xgb", "keras", "qte_reelle"))},
               cast(p.sem as int) as sem
        from p left join a on a.sem = p.sem order by p.sem""",
    "calendar_features_day": f"select code_insee, date_recolte, {_shown(DAY_FEATURES)} from day_features",
    "calendar_features_week": f"select code_insee, id, {_shown(WEEK_FEATURES)} from week_features",
    "minmax_scale": "select code_insee, date_recolte, "
    + ", ".join(f"{rounded(_scaled(c, 'partition by code_insee'))} as {c}" for c in DAY_FEATURES)
    + " from day_features",
    "minmax_scale_one_series": "select date_recolte, "
    + ", ".join(f"{rounded(_scaled(c, ''))} as {c}" for c in DAY_FEATURES)
    + f" from day_features where code_insee = {SITE}",
    "minmax_fit": "select code_insee, "
    + ", ".join(
        f"{rounded(f'{side}(cast({c} as double))')} as {side}_{c}" for c in DAY_FEATURES for side in ("min", "max")
    )
    + " from day_features group by 1",
    "minmax_inverse": "select code_insee, date_recolte, "
    + ", ".join(
        f"cast(trunc((({_scaled(c, 'partition by code_insee')}) / 2 + 1) / 2 "
        f"* (max({c}) over (partition by code_insee) - min({c}) over (partition by code_insee)) "
        f"+ min({c}) over (partition by code_insee)) as bigint) as {c}"
        for c in INVERTED
    )
    + " from day_features",
    "sequence_windows_day": _sequence("day_rows", "day_anchors", DAY_FEATURES, (-12, -1), (3, 8)),
    "sequence_windows_week": _sequence("week_rows", "week_anchors", WEEK_FEATURES, (-7, -2), (0, 0)),
    "latest_window": """
        select kind, code_insee, cast(sample as int) as sample,
               sample = max(sample) over (partition by kind, code_insee) as is_score,
               cast(past_rows as int) as past_rows, cast(future_rows as int) as future_rows, first, last
        from (select 'day' as kind, a.code_insee, a.i as sample, 12 as past_rows, 6 as future_rows,
                     cast(f.date_recolte as varchar) as first, cast(l.date_recolte as varchar) as last
              from day_rows a
              join day_rows f on f.code_insee = a.code_insee and f.i = a.i + 3
              join day_rows l on l.code_insee = a.code_insee and l.i = a.i + 8
              where a.i >= 12 and (a.n - 1 - l.i) % 6 = 0
              union all
              select 'week' as kind, a.code_insee, sample, 6 as past_rows, 1 as future_rows,
                     cast(id as varchar), cast(id as varchar)
              from week_anchors a join week_rows r on r.code_insee = a.code_insee and r.i = sample)""",
    "sequence_forecast": "select * from forecasts",
    "weekly_forecast_run": f"""
        select d.code_insee, d.jour, greatest(coalesce(d.pred, 0), 0) as pred2, w.pred as pred1
        from (select * from forecasts where kind = 'day' and jour between {AS_OF} + 4 and {AS_OF} + 9) d
        left join (select * from forecasts where kind = 'week') w on w.code_insee = d.code_insee and w.jour = d.jour""",
    "forecast_quality": f"""
        select kind, position, count(*) as n, {rounded("sqrt(avg((pred - label) * (pred - label)))", 4)} as rmse,
               {rounded("avg(abs(pred - label))", 4)} as mae,
               {rounded("avg(abs(pred - label) / nullif(abs(label), 0) * 100)", 4)} as mape,
               {rounded("avg((label - pred) / nullif(label, 0) * 100)", 4)} as mpe
        from origins group by 1, 2""",
    "forecast_run_log": f"""
        select cast(epoch({AS_OF}) as bigint) as timest, 'cf' as ml, 'métrique' as info,
               'rmse ' || kind || ' ' || cast(cast(sqrt(avg((pred - label) * (pred - label))) as decimal(20, 2)) as varchar) as log,
               'run final day' as page
        from origins group by kind""",
    "forecast_ledger": f"""
        with e as (select code_insee from growers union select numero_station from growers where numero_station is not null),
             w as (select unnest(range(7)) as p),
             spine as (select code_insee, case when p < 6 then 'day' else 'week' end as kind,
                              {AS_OF} + 4 + cast(p % 6 as int) as jour from e, w where code_insee is not null),
             sizes as (select code_insee, 'day' as kind, count(*) as c from day_features group by 1
                       union all select code_insee, 'week', count(*) from week_features group by 1)
        select s.code_insee, s.kind, s.jour, f.pred,
               case when s.kind = 'day' and f.kind is not null then greatest(coalesce(f.pred, 0), 0) else f.pred end as published,
               case when s.kind = 'day' and f.pred < 0 then 'negative' when f.pred is not null then 'forecast'
                    when f.kind is not null then 'no model' when c is null then 'unknown'
                    when c < case when s.kind = 'day' then 21 else 8 end then 'too short'
                    else s.kind || ' missing' end as reason
        from spine s left join forecasts f on f.code_insee = s.code_insee and f.kind = s.kind and f.jour = s.jour
        left join sizes z on z.code_insee = s.code_insee and z.kind = s.kind""",
    "calendar_between": """
        with b as (select min(date_recolte) as first, max(date_recolte) as last from deliveries_all),
             d as (select cast(unnest(generate_series(first, last, interval 1 day)) as date) as jour from b)
        select jour from d where isodow(jour) < 7""",
    "model_input": "select code_insee, date_recolte, part, name, "
    + rounded("value")
    + " as value from (select code_insee, date_recolte, 'features' as part, name, value from (select code_insee, date_recolte, "
    + ", ".join(f"cast({c} as double) as {c}" for c in DAY_FEATURES)
    + f" from day_features) unpivot include nulls (value for name in ({', '.join(DAY_FEATURES)})))"
    + " union all by name select code_insee, date_recolte, 'target' as part, 'qte' as name, cast(qte as double) as value from day_features"
    + " union all by name select code_insee, date_recolte, part, name, value from (select code_insee, date_recolte, 'exogenous' as part, name, "
    + rounded("value")
    + " as value from (select code_insee, date_recolte, "
    + ", ".join(f"cast({c} as double) as {c}" for c in DAY_FEATURES if c != "qte")
    + f" from day_features) unpivot include nulls (value for name in ({', '.join(c for c in DAY_FEATURES if c != 'qte')})))",
    "stored_model_forecast": f"""
        select t.code_insee, t.kind, t.position, t.jour, {QUANTITY} as pred, version, n as trained
        from day_targets t left join (
            select * from stored_models where version <= {AS_OF}
            qualify version = max(version) over (partition by code_insee, kind, position)
        ) m on m.code_insee = t.code_insee and m.position = t.position
        where is_score""",
    "series_least_squares": f"""
        with w as (select code_adherent, date_trunc('week', date_recolte) as lundi,
                          cast(sum(quantite_recolte) as bigint) as qte
                   from deliveries_all group by 1, 2)
        select a.code_adherent, count(b.qte) filter (where a.qte is not null) as n,
               {rounded("regr_slope(a.qte, b.qte)", 5)} as slope,
               {rounded("regr_intercept(a.qte, b.qte)", 5)} as intercept
        from w a left join w b on b.code_adherent = a.code_adherent and b.lundi = a.lundi - interval 14 day
        group by 1""",
    "publish_forecast": f"""
        with t as (select jour, 2 * dt as v from forecast_daily
                   where jour >= {AS_OF} - 3 and jour < {AS_OF} + 4
                   union all
                   select jour + 7, -dt from forecast_daily
                   where jour >= {AS_OF} - 10 and jour < {AS_OF} - 3),
             d as (select {AS_OF} + 4 + cast(p as int) as jour, sum(v) as pred
                   from (select unnest(range(6)) as p) left join t on isodow(jour) = p + 1 group by 1)
        select jour, cast(greatest(coalesce(pred, 0), 0) as bigint) as pred2,
               cast(case when isodow(jour) = 1 then (select sum(pred) from d) end as bigint) as pred1
        from d
        union all
        select jour, dt, case when isodow(jour) = 1 then dt * 6 end
        from forecast_daily where jour not between {AS_OF} + 4 and {AS_OF} + 9""",
    "forecast_metrics": f"""
        select annee, count(*) as n,
               {rounded("sqrt(avg(cast(pred - reel as double) * (pred - reel)))", 6)} as rmse,
               {rounded("avg(abs(pred - reel))", 6)} as mae,
               {rounded("avg(abs(pred - reel) / nullif(cast(reel as double), 0) * 100)", 6)} as mape,
               {rounded("avg((reel - pred) / nullif(cast(reel as double), 0) * 100)", 6)} as mpe
        from (select f.annee, pred, quantite_recolte as reel from forecast_final f
              join whole_week w on w.annee = f.annee and w.semaine = f.semaine)
        where reel is not null group by 1""",
    "run_log": f"""
        select cast(epoch({AS_OF}) as bigint) as timest, 'cf' as ml, 'métrique' as info,
               'rmse model 1 ' || cast(cast(trunc(sqrt(avg(cast(pred - reel as double) * (pred - reel)))) as int)
                                       as varchar) as log,
               'run final day' as page
        from (select pred, quantite_recolte as reel from forecast_final f
              join whole_week w on w.annee = f.annee and w.semaine = f.semaine)
        where reel is not null""",
    "rank_correlation": f"""
        with u as (select code_insee, feature, value, qte from flux_day_sites
                   unpivot (value for feature in (t_min, t_max, ctmax, ctmin, cpluie))
                   where qte is not null),
             r as (select *, rank() over (partition by code_insee, feature order by value)
                             + (count(*) over (partition by code_insee, feature, value) - 1) / 2.0 as rv,
                          rank() over (partition by code_insee, feature order by qte)
                             + (count(*) over (partition by code_insee, feature, qte) - 1) / 2.0 as rt
                   from u)
        select code_insee, feature, count(*) as n, {rounded("corr(rv, rt)")} as rho
        from r group by 1, 2""",
}

ORACLES: dict[str, str] = {name: _twin(body) for name, body in _BODIES.items()}
