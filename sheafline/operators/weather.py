"""Daily weather features: threshold flags, lags and trailing sums."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from sheafline.functions import TrailingSum, trailing_sums

# fixed values: the trailing sums of each measure. A sum with suffix k covers the k + 1
# rows before the current one.
CUMULS: dict[str, tuple[str, tuple[int, ...]]] = {
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

# fixed values: name, source and distance in rows of each lag
LAGS = (
    ("t1", "tmax", 1), ("t2", "tmax", 2), ("t4", "tmax", 4),
    ("p1", "rr10", 1), ("p2", "rr10", 2), ("p4", "rr10", 4), ("p7", "rr10", 7),
)


def _flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def weather_day_flags(weather: DataFrame, *, site: int | None = None) -> DataFrame:
    """Weather with its nine 0/1 flags. The thresholds are fixed values."""
    if site is not None:
        weather = weather.filter(F.col("code_insee") == site)
    tmin, tmax, rain = F.col("tmin"), F.col("tmax"), F.col("rr10")
    return weather.withColumns(
        {
            "gel": _flag(tmin < 0),
            "froid": _flag(tmin < 5),
            "jourfroid": _flag(tmax < 10),
            "jourtresfroid": _flag(tmax < 5),
            "jourchaud": _flag(tmax.between(15, 25)),
            "jourdoux": _flag(tmax.between(15, 20)),
            "arrosage": _flag(rain > 0),
            "pluiemoderee": _flag(rain > 8),
            "pluieforte": _flag(rain > 15),
        }
    )


def weather_lags(weather: DataFrame) -> DataFrame:
    """Earlier temperatures and rain of the same site."""
    spec = Window.partitionBy("code_insee").orderBy("date_reelle")
    return weather.withColumns({name: F.lag(source, k).over(spec) for name, source, k in LAGS})


def cumul_sums(names: Iterable[str] | None = None) -> list[TrailingSum]:
    """The trailing sums by name, all of them by default."""
    sums = [
        TrailingSum(source, f"{prefix}{k}", start=k + 1)
        for prefix, (source, suffixes) in CUMULS.items()
        for k in suffixes
    ]
    if names is None:
        return sums
    by_name = {s.name: s for s in sums}
    return [by_name[n] for n in names]


def weather_cumuls(
    flagged: DataFrame, *, names: Iterable[str] | None = None, lags: bool = False
) -> DataFrame:
    """Trailing sums over flagged weather, today excluded, optionally with the lags.

    One exchange and one sort by (site, day) serve all columns.
    """
    spec = Window.partitionBy("code_insee").orderBy("date_reelle")
    extra = {name: F.lag(source, k).over(spec) for name, source, k in LAGS} if lags else None
    return trailing_sums(flagged, ["code_insee"], "date_reelle", cumul_sums(names), extra=extra)
