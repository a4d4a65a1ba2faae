"""Data quality: orphan growers, duplicate weather keys, sentinel values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheafline.sources.tables import WEATHER_MEASURES

# fixed value: stands for "missing" in raw weather
SENTINEL = -99

# fixed values: labels of the check report
LABEL_DELIVERIES_GROWERS = "adhérents dans apports non listés dans table producteurs"
LABEL_SOWINGS_GROWERS = "adhérents dans semis non listés dans table producteurs"
LABEL_DELIVERIES_SOWINGS = "adhérents dans apports non listés dans semis"
LABEL_WEATHER = "doublons météo"


def sentinel_to_null(weather: DataFrame, *, columns: tuple[str, ...] = WEATHER_MEASURES) -> DataFrame:
    """Weather with the sentinel replaced by NULL."""
    return weather.withColumns({c: F.nullif(F.col(c), F.lit(SENTINEL)) for c in columns})


def data_checks(
    deliveries: DataFrame, sowings: DataFrame, growers: DataFrame, weather: DataFrame
) -> DataFrame:
    """Four rows (nbre, erreur): rows with unlisted growers, and duplicate weather keys.

    "Not listed" is SQL's NOT IN: a NULL in the list leaves nothing to report, and an
    empty list reports all rows with a grower. The three lists meet in one grouping by
    grower, summed up map-side, in place of three anti joins; a frequent grower costs
    one row per task, and no list is broadcast.
    """

    def tagged(df: DataFrame, key: str, table: str) -> DataFrame:
        return df.select(
            F.col(key).alias("grower"),
            *(F.lit(int(t == table)).cast("bigint").alias(t) for t in ("delivered", "sown", "listed")),
        )

    per_grower = (
        tagged(deliveries, "prdcode", "delivered")
        .unionByName(tagged(sowings, "code_adherent", "sown"))
        .unionByName(tagged(growers, "code_adherent", "listed"))
        .groupBy("grower")
        .agg(*(F.sum(t).alias(t) for t in ("delivered", "sown", "listed")))
    )
    known = F.col("grower").isNotNull()

    def missing(rows: str, where: str) -> Column:
        unlisted = F.sum(F.when(known & (F.col(where) == 0), F.col(rows)))
        null_listed = F.sum(F.when(~known, F.col(where)))
        return F.when(F.coalesce(null_listed, F.lit(0)) > 0, F.lit(0)).otherwise(
            F.coalesce(unlisted, F.lit(0))
        )

    counts = per_grower.agg(
        missing("delivered", "listed").alias("a"),
        missing("sown", "listed").alias("b"),
        missing("delivered", "sown").alias("c"),
    )
    growers_report = counts.select(
        F.inline(
            F.array(
                *(
                    F.struct(F.col(c).cast("bigint").alias("nbre"), F.lit(label).alias("erreur"))
                    for c, label in (
                        ("a", LABEL_DELIVERIES_GROWERS),
                        ("b", LABEL_SOWINGS_GROWERS),
                        ("c", LABEL_DELIVERIES_SOWINGS),
                    )
                )
            )
        )
    )
    # a group with an unknown commune counts as zero rows, as its key is not countable
    duplicates = (
        weather.groupBy("code_insee", "date_reelle")
        .agg(F.count("code_insee").alias("n"))
        .filter(F.col("n") > 1)
        .agg(F.count(F.lit(1)).alias("nbre"))
        .select("nbre", F.lit(LABEL_WEATHER).alias("erreur"))
    )
    return growers_report.unionByName(duplicates)
