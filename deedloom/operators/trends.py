"""Counts, weighted averages and trends of snapshots by group."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def group_counts(df: DataFrame, keys: Sequence[str], snapshot: str = "snapshot_date", name: str = "counts") -> DataFrame:
    """Rows by snapshot and keys; rows with a null key belong to no group."""
    return df.dropna(subset=list(keys)).groupBy(snapshot, *keys).agg(F.count(F.lit(1)).alias(name)) if keys else df.groupBy(snapshot).agg(F.count(F.lit(1)).alias(name))


def summary_counts(df: DataFrame, class_col: str = "class", snapshot: str = "snapshot_date", most_expanded: int | None = None) -> dict[str, DataFrame]:
    """Four tables of counts: residential by is_multi, and by is_multi and LAD; all by region and class, and by country.

    Rows expanded to ``most_expanded`` or more, or with a null expansion_size, are left out if it is given.
    """
    rows = df if most_expanded is None else df.where(F.col("expansion_size") < most_expanded)
    homes = rows.where(F.col(class_col) == "residential")
    return {
        "multi": group_counts(homes, ["is_multi"], snapshot), "multi_lad": group_counts(homes, ["is_multi", "lad11cd"], snapshot),
        "region_class": group_counts(rows, ["region", class_col], snapshot), "country": group_counts(rows, ["country_incorporated"], snapshot),
    }


def weighted_mean(value: str, weight: str) -> Column:
    """Mean of values by weight; null if any value is missing, or the weights sum to nothing."""
    w = F.coalesce(F.col(weight), F.lit(0)).cast("double")
    return F.when((F.count_if(F.col(value).isNull()) == 0) & (F.sum(w) > 0), F.try_divide(F.sum(F.col(value).cast("double") * w), F.sum(w)))


def lad_averages(df: DataFrame, snapshot: str, lad: str, groups: Sequence[str]) -> DataFrame:
    """Count-weighted means of price_mean and price_median by LAD, over areas that have both."""
    priced = df.where(F.col("price_mean").isNotNull() & F.col("price_median").isNotNull())
    return priced.groupBy(snapshot, lad, *groups).agg(weighted_mean("price_mean", "ocod_total_counts").alias("price_mean"), weighted_mean("price_median", "ocod_total_counts").alias("price_median"))


def weighted_series(homes: DataFrame, prices: DataFrame, dwellings: DataFrame, groups: Sequence[str] = (), area: str = "msoa11cd", snapshot: str = "snapshot_date", lad: str | None = None) -> DataFrame:
    """A row for each snapshot and group: averages weighted by records and by dwellings, totals and their ratio.

    ``homes`` are records with area and groups, ``prices`` has snapshot, area, price_mean and price_median, ``dwellings``
    area and dwellings, one row a key each. Counts come first; areas without a price make the group's mean null, as an
    average over an unknown value is unknown. Snapshots without any price have no rows. With ``lad`` records without an
    area take their LAD's averages, as areas UNKNOWN_<lad> without dwellings.

    Integers are cut towards 0. All snapshots are one plan.
    """
    groups = list(groups)
    placed = homes.where(F.col(area).isNotNull())
    lad_of = [F.min(lad).alias(lad)] if lad else []
    counts = placed.dropna(subset=groups).groupBy(snapshot, area, *groups).agg(F.count(F.lit(1)).alias("ocod_total_counts"), *lad_of) if groups else placed.groupBy(snapshot, area).agg(F.count(F.lit(1)).alias("ocod_total_counts"), *lad_of)
    known = prices.select(snapshot).distinct()
    cells = counts.join(known, snapshot, "left_semi").join(prices.select(snapshot, area, "price_mean", "price_median"), [snapshot, area], "left").join(dwellings.select(area, "dwellings"), area, "left")
    if lad:
        average = lad_averages(cells, snapshot, lad, groups)
        lost = homes.where(F.col(area).isNull() & F.col(lad).isNotNull()).dropna(subset=groups or None).groupBy(snapshot, lad, *groups).agg(F.count(F.lit(1)).alias("ocod_total_counts")).join(known, snapshot, "left_semi")
        extra = lost.join(average, [snapshot, lad, *groups], "left").withColumn(area, F.concat(F.lit("UNKNOWN_"), F.col(lad))).withColumn("dwellings", F.lit(0).cast("long"))
        cells = cells.unionByName(extra.select(*cells.columns))
    whole = lambda c: F.col(c).cast("long")
    sums = cells.groupBy(snapshot, *groups).agg(
        weighted_mean("price_mean", "ocod_total_counts").alias("_om"), weighted_mean("price_median", "ocod_total_counts").alias("_od"), weighted_mean("price_mean", "dwellings").alias("_dm"), weighted_mean("price_median", "dwellings").alias("_dd"),
        F.sum("ocod_total_counts").alias("ocod_total_counts"), F.sum(F.coalesce("dwellings", F.lit(0))).cast("long").alias("total_dwelling_count"),
    ).withColumns({"_ov": F.col("ocod_total_counts") * F.col("_om"), "_dv": F.col("total_dwelling_count") * F.col("_dm")})
    return sums.select(
        F.col(snapshot).alias("date"), F.year(snapshot).alias("year"), F.month(snapshot).alias("month"), *groups, whole("_om").alias("ocod_mean"), whole("_od").alias("ocod_median"), whole("_dm").alias("dwelling_mean"), whole("_dd").alias("dwelling_median"),
        F.when(F.col("_dm") > 0, F.col("_om") / F.col("_dm")).alias("ocod_ratio_mean"), "ocod_total_counts", "total_dwelling_count", whole("_ov").alias("total_value_ocod_mean"), whole("_dv").alias("total_value_dwelling_mean"),
        F.when(F.col("_dv") > 0, F.col("_ov") / F.col("_dv")).alias("fraction_of_total_value"),
    )


def monthly_means(homes: DataFrame, prices: DataFrame, groups: Sequence[str], area: str = "msoa11cd", snapshot: str = "snapshot_date") -> DataFrame:
    """(snapshot, groups, weighted_mean, unweighted_mean, price_ratio) over areas that have both records and a price row."""
    counts = homes.dropna(subset=[area, *groups]).groupBy(snapshot, area, *groups).agg(F.count(F.lit(1)).alias("_n"))
    cells = counts.join(prices.select(snapshot, area, "price_mean"), [snapshot, area])
    means = cells.groupBy(snapshot, *groups).agg(weighted_mean("price_mean", "_n").alias("weighted_mean"), F.avg("price_mean").alias("unweighted_mean"))
    return means.withColumn("price_ratio", F.when(F.col("unweighted_mean") != 0, F.col("weighted_mean") / F.col("unweighted_mean")))


def bootstrap_ratio(ratios: Sequence[float], draws: int = 1000, seed: int = 42) -> dict[str, float | bool | None]:
    """How surely a mean of ratios differs from 1: shares of resampled means above and below, and their 95 % range.

    Fewer than two ratios say nothing: all null, and not significant. Equal input in equal order gives equal output.
    """
    names = ("fraction_above_one", "fraction_below_one", "mean_ratio", "ci_lower", "ci_upper")
    x = np.asarray(ratios, dtype=float)
    if len(x) < 2:
        return {**dict.fromkeys(names), "significantly_different": False}
    rng = np.random.RandomState(seed)  # the legacy stream: fixed by its seed for good
    means = x[rng.choice(len(x), size=(draws, len(x)), replace=True)].mean(axis=1)
    above, below = float((means > 1).mean()), float((means < 1).mean())
    low, high = np.percentile(means, [2.5, 97.5])
    return {"fraction_above_one": above, "fraction_below_one": below, "significantly_different": bool(above > 0.975 or below > 0.975), "mean_ratio": float(x.mean()), "ci_lower": float(low), "ci_upper": float(high)}


_TREND = "mean_price_ratio double, ratio_fraction_above_one double, ratio_fraction_below_one double, ratio_significantly_different boolean, ratio_ci_lower double, ratio_ci_upper double, n_ratio_observations int"


def mean_differences(means: DataFrame, groups: Sequence[str], snapshot: str = "snapshot_date", bootstrap: bool = True) -> DataFrame:
    """For each group with two snapshots and more: mean change from one to the next, and the bootstrap of its price ratios.

    Differences with a missing side have no part; n_periods counts the others. A group has one row a snapshot, so the
    Python function sees as many values as there are snapshots.
    """
    if not groups:
        raise ValueError("groups are needed")
    order = Window.partitionBy(*groups).orderBy(snapshot)
    steps = means.withColumns({"_w": F.col("weighted_mean") - F.lag("weighted_mean").over(order), "_u": F.col("unweighted_mean") - F.lag("unweighted_mean").over(order)})
    out = steps.groupBy(*groups).agg(F.avg("_w").alias("mean_weighted_difference"), F.avg("_u").alias("mean_unweighted_difference"), F.count("_w").cast("int").alias("n_periods")).where(F.col("n_periods") > 0)
    if not bootstrap:
        return out
    kinds = dict(means.dtypes)
    keys = ", ".join(f"{g} {kinds[g]}" for g in groups)

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        ratios = rows.sort_values(snapshot)["price_ratio"].dropna()
        b = bootstrap_ratio(ratios)
        return pd.DataFrame([[*key, b["mean_ratio"], b["fraction_above_one"], b["fraction_below_one"], b["significantly_different"], b["ci_lower"], b["ci_upper"], len(ratios)]], columns=[c.split()[0] for c in f"{keys}, {_TREND}".split(", ")])

    tests = means.select(*groups, snapshot, "price_ratio").groupBy(*groups).applyInPandas(one, f"{keys}, {_TREND}")
    return out.join(tests, list(groups))
