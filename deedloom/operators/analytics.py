"""Tables and measures for looking at results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str], normalize: str | None = None, margins: bool = False) -> DataFrame:
    """Counts of rows by two keys, one column a value of ``values``; shares of all, or of each column, if asked for.

    Null keys have no part; combinations that don't occur are 0. ``margins`` adds a row and a column All (counts only).
    """
    if normalize not in (None, "all", "columns"):
        raise ValueError("normalize is None, 'all' or 'columns'")
    whole = df.dropna(subset=[row, column]).where(F.col(column).isin(*values))
    counts = whole.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(v) for v in values])
    if normalize == "all":
        total = F.sum(sum((F.col(v) for v in values[1:]), F.col(values[0]))).over(Window.partitionBy(F.lit(1)))
        return counts.select(row, *[F.coalesce(F.try_divide(F.col(v).cast("double"), total), F.lit(0.0)).alias(v) for v in values])
    if normalize == "columns":
        return counts.select(row, *[F.coalesce(F.try_divide(F.col(v).cast("double"), F.sum(v).over(Window.partitionBy(F.lit(1)))), F.lit(0.0)).alias(v) for v in values])
    if margins:
        counts = counts.unionByName(counts.agg(*[F.coalesce(F.sum(v), F.lit(0)).alias(v) for v in values]).withColumn(row, F.lit("All")))
        return counts.withColumn("All", sum((F.col(v) for v in values[1:]), F.col(values[0])))
    return counts


def pivoted(df: DataFrame, index: Sequence[str], column: str, values: Sequence[str], cell: Column, fill: float | int | None = 0) -> DataFrame:
    """One row an index, one column a value: an aggregate of the cell's rows, missing cells filled."""
    out = df.dropna(subset=[*index, column]).groupBy(*index).pivot(column, list(values)).agg(cell)
    return out if fill is None else out.fillna(fill, subset=list(values))


def described(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample deviation, least, exact quartiles and greatest of a column, nulls aside."""
    c = F.col(column)
    aggregates = [F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("min"), *[F.percentile(c, q).alias(n) for q, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))], F.max(c).alias("max")]
    return df.groupBy(*by).agg(*aggregates) if by else df.agg(*aggregates)


def shares(df: DataFrame, keys: Sequence[str], within: Sequence[str] = (), name: str = "share") -> DataFrame:
    """(within, keys, n, share): rows by keys and their share of all rows, or of those with equal ``within``."""
    counts = df.dropna(subset=[*within, *keys]).groupBy(*within, *keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn(name, F.col("n") / F.sum("n").over(Window.partitionBy(*within) if within else Window.partitionBy(F.lit(1))))


def null_rates(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Share of nulls in each column, as <column>_null_rate, and n."""
    aggregates = [F.count(F.lit(1)).alias("n"), *[F.try_divide(F.count_if(F.col(c).isNull()).cast("double"), F.count(F.lit(1))).alias(f"{c}_null_rate") for c in columns]]
    return df.groupBy(*by).agg(*aggregates) if by else df.agg(*aggregates)


def first_last_change(df: DataFrame, keys: Sequence[str], at: str, value: str) -> DataFrame:
    """(keys, first, last, ratio): the value at a key's first and last time, and last / first (null if first is 0)."""
    out = df.where(F.col(at).isNotNull()).groupBy(*keys).agg(F.min_by(value, at).alias("first"), F.max_by(value, at).alias("last"))
    return out.withColumn("ratio", F.try_divide(F.col("last").cast("double"), F.col("first").cast("double")))


def month_gap(later: Column, earlier: Column) -> Column:
    """Whole months between two dates' months."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def changes(df: DataFrame, keys: Sequence[str], at: str, value: str) -> DataFrame:
    """Adds diff, relative_change and monthly_change of a value from the key's row before; null for the first row."""
    order = Window.partitionBy(*keys).orderBy(at)
    before, diff = F.lag(value).over(order), F.col(value) - F.lag(value).over(order)
    return df.withColumns({"diff": diff, "relative_change": F.try_divide(diff.cast("double"), before.cast("double")), "monthly_change": F.try_divide(diff.cast("double"), month_gap(F.col(at), F.lag(at).over(order)).cast("double"))})


def projected_change(df: DataFrame, keys: Sequence[str], at: str, value: str) -> DataFrame:
    """(keys, mean_monthly_change, total_change): mean monthly change times the months from the table's first date to its last."""
    span = df.agg(month_gap(F.max(at), F.min(at)).alias("_months"))
    means = changes(df, keys, at, value).groupBy(*keys).agg(F.avg("monthly_change").alias("mean_monthly_change"))
    return means.crossJoin(F.broadcast(span)).select(*keys, "mean_monthly_change", (F.col("mean_monthly_change") * F.col("_months")).alias("total_change"))


def top(df: DataFrame, by: str, n: int, largest: bool = True, ties: Sequence[str] = ()) -> DataFrame:
    """The n rows with the greatest (or least) values, nulls aside; ties by the columns given."""
    return df.where(F.col(by).isNotNull()).orderBy(F.desc(by) if largest else F.asc(by), *ties).limit(n)


def concentration(df: DataFrame, value: str, n: int = 20) -> DataFrame:
    """(sign, top_sum, total, share): of the positive and of the negative values, what the n greatest by size sum to, and their share."""
    signed = df.where(F.col(value) != 0).select(F.when(F.col(value) > 0, "positive").otherwise("negative").alias("sign"), F.col(value).alias("v"))
    ranked = signed.withColumn("k", F.row_number().over(Window.partitionBy("sign").orderBy(F.desc(F.abs("v")))))
    totals = signed.groupBy("sign").agg(F.sum("v").alias("total"))
    return ranked.where(F.col("k") <= n).groupBy("sign").agg(F.sum("v").alias("top_sum")).join(totals, "sign").select("sign", "top_sum", "total", F.try_divide(F.col("top_sum").cast("double"), F.col("total").cast("double")).alias("share"))


def clipped(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Values below low or above high moved there; null stays null."""
    c = F.when(c < low, F.lit(low)).otherwise(c) if low is not None else c
    return F.when(c > high, F.lit(high)).otherwise(c) if high is not None else c


def merged(tables: Sequence[DataFrame], keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Tables joined one after the other by their keys (inner, left or full); other columns must differ in name. Null keys match nothing."""
    out = tables[0]
    for t in tables[1:]:
        out = out.join(t, list(keys), how)
    return out
