"""Transactions: cleaning, and averages by area over rolling windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deedloom.functions.text import clean_street_number, street_key
from deedloom.functions.values import compact

# Kinds of homes, and the category of ordinary sales.
HOME_TYPES, ORDINARY = ("D", "S", "F", "T"), "A"
PROPERTY_TYPES, CATEGORIES = ("D", "S", "T", "F", "O"), ("A", "B")


def clean_transactions(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """Raw transactions with keys and areas: street, locality and paon in lower case, street_name2, street_number, postcode2, year.

    Rows whose date can't be read are dropped; codes outside the known ones become null. Missing texts stay null.
    """
    code = lambda c, known: F.when(F.col(c).isin(*known), F.col(c))
    out = df.withColumn("date_of_transfer", F.coalesce(F.try_to_date("date_of_transfer", "yyyy-MM-dd HH:mm"), F.try_to_date("date_of_transfer", "yyyy-MM-dd"))).where(F.col("date_of_transfer").isNotNull())
    out = out.withColumns({"street": F.lower("street"), "locality": F.lower("locality"), "paon": F.lower("paon"), "property_type": code("property_type", PROPERTY_TYPES), "ppd_category_type": code("ppd_category_type", CATEGORIES)})
    out = out.withColumns({"street_name2": street_key(F.col("street")), "street_number": clean_street_number(F.col("paon")), "postcode2": compact(F.col("postcode")), "year": F.year("date_of_transfer")})
    return out.join(lookup, "postcode2", "left").drop("street", "postcode")


def ordinary_homes(df: DataFrame) -> DataFrame:
    return df.where(F.col("property_type").isin(*HOME_TYPES) & (F.col("ppd_category_type") == ORDINARY))


def in_years(df: DataFrame, *years: int, column: str = "year") -> DataFrame:
    """Rows of the years; on a table partitioned by year only these are read. No years give an empty table."""
    return df.where(F.col(column).isin(*years)) if years else df.limit(0)


def between_dates(df: DataFrame, start: str | Column, end: str | Column, date: str = "date_of_transfer") -> DataFrame:
    """Rows with start <= date <= end."""
    as_column = lambda d: d if isinstance(d, Column) else F.lit(d).cast("date")
    return df.where(F.col(date).between(as_column(start), as_column(end)))


def area_averages(df: DataFrame, area: str = "msoa11cd", price: str = "price", by: tuple[str, ...] = ()) -> DataFrame:
    """(by, area, price_mean, price_median, n): exact mean and median of each area's ordinary home sales; null areas have no row."""
    homes = ordinary_homes(df).where(F.col(area).isNotNull())
    return homes.groupBy(*by, area).agg(F.avg(price).alias("price_mean"), F.median(price).alias("price_median"), F.count(price).alias("n"))


def rolling_averages(df: DataFrame, snapshots: DataFrame, area: str = "msoa11cd", price: str = "price", years_back: int = 3, date: str = "date_of_transfer") -> DataFrame:
    """(snapshot_date, area, price_mean, price_median, n): averages over the years before each snapshot, both ends included.

    Sales are first counted by month, area and price, which is all the averages need, so that what is repeated for each
    of a sale's windows is a count and not a sale; a window is a set of months for all but its last, of which only the
    first day is inside. ``snapshots`` has snapshot_date, the first day of a month each.
    """
    months = years_back * 12
    homes = ordinary_homes(df).where(F.col(area).isNotNull() & F.col(price).isNotNull() & F.col(date).isNotNull())
    first = F.trunc(date, "month")
    counted = homes.groupBy(first.alias("_month"), (F.col(date) == first).alias("_on_first"), F.col(area), F.col(price)).agg(F.count(F.lit(1)).alias("_n"))
    # A month belongs to the windows of the snapshots in the years after it, and its first day to its own, too.
    ends = F.transform(F.sequence(F.when(F.col("_on_first"), 0).otherwise(1), F.lit(months)), lambda k: F.add_months("_month", k))
    windows = counted.select(F.explode(ends).alias("snapshot_date"), area, price, "_n").join(snapshots.select("snapshot_date").distinct(), "snapshot_date")
    totals = windows.groupBy("snapshot_date", area, price).agg(F.sum("_n").alias("_n"))
    return totals.groupBy("snapshot_date", area).agg(
        (F.sum(F.col(price).cast("double") * F.col("_n")) / F.sum("_n")).alias("price_mean"), F.expr(f"percentile({price}, 0.5, _n)").alias("price_median"), F.sum("_n").alias("n")
    )
