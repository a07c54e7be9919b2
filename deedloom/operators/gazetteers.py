"""Gazetteers learned from transactions: the likeliest area of a building, a district and a street."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deedloom.functions.text import joined_address
from deedloom.operators.labelling import BUILDING_RULES, label_spans, without_empty, without_overlaps

#: A building's area is kept if it holds more than this share of the building's mentions in the LAD.
LEAST_FRACTION = 0.2


def top_share(df: DataFrame, keys: Sequence[str], values: Sequence[str], least: float | None = None) -> DataFrame:
    """(keys, values, fraction): of each key the values that occur most often, and their share of the key's rows.

    Rows with a null key or value have no part. Ties go to the least values in order, so the result is the same on every
    run. Counts are combined before the shuffle; the share and the choice use one partitioning by key.
    """
    whole = df.select(*keys, *values).dropna()
    counts = whole.groupBy(*keys, *values).agg(F.count(F.lit(1)).alias("_n"))
    by_key = Window.partitionBy(*keys)
    best = counts.withColumn("_total", F.sum("_n").over(by_key)).withColumn("_place", F.row_number().over(by_key.orderBy(F.desc("_n"), *values))).where(F.col("_place") == 1)
    best = best.withColumn("fraction", F.col("_n") / F.col("_total")).drop("_n", "_total", "_place")
    return best if least is None else best.where(F.col("fraction") > least)


def building_mentions(transactions: DataFrame, row_id: str) -> DataFrame:
    """(text, area codes): names of buildings in the transactions' addresses, distinct with their areas; others have none."""
    address = joined_address(*[F.col(c) for c in ("saon", "paon", "street_name2", "locality", "postcode2")])
    areas = ["lad11cd", "lsoa11cd", "oa11cd", "msoa11cd"]
    spans = transactions.select(row_id, *areas, without_empty(without_overlaps(label_spans(address, BUILDING_RULES))).alias("_spans"))
    return spans.select(F.explode(F.transform("_spans", lambda s: s["text"])).alias("text"), *areas).dropna().distinct()


def building_gazetteer(mentions: DataFrame, least: float = LEAST_FRACTION) -> DataFrame:
    """(building_name, oa11cd, lsoa11cd, msoa11cd, lad11cd, fraction): of each name and LAD the area most mentioned.

    Mentions are distinct before names are lowered, so spellings in other case count each.
    """
    named = mentions.withColumn("building_name", F.lower("text"))
    best = top_share(named, ["building_name", "lad11cd"], ["lsoa11cd", "oa11cd", "msoa11cd"], least)
    return best.select("building_name", "oa11cd", "lsoa11cd", "msoa11cd", "lad11cd", "fraction")


def district_gazetteer(transactions: DataFrame) -> DataFrame:
    """(district, lad11cd): the LAD that most transactions of a district are in."""
    return top_share(transactions, ["district"], ["lad11cd"]).select("district", "lad11cd")


def street_gazetteer(transactions: DataFrame) -> DataFrame:
    """(street_name2, lsoa11cd, oa11cd, msoa11cd, lad11cd, fraction): of each street and LAD the area of most transactions."""
    best = top_share(transactions, ["street_name2", "lad11cd"], ["lsoa11cd", "oa11cd", "msoa11cd"])
    return best.select("street_name2", "lsoa11cd", "oa11cd", "msoa11cd", "lad11cd", "fraction")
