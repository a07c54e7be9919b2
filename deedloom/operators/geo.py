"""Locating records: by postcode, by learned gazetteers, and from other records of the title."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deedloom.functions.text import last_number, street_key
from deedloom.functions.values import compact
from deedloom.plans.ordered import filled_forward
from deedloom.plans.sizes import nulls_apart

AREAS = ("oa11cd", "lsoa11cd", "msoa11cd", "lad11cd")


def add_areas(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """df with postcode2, the lookup's area codes (null if it has no such postcode), street_number2 and street_name2.

    The lookup must have one row a postcode; whether it is broadcast is left to its size. Rows without postcode find nothing
    and are spread over tasks. Area columns that df has are replaced.
    """
    areas = [c for c in lookup.columns if c != "postcode2"]
    keyed = df.drop(*areas).withColumn("postcode2", compact(F.col("postcode")))
    # Equal addresses may fall to one piece; what matters is that rows without postcode don't.
    key = nulls_apart(F.col("postcode2"), F.struct("street_name", "street_number", *[c for c in ("title_number", "building_name", "unit_id") if c in df.columns]))
    located = keyed.join(lookup.select(F.col("postcode2").alias("_key"), *areas), key == F.col("_key"), "left").drop("_key")
    return located.withColumns({"street_number2": last_number(F.col("street_number")), "street_name2": F.lower(street_key(F.col("street_name")))})


def fill_by_district(df: DataFrame, districts: DataFrame) -> DataFrame:
    """lad11cd from the district where it is null; districts has one row a district."""
    names = districts.select(F.lower("district").alias("_district"), F.col("lad11cd").alias("_lad"))
    return df.join(names, F.lower("district") == F.col("_district"), "left").withColumn("lad11cd", F.coalesce("lad11cd", "_lad")).drop("_district", "_lad")


def _fill_from(df: DataFrame, gazetteer: DataFrame, key: str, sets: tuple[str, ...], mark: str) -> DataFrame:
    named = gazetteer.select(F.lower(key).alias("_key"), F.col("lad11cd").alias("_lad"), *[F.col(c).alias(f"_{c}") for c in sets], F.col("fraction").alias("_fraction"))
    hit = F.col("lsoa11cd").isNull() & F.col("_lsoa11cd").isNotNull()
    # Located rows, most of all, ask nothing: their keys differ from the gazetteer's and from one another's.
    asked = nulls_apart(F.when(F.col("lsoa11cd").isNull(), F.col(key)), F.struct("street_number", "street_name2", "postcode2"))
    joined = df.join(named, (asked == F.col("_key")) & (F.col("lad11cd") == F.col("_lad")), "left")
    # All of a row's codes change by the same test, so it is made once, before any of them does.
    joined = joined.withColumn("_hit", hit)
    changed = {c: F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)) for c in sets}
    return joined.withColumns({**changed, "match_prob": F.when(F.col("_hit"), F.col("_fraction")).otherwise(F.col("match_prob")), "geog_match": F.when(F.col("_hit"), F.lit(mark)).otherwise(F.col("geog_match"))}).drop("_hit", "_key", "_lad", "_fraction", *[f"_{c}" for c in sets])


def fill_by_gazetteers(df: DataFrame, buildings: DataFrame, districts: DataFrame, streets: DataFrame) -> DataFrame:
    """df with null areas filled: the LAD by district, then by building and LAD, then by street and LAD.

    Adds match_prob (the gazetteer's fraction) and geog_match (building, street or null). A building sets oa, lsoa and
    msoa; a street only lsoa and msoa. Only rows without lsoa11cd and with both keys are looked up; gazetteers have one
    row a key and are compared in lower case.
    """
    out = fill_by_district(df, districts).withColumns({"match_prob": F.lit(None).cast("double"), "geog_match": F.lit(None).cast("string")})
    out = _fill_from(out, buildings, "building_name", ("oa11cd", "lsoa11cd", "msoa11cd"), "building")
    return _fill_from(out, streets, "street_name2", ("lsoa11cd", "msoa11cd"), "street")


def forward_fill_in_title(df: DataFrame, order: list[str | Column], columns: tuple[str, ...] = ("oa11cd", "msoa11cd", "lad11cd", "match_prob", "geog_match"), title: str = "title_number") -> DataFrame:
    """Null columns take the value of the nearest row before in their title, rows ordered by geog_match (null last) and ``order``.

    Rows without a title are left as they are. lsoa11cd is not among the columns filled unless asked for. A title that holds
    a good part of all rows is filled in pieces (see plans/ordered).
    """
    in_order = [F.col("geog_match").isNull(), F.col("geog_match"), *[F.col(o) if isinstance(o, str) else o for o in order]]
    with_title = filled_forward(df.where(F.col(title).isNotNull()), title, in_order, columns)
    return with_title.unionByName(df.where(F.col(title).isNull()))
