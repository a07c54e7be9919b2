"""Whether keys of a record occur in another table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The flags of a match with businesses, and the keys of each.
BUSINESS_FLAGS = {
    "oa_match": ("oa11cd",),
    "lsoa_match": ("lsoa11cd",),
    "building_match": ("building_name", "lad11cd"),
    "street_match": ("street_name2", "lad11cd"),
    "number_match": ("street_number", "street_name2", "lad11cd"),
}


def add_existence_flags(df: DataFrame, other: DataFrame, flags: Mapping[str, Sequence[str]] = BUSINESS_FLAGS) -> DataFrame:
    """df with a boolean for each flag: whether ``other`` has a row with the same keys. A null key gives false.

    The other table's keys are made distinct first, so no row of df is ever repeated; small key sets are broadcast by
    their size.
    """
    for flag, keys in flags.items():
        found = other.select(*[F.col(k).alias(f"_{k}") for k in keys]).dropna().distinct().withColumn("_found", F.lit(True))
        same = [F.col(k) == F.col(f"_{k}") for k in keys]
        df = df.drop(flag).join(found, same, "left").withColumn(flag, F.coalesce("_found", F.lit(False))).drop("_found", *[f"_{k}" for k in keys])
    return df
