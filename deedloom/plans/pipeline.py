"""The property pipeline: title snapshots to one located, classified row a property."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deedloom.operators.assemble import PARTS, addresses_of
from deedloom.operators.classify import Rule, classify, default_rules, drop_repeated_classes, fill_unknown_classes
from deedloom.operators.expand import expand_numbers, unique_ids
from deedloom.operators.geo import add_areas, fill_by_gazetteers, forward_fill_in_title
from deedloom.operators.labelling import Labeller, RuleLabeller, label_entities
from deedloom.operators.match import add_existence_flags
from deedloom.plans.session import cut
from deedloom.plans.sizes import hot_keys, salted_left_join

# The columns of the result, in order.
OUTPUT = (
    "title_number", "multi_id", "unique_id", "unit_id", "unit_type", "building_name", "street_number", "street_name", "postcode", "city", "district", "region", "property_address", "oa11cd", "lsoa11cd", "msoa11cd", "lad11cd",
    "country_incorporated", "class", "matched_rule", "is_multi", "expansion_size", "large_expansion",
)


def with_datapoint_id(titles: DataFrame) -> DataFrame:
    """Titles with datapoint_id: a hash of snapshot, title and address, the same on every run and for any number of rows."""
    snapshot = F.col("snapshot_date") if "snapshot_date" in titles.columns else F.lit(None).cast("date")
    return titles.withColumn("datapoint_id", F.xxhash64(snapshot, "title_number", "property_address")).dropDuplicates(["datapoint_id"])


def parse_titles(titles: DataFrame, make: Callable[[], Labeller] = RuleLabeller) -> DataFrame:
    """One row for each address in a title's text, with the title's columns; titles without an address vanish.

    Texts are labelled in lower case, as the rules expect; each distinct text goes to Python once, however many titles and
    snapshots have it, and is joined back in pieces where a good part of them do.
    """
    keyed = cut(titles.withColumn("_text_id", F.unhex(F.md5(F.lower("property_address")))))
    texts = keyed.where(F.col("_text_id").isNotNull()).groupBy("_text_id").agg(F.min(F.lower("property_address")).alias("_text"))
    # Titles and labelled texts are read several times below, so both are written down once.
    parsed = cut(addresses_of(label_entities(texts.repartition(2 * titles.sparkSession.sparkContext.defaultParallelism, "_text_id"), "_text_id", "_text", make), "_text_id"))
    return salted_left_join(keyed, parsed, "_text_id", F.col("datapoint_id"), hot_keys(keyed.select("_text_id"), "_text_id")).where(F.col("leaf_pos").isNotNull()).drop("_text_id")


def run_pipeline(
    titles: DataFrame, lookup: DataFrame, businesses: DataFrame, buildings: DataFrame, districts: DataFrame, streets: DataFrame, make: Callable[[], Labeller] = RuleLabeller, rules: Sequence[Rule] | None = None
) -> DataFrame:
    """The OUTPUT columns (and snapshot_date, if titles has it) for every property of every snapshot.

    titles: the snapshot columns, several snapshots in one table if it has snapshot_date. lookup: areas by postcode.
    businesses: keys of business premises. The gazetteers have one row a key.

    One plan over all snapshots: what happens within a title happens within (snapshot, title), and windows over a title
    share its partitioning. Rows of a title are numbered by what was expanded, class and place in the text, as listed below.
    """
    dated = "snapshot_date" in titles.columns
    scoped = titles if dated else titles.withColumn("snapshot_date", F.lit("1970-01-01").cast("date"))
    # Keys of groups within one snapshot; the title itself is put back at the end.
    keyed = with_datapoint_id(scoped).withColumn("_title", F.col("title_number")).withColumn("title_number", F.concat_ws("|", F.col("snapshot_date").cast("string"), F.col("title_number")))
    located = add_areas(cut(parse_titles(keyed, make)), lookup)
    order = ["datapoint_id", "leaf_pos"]
    filled = forward_fill_in_title(fill_by_gazetteers(located, buildings, districts, streets), order)
    flagged = unique_ids(add_existence_flags(filled, businesses), order)
    classed = classify(flagged, default_rules() if rules is None else rules)
    kept = drop_repeated_classes(fill_unknown_classes(classed), [~F.col("was_filled"), *order])
    expanded = cut(expand_numbers(kept))
    last = [F.col("expand_block"), F.col("class") != "residential", ~F.col("was_filled"), "datapoint_id", "leaf_pos", "expanded_n"]
    numbered = unique_ids(expanded, last).withColumn("title_number", F.col("_title")).withColumn("unique_id", F.concat_ws("-", "_title", F.col("multi_id").cast("string")))
    present = {c: F.lit(None).cast("string") for c in OUTPUT if c not in numbered.columns}
    return numbered.withColumns(present).select(*OUTPUT, *(["snapshot_date"] if dated else []))


__all__ = ["OUTPUT", "PARTS", "parse_titles", "run_pipeline", "with_datapoint_id"]
