"""Queries of the property pipeline: locate, match, classify, expand, number."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedloom.functions.text import TOKEN_SPACING, clean_street_number, commercial_park_tag, flat_tag, joined_address, last_number, span_start, street_key, token_spacing, with_missing_columns, with_spans
from deedloom.functions.values import compact
from deedloom.operators.classify import class_by_number, classify, default_rules, drop_repeated_classes, fill_unknown_classes, relabelled
from deedloom.operators.expand import expand_column, expand_numbers, needs_expansion, unique_ids
from deedloom.operators.gazetteers import LEAST_FRACTION, building_gazetteer, building_mentions, district_gazetteer, street_gazetteer, top_share
from deedloom.operators.geo import add_areas, fill_by_gazetteers, forward_fill_in_title
from deedloom.operators.labelling import components_by_type, exploded_spans, label_entities, labelling_summary, overlap_statistics, standard_spans, with_spans_of, without_empty, without_overlaps
from deedloom.operators.assemble import addresses_of
from deedloom.operators.match import add_existence_flags
from deedloom.operators.snapshots import latest_rows
from deedloom.plans.pipeline import run_pipeline
from deedloom.queries.tables import table
from deedloom.sources.archives import HOUSE_STOPS, NO_PREMISES_CODES, NO_PREMISES_TEXT, ONE_CENTRE, businesses_located

_FIELDS = ["title_number", "unit_id", "building_name", "street_number", "street_name", "postcode", "city", "district", "region", "property_address", "country_incorporated", "class", "is_multi"]


def records(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    return latest_rows(table(spark, folder, "ocod"), ["ocod_id"], "loaded_at", [*_FIELDS, *more])


def businesses(spark: SparkSession, folder: str) -> DataFrame:
    """The business register's premises with keys and areas."""
    return businesses_located(table(spark, folder, "voa_register").distinct(), table(spark, folder, "postcode_lookup"), keep=("voa_id",))


def located(spark: SparkSession, folder: str) -> DataFrame:
    lookup = table(spark, folder, "postcode_lookup").select("postcode2", "oa11cd", "lsoa11cd", "msoa11cd", "lad11cd")
    return add_areas(records(spark, folder), lookup).withColumn("building_name", F.lower("building_name"))


def area_join(spark: SparkSession, folder: str) -> DataFrame:
    return located(spark, folder).select("ocod_id", "postcode2", "oa11cd", "lsoa11cd", "msoa11cd", "lad11cd", "street_name2", "street_number2")


def business_register(spark: SparkSession, folder: str) -> DataFrame:
    return businesses(spark, folder)


def existence_flags(spark: SparkSession, folder: str) -> DataFrame:
    flagged = add_existence_flags(located(spark, folder), businesses(spark, folder))
    return flagged.select("ocod_id", "oa_match", "lsoa_match", "building_match", "street_match", "number_match")


def _classified(spark: SparkSession, folder: str) -> DataFrame:
    return classify(add_existence_flags(located(spark, folder), businesses(spark, folder)), default_rules())


def first_match_rules(spark: SparkSession, folder: str) -> DataFrame:
    return _classified(spark, folder).select("ocod_id", "class", "matched_rule")


def group_class_fill(spark: SparkSession, folder: str) -> DataFrame:
    known = records(spark, folder).withColumn("class", F.coalesce(F.lower(F.trim("class")), F.lit("unknown")))
    return fill_unknown_classes(known, excluded=("unknown", "airspace", "carpark", "", "-", "n/a", "unclassified")).select("ocod_id", "class", "was_filled")


def keep_first_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    return drop_repeated_classes(records(spark, folder).where(F.col("class").isNotNull()), ["ocod_id"]).select("ocod_id", "title_number", "class")


def unique_row_ids(spark: SparkSession, folder: str) -> DataFrame:
    return unique_ids(records(spark, folder), ["ocod_id"]).select("ocod_id", "multi_id", "unique_id", "is_multi")


def _ranged(spark: SparkSession, folder: str) -> DataFrame:
    parity = F.when(F.col("property_address").rlike(r"(?i)\(odd"), "odd").when(F.col("property_address").rlike(r"(?i)\(even"), "even")
    return records(spark, folder).withColumn("number_filter", parity).select("ocod_id", "class", "unit_id", "street_number", "number_filter")


def range_expand_filter(spark: SparkSession, folder: str) -> DataFrame:
    return expand_numbers(_ranged(spark, folder)).select("ocod_id", "unit_id", "street_number", "expansion_size", "large_expansion", "expand_block", "expanded_n")


def range_expand_column(spark: SparkSession, folder: str) -> DataFrame:
    return expand_column(needs_expansion(_ranged(spark, folder)), "street_number", large=30).select("ocod_id", "street_number", "expansion_size", "large_expansion")


def street_gazetteer_top1(spark: SparkSession, folder: str) -> DataFrame:
    return street_gazetteer(table(spark, folder, "price_paid_transactions").distinct())


def district_gazetteer_top1(spark: SparkSession, folder: str) -> DataFrame:
    return district_gazetteer(table(spark, folder, "price_paid_transactions").distinct())


def building_gazetteer_top1(spark: SparkSession, folder: str) -> DataFrame:
    return building_gazetteer(building_mentions(table(spark, folder, "price_paid_transactions").distinct(), "transaction_unique_identifier"))


def building_gazetteer_of_records(spark: SparkSession, folder: str) -> DataFrame:
    """The building gazetteer, learned from the records that their postcode locates instead of from sales."""
    named = records(spark, folder).select(F.col("building_name").alias("text"), compact(F.col("postcode")).alias("postcode2")).join(table(spark, folder, "postcode_lookup"), "postcode2")
    mentions = named.select("text", "lad11cd", "lsoa11cd", "oa11cd", "msoa11cd").dropna().distinct()
    return building_gazetteer(mentions)


def _filled(spark: SparkSession, folder: str) -> DataFrame:
    """Located records with areas filled, buildings from the records that their postcode locates."""
    streets = street_gazetteer(table(spark, folder, "price_paid_transactions").distinct())
    named = records(spark, folder).where(F.col("building_name").isNotNull()).select(F.lower("building_name").alias("building_name"), compact(F.col("postcode")).alias("postcode2"))
    places = named.join(table(spark, folder, "postcode_lookup"), "postcode2")
    buildings = top_share(places, ["building_name", "lad11cd"], ["lsoa11cd", "oa11cd", "msoa11cd"], LEAST_FRACTION)
    return fill_by_gazetteers(located(spark, folder), buildings, table(spark, folder, "district_gazetteer"), streets)


def coalesce_fill_chain(spark: SparkSession, folder: str) -> DataFrame:
    return _filled(spark, folder).select("ocod_id", "oa11cd", "lsoa11cd", "msoa11cd", "lad11cd", F.round("match_prob", 6).alias("match_prob"), "geog_match")


def group_forward_fill(spark: SparkSession, folder: str) -> DataFrame:
    filled = forward_fill_in_title(_filled(spark, folder), ["ocod_id"])
    return filled.select("ocod_id", "oa11cd", "msoa11cd", "lad11cd", F.round("match_prob", 6).alias("match_prob"), "geog_match")


def street_key_normalise(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", street_key(F.lower("text")).alias("street_key"))


def clean_numbers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "voa_register").distinct().select("voa_id", "number_or_name", clean_street_number(F.col("number_or_name")).alias("street_number"), last_number(F.col("number_or_name")).alias("digits"))


def keyword_flags(spark: SparkSession, folder: str) -> DataFrame:
    texts = table(spark, folder, "documents").select("doc_id", F.col("text"))
    return texts.select("doc_id", flat_tag(F.col("text")).alias("flat_tag"), commercial_park_tag(F.col("text")).alias("commercial_park_tag"))


def token_spaced(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", token_spacing(F.col("text")).alias("spaced"))


def address_concat(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "price_paid_transactions").distinct()
    return t.select("transaction_unique_identifier", joined_address(*[F.col(c) for c in ("saon", "paon", "street_name2", "locality", "postcode2")]).alias("address"))


def span_find_validate(spark: SparkSession, folder: str) -> DataFrame:
    rows = records(spark, folder).where(F.col("street_name").isNotNull() & F.col("property_address").isNotNull()).select("ocod_id", "property_address", F.col("street_name").alias("text"))
    return with_spans(rows).select("ocod_id", "start", "end", "span_valid", (span_start(F.col("property_address"), F.col("text")) >= 0).alias("found"))


def span_valid_counts(spark: SparkSession, folder: str) -> DataFrame:
    return span_find_validate(spark, folder).groupBy("span_valid").agg(F.count(F.lit(1)).alias("n"))


def class_by_number_filled(spark: SparkSession, folder: str) -> DataFrame:
    """Classes with unknown ones told by their number, and shorter names for two of them."""
    known = records(spark, folder).withColumn("class", F.coalesce(F.lower(F.trim("class")), F.lit("unknown")))
    return relabelled(class_by_number(known), "class", {"residential": "domestic", "carpark": "parking"}).select("ocod_id", "class")


def missing_columns_filled(spark: SparkSession, folder: str) -> DataFrame:
    return with_missing_columns(records(spark, folder).select("ocod_id", "unit_id"), ["unit_id", "unit_type", "number_filter"], "?")


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    return records(spark, folder).groupBy("title_number").agg(F.min("ocod_id").alias("datapoint_id"), F.max(F.lower("property_address")).alias("property_address"))


def span_extract(spark: SparkSession, folder: str) -> DataFrame:
    spans = with_spans_of(_texts(spark, folder)).withColumn("spans", without_empty(without_overlaps(F.col("spans"))))
    return exploded_spans(spans, "datapoint_id")


def span_overlaps(spark: SparkSession, folder: str) -> DataFrame:
    return overlap_statistics(with_spans_of(_texts(spark, folder)))


def span_standard(spark: SparkSession, folder: str) -> DataFrame:
    return with_spans_of(_texts(spark, folder)).select("datapoint_id", F.explode(standard_spans(F.col("spans"))).alias("s")).select("datapoint_id", "s.start", "s.end", "s.label")


def _entities(spark: SparkSession, folder: str) -> DataFrame:
    return label_entities(_texts(spark, folder), "datapoint_id", "property_address")


def entity_summary(spark: SparkSession, folder: str) -> DataFrame:
    return labelling_summary(_entities(spark, folder))


def entity_components(spark: SparkSession, folder: str) -> DataFrame:
    parts = _entities(spark, folder).select("datapoint_id", F.explode(components_by_type(F.col("entities"))).alias("type", "texts"))
    return parts.select("datapoint_id", "type", F.array_join("texts", "|").alias("texts"))


def address_tree(spark: SparkSession, folder: str) -> DataFrame:
    return addresses_of(_entities(spark, folder))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """All snapshots of the raw register, to one located, classified row a property."""
    titles = table(spark, folder, "titles").withColumn("title_number", F.upper(F.trim("title_number")))
    latest = latest_rows(titles, ["title_number", "snapshot_date"], "loaded_at", ["tenure", "district", "county", "region", "price_paid", "property_address", "country_incorporated"]).where(F.col("property_address").isNotNull())
    sales = table(spark, folder, "price_paid_transactions").distinct()
    buildings = building_gazetteer(building_mentions(sales, "transaction_unique_identifier"))
    lookup = table(spark, folder, "postcode_lookup").select("postcode2", "oa11cd", "lsoa11cd", "msoa11cd", "lad11cd")
    return run_pipeline(latest, lookup, businesses(spark, folder), buildings, table(spark, folder, "district_gazetteer"), street_gazetteer(sales))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    area_join, business_register, existence_flags, first_match_rules, group_class_fill, keep_first_dedupe, unique_row_ids, range_expand_filter, range_expand_column, street_gazetteer_top1, district_gazetteer_top1, building_gazetteer_top1, building_gazetteer_of_records, span_valid_counts, class_by_number_filled,
    coalesce_fill_chain, group_forward_fill, street_key_normalise, clean_numbers, keyword_flags, token_spaced, address_concat, span_find_validate, missing_columns_filled, span_extract, span_overlaps, span_standard, entity_summary, entity_components, address_tree, pipeline,
)}

_RECORDS = "records AS (SELECT * FROM ocod QUALIFY row_number() OVER (PARTITION BY ocod_id ORDER BY loaded_at DESC) = 1)"
_KEY = lambda c: f"regexp_replace(regexp_replace(replace({c}, '''', ''), 'ss?(\\s)', '\\1', 'g'), '\\s', '', 'g')"
_PC = lambda c: f"nullif(regexp_replace(lower({c}), '\\s', '', 'g'), '')"
_LOCATED = f"""located AS (
  SELECT r.ocod_id, r.title_number, r.unit_id, lower(r.building_name) AS building_name, r.street_number, r.property_address, r.district, {_PC('r.postcode')} AS postcode2, l.oa11cd, l.lsoa11cd, l.msoa11cd, l.lad11cd,
    lower({_KEY('r.street_name')}) AS street_name2, regexp_replace(CASE WHEN regexp_matches(r.street_number, '\\b[0-9]+$') THEN regexp_extract(r.street_number, '\\b([0-9]+)$', 1) ELSE r.street_number END, '[^0-9]', '', 'g') AS street_number2
  FROM records r LEFT JOIN postcode_lookup l ON l.postcode2 = {_PC('r.postcode')}
)"""


def _clean(c: str) -> str:
    x = f"regexp_replace({c}, '\\(.+\\)', '', 'g')"
    x = f"replace(replace(replace({x}, '+', ' '), '@', ' at '), '&', ' and ')"
    x = f"regexp_replace({x}, '\\s*-\\s*', '-', 'g')"
    x = f"CASE WHEN NOT regexp_matches({x}, '(?i)unit|suite|room') THEN nullif(regexp_extract({x}, '([^\\s]+)$', 1), '') END"
    x = f"regexp_replace(regexp_replace({x}, '[a-zA-Z]', '', 'g'), '^-+|-+$', '', 'g')"
    x = f"trim(regexp_replace(regexp_replace({x}, '[\\\\/]', ' ', 'g'), '-{{2,}}', '-', 'g'))"
    return f"CASE WHEN {x} NOT IN ('', '-') THEN {x} END"


def _house_name(c: str) -> str:
    """Words before the first house in a text, after the last word there that ends a name or holds a digit."""
    bad = r"[0-9\n]|\b(?:" + "|".join(HOUSE_STOPS) + r")\b"
    words = f"string_split(regexp_extract(lower({c}), '^(.*?) house\\b', 1), ' ')"
    ends = f"coalesce(list_max(list_filter(range(1, len({words}) + 1), lambda i: regexp_matches({words}[i], '{bad}'))), 0)"
    return f"CASE WHEN regexp_matches(lower({c}), ' house\\b') AND {ends} < len({words}) THEN array_to_string({words}[{ends} + 1:], ' ') || ' house' END"


_NUMBER = _clean("v.number_or_name")
_BUSINESS = f"""business AS (
  SELECT v.voa_id, {_KEY('lower(v.street)')} AS street_name2, CASE WHEN NOT coalesce(contains(full_property_identifier, '{ONE_CENTRE}'), false) AND NOT coalesce(regexp_matches({_NUMBER}, '-\\d+-'), false) THEN {_NUMBER} END AS street_number,
    {_house_name('v.number_or_name')} AS building_name, l.oa11cd, l.lsoa11cd, l.msoa11cd, l.lad11cd
  FROM (SELECT DISTINCT * FROM voa_register) v JOIN postcode_lookup l ON l.postcode2 = {_PC('v.postcode')}
  WHERE coalesce(primary_and_secondary_description_code NOT IN {NO_PREMISES_CODES}, true) AND coalesce(NOT contains(primary_description_text, '{NO_PREMISES_TEXT}'), true)
)"""
_FLAGS = """flags AS (
  SELECT o.*, EXISTS (SELECT 1 FROM business b WHERE b.oa11cd = o.oa11cd) AS oa_match, EXISTS (SELECT 1 FROM business b WHERE b.lsoa11cd = o.lsoa11cd) AS lsoa_match,
    EXISTS (SELECT 1 FROM business b WHERE b.building_name = o.building_name AND b.lad11cd = o.lad11cd) AS building_match, EXISTS (SELECT 1 FROM business b WHERE b.street_name2 = o.street_name2 AND b.lad11cd = o.lad11cd) AS street_match,
    EXISTS (SELECT 1 FROM business b WHERE b.street_number = o.street_number AND b.street_name2 = o.street_name2 AND b.lad11cd = o.lad11cd) AS number_match
  FROM located o
)"""


def _rules_sql() -> str:
    from deedloom.operators import classify as c
    from deedloom.operators.expand import RANGE

    says = lambda col, pattern: f"regexp_matches({col}, '(?i){pattern.replace(chr(39), chr(39) * 2)}')"
    address = lambda pattern: says("property_address", pattern)
    tests = [
        address(c.LAND_FIRST), address(c.CARPARK), address(c.AIRSPACE), address(c.DWELLING), address(c.BUSINESS_WORDS), address(c.LAND_LATER), says("building_name", c.PUB_NAME),
        f"building_name IS NOT NULL AND regexp_matches(street_number, '{RANGE}') AND unit_id IS NULL", address(c.PART_FIRST), address(c.UNIT_WORD) + " AND building_name IS NULL", "building_match", "number_match", "NOT street_match", "NOT oa_match", "NOT lsoa_match",
    ]
    rules = c.default_rules()
    return "CASE " + " ".join(f"WHEN {t} THEN '{r.value}'" for t, r in zip(tests, rules)) + " ELSE 'unknown' END AS class, CASE " + " ".join(f"WHEN {t} THEN '{r.name}'" for t, r in zip(tests, rules)) + " ELSE 'none' END AS matched_rule"


_TOP_STREET = """streets AS (
  SELECT * FROM (
    SELECT street_name2, lsoa11cd, oa11cd, msoa11cd, lad11cd, n / sum(n) OVER (PARTITION BY street_name2, lad11cd) AS fraction, row_number() OVER (PARTITION BY street_name2, lad11cd ORDER BY n DESC, lsoa11cd, oa11cd, msoa11cd) AS k
    FROM (SELECT street_name2, lad11cd, lsoa11cd, oa11cd, msoa11cd, count(*) AS n FROM (SELECT DISTINCT * FROM price_paid_transactions)
      WHERE street_name2 IS NOT NULL AND lad11cd IS NOT NULL AND lsoa11cd IS NOT NULL AND oa11cd IS NOT NULL AND msoa11cd IS NOT NULL GROUP BY ALL)
  ) WHERE k = 1
)"""
_FILLED = f"""{_TOP_STREET}, buildings AS (
  SELECT * FROM (
    SELECT building_name, lsoa11cd, oa11cd, msoa11cd, lad11cd, n / sum(n) OVER (PARTITION BY building_name, lad11cd) AS fraction, row_number() OVER (PARTITION BY building_name, lad11cd ORDER BY n DESC, lsoa11cd, oa11cd, msoa11cd) AS k
    FROM (SELECT lower(r.building_name) AS building_name, l.lad11cd, l.lsoa11cd, l.oa11cd, l.msoa11cd, count(*) AS n FROM records r JOIN postcode_lookup l ON l.postcode2 = {_PC('r.postcode')} WHERE r.building_name IS NOT NULL GROUP BY ALL)
  ) WHERE k = 1 AND fraction > 0.2
), districted AS (
  SELECT o.* EXCLUDE (lad11cd), coalesce(o.lad11cd, d.lad11cd) AS lad11cd FROM located o LEFT JOIN district_gazetteer d ON lower(o.district) = lower(d.district)
), filled1 AS (
  SELECT o.ocod_id, o.title_number, o.street_name2, o.lad11cd, CASE WHEN h THEN b.oa11cd ELSE o.oa11cd END AS oa11cd, CASE WHEN h THEN b.lsoa11cd ELSE o.lsoa11cd END AS lsoa11cd, CASE WHEN h THEN b.msoa11cd ELSE o.msoa11cd END AS msoa11cd,
    CASE WHEN h THEN b.fraction END AS match_prob, CASE WHEN h THEN 'building' END AS geog_match
  FROM (SELECT o.*, b AS b, o.lsoa11cd IS NULL AND b.lsoa11cd IS NOT NULL AS h FROM districted o LEFT JOIN buildings b ON b.building_name = o.building_name AND b.lad11cd = o.lad11cd) o
), filled AS (
  SELECT ocod_id, title_number, oa11cd, lad11cd, CASE WHEN h THEN s.lsoa11cd ELSE lsoa11cd END AS lsoa11cd, CASE WHEN h THEN s.msoa11cd ELSE msoa11cd END AS msoa11cd, CASE WHEN h THEN s.fraction ELSE match_prob END AS match_prob, CASE WHEN h THEN 'street' ELSE geog_match END AS geog_match
  FROM (SELECT o.*, s AS s, o.lsoa11cd IS NULL AND s.lsoa11cd IS NOT NULL AS h FROM filled1 o LEFT JOIN streets s ON lower(s.street_name2) = o.street_name2 AND s.lad11cd = o.lad11cd)
)"""
_RANGED = r"""ranged AS (
  SELECT ocod_id, class, unit_id, street_number, CASE WHEN regexp_matches(property_address, '(?i)\(odd') THEN 'odd' WHEN regexp_matches(property_address, '(?i)\(even') THEN 'even' END AS number_filter,
    coalesce(regexp_matches(unit_id, '\d+[a-z]?\s?(?:to|-|/)\s?\d+[a-z]?\b'), false) AS ur, coalesce(regexp_matches(street_number, '\d+[a-z]?\s?(?:to|-|/)\s?\d+[a-z]?\b'), false) AS sr
  FROM records
)"""
_NUMBERS = lambda c: f"list_filter((SELECT CASE WHEN len(ns) > 0 THEN range(list_min(ns), list_max(ns) + 1) END FROM (SELECT list_filter(list_transform(regexp_extract_all({c}, '\\d+'), lambda x: try_cast(x AS INTEGER)), lambda x: x IS NOT NULL) AS ns)), lambda n: CASE number_filter WHEN 'odd' THEN n % 2 = 1 WHEN 'even' THEN n % 2 = 0 ELSE true END)"

ORACLE: dict[str, str] = {
    "area_join": f"WITH {_RECORDS}, {_LOCATED} SELECT ocod_id, postcode2, oa11cd, lsoa11cd, msoa11cd, lad11cd, street_name2, street_number2 FROM located",
    "business_register": f"WITH {_BUSINESS} SELECT * FROM business",
    "existence_flags": f"WITH {_RECORDS}, {_LOCATED}, {_BUSINESS}, {_FLAGS} SELECT ocod_id, oa_match, lsoa_match, building_match, street_match, number_match FROM flags",
    "first_match_rules": f"WITH {_RECORDS}, {_LOCATED}, {_BUSINESS}, {_FLAGS} SELECT ocod_id, {_rules_sql()} FROM flags",
    "group_class_fill": f"""WITH {_RECORDS}, r AS (SELECT ocod_id, title_number, is_multi, coalesce(lower(trim(class)), 'unknown') AS class FROM records),
known AS (SELECT DISTINCT title_number, class FROM r WHERE is_multi AND class NOT IN ('unknown', 'airspace', 'carpark', '', '-', 'n/a', 'unclassified'))
SELECT r.ocod_id, coalesce(k.class, r.class) AS class, k.class IS NOT NULL AS was_filled FROM r LEFT JOIN known k ON k.title_number = r.title_number AND r.is_multi AND r.class = 'unknown'""",
    "keep_first_dedupe": f"WITH {_RECORDS} SELECT ocod_id, title_number, class FROM records WHERE class IS NOT NULL QUALIFY class = 'residential' OR row_number() OVER (PARTITION BY title_number, class ORDER BY ocod_id) = 1",
    "unique_row_ids": f"WITH {_RECORDS}, n AS (SELECT ocod_id, title_number, CAST(row_number() OVER (PARTITION BY title_number ORDER BY ocod_id) AS INTEGER) AS multi_id, count(*) OVER (PARTITION BY title_number) > 1 AS is_multi FROM records) SELECT ocod_id, multi_id, title_number || '-' || multi_id AS unique_id, is_multi FROM n",
    "range_expand_filter": f"""WITH {_RECORDS}, {_RANGED}, sized AS (
  SELECT *, CASE WHEN class = 'residential' AND ur THEN 1 WHEN class = 'residential' AND unit_id IS NULL AND sr THEN 2 ELSE 0 END AS b FROM ranged
), listed AS (SELECT *, CASE WHEN b > 0 THEN {_NUMBERS("CASE WHEN b = 1 THEN unit_id ELSE street_number END")} END AS ns FROM sized),
opened AS (SELECT *, CASE WHEN b = 0 THEN 1 ELSE len(ns) END AS n, unnest(CASE WHEN b > 0 AND len(ns) > 1 THEN range(len(ns)) ELSE [0] END) AS i FROM listed)
SELECT ocod_id, CASE WHEN b = 1 AND n > 1 THEN CAST(ns[i + 1] AS VARCHAR) ELSE unit_id END AS unit_id, CASE WHEN b = 2 AND n > 1 THEN CAST(ns[i + 1] AS VARCHAR) ELSE street_number END AS street_number,
  CAST(n AS INTEGER) AS expansion_size, n > 100 AS large_expansion, b AS expand_block, CAST(i AS INTEGER) AS expanded_n FROM opened""",
    "range_expand_column": f"""WITH {_RECORDS}, {_RANGED}, listed AS (SELECT *, coalesce({_NUMBERS('street_number')}, []) AS ns FROM ranged WHERE class = 'residential' AND (ur OR (unit_id IS NULL AND sr)))
SELECT ocod_id, CASE WHEN len(ns) > 1 THEN CAST(ns[i + 1] AS VARCHAR) ELSE street_number END AS street_number, CAST(len(ns) AS INTEGER) AS expansion_size, len(ns) > 30 AS large_expansion
FROM (SELECT *, unnest(CASE WHEN len(ns) > 1 THEN range(len(ns)) ELSE [0] END) AS i FROM listed)""",
    "street_gazetteer_top1": f"WITH {_TOP_STREET} SELECT street_name2, lsoa11cd, oa11cd, msoa11cd, lad11cd, fraction FROM streets",
    "district_gazetteer_top1": """SELECT district, lad11cd FROM (SELECT district, lad11cd, count(*) AS n FROM (SELECT DISTINCT * FROM price_paid_transactions) WHERE district IS NOT NULL AND lad11cd IS NOT NULL GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY district ORDER BY n DESC, lad11cd) = 1""",
    "coalesce_fill_chain": f"WITH {_RECORDS}, {_LOCATED}, {_FILLED} SELECT ocod_id, oa11cd, lsoa11cd, msoa11cd, lad11cd, round(match_prob, 6) AS match_prob, geog_match FROM filled",
    "group_forward_fill": f"""WITH {_RECORDS}, {_LOCATED}, {_FILLED}
SELECT ocod_id, last_value(oa11cd IGNORE NULLS) OVER w AS oa11cd, last_value(msoa11cd IGNORE NULLS) OVER w AS msoa11cd, last_value(lad11cd IGNORE NULLS) OVER w AS lad11cd,
  round(last_value(match_prob IGNORE NULLS) OVER w, 6) AS match_prob, last_value(geog_match IGNORE NULLS) OVER w AS geog_match
FROM filled WINDOW w AS (PARTITION BY title_number ORDER BY geog_match ASC NULLS LAST, ocod_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "street_key_normalise": f"SELECT doc_id, {_KEY('lower(text)')} AS street_key FROM documents",
    "clean_numbers": f"SELECT DISTINCT voa_id, number_or_name, {_clean('number_or_name')} AS street_number, regexp_replace(CASE WHEN regexp_matches(number_or_name, '\\b[0-9]+$') THEN regexp_extract(number_or_name, '\\b([0-9]+)$', 1) ELSE number_or_name END, '[^0-9]', '', 'g') AS digits FROM (SELECT DISTINCT * FROM voa_register)",
    "keyword_flags": r"""SELECT doc_id, coalesce(regexp_matches(text, '(?i)\b(?:apartment|flat|penthouse|unit)s?\b'), false) AS flat_tag,
  coalesce(regexp_matches(text, '(?i)\b(?:(?:business|industrial|commercial|office|technology|science|enterprise|retail|tech|innovation|corporate)\s+park|(?:trading|business|industrial)\s+estate)s?\b'), false) AS commercial_park_tag FROM documents""",
    "address_concat": """SELECT transaction_unique_identifier, replace(regexp_replace(coalesce(saon, '') || ', ' || coalesce(paon, '') || ', ' || coalesce(street_name2, '') || ', ' || coalesce(locality, '') || ', ' || coalesce(postcode2, ''), '^, ', ''), ', , ', ', ') AS address
FROM (SELECT DISTINCT * FROM price_paid_transactions)""",
    "span_find_validate": f"""WITH {_RECORDS}, p AS (SELECT ocod_id, property_address, trim(street_name) AS t, strpos(lower(trim(property_address)), lower(trim(street_name))) - 1 AS s FROM records WHERE street_name IS NOT NULL AND property_address IS NOT NULL)
SELECT ocod_id, CAST(s AS INTEGER) AS start, CAST(CASE WHEN s >= 0 THEN s + length(t) ELSE -1 END AS INTEGER) AS "end", s >= 0 AND lower(substr(property_address, s + 1, length(t))) = lower(t) AS span_valid, s >= 0 AS found FROM p""",
    "missing_columns_filled": f"WITH {_RECORDS} SELECT ocod_id, unit_id, '?' AS unit_type, '?' AS number_filter FROM records",
}
ORACLE["building_gazetteer_of_records"] = f"""WITH {_RECORDS}, mentions AS (SELECT DISTINCT r.building_name AS text, l.lad11cd, l.lsoa11cd, l.oa11cd, l.msoa11cd FROM records r JOIN postcode_lookup l ON l.postcode2 = {_PC('r.postcode')}
  WHERE r.building_name IS NOT NULL AND l.lad11cd IS NOT NULL AND l.lsoa11cd IS NOT NULL AND l.oa11cd IS NOT NULL AND l.msoa11cd IS NOT NULL
), counts AS (SELECT lower(text) AS building_name, lad11cd, lsoa11cd, oa11cd, msoa11cd, count(*) AS n FROM mentions GROUP BY ALL),
ranked AS (SELECT *, n / sum(n) OVER (PARTITION BY building_name, lad11cd) AS fraction, row_number() OVER (PARTITION BY building_name, lad11cd ORDER BY n DESC, lsoa11cd, oa11cd, msoa11cd) AS k FROM counts)
SELECT building_name, oa11cd, lsoa11cd, msoa11cd, lad11cd, fraction FROM ranked WHERE k = 1 AND fraction > {LEAST_FRACTION}"""
ORACLE["span_valid_counts"] = f"SELECT span_valid, count(*) AS n FROM ({ORACLE['span_find_validate']}) GROUP BY span_valid"
ORACLE["class_by_number_filled"] = f"""WITH {_RECORDS}, k AS (SELECT ocod_id, street_number, coalesce(lower(trim(class)), 'unknown') AS class FROM records), c AS (SELECT ocod_id, CASE WHEN class = 'unknown' AND street_number IS NOT NULL THEN 'residential' ELSE class END AS class FROM k)
SELECT ocod_id, CASE class WHEN 'residential' THEN 'domestic' WHEN 'carpark' THEN 'parking' ELSE class END AS class FROM c"""


def _spacing_sql(c: str) -> str:
    """The rewrites of token spacing without look-around: what stands around a mark is matched and put back, twice, as neighbours share it."""
    for pattern, by in TOKEN_SPACING:
        flags = "(?U)" in pattern
        pattern = pattern.replace("(?U)", "")
        before = re.match(r"\(\?<=(\[.*?\])\)", pattern)
        after = re.search(r"\(\?=(\[.*?\]|\\S)\)$", pattern)
        mark = pattern[before.end() if before else 0 : after.start() if after else len(pattern)]
        # Groups of the mark are numbered after the one before it.
        shift = 1 if before else 0
        by = re.sub(r"\$(\d)", lambda m, k=shift: f"\\{int(m.group(1)) + k}", by)
        groups = re.compile(mark).groups
        whole = (f"({before.group(1)})" if before else "") + mark + (f"({after.group(1)})" if after else "")
        put = ("\\1" if before else "") + by + (f"\\{groups + shift + 1}" if after else "")
        if flags:
            blank = r"[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
            whole = re.sub(r"\\[sS]", lambda m: blank if m.group() == r"\s" else blank.replace("[", "[^", 1), whole).replace(r"\d", r"\p{Nd}")  # noqa: B023
        for _ in range(2 if after else 1):
            c = f"regexp_replace({c}, '{whole.replace(chr(39), chr(39) * 2)}', '{put}', 'g')"
    return c


ORACLE["token_spaced"] = f"SELECT doc_id, regexp_replace({_spacing_sql('text')}, '^ | $', '', 'g') AS spaced FROM documents"
