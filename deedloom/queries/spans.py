"""Queries of labelled spans and address trees whose rules SQL can express: patterns without look-around, and fields found in the address."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deedloom.functions.addresses import STREETS, UNITS
from deedloom.functions.label_patterns import POSTCODE, RANGE
from deedloom.operators.assemble import LEVELS, addresses_of
from deedloom.operators.labelling import RuleLabeller, SpanRule, components_by_type, exploded_spans, label_entities, labelling_summary, overlap_statistics, standard_spans, with_spans_of, without_empty, without_overlaps
from deedloom.operators.quality import bio_labels, bio_spans
from deedloom.queries.properties import _texts, records

#: A second set of rules beside the default one: a user's own labeller.
PLAIN_RULES = (
    SpanRule("postcode", "postcode", POSTCODE), SpanRule("range", "street_number", RANGE), SpanRule("number", "street_number", r"\b\d+[a-z]?\b"), SpanRule("unit", "unit_id", rf"\b{UNITS} \d+[a-z]?\b"),
    SpanRule("street", "street_name", rf"\b[a-z']+ {STREETS}\b"), SpanRule("empty", "unit_id", r"\b"),
)


def plain_engine() -> RuleLabeller:
    return RuleLabeller(PLAIN_RULES)


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    return with_spans_of(_texts(spark, folder), rules=PLAIN_RULES)


def plain_spans(spark: SparkSession, folder: str) -> DataFrame:
    """All spans that the rules find, empty ones left out, one row a span."""
    return exploded_spans(_labelled(spark, folder).withColumn("spans", without_empty(F.col("spans"))), "datapoint_id")


def plain_spans_resolved(spark: SparkSession, folder: str) -> DataFrame:
    """The spans that remain where they overlap."""
    return exploded_spans(_labelled(spark, folder).withColumn("spans", without_empty(without_overlaps(F.col("spans")))), "datapoint_id")


def plain_overlaps(spark: SparkSession, folder: str) -> DataFrame:
    out = overlap_statistics(_labelled(spark, folder).withColumn("spans", without_empty(F.col("spans"))))
    return out.withColumn("pct_with_overlaps", F.round("pct_with_overlaps", 6))


def plain_standard(spark: SparkSession, folder: str) -> DataFrame:
    return _labelled(spark, folder).select("datapoint_id", F.explode(standard_spans(F.col("spans"))).alias("s")).select("datapoint_id", "s.start", "s.end", "s.label")


def plain_entities(spark: SparkSession, folder: str) -> DataFrame:
    """What an engine of the user's own rules gives, one row an entity."""
    found = label_entities(_texts(spark, folder), "datapoint_id", "property_address", plain_engine)
    return found.select("datapoint_id", F.explode("entities").alias("e")).select("datapoint_id", "e.type", "e.text", "e.start", "e.end", "e.confidence")


def plain_components(spark: SparkSession, folder: str) -> DataFrame:
    found = label_entities(_texts(spark, folder), "datapoint_id", "property_address", plain_engine)
    return found.select("datapoint_id", F.explode(components_by_type(F.col("entities"))).alias("type", "texts")).select("datapoint_id", "type", F.array_join("texts", "|").alias("texts"))


def plain_summary(spark: SparkSession, folder: str) -> DataFrame:
    out = labelling_summary(label_entities(_texts(spark, folder), "datapoint_id", "property_address", plain_engine))
    return out.withColumn("success_rate", F.round("success_rate", 9))


def bio_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Spans as BIO labels of blank-separated tokens, and back to runs: one row a run."""
    texts = _labelled(spark, folder).withColumn("spans", without_empty(without_overlaps(F.col("spans"))))
    words = F.split("property_address", " ")
    starts = F.transform(words, lambda w, i: F.aggregate(F.slice(words, 1, i), F.lit(0), lambda a, x: a + F.length(x) + 1))
    tokens = F.zip_with(words, starts, lambda w, s: F.struct(s.alias("start"), (s + F.length(w)).alias("end")))
    runs = texts.withColumn("tokens", tokens).withColumn("labels", bio_labels(F.col("tokens"), F.col("spans"))).select("datapoint_id", F.explode(bio_spans(F.col("labels"))).alias("r"))
    return runs.select("datapoint_id", "r.start", "r.end", "r.label")


_FIELDS = {"city": "city", "postcode": "postcode", "street_name": "street_name", "street_number": "street_number", "building_name": "building_name", "unit_id": "unit_id"}


def _found_fields(df: DataFrame) -> Column:
    """Entities of an address: the fields of its record that stand in it, where they first do."""
    at = lambda c: F.instr("property_address", F.col(c)) - 1
    one = lambda kind, c: F.when((F.length(c) > 0) & (at(c) >= 0), F.struct(F.lit(kind).alias("type"), F.col(c).alias("text"), at(c).cast("int").alias("start"), (at(c) + F.length(c)).cast("int").alias("end"), F.lit(1.0).alias("confidence")))
    return F.array_compact(F.array(*[one(kind, c) for kind, c in _FIELDS.items()]))


def address_tree_of_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Trees of the fields that records' addresses hold, as addresses."""
    rows = records(spark, folder).withColumn("entities", _found_fields(records(spark, folder)))
    return addresses_of(rows, "ocod_id").select("ocod_id", "leaf_pos", *_FIELDS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (plain_spans, plain_spans_resolved, plain_overlaps, plain_standard, plain_entities, plain_components, plain_summary, bio_runs, address_tree_of_fields)}


def _rule_sql(i: int, rule: SpanRule) -> str:
    pattern = "(?i)" + rule.pattern.replace("'", "''")
    # Where the pieces between matches end is where matches begin.
    return f"""SELECT d, t, {i} AS rule, '{rule.label}' AS label, unnest(range(1, len(m) + 1)) AS k, m, p
  FROM (SELECT d, t, regexp_extract_all(t, '{pattern}') AS m, regexp_split_to_array(t, '{pattern}') AS p FROM texts)"""


_RECORDS = "records AS (SELECT * FROM ocod QUALIFY row_number() OVER (PARTITION BY ocod_id ORDER BY loaded_at DESC) = 1)"
_SPANS = f"""{_RECORDS}, texts AS (SELECT min(ocod_id) AS d, max(lower(property_address)) AS t FROM records GROUP BY title_number),
matches AS ({" UNION ALL ".join(_rule_sql(i, r) for i, r in enumerate(PLAIN_RULES) if r.name != "empty")}),
spans AS (
  SELECT d, t, rule, k, label, m[k] AS text, CAST(list_sum(list_transform(p[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:k - 1], lambda x: length(x))), 0) AS INTEGER) AS s FROM matches
), placed AS (SELECT d, t, rule, k, label, text, s, CAST(s + length(text) AS INTEGER) AS e FROM spans WHERE length(text) > 0),
listed AS (SELECT d, any_value(t) AS t, list([{{'s': s, 'e': e, 'label': label, 'text': text}}] ORDER BY e - s DESC, rule, k) AS found FROM placed GROUP BY d),
resolved AS (
  SELECT d, t, list_sort(list_reduce(found, lambda kept, x: CASE WHEN len(list_filter(kept, lambda o: x[1].e > o.s AND o.e > x[1].s)) = 0 THEN list_concat(kept, x) ELSE kept END)) AS kept FROM listed
), alone AS (SELECT d, t, unnest(kept) AS x FROM resolved)"""

ORACLE: dict[str, str] = {
    "plain_spans": f"""WITH {_SPANS} SELECT d AS datapoint_id, s AS start, e AS "end", text, label, t AS property_address FROM placed""",
    "plain_spans_resolved": f"""WITH {_SPANS} SELECT d AS datapoint_id, x.s AS start, x.e AS "end", x.text, x.label, t AS property_address FROM alone""",
    "plain_overlaps": f"""WITH {_SPANS}, n AS (SELECT d, found, len(found) AS before, len(kept) AS after FROM listed JOIN resolved USING (d)), touching AS (
  SELECT DISTINCT d FROM (SELECT d, e, lead(s) OVER (PARTITION BY d ORDER BY s, rule, k) AS nxt FROM placed) WHERE e > nxt
), sums AS (SELECT (SELECT count(*) FROM texts) AS n_rows, (SELECT count(*) FROM touching) AS o, sum(before) AS b, sum(after) AS a FROM n)
SELECT n_rows, o AS rows_with_overlaps, round(100.0 * o / n_rows, 6) AS pct_with_overlaps, CAST(b AS BIGINT) AS spans_before, CAST(b - a AS BIGINT) AS spans_removed, CAST(a AS BIGINT) AS spans_after FROM sums""",
    "plain_standard": f"""WITH {_SPANS} SELECT DISTINCT d AS datapoint_id, s AS start, e AS "end", label FROM placed""",
    "plain_entities": f"""WITH {_SPANS} SELECT d AS datapoint_id, x.label AS type, x.text, x.s AS start, x.e AS "end", CAST(1 AS DOUBLE) AS confidence FROM alone""",
    "plain_components": f"""WITH {_SPANS} SELECT d AS datapoint_id, x.label AS type, string_agg(x.text, '|' ORDER BY x.s) AS texts FROM alone GROUP BY ALL""",
    "plain_summary": f"""WITH {_SPANS}, n AS (SELECT count(*) AS total, count(kept) FILTER (len(kept) > 0) AS good FROM texts LEFT JOIN resolved USING (d))
SELECT total, good AS successful, total - good AS failed, round(good / total, 9) AS success_rate FROM n""",
    "bio_runs": f"""WITH {_SPANS}, words AS (SELECT d, string_split(t, ' ') AS w FROM texts),
tokens AS (SELECT d, i, CAST(coalesce(list_sum(list_transform(w[1:i - 1], lambda x: length(x) + 1)), 0) AS INTEGER) AS s, length(w[i]) AS n FROM (SELECT d, w, unnest(range(1, len(w) + 1)) AS i FROM words)),
held AS (SELECT t.d, t.i, min(a.x.s) AS span, arg_min(a.x.label, a.x.s) AS label FROM tokens t JOIN alone a ON a.d = t.d AND t.n > 0 AND t.s < a.x.e AND t.s + t.n > a.x.s GROUP BY t.d, t.i),
begun AS (
  SELECT h.d, h.i, h.label, NOT EXISTS (SELECT 1 FROM tokens o JOIN alone a ON a.d = o.d AND a.x.s = h.span WHERE o.d = h.d AND o.i < h.i AND o.n > 0 AND o.s < a.x.e AND o.s + o.n > a.x.s) AS b,
    lag(h.i) OVER w AS before, lag(h.label) OVER w AS before_label FROM held h WINDOW w AS (PARTITION BY h.d ORDER BY h.i)
), runs AS (SELECT *, sum(CASE WHEN NOT b AND before = i - 1 AND before_label = label THEN 0 ELSE 1 END) OVER (PARTITION BY d ORDER BY i) AS run FROM begun)
SELECT d AS datapoint_id, CAST(min(i) - 1 AS INTEGER) AS start, CAST(max(i) AS INTEGER) AS "end", any_value(label) AS label FROM runs GROUP BY d, run""",
    "address_tree_of_fields": f"""WITH RECURSIVE {_RECORDS}, ents AS (
  SELECT ocod_id, rank, kind, v, strpos(property_address, v) AS s FROM records, LATERAL (VALUES {", ".join(f"({LEVELS.index(kind)}, '{kind}', {c})" for kind, c in _FIELDS.items())}) f(rank, kind, v)
  WHERE length(v) > 0 AND strpos(property_address, v) > 0
), parents AS (
  SELECT e.ocod_id, e.rank, (SELECT max(h.rank) FROM ents h WHERE h.ocod_id = e.ocod_id AND h.rank < e.rank AND (h.rank = 0 OR e.s < h.s)) AS parent FROM ents e
), leaves AS (
  SELECT ocod_id, rank, row_number() OVER (PARTITION BY ocod_id ORDER BY rank) - 1 AS leaf FROM parents p WHERE NOT EXISTS (SELECT 1 FROM parents c WHERE c.ocod_id = p.ocod_id AND c.parent = p.rank)
), chain AS (
  SELECT ocod_id, leaf, rank FROM leaves
  UNION ALL SELECT c.ocod_id, c.leaf, p.parent FROM chain c JOIN parents p ON p.ocod_id = c.ocod_id AND p.rank = c.rank WHERE p.parent IS NOT NULL
)
SELECT c.ocod_id, CAST(c.leaf AS INTEGER) AS leaf_pos, {", ".join(f"max(trim(e.v, ' ')) FILTER (e.kind = '{kind}') AS {kind}" for kind in _FIELDS)}
FROM chain c JOIN ents e ON e.ocod_id = c.ocod_id AND e.rank = c.rank GROUP BY ALL""",
}
