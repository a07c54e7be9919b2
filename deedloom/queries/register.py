"""p3, p5 and p6: filling, packed values and snapshot changes of the register."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedloom.functions.values import compact
from deedloom.operators.fill import Gap, Level, fill_missing, missing_fills
from deedloom.operators.packed import split_packed
from deedloom.operators.snapshots import latest_rows, snapshot_changes
from deedloom.queries.tables import table

_CODES = ("oa11cd", "lsoa11cd")


def _records(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each ocod record, as delivered last."""
    return latest_rows(table(spark, folder, "ocod"), ["ocod_id"], "loaded_at", ["title_number", "postcode2", *_CODES, "class"])


def _gaps() -> list[Gap]:
    postcode = compact(F.col("postcode2"))
    place = F.when(postcode.isNotNull(), F.concat(F.lit("p"), postcode)).otherwise(F.concat(F.lit("t"), F.col("title_number")))
    title = F.col("title_number")
    return [*[Gap(c, [Level("postcode", place)]) for c in _CODES], Gap("class", [Level("title", title)])]


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    fills = missing_fills(_records(spark, folder), _gaps(), "ocod_id")
    return fills.select(F.col("row_id").alias("ocod_id"), "field_name", "fill_value")


def p3_backed_off(spark: SparkSession, folder: str) -> DataFrame:
    """lsoa11cd of every record: from the postcode, else the title, else the postcode's district, each with 2 votes at least."""
    postcode = compact(F.col("postcode2"))
    levels = [Level("postcode", postcode, 2), Level("title", F.col("title_number"), 2), Level("outward", F.regexp_replace(postcode, r"[0-9][a-z]{2}$", ""), 2)]
    filled = fill_missing(_records(spark, folder), Gap("lsoa11cd", levels), "ocod_id")
    return filled.select("ocod_id", "lsoa11cd_filled", "lsoa11cd_is_filled", "lsoa11cd_fill_level")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return split_packed(table(spark, folder, "ocod"), "title_number", "property_address")


def p5_counts(spark: SparkSession, folder: str) -> DataFrame:
    """For each title with packed values, how many there are and whether the delivered expansion_size agrees."""
    ocod = table(spark, folder, "ocod")
    counted = split_packed(ocod, "title_number", "property_address").groupBy("title_number").agg(F.count(F.lit(1)).alias("n_values"))
    stated = ocod.groupBy("title_number").agg(F.max("expansion_size").alias("stated_size"))
    return counted.join(stated, "title_number").select("title_number", "n_values", "stated_size", F.coalesce(F.col("n_values") == F.col("stated_size"), F.lit(False)).alias("agrees"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    changes = snapshot_changes(table(spark, folder, "titles"), "title_number", "snapshot_date", ["tenure", "country_incorporated"], latest_by="loaded_at")
    return changes.select(F.date_format("snapshot", "yyyy-MM-dd").alias("snapshot_day"), "title_number", "change_kind")


def p6_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Changed titles with the fields that changed, as one text."""
    changes = snapshot_changes(table(spark, folder, "titles"), "title_number", "snapshot_date", ["tenure", "country_incorporated"], latest_by="loaded_at")
    return changes.where(F.col("change_kind") == "changed").select(F.date_format("snapshot", "yyyy-MM-dd").alias("snapshot_day"), "title_number", F.array_join("changed_fields", ",").alias("changed_fields"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p3_found": p3_found,
    "p3_backed_off": p3_backed_off,
    "p5_found": p5_found,
    "p5_counts": p5_counts,
    "p6_found": p6_found,
    "p6_fields": p6_fields,
}

_NO_VALUE = "('', '-', '--', '?', '.', 'N/A', 'NA', 'N.A.', 'N/K', 'NAN', 'NIL', 'NONE', 'NOT KNOWN', 'NOT STATED', 'NULL', 'TBC', 'UNCLASSIFIED', 'UNKNOWN')"
_RECORDS = """records AS (
  SELECT * FROM ocod QUALIFY row_number() OVER (PARTITION BY ocod_id ORDER BY loaded_at DESC) = 1
)"""


def _value(c: str) -> str:
    return f"CASE WHEN upper(trim({c})) NOT IN {_NO_VALUE} THEN trim({c}) END"


_P3 = f"""WITH {_RECORDS}, cells AS (
  SELECT ocod_id, 'oa11cd' AS field_name, CASE WHEN pc IS NULL THEN 't' || title_number ELSE 'p' || pc END AS k, {_value('oa11cd')} AS v
  FROM (SELECT *, nullif(regexp_replace(lower(postcode2), '\\s', '', 'g'), '') AS pc FROM records)
  UNION ALL
  SELECT ocod_id, 'lsoa11cd', CASE WHEN pc IS NULL THEN 't' || title_number ELSE 'p' || pc END, {_value('lsoa11cd')}
  FROM (SELECT *, nullif(regexp_replace(lower(postcode2), '\\s', '', 'g'), '') AS pc FROM records)
  UNION ALL
  SELECT ocod_id, 'class', title_number, {_value('class')} FROM records
), votes AS (
  SELECT field_name, k, v, count(*) AS n FROM cells WHERE v IS NOT NULL AND k IS NOT NULL GROUP BY ALL
), best AS (
  SELECT field_name, k, v, n, count(*) OVER (PARTITION BY field_name, k, n) AS equals, max(n) OVER (PARTITION BY field_name, k) AS most FROM votes
)
SELECT c.ocod_id, c.field_name, b.v AS fill_value
FROM cells c JOIN best b ON b.field_name = c.field_name AND b.k = c.k AND b.n = b.most AND b.equals = 1
WHERE c.v IS NULL"""

_P3_BACK = f"""WITH {_RECORDS}, r AS (
  SELECT ocod_id, title_number AS g1, pc AS g0, regexp_replace(pc, '[0-9][a-z][a-z]$', '') AS g2, {_value('lsoa11cd')} AS v
  FROM (SELECT *, nullif(regexp_replace(lower(postcode2), '\\s', '', 'g'), '') AS pc FROM records)
), votes AS (
  SELECT 0 AS lv, g0 AS k, v, count(*) AS n FROM r WHERE v IS NOT NULL AND g0 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT 1, g1, v, count(*) FROM r WHERE v IS NOT NULL AND g1 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT 2, g2, v, count(*) FROM r WHERE v IS NOT NULL AND g2 IS NOT NULL GROUP BY ALL
), best AS (
  SELECT lv, k, v FROM (SELECT *, count(*) OVER (PARTITION BY lv, k, n) AS equals, max(n) OVER (PARTITION BY lv, k) AS most, sum(n) OVER (PARTITION BY lv, k) AS support FROM votes)
  WHERE n = most AND equals = 1 AND support >= 2
)
SELECT r.ocod_id, coalesce(r.v, b0.v, b1.v, b2.v) AS lsoa11cd_filled,
  r.v IS NULL AND coalesce(b0.v, b1.v, b2.v) IS NOT NULL AS lsoa11cd_is_filled,
  CASE WHEN r.v IS NOT NULL THEN NULL WHEN b0.v IS NOT NULL THEN 'postcode' WHEN b1.v IS NOT NULL THEN 'title' WHEN b2.v IS NOT NULL THEN 'outward' END AS lsoa11cd_fill_level
FROM r LEFT JOIN best b0 ON b0.lv = 0 AND b0.k = r.g0 LEFT JOIN best b1 ON b1.lv = 1 AND b1.k = r.g1 LEFT JOIN best b2 ON b2.lv = 2 AND b2.k = r.g2"""

_P6_PAIRS = """WITH latest AS (
  SELECT upper(trim(title_number)) AS t, snapshot_date AS d, nullif(upper(trim(tenure)), '') AS f1, nullif(upper(trim(country_incorporated)), '') AS f2
  FROM titles WHERE trim(title_number) <> '' AND snapshot_date IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY upper(trim(title_number)), snapshot_date ORDER BY loaded_at DESC NULLS LAST, f1 DESC NULLS LAST, f2 DESC NULLS LAST) = 1
), dates AS (
  SELECT d, lead(d) OVER (ORDER BY d) AS nxt FROM (SELECT DISTINCT d FROM latest)
), old AS (
  SELECT t, nxt AS d, f1, f2 FROM latest JOIN dates USING (d) WHERE nxt IS NOT NULL
), new AS (
  SELECT t, d, f1, f2 FROM latest WHERE d IN (SELECT nxt FROM dates)
), pairs AS (
  SELECT coalesce(n.d, o.d) AS d, coalesce(n.t, o.t) AS t, o.t IS NULL AS was_added, n.t IS NULL AS was_removed,
    o.f1 IS DISTINCT FROM n.f1 AS c1, o.f2 IS DISTINCT FROM n.f2 AS c2
  FROM old o FULL JOIN new n ON o.t = n.t AND o.d = n.d
)"""

ORACLE: dict[str, str] = {
    "p3_found": _P3,
    "p3_backed_off": _P3_BACK,
    "p6_found": _P6_PAIRS + """
SELECT strftime(d, '%Y-%m-%d') AS snapshot_day, t AS title_number, CASE WHEN was_added THEN 'added' WHEN was_removed THEN 'removed' ELSE 'changed' END AS change_kind
FROM pairs WHERE was_added OR was_removed OR c1 OR c2""",
    "p6_fields": _P6_PAIRS + """
SELECT strftime(d, '%Y-%m-%d') AS snapshot_day, t AS title_number, concat_ws(',', CASE WHEN c2 THEN 'country_incorporated' END, CASE WHEN c1 THEN 'tenure' END) AS changed_fields
FROM pairs WHERE NOT was_added AND NOT was_removed AND (c1 OR c2)""",
}
