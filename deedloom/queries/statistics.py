"""Queries of prices, trends, quality measures and result tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedloom.functions.text import band
from deedloom.operators import analytics as A
from deedloom.functions.values import present
from deedloom.operators.fill import Gap, Level, fill_missing
from deedloom.operators.prices import area_averages, between_dates, in_years, rolling_averages
from deedloom.operators.quality import bio_labels, bio_spans, classification_report, diagnose_class, error_texts, performance_by_rule, span_errors, span_scores, truth_and_prediction
from deedloom.operators.trends import mean_differences, monthly_means, summary_counts, weighted_series
from deedloom.queries.properties import _texts, records
from deedloom.operators.labelling import BUILDING_RULES, DEFAULT_RULES, label_spans, with_spans_of, without_empty, without_overlaps
from deedloom.operators.snapshots import latest_rows
from deedloom.queries.register import _value
from deedloom.queries.tables import table

CLASSES = ["airspace", "business", "carpark", "land", "residential"]


def _sales(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "price_paid_transactions").distinct()


def _months(spark: SparkSession, folder: str) -> DataFrame:
    """The first days of months with sales, from three years after the first sale's month on (their windows are whole), as snapshots."""
    months = _sales(spark, folder).select(F.trunc("date_of_transfer", "month").alias("snapshot_date")).where(F.col("snapshot_date").isNotNull()).distinct()
    first = months.agg(F.add_months(F.min("snapshot_date"), 36).alias("first"))
    return months.join(F.broadcast(first), F.col("snapshot_date") >= F.col("first")).select("snapshot_date")


def mean_median_by_area(spark: SparkSession, folder: str) -> DataFrame:
    out = area_averages(_sales(spark, folder))
    return out.select("msoa11cd", F.round(F.col("price_mean") * F.col("n")).cast("long").alias("price_sum"), (F.col("price_median") * 2).cast("long").alias("median_twice"), "n")


def rolling_3y_window(spark: SparkSession, folder: str) -> DataFrame:
    out = rolling_averages(_sales(spark, folder), _months(spark, folder))
    return out.select("snapshot_date", "msoa11cd", F.round(F.col("price_mean") * F.col("n")).cast("long").alias("price_sum"), (F.col("price_median") * 2).cast("long").alias("median_twice"), "n")


def sales_of_years(spark: SparkSession, folder: str) -> DataFrame:
    return in_years(_sales(spark, folder), 2028, 2030, column="transfer_year").groupBy("transfer_year").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("price_sum"))


def sales_between_dates(spark: SparkSession, folder: str) -> DataFrame:
    return between_dates(_sales(spark, folder), "2028-03-01", "2029-03-01").groupBy("district").agg(F.count(F.lit(1)).alias("n"), F.min("date_of_transfer").alias("first_day"), F.max("date_of_transfer").alias("last_day"))


def _homes(spark: SparkSession, folder: str) -> DataFrame:
    """Titles by snapshot with an area each: nation stands for it, orders for homes, as in the SQL."""
    o, c = table(spark, folder, "orders"), table(spark, folder, "customer")
    joined = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("snapshot_date"), F.col("c_nationkey").cast("string").alias("msoa11cd"), F.col("c_mktsegment").alias("segment"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))


def _area_prices(homes: DataFrame) -> DataFrame:
    averages = homes.groupBy("snapshot_date", "msoa11cd").agg(F.sum("cents").alias("s"), F.count("cents").alias("n"), F.median("cents").alias("price_median"))
    return averages.select("snapshot_date", "msoa11cd", F.floor(F.col("s") / F.col("n")).alias("price_mean"), F.floor("price_median").alias("price_median"))


def _dwellings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").groupBy(F.col("c_nationkey").cast("string").alias("msoa11cd")).agg(F.count(F.lit(1)).alias("dwellings"))


def weighted_index(spark: SparkSession, folder: str) -> DataFrame:
    homes = _homes(spark, folder)
    out = weighted_series(homes, _area_prices(homes), _dwellings(spark, folder), ["segment"])
    return out.select("date", "segment", "ocod_mean", "ocod_median", "dwelling_mean", "dwelling_median", F.round("ocod_ratio_mean", 6).alias("ocod_ratio_mean"), "ocod_total_counts", "total_dwelling_count")


def mean_difference_trend(spark: SparkSession, folder: str) -> DataFrame:
    homes = _homes(spark, folder)
    out = mean_differences(monthly_means(homes, _area_prices(homes), ["segment"]), ["segment"], bootstrap=False)
    return out.select("segment", F.round("mean_weighted_difference", 2).alias("mean_weighted_difference"), F.round("mean_unweighted_difference", 2).alias("mean_unweighted_difference"), "n_periods")


def bootstrap_trend(spark: SparkSession, folder: str) -> DataFrame:
    homes = _homes(spark, folder)
    return mean_differences(monthly_means(homes, _area_prices(homes), ["segment"]), ["segment"])


def _snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return records(spark, folder, "expansion_size").withColumn("snapshot_date", F.lit("2031-01-01").cast("date"))


def summarised_stats(name: str, most_expanded: int | None = None) -> Callable[[SparkSession, str], DataFrame]:
    """Counts of all records or, with ``most_expanded``, of those expanded to fewer rows by their expansion_size."""
    def query(spark: SparkSession, folder: str) -> DataFrame:
        rows = _snapshots(spark, folder).withColumn("lad11cd", F.col("district"))
        return summary_counts(rows, most_expanded=most_expanded)[name]

    return query


def class_crosstab(spark: SparkSession, folder: str) -> DataFrame:
    return A.crosstab(records(spark, folder), "region", "class", CLASSES, margins=True)


def class_crosstab_shares(spark: SparkSession, folder: str) -> DataFrame:
    out = A.crosstab(records(spark, folder), "region", "class", CLASSES, normalize="columns")
    return out.select("region", *[F.round(c, 9).alias(c) for c in CLASSES])


def pivot_prices(spark: SparkSession, folder: str) -> DataFrame:
    return A.pivoted(_sales(spark, folder), ["district"], "property_type", ["D", "F", "S", "T"], F.sum("price"))


def describe_prices(spark: SparkSession, folder: str) -> DataFrame:
    out = A.described(_sales(spark, folder), "price", ["property_type"])
    return out.select("property_type", "count", F.round("std", 3).alias("std"), "min", "q25", "q50", "q75", "max")


def region_shares(spark: SparkSession, folder: str) -> DataFrame:
    out = A.shares(records(spark, folder), ["class"], within=["region"])
    return out.select("region", "class", "n", F.round("share", 9).alias("share"))


def missing_by_class(spark: SparkSession, folder: str) -> DataFrame:
    out = A.null_rates(records(spark, folder), ["unit_id", "building_name", "street_number"], ["class"])
    return out.select("class", "n", *[F.round(f"{c}_null_rate", 9).alias(f"{c}_null_rate") for c in ("unit_id", "building_name", "street_number")])


def _monthly(spark: SparkSession, folder: str) -> DataFrame:
    homes = _homes(spark, folder)
    return homes.groupBy("segment", "snapshot_date").agg(F.sum("cents").alias("value"))


def first_last_ratio(spark: SparkSession, folder: str) -> DataFrame:
    out = A.first_last_change(_monthly(spark, folder), ["segment"], "snapshot_date", "value")
    return out.select("segment", "first", "last", F.round("ratio", 9).alias("ratio"))


def lag_diff_monthly(spark: SparkSession, folder: str) -> DataFrame:
    out = A.changes(_monthly(spark, folder), ["segment"], "snapshot_date", "value")
    return out.select("segment", "snapshot_date", "diff", F.round("relative_change", 9).alias("relative_change"), band(F.col("relative_change"), -0.05, 0.05).alias("band"))


def months_gap_change(spark: SparkSession, folder: str) -> DataFrame:
    out = A.projected_change(_monthly(spark, folder), ["segment"], "snapshot_date", "value")
    return out.select("segment", F.round("mean_monthly_change", 3).alias("mean_monthly_change"), F.round("total_change", 3).alias("total_change"))


def top_customers(spark: SparkSession, folder: str) -> DataFrame:
    return A.top(table(spark, folder, "customer"), "c_acctbal", 20, ties=["c_custkey"]).select("c_custkey", "c_acctbal")


def bottom_customers(spark: SparkSession, folder: str) -> DataFrame:
    return A.top(table(spark, folder, "customer"), "c_acctbal", 10, largest=False, ties=["c_custkey"]).select("c_custkey", "c_acctbal")


def balance_concentration(spark: SparkSession, folder: str) -> DataFrame:
    cents = table(spark, folder, "customer").select(F.round(F.col("c_acctbal") * 100).cast("long").alias("cents"))
    return A.concentration(cents, "cents").select("sign", "top_sum", "total", F.round("share", 9).alias("share"))


def winsorised(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select("c_custkey", A.clipped(F.col("c_acctbal"), low=-500.0, high=9000.0).alias("clipped"))


def large_titles(spark: SparkSession, folder: str) -> DataFrame:
    return records(spark, folder).groupBy("title_number").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 50)


def _judged(spark: SparkSession, folder: str) -> DataFrame:
    """Delivered classes of records beside those that the raw register's text of their title suggests, by title; all records and spellings of classes."""
    text = table(spark, folder, "titles").where(F.trim("title_number") != "").groupBy(F.upper(F.trim("title_number")).alias("title_number")).agg(F.max("property_address").alias("text"))
    guess = F.when(F.col("text").rlike("(?i)^(?:land|site)"), "land").when(F.col("text").rlike("(?i)airspace"), "airspace").when(F.col("text").rlike("(?i)^(?:parking|garage)"), "carpark").otherwise("residential")
    truth = records(spark, folder).select(F.upper(F.trim("title_number")).alias("title_number"), F.coalesce(F.lower(F.trim("class")), F.lit("unknown")).alias("class"), F.when(F.col("unit_id").isNotNull(), "unit").otherwise("no unit").alias("matched_rule"))
    return truth_and_prediction(truth, text.select("title_number", guess.alias("class")), "title_number").select("title_number", F.col("class_truth").alias("truth"), F.col("class_predicted").alias("guess"), "matched_rule")


def truth_beside_prediction(spark: SparkSession, folder: str) -> DataFrame:
    """How often each delivered class stands beside each guessed one."""
    return _judged(spark, folder).groupBy("truth", "guess").agg(F.count(F.lit(1)).alias("n"))


def class_report(spark: SparkSession, folder: str) -> DataFrame:
    out = classification_report(_judged(spark, folder), "truth", "guess")
    return out.select("label", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support")


def rule_performance(spark: SparkSession, folder: str) -> DataFrame:
    out = performance_by_rule(_judged(spark, folder), "truth", "guess")
    return out.select("matched_rule", "n", *[F.round(c, 9).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


def _span_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Street and number spans as delivered, beside those found: offsets of street_name and street_number in the address."""
    rows = records(spark, folder).where(F.col("property_address").isNotNull())
    at = lambda c, label: rows.where(F.col(c).isNotNull()).select(F.col("ocod_id").alias("datapoint_id"), F.instr("property_address", F.col(c)).alias("start"), (F.instr("property_address", F.col(c)) + F.length(c)).alias("end"), F.lit(label).alias("label"))
    truth = at("street_name", "street_name").unionByName(at("street_number", "street_number")).where(F.col("start") > 0)
    guessed = at("street_name", "street_name").unionByName(at("unit_id", "street_number")).where(F.col("start") > 0)
    return truth, guessed


def entity_prf(spark: SparkSession, folder: str) -> DataFrame:
    out = span_scores(*_span_tables(spark, folder), per_text=True)
    return out.select("label", "tp", "fp", "fn", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


def entity_prf_pooled(spark: SparkSession, folder: str) -> DataFrame:
    out = span_scores(*_span_tables(spark, folder))
    return out.select("label", "tp", "fp", "fn", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


def entity_errors(spark: SparkSession, folder: str) -> DataFrame:
    return span_errors(*_span_tables(spark, folder)).groupBy("label", "error").agg(F.count(F.lit(1)).alias("n"))


def entity_error_texts(spark: SparkSession, folder: str) -> DataFrame:
    """The most frequent texts of missed and wrong spans."""
    truth, guessed = _span_tables(spark, folder)
    # Offsets of these tables count from 1.
    errors = span_errors(truth, guessed).withColumns({"start": F.col("start") - 1, "end": F.col("end") - 1})
    return error_texts(errors, records(spark, folder).select(F.col("ocod_id").alias("datapoint_id"), F.col("property_address").alias("text")))


def _located_homes(spark: SparkSession, folder: str) -> DataFrame:
    """Records with areas, nulls where the record has none, and their class as it is delivered."""
    return latest_rows(table(spark, folder, "ocod"), ["ocod_id"], "loaded_at", ["msoa11cd", "lad11cd", "region"]).withColumns({"snapshot_date": F.lit("2031-01-01").cast("date"), "msoa11cd": present(F.col("msoa11cd")), "lad11cd": present(F.col("lad11cd"))})


def weighted_index_lad(spark: SparkSession, folder: str) -> DataFrame:
    """Weighted averages in which records without an area take their district's; dwellings are the postcodes of an area."""
    sales = area_averages(_sales(spark, folder)).select(F.lit("2031-01-01").cast("date").alias("snapshot_date"), "msoa11cd", F.floor("price_mean").alias("price_mean"), F.floor("price_median").alias("price_median"))
    dwellings = table(spark, folder, "postcode_lookup").where(F.col("msoa11cd").isNotNull()).groupBy("msoa11cd").agg(F.count(F.lit(1)).alias("dwellings"))
    priced = _located_homes(spark, folder).join(sales.select(F.col("msoa11cd").alias("_known")), F.col("msoa11cd") == F.col("_known"), "left").where(F.col("msoa11cd").isNull() | F.col("_known").isNotNull()).drop("_known")
    out = weighted_series(priced, sales, dwellings, ["region"], lad="lad11cd")
    return out.select("date", "region", "ocod_mean", "ocod_median", "dwelling_mean", "dwelling_median", "ocod_total_counts", "total_dwelling_count")


def median_fills(spark: SparkSession, folder: str) -> DataFrame:
    """Missing prices of records, filled by the median of the district and class, else of the region, each with 3 votes at least."""
    rows = latest_rows(table(spark, folder, "ocod"), ["ocod_id"], "loaded_at", ["price_paid", "district", "class", "region"])
    levels = [Level("district and class", F.concat("district", F.lit("|"), "class"), 3), Level("region", F.col("region"), 3)]
    return fill_missing(rows, Gap("price_paid", levels), "ocod_id", "median").select("ocod_id", "price_paid_filled", "price_paid_is_filled", "price_paid_fill_level")


def merged_results(spark: SparkSession, folder: str) -> DataFrame:
    """Results by district side by side: records, sales and the district's code."""
    counts = records(spark, folder).where(F.col("district").isNotNull()).groupBy("district").agg(F.count(F.lit(1)).alias("n_records"))
    sales = _sales(spark, folder).where(F.col("district").isNotNull()).groupBy("district").agg(F.sum("price").alias("price_sum"))
    return A.merged([counts, sales, table(spark, folder, "district_gazetteer")], ["district"], "left")


def entity_diagnosis(spark: SparkSession, folder: str) -> DataFrame:
    texts = _texts(spark, folder).select(F.col("property_address").alias("text"))
    truth = texts.withColumn("spans", without_empty(without_overlaps(label_spans(F.col("text"), DEFAULT_RULES))))
    guess = texts.withColumn("spans", without_empty(label_spans(F.col("text"), BUILDING_RULES)))
    return diagnose_class(truth, guess, "building_name").groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def bio_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Spans as BIO labels of blank-separated tokens, and back; by label how many runs there are."""
    texts = with_spans_of(_texts(spark, folder)).withColumn("spans", without_empty(without_overlaps(F.col("spans"))))
    words = F.split("property_address", " ")
    starts = F.transform(words, lambda w, i: F.aggregate(F.slice(words, 1, i), F.lit(0), lambda a, x: a + F.length(x) + 1))
    tokens = F.zip_with(words, starts, lambda w, s: F.struct(s.alias("start"), (s + F.length(w)).alias("end")))
    runs = texts.withColumn("tokens", tokens).withColumn("labels", bio_labels(F.col("tokens"), F.col("spans"))).select(F.explode(bio_spans(F.col("labels"))).alias("r"))
    return runs.groupBy("r.label").agg(F.count(F.lit(1)).alias("n_runs"), F.sum(F.col("r.end") - F.col("r.start")).alias("n_tokens"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    mean_median_by_area, rolling_3y_window, sales_of_years, sales_between_dates, weighted_index, mean_difference_trend, bootstrap_trend, class_crosstab, class_crosstab_shares, pivot_prices, describe_prices, region_shares, missing_by_class,
    first_last_ratio, lag_diff_monthly, months_gap_change, top_customers, bottom_customers, balance_concentration, winsorised, large_titles, class_report, rule_performance, truth_beside_prediction, entity_error_texts, weighted_index_lad, median_fills, merged_results, entity_prf, entity_prf_pooled, entity_errors, entity_diagnosis, bio_round_trip,
)} | {f"summarised_stats_{name}{end}": summarised_stats(name, most) for name in ("multi", "multi_lad", "region_class", "country") for end, most in (("", None), ("_below_100", 100))}

_RECORDS = "records AS (SELECT * FROM ocod QUALIFY row_number() OVER (PARTITION BY ocod_id ORDER BY loaded_at DESC) = 1)"
_SALES = "sales AS (SELECT DISTINCT * FROM price_paid_transactions), homes AS (SELECT * FROM sales WHERE property_type IN ('D', 'S', 'F', 'T') AND ppd_category_type = 'A' AND msoa11cd IS NOT NULL)"
_ORDERS = """homes AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date, CAST(c_nationkey AS VARCHAR) AS msoa11cd, c_mktsegment AS segment, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders JOIN customer ON o_custkey = c_custkey),
prices AS (SELECT snapshot_date, msoa11cd, floor(CAST(sum(cents) AS DOUBLE) / count(cents)) AS price_mean, floor(median(cents)) AS price_median FROM homes GROUP BY ALL),
dwellings AS (SELECT CAST(c_nationkey AS VARCHAR) AS msoa11cd, count(*) AS dwellings FROM customer GROUP BY ALL)"""
_MONTHLY = f"WITH {_ORDERS}, monthly AS (SELECT segment, snapshot_date, CAST(sum(cents) AS BIGINT) AS value FROM homes GROUP BY ALL)"
_JUDGED = f"""WITH {_RECORDS}, texts AS (SELECT upper(trim(title_number)) AS title_number, max(property_address) AS text FROM titles WHERE trim(title_number) <> '' GROUP BY ALL), judged AS (
  SELECT coalesce(lower(trim(class)), 'unknown') AS truth, CASE WHEN regexp_matches(text, '(?i)^(?:land|site)') THEN 'land' WHEN regexp_matches(text, '(?i)airspace') THEN 'airspace' WHEN regexp_matches(text, '(?i)^(?:parking|garage)') THEN 'carpark' ELSE 'residential' END AS guess,
    CASE WHEN unit_id IS NOT NULL THEN 'unit' ELSE 'no unit' END AS matched_rule
  FROM records r JOIN texts t ON t.title_number = upper(trim(r.title_number))
)"""
_SPANS = f"""WITH {_RECORDS}, rows AS (SELECT * FROM records WHERE property_address IS NOT NULL),
street AS (SELECT ocod_id, strpos(property_address, street_name) AS s, strpos(property_address, street_name) + length(street_name) AS e, 'street_name' AS label FROM rows WHERE street_name IS NOT NULL),
number AS (SELECT ocod_id, strpos(property_address, street_number) AS s, strpos(property_address, street_number) + length(street_number) AS e, 'street_number' AS label FROM rows WHERE street_number IS NOT NULL),
unit AS (SELECT ocod_id, strpos(property_address, unit_id) AS s, strpos(property_address, unit_id) + length(unit_id) AS e, 'street_number' AS label FROM rows WHERE unit_id IS NOT NULL),
truth AS (SELECT DISTINCT * FROM (SELECT * FROM street UNION ALL SELECT * FROM number) WHERE s > 0), guess AS (SELECT DISTINCT * FROM (SELECT * FROM street UNION ALL SELECT * FROM unit) WHERE s > 0)"""


def _prf_sql(keys: str) -> str:
    return f"""{_SPANS}, t AS (SELECT DISTINCT {keys} FROM truth), g AS (SELECT DISTINCT {keys} FROM guess),
counted AS (
  SELECT label, sum(t) AS n_t, sum(g) AS n_g, sum(t * g) AS tp FROM (SELECT coalesce(t.label, g.label) AS label, (t.label IS NOT NULL)::INT AS t, (g.label IS NOT NULL)::INT AS g FROM t FULL JOIN g USING ({keys})) GROUP BY label
), rows2 AS (SELECT * FROM counted UNION ALL SELECT 'overall', sum(n_t), sum(n_g), sum(tp) FROM counted),
scored AS (SELECT *, CASE WHEN n_g > 0 THEN tp / n_g ELSE 0 END AS p, CASE WHEN n_t > 0 THEN tp / n_t ELSE 0 END AS r FROM rows2)
SELECT label, CAST(tp AS BIGINT) AS tp, CAST(n_g - tp AS BIGINT) AS fp, CAST(n_t - tp AS BIGINT) AS fn, round(p, 9) AS precision, round(r, 9) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 9) AS f1 FROM scored"""


_SCORED = """, labels AS (
  SELECT {by} label, sum(tp) AS tp, sum(p) AS n_p, sum(a) AS n_a FROM (
    SELECT {by} truth AS label, 1 AS a, 0 AS p, (truth = guess)::INT AS tp FROM judged UNION ALL SELECT {by} guess, 0, 1, 0 FROM judged) GROUP BY ALL
), pr AS (SELECT *, CASE WHEN n_p > 0 THEN tp / n_p ELSE 0 END AS p, CASE WHEN n_a > 0 THEN tp / n_a ELSE 0 END AS r FROM labels), f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1 FROM pr)"""
_CLASS_COUNTS = ", ".join(f"count(*) FILTER (class = '{c}') AS {c}" for c in CLASSES)
_IN_CLASSES = "class IN (" + ", ".join(f"'{c}'" for c in CLASSES) + ")"

ORACLE: dict[str, str] = {
    "mean_median_by_area": f"WITH {_SALES} SELECT msoa11cd, CAST(sum(price) AS BIGINT) AS price_sum, CAST(median(price) * 2 AS BIGINT) AS median_twice, count(price) AS n FROM homes GROUP BY msoa11cd",
    "rolling_3y_window": f"""WITH {_SALES}, months AS (SELECT DISTINCT CAST(date_trunc('month', date_of_transfer) AS DATE) AS d FROM sales WHERE date_trunc('month', date_of_transfer) >= (SELECT date_trunc('month', min(date_of_transfer)) + INTERVAL 3 YEAR FROM sales))
SELECT d AS snapshot_date, msoa11cd, CAST(sum(price) AS BIGINT) AS price_sum, CAST(median(price) * 2 AS BIGINT) AS median_twice, count(price) AS n
FROM months JOIN homes ON date_of_transfer BETWEEN d - INTERVAL 3 YEAR AND d WHERE price IS NOT NULL GROUP BY ALL""",
    "sales_of_years": f"WITH {_SALES} SELECT transfer_year, count(*) AS n, CAST(sum(price) AS BIGINT) AS price_sum FROM sales WHERE transfer_year IN (2028, 2030) GROUP BY ALL",
    "sales_between_dates": f"WITH {_SALES} SELECT district, count(*) AS n, min(date_of_transfer) AS first_day, max(date_of_transfer) AS last_day FROM sales WHERE date_of_transfer BETWEEN DATE '2028-03-01' AND DATE '2029-03-01' GROUP BY ALL",
    "weighted_index": f"""WITH {_ORDERS}, cells AS (
  SELECT c.*, p.price_mean, p.price_median, d.dwellings FROM (SELECT snapshot_date, msoa11cd, segment, count(*) AS n FROM homes GROUP BY ALL) c LEFT JOIN prices p USING (snapshot_date, msoa11cd) LEFT JOIN dwellings d USING (msoa11cd)
), sums AS (
  SELECT snapshot_date, segment, sum(price_mean * n) / sum(n) AS om, sum(price_median * n) / sum(n) AS od, sum(price_mean * dwellings) / sum(dwellings) AS dm, sum(price_median * dwellings) / sum(dwellings) AS dd, sum(n) AS n, sum(dwellings) AS d FROM cells GROUP BY ALL
)
SELECT snapshot_date AS date, segment, CAST(trunc(om) AS BIGINT) AS ocod_mean, CAST(trunc(od) AS BIGINT) AS ocod_median, CAST(trunc(dm) AS BIGINT) AS dwelling_mean, CAST(trunc(dd) AS BIGINT) AS dwelling_median, round(om / dm, 6) AS ocod_ratio_mean, CAST(n AS BIGINT) AS ocod_total_counts, CAST(d AS BIGINT) AS total_dwelling_count FROM sums""",
    "mean_difference_trend": f"""WITH {_ORDERS}, means AS (
  SELECT snapshot_date, segment, sum(price_mean * n) / sum(n) AS w, avg(price_mean) AS u FROM (SELECT snapshot_date, msoa11cd, segment, count(*) AS n FROM homes GROUP BY ALL) JOIN prices USING (snapshot_date, msoa11cd) GROUP BY ALL
), steps AS (SELECT segment, w - lag(w) OVER o AS dw, u - lag(u) OVER o AS du FROM means WINDOW o AS (PARTITION BY segment ORDER BY snapshot_date))
SELECT segment, round(avg(dw), 2) AS mean_weighted_difference, round(avg(du), 2) AS mean_unweighted_difference, CAST(count(dw) AS INTEGER) AS n_periods FROM steps GROUP BY segment HAVING count(dw) > 0""",
    "class_crosstab": f"""WITH {_RECORDS}, c AS (SELECT region, {_CLASS_COUNTS} FROM records WHERE region IS NOT NULL AND {_IN_CLASSES} GROUP BY region), b AS (SELECT * FROM c UNION ALL SELECT 'All', {", ".join(f"CAST(sum({c}) AS BIGINT)" for c in CLASSES)} FROM c)
SELECT *, {" + ".join(CLASSES)} AS "All" FROM b""",
    "class_crosstab_shares": f"WITH {_RECORDS}, c AS (SELECT region, {_CLASS_COUNTS} FROM records WHERE region IS NOT NULL AND {_IN_CLASSES} GROUP BY region) SELECT region, " + ", ".join(f"round(coalesce({c} / nullif(sum({c}) OVER (), 0), 0), 9) AS {c}" for c in CLASSES) + " FROM c",
    "pivot_prices": f"WITH {_SALES} SELECT district, " + ", ".join(f"CAST(coalesce(sum(price) FILTER (property_type = '{t}'), 0) AS BIGINT) AS {t}" for t in "DFST") + " FROM sales WHERE district IS NOT NULL AND property_type IS NOT NULL GROUP BY district",
    "describe_prices": f"WITH {_SALES} SELECT property_type, count(price) AS count, round(stddev_samp(price), 3) AS std, min(price) AS min, quantile_cont(price, 0.25) AS q25, quantile_cont(price, 0.5) AS q50, quantile_cont(price, 0.75) AS q75, max(price) AS max FROM sales GROUP BY property_type",
    "region_shares": f"WITH {_RECORDS} SELECT region, class, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY region), 9) AS share FROM records WHERE region IS NOT NULL AND class IS NOT NULL GROUP BY region, class",
    "missing_by_class": f"WITH {_RECORDS} SELECT class, count(*) AS n, round(count(*) FILTER (unit_id IS NULL) / count(*), 9) AS unit_id_null_rate, round(count(*) FILTER (building_name IS NULL) / count(*), 9) AS building_name_null_rate, round(count(*) FILTER (street_number IS NULL) / count(*), 9) AS street_number_null_rate FROM records GROUP BY class",
    "first_last_ratio": f"{_MONTHLY} SELECT segment, arg_min(value, snapshot_date) AS first, arg_max(value, snapshot_date) AS last, round(arg_max(value, snapshot_date) / arg_min(value, snapshot_date), 9) AS ratio FROM monthly GROUP BY segment",
    "lag_diff_monthly": f"""{_MONTHLY}, l AS (SELECT *, value - lag(value) OVER o AS diff, CAST(value - lag(value) OVER o AS DOUBLE) / lag(value) OVER o AS rel FROM monthly WINDOW o AS (PARTITION BY segment ORDER BY snapshot_date))
SELECT segment, snapshot_date, diff, round(rel, 9) AS relative_change, CASE WHEN rel > 0.05 THEN 'increase' WHEN rel < -0.05 THEN 'decrease' ELSE 'stable' END AS band FROM l""",
    "months_gap_change": f"""{_MONTHLY}, l AS (SELECT segment, CAST(value - lag(value) OVER o AS DOUBLE) / datediff('month', lag(snapshot_date) OVER o, snapshot_date) AS m FROM monthly WINDOW o AS (PARTITION BY segment ORDER BY snapshot_date))
SELECT segment, round(avg(m), 3) AS mean_monthly_change, round(avg(m) * (SELECT datediff('month', min(snapshot_date), max(snapshot_date)) FROM monthly), 3) AS total_change FROM l GROUP BY segment""",
    "top_customers": "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal IS NOT NULL ORDER BY c_acctbal DESC, c_custkey LIMIT 20",
    "bottom_customers": "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal IS NOT NULL ORDER BY c_acctbal, c_custkey LIMIT 10",
    "balance_concentration": """WITH c AS (SELECT CAST(round(c_acctbal * 100) AS BIGINT) AS v FROM customer), s AS (SELECT CASE WHEN v > 0 THEN 'positive' ELSE 'negative' END AS sign, v FROM c WHERE v <> 0),
r AS (SELECT *, row_number() OVER (PARTITION BY sign ORDER BY abs(v) DESC) AS k FROM s)
SELECT sign, CAST(sum(v) FILTER (k <= 20) AS BIGINT) AS top_sum, CAST(sum(v) AS BIGINT) AS total, round(sum(v) FILTER (k <= 20) / sum(v), 9) AS share FROM r GROUP BY sign""",
    "winsorised": "SELECT c_custkey, CASE WHEN c_acctbal < -500 THEN -500.0 WHEN c_acctbal > 9000 THEN 9000.0 ELSE c_acctbal END AS clipped FROM customer",
    "large_titles": f"WITH {_RECORDS} SELECT title_number, count(*) AS n FROM records GROUP BY title_number HAVING count(*) > 50",
    "class_report": _JUDGED + _SCORED.format(by="") + """
SELECT label, round(p, 9) AS precision, round(r, 9) AS recall, round(f1, 9) AS f1, CAST(n_a AS BIGINT) AS support FROM f
UNION ALL SELECT 'accuracy', round(sum(tp) / sum(n_a), 9), round(sum(tp) / sum(n_a), 9), round(sum(tp) / sum(n_a), 9), CAST(sum(n_a) AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round(avg(p), 9), round(avg(r), 9), round(avg(f1), 9), CAST(sum(n_a) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(sum(p * n_a) / sum(n_a), 9), round(sum(r * n_a) / sum(n_a), 9), round(sum(f1 * n_a) / sum(n_a), 9), CAST(sum(n_a) AS BIGINT) FROM f""",
    "rule_performance": _JUDGED + _SCORED.format(by="matched_rule,") + """
SELECT matched_rule, CAST(sum(n_a) AS BIGINT) AS n, round(sum(tp) / sum(n_a), 9) AS accuracy, round(sum(p * n_a) / sum(n_a), 9) AS precision, round(sum(r * n_a) / sum(n_a), 9) AS recall, round(sum(f1 * n_a) / sum(n_a), 9) AS f1 FROM f GROUP BY matched_rule""",
    "entity_prf": _prf_sql("ocod_id, s, e, label"),
    "entity_prf_pooled": _prf_sql("s, e, label"),
    "entity_errors": f"{_SPANS} SELECT label, 'FN' AS error, count(*) AS n FROM (SELECT * FROM truth EXCEPT SELECT * FROM guess) GROUP BY label UNION ALL SELECT label, 'FP', count(*) FROM (SELECT * FROM guess EXCEPT SELECT * FROM truth) GROUP BY label",
    "summarised_stats_multi": f"WITH {_RECORDS} SELECT DATE '2031-01-01' AS snapshot_date, is_multi, count(*) AS counts FROM records WHERE class = 'residential' AND is_multi IS NOT NULL GROUP BY is_multi",
    "summarised_stats_multi_lad": f"WITH {_RECORDS} SELECT DATE '2031-01-01' AS snapshot_date, is_multi, district AS lad11cd, count(*) AS counts FROM records WHERE class = 'residential' AND is_multi IS NOT NULL AND district IS NOT NULL GROUP BY is_multi, district",
    "summarised_stats_region_class": f"WITH {_RECORDS} SELECT DATE '2031-01-01' AS snapshot_date, region, class, count(*) AS counts FROM records WHERE region IS NOT NULL AND class IS NOT NULL GROUP BY region, class",
    "summarised_stats_country": f"WITH {_RECORDS} SELECT DATE '2031-01-01' AS snapshot_date, country_incorporated, count(*) AS counts FROM records WHERE country_incorporated IS NOT NULL GROUP BY country_incorporated",
}
ORACLE |= {f"{k}_below_100": sql.replace("FROM records WHERE", "FROM records WHERE expansion_size < 100 AND") for k, sql in ORACLE.items() if k.startswith("summarised_stats_")}
ORACLE |= {
    "truth_beside_prediction": _JUDGED + " SELECT truth, guess, count(*) AS n FROM judged GROUP BY ALL",
    "entity_error_texts": f"""{_SPANS}, errors AS (SELECT label, 'FN' AS error, ocod_id, s, e FROM (SELECT * FROM truth EXCEPT SELECT * FROM guess) UNION ALL SELECT label, 'FP', ocod_id, s, e FROM (SELECT * FROM guess EXCEPT SELECT * FROM truth)),
counts AS (SELECT label, error, substr(property_address, s, e - s) AS text, count(*) AS n FROM errors JOIN records USING (ocod_id) GROUP BY ALL)
SELECT label, error, text, n FROM counts QUALIFY row_number() OVER (PARTITION BY label, error ORDER BY n DESC, text) <= 10""",
    "weighted_index_lad": f"""WITH {_RECORDS}, {_SALES}, prices AS (SELECT msoa11cd, floor(avg(price)) AS mean, floor(median(price)) AS med FROM homes GROUP BY msoa11cd),
placed AS (SELECT region, {_value('msoa11cd')} AS m, {_value('lad11cd')} AS lad FROM records WHERE region IS NOT NULL), dwellings AS (SELECT msoa11cd AS m, count(*) AS dw FROM postcode_lookup WHERE msoa11cd IS NOT NULL GROUP BY ALL),
cells AS (SELECT region, p.m, min(lad) AS lad, count(*) AS n, any_value(mean) AS mean, any_value(med) AS med, any_value(dw) AS dw FROM placed p JOIN prices ON prices.msoa11cd = p.m LEFT JOIN dwellings d ON d.m = p.m GROUP BY region, p.m),
by_lad AS (SELECT region, lad, sum(mean * n) / sum(n) AS mean, sum(med * n) / sum(n) AS med FROM cells GROUP BY ALL),
lost AS (SELECT p.region, p.lad, count(*) AS n, any_value(b.mean) AS mean, any_value(b.med) AS med FROM placed p LEFT JOIN by_lad b ON b.region = p.region AND b.lad = p.lad WHERE p.m IS NULL AND p.lad IS NOT NULL GROUP BY p.region, p.lad),
whole AS (SELECT region, n, mean, med, coalesce(dw, 0) AS dw FROM cells UNION ALL SELECT region, n, mean, med, 0 FROM lost),
sums AS (SELECT region, bool_and(mean IS NOT NULL) AS sure, sum(mean * n) / sum(n) AS om, sum(med * n) / sum(n) AS od, sum(mean * dw) / nullif(sum(dw), 0) AS dm, sum(med * dw) / nullif(sum(dw), 0) AS dd, sum(n) AS n, sum(dw) AS d FROM whole GROUP BY region)
SELECT DATE '2031-01-01' AS date, region, CASE WHEN sure THEN CAST(trunc(om) AS BIGINT) END AS ocod_mean, CASE WHEN sure THEN CAST(trunc(od) AS BIGINT) END AS ocod_median, CASE WHEN sure THEN CAST(trunc(dm) AS BIGINT) END AS dwelling_mean, CASE WHEN sure THEN CAST(trunc(dd) AS BIGINT) END AS dwelling_median,
  CAST(n AS BIGINT) AS ocod_total_counts, CAST(d AS BIGINT) AS total_dwelling_count FROM sums""",
    "median_fills": f"""WITH {_RECORDS}, a AS (SELECT district, class, quantile_disc(price_paid, 0.5) AS v FROM records WHERE price_paid IS NOT NULL AND district IS NOT NULL AND class IS NOT NULL GROUP BY ALL HAVING count(*) >= 3),
b AS (SELECT region, quantile_disc(price_paid, 0.5) AS v FROM records WHERE price_paid IS NOT NULL AND region IS NOT NULL GROUP BY ALL HAVING count(*) >= 3)
SELECT ocod_id, coalesce(price_paid, a.v, b.v) AS price_paid_filled, price_paid IS NULL AND coalesce(a.v, b.v) IS NOT NULL AS price_paid_is_filled, CASE WHEN price_paid IS NOT NULL THEN NULL WHEN a.v IS NOT NULL THEN 'district and class' WHEN b.v IS NOT NULL THEN 'region' END AS price_paid_fill_level
FROM records r LEFT JOIN a ON a.district = r.district AND a.class = r.class LEFT JOIN b ON b.region = r.region""",
    "merged_results": f"""WITH {_RECORDS}, c AS (SELECT district, count(*) AS n_records FROM records WHERE district IS NOT NULL GROUP BY ALL), s AS (SELECT district, CAST(sum(price) AS BIGINT) AS price_sum FROM (SELECT DISTINCT * FROM price_paid_transactions) GROUP BY ALL)
SELECT c.district, n_records, price_sum, lad11cd FROM c LEFT JOIN s ON s.district = c.district LEFT JOIN district_gazetteer g ON g.district = c.district""",
}
