"""Queries that write tables as the files a source has and read them back by the source's reader."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedloom.operators.prices import clean_transactions
from deedloom.plans.session import checkpoint_folder
from deedloom.queries.tables import table
from deedloom.sources.archives import REGISTER_POSITIONS, TITLE_COLUMNS, TRANSACTION_COLUMNS, read_businesses, read_dwellings, read_postcodes, read_titles, read_transactions, with_file_metadata
from deedloom.sources.sinks import ensure_table, write_by_year, write_metrics, write_new_partitions, write_zipped_csv


def _place(spark: SparkSession) -> str:
    """A new folder beside the checkpoints, which all executors share."""
    return f"{checkpoint_folder(spark).rstrip('/')}/round-trips/{uuid.uuid4().hex}"


def zipped_titles(spark: SparkSession, folder: str) -> DataFrame:
    path = _place(spark)
    write_zipped_csv(table(spark, folder, "titles").select(*[F.col(c).alias(c.replace("_", " ").title()) for c in TITLE_COLUMNS]), path, "titles.csv", "OCOD_FULL_2031_01")
    return read_titles(spark, f"{path}/*.zip")


def zipped_postcodes(spark: SparkSession, folder: str) -> DataFrame:
    path = _place(spark)
    rows = table(spark, folder, "postcode_lookup").select(F.upper("postcode2").alias("pcds"), F.col("lad11cd").alias("lad25cd"), "oa11cd", "lsoa11cd", "msoa11cd", F.when(F.col("msoa11cd").isNotNull(), "E92000001").otherwise("S92000003").alias("ctry25cd"))
    write_zipped_csv(rows, path, "Data/ONSPD_2031.csv")
    return read_postcodes(spark, f"{path}/*.zip")


def zipped_businesses(spark: SparkSession, folder: str) -> DataFrame:
    path = _place(spark)
    empty = [F.lit(None).cast("string").alias(f"c{i}") for i in range(max(REGISTER_POSITIONS) + 1)]
    rows = table(spark, folder, "voa_register").select(*[F.col(REGISTER_POSITIONS[i]) if i in REGISTER_POSITIONS else c for i, c in enumerate(empty)])
    write_zipped_csv(rows, path, "register.csv", delimiter="*", header=False)
    return read_businesses(spark, f"{path}/*.zip")


def transactions_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions as CSV without header, read and cleaned, with areas by postcode."""
    path = _place(spark)
    t = table(spark, folder, "price_paid_transactions").distinct()
    have = {"street": F.col("street_name2"), "postcode": F.col("postcode2"), **{c: F.col(c) for c in t.columns}}
    t.select(*[have.get(c, F.lit(None)).cast("string").alias(c) for c in TRANSACTION_COLUMNS]).write.csv(path, quote='"', escape='"')
    out = clean_transactions(read_transactions(spark, path), table(spark, folder, "postcode_lookup"))
    return out.select("transaction_unique_identifier", "price", "date_of_transfer", "property_type", "ppd_category_type", "paon", "saon", "locality", "district", "street_name2", "street_number", "postcode2", "year", "oa11cd", "lsoa11cd", "msoa11cd", "lad11cd")


def new_partitions_only(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots written in two goes, of which the second adds only what isn't there."""
    path, titles = _place(spark), table(spark, folder, "titles").select("title_number", "tenure", "snapshot_date")
    first = titles.agg(F.min("snapshot_date").alias("d")).first().d
    write_new_partitions(titles.where(F.col("snapshot_date") == first), path, "snapshot_date")
    write_new_partitions(titles, path, "snapshot_date")
    return spark.read.parquet(path).groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"), F.count("tenure").alias("n_tenure"))


def sales_by_year(spark: SparkSession, folder: str) -> DataFrame:
    """Sales written by year, kept as a table that is made once, and read."""
    path, sales = _place(spark), table(spark, folder, "price_paid_transactions").distinct()
    write_by_year(sales, path)
    made = ensure_table(spark, path, lambda: sales.limit(0))
    return made.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("price_sum"))


def dwellings_by_area(spark: SparkSession, folder: str) -> DataFrame:
    """A sheet of counts, as CSV, summed by area."""
    path = _place(spark)
    write_metrics(table(spark, folder, "postcode_lookup").groupBy("msoa11cd", "lsoa11cd").agg(F.count(F.lit(1)).alias("dwellings")), path)
    return read_dwellings(spark, path)


def file_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Names and months of the files that rows came from."""
    path = _place(spark)
    n = write_zipped_csv(table(spark, folder, "titles").select("title_number").coalesce(1), path, "titles.csv", "OCOD_FULL_2031_05")
    files = with_file_metadata(spark.read.format("binaryFile").load(f"{path}/*.zip").select("path"), "path")
    return files.select(F.regexp_replace("filename", r"-\d+$", "").alias("filename"), "snapshot_date", F.lit(n).alias("n_files"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (zipped_titles, zipped_postcodes, zipped_businesses, transactions_cleaned, new_partitions_only, sales_by_year, dwellings_by_area, file_metadata)}

_KEY = lambda c: f"regexp_replace(regexp_replace(replace({c}, '''', ''), 'ss?(\\s)', '\\1', 'g'), '\\s', '', 'g')"


def _oracle() -> dict[str, str]:
    from deedloom.queries.properties import _clean

    text = lambda *columns: ", ".join(f"nullif({c}, '') AS {c}" for c in columns)
    return {
        "zipped_titles": f"SELECT {text(*[c for c in TITLE_COLUMNS if c != 'price_paid'])}, price_paid, DATE '2031-01-01' AS snapshot_date FROM titles WHERE property_address <> ''",
        "zipped_postcodes": "SELECT nullif(regexp_replace(lower(postcode2), '\\s', '', 'g'), '') AS postcode2, nullif(lad11cd, '') AS lad11cd, nullif(oa11cd, '') AS oa11cd, nullif(lsoa11cd, '') AS lsoa11cd, nullif(msoa11cd, '') AS msoa11cd FROM postcode_lookup WHERE msoa11cd IS NOT NULL",
        "zipped_businesses": f"SELECT {text(*REGISTER_POSITIONS.values())} FROM voa_register",
        "transactions_cleaned": f"""SELECT transaction_unique_identifier, price, CAST(date_of_transfer AS DATE) AS date_of_transfer, CASE WHEN property_type IN ('D', 'S', 'T', 'F', 'O') THEN property_type END AS property_type, CASE WHEN ppd_category_type IN ('A', 'B') THEN ppd_category_type END AS ppd_category_type,
  lower(paon) AS paon, saon, lower(locality) AS locality, district, {_KEY("lower(t.street_name2)")} AS street_name2, {_clean("lower(paon)")} AS street_number, nullif(regexp_replace(lower(t.postcode2), '\\s', '', 'g'), '') AS postcode2, CAST(year(date_of_transfer) AS INTEGER) AS year, l.oa11cd, l.lsoa11cd, l.msoa11cd, l.lad11cd
FROM (SELECT DISTINCT * FROM price_paid_transactions) t LEFT JOIN postcode_lookup l ON l.postcode2 = regexp_replace(lower(t.postcode2), '\\s', '', 'g') WHERE date_of_transfer IS NOT NULL""",
        "new_partitions_only": "SELECT snapshot_date, count(*) AS n, count(tenure) AS n_tenure FROM titles GROUP BY snapshot_date",
        "sales_by_year": "SELECT CAST(year(date_of_transfer) AS INTEGER) AS year, count(*) AS n, CAST(sum(price) AS BIGINT) AS price_sum FROM (SELECT DISTINCT * FROM price_paid_transactions) WHERE date_of_transfer IS NOT NULL GROUP BY ALL",
        "dwellings_by_area": "SELECT msoa11cd, count(*) AS dwellings FROM postcode_lookup WHERE msoa11cd IS NOT NULL GROUP BY msoa11cd",
        "file_metadata": "SELECT 'OCOD_FULL_2031_05' AS filename, DATE '2031-05-01' AS snapshot_date, CAST(1 AS INTEGER) AS n_files",
    }


ORACLE: dict[str, str] = _oracle()
