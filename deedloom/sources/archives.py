"""Delimited files in zip archives, and the register's own layouts."""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from itertools import islice
from typing import IO
from urllib.parse import quote

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedloom.functions.text import clean_street_number, snapshot_month, street_key
from deedloom.functions.values import compact

#: Records of a member that are handed on at a time.
RECORDS = 10_000
#: File systems whose files are read as streams; others' come whole through Spark.
STREAMED = ("file", "hdfs", "viewfs", "s3", "gs", "gcs", "abfs", "abfss")


def member_of(names: Sequence[str], wanted: str | None = None, pattern: str | None = None) -> str:
    """The member asked for: by name, by pattern, else the first .csv; ValueError lists what there is."""
    fits = [n for n in names if n == wanted] if wanted else [n for n in names if re.search(pattern, n)] if pattern else [n for n in names if n.lower().endswith(".csv")]
    if not fits:
        raise ValueError(f"no such member; there are: {', '.join(names) or 'none'}")
    return fits[0]


@contextmanager
def _opened(path: str, content: bytes | None) -> Iterator[IO[bytes]]:
    """A file to seek in: in memory if its content is given, else of any file system that pyarrow knows."""
    if content is not None:
        yield io.BytesIO(content)
    elif path.startswith(("file:", "/")):
        with open(re.sub(r"^file:/*", "/", path), "rb") as f:
            yield f
    else:
        system, name = pafs.FileSystem.from_uri(quote(path, safe=":/@?&=%+,"))
        with system.open_input_file(name) as f:
            yield f


def read_zipped_records(spark: SparkSession, path: str, member: str | None = None, pattern: str | None = None, largest: bool = False, encoding: str = "utf-8", delimiter: str = ",", first_only: bool = False) -> DataFrame:
    """(file, record_no, fields): records of a delimited member of each archive at ``path``; undecodable bytes are dropped.

    Values in quotes may hold delimiters, line ends and doubled quotes; empty values are null. ``first_only`` stops after the
    first record of each file.

    Archives are read in parallel, each by one task that streams the member through a bounded buffer, from any file
    system that pyarrow opens (local, HDFS, object stores); from others whole files come through Spark's reader. A zip can't
    be split, so big archives are best repacked once into a table.
    """
    scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", path) or re.match(r"([^:]*)", spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///"))
    content = F.lit(None).cast("binary") if scheme.group(1).lower() in STREAMED else F.col("content")
    files = spark.read.format("binaryFile").load(path).select("path", content.alias("content"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        csv.field_size_limit(2**31 - 1)
        for b in batches:
            for name, content in zip(b["path"], b["content"]):
                with _opened(name, content) as opened, zipfile.ZipFile(opened) as z:
                    chosen = max(z.infolist(), key=lambda i: i.file_size).filename if largest else member_of(z.namelist(), member, pattern)
                    with z.open(chosen) as f:
                        records = csv.reader(io.TextIOWrapper(f, encoding=encoding, errors="ignore", newline=""), delimiter=delimiter)
                        for number, some in enumerate(iter(lambda: list(islice(records, 1 if first_only else RECORDS)), [])):
                            yield pd.DataFrame({"file": name, "record_no": range(number * RECORDS, number * RECORDS + len(some)), "fields": [[x or None for x in r] for r in some]})
                            if first_only:
                                break

    return files.mapInPandas(run, "file string, record_no bigint, fields array<string>")


def normal_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def read_zipped_csv(spark: SparkSession, path: str, member: str | None = None, pattern: str | None = None, columns: Sequence[str] | Callable[[str], bool] | None = None, encoding: str = "utf-8") -> DataFrame:
    """Columns of a CSV member with a header, as strings, and ``file``; columns by list or by a test of their names.

    The header is read from the first archive and holds for all; records that lack fields have nulls there.
    """
    first = read_zipped_records(spark, path, member, pattern, encoding=encoding, first_only=True).orderBy("file").first()
    if first is None:
        raise ValueError(f"nothing to read at {path}")
    header = [h or "" for h in first.fields]
    parsed = read_zipped_records(spark, path, member, pattern, encoding=encoding).where((F.col("record_no") > 0) & (F.size("fields") > 0))
    keep = [(i, n) for i, n in enumerate(header) if columns is None or (columns(n) if callable(columns) else n in columns)]
    if columns is not None and not callable(columns) and (missing := set(columns) - set(header)):
        raise ValueError(f"columns not in the file: {sorted(missing)}")
    return parsed.select("file", *[F.get("fields", F.lit(i)).alias(n) for i, n in keep])


# Columns of a title snapshot, by normalised name, and what some are called instead.
TITLE_COLUMNS = ("title_number", "tenure", "district", "county", "region", "price_paid", "property_address", "country_incorporated")
TITLE_ALIASES = {"country_incorporated_1": "country_incorporated", "country_incorporated_(1)": "country_incorporated"}


def read_titles(spark: SparkSession, path: str, keep: Sequence[str] = TITLE_COLUMNS) -> DataFrame:
    """Title snapshots from CSV files or zips: the columns kept, snapshot_date from the file's name; rows without an address are dropped."""
    raw = read_zipped_csv(spark, path, columns=lambda n: TITLE_ALIASES.get(normal_name(n), normal_name(n)) in keep) if path.endswith(".zip") or "*.zip" in path else spark.read.csv(path, header=True, multiLine=True, escape='"').select("*", F.col("_metadata.file_path").alias("file"))
    names = {c: TITLE_ALIASES.get(normal_name(c), normal_name(c)) for c in raw.columns}
    if "property_address" not in names.values():
        raise ValueError("there is no property_address column")
    kept = raw.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items() if n in keep], F.col("file").alias("_file"))
    out = kept.where(F.col("property_address").isNotNull()).withColumn("snapshot_date", snapshot_month(F.col("_file"))).drop("_file")
    return out.withColumn("price_paid", F.expr("try_cast(price_paid AS double)")) if "price_paid" in out.columns else out


# The two layouts of the postcode directory, what their columns become, and the countries kept.
DIRECTORY_LAYOUTS = {
    "before 2025": {"pcds": "postcode2", "oslaua": "lad11cd", "oa11": "oa11cd", "lsoa11": "lsoa11cd", "msoa11": "msoa11cd", "ctry": "ctry"},
    "from 2025": {"pcds": "postcode2", "lad25cd": "lad11cd", "oa11cd": "oa11cd", "lsoa11cd": "lsoa11cd", "msoa11cd": "msoa11cd", "ctry25cd": "ctry"},
}
DIRECTORY_COUNTRIES = ("E92000001", "W92000004")
DIRECTORY_MEMBER = r"^Data/ONSPD.+csv$"


def read_postcodes(spark: SparkSession, path: str, member: str | None = None, layout: dict[str, str] | None = None) -> DataFrame:
    """(postcode2, lad11cd, oa11cd, lsoa11cd, msoa11cd) from a postcode directory archive of either layout, or of ``layout``.

    A layout that fits neither is an error that says what is missing of each.
    """
    raw = read_zipped_csv(spark, path, member, None if member else DIRECTORY_MEMBER, encoding="latin-1")
    have = set(raw.columns)
    if layout is None:
        layout = next((m for m in DIRECTORY_LAYOUTS.values() if set(m) <= have), None)
    if layout is None or not set(layout) <= have:
        misses = "; ".join(f"{name} lacks {sorted(set(m) - have)}" for name, m in (DIRECTORY_LAYOUTS if layout is None else {"given layout": layout}).items())
        raise ValueError(f"unknown postcode directory layout: {misses}; there are {sorted(have - {'file'})}")
    out = raw.select(*[F.col(f"`{c}`").alias(n) for c, n in layout.items()])
    if "ctry" in out.columns:
        out = out.where(F.col("ctry").isin(*DIRECTORY_COUNTRIES)).drop("ctry")
    return out.withColumn("postcode2", compact(F.col("postcode2")))


# Positions of the business register's columns; entries that are no premises; words that end a house's name.
REGISTER_POSITIONS = {4: "primary_and_secondary_description_code", 5: "primary_description_text", 7: "full_property_identifier", 9: "number_or_name", 10: "street", 14: "postcode"}
NO_PREMISES_CODES, NO_PREMISES_TEXT = ("C0", "CP", "CP1", "CX", "MX"), "ADVERTISING"
HOUSE_STOPS = (r"\)", r"\(", r"r\/o", "floor", "floors", "pt", "and", "annexe", "room", "gf", "south", "north", "east", "west", "at", "on", "in", "of", "adjoining", "adj", "basement", "bsmt", "fl", "flr", "flrs", "wing")
ONE_CENTRE = "WESTFIELD SHOPPING CENTRE"
HOUSE_NAME = r"((?<!\S)(?:(?!\b(?:" + "|".join(HOUSE_STOPS) + r")\b)[^\n\d])*? house\b)"


def read_businesses(spark: SparkSession, path: str) -> DataFrame:
    """Raw business register entries from *-separated files without header, or zips of which the largest member counts."""
    if path.endswith(".zip"):
        fields = read_zipped_records(spark, path, largest=True, encoding="latin-1", delimiter="*").where(F.size("fields") > 0)
        return fields.select(*[F.get("fields", F.lit(i)).alias(n) for i, n in REGISTER_POSITIONS.items()])
    raw = spark.read.csv(path, sep="*", header=False, escape='"', encoding="iso-8859-1")
    return raw.select(*[F.nullif(F.col(f"_c{i}").cast("string"), F.lit("")).alias(n) for i, n in REGISTER_POSITIONS.items()])


def businesses_located(raw: DataFrame, lookup: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(kept columns, street_name2, street_number, building_name, area codes) of entries that are premises and whose postcode is known.

    Entries with a null code or description are kept. Numbers in the middle of dashes are no house numbers, nor are
    those of the one named shopping centre (by the full identifier, if there is one).
    """
    code, text = F.col("primary_and_secondary_description_code"), F.col("primary_description_text")
    kept = raw.where(F.coalesce(~code.isin(*NO_PREMISES_CODES), F.lit(True)) & F.coalesce(~text.contains(NO_PREMISES_TEXT), F.lit(True)))
    keyed = kept.withColumns({"postcode2": compact(F.col("postcode")), "street_name2": street_key(F.lower("street"))}).join(lookup, "postcode2")
    number = clean_street_number(F.col("number_or_name"))
    identifier = F.col("full_property_identifier") if "full_property_identifier" in raw.columns else F.lit(None).cast("string")
    number = F.when(~F.coalesce(identifier.contains(ONE_CENTRE), F.lit(False)) & ~F.coalesce(number.rlike(r"-\d+-"), F.lit(False)), number)
    named = F.nullif(F.regexp_extract(F.lower("number_or_name"), HOUSE_NAME, 1), F.lit(""))
    return keyed.select(*keep, "street_name2", number.alias("street_number"), named.alias("building_name"), "oa11cd", "lsoa11cd", "msoa11cd", "lad11cd")


# The sixteen columns of a transaction file, and those kept.
TRANSACTION_COLUMNS = ("transaction_unique_identifier", "price", "date_of_transfer", "postcode", "property_type", "old_new", "duration", "paon", "saon", "street", "locality", "town", "district", "county", "ppd_category_type", "record_status")
TRANSACTION_KEPT = ("transaction_unique_identifier", "price", "date_of_transfer", "postcode", "property_type", "paon", "saon", "street", "locality", "district", "ppd_category_type")


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """Raw transactions from CSV files without header, the kept columns only."""
    schema = ", ".join(f"{c} {'int' if c == 'price' else 'string'}" for c in TRANSACTION_COLUMNS)
    return spark.read.schema(schema).csv(path, quote='"', escape='"').select(*TRANSACTION_KEPT)


def read_labelled_batches(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the ``results`` arrays of JSON batch files, with the batch's file name; order by it and by position."""
    raw = spark.read.json(path, multiLine=True).select(F.col("_metadata.file_name").alias("batch"), F.posexplode("results").alias("position", "r"))
    return raw.select("batch", "position", "r.*")


def read_span_texts(spark: SparkSession, path: str) -> DataFrame:
    """(text, spans) of JSON files that hold lists of such objects."""
    return spark.read.schema("text string, spans array<struct<text:string,start:int,end:int,label:string>>").json(path, multiLine=True)


def annotations_only(df: DataFrame) -> DataFrame:
    """Annotation rows of raw reviewed data, under the names used here."""
    names = {"datapoint_id": "datapoint_id", "input:text": "property_address", "input": "property_address"}
    kept = df.where(F.col("type") == "annotation").drop("type")
    return kept.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in kept.columns])


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Parquet snapshots, one file a month, with snapshot_date from the file's name; one plan over all files."""
    return spark.read.option("mergeSchema", "true").parquet(path).select("*", snapshot_month(F.col("_metadata.file_name")).alias("snapshot_date"))


def with_file_metadata(df: DataFrame, file: str) -> DataFrame:
    """df with filename (without folders and extension) and snapshot_date (from the name, null if it has none) of the files named in a column."""
    name = F.regexp_replace(F.substring_index(file, "/", -1), r"(\.csv|\.parquet|\.zip|\.json|\.gz)+$", "")
    return df.withColumns({"filename": name, "snapshot_date": snapshot_month(F.substring_index(file, "/", -1))})


def read_dwellings(spark: SparkSession, path: str, area: str = "msoa11cd", count: str = "dwellings") -> DataFrame:
    """(<area>, dwellings): counts of dwellings from CSV files with a header, summed by area; counts that aren't numbers and null areas have no part."""
    raw = spark.read.csv(path, header=True).select(F.col(f"`{area}`").alias(area), F.col(f"`{count}`").try_cast("bigint").alias("n"))
    return raw.where(F.col(area).isNotNull() & F.col("n").isNotNull()).groupBy(area).agg(F.sum("n").alias("dwellings"))
