"""Partitioned tables, incremental by partition, and files for other tools."""

from __future__ import annotations

import csv
import io
import os
import re
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedloom.plans.sizes import at_most


def existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at a path, or None if nothing is there. What is there and can't be read is an error, so that nobody writes over it."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def write_partitioned(df: DataFrame, path: str, *by: str) -> None:
    """Write by partition; partitions that df has replace those there, others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def new_partitions(df: DataFrame, path: str, by: str) -> DataFrame:
    """Rows of df whose partition isn't in the table yet; all of them if there is no table."""
    done = existing(df.sparkSession, path)
    return df if done is None else df.join(done.select(F.col(by)).distinct(), by, "left_anti")


def write_new_partitions(df: DataFrame, path: str, by: str) -> None:
    """Write only partitions that aren't there yet (work once done is skipped)."""
    new_partitions(df, path, by).write.mode("append").partitionBy(by).parquet(path)


def write_by_year(df: DataFrame, path: str, date: str = "date_of_transfer") -> None:
    """Write rows with a date by its year."""
    write_partitioned(df.where(F.col(date).isNotNull()).withColumn("year", F.year(date)), path, "year")


def ensure_table(spark: SparkSession, path: str, make) -> DataFrame:  # noqa: ANN001
    """The table at a path, made and written first if there is none."""
    found = existing(spark, path)
    if found is None:
        make().write.mode("overwrite").parquet(path)
        found = spark.read.parquet(path)
    return found


def span_documents(df: DataFrame, group: str = "datapoint_id") -> DataFrame:
    """(text, spans): one row a datapoint, its spans (text, start, end, label) by start and end, as other labelling tools read them."""
    span = F.struct("start", "end", F.trim("text").alias("text"), "label")
    rows = df.groupBy(group).agg(F.min("property_address").alias("_address"), F.array_sort(F.collect_list(span)).alias("_spans"))
    return rows.select(F.col("_address").alias("text"), F.transform("_spans", lambda s: F.struct(s["text"].alias("text"), s["start"].alias("start"), s["end"].alias("end"), s["label"].alias("label"))).alias("spans"))


def write_span_documents(df: DataFrame, path: str) -> None:
    span_documents(df).write.mode("overwrite").json(path)


#: Rows up to which a table is written as one file.
ONE_FILE_ROWS = 1_000_000


def write_metrics(df: DataFrame, path: str) -> None:
    """A small table as one CSV file with a header; a larger one than ONE_FILE_ROWS as several."""
    (df.coalesce(1) if at_most(df, ONE_FILE_ROWS) else df).write.mode("overwrite").csv(path, header=True)


def write_zipped_csv(df: DataFrame, path: str, member: str = "data.csv", name: str = "part", delimiter: str = ",", header: bool = True) -> int:
    """Write a table as zip archives with one delimited member each, <path>/<name>-<partition>.zip; gives their number.

    Values are written as strings, null as nothing. Each partition is written by its task, so parts should fit in memory
    when packed; a task that runs again writes the same archive again. Empty partitions have none.
    """
    columns = df.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packed, rows = io.BytesIO(), 0
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z, z.open(member, "w") as f:
            text = io.TextIOWrapper(f, encoding="utf-8", newline="")
            to = csv.writer(text, delimiter=delimiter)
            if header:
                to.writerow(columns)
            for b in batches:
                to.writerows([["" if v is None else v for v in row] for row in b.itertuples(index=False, name=None)])
                rows += len(b)
            text.flush()
            text.detach()
        file = f"{name}-{TaskContext.get().partitionId()}.zip"
        if rows and re.match(r"file:|[^:]*$", path):
            folder = re.sub(r"^file:/*", "/", path)
            os.makedirs(folder, exist_ok=True)
            with open(os.path.join(folder, file), "wb") as out:
                out.write(packed.getvalue())
        elif rows:
            system, folder = pafs.FileSystem.from_uri(path)
            system.create_dir(folder)
            with system.open_output_stream(f"{folder}/{file}") as out:
                out.write(packed.getvalue())
        yield pd.DataFrame({"n": [int(rows > 0)]})

    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns]).mapInPandas(run, "n int").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n


def published_gazetteer(df: DataFrame) -> DataFrame:
    """A building gazetteer as it is published: every fraction is 1."""
    return df.withColumn("fraction", F.lit(1.0))


def with_literal_columns(df: DataFrame, **values: str) -> DataFrame:
    """df with columns of one value each."""
    return df.withColumns({c: F.lit(v) for c, v in values.items()})
