"""Row numbers and running values within groups of any size.

A window sorts a group in one task. Groups that hold more than HOT_SHARE of the rows are therefore cut into buckets at
quantiles of the order, worked on bucket by bucket, and put together by what each bucket hands on: its size, or its last
values. There are at most 1 / HOT_SHARE hot groups of about BUCKETS buckets, so what is handed on is bounded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deedloom.plans.session import cut
from deedloom.plans.sizes import HOT_SHARE

BUCKETS = 64
#: Rows of a hot group, about, from which its quantiles are taken.
SAMPLE = 64 * BUCKETS


def with_buckets(df: DataFrame, key: str, order: Sequence[Column], share: float = HOT_SHARE) -> tuple[DataFrame, DataFrame]:
    """(df with _order and _bucket, bounds): bucket 0 but for rows of hot groups, whose buckets follow the order.

    The bounds come from rows chosen by hash, about SAMPLE a group, and are written down once: whatever they are, rows
    are put in order by them, and a lost executor finds the same ones again.
    """
    ordered = df.withColumn("_order", F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]))
    keyed = ordered.where(F.col(key).isNotNull())
    counts = keyed.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    hot = cut(counts.join(F.broadcast(total), F.col("_n") > F.greatest(F.col("_total") * share, F.lit(SAMPLE))).select("_key", "_n"))
    if hot.isEmpty():
        return ordered.withColumn("_bucket", F.lit(0)), hot
    chosen = keyed.join(F.broadcast(hot), F.col(key) == F.col("_key")).where(F.pmod(F.xxhash64("_order"), F.ceil(F.col("_n") / SAMPLE).cast("long")) == 0)
    placed = chosen.select("_key", "_order").distinct().withColumn("_p", F.ntile(BUCKETS).over(Window.partitionBy("_key").orderBy("_order")))
    cuts = placed.groupBy("_key", "_p").agg(F.max("_order").alias("_last")).where(F.col("_p") < BUCKETS)
    bounds = cut(cuts.groupBy("_key").agg(F.array_sort(F.collect_list("_last")).alias("_bounds")))
    joined = ordered.join(F.broadcast(bounds), F.col(key) == F.col("_key"), "left").drop("_key")
    return joined.withColumn("_bucket", F.coalesce(F.size(F.filter("_bounds", lambda b: b < F.col("_order"))), F.lit(0))).withColumn("_bucket", F.greatest("_bucket", F.lit(0))).drop("_bounds"), bounds


def _joined_by_bucket(df: DataFrame, handed: DataFrame, key: str) -> DataFrame:
    """handed has _key, _bucket and what is handed on, for hot groups only."""
    return df.join(F.broadcast(handed.withColumnRenamed("_bucket", "_at")), (F.col(key) == F.col("_key")) & (F.col("_bucket") == F.col("_at")), "left").drop("_key", "_at")


def numbered(df: DataFrame, key: str, order: Sequence[Column], number: str, several: str | None = None, share: float = HOT_SHARE) -> DataFrame:
    """df with the position of each row in its group by ``order`` (ascending, null first), from 1, and whether the group has several rows."""
    placed, bounds = with_buckets(df, key, order, share)
    within = Window.partitionBy(key, "_bucket")
    out = placed.withColumn(number, F.row_number().over(within.orderBy("_order")))
    if several:
        out = out.withColumn(several, F.count(F.lit(1)).over(within) > 1)
    if "_bounds" in bounds.columns:
        sizes = placed.join(F.broadcast(bounds.select("_key")), F.col(key) == F.col("_key")).groupBy("_key", "_bucket").agg(F.count(F.lit(1)).alias("_size"))
        before = sizes.withColumn("_before", F.sum("_size").over(Window.partitionBy("_key").orderBy("_bucket")) - F.col("_size")).drop("_size")
        out = _joined_by_bucket(out, before, key).withColumn(number, (F.col(number) + F.coalesce("_before", F.lit(0))).cast("int"))
        if several:
            out = out.withColumn(several, F.col(several) | F.col("_before").isNotNull())
        out = out.drop("_before")
    return out.drop("_order", "_bucket")


def filled_forward(df: DataFrame, key: str, order: Sequence[Column], columns: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """df with nulls of the columns replaced by the value of the nearest row before in the group that has one."""
    placed, bounds = with_buckets(df, key, order, share)
    before = Window.partitionBy(key, "_bucket").orderBy("_order").rowsBetween(Window.unboundedPreceding, 0)
    if "_bounds" not in bounds.columns:
        return placed.withColumns({c: F.last(c, ignorenulls=True).over(before) for c in columns}).drop("_order", "_bucket")
    lasts = placed.join(F.broadcast(bounds.select("_key")), F.col(key) == F.col("_key")).groupBy("_key", "_bucket").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_order"))).alias(f"_l_{c}") for c in columns])
    earlier = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    handed = lasts.select("_key", "_bucket", *[F.last(f"_l_{c}", ignorenulls=True).over(earlier).alias(f"_l_{c}") for c in columns])
    out = _joined_by_bucket(placed, handed, key)
    return out.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(before), F.col(f"_l_{c}")) for c in columns}).drop("_order", "_bucket", *[f"_l_{c}" for c in columns])
