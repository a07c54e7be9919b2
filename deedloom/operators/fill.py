"""Filling missing values from records of the same group, with back-off to coarser groups."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deedloom.functions.values import present
from deedloom.plans.session import cut
from deedloom.plans.sizes import hot_keys, salted_left_join


@dataclass(frozen=True)
class Level:
    """A way of grouping: ``key`` (a string Column) is null for rows that have no group at this level."""

    name: str
    key: Column
    min_support: int = 1


@dataclass(frozen=True)
class Gap:
    """A field to fill, its levels from fine to coarse, and its value as read (null where missing)."""

    name: str
    levels: Sequence[Level]
    value: Column | None = field(default=None)


def _modes(votes: DataFrame) -> DataFrame:
    """Votes (key, value) to (key, fill, support); a key whose most frequent values tie has no row."""
    counted = votes.groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy("key").agg(F.max(F.struct("n", "value")).alias("a"), F.min(F.struct((-F.col("n")).alias("n"), F.col("value"))).alias("b"), F.sum("n").alias("support"))
    # Among the most frequent values, a is the greatest and b the least: with a tie they differ.
    return best.where(F.col("a.value") == F.col("b.value")).select("key", F.col("a.value").alias("fill"), "support")


def _medians(votes: DataFrame) -> DataFrame:
    """Votes (key, value) to (key, fill, support): the lower median, from a running sum over counted values."""
    counted = votes.where(~F.isnan("value")).groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))
    by_value = Window.partitionBy("key").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    run = counted.withColumn("run", F.sum("n").over(by_value)).withColumn("support", F.sum("n").over(Window.partitionBy("key")))
    return run.where((F.col("run") * 2 >= F.col("support")) & ((F.col("run") - F.col("n")) * 2 < F.col("support"))).select("key", F.col("value").alias("fill"), "support")


def missing_fills(df: DataFrame, gaps: Sequence[Gap], row_id: str, how: str = "mode") -> DataFrame:
    """(row_id, field_name, fill_value, fill_level) for each missing value that a level has an answer for.

    Method: every row votes, in each field and level, for its value in its group. A level answers with the group's
    mode (``how="mode"``; with a tie it has none) or lower median (``how="median"``, numbers) if the group has at
    least ``min_support`` votes; the finest level that answers gives the fill.

    Cases: a value is missing if it is null, blank or a word or mark that stands for no value (``Gap.value`` gives
    another reading); missing values and rows without a group have no vote. Each row has one vote, so pass one row
    a record. Values without an answer have no row in the result; an empty table gives none. Columns of any other
    names may be there.

    Scale: one pass over all fields and levels. Votes are combined before the shuffle, so a group of any size costs
    as many rows as it has values. Only missing values are joined to the answers, and those of groups that hold
    more than 1/256 of them are spread over tasks.
    """
    if how not in ("mode", "median"):
        raise ValueError("how is 'mode' or 'median'")
    kind = "string" if how == "mode" else "double"
    cells = []
    for g in gaps:
        value = (g.value if g.value is not None else present(F.col(g.name)) if how == "mode" else F.col(g.name)).cast(kind)
        for i, level in enumerate(g.levels):
            # The field and level are part of the key: one aggregation serves all.
            key = F.when(level.key.isNotNull(), F.concat(F.lit(f"{g.name}\t{i}\t"), level.key.cast("string")))
            cells.append(F.struct(F.lit(g.name).alias("field_name"), F.lit(i).alias("rank"), F.lit(level.name).alias("fill_level"), F.lit(level.min_support).alias("least"), key.alias("key"), value.alias("value")))
    rows = df.select(F.col(row_id).alias("row_id"), F.explode(F.array(*cells)).alias("c")).select("row_id", "c.*").where(F.col("key").isNotNull())
    answers = (_modes if how == "mode" else _medians)(rows.where(F.col("value").isNotNull()).select("key", "value"))
    # The gaps are few and are read four times below (hot keys on both sides of the join), so they are written down once.
    asked = cut(rows.where(F.col("value").isNull()).drop("value"))
    got = salted_left_join(asked, answers, "key", F.col("row_id"), hot_keys(asked.select("key"), "key")).where(F.col("support") >= F.col("least"))
    if all(len(g.levels) == 1 for g in gaps):
        return got.select("row_id", "field_name", F.col("fill").alias("fill_value"), "fill_level")
    best = F.min_by(F.struct("fill", "fill_level"), "rank").alias("best")
    return got.groupBy("row_id", "field_name").agg(best).select("row_id", "field_name", F.col("best.fill").alias("fill_value"), F.col("best.fill_level").alias("fill_level"))


def fill_missing(df: DataFrame, gap: Gap, row_id: str, how: str = "mode") -> DataFrame:
    """df with <name>_filled (the value or its fill), <name>_is_filled and <name>_fill_level (null if not filled).

    As missing_fills, for one field; the added columns replace existing ones of their names. A value that no level
    can fill stays null with is_filled false.
    """
    kind = "string" if how == "mode" else "double"
    value = (gap.value if gap.value is not None else present(F.col(gap.name)) if how == "mode" else F.col(gap.name)).cast(kind)
    added = [f"{gap.name}_filled", f"{gap.name}_is_filled", f"{gap.name}_fill_level"]
    kept = [c for c in df.columns if c not in added]
    # A struct keeps the caller's columns apart from ours, whatever their names.
    whole = df.select(F.col(row_id).alias("id"), value.alias("value"), F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"))
    out = whole.join(missing_fills(df, [gap], row_id, how), F.col("id") == F.col("row_id"), "left")
    return out.select(
        "row.*", F.coalesce("value", "fill_value").alias(added[0]), (F.col("value").isNull() & F.col("fill_value").isNotNull()).alias(added[1]), F.when(F.col("value").isNull(), F.col("fill_level")).alias(added[2]),
    )
