"""What changed between full snapshots of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from deedloom.functions.values import folded


def latest_rows(df: DataFrame, keys: Sequence[str], order: str, carry: Sequence[str]) -> DataFrame:
    """One row a key: that with the greatest ``order`` (null counts least), ties by the carried values.

    A grouped maximum of a struct, not a window: rows are reduced before they are shuffled, so a key that is
    delivered any number of times costs one row a partition.
    """
    best = F.max(F.struct(F.col(order), *[F.col(c) for c in carry])).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in carry])


def snapshot_changes(df: DataFrame, key: str, snapshot: str, fields: Sequence[str], latest_by: str | None = None, normal: dict[str, Column] | None = None) -> DataFrame:
    """Rows added, removed or changed between each pair of neighbouring snapshots.

    Method: a row of snapshot s becomes signed cells, +1 for the pair that ends in s and -1 for the pair that
    begins with s: one cell for the key's presence and one for each field's value. Cells are summed by (pair, key,
    field, value). A sum of +1 (-1) of the presence cell means the key was added (removed); otherwise any nonzero
    sum of a field cell means that field changed.

    Returns (snapshot, <key>, change_kind, changed_fields): dated with the later snapshot; ``changed_fields`` is
    sorted, and empty unless the kind is ``changed``.

    Cases: values are compared as ``normal`` gives them (default: upper case, trimmed, blank as null); null equals
    null and differs from any value. Rows with a null or blank key or a null snapshot belong to no record and are
    left out. Of several rows of a key in a snapshot the greatest ``latest_by`` counts, ties by the greatest
    field values. An empty table, or one with a single snapshot, gives no rows. Other columns, also ones with
    names like those used here, are ignored.
    """
    normal = normal or {}
    names = [f"_f{i}" for i in range(len(fields))]
    at = lambda c: normal.get(c, folded(F.col(c)))
    rows = df.select(
        at(key).alias("_key"), F.col(snapshot).alias("_at"), (F.col(latest_by) if latest_by else F.lit(None).cast("timestamp")).alias("_by"),
        *[at(c).alias(n) for c, n in zip(fields, names)],
    ).where(F.col("_key").isNotNull() & F.col("_at").isNotNull())
    rows = latest_rows(rows, ["_key", "_at"], "_by", names)
    # One row for each date, so the window below sees as many rows as there are snapshots.
    dates = df.select(F.col(snapshot).alias("_at")).where(F.col("_at").isNotNull()).distinct()
    dates = dates.select("_at", F.lead("_at").over(Window.orderBy("_at")).alias("_next"), F.lag("_at").over(Window.orderBy("_at")).alias("_before"))
    # Cells of a key stay in one partition from here on: both sums below use this partitioning.
    rows = rows.join(dates, "_at").repartition("_key")
    sides = F.array(
        F.struct(F.when(F.col("_before").isNotNull(), F.col("_at")).alias("pair"), F.lit(1).alias("sign")),
        F.struct(F.col("_next").alias("pair"), F.lit(-1).alias("sign")),
    )
    cells = F.array(
        F.struct(F.lit(-1).alias("field"), F.lit(None).cast("string").alias("value")),
        *[F.struct(F.lit(i).alias("field"), F.col(n).cast("string").alias("value")) for i, n in enumerate(names)],
    )
    signed = (
        rows.select("_key", F.explode(sides).alias("_side"), cells.alias("_cells")).where(F.col("_side.pair").isNotNull())
        .select("_key", F.col("_side.pair").alias("_pair"), F.col("_side.sign").alias("_sign"), F.explode("_cells").alias("_cell"))
    )
    sums = signed.groupBy("_key", "_pair", "_cell").agg(F.sum("_sign").alias("_sum")).where(F.col("_sum") != 0)
    presence = F.max(F.when(F.col("_cell.field") < 0, F.col("_sum")))
    touched = F.array_sort(F.collect_set(F.when(F.col("_cell.field") >= 0, F.element_at(F.array(*map(F.lit, fields)), F.col("_cell.field") + 1))))
    return sums.groupBy("_key", "_pair").agg(presence.alias("_presence"), touched.alias("_touched")).select(
        F.col("_pair").alias("snapshot"), F.col("_key").alias(key),
        F.when(F.col("_presence") > 0, "added").when(F.col("_presence") < 0, "removed").otherwise("changed").alias("change_kind"),
        F.when(F.col("_presence").isNull(), F.col("_touched")).otherwise(F.array().cast("array<string>")).alias("changed_fields"),
    )
