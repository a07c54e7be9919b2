"""Expansion of number ranges to one row a number, and numbering of a title's rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deedloom.functions.values import let
from deedloom.plans.ordered import numbered
from deedloom.plans.sizes import repeated

# Fixed value: a range of numbers.
RANGE = r"\d+[a-z]?\s?(?:to|-|/)\s?\d+[a-z]?\b"
#: An expansion of more rows than this is flagged.
LARGE = 100


def number_range(c: Column, which: Column) -> Column:
    """STRUCT<first, step, n>: the numbers from the least to the greatest in the text, only the odd or even ones if ``which`` says exactly so; null if it holds none.

    Numbers that don't fit an integer are left out. The range is never written out here, however wide it is.
    """
    found = F.array_compact(F.transform(F.regexp_extract_all(c, F.lit(r"(\d+)"), F.lit(1)), lambda x: x.try_cast("int").cast("bigint")))

    def ranged(ns: Column) -> Column:
        lo, hi = F.array_min(ns), F.array_max(ns)
        halved = F.coalesce(which.isin("odd", "even"), F.lit(False))
        first = F.when(halved & ((lo % 2 == 0) == (which == "odd")), lo + 1).otherwise(lo)
        step = F.when(halved, 2).otherwise(1).cast("bigint")
        n = F.when(first > hi, F.lit(0).cast("bigint")).otherwise(F.call_function("div", hi - first, step) + 1)
        return F.when(F.size(ns) > 0, F.struct(first.alias("first"), step.alias("step"), n.alias("n")))

    return let(found, ranged)


def _size(n: Column) -> Column:
    """A number of rows as an integer; the one range that has a number more than integers go stays at the last of them."""
    return F.least(n, F.lit(2**31 - 1)).cast("int")


def needs_expansion(df: DataFrame, class_col: str = "class") -> DataFrame:
    """Rows that stand for several homes: residential, with a range in the unit or, without a unit, in the number."""
    ranged = lambda c: F.coalesce(F.col(c).rlike(RANGE), F.lit(False))
    return df.where((F.col(class_col) == "residential") & (ranged("unit_id") | (F.col("unit_id").isNull() & ranged("street_number"))))


def expand_column(df: DataFrame, column: str, min_count: int = 1, large: int = LARGE) -> DataFrame:
    """One row for each number of the range in ``column``, which then holds the number; adds expansion_size and large_expansion.

    number_filter (odd, even, else all; null is all) selects the numbers. A row with no more than ``min_count`` numbers
    stays as it is; its size says how many there were, 0 also for a text without any. Ranges of any width come out whole,
    piece by piece. An empty table stays empty.
    """
    added = ["expansion_size", "large_expansion"]
    sized = df.drop(*added).withColumn("_range", number_range(F.col(column), F.col("number_filter"))).withColumn("_n", F.coalesce("_range.n", F.lit(0).cast("bigint")))
    rows = repeated(sized, F.when(F.col("_n") > min_count, F.col("_n")).otherwise(1), "_at")
    value = F.when(F.col("_n") > min_count, (F.col("_range.first") + F.col("_range.step") * F.col("_at")).cast("string")).otherwise(F.col(column))
    return rows.withColumns({column: value, "expansion_size": _size(F.col("_n")), "large_expansion": F.col("_n") > large}).drop("_range", "_n", "_at")


def expand_numbers(df: DataFrame, class_col: str = "class", large: int = LARGE) -> DataFrame:
    """df with each row that needs it expanded, by unit if the unit is a range, else by number; other rows have size 1.

    Adds expansion_size, large_expansion, expand_block (0 not expanded, 1 by unit, 2 by number) and expanded_n (position
    in the expansion, from 0). One pass: no row is read twice, and ranges of any width come out whole, piece by piece.
    """
    ranged = lambda c: F.coalesce(F.col(c).rlike(RANGE), F.lit(False))
    home = F.coalesce(F.col(class_col) == "residential", F.lit(False))
    block = F.when(home & ranged("unit_id"), 1).when(home & F.col("unit_id").isNull() & ranged("street_number"), 2).otherwise(0)
    text = F.when(F.col("expand_block") == 1, F.col("unit_id")).when(F.col("expand_block") == 2, F.col("street_number"))
    out = df.withColumn("expand_block", block).withColumn("_range", number_range(text, F.col("number_filter")))
    out = out.withColumn("_n", F.when(F.col("expand_block") == 0, F.lit(1).cast("bigint")).otherwise(F.coalesce("_range.n", F.lit(0).cast("bigint"))))
    out = out.withColumns({"expansion_size": _size(F.col("_n")), "large_expansion": F.col("_n") > large, "_several": (F.col("expand_block") > 0) & (F.col("_n") > 1)})
    out = repeated(out, F.when(F.col("_several"), F.col("_n")).otherwise(1), "_at")
    value = (F.col("_range.first") + F.col("_range.step") * F.col("_at")).cast("string")
    put = lambda c, b: F.when(F.col("_several") & (F.col("expand_block") == b), value).otherwise(F.col(c))
    return out.withColumns({"unit_id": put("unit_id", 1), "street_number": put("street_number", 2), "expanded_n": _size(F.col("_at"))}).drop("_range", "_n", "_several", "_at")


def unique_ids(df: DataFrame, order: list[str | Column], title: str = "title_number") -> DataFrame:
    """Adds multi_id (position in the title by ``order``, ascending, from 1), unique_id (title-position) and is_multi (more than one row).

    A title that holds a good part of all rows is numbered in pieces (see plans/ordered).
    """
    columns = [F.col(o) if isinstance(o, str) else o for o in order]
    return numbered(df, title, columns, "multi_id", "is_multi").withColumn("unique_id", F.concat_ws("-", title, F.col("multi_id").cast("string")))
