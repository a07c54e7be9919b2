"""Broadcasts behind a check of the size, and joins that spread hot keys."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows up to which a side may be broadcast, unless the caller says otherwise.
BROADCAST_ROWS = 200_000
#: A key is hot if it holds more than this share of the rows, so there are at most 1 / HOT_SHARE hot keys.
HOT_SHARE = 1 / 256
#: Number of pieces into which a hot key's rows are cut.
SALTS = 64
#: Rows that one row is repeated to at a time.
PIECE = 65_536


def at_most(df: DataFrame, rows: int) -> bool:
    """True if df has at most so many rows; reads no more than rows + 1 of them."""
    return df.limit(rows + 1).count() <= rows


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most so many rows, else df as it is (a shuffle join follows)."""
    return F.broadcast(df) if at_most(df, rows) else df


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """Keys with more than this share of the rows: at most 1 / share of them, whatever the input.

    Null is no key. Counts are combined before the shuffle, so a hot key costs one row a partition.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    return counts.join(F.broadcast(total), F.col("_n") > F.col("_total") * share).select(key)


def salted_left_join(left: DataFrame, right: DataFrame, key: str, spread_by: Column, hot: DataFrame, salts: int = SALTS) -> DataFrame:
    """left LEFT JOIN right on key, where right has few rows a key and left may have any number.

    Rows of hot keys are spread over ``salts`` tasks by ``spread_by``; right's rows of such a key are repeated
    that often. Null keys match nothing and are spread too. ``hot`` must be bounded, as that of hot_keys is.
    """
    mark = F.broadcast(hot.select(F.col(key).alias("_hot")))
    salt = F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
    spread = left.join(mark, F.col(key) == F.col("_hot"), "left").withColumn("_salt", F.when(F.col("_hot").isNotNull() | F.col(key).isNull(), salt).otherwise(F.lit(0))).drop("_hot")
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    copies = right.join(mark, F.col(key) == F.col("_hot"), "left").withColumn("_salt", F.explode(F.when(F.col("_hot").isNotNull(), every).otherwise(F.array(F.lit(0))))).drop("_hot")
    return spread.join(copies, [key, "_salt"], "left").drop("_salt")


def nulls_apart(key: Column, spread_by: Column, pieces: int = 4096) -> Column:
    """The key or, for null, one of ``pieces`` texts that no key equals: a left join then finds nothing for these rows, and no task gets them all."""
    return F.coalesce(key, F.concat(F.lit("\u0001"), F.pmod(F.xxhash64(spread_by), F.lit(pieces)).cast("string")))


def repeated(df: DataFrame, times: Column, at: str) -> DataFrame:
    """df with each row as often as ``times`` says (null as 0), ``at`` counting from 0; done piece by piece, so no array is large whatever the number.

    Generated code puts all that an input row gives into a buffer before it hands on the first row. The pieces are therefore
    opened by an expression that isn't compiled (a transform): rows then come one at a time.
    """
    last = F.col("_times") - 1
    counted = df.withColumn("_times", times.cast("bigint")).where(F.col("_times") > 0)
    pieces = counted.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), last, F.lit(PIECE).cast("bigint"))).alias("_from"))
    size = F.least(F.lit(PIECE - 1).cast("bigint"), last - F.col("_from"))
    return pieces.select("*", F.explode(F.transform(F.sequence(F.lit(0).cast("bigint"), size, F.lit(1).cast("bigint")), lambda j: j + F.col("_from"))).alias(at)).drop("_times", "_from")


#: Operators of a plan behind which the number of parts isn't known without running it.
_SHUFFLING = ("Aggregate", "Join", "Window", "WindowGroupLimit", "Sort", "Repartition", "RepartitionByExpression", "RebalancePartitions", "Distinct", "Deduplicate", "Intersect", "Except", "GlobalLimit", "Tail")


def _operators(plan) -> Iterator[str]:  # noqa: ANN001
    """Names of the operators of a JVM plan, from the top down."""
    yield plan.nodeName()
    children = plan.children()
    for i in range(children.size()):
        yield from _operators(children.apply(i))


def spread(df: DataFrame) -> DataFrame:
    """df over all cores, for work that costs far more than moving the rows: a table of fewer parts than cores is dealt out anew.

    Tables that are read in more parts than there are cores stay where they are, without a shuffle. So does what comes out
    of one: to ask for its parts would be to run it.
    """
    if any(name in _SHUFFLING for name in _operators(df._jdf.queryExecution().optimizedPlan())):
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
