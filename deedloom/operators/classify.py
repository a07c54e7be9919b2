"""First-match classification by ordered rules, and what follows from it within a title."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deedloom.operators.expand import RANGE
from deedloom.plans.sizes import hot_keys, salted_left_join

# Patterns of the default rules; all but the range are used without regard to case.
LAND_FIRST = r"^(?:land|plot)"
CARPARK = r"^(?:[a-z\s]*)(?:garage|parking(?:\s)?space|parking space|car park(?:ing)?)"
AIRSPACE = r"^(?:the airspace|airspace|air space)"
DWELLING = r"penthouse|flat|apartment"
BUSINESS_WORDS = (
    r"cinema|hotel|office|centre|\bpub|holiday(?:\s)?inn|travel lodge|travelodge|medical|business|cafe|^shop| shop|service|logistics|building supplies|restaurant|home|suite|"
    r"^store(?:s|rooms?)\b|^storage\b|company|ltd|limited|plc|retail|leisure|industrial|hall of|trading|commercial|technology|works|club,|advertising|school|church|(?:^room)|vault"
)
LAND_LATER = r"^[a-z\s']+\b(?:land(?:s)?|plot(?:s)?)\b"
PUB_NAME = r"\binn$|public house|^the\s\w+\sand\s\w+|(?:tavern$)|^the\s+(?:red|white|black|blue|green|golden|silver|old|royal)\s+\w+$"
PART_FIRST = r"^(?:part|parts)\b"
UNIT_WORD = r"\b(?:unit|units)\b"

UNKNOWN, NO_RULE = "unknown", "none"


@dataclass(frozen=True)
class Rule:
    """A named predicate and the class it gives. The predicate is a Column, or makes one from the DataFrame."""

    name: str
    when: Column | Callable[[DataFrame], Column]
    value: str
    comment: str = ""


def default_rules() -> list[Rule]:
    """The fifteen rules for property titles, in order."""
    says = lambda c, pattern: F.col(c).rlike(f"(?i){pattern}")
    address = lambda pattern: says("property_address", pattern)
    return [
        Rule("Land plots at start of address", lambda _: address(LAND_FIRST), "land"),
        Rule("Parking and garage spaces", lambda _: address(CARPARK), "carpark"),
        Rule("Airspace properties", lambda _: address(AIRSPACE), "airspace"),
        Rule("Penthouse/Flat/Apartment", lambda _: address(DWELLING), "residential"),
        Rule("Business properties by address keywords", lambda _: address(BUSINESS_WORDS), "business"),
        Rule("Land with words before it", lambda _: address(LAND_LATER), "land"),
        Rule("Pubs by building name", lambda _: says("building_name", PUB_NAME), "business"),
        Rule("Named building crossing multiple addresses", lambda _: F.col("building_name").isNotNull() & F.col("street_number").rlike(RANGE) & F.col("unit_id").isNull(), "business"),
        Rule("Addresses starting with part/parts", lambda _: address(PART_FIRST), "business"),
        Rule("Units without building name", lambda _: address(UNIT_WORD) & F.col("building_name").isNull(), "business"),
        Rule("Building match indicator", lambda _: F.col("building_match"), "business"),
        Rule("Number match indicator", lambda _: F.col("number_match"), "business"),
        Rule("No street match", lambda _: ~F.col("street_match"), "residential"),
        Rule("oa match", lambda _: ~F.col("oa_match"), "residential"),
        Rule("lsoa match", lambda _: ~F.col("lsoa_match"), "residential"),
    ]


def classify(df: DataFrame, rules: Sequence[Rule], keep_rule: bool = True) -> DataFrame:
    """Adds class, and matched_rule if asked for: those of the first rule whose predicate is true, else unknown and none.

    A null predicate is no match. A rule that can't be applied (its column is missing, or it raises) is warned of and
    skipped. Rule names must differ if they are kept. All rules are one CASE, so the table is read once.
    """
    names = [r.name for r in rules]
    if keep_rule and len(set(names)) < len(names):
        raise ValueError("rule names must differ")
    usable = []
    for rule in rules:
        try:
            made = rule.when(df) if callable(rule.when) else rule.when
            df.select(made.cast("boolean").alias("_")).schema  # noqa: B018
            usable.append((rule, made))
        except (AnalysisException, KeyError, AttributeError, TypeError, ValueError) as e:
            warnings.warn(f"Rule '{rule.name}' failed: {str(e).splitlines()[0][:200]}", stacklevel=2)
    value, name = None, None
    for rule, made in usable:
        value = F.when(made, rule.value) if value is None else value.when(made, rule.value)
        name = F.when(made, rule.name) if name is None else name.when(made, rule.name)
    out = df.withColumn("class", F.lit(UNKNOWN) if value is None else value.otherwise(UNKNOWN))
    return out.withColumn("matched_rule", F.lit(NO_RULE) if name is None else name.otherwise(NO_RULE)) if keep_rule else out


def fill_unknown_classes(df: DataFrame, group: str = "title_number", class_col: str = "class", unknown: str = UNKNOWN, excluded: Sequence[str] = (UNKNOWN, "airspace", "carpark"), where: str = "is_multi") -> DataFrame:
    """df in which unknown rows take the classes that known rows of their group have; adds was_filled.

    Only rows with ``where`` true take part. A group with several known classes gives its unknown rows once for each;
    rows of groups without any stay. Other columns don't change. A null class is not known and not unknown.

    The known classes of a group are few whatever its size, and are made distinct before the join, in which the rows of
    groups that ask much are spread over tasks.
    """
    part = F.coalesce(F.col(where), F.lit(False))
    known = df.where(part & F.col(class_col).isNotNull() & ~F.col(class_col).isin(*excluded)).select(F.col(group).alias("_group"), F.col(class_col).alias("_class")).distinct()
    asks = part & (F.col(class_col) == unknown)
    asking = df.where(asks).withColumn("_group", F.col(group))
    filled = salted_left_join(asking, known, "_group", F.struct(*[F.col(f"`{c}`") for c in df.columns]), hot_keys(asking.select("_group"), "_group"))
    filled = filled.withColumn("was_filled", F.col("_class").isNotNull()).withColumn(class_col, F.coalesce("_class", class_col)).drop("_group", "_class")
    return filled.unionByName(df.where(~F.coalesce(asks, F.lit(False))).withColumn("was_filled", F.lit(False)))


def drop_repeated_classes(df: DataFrame, order: list[str | Column], class_col: str = "class", title: str = "title_number") -> DataFrame:
    """All residential rows, and of the others the first of each title and class by ``order`` (ascending).

    A grouped minimum, combined before the shuffle: a title of any size costs one row a class and partition. Residential
    rows aren't shuffled at all.
    """
    home = F.coalesce(F.col(class_col) == "residential", F.lit(False))
    key = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    rows = df.where(~home).select(F.col(title).alias("_title"), F.col(class_col).alias("_class"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), key.alias("_key"))
    first = rows.groupBy("_title", "_class").agg(F.min_by("_row", "_key").alias("_row")).select("_row.*")
    return df.where(home).unionByName(first)


def class_by_number(df: DataFrame, class_col: str = "class", unknown: str = UNKNOWN) -> DataFrame:
    """df in which unknown rows with a street number are residential."""
    return df.withColumn(class_col, F.when((F.col(class_col) == unknown) & F.col("street_number").isNotNull(), "residential").otherwise(F.col(class_col)))


def relabelled(df: DataFrame, column: str, names: dict[str, str]) -> DataFrame:
    """df with values of a column renamed; others and null stay."""
    return df.replace(names, subset=[column])
