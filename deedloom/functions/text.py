"""Normalisation of register texts, as Columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rewrites that put blanks between tokens, in order; (?U) lets \s and \S know all blanks.
TOKEN_SPACING = (
    (r"(?<=[0-9])([+\-\,*^\(\)])(?=[0-9-])", r" $1 "),
    (r"(?<=[a-z\"'])\.(?=[a-zA-Z\"'])", r". "),
    (r"(?<=[a-zA-Z]),(?=[a-zA-Z])", r", "),
    (r"(?<=[a-zA-Z])[-–—](?=[a-zA-Z])", r" - "),
    (r"(?<=[a-zA-Z0-9])([:<>=/\(\)])(?=[a-zA-Z])", r" $1 "),
    (r"(?<=[a-zA-Z])([:<>=/\(\)])(?=[a-zA-Z0-9])", r" $1 "),
    (r"(?U)(\))(\d)", r"$1 $2"),
    (r"(?U)(\d)(\()", r"$1 $2"),
    (r"(?U)([,;:])(?=\S)", r"$1 "),
    (r"(?U)(\d+)\s*-\s*(\d+)", r"$1-$2"),
    (r"(?U)\s+", " "),
)
# Words for dwellings in a building, and for parks of businesses.
FLAT_WORDS = r"(?i)\b(?:apartment|flat|penthouse|unit)s?\b"
PARK_WORDS = (
    r"(?i)\b(?:business\s+park|industrial\s+park|commercial\s+park|office\s+park|technology\s+park|science\s+park|enterprise\s+park|trading\s+estate|"
    r"business\s+estate|industrial\s+estate|retail\s+park|tech\s+park|innovation\s+park|corporate\s+park)s?\b"
)


def stripped(c: Column) -> Column:
    """Without blanks of any kind at the ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def token_spacing(c: Column) -> Column:
    """Blanks around operators and punctuation, so that tokens stand apart; null stays null; idempotent on its results."""
    for pattern, by in TOKEN_SPACING:
        c = F.regexp_replace(c, pattern, by)
    return stripped(c)


def clean_street_number(c: Column) -> Column:
    """The house number at the end of a number-or-name text; null for units, suites and rooms, and if none is there."""
    x = F.regexp_replace(c, r"\(.+\)", "")
    x = F.regexp_replace(F.regexp_replace(F.regexp_replace(x, r"\+", " "), "@", " at "), "&", " and ")
    x = F.regexp_replace(x, r"\s*-\s*", "-")
    x = F.when(~x.rlike(r"(?i)unit|suite|room"), F.nullif(F.regexp_extract(x, r"([^\s]+)$", 1), F.lit("")))
    x = F.regexp_replace(F.regexp_replace(x, r"[a-zA-Z]", ""), r"^-+|-+$", "")
    x = stripped(F.regexp_replace(F.regexp_replace(x, r"[\\/]", " "), r"-{2,}", "-"))
    return F.when(~x.isin("", "-"), x)


def street_key(c: Column) -> Column:
    """Join key of a street: no apostrophes, no s before a blank, no blanks. Case is left, so lower it first or after."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "'", ""), r"s(s)?(?=\s)", ""), r"\s", "")


def last_number(c: Column) -> Column:
    """Digits of the number that ends the text, else all its digits."""
    return F.regexp_replace(F.regexp_replace(c, r"^.*(?=\b[0-9]+$)", ""), r"[^0-9]", "")


def joined_address(*parts: Column) -> Column:
    """Parts joined by commas, blank parts kept; a leading comma goes, and two in a row become one (one pass)."""
    text = parts[0] if len(parts) == 1 else F.concat(F.coalesce(parts[0], F.lit("")), *[F.concat(F.lit(", "), F.coalesce(p, F.lit(""))) for p in parts[1:]])
    return F.regexp_replace(F.regexp_replace(text, "^, ", ""), ", , ", ", ")


def flat_tag(c: Column) -> Column:
    return F.coalesce(c.rlike(FLAT_WORDS), F.lit(False))


def commercial_park_tag(c: Column) -> Column:
    return F.coalesce(c.rlike(PARK_WORDS), F.lit(False))


def snapshot_month(name: Column) -> Column:
    """First day of the month in a file name: ..._FULL_yyyy_mm..., else a stem that ends in _yyyy_mm; null otherwise."""
    full = F.regexp_extract(name, r"OCOD_FULL_(\d{4})_(\d{2})", 0)
    tail = F.regexp_extract(name, r"(\d{4})_(\d{2})(?:\.[A-Za-z0-9.]+)?$", 0)
    found = F.when(full != "", F.right(full, F.lit(7))).otherwise(F.substring(tail, 1, 7))
    return F.try_to_date(F.concat(F.regexp_replace(F.nullif(found, F.lit("")), "_", "-"), F.lit("-01")), "yyyy-MM-dd")


def window_start(month: Column, years_back: int = 3) -> Column:
    """First day of the rolling window that ends in a month."""
    return F.add_months(month, -12 * years_back)


def span_start(address: Column, text: Column) -> Column:
    """Offset of a text in an address, both stripped, without regard to case; -1 if it isn't there."""
    return F.instr(F.lower(stripped(address)), F.lower(stripped(text))) - 1


def with_spans(df: DataFrame, address: str = "property_address", text: str = "text") -> DataFrame:
    """Adds start and end of the first occurrence of each text (-1, -1 if absent or null) and span_valid: whether the address holds the text there."""
    start = F.coalesce(span_start(F.col(address), F.col(text)), F.lit(-1))
    end = F.when(F.col("start") >= 0, F.col("start") + F.length(stripped(F.col(text)))).otherwise(-1)
    held = F.lower(F.substring(F.col(address), F.col("start") + 1, F.col("end") - F.col("start")))
    return df.withColumn("start", start).withColumn("end", end).withColumn("span_valid", F.coalesce((F.col("start") >= 0) & (held == F.lower(stripped(F.col(text)))), F.lit(False)))


def with_missing_columns(df: DataFrame, columns: list[str], fill: str | None = None) -> DataFrame:
    """df with the columns it lacks, filled with one value."""
    return df.withColumns({c: F.lit(fill).cast("string") for c in columns if c not in df.columns})


def band(c: Column, low: float, high: float) -> Column:
    """decrease below low, increase above high, else (also for null) stable."""
    return F.when(c > high, "increase").when(c < low, "decrease").otherwise("stable")
