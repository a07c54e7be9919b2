"""Missing values and normalised keys, as Columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words and marks that stand for no value, in upper case.
NO_VALUE = ("", "-", "--", "?", ".", "N/A", "NA", "N.A.", "N/K", "NAN", "NIL", "NONE", "NOT KNOWN", "NOT STATED", "NULL", "TBC", "UNCLASSIFIED", "UNKNOWN")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value worked out once however often it is used."""
    return F.transform(F.array(value), use)[0]


def squeezed(c: Column) -> Column:
    """Upper case without blanks at the ends and with single blanks inside."""
    return F.trim(F.regexp_replace(F.upper(c), r"\s+", " "))


def present(c: Column) -> Column:
    """The value trimmed, or null where it is blank or stands for no value."""
    bare = F.regexp_replace(c, r"^\s+|\s+$", "")
    return F.when(~squeezed(c).isin(*NO_VALUE), bare)


def folded(c: Column) -> Column:
    """For comparisons in which case and outer blanks don't count: upper case, trimmed, blank as null."""
    return F.nullif(F.upper(F.regexp_replace(c, r"^\s+|\s+$", "")), F.lit(""))


def compact(c: Column) -> Column:
    """Lower case without any blanks (postcode keys); blank as null."""
    return F.nullif(F.regexp_replace(F.lower(c), r"\s+", ""), F.lit(""))
