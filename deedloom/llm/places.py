"""Parts of postal addresses in one form, as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from deedloom.functions.addresses import BUILDING_TYPES, STREET_TYPES, UNITS
from deedloom.functions.values import let

# What stands before a number or name and says which floor or part is meant.
FLOORS = r"^(?:(?:pt|part)\s+)?(?:(?:bsmt|basement)\s*(?:&|and)\s*)?(?:(?:gnd|ground|\d+(?:st|nd|rd|th)|lower|upper|bsmt|basement|top)\s+(?:flr|floor)|(?:bsmt|basement))\b[\s,]*"
BEHIND = r"^(?:r/o|rear of|adj(?:oining)?|at)\s+"
PART_AT = r"^(?:unit|suite|shop|office|room|kiosk|flat|studio)s?\s+[0-9]*[a-z]?\s*(?:at|of)\s+"
# How titles of land, parking and the like near a building begin.
NEAR = r"(?i)^\s*(?:the\s+)?(?:air\s*space|land|parking|car\s*(?:park|space)|garages?\s+(?:and|at|to|adj)|site|store\s+at|plot\s+of\s+land)\b"

_NUMBER = r"([0-9]+[a-z]?)(?:\s*(?:-|–|—|/|\bto\b)\s*([0-9]+[a-z]?))?"


def _short_to_full(types: dict[str, tuple[str, ...]]) -> Column:
    return F.create_map(*[F.lit(x) for full, short in types.items() for s in (full, *short) for x in (s, full)])


def _full_type(word: Column, types: dict[str, tuple[str, ...]]) -> Column:
    """A type word in full: from its abbreviation, or from a slip that fits one type only."""
    letters = lambda c: F.array_sort(F.split(c, ""))
    fits = lambda t: (F.levenshtein(word, t) <= F.when(F.length(t) >= 6, 2).otherwise(1)) | (letters(word) == letters(t))
    slip = let(F.filter(F.array(*map(F.lit, types)), fits), lambda near: F.when((F.size(near) == 1) & (F.length(word) > 1), near[0]))
    return F.coalesce(F.try_element_at(_short_to_full(types), word), slip, word)


def plain_words(c: Column) -> Column:
    """Lower case letters and digits, single blanks between; apostrophes close up; null if nothing is left."""
    bare = F.regexp_replace(F.lower(c), r"['’`]", "")
    return F.nullif(F.trim(F.regexp_replace(F.regexp_replace(bare, r"&", " and "), r"[^\p{L}\p{N}]+", " ")), F.lit(""))


def street_parts(c: Column) -> Column:
    """STRUCT<base, type>: a street's name without blanks, and its type in full (null if it is one word)."""
    def parts(words: Column) -> Column:
        two = F.size(words) > 1
        return F.struct(
            F.nullif(F.when(two, F.array_join(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(1))), "")).otherwise(F.element_at(words, -1)), F.lit("")).alias("base"),
            F.when(two, let(F.element_at(words, -1), lambda last: _full_type(last, STREET_TYPES))).alias("type"),
        )

    return let(F.split(plain_words(F.regexp_replace(F.lower(c), r"\(\s*off\s*\)", " ")), " "), parts)


def building_key(c: Column) -> Column:
    """A building's name without blanks and leading article, its type in full."""
    def key(words: Column) -> Column:
        last = F.element_at(words, -1)
        long = F.concat(F.array_join(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(1))), ""), let(last, lambda w: _full_type(w, BUILDING_TYPES)))
        return F.nullif(F.when(F.size(words) > 1, long).otherwise(last), F.lit(""))

    return let(F.split(F.regexp_replace(plain_words(c), r"^the ", ""), " "), key)


def number_key(c: Column) -> Column:
    """A house number with its letter, or a range as first-last; null if there is none."""
    first, last = F.regexp_extract(F.lower(c), _NUMBER, 1), F.regexp_extract(F.lower(c), _NUMBER, 2)
    return F.nullif(F.when(last != "", F.concat(first, F.lit("-"), last)).otherwise(first), F.lit(""))


def number_beside(address: Column, street: Column) -> Column:
    """The house number that stands right before or after the street in an address text; a unit's number is none."""
    def found(at_text: Column) -> Column:
        text, name, at = at_text["text"], at_text["name"], at_text["at"]
        before = F.substring(text, F.lit(1), at - 1)
        unit = before.rlike(rf"\b{UNITS}\.?\s+[0-9]+[a-z]?\s*,?\s*$")
        house = F.when(~unit, F.regexp_extract(before, rf"({_NUMBER})\s*,?\s*$", 1)).otherwise("")
        after = F.regexp_extract(F.substring(text, at + F.length(name), F.lit(40)), rf"^\s*({_NUMBER})\b(?!\w)", 1)
        return F.when((at > 0) & (name != ""), number_key(F.when(house != "", house).otherwise(F.nullif(after, F.lit("")))))

    text, name = F.regexp_replace(F.lower(address), r"\s+", " "), F.trim(F.regexp_replace(F.lower(street), r"\s+", " "))
    return let(F.struct(text.alias("text"), name.alias("name"), F.instr(text, name).alias("at")), found)


def close(a: Column, b: Column, short: int | Column = 5, long: int | Column = 9) -> Column:
    """True if two words differ by no more than slips: one edit from ``short`` letters on, two from ``long`` on; a swap is one."""
    swapped = F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, ""))
    edits = F.levenshtein(a, b)
    n = F.least(F.length(a), F.length(b))
    return (a == b) | ((n >= short) & (edits <= 1)) | ((n >= long) & (edits <= 2)) | ((n >= short - 1) & swapped & (edits <= 2))


def remains(c: Column) -> Column:
    """Keys of a word such that any two words that are close() with 3 and 6 (so with greater lengths too) share one.

    These are the word, what is left of it without any letter or, from six letters on, any two, and its letters in order.
    """
    without_one = lambda w: F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.substr(w, F.lit(1), i - 1), F.substr(w, i + 1)))
    none = F.array().cast("array<string>")
    one = F.when(F.length(c) > 1, without_one(c)).otherwise(none)
    two = F.when(F.length(c) >= 6, F.flatten(F.transform(without_one(c), without_one))).otherwise(none)
    return F.array_distinct(F.concat(F.array(c), one, two, F.array(F.concat(F.lit("\u0001"), F.array_join(F.array_sort(F.split(c, "")), "")))))
