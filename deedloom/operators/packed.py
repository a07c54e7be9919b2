"""Several values packed in one field: one row a value, with its position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deedloom.functions.addresses import POSTCODE, STREETS, STREETS_SHORT, UNITS
from deedloom.functions.values import let
from deedloom.plans.sizes import repeated

#: A title's positions are integers, so no range has more values; a longer one is one value as it is written.
MOST_VALUES = 2**31 - 1

_PARITY = r"(?i)\b(odd|even)"
#: The first word that can't be part of a list of values ends the list.
_ENDS = rf"\b(?!(?:and|to|odds?|evens?|numbers?|nos?|only|inclusive|incl|{UNITS})\b)[A-Za-z]{{2,}}"
_DELIMITER = r"(?i)[,;&+|\n\t]|\band\b"
#: A whole address ends with a street, and mostly a town and a postcode; then another begins.
_NEXT_ADDRESS = (
    rf"(?i)(\b{STREETS}\b(?:,\s*[A-Za-z][A-Za-z' .-]{{0,60}}?)?(?:[ ,]+{POSTCODE})?)\s*"
    rf"(?:\band\s+also\b|;\s*and\b|;|\||\n|\t|\band\b(?=\s+(?:(?:{UNITS})\s|(?:no\.?\s*)?[0-9\"])))\s*(?=[A-Za-z0-9\"])"
)
#: What a text that packs values must look like at least; most texts don't, and need no closer look.
_MAY_PACK = (
    rf"(?is)^\s*(?:[\"“”„‟«»'‘]|(?:{UNITS}\s+)?(?:nos?\.?\s*|numbers?\s+)?(?:[\"“”„‟«»'‘]|[0-9]+[a-z]?\s*(?:[-–—,;&+|(\n\t]|to\b|and\b|odd|even)|[a-z]\s*(?:[,;&+|\n\t]|and\b)))"
    rf"|[;|\n\t]|\band\s+also\b|\band\s+(?:{UNITS}\s|no\b|[0-9\"])"
)
_SINGLE_QUOTED = r"(?<![A-Za-z0-9])'([^'\n]+(?:'[a-z][^'\n]*){0,3})'(?=\s*(?:[,;&+|)\n\t]|$)|\s+(?:and|of|at)\b)"
_ITEM = rf"(?i)^(?:{UNITS}\s+)?([0-9]+[A-Za-z]?|[A-Za-z])\s*(?:(?:[-–—]|\bto\b)\s*([0-9]+[A-Za-z]?))?\s*(?![0-9A-Za-z]*[0-9])"


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


_ITEMS = "array<struct<text:string,first:bigint,step:bigint,n:bigint>>"


def _item(text: Column, first: Column | None = None, step: Column | None = None, n: Column | None = None) -> Column:
    """One item of a list, as it is written: the n numbers from first on by step or, without first, the text."""
    none = F.lit(None).cast("bigint")
    return F.struct(text.alias("text"), (none if first is None else first).alias("first"), (none if step is None else step).alias("step"), (F.lit(1).cast("bigint") if n is None else n).alias("n"))


def _numbers(item: Column) -> Column:
    """The item of one delimited piece, a range or the bare value; none if it holds no value."""
    first, last = F.regexp_extract(item, _ITEM, 1), F.regexp_extract(item, _ITEM, 2)
    lo, hi = first.try_cast("bigint"), last.try_cast("bigint")
    parity = F.lower(F.regexp_extract(item, _PARITY, 1))
    step = F.when(hi < lo, -1).otherwise(1).cast("bigint")
    start = F.when(((parity == "odd") & (lo % 2 == 0)) | ((parity == "even") & (lo % 2 != 0)), lo + step).otherwise(lo)
    stride = F.when(parity == "", step).otherwise(step * 2)
    # By division without fractions; a range of the other parity only has no numbers.
    n = F.when((hi - start) * step < 0, F.lit(0).cast("bigint")).otherwise(F.call_function("div", hi - start, stride) + 1)
    bare = F.when(last == "", first).otherwise(F.regexp_extract(item, rf"(?i)^(?:{UNITS}\s+)?([0-9]+[A-Za-z]?\s*(?:[-–—]|to)\s*[0-9]+[A-Za-z]?)", 1))
    short = F.abs(hi - lo) < MOST_VALUES
    ranged = let(F.array(_item(bare, start, stride, n)), lambda x: F.filter(x, lambda i: i["n"] > 0))
    return F.when((last != "") & lo.isNotNull() & hi.isNotNull() & short, ranged).when(first != "", F.array(_item(bare))).otherwise(F.array().cast(_ITEMS))


def _count(items: Column) -> Column:
    """How many values the items stand for, without any range written out."""
    return F.aggregate(items, F.lit(0).cast("bigint"), lambda a, i: a + i["n"])


def _list_items(body: Column, units: Column, plural: Column) -> Column:
    """Items of the list that ``body`` begins with.

    Split on quote characters: odd pieces are literals; even pieces are cut at the first word that ends a list, and
    split on delimiters. A fold puts the pieces together in order and stops where the list ends.
    """
    pieces = F.transform(F.split(body, '"'), lambda p, i: F.struct(
        (i % 2 == 1).alias("literal"), p.alias("text"),
        F.when(i % 2 == 1, "").otherwise(F.regexp_extract(p, rf"(?is)^(.*?)(?:{_ENDS}|$)", 1)).alias("head"), ((i % 2 == 0) & p.rlike(rf"(?i){_ENDS}")).alias("ends"),
    ))
    # Rows of the fold's state: (items, whether the list has ended, what follows it).
    start = F.struct(F.array().cast(_ITEMS).alias("items"), F.lit(False).alias("over"), F.lit("").alias("rest"), F.lit(False).alias("comma"))

    def step(acc: Column, p: Column) -> Column:
        items = F.flatten(F.transform(F.split(p["head"], _DELIMITER), lambda x: _numbers(_strip(x))))
        added = F.when(p["literal"], F.array(_item(p["text"]))).otherwise(items)
        return F.when(acc["over"], acc).otherwise(F.struct(
            F.concat(acc["items"], added).alias("items"), p["ends"].alias("over"),
            F.when(p["ends"], F.substring(p["text"], F.length(p["head"]) + 1, F.lit(2**31 - 1))).otherwise("").alias("rest"),
            p["head"].rlike(r",\s*[0-9]+[A-Za-z]?(?:\s*[-–]\s*[0-9]+)?\s*,?\s*$").alias("comma"),
        ))

    def without_house(done: Column) -> Column:
        # A number between the units and a street is the building's, not a unit.
        street_follows = done["rest"].rlike(rf"(?i)^[A-Za-z][A-Za-z'. -]*?\b{STREETS_SHORT}\s*(?:,|\(|$|{POSTCODE})")
        house_at_end = units & ~done["rest"].rlike(r"(?i)^(?:of|at)\b") & (street_follows | (~plural & done["comma"]))
        return F.when(house_at_end & (F.size(done["items"]) > 0), F.slice(done["items"], 1, F.greatest(F.size(done["items"]) - 1, F.lit(0)))).otherwise(done["items"])

    return let(F.aggregate(pieces, start, step), without_house)


def _packed_items(text: Column) -> Column:
    """The items packed in an address text; empty if they are at most one value."""
    none = F.array().cast(_ITEMS)
    several = lambda v: F.when(_count(v) > 1, v).otherwise(none)
    return F.when(text.rlike(_MAY_PACK), let(let(_straight(text), _items_of), several)).otherwise(none)


def packed_values(text: Column) -> Column:
    """ARRAY<STRING>: the values packed in an address text, in the order written; empty if it holds at most one.

    The values are the units if units are listed, else the house numbers; with several whole addresses, one unit (else
    house number) of each. Values come without the word for their kind and without quotes; a quoted name is one
    value; a range stands for its numbers, or for the odd or even ones if it says so. A range of house numbers
    after a unit or a building's name belongs to the building.

    Cases: null, blank and texts of any other form give an empty array. Falling ranges fall. Values may repeat; each
    occurrence counts. The array holds all of a text's values, so for rows use split_packed, which never builds it.
    """
    numbers = lambda i: F.transform(F.sequence(i["first"], i["first"] + i["step"] * (i["n"] - 1), i["step"]), lambda n: n.cast("string"))
    return F.flatten(F.transform(_packed_items(text), lambda i: F.when(i["first"].isNull(), F.array(i["text"])).otherwise(numbers(i))))


def _straight(text: Column) -> Column:
    """The text with all quotes that enclose names as plain double ones."""
    return F.regexp_replace(F.translate(text, "“”„‟«»‘’", "\"\"\"\"\"\"''"), _SINGLE_QUOTED, '"$1"')


def _whole_addresses(quoted: Column) -> Column:
    """The whole addresses that a text with plain quotes lists; one if it lists none."""
    literals = F.filter(F.split(quoted, '"'), lambda p, i: i % 2 == 1)
    in_quotes = quoted.rlike(r'^\s*"') & (F.size(literals) > 1) & F.forall(literals, lambda p: p.rlike(rf"(?i)\b{STREETS}\b"))
    return F.when(in_quotes, literals).otherwise(F.split(F.regexp_replace(quoted, _NEXT_ADDRESS, "$1\u0002"), "\u0002"))


def _one_of(address: Column) -> Column:
    """The unit, else the house number, of a whole address; null if it has neither."""
    literal = F.regexp_extract(address, rf"(?i)^\s*{UNITS}\s+\"([^\"]+)\"", 1)
    unit = F.regexp_extract(address, rf"(?i)^\s*{UNITS}\s+([0-9]+[A-Za-z]?|[A-Za-z])\b", 1)
    house = F.regexp_extract(address, r"(?i)^\s*(?:nos?\.?\s*)?([0-9]+[A-Za-z]?(?:\s*[-–]\s*[0-9]+[A-Za-z]?)?)\b", 1)
    of_building = F.regexp_extract(address, rf"(?i),\s*([0-9]+[A-Za-z]?(?:\s*[-–]\s*[0-9]+[A-Za-z]?)?),?\s+[A-Za-z'. ]+?\b{STREETS}\b", 1)
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in (literal, unit, house, of_building)])


def _items_of(quoted: Column) -> Column:
    lead, number = rf"(?is)^\s*{UNITS}\s+(?=[\"0-9]|[A-Z]\b)", r"(?i)^\s*(?:nos?\.?\s*|numbers?\s+)?(?=[0-9])"
    units, plural = quoted.rlike(lead), quoted.rlike(r"(?i)^\s*[a-z]+s\s")
    body = F.when(units, F.regexp_replace(quoted, lead, "")).when(quoted.rlike(number), F.regexp_replace(quoted, number, ""))
    return let(_whole_addresses(quoted), lambda whole: F.when(F.size(whole) > 1, F.transform(F.filter(F.transform(whole, _one_of), lambda v: v.isNotNull()), lambda v: _item(v))).otherwise(_list_items(body, units, plural)))


def split_packed(df: DataFrame, key: str, text: str) -> DataFrame:
    """(<key>, pos, val): one row for each value packed in ``text``, pos from 1; texts with at most one value have no row.

    Rows of a key must carry the same text (with several the greatest counts); they are combined before the shuffle,
    so a key of any number of rows is parsed once. Rows with a null key are one group. Cases as in packed_values; ranges
    of any length are written out, piece by piece, so that none has to fit in memory. An empty table gives no rows; other
    columns are ignored.
    """
    texts = df.groupBy(F.col(key).alias("_key")).agg(F.max(text).alias("_text"))
    items = texts.select("_key", F.posexplode(_packed_items(F.col("_text"))).alias("_i", "_item")).select("_key", "_i", *[F.col(f"_item.{c}").alias(f"_{c}") for c in ("text", "first", "step", "n")])
    # What the items before an item stand for comes before it; the rows of a key are together already.
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_key").orderBy("_i").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    values = repeated(items.withColumn("_before", before), F.col("_n"), "_j")
    val = F.when(F.col("_first").isNull(), F.col("_text")).otherwise((F.col("_first") + F.col("_step") * F.col("_j")).cast("string"))
    return values.select(F.col("_key").alias(key), (F.col("_before") + F.col("_j") + 1).cast("int").alias("pos"), val.alias("val"))


def packed_kind(text: Column) -> Column:
    """What an address text packs: ``addresses``, ``houses`` or ``units``; null if it holds at most one value."""
    kind = lambda q: F.when(F.size(_whole_addresses(q)) > 1, "addresses").when(q.rlike(rf"(?i)^\s*{UNITS}\s"), "units").otherwise("houses")
    return F.when(F.size(_packed_items(text)) > 0, let(_straight(text), kind))


def packs_places(text: Column) -> Column:
    """Whether an address text packs several house numbers or whole addresses; lists of units in one building don't count. False for null.

    Unit lists, the longest of the texts, are only looked at for a second address.
    """
    places = lambda q: (F.size(_whole_addresses(q)) > 1) | (~q.rlike(rf"(?i)^\s*{UNITS}\s") & (_count(_items_of(q)) > 1))
    return F.coalesce(F.when(text.rlike(_MAY_PACK), let(_straight(text), places)), F.lit(False))
