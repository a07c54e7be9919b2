"""Address records that denote the same location, however they are written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deedloom.functions.values import compact
from deedloom.llm.places import NEAR, building_key, close, number_beside, number_key, plain_words, remains, street_parts
from deedloom.operators.packed import packed_kind
from deedloom.plans.session import cut
from deedloom.plans.sizes import small

#: Blocks of no more forms than this are compared whole; in larger ones forms meet by what slips leave of their streets.
#: Both ways find every pair.
WHOLE = 50
#: Rounds of label spreading after which an error is raised; components of forms are a few forms wide.
ROUNDS = 40

PARTS = ("unit", "number", "building", "street", "street_type", "town", "district", "postcode")


def title_addresses(records: DataFrame) -> DataFrame:
    """One row for each title whose records name one place: title_number and the PARTS, null where not given.

    Titles that pack several values, name several units, or are of land, parking or airspace near a place have none. All parts
    are those of one record, the one that gives the most of them (ties by the greatest parts). Records are combined by title
    before the shuffle.
    """
    fields = ["unit_id", "street_number", "building_name", "street_name", "postcode", "city", "district", "property_address"]
    # The record with a street and the most of the other parts, ties by the parts themselves: its parts go together.
    given = sum((F.col(c).isNotNull().cast("int") for c in fields[1:]), F.col("street_name").isNotNull().cast("int") * len(fields))
    cells = [F.max(F.struct(given.alias("_given"), *fields)).alias("_one")]
    units = [F.min(F.coalesce("unit_id", F.lit(""))).alias("_least"), F.max(F.coalesce("unit_id", F.lit(""))).alias("_most")]
    titles = records.where(F.col("title_number").isNotNull()).groupBy("title_number").agg(*cells, *units)
    one = titles.select("title_number", "_least", "_most", "_one.*").where((F.col("_least") == F.col("_most")) & ~F.coalesce(F.col("property_address").rlike(NEAR), F.lit(False)) & packed_kind(F.col("property_address")).isNull())
    street = street_parts(F.col("street_name"))
    return one.select(
        "title_number", F.nullif(F.regexp_replace(F.lower("unit_id"), r"[^\p{L}\p{N}]", ""), F.lit("")).alias("unit"),
        F.coalesce(number_key(F.col("street_number")), number_beside(F.col("property_address"), F.col("street_name"))).alias("number"),
        building_key(F.col("building_name")).alias("building"), street["base"].alias("street"), street["type"].alias("street_type"),
        F.regexp_replace(plain_words(F.col("city")), " ", "").alias("town"), plain_words(F.col("district")).alias("district"), compact(F.col("postcode")).alias("postcode"),
    )


def _agree(a: str, b: str) -> Column:
    """Whether forms a and b denote one place: strict on unit, number and street type, tolerant of slips elsewhere."""
    at = lambda side, part: F.col(f"{side}.{part}")
    both = lambda part: at(a, part).isNotNull() & at(b, part).isNotNull()
    same = lambda part: at(a, part).eqNullSafe(at(b, part))
    town = F.when(both("town"), close(at(a, "town"), at(b, "town"))).otherwise(same("district") | (both("postcode") & same("postcode")))
    street = both("street") & same("street_type") & F.when(
        # With other postcodes only the same spelling is the same street.
        both("postcode") & ~same("postcode"), same("street")
    ).when(both("postcode"), close(at(a, "street"), at(b, "street"), 3, 6)).otherwise(close(at(a, "street"), at(b, "street"), 4, 7))
    # Where a number is missing, the building's name has to tell.
    place = F.when(both("number"), same("number")).otherwise(both("building") & close(at(a, "building"), at(b, "building")))
    return F.coalesce(same("unit") & town & street & place, F.lit(False))


def _close_towns(forms: DataFrame) -> DataFrame:
    """(town, others): towns in whose blocks the forms of a town stand too, so that any two close towns share a block.

    Of two close towns the rarer goes to the block of the commoner, or both go to that of a third, the commonest near both.
    """
    towns = cut(forms.where(F.col("town").isNotNull()).groupBy(F.col("town").alias("t")).agg(F.count(F.lit(1)).alias("n")))
    keyed = towns.select(F.struct("n", "t").alias("x"), F.explode(remains(F.col("t"))).alias("key"))
    near = keyed.join(keyed.withColumnRenamed("x", "y"), "key").where((F.col("x") < F.col("y")) & close(F.col("x.t"), F.col("y.t"))).select("x", "y").distinct()
    near = cut(near)
    best = near.groupBy("x").agg(F.max("y").alias("best"))
    both = near.join(best, "x").join(best.select(F.col("x").alias("y"), F.col("best").alias("best_y")), "y", "left")
    return both.where(~F.col("best").eqNullSafe(F.col("best_y"))).groupBy(F.col("x.t").alias("town")).agg(F.collect_list("y.t").alias("others"))


def _links(forms: DataFrame, whole: int = WHOLE) -> DataFrame:
    """Links (a, b) of all forms that agree.

    Forms that agree share a block: of the unit, the street type, the number (without one, a building is given) and the
    town, a town close to it or, where one has none, the district or postcode. In the latter blocks, and those without
    number, pairs count only if one side lacks the part (``asks``). What the blocks give is checked by _agree, so
    hashes that clash do no harm.
    """
    placed = forms.join(small(_close_towns(forms)), "town", "left")
    part = lambda c: F.coalesce(F.col(c), F.lit("\u0002"))
    no_number, no_town = F.col("number").isNull(), F.col("town").isNull()

    def blocks(kind: str, some: Column, number: Column, asks_town: Column, asks_rest: Column) -> Column:
        at = lambda of, where: F.xxhash64(F.lit(kind + of), number, part("unit"), part("street_type"), where)
        towns = F.when(some & ~no_town, F.transform(F.concat(F.array("town"), F.coalesce("others", F.array().cast("array<string>"))), lambda t: F.struct(at("t", t).alias("block"), asks_town.alias("asks"))))
        district = F.when(some, F.struct(at("d", part("district")).alias("block"), asks_rest.alias("asks")))
        postcode = F.when(some & F.col("postcode").isNotNull(), F.struct(at("p", part("postcode")).alias("block"), asks_rest.alias("asks")))
        return F.concat(F.coalesce(towns, F.array().cast("array<struct<block:bigint,asks:boolean>>")), F.array_compact(F.array(district, postcode)))

    numbered = blocks("n", ~no_number, part("number"), F.lit(True), no_town)
    named = blocks("b", F.col("building").isNotNull(), F.lit(""), no_number, no_number)
    rows = placed.select(F.xxhash64("id").alias("h"), "street", F.explode(F.concat(numbered, named)).alias("k")).select("h", "street", "k.*")
    block = Window.partitionBy("block")
    met = rows.withColumns({"n": F.count(F.lit(1)).over(block), "asking": F.max("asks").over(block)}).where((F.col("n") > 1) & F.col("asking"))
    keys = F.when(F.col("n") <= whole, F.array("block")).otherwise(F.transform(remains(F.col("street")), lambda r: F.xxhash64("block", r)))
    met = cut(met.select("h", "street", "asks", F.explode(keys).alias("key")))
    a, b = met.where("asks").select("key", F.col("h").alias("a"), F.col("street").alias("s")), met.select("key", F.col("h").alias("b"), F.col("street").alias("t"))
    pairs = a.join(b, "key").where((F.col("a") != F.col("b")) & close(F.col("s"), F.col("t"), 3, 6)).select(F.least("a", "b").alias("ha"), F.greatest("a", "b").alias("hb")).distinct()
    side = lambda n: forms.select(F.xxhash64("id").alias(f"h{n}"), F.struct("id", *PARTS).alias(n))
    agreed = pairs.join(side("a"), "ha").join(side("b"), "hb").where(_agree("a", "b"))
    return agreed.select(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b")).where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(id, label): each id that has a link with the least id it is connected to.

    Labels spread along links in both directions, and jump to their label's label, until none changes. Each round is
    cut off by a checkpoint. Raises an error if ``rounds`` don't suffice, so no component is ever left in pieces.
    """
    edges = cut(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = cut(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("label")))
    for _ in range(rounds):
        near = edges.join(labels, F.col("b") == F.col("id")).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, F.col("id") == F.col("a"), "left").select("id", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("label"))
        jump = lower.select(F.col("id").alias("_id"), F.col("label").alias("_label"))
        lower = cut(lower.join(jump, F.col("label") == F.col("_id"), "left").select("id", "old", F.least("label", F.coalesce("_label", "label")).alias("label")))
        labels = lower.select("id", "label")
        if lower.where(F.col("old") != F.col("label")).isEmpty():
            return labels
    raise RuntimeError(f"labels still change after {rounds} rounds")


def same_places(addresses: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(members, links) of addresses with the PARTS: (<key>, form, place) for each address, and links between forms.

    Method: addresses equal in all parts are one form. Forms are put in blocks by unit, number, street type and town
    (see _links), and all that agree are linked, however thick the blocks: unit, number and street type must be equal;
    street, building and town may differ by slips (edits, swaps). Links chain to places.

    Cases: addresses without street, or with neither number nor building, form no links. Null parts agree with what the
    rules for missing parts allow (see _agree); null units are the whole. An address has its own form if it links to none.
    """
    hashed = F.md5(F.concat_ws("\u0001", *[F.coalesce(F.col(p), F.lit("\u0002")) for p in PARTS]))
    keyed = addresses.withColumn("id", hashed)
    forms = cut(keyed.where(F.col("street").isNotNull() & (F.col("number").isNotNull() | F.col("building").isNotNull())).select("id", *PARTS).distinct())
    links = cut(_links(forms))
    places = components(links)
    members = keyed.select(key, "id", *PARTS).join(places.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"), "left")
    able = F.col("street").isNotNull() & (F.col("number").isNotNull() | F.col("building").isNotNull())
    return members.select(key, F.col("id").alias("form"), F.when(able, F.coalesce("label", "id")).alias("place"), *PARTS), links


def same_place_pairs(addresses: DataFrame, key: str) -> DataFrame:
    """(a, b): the keys of each two addresses of one place, a < b, once.

    Pairs are those of a place whose units are equal and whose numbers are equal where both are given; their streets agree
    directly or through other addresses of the place. The number of rows is that of the pairs that are asked for. Addresses
    without a place have none; repeated keys count once.
    """
    members, _ = same_places(addresses, key)
    held = cut(members.where(F.col("place").isNotNull()).select(F.col(key).alias("key"), "place", *PARTS).dropDuplicates(["key"]))
    left = held.select("place", F.struct("key", *PARTS).alias("a"))
    right = held.select("place", F.struct("key", *PARTS).alias("b"))
    return left.join(right, "place").where((F.col("a.key") < F.col("b.key")) & F.col("a.unit").eqNullSafe(F.col("b.unit")) & (F.col("a.number").isNull() | F.col("b.number").isNull() | (F.col("a.number") == F.col("b.number")))).select(
        F.col("a.key").alias("a"), F.col("b.key").alias("b")
    )
