"""Matching of records of two sources that share no key, by a graph of candidate links."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deedloom.functions.addresses import STREET_TYPES
from deedloom.functions.values import compact
from deedloom.llm.places import BEHIND, FLOORS, NEAR, PART_AT, building_key, close, number_beside, number_key, plain_words, remains, street_parts
from deedloom.operators.packed import packs_places
from deedloom.plans.session import cut
from deedloom.plans.sizes import hot_keys, salted_left_join, small

PARTS = ("number", "building", "street", "street_type", "town", "postcode")
#: A candidate link is pruned if its weight is under this share of the mean of the best ones at its two ends.
PRUNE = 0.25
#: Share of a link's score that comes from its neighbours; the score from which a link is a match.
NEIGHBOURS, ACCEPT = 0.25, 0.74
#: How much two streets of slightly different spelling count against two of the same one when streets compete for a partner,
#: and what a street keeps of its neighbours' support however much better another one is.
SLIP, KEPT = 0.15, 0.25
#: Scores are stable if none changes by more than this; an error is raised if they aren't after so many rounds.
STABLE, ROUNDS = 0.005, 40
#: A town is taken for another spelling of a close one that so many times as many addresses name.
TOWN_RATIO = 5


def _parsed(rows: DataFrame, parse: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows (row_id, texts...) with the parts that ``parse`` makes of their texts; equal texts are parsed once.

    ``parse`` keeps all texts and says in ``_out`` which don't count; these are left out after the cut, as a filter before
    it would move down to the rows and parse each of them. Texts that a good part of the rows share are joined in pieces.
    """
    texts = [c for c in rows.columns if c != "row_id"]
    keyed = rows.withColumn("text_id", _id_of(*texts))
    parsed = cut(parse(keyed.drop("row_id").distinct())).where(~F.col("_out")).withColumn("_in", F.lit(True)).drop("_out")
    ids = cut(keyed.select("row_id", "text_id"))
    joined = salted_left_join(ids, parsed, "text_id", F.col("row_id"), hot_keys(ids.select("text_id"), "text_id"))
    return joined.where(F.col("_in")).drop("text_id", "_in")


def _id_of(*columns: str) -> Column:
    """16 bytes that differ where any of the columns does; null is a value."""
    return F.unhex(F.md5(F.concat_ws("\u0001", *[F.coalesce(F.col(c), F.lit("\u0002")) for c in columns])))


def register_premises(records: DataFrame) -> DataFrame:
    """Addresses of register records by record: row_id and the PARTS; packed houses or addresses and land nearby have none."""
    rows = records.select(F.col("ocod_id").alias("row_id"), "property_address", "street_number", "building_name", "street_name", "city", F.coalesce(compact(F.col("postcode")), compact(F.col("postcode2"))).alias("postcode"))

    def parse(texts: DataFrame) -> DataFrame:
        near = F.coalesce(F.col("property_address").rlike(NEAR), F.lit(False)) | F.col("street_name").isNull()
        staged = texts.withColumn("out", near | packs_places(F.col("property_address"))).withColumn("s", F.when(~F.col("out"), street_parts(F.col("street_name"))))
        kept = lambda c: F.when(~F.col("out"), c)
        return staged.select(
            "text_id", (F.col("out") | F.col("s.base").isNull()).alias("_out"), kept(F.coalesce(number_key(F.col("street_number")), number_beside(F.col("property_address"), F.col("street_name")))).alias("number"),
            kept(building_key(F.col("building_name"))).alias("building"), F.col("s.base").alias("street"), F.col("s.type").alias("street_type"), kept(F.regexp_replace(plain_words(F.col("city")), " ", "")).alias("town"), "postcode",
        )

    return _parsed(rows, parse)


def business_premises(records: DataFrame) -> DataFrame:
    """Addresses of business entries: row_id and the PARTS, from their number-or-name, street and identifier."""
    number = r"(?:^|[\s,])([0-9]+[a-z]?(?:\s*(?:-|–|/|\bto\b)\s*[0-9]+[a-z]?)?)$"

    def parse(texts: DataFrame) -> DataFrame:
        place = F.trim(F.regexp_replace(F.regexp_replace(F.lower("number_or_name"), r"\s+", " "), r"^[\s,]+|[\s,.]+$", ""))
        for prefix in (FLOORS, BEHIND, PART_AT, BEHIND):
            place = F.regexp_replace(place, prefix, "")
        # The town stands after the street in the identifier, before the postcode.
        parts = F.filter(F.transform(F.split(F.lower("full_property_identifier"), ","), lambda x: F.trim(x)), lambda x: (x != "") & ~x.rlike(r"^[a-z]{1,2}[0-9][0-9a-z]?\s*[0-9a-z]{3}$"))
        staged = texts.withColumns({"place": place, "parts": parts, "s": street_parts(F.col("street"))}).withColumn("last", F.element_at("parts", -1))
        is_town = (F.size("parts") > 1) & ~plain_words(F.col("last")).eqNullSafe(plain_words(F.col("street"))) & ~street_parts(F.col("last"))["base"].eqNullSafe(F.col("s.base"))
        return staged.select(
            "text_id", F.col("s.base").isNull().alias("_out"), number_key(F.nullif(F.regexp_extract("place", number, 1), F.lit(""))).alias("number"), building_key(F.regexp_replace("place", number, "")).alias("building"), F.col("s.base").alias("street"), F.col("s.type").alias("street_type"),
            F.when(is_town, F.regexp_replace(plain_words(F.col("last")), " ", "")).alias("town"), compact(F.col("postcode")).alias("postcode"),
        )

    return _parsed(records.select(F.col("voa_id").alias("row_id"), "number_or_name", "street", "full_property_identifier", "postcode"), parse)


def _forms(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct addresses with an id, and which rows have which."""
    keyed = rows.where(F.col("street").isNotNull() & (F.col("number").isNotNull() | F.col("building").isNotNull())).withColumn("form", _id_of(*PARTS))
    return cut(keyed.select("form", *PARTS).distinct()), cut(keyed.select("form", "row_id").distinct())


def _area(postcode: Column) -> Column:
    """The part of a postcode that tells the area."""
    return F.nullif(F.regexp_replace(postcode, r"[0-9][a-z]{2}$", ""), F.lit(""))


def _town_names(forms: DataFrame) -> DataFrame:
    """(town, name): the towns that are slips of far commoner ones, with the commonest of those."""
    towns = cut(forms.where(F.col("town").isNotNull()).groupBy("town").agg(F.count(F.lit(1)).alias("n")))
    keyed = towns.select("town", "n", F.explode(remains(F.col("town"))).alias("key"))
    common = keyed.where(F.col("n") >= TOWN_RATIO).select(F.col("town").alias("other"), F.col("n").alias("m"), "key")
    near = keyed.join(common, "key").where(F.col("m") >= TOWN_RATIO * F.col("n")).select("town", "other", "m").distinct().where(close(F.col("town"), F.col("other")))
    return near.groupBy("town").agg(F.max_by("other", F.struct("m", "other")).alias("name"))


def _placed(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides' forms with places: the town as it is mostly written or, without one, all towns that addresses of the postcode's area name."""
    both = left.select("town", "postcode").unionByName(right.select("town", "postcode"))
    names = cut(_town_names(both))
    named = lambda side: side.join(small(names), "town", "left").withColumn("town", F.coalesce("name", "town")).drop("name")
    # Towns that a single address of the area names may be mistakes.
    in_area = named(both).where(F.col("town").isNotNull()).groupBy(_area(F.col("postcode")).alias("area"), "town").agg(F.count(F.lit(1)).alias("n")).where(F.col("area").isNotNull() & (F.col("n") > 1))
    areas = cut(in_area.groupBy("area").agg(F.collect_list("town").alias("towns")))

    def place(side: DataFrame) -> DataFrame:
        asked = named(side).withColumn("_asks", F.when(F.col("town").isNull(), _area(F.col("postcode"))))
        out = asked.join(small(areas), F.col("_asks") == F.col("area"), "left").drop("_asks", "area")
        return out.withColumn("places", F.when(F.col("town").isNotNull(), F.array("town")).otherwise(F.coalesce("towns", F.array().cast("array<string>")))).drop("towns")

    return cut(place(left)), cut(place(right))


def _attributes(forms: DataFrame) -> DataFrame:
    """(form, attribute): what two addresses of one place may share.

    Each attribute holds a postcode, or a town and a number or building's name, so no block grows with the country: a common
    street name and number are one block a town. Addresses without town have theirs in each town of their postcode's area.
    """
    street = F.concat_ws(" ", "street", F.coalesce("street_type", F.lit("")))
    start, end = F.substring("street", 1, 3), F.substring(F.reverse("street"), 1, 3)
    b, n, p = F.col("building"), F.col("number"), F.col("postcode")
    at_postcode: list[tuple[str, Sequence[Column]]] = [("number", [n]), ("building", [b]), ("street", [street]), ("number+street", [n, street])]
    in_town: list[tuple[str, Sequence[Column]]] = [("street+number", [street, n]), ("building", [b]), ("building+number", [b, n]), ("street+building", [street, b]), ("number+start", [n, start]), ("number+end", [n, end, F.col("street_type")]), ("street+name", [street, F.substring("building", 1, 3)])]
    # An attribute is its hash: the shuffles carry 8 bytes of it. Two attributes with one hash only make one more candidate.
    cell = lambda name, cols: F.when(F.concat(*cols).isNotNull(), F.xxhash64(F.lit(name), *cols))
    by_town = F.flatten(F.transform("places", lambda t: F.array(*[cell(f"town+{name}", [t, *cols]) for name, cols in in_town])))
    cells = F.concat(F.array(*[cell(f"postcode+{name}", [p, *cols]) for name, cols in at_postcode]), by_town)
    return forms.select("form", F.explode(F.array_distinct(F.array_compact(cells))).alias("attribute"))


def weighted_candidates(left: DataFrame, right: DataFrame) -> DataFrame:
    """(a, b, weight) for forms that share attributes: the sum of what each shared one weighs, the more the fewer have it."""
    # Both sides' attributes are shuffled once: a window over an attribute counts them, and both sides of the join read it.
    rows = _attributes(left).withColumn("side", F.lit(0)).unionByName(_attributes(right).withColumn("side", F.lit(1)))
    by_attribute = Window.partitionBy("attribute")
    counted = rows.withColumns({"n": F.count(F.lit(1)).over(by_attribute), "m": F.sum("side").over(by_attribute)}).where((F.col("m") > 0) & (F.col("m") < F.col("n")))
    a = counted.where(F.col("side") == 0).select("attribute", F.col("form").alias("a"), (1 / F.log1p(F.col("n").cast("double"))).alias("rarity"))
    b = counted.where(F.col("side") == 1).select("attribute", F.col("form").alias("b"))
    return a.join(b, "attribute").groupBy("a", "b").agg(F.sum("rarity").alias("weight"))


def pruned(candidates: DataFrame, prune: float = PRUNE) -> DataFrame:
    """Meta-blocking: candidates whose weight is at least ``prune`` of the mean of the best ones at their two ends."""
    best = candidates.withColumn("best_a", F.max("weight").over(Window.partitionBy("a"))).withColumn("best_b", F.max("weight").over(Window.partitionBy("b")))
    return best.where(F.col("weight") * 2 >= prune * (F.col("best_a") + F.col("best_b"))).select("a", "b", "weight")


def _likeness(l: str, r: str) -> Column:
    """STRUCT<own, same>: agreement of two addresses, 0 to 1 (0 where number, street, its type or town contradict), and whether the streets are spelt alike."""
    at = lambda side, part: F.col(f"{side}.{part}")
    both = lambda part: at(l, part).isNotNull() & at(r, part).isNotNull()
    same = lambda part: at(l, part).eqNullSafe(at(r, part))
    whole = lambda side: F.concat(at(side, "street"), F.coalesce(at(side, "street_type"), F.lit("")))
    near = F.levenshtein(at(l, "postcode"), at(r, "postcode")) <= 1
    no_town = ~both("town")
    town = F.when(no_town, 1.0).when(same("town"), 1.0).when(close(at(l, "town"), at(r, "town")), 0.95).otherwise(0.0)
    # Where it is: by postcode, else by town; another postcode in one town is a doubt, without a town it is far away.
    where = F.when(both("postcode"), F.when(same("postcode"), 1.0).when(near, 0.9).when(no_town, 0.3).otherwise(0.5)).when(no_town, 0.5).otherwise(0.8)
    typed = same("street_type")
    untyped = ~(F.coalesce(at(l, "street_type").isin(*STREET_TYPES), F.lit(False)) & F.coalesce(at(r, "street_type").isin(*STREET_TYPES), F.lit(False)))
    short, long = (F.when(where >= 0.9, n).otherwise(n + 1) for n in (3, 6))
    slip = F.coalesce(typed & close(at(l, "street"), at(r, "street"), short, long), F.lit(False)) | (untyped & close(whole(l), whole(r), 6, 9))
    one = (F.levenshtein(whole(l), whole(r)) <= 1) | (F.array_sort(F.split(whole(l), "")) == F.array_sort(F.split(whole(r), "")))
    spelt = same("street") & typed
    street = F.when(spelt, 1.0).when(slip & one, 0.8).when(slip, 0.45).otherwise(0.0)
    agree, alike = both("building") & same("building"), both("building") & close(at(l, "building"), at(r, "building"))
    place = F.when(both("number"), same("number")).otherwise(alike)
    name = F.when(agree, 0.1).when(alike, 0.08).when(both("building"), -0.05).otherwise(0.0)
    own = F.least(F.lit(1.0), 0.45 * street + 0.55 * where * town + name)
    return F.struct(F.when(place & (street > 0) & (town > 0), own).otherwise(0.0).alias("own"), spelt.alias("same"))


def _street(side: str = "") -> Column:
    return F.concat_ws(" ", f"{side}street", f"{side}street_type")


def refined(links: DataFrame, known: DataFrame, neighbours: float = NEIGHBOURS, rounds: int = ROUNDS) -> DataFrame:
    """(a, b, own, score): scores of links refined by their neighbours' until stable.

    links: (na, sb, a, b, own, same): a joins street name na, b the street sb of a place. known: (na, sb) that are spelt alike,
    whether or not premises link them. Links that join na to sb are neighbours. The evidence that sb is na grows with the
    premises of sb that na's links join, each by its best score, and counts SLIP of its worth where the spelling differs. The
    street names that claim sb compete: a link gets the share of the best claim's evidence that its own claim has. So a slip
    is believed where no street is spelt so, and not where the very street is there. Evidence is summed by street, never listed
    by pairs of links. Raises an error if scores aren't stable after ``rounds``.
    """
    # Links are few beside the candidates they come from, which are worked out once.
    state = cut(links.withColumn("score", F.col("own")))
    known = cut(known.select("na", "sb").distinct().withColumn("evidence", F.lit(1.0)))
    worth = F.when(F.col("same"), 1.0).otherwise(SLIP)
    for _ in range(rounds):
        best = state.groupBy("na", "sb", "b").agg(F.max("score").alias("top"), F.max(worth).alias("worth"))
        claims = best.groupBy("na", "sb").agg((F.max("worth") * (1 + F.sum("top"))).alias("evidence")).unionByName(known).groupBy("na", "sb").agg(F.max("evidence").alias("evidence"))
        claims = claims.withColumn("support", F.col("evidence") / F.max("evidence").over(Window.partitionBy("sb"))).drop("evidence")
        new = state.join(claims, ["na", "sb"]).withColumn("new", (1 - neighbours) * F.col("own") + neighbours * (KEPT + (1 - KEPT) * F.col("support")))
        new = cut(new.select("na", "sb", "a", "b", "own", "same", F.col("score").alias("old"), F.col("new").alias("score")))
        change = new.agg(F.max(F.abs(F.col("score") - F.col("old"))).alias("c")).first().c
        state = new.drop("old")
        if change is None or change <= STABLE:
            return state.select("a", "b", "own", "score")
    raise RuntimeError(f"scores still change after {rounds} rounds")


def form_links(left: DataFrame, right: DataFrame, prune: float = PRUNE, neighbours: float = NEIGHBOURS, rounds: int = ROUNDS) -> DataFrame:
    """(a, b, own, score): links of two sides' forms, before any is accepted."""
    left, right = _placed(left, right)
    candidates = pruned(weighted_candidates(left, right), prune)
    l, r = left.select(F.col("form").alias("a"), F.struct(*PARTS).alias("l")), right.select(F.col("form").alias("b"), F.struct(*PARTS).alias("r"))
    scored = candidates.join(l, "a").join(r, "b").withColumn("like", _likeness("l", "r")).where(F.col("like.own") > 0)
    at = lambda side="": F.concat_ws("|", _street(side), F.coalesce(F.col(f"{side}town"), F.concat(F.lit("~"), _area(F.col(f"{side}postcode"))), F.lit("?")))
    links = scored.select(_street("l.").alias("na"), at("r.").alias("sb"), "a", "b", "like.own", "like.same")
    known = left.where(F.col("town").isNotNull()).select(_street().alias("na"), at().alias("sb")).distinct().join(right.select(at().alias("sb")).distinct(), "sb", "left_semi")
    return refined(links, known, neighbours, rounds)


def link_premises(left: DataFrame, right: DataFrame, prune: float = PRUNE, neighbours: float = NEIGHBOURS, accept: float = ACCEPT, rounds: int = ROUNDS) -> DataFrame:
    """(left_id, right_id, confidence): rows of two sources with the PARTS that are the same premises.

    Method: equal addresses of a side are one node. Nodes that share attributes (street and number, postcode and
    number, building and street, ...) are candidates, weighted by how rare these are; meta-blocking prunes candidates far
    lighter than the best at their ends. Those left are scored by their parts, and each score is refined by its
    neighbours', links that join the same two streets, until none changes. Scores from ``accept`` on are matches.

    Strict: numbers (with letter and range) must be equal where both are given, else the buildings' names must agree; a
    street's type and the town must not contradict.

    Cases: rows without street, or with neither number nor building, have no match. Null parts agree with anything,
    for less. Repeated rows count once. Each side may be empty. Other columns are ignored.

    Scale: everything but the last joins works on distinct addresses, in blocks that hold a postcode or a town. Rows of an
    address that a good part of all rows have are joined in pieces; the result has one row a pair that is asked for.
    """
    (lf, lrows), (rf, rrows) = _forms(left), _forms(right)
    final = cut(form_links(lf, rf, prune, neighbours, rounds).where(F.col("score") >= accept).select("a", "b", "score"))
    pairs = salted_left_join(lrows, final.withColumnRenamed("a", "form"), "form", F.col("row_id"), hot_keys(lrows.select("form"), "form")).where(F.col("b").isNotNull())
    pairs = pairs.select(F.col("row_id").alias("left_id"), F.col("b").alias("form"), "score")
    both = salted_left_join(pairs, rrows, "form", F.col("left_id"), hot_keys(pairs.select("form"), "form")).where(F.col("row_id").isNotNull())
    return both.groupBy("left_id", F.col("row_id").alias("right_id")).agg(F.round(F.max("score"), 4).alias("confidence"))
