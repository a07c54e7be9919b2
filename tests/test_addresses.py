"""Labelling and assembly of addresses, with the golden cases."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from deedloom.operators.assemble import PARTS, addresses_of, assemble, describe_trees
from deedloom.operators.labelling import DEFAULT_RULES, RuleLabeller, SpanRule, components_by_type, exploded_spans, label_entities, label_spans, labelling_summary, overlap_statistics, standard_spans, with_spans_of, without_empty, without_overlaps

TAIL8 = ("ascent street", "se45 6pq", "London")
GOLDEN = [
    ("33 high street, London", [("street_number", "33"), ("street_name", "high street"), ("city", "London")], [(None, None, None, None, "33", "high street", None, "London")]),
    ("33-35, high street, London", [("street_number", "33-35"), ("street_name", "high street"), ("city", "London")], [(None, None, None, None, "33-35", "high street", None, "London")]),
    ("33, 34,35 high street, London", [("street_number", "33"), ("street_number", "34"), ("street_number", "35"), ("street_name", "high street"), ("city", "London")], [(None, None, None, None, n, "high street", None, "London") for n in ("33", "34", "35")]),
    ("units 33-35, high street, London", [("unit_type", "units"), ("unit_id", "33-35"), ("street_name", "high street"), ("city", "London")], [("units", "33-35", None, None, None, "high street", None, "London")]),
    ("flat 33-35, high street, London", [("unit_type", "flat"), ("unit_id", "33-35"), ("street_name", "high street"), ("city", "London")], [("flat", "33-35", None, None, None, "high street", None, "London")]),
    (
        "1, 7-10, 11-17 (odds), Broadhall House, 34-37 river road, London (sw15 8pt)",
        [("unit_id", "1"), ("unit_id", "7-10"), ("unit_id", "11-17"), ("number_filter", "odd"), ("building_name", "Broadhall House"), ("street_number", "34-37"), ("street_name", "river road"), ("city", "London"), ("postcode", "sw15 8pt")],
        [(None, u, f, "Broadhall House", "34-37", "river road", "sw15 8pt", "London") for u, f in (("1", None), ("7-10", None), ("11-17", "odd"))],
    ),
    (
        "1, 7-10, 11-17 (odds), 22-28 (evens), Broadhall House, 34-37 river road, London (sw15 8pt)",
        [("unit_id", "1"), ("unit_id", "7-10"), ("unit_id", "11-17"), ("number_filter", "odd"), ("unit_id", "22-28"), ("number_filter", "even"), ("building_name", "Broadhall House"), ("street_number", "34-37"), ("street_name", "river road"), ("city", "London"), ("postcode", "sw15 8pt")],
        [(None, u, f, "Broadhall House", "34-37", "river road", "sw15 8pt", "London") for u, f in (("1", None), ("7-10", None), ("11-17", "odd"), ("22-28", "even"))],
    ),
    (
        "Flats 36 - 40 (even), 42-44, climb house, Flats 1-5 down buildings, ascent street, London, se45 6pq",
        [("unit_type", "Flats"), ("unit_id", "36 - 40"), ("number_filter", "even"), ("unit_id", "42-44"), ("building_name", "climb house"), ("unit_type", "Flats"), ("unit_id", "1-5"), ("building_name", "down buildings"), ("street_name", "ascent street"), ("city", "London"), ("postcode", "se45 6pq")],
        [("Flats", "36 - 40", "even", "climb house", None, *TAIL8), ("Flats", "42-44", None, "climb house", None, *TAIL8), (None, "1-5", None, "down buildings", None, *TAIL8)],
    ),
    (
        "Flats 36 - 40 (even), 42-44, climb house, Flats 1-5 down buildings",
        [("unit_type", "Flats"), ("unit_id", "36 - 40"), ("number_filter", "even"), ("unit_id", "42-44"), ("building_name", "climb house"), ("unit_type", "Flats"), ("unit_id", "1-5"), ("building_name", "down buildings")],
        [("Flats", "36 - 40", "even", "climb house", None, None, None, None), ("Flats", "42-44", None, "climb house", None, None, None, None), (None, "1-5", None, "down buildings", None, None, None, None)],
    ),
]


def _entities(text, given):
    return [{"type": t, "text": x, "start": text.find(x), "end": text.find(x) + len(x), "confidence": 1.0} for t, x in given]


@pytest.mark.parametrize("case", range(len(GOLDEN)))
def test_golden(case):
    text, given, want = GOLDEN[case]
    assert [tuple(a[p] for p in PARTS) for a in assemble(_entities(text, given))] == want


def test_addresses_of(spark):
    rows = [(i, _entities(t, g), "clash") for i, (t, g, _) in enumerate(GOLDEN)] + [(90, [], "x"), (91, [{"type": "unit_type", "text": "flat", "start": 0, "end": 4, "confidence": 1.0}], "x"), (92, [{"type": "nonsense", "text": "x", "start": 0, "end": 1, "confidence": 1.0}], "x"), (93, None, "x")]
    df = spark.createDataFrame(rows, "datapoint_id int, entities array<struct<type:string,text:string,start:int,end:int,confidence:double>>, leaf string")
    out = addresses_of(df, keep=("leaf",)).orderBy("datapoint_id", "leaf_pos").collect()
    assert [(r.datapoint_id, *[r[p] for p in PARTS]) for r in out] == [(i, *w) for i, (_, _, want) in enumerate(GOLDEN) for w in want]
    assert addresses_of(df.limit(0)).columns == ["datapoint_id", "leaf_pos", *PARTS]
    assert "street_name=high street" in describe_trees(_entities(GOLDEN[0][0], GOLDEN[0][1]))


def _found(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", label_spans(F.col("t")).alias("s"))
    return {r.i: {(s.text.strip(), s.label) for s in r.s if s.start < s.end} for r in df.collect()}


def test_rules(spark):
    got = _found(spark, "flat 3, oak house, 12 high street, london (sw1 1aa)", "units 1-5 (odd), the exchange, 4 park road, leeds", None, "", "garage 7, elm mews, london", "12 and 14 green lane, bath", "flat a, oak road, london")
    assert {("oak house", "building_name"), ("3", "unit_id"), ("flat", "unit_type"), ("high street", "street_name"), ("sw1 1aa", "postcode"), ("london", "city")} <= got[0]
    assert {("odd", "number_filter"), ("1-5", "unit_id"), ("leeds", "city")} <= got[1]
    assert got[2] == set() and got[3] == set()
    assert ("7", "unit_id") in got[4] and ("garage", "unit_type") in got[4]
    assert {("12", "street_number"), ("14", "street_number"), ("green lane", "street_name")} <= got[5]
    assert len(DEFAULT_RULES) == 44 and len({r.name for r in DEFAULT_RULES}) == 42


def test_user_rules_and_failures(spark):
    def broken(text):
        raise RuntimeError

    rules = [SpanRule("broken", function=broken), SpanRule("x", function=lambda t: [(0, 1, "mine")]), SpanRule("digits", "number", r"\d+", applies="flat")]
    df = spark.createDataFrame([("flat 12",), ("12",)], "t string").select("t", label_spans(F.col("t"), rules).alias("s"))
    assert {r.t: [(s.label, s.start, s.end) for s in r.s] for r in df.collect()} == {"flat 12": [("mine", 0, 1), ("number", 5, 7)], "12": [("mine", 0, 1)]}


SPANS = "i int, spans array<struct<text:string,start:int,end:int,label:string,function:string,ord:int>>"


def _greedy(spans):
    if len(spans) < 2:
        return spans
    kept = []
    for s in sorted(spans, key=lambda s: s[1] - s[2]):
        if all(s[2] <= k[1] or k[2] <= s[1] for k in kept):
            kept.append(s)
    return sorted(kept, key=lambda s: s[1])


def test_overlaps_against_brute_force(spark):
    rng, rows = random.Random(2), []
    for i in range(150):
        spans = []
        for o in range(rng.randint(0, 9)):
            a = rng.randint(0, 20)
            spans.append(("x", a, a + rng.randint(0, 8), rng.choice("ab"), "f", o))
        rows.append((i, spans))
    df = spark.createDataFrame(rows, SPANS)
    got = {r.i: ([tuple(s) for s in r.a], [tuple(s) for s in r.b], [tuple(s) for s in r.c]) for r in df.select("i", without_overlaps(F.col("spans")).alias("a"), without_empty(F.col("spans")).alias("b"), standard_spans(F.col("spans")).alias("c")).collect()}
    for i, spans in rows:
        kept, full, distinct = got[i]
        assert [s[1:3] for s in kept] == [s[1:3] for s in _greedy(spans)]
        assert full == [s for s in spans if s[1] < s[2]] and distinct == list(dict.fromkeys((s[1], s[2], s[3]) for s in spans if s[1] < s[2]))
    stats = overlap_statistics(df).first()
    assert stats.spans_before == sum(len(s) for _, s in rows) and stats.spans_after == sum(len(_greedy(s)) for _, s in rows)
    empty = overlap_statistics(df.limit(0)).first()
    assert empty.n_rows == 0 and empty.pct_with_overlaps is None


def test_entities(spark):
    df = spark.createDataFrame([(1, "flat 3, oak house, 12 high street, london"), (2, None), (3, ""), (4, "x" * 5000)], "datapoint_id long, address string").withColumn("id", F.lit("clash"))
    out = label_entities(df, "datapoint_id", "address")
    rows = {r.datapoint_id: r for r in out.collect()}
    assert all(e.text == rows[1].original_address[e.start : e.end] for e in rows[1].entities) and rows[2].entities == [] and rows[2].original_address == ""
    assert {e.type for e in rows[1].entities} >= {"unit_id", "street_name", "city"}
    summary = labelling_summary(out).first()
    assert summary.total == 4 and summary.failed == summary.total - summary.successful
    assert labelling_summary(out.limit(0)).first().success_rate == 0.0
    parts = out.where("datapoint_id = 1").select(components_by_type(F.col("entities")).alias("m")).first().m
    assert parts["city"] == ["london"]
    spans = with_spans_of(df.withColumnRenamed("address", "property_address"))
    assert exploded_spans(spans, "datapoint_id").columns == ["datapoint_id", "start", "end", "text", "label", "property_address"]
    assert RuleLabeller()(["12 high street, london"])[0]
