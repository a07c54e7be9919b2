"""Expansion, rules, location, matching, prices, trends, quality, sources, sinks and the pipeline."""

from __future__ import annotations

import warnings
import zipfile
from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from deedloom.functions.text import clean_street_number, commercial_park_tag, flat_tag, joined_address, snapshot_month, street_key, token_spacing, window_start, with_missing_columns, with_spans
from deedloom.operators import analytics as A
from deedloom.operators.classify import Rule, classify, default_rules, drop_repeated_classes, fill_unknown_classes
from deedloom.operators.expand import expand_column, expand_numbers, needs_expansion, unique_ids
from deedloom.operators.gazetteers import building_gazetteer, building_mentions, top_share
from deedloom.operators.geo import add_areas, fill_by_gazetteers, forward_fill_in_title
from deedloom.operators.match import add_existence_flags
from deedloom.operators.prices import clean_transactions, rolling_averages
from deedloom.operators.quality import bio_labels, bio_spans, classification_report, diagnose_class, span_scores
from deedloom.operators.trends import bootstrap_ratio, mean_differences, monthly_means, weighted_series
from deedloom.plans.pipeline import OUTPUT, run_pipeline
from deedloom.plans.sizes import nulls_apart, repeated, spread
from deedloom.sources.archives import businesses_located, read_businesses, read_postcodes, read_snapshots, read_span_texts, read_titles, read_transactions, read_zipped_csv
from deedloom.sources.downloads import Downloader, listed_in_xml, newest_first
from deedloom.sources.sinks import ensure_table, new_partitions, span_documents, write_by_year, write_metrics, write_new_partitions, write_partitioned, write_span_documents
from deedloom.streaming.incremental import stream_snapshots

EXPAND = "i int, unit_id string, street_number string, number_filter string, class string"


def _expand(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], EXPAND)


@pytest.mark.parametrize(("text", "parity", "limit", "size", "large"), [
    ("1-5", None, 100, 5, False), ("1-150", None, 100, 150, True), ("1-50", None, 30, 50, True), ("1-50", None, 60, 50, False), ("10-12", None, 100, 3, False), ("0-2009", None, 100, 2010, True), ("2000-2099", None, 150, 100, False),
    ("1-20", "even", 15, 10, False), ("1-20", "odd", 5, 10, True), ("1-99", None, 100, 99, False), ("1-101", None, 100, 101, True), ("1-3, 7-9", None, 100, 9, False), ("9-7", None, 100, 3, False),
])
def test_expansion_sizes(spark, text, parity, limit, size, large):
    out = expand_column(_expand(spark, (text, None, parity, "residential")), "unit_id", large=limit).collect()
    assert len(out) == size and {(r.expansion_size, r.large_expansion) for r in out} == {(size, large)}


def test_expansion_cases(spark):
    df = _expand(spark, ("1-10", None, None, "residential"), ("50-200", None, None, "residential"), ("5-8", None, None, "residential"), (None, "1-100", None, "residential"), ("7", "1-3", None, "residential"), ("1-3", None, None, "business"), (None, None, None, None), ("1-3", None, "even", "residential"), ("99999999999-3", None, None, "residential"), ("5-5", None, "even", "residential"))
    out = expand_numbers(df)
    sizes = {r.i: r["count"] for r in out.groupBy("i").count().collect()}
    assert sizes == {0: 10, 1: 151, 2: 4, 3: 100, 4: 1, 5: 1, 6: 1, 7: 1, 8: 1, 9: 1}
    one = {r.i: r for r in out.where("i >= 4").collect()}
    assert one[5].expand_block == 0 and one[5].expansion_size == 1 and one[7].unit_id == "1-3" and one[7].expansion_size == 1 and one[9].expansion_size == 0
    assert {r.i for r in needs_expansion(df).collect()} == {0, 1, 2, 3, 7, 8, 9}
    assert expand_numbers(df.limit(0)).count() == 0 and expand_column(df.limit(0), "unit_id").count() == 0


def test_wide_ranges_are_expanded_whole(spark):
    """Ranges of any width: no array is made of them, and every number comes out."""
    df = _expand(spark, ("Unit 1 - 2000000000", None, None, "residential"), ("1-150001", None, "odd", "residential"), (None, "200000 - 5", None, "residential"), ("0-2147483647", None, None, "residential"))
    first = expand_numbers(df.where("i = 0")).limit(3).collect()
    assert [(r.unit_id, r.expansion_size, r.large_expansion) for r in first] == [(str(n), 2_000_000_000, True) for n in (1, 2, 3)]
    assert expand_numbers(df.where("i = 3")).first().expansion_size == 2**31 - 1
    sizes = expand_column(df.where("i = 0"), "unit_id").limit(5).collect()
    assert [r.expansion_size for r in sizes] == [2_000_000_000] * 5
    whole = expand_numbers(df.where("i in (1, 2)"))
    got = {r.i: (r.n, r.least, r.most, r.different) for r in whole.groupBy("i").agg(F.count(F.lit(1)).alias("n"), F.min(F.coalesce("unit_id", "street_number").cast("int")).alias("least"), F.max(F.coalesce("unit_id", "street_number").cast("int")).alias("most"), F.countDistinct("expanded_n").alias("different")).collect()}
    assert got == {1: (75_001, 1, 150_001, 75_001), 2: (199_996, 5, 200_000, 199_996)}


def test_repeated_and_nulls_apart(spark):
    df = spark.createDataFrame([("a", 3), ("b", 0), ("c", None), ("d", 70_000)], "k string, n int")
    assert {r.k: (r["count"], r.most) for r in repeated(df, F.col("n"), "at").groupBy("k").agg(F.count(F.lit(1)).alias("count"), F.max("at").alias("most")).collect()} == {"a": (3, 2), "d": (70_000, 69_999)}
    keys = [r.k for r in spark.range(500).select(nulls_apart(F.when(F.col("id") < 5, "x"), F.col("id")).alias("k")).collect()]
    assert keys.count("x") == 5 and len(set(keys)) > 400


def test_unique_ids(spark):
    df = spark.createDataFrame([("A", 2), ("A", 1), ("B", 5)], "title_number string, k int")
    assert {(r.title_number, r.k): (r.multi_id, r.unique_id, r.is_multi) for r in unique_ids(df, ["k"]).collect()} == {("A", 1): (1, "A-1", True), ("A", 2): (2, "A-2", True), ("B", 5): (1, "B-1", False)}


LAND, SHOP = "land at the edge of the shopping centre", "apartment with shopping centre view"


def _texts(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "property_address string")


def test_rules(spark):
    says = lambda p: lambda df: F.col("property_address").rlike(p)
    land, shop = Rule("land", says("^land"), "land"), Rule("shop", says("shopping centre"), "business")
    df = _texts(spark, LAND, SHOP, "land plot for sale", "residential house", None)
    at = lambda rules: [r["class"] for r in classify(df, rules).collect()]
    assert at([land]) == ["land", "unknown", "land", "unknown", "unknown"]
    assert at([shop]) == ["business", "business", "unknown", "unknown", "unknown"]
    assert at([land, shop]) == ["land", "business", "land", "unknown", "unknown"]
    assert at([shop, land]) == ["business", "business", "land", "unknown", "unknown"]
    assert at([]) == ["unknown"] * 5 and classify(df.limit(0), [land]).columns == ["property_address", "class", "matched_rule"]
    with pytest.raises(ValueError):
        classify(df, [land, land])

    def broken(_):
        raise KeyError("nothing")

    with pytest.warns(UserWarning, match="Rule 'broken' failed"):
        assert at([Rule("broken", broken, "x"), land])[0] == "land"
    with warnings.catch_warnings(record=True) as said:
        warnings.simplefilter("always")
        out = classify(spark.createDataFrame([("x",)], "other string"), [land, Rule("missing", F.col("nowhere") == 1, "y")]).collect()
    assert [r["class"] for r in out] == ["unknown"] and sum("failed" in str(w.message) for w in said) == 2
    assert len(default_rules()) == 15


def test_fill_and_dedupe(spark):
    rows = [("A", "residential", True), ("A", "business", True), ("A", "unknown", True), ("B", "unknown", True), ("B", "airspace", True), ("C", "unknown", False), ("C", "land", True), ("D", None, True)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, title_number string, class string, is_multi boolean")
    got = sorted((r.i, r["class"], r.was_filled) for r in fill_unknown_classes(df).where("class is not null").collect())
    assert got == [(0, "residential", False), (1, "business", False), (2, "business", True), (2, "residential", True), (3, "unknown", False), (4, "airspace", False), (5, "unknown", False), (6, "land", False)]
    again = spark.createDataFrame([(1, "A", "land"), (2, "A", "land"), (3, "A", "residential"), (4, "A", "residential"), (5, "B", "land")], "i int, title_number string, class string")
    assert sorted(r.i for r in drop_repeated_classes(again, ["i"]).collect()) == [1, 3, 4, 5]


def test_text_functions(spark):
    df = spark.createDataFrame([("123+456", "semi-detached", "london.Manchester", "(odd)33-45"), (None, None, None, None)], "a string, b string, c string, d string")
    out = df.select(*[token_spacing(F.col(c)).alias(c) for c in df.columns])
    first = tuple(out.first())
    assert first[:3] == ("123 + 456", "semi - detached", "london. Manchester") and first[3].endswith("33-45")
    assert tuple(out.select(*[token_spacing(F.col(c)).alias(c) for c in df.columns]).first()) == first
    numbers = spark.createDataFrame([("UNIT 5",), ("12A",), ("GND FLR 12-14",), ("10 & 12",), ("THE HALL",), (None,), ("4 (REAR)",), ("-",)], "n string")
    # What stands before a bracket at the end keeps its blank, so no last word is found there.
    assert [r.n for r in numbers.select(clean_street_number(F.col("n")).alias("n")).collect()] == [None, "12", "12-14", "12", None, None, None, None]
    keys = spark.createDataFrame([("abbot's hill road",), ("glass house lane",)], "s string")
    assert [r.s for r in keys.select(street_key(F.col("s")).alias("s")).collect()] == ["abbothillroad", "glahouselane"]
    tags = spark.createDataFrame([("Flats 1",), ("unit 4 chelmsford business park",), ("4 road",), (None,)], "t string").select(flat_tag(F.col("t")).alias("f"), commercial_park_tag(F.col("t")).alias("p"))
    assert [tuple(r) for r in tags.collect()] == [(True, False), (True, True), (False, False), (False, False)]
    joined = spark.createDataFrame([(None, "b", None, None, "e"), ("a", None, None, "d", None)], "a string, b string, c string, d string, e string").select(joined_address(*[F.col(c) for c in "abcde"]).alias("j"))
    assert [r.j for r in joined.collect()] == ["b, , e", "a, , d, "]
    months = spark.createDataFrame([("OCOD_FULL_2024_05.zip",), ("price_2024_06.parquet",), ("x.csv",), (None,)], "f string").select(snapshot_month(F.col("f")).alias("m"))
    assert [r.m for r in months.collect()] == [date(2024, 5, 1), date(2024, 6, 1), None, None]
    assert months.select(window_start(F.col("m")).alias("w")).first().w == date(2021, 5, 1)
    spans = with_spans(spark.createDataFrame([("12 Oak Road", " oak road "), ("x", "y"), (None, "y")], "property_address string, text string")).collect()
    assert [(r.start, r.end, r.span_valid) for r in spans] == [(3, 11, True), (-1, -1, False), (-1, -1, False)]
    assert with_missing_columns(df, ["a", "z"], "?").columns == ["a", "b", "c", "d", "z"]


AREAS = "oa11cd string, lsoa11cd string, msoa11cd string, lad11cd string"


def test_location_and_matching(spark):
    lookup = spark.createDataFrame([("aa11aa", "o1", "l1", "m1", "d1")], f"postcode2 string, {AREAS}")
    df = spark.createDataFrame([
        (1, "T", "AA1 1AA", "north", None, "oak road", "12"), (2, "T", None, "north", "elm house", "oak road", "14"), (3, "T", "ZZ9 9ZZ", "north", None, "fir way", None), (4, "U", None, "south", None, None, None), (5, None, None, "north", None, None, None),
    ], "i int, title_number string, postcode string, district string, building_name string, street_name string, street_number string")
    located = add_areas(df, lookup)
    buildings = spark.createDataFrame([("Elm House", "o2", "l2", "m2", "d1", 0.7)], f"building_name string, {AREAS}, fraction double")
    districts = spark.createDataFrame([("NORTH", "d1")], "district string, lad11cd string")
    streets = spark.createDataFrame([("firway", "o3", "l3", "m3", "d1", 0.5)], f"street_name2 string, {AREAS}, fraction double")
    filled = fill_by_gazetteers(located, buildings, districts, streets)
    got = {r.i: (r.oa11cd, r.lsoa11cd, r.msoa11cd, r.lad11cd, r.match_prob, r.geog_match) for r in filled.collect()}
    assert got == {1: ("o1", "l1", "m1", "d1", None, None), 2: ("o2", "l2", "m2", "d1", 0.7, "building"), 3: (None, "l3", "m3", "d1", 0.5, "street"), 4: (None,) * 6, 5: (None, None, None, "d1", None, None)}
    forward = {r.i: (r.oa11cd, r.lsoa11cd, r.geog_match) for r in forward_fill_in_title(filled, ["i"]).collect()}
    # By geog_match: building (2), street (3), none (1).
    assert forward == {2: ("o2", "l2", "building"), 3: ("o2", "l3", "street"), 1: ("o1", "l1", "street"), 4: (None, None, None), 5: (None, None, None)}
    business = spark.createDataFrame([("o1", "l9", "elm house", "oakroad", "12", "d1"), ("o1", "l9", "elm house", "oakroad", "12", "d1"), (None,) * 6], "oa11cd string, lsoa11cd string, building_name string, street_name2 string, street_number string, lad11cd string")
    flags = {r.i: (r.oa_match, r.lsoa_match, r.building_match, r.street_match, r.number_match) for r in add_existence_flags(filled, business).collect()}
    assert flags == {1: (True, False, False, True, True), 2: (False, False, True, True, False), 3: (False,) * 5, 4: (False,) * 5, 5: (False,) * 5}


def test_top_share_ties(spark):
    df = spark.createDataFrame([("a", "x")] * 2 + [("a", "y")] * 2 + [("b", "z"), (None, "z"), ("c", None)], "k string, v string")
    assert {(r.k, r.v, r.fraction) for r in top_share(df, ["k"], ["v"]).collect()} == {("a", "x", 0.5), ("b", "z", 1.0)}
    assert top_share(df, ["k"], ["v"], 0.6).count() == 1


def test_building_gazetteer(spark):
    rows = [(i, None, "oak house", "high street", "town", "aa11aa", "d1", l, l, l) for i, l in enumerate(["l1", "l1", "l2"])]
    sales = spark.createDataFrame(rows, "id int, saon string, paon string, street_name2 string, locality string, postcode2 string, lad11cd string, lsoa11cd string, oa11cd string, msoa11cd string")
    best = building_gazetteer(building_mentions(sales, "id")).where("building_name like '%oak house%'").collect()
    assert [(r.lsoa11cd, r.fraction) for r in best] == [("l1", 0.5)]


def test_transactions_and_rolling_averages(spark):
    raw = spark.createDataFrame([("t1", 100, "2020-05-01 00:00", "AA1 1AA", "F", "12", None, "OAK ROAD", "X", "D", "A"), ("t2", 300, "2020-04-30 00:00", "AA1 1AA", "Z", "12A", None, None, "X", "D", "B"), ("t3", 1, "rubbish", None, None, None, None, None, None, None, None)],
        "transaction_unique_identifier string, price int, date_of_transfer string, postcode string, property_type string, paon string, saon string, street string, locality string, district string, ppd_category_type string")
    lookup = spark.createDataFrame([("aa11aa", "m1")], "postcode2 string, msoa11cd string")
    clean = {r.transaction_unique_identifier: r for r in clean_transactions(raw, lookup).collect()}
    assert set(clean) == {"t1", "t2"} and clean["t1"].street_name2 == "oakroad" and clean["t2"].property_type is None and clean["t2"].street_number == "12" and clean["t1"].msoa11cd == "m1" and clean["t1"].year == 2020
    sales = spark.createDataFrame([("m", p, d, "F", "A") for p, d in [(100, date(2018, 1, 1)), (200, date(2018, 1, 2)), (300, date(2021, 1, 1)), (500, date(2021, 1, 2)), (400, date(2017, 12, 31))]] + [("m", None, date(2020, 1, 1), "F", "A"), (None, 5, date(2020, 1, 1), "F", "A"), ("m", 7, date(2020, 1, 1), "O", "A")], "msoa11cd string, price int, date_of_transfer date, property_type string, ppd_category_type string")
    out = rolling_averages(sales, spark.createDataFrame([(date(2021, 1, 1),)], "snapshot_date date")).collect()
    assert [(r.price_mean, r.price_median, r.n) for r in out] == [(200.0, 200.0, 3)]


def test_weighted_series_and_trends(spark):
    homes = spark.createDataFrame([(date(2024, 1, 1), a, "g", "d") for a in ("m1", "m1", "m2")] + [(date(2024, 1, 1), "m3", "h", "d"), (date(2024, 2, 1), "m1", "g", "d"), (date(2024, 1, 1), None, "g", "d"), (date(2024, 3, 1), "m1", "g", "d")], "snapshot_date date, msoa11cd string, grp string, lad11cd string")
    prices = spark.createDataFrame([(date(2024, 1, 1), "m1", 100.0, 90.0), (date(2024, 1, 1), "m2", 400.0, 300.0), (date(2024, 2, 1), "m1", 150.0, 100.0)], "snapshot_date date, msoa11cd string, price_mean double, price_median double")
    dwellings = spark.createDataFrame([("m1", 10), ("m2", 30)], "msoa11cd string, dwellings long")
    rows = {(r.date.month, r.grp): r for r in weighted_series(homes, prices, dwellings, ["grp"]).collect()}
    assert set(rows) == {(1, "g"), (1, "h"), (2, "g")}
    r = rows[1, "g"]
    assert (r.ocod_mean, r.ocod_median, r.dwelling_mean, r.ocod_total_counts, r.total_dwelling_count, r.total_value_ocod_mean) == (200, 160, 325, 3, 40, 600) and abs(r.ocod_ratio_mean - 200 / 325) < 1e-12
    assert rows[1, "h"].ocod_mean is None and rows[1, "h"].ocod_total_counts == 1
    whole = {(r.date.month): r for r in weighted_series(homes, prices, dwellings).collect()}
    assert whole[1].ocod_mean is None and whole[1].ocod_total_counts == 4
    with_lad = {(r.date.month, r.grp): r for r in weighted_series(homes, prices, dwellings, ["grp"], lad="lad11cd").collect()}
    assert with_lad[1, "g"].ocod_total_counts == 4 and with_lad[1, "g"].ocod_mean == 200
    means = monthly_means(homes, prices, ["grp"])
    trend = mean_differences(means, ["grp"]).collect()
    assert [(t.grp, t.mean_weighted_difference, t.mean_unweighted_difference, t.n_periods, t.n_ratio_observations) for t in trend] == [("g", -50.0, -100.0, 1, 2)]
    with pytest.raises(ValueError):
        mean_differences(means, [])


def test_bootstrap():
    assert bootstrap_ratio([1.0]) == {"fraction_above_one": None, "fraction_below_one": None, "mean_ratio": None, "ci_lower": None, "ci_upper": None, "significantly_different": False}
    x = [1.1, 1.2, 1.3, 1.05]
    np.random.seed(42)
    means = np.array(x)[np.random.choice(4, size=(1000, 4), replace=True)].mean(axis=1)
    b = bootstrap_ratio(x)
    assert b["ci_lower"] == np.percentile(means, 2.5) and b["significantly_different"] and b["fraction_above_one"] == 1.0


def test_quality(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a")], "t string, p string")
    got = {r.label: (round(r.precision, 6), round(r.recall, 6), round(r.f1, 6), r.support) for r in classification_report(df, "t", "p").collect()}
    assert got["a"] == (0.5, 0.5, 0.5, 2) and got["c"] == (0.0, 0.0, 0.0, 1) and got["accuracy"] == (0.5, 0.5, 0.5, 4) and got["macro avg"][1] == 0.5
    parts = "datapoint_id int, start int, end int, label string"
    truth, guess = spark.createDataFrame([(1, 0, 2, "x"), (2, 0, 2, "x")], parts), spark.createDataFrame([(1, 0, 2, "x"), (2, 1, 2, "x")], parts)
    pooled, apart = ({r.label: (r.tp, r.fp, r.fn) for r in span_scores(truth, guess, per_text=k).collect()} for k in (False, True))
    assert pooled["overall"] == (1, 1, 0) and apart["overall"] == (1, 1, 1)
    assert span_scores(truth.limit(0), guess.limit(0)).collect()[0].f1 == 0.0
    spans = "text string, spans array<struct<start:int,end:int,label:string>>"
    t = spark.createDataFrame([("a", [(0, 1, "x")]), ("b", [(0, 1, "x")]), ("c", []), ("d", [(0, 1, "x")]), ("e", [])], spans)
    p = spark.createDataFrame([("a", [(0, 1, "x")]), ("b", [(0, 2, "x")]), ("c", [(0, 1, "x")]), ("d", []), ("e", [])], spans)
    assert {r.text: r.outcome for r in diagnose_class(t, p, "x").collect()} == {"a": "correct", "b": "incorrect", "c": "false_positive", "d": "missing"}
    tokens = spark.createDataFrame([([(0, 0), (0, 2), (3, 5), (6, 8), (9, 11)], [(0, 5, "s"), (9, 11, "u")])], "tokens array<struct<start:int,end:int>>, spans array<struct<start:int,end:int,label:string>>")
    row = tokens.select(bio_labels(F.col("tokens"), F.col("spans")).alias("b")).select("b", bio_spans(F.col("b")).alias("s")).first()
    assert row.b == [None, "B-s", "I-s", "O", "B-u"] and [tuple(s) for s in row.s] == [(1, 3, "s"), (4, 5, "u")]


def test_tables(spark):
    df = spark.createDataFrame([("r", "a"), ("r", "b"), ("s", "a"), (None, "a")], "r string, c string")
    assert {tuple(r) for r in A.crosstab(df, "r", "c", ["a", "b"], margins=True).collect()} == {("r", 1, 1, 2), ("s", 1, 0, 1), ("All", 2, 1, 3)}
    assert {tuple(r) for r in A.crosstab(df, "r", "c", ["a", "b"], normalize="columns").collect()} == {("r", 0.5, 1.0), ("s", 0.5, 0.0)}
    series = spark.createDataFrame([("k", date(2024, 1, 1), 10), ("k", date(2024, 3, 1), 20)], "k string, d date, v int")
    row = A.projected_change(series, ["k"], "d", "v").first()
    assert (row.mean_monthly_change, row.total_change) == (5.0, 10.0)
    assert A.first_last_change(series, ["k"], "d", "v").first().ratio == 2.0
    assert A.concentration(spark.createDataFrame([(5,), (3,), (-2,), (0,)], "v int"), "v", 1).where("sign = 'positive'").first().share == 5 / 8


def test_sources(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "OCOD_FULL_2024_05.zip", "w") as z:
        z.writestr("notes.txt", "x")
        z.writestr("titles.csv", 'Title Number,Tenure,Property Address,Country Incorporated (1),Other\nA1,Freehold,"1 Oak Road, Town",JERSEY,x\nA2,Leasehold,,PANAMA,y\n'.encode() + b"A3,Freehold,caf\xff,MALTA,z\n")
    rows = {r.title_number: r for r in read_titles(spark, str(tmp_path / "*.zip")).collect()}
    assert set(rows) == {"A1", "A3"} and rows["A1"].property_address == "1 Oak Road, Town" and rows["A1"].country_incorporated == "JERSEY" and rows["A3"].property_address == "caf" and rows["A1"].snapshot_date == date(2024, 5, 1)
    with pytest.raises(Exception, match="titles.csv"):
        read_zipped_csv(spark, str(tmp_path / "OCOD_FULL_2024_05.zip"), member="absent.csv").collect()
    directory = tmp_path / "directory"
    directory.mkdir()
    with zipfile.ZipFile(directory / "p.zip", "w") as z:
        z.writestr("Data/ONSPD_X.csv", "pcds,oslaua,oa11,lsoa11,msoa11,ctry,more\nAA1 1AA,d,o,l,m,E92000001,x\nZZ1 1ZZ,d,o,l,m,S92000003,x\n")
        z.writestr("bad.csv", "a,b\n1,2\n")
    assert [tuple(r) for r in read_postcodes(spark, str(directory / "p.zip")).collect()] == [("aa11aa", "d", "o", "l", "m")]
    with pytest.raises(ValueError, match="lacks"):
        read_postcodes(spark, str(directory / "p.zip"), member="bad.csv")
    line = lambda code, text, ident, number, street, post: "*".join(["0", "1", "2", "3", code, text, "6", ident, "8", number, street, "11", "12", "13", post, "15"])
    (tmp_path / "voa.csv").write_text("\n".join([line("CS", "SHOP", "ID", "OAK HOUSE", "OAKS ROAD", "AA1 1AA"), line("CP", "CAR PARK", "ID", "1", "X", "AA1 1AA"), line("CS", "ADVERTISING RIGHT", "ID", "1", "X", "AA1 1AA"), line("CS", "SHOP", "WESTFIELD SHOPPING CENTRE", "5", "X", "AA1 1AA"), line("CS", "SHOP", "ID", "GND FLR 12", "X", "QQ1 1QQ")]))
    with zipfile.ZipFile(tmp_path / "quoted.zip", "w") as z:
        z.writestr("q.csv", 'a,b\n"one\nline, and ""another""",2\n\nx\n')
    assert [(r.a, r.b) for r in read_zipped_csv(spark, str(tmp_path / "quoted.zip")).collect()] == [('one\nline, and "another"', "2"), ("x", None)]
    (tmp_path / "OCOD_FULL_2024_06.csv").write_text('Title Number,Property Address\nT1,"1 Oak\nRoad, ""Town"""\n')
    assert [(r.title_number, r.property_address) for r in read_titles(spark, str(tmp_path / "OCOD_FULL_2024_06.csv")).collect()] == [("T1", '1 Oak\nRoad, "Town"')]
    with zipfile.ZipFile(tmp_path / "voa.zip", "w") as z:
        z.write(tmp_path / "voa.csv", "voa.csv")
        z.writestr("small.csv", "x")
    lookup = spark.createDataFrame([("aa11aa", "o", "l", "m", "d")], f"postcode2 string, {AREAS}")
    for path in ("voa.csv", "voa.zip"):
        got = {(r.street_name2, r.street_number, r.building_name) for r in businesses_located(read_businesses(spark, str(tmp_path / path)), lookup).collect()}
        assert got == {("oakroad", None, "oak house"), ("x", None, None)}
    (tmp_path / "pp.csv").write_text('"{T}","100","2020-05-01 00:00","AA1 1AA","F","N","F","12","","OAK ROAD","","T","D","C","A","A"\n')
    assert read_transactions(spark, str(tmp_path / "pp.csv")).first().price == 100


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, date(2020, 1, 5)), (2, date(2021, 1, 5)), (3, None)], "i int, date_of_transfer date")
    write_by_year(df, str(tmp_path / "years"))
    assert sorted(p.name for p in (tmp_path / "years").glob("year=*")) == ["year=2020", "year=2021"]
    again = df.where("i = 2").withColumn("i", F.lit(9)).withColumn("year", F.year("date_of_transfer"))
    write_partitioned(again, str(tmp_path / "years"), "year")
    assert sorted(r.i for r in spark.read.parquet(str(tmp_path / "years")).collect()) == [1, 9]
    more = spark.createDataFrame([(5, 2021), (6, 2022)], "i int, year int")
    assert [r.i for r in new_partitions(more, str(tmp_path / "years"), "year").collect()] == [6]
    write_new_partitions(more.select("i", F.lit(None).cast("date").alias("date_of_transfer"), "year"), str(tmp_path / "years"), "year")
    assert spark.read.parquet(str(tmp_path / "years")).count() == 3
    made = []
    make = lambda: made.append(1) or more
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception):  # noqa: B017
        ensure_table(spark, str(tmp_path / "broken"), make).count()
    assert made == [] and (tmp_path / "broken" / "part-0.parquet").read_bytes() == b"no parquet"
    assert ensure_table(spark, str(tmp_path / "t"), make).count() == 2 and ensure_table(spark, str(tmp_path / "t"), make).count() == 2 and made == [1]
    spans = spark.createDataFrame([(1, 5, 6, " b ", "y", "a b"), (1, 0, 1, "a", "x", "a b")], "datapoint_id int, start int, end int, text string, label string, property_address string")
    write_span_documents(spans, str(tmp_path / "json"))
    back = read_span_texts(spark, str(tmp_path / "json")).first()
    assert back.text == "a b" and [s.text for s in back.spans] == ["a", "b"] and span_documents(spans.limit(0)).count() == 0
    write_metrics(more, str(tmp_path / "csv"))
    assert len(list((tmp_path / "csv").glob("*.csv"))) == 1
    spark.createDataFrame([(1,)], "i int").coalesce(1).write.parquet(str(tmp_path / "snap"))
    part = next((tmp_path / "snap").glob("part*.parquet"))
    part.rename(tmp_path / "snap" / "x_2024_05.parquet")
    assert read_snapshots(spark, str(tmp_path / "snap" / "x_2024_05.parquet")).first().snapshot_date == date(2024, 5, 1)


def test_downloads(tmp_path):
    import io
    import urllib.error

    calls, waits = [], []

    def opener(request):
        calls.append(request.full_url)
        if len(calls) < 3:
            raise urllib.error.URLError("away")
        return io.BytesIO(b"data")

    d = Downloader(tmp_path, opener=opener, sleep=waits.append)
    assert d.fetch("http://x/y/a.zip?k=1").read_bytes() == b"data" and waits == [1.0, 2.0]
    assert d.fetch("http://x/y/a.zip") and len(calls) == 3
    assert d.fetch_all([("http://x/b", "b")], confirm=lambda names: False) == []
    assert newest_first(["FULL_2023", "FULL_2024", "x"], "FULL") == ["FULL_2024", "FULL_2023"] and listed_in_xml("<Name>a.csv</Name><Name>b.zip</Name>", suffix=".zip") == ["b.zip"]


TITLES = "title_number string, tenure string, district string, county string, region string, price_paid double, property_address string, country_incorporated string, snapshot_date date"


def _pipeline_inputs(spark):
    lookup = spark.createDataFrame([("aa1 1aa".replace(" ", ""), "o1", "l1", "m1", "d1")], f"postcode2 string, {AREAS}")
    none = lambda key: spark.createDataFrame([], f"{key} string, {AREAS}, fraction double")
    business = spark.createDataFrame([("oakroad", "12", "elm house", "o1", "l1", "m1", "d1")], f"street_name2 string, street_number string, building_name string, {AREAS}")
    return lookup, business, none("building_name"), spark.createDataFrame([("north", "d1")], "district string, lad11cd string"), none("street_name2")


def test_pipeline(spark):
    rows = [("A", "Flats 1-3 (odd), oak house, 4 high street, london (aa1 1aa)"), ("B", "land at oak road, london"), ("C", "garage 7, elm mews, london"), ("A2", "flat 9, 12 oak road, london (aa1 1aa)"), ("N", None)]
    both = [(t, "F", "north", "c", "r", 1.0, a, "JERSEY", date(2024, m, 1)) for t, a in rows for m in (1, 2)]
    out = run_pipeline(spark.createDataFrame(both, TITLES), *_pipeline_inputs(spark)).collect()
    january = {(r.title_number, r.unit_id): r for r in out if r.snapshot_date == date(2024, 1, 1)}
    assert len(out) == 2 * len(january) and {t for t, _ in january} == {"A", "B", "C", "A2"}
    flats = {u: r for (t, u), r in january.items() if t == "A"}
    assert all(r["class"] == "residential" and r.lsoa11cd == "l1" for r in flats.values()) and {r.unique_id for r in flats.values()} == {f"A-{k + 1}" for k in range(len(flats))}
    assert next(r["class"] for (t, _), r in january.items() if t == "B") == "land" and next(r["class"] for (t, _), r in january.items() if t == "C") == "carpark"
    again = run_pipeline(spark.createDataFrame(both, TITLES).repartition(5), *_pipeline_inputs(spark)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    assert run_pipeline(spark.createDataFrame([], TITLES), *_pipeline_inputs(spark)).columns == [*OUTPUT, "snapshot_date"]


def test_pipeline_query_expands_long_ranges(spark, monkeypatch):
    """The registered query gives a row for each number of a range, however long."""
    from deedloom.queries import properties

    title = [("A", "F", "north", "c", "r", 1.0, "Flats 1-100003, Oak House, 4 High Street, London (AA1 1AA)", "JERSEY", date(2024, 1, 1), datetime(2024, 1, 2))]
    tables = {"titles": spark.createDataFrame(title, TITLES + ", loaded_at timestamp"), "postcode_lookup": _pipeline_inputs(spark)[0], "district_gazetteer": _pipeline_inputs(spark)[3]}
    tables["voa_register"] = spark.createDataFrame([], "voa_id long, primary_and_secondary_description_code string, primary_description_text string, number_or_name string, street string, postcode string")
    tables["price_paid_transactions"] = spark.createDataFrame([], f"transaction_unique_identifier string, saon string, paon string, locality string, price int, date_of_transfer date, district string, property_type string, street_name2 string, street_number string, postcode2 string, {AREAS}")
    monkeypatch.setattr(properties, "table", lambda spark, folder, name: tables[name])
    out = properties.pipeline(spark, "").select(F.count(F.lit(1)).alias("n"), F.countDistinct("unit_id").alias("units"), F.max("expansion_size").alias("size")).first()
    assert (out.n, out.units, out.size) == (100_003, 100_003, 100_003)


def test_summary_queries_use_the_expansion_size(spark, monkeypatch):
    """The plain counts hold all records; those below 100 leave out large and unknown expansions."""
    from deedloom.queries import properties, statistics

    schema = "ocod_id long, " + ", ".join(f"{c} {'boolean' if c == 'is_multi' else 'string'}" for c in properties._FIELDS) + ", expansion_size int, loaded_at timestamp"
    row = {c: "x" for c in properties._FIELDS} | {"class": "residential", "is_multi": True, "loaded_at": datetime(2031, 1, 1)}
    ocod = spark.createDataFrame([row | {"ocod_id": i, "expansion_size": n} for i, n in enumerate((1, 99, 100, 259, None))], schema)
    monkeypatch.setattr(properties, "table", lambda spark, folder, name: ocod)
    for name in ("multi", "multi_lad", "region_class", "country"):
        assert [statistics.QUERIES[f"summarised_stats_{name}{end}"](spark, "").first().counts for end in ("", "_below_100")] == [5, 2]


def test_rolling_query_starts_with_the_sales(spark, monkeypatch):
    """Windows begin three years after the first sale, whenever that was."""
    from deedloom.queries import statistics

    days = [date(2019, 5, 7), date(2022, 4, 30), date(2022, 5, 1), date(2022, 5, 9), date(2022, 8, 1)]
    sales = spark.createDataFrame([(100 * (i + 1), d, "D", "A", "m1") for i, d in enumerate(days)], "price int, date_of_transfer date, property_type string, ppd_category_type string, msoa11cd string")
    monkeypatch.setattr(statistics, "table", lambda spark, folder, name: sales)
    got = {(r.snapshot_date, r.price_sum, r.n) for r in statistics.rolling_3y_window(spark, "").collect()}
    assert got == {(date(2022, 5, 1), 100 + 200 + 300, 3), (date(2022, 8, 1), 200 + 300 + 400 + 500, 4)}


def test_stream(spark, tmp_path):
    source, target, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    inputs = _pipeline_inputs(spark)
    snap = lambda m: spark.createDataFrame([("B", "F", "north", "c", "r", 1.0, "land at oak road, london", "JERSEY", date(2024, m, 1))], TITLES)
    run = lambda: stream_snapshots(spark, source, TITLES, target, marks, lambda df: run_pipeline(df, *inputs)).awaitTermination()
    snap(1).write.parquet(source)
    run()
    snap(2).write.mode("append").parquet(source)
    run()
    run()
    assert sorted(r.snapshot_date for r in spark.read.parquet(target).collect()) == [date(2024, 1, 1), date(2024, 2, 1)]


def test_groups_in_pieces_equal_whole_ones(spark):
    from pyspark.sql import Window

    from deedloom.plans import ordered

    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 1000 == 1, None).otherwise(F.concat(F.lit("k"), (F.col("id") % 5000).cast("string"))).alias("k"), F.xxhash64("id").alias("o"), "id", F.when(F.xxhash64(F.col("id") + 7) % 50 == 0, F.col("id")).alias("v"))
    assert ordered.with_buckets(df, "k", [F.col("o")])[0].where("k = 'hot'").select("_bucket").distinct().count() > 30
    by = Window.partitionBy("k").orderBy("o")
    want = df.select("id", F.row_number().over(by).alias("n"), (F.count(F.lit(1)).over(Window.partitionBy("k")) > 1).alias("m"), F.last("v", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0)).alias("v"))
    got = ordered.numbered(df, "k", [F.col("o")], "n", "m").select("id", "n", "m").join(ordered.filled_forward(df, "k", [F.col("o")], ["v"]).select("id", "v"), "id").select("id", "n", "m", "v")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_checkpoints_need_a_shared_folder_on_clusters():
    from types import SimpleNamespace

    from deedloom.plans.session import checkpoint_folder

    named, context = {}, SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None, setCheckpointDir=lambda d: named.setdefault("dir", d))
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d=None: named.get(k, d)))
    with pytest.raises(ValueError):
        checkpoint_folder(session)
    named["spark.checkpoint.dir"] = "hdfs://shared/cut"
    assert checkpoint_folder(session) == "hdfs://shared/cut" == named["dir"]


def test_spread_looks_at_operators_not_names(spark, tmp_path):
    """A path or column named like an operator changes nothing."""
    spark.range(8).coalesce(1).select(F.col("id").alias("Join")).write.parquet(str(tmp_path / "Sort"))
    assert spread(spark.read.parquet(str(tmp_path / "Sort"))).rdd.getNumPartitions() >= 2
    grouped = spark.range(8).groupBy("id").count()
    assert spread(grouped) is grouped


def test_evaluation_joins_and_error_texts(spark):
    """Null keys have no row, repeated ones pair, clashing columns get suffixes; the most frequent texts come first, ties by text."""
    from deedloom.operators.analytics import merged
    from deedloom.operators.quality import error_texts, truth_and_prediction

    truth = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), (None, "x", 3), ("c", None, 4)], "k string, class string, only int")
    guess = spark.createDataFrame([("a", "x"), ("b", "x"), (None, "y"), ("c", "z")], "k string, class string")
    got = truth_and_prediction(truth, guess, "k")
    assert got.columns == ["k", "class_truth", "only", "class_predicted"] and sorted(map(tuple, got.collect()), key=str) == [("a", "x", 1, "x"), ("a", "y", 2, "x"), ("c", None, 4, "z")]
    assert truth_and_prediction(truth.limit(0), guess, "k").collect() == []
    errors = spark.createDataFrame([(i, 0, 2, "l", "FN") for i in range(3)] + [(0, 3, 5, "l", "FN"), (9, 0, 1, "l", "FP")], "datapoint_id int, start int, end int, label string, error string")
    texts = spark.createDataFrame([(0, "ab cd"), (1, "ab"), (2, "zz"), (9, None)], "datapoint_id int, text string")
    assert [(r.error, r.text, r.n) for r in error_texts(errors, texts, 2).orderBy("error", F.desc("n"), "text").collect()] == [("FN", "ab", 2), ("FN", "cd", 1), ("FP", None, 1)]
    sides = [spark.createDataFrame(rows, f"k int, v{i} int") for i, rows in enumerate(([(1, 1), (2, 2), (None, 3)], [(1, 10)], [(2, 20)]))]
    assert sorted(map(tuple, merged(sides, ["k"], "left").collect()), key=str) == [(1, 1, 10, None), (2, 2, None, 20), (None, 3, None, None)]


def test_zipped_csv_round_trip(spark, tmp_path):
    """What is written comes back: quotes, delimiters and line ends in values, nulls, long texts; an empty table writes no archive."""
    from deedloom.sources.archives import read_dwellings, with_file_metadata
    from deedloom.sources.sinks import write_zipped_csv

    rows = [("a,b", 'say "x"'), ("two\nlines", None), ("é" * 200_000, "z")]
    df = spark.createDataFrame(rows, "a string, b string").coalesce(1)
    assert write_zipped_csv(df, str(tmp_path / "z"), name="OCOD_FULL_2031_02") == 1
    back = read_zipped_csv(spark, str(tmp_path / "z" / "*.zip"))
    assert sorted(((r.a, r.b) for r in back.collect()), key=str) == sorted(rows, key=str)
    assert {(r.filename.rsplit("-", 1)[0], str(r.snapshot_date)) for r in with_file_metadata(back, "file").collect()} == {("OCOD_FULL_2031_02", "2031-02-01")}
    assert write_zipped_csv(df.limit(0), str(tmp_path / "none")) == 0
    (tmp_path / "d.csv").write_text("msoa11cd,dwellings\nm1,3\nm1,4\n,9\nm2,many\n")
    assert [tuple(r) for r in read_dwellings(spark, str(tmp_path / "d.csv")).collect()] == [("m1", 7)]


def test_class_by_number_and_relabelled(spark):
    from deedloom.operators.classify import class_by_number, relabelled

    df = spark.createDataFrame([("unknown", "1"), ("unknown", None), ("land", "2"), (None, "3")], "class string, street_number string")
    got = relabelled(class_by_number(df), "class", {"residential": "domestic"})
    assert [r["class"] for r in got.collect()] == ["domestic", "unknown", "land", None]
