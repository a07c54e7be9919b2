"""Filling, packed values and snapshot changes, with the cases of their docstrings."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from deedloom.functions.values import folded, present
from deedloom.operators.fill import Gap, Level, fill_missing, missing_fills
from deedloom.operators.packed import packed_kind, packed_values, packs_places, split_packed
from deedloom.operators.snapshots import latest_rows, snapshot_changes
from deedloom.plans.sizes import hot_keys, salted_left_join

PACKED = {
    "Flats 1-5 (ODD), 12, Beacon House, 4 Wren Road, Town": ["1", "3", "5", "12"],
    "Units 1 & 2 & 4B; 6–8, Rush Mansions, 7 Linden Mews, Town, BA25 2EZ": ["1", "2", "4B", "6", "7", "8"],
    "Flats 1 , 'Gallery; East Wing' and \"Caretaker's Room\", 9, at 3 Wren Road, Town": ["1", "Gallery; East Wing", "Caretaker's Room", "9"],
    "Flats “Loft & Studio”; Flat 3 | 4, Oak Hall, 9-12 Wren Road, Town": ["Loft & Studio", "3", "4"],
    "Suites 1\n2-6 (evens)\n8, Coral Lodge, 112 Sorrel Road, Town": ["1", "2", "4", "6", "8"],
    "102, 104 to 106 (even), 110 and 111 Cinder Lane, Town": ["102", "104", "106", "110", "111"],
    "27 to 30 Cotter Bank Road, Town": ["27", "28", "29", "30"],
    "12 & 15 St Bredda's Street, Town": ["12", "15"],
    "Plots 26-28 of 16 Brook Road, Town": ["26", "27", "28"],
    "2 Oak Road, Town A (AA1 1AA) AND ALSO 18 Tin Way, Town B AND ALSO Flat 3, Elm House, 4-6 Fir Row, Town C": ["2", "18", "3"],
    '"49 Oak Street, Town (DA29 7JS)", "Flat F, Elm Mill, 50 Fir Road, Town"': ["49", "F"],
    "16 Oak Place, Town BA8 4HX; and 111, Cooper's Road, Town FA29 3XP": ["16", "111"],
    "Flats 1 & 2, 43-45 Foo Road, Town": ["1", "2"],
    "Flats 9-7, Elm House, Fir Road, Town": ["9", "8", "7"],
    # No more than one value.
    "Flat 50, 10, Mallow Road, Town": [],
    "Flat 12, 9 Foo Rd., Town": [],
    "Clover and Pebble Mansions, 112-116 St Bredda's Way, Town": [],
    "Apartment 10, Walnut Apartments, 18-21 Sedge Gardens, Town": [],
    "No. 103 Swallow Street, Town": [],
    "ba16  9jb,1 Cinder Terr,Town": [],
    "Land adjoining 20 Brook Street, Town": [],
    "": [],
    "   ": [],
    "Flats 1": [],
    "Units 7-7, Oak House": [],
}


def test_packed_values(spark):
    rows = spark.createDataFrame(list(enumerate(PACKED)), "i int, t string").select("t", packed_values(F.col("t")).alias("v")).collect()
    assert {r.t: r.v for r in rows} == PACKED


def test_packed_kinds(spark):
    texts = {"Flats 1, 2, Elm House": "units", "1, 2 Elm Road, T": "houses", "1 Elm Road, T | 2 Fir Road, T": "addresses", "1 Elm Road, T": None, None: None}
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", packed_kind(F.col("t")).alias("k"), packs_places(F.col("t")).alias("p")).collect()
    assert {r.t: r.k for r in rows} == texts
    assert all(r.p == (r.k in ("houses", "addresses")) for r in rows)


def test_split_packed_cases(spark):
    long_list = "Flats " + ", ".join(str(2 * i) for i in range(1, 4001)) + ", Elm House, 3 Fir Road, Town"
    schema = "title_number string, property_address string, pos string, _text string, val int"
    rows = [("A", "Flats 1, 2, Elm House", "x", "y", 1)] * 3 + [("L", long_list, None, None, None), ("N", None, None, None, None), ("E", "", None, None, None), (None, "Flats 3, 4, Elm House", None, None, None), ("H", "Flats 1-9999999999, 5, Elm House", None, None, None)]
    got = defaultdict(list)
    for r in sorted(split_packed(spark.createDataFrame(rows, schema), "title_number", "property_address").collect(), key=lambda r: r.pos):
        got[r.title_number].append((r.pos, r.val))
    assert got["A"] == [(1, "1"), (2, "2")]
    assert [v for _, v in got["L"]] == [str(2 * i) for i in range(1, 4001)]
    assert got[None] == [(1, "3"), (2, "4")]
    assert got["H"] == [(1, "1-9999999999"), (2, "5")]
    assert set(got) == {"A", "L", None, "H"}
    assert split_packed(spark.createDataFrame([], schema), "title_number", "property_address").collect() == []


def test_long_ranges_are_written_out(spark, tmp_path):
    """Ranges longer than a piece give every number, and count as packed."""
    from deedloom.queries.register import p5_found

    schema = "title_number string, property_address string"
    rows = [("A", "Flats 1-150000, Elm House"), ("B", "Flats 9, 1-200001 (odd), 200001-4 (even), 7, Elm House"), ("C", "Flats 3000000001-3000000003, Elm House"), ("D", "Flats 6-5 (odd), 4-4 (odd), Elm House")]
    df = spark.createDataFrame(rows, schema)
    df.write.parquet(str(tmp_path / "ocod.parquet"))
    got = defaultdict(list)
    for r in p5_found(spark, str(tmp_path)).collect():
        got[r.title_number].append((r.pos, r.val))
    want = {"A": range(1, 150_001), "B": [9, *range(1, 200_002, 2), *range(200_000, 3, -2), 7], "C": range(3_000_000_001, 3_000_000_004)}
    assert {k: sorted(v) for k, v in got.items()} == {k: [(i, str(n)) for i, n in enumerate(v, 1)] for k, v in want.items()}
    kinds = spark.createDataFrame([("1-150000 Elm Road, Town",), ("Flats 1-999999999, Elm House",)], "t string").select(packed_kind(F.col("t")).alias("k"), packs_places(F.col("t")).alias("p")).collect()
    assert [(r.k, r.p) for r in kinds] == [("houses", True), ("units", False)]


def _brute_units(text: str) -> list[str]:
    """A plain reading of 'Flats <list>, X House, ...' for random lists."""
    out = []
    for item in re.split(r"\s*(?:[,;&+|]|\band\b)\s*", text):
        m = re.match(r"(\d+)\s*(?:-|to)\s*(\d+)(.*)", item)
        if m:
            out += [str(n) for n in range(int(m[1]), int(m[2]) + 1) if not ("odd" in m[3] and n % 2 == 0) and not ("even" in m[3] and n % 2)]
        else:
            out.append(item)
    return out


def test_packed_against_brute_force(spark):
    import random

    rng, texts = random.Random(5), {}
    for _ in range(300):
        n, items = 0, []
        for _ in range(rng.randint(2, 12)):
            n += rng.randint(1, 4)
            if rng.random() < 0.4:
                last = n + rng.randint(1, 9)
                items.append(f"{n}{rng.choice(['-', ' - ', ' to '])}{last}{rng.choice(['', '', ' (odds)', ' (even numbers only)', ' odd nos'])}")
                n = last
            else:
                items.append(f"{n}{rng.choice(['', '', 'A'])}")
        listed = items[0] + "".join(rng.choice([", ", ",", "; ", " & ", " and ", " | ", " + "]) + x for x in items[1:])
        want = _brute_units(listed)
        texts[f"Flats {listed}, Elm House, 9-12 Fir Road, Town"] = want if len(want) > 1 else []
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", packed_values(F.col("t")).alias("v")).collect()
    assert {r.t: r.v for r in rows} == texts


SNAP = "title_number string, tenure string, country_incorporated string, snapshot_date date, loaded_at timestamp, _key string, sign int"


def _snap(rows):
    return [(t, a, c, date(2031, m, 1), datetime(2031, m, 1, h), "x", 9) for t, a, c, m, h in rows]


def test_snapshot_changes(spark):
    rows = _snap([
        ("a", "F", "X", 1, 1), ("A ", "f ", " x", 2, 1),  # the same
        ("b", "F", "X", 1, 1),  # removed
        ("c", "F", "X", 2, 1),  # added
        ("d", "F", None, 1, 1), ("d", "F", " ", 2, 1),  # null and blank are equal
        ("e", "F", None, 1, 1), ("e", "F", "X", 2, 1),  # null differs from a value
        ("f", "F", "X", 1, 1), ("f", "L", "Y", 2, 1), ("f", "F", "X", 2, 0),  # the later row counts
        ("g", "F", "X", 1, 1), ("g", "F", "X", 3, 1),  # away in between
        (None, "F", "X", 1, 1), ("  ", "F", "X", 1, 1),
        ("h", "F", "X", 1, 1), ("h", "F", "X", 1, 1), ("h", "F", "X", 2, 1),  # repeated
    ])
    df = spark.createDataFrame(rows, SNAP)
    got = {(str(r.snapshot), r.title_number): (r.change_kind, r.changed_fields) for r in snapshot_changes(df, "title_number", "snapshot_date", ["tenure", "country_incorporated"], "loaded_at").collect()}
    third = {("2031-03-01", k): ("removed", []) for k in "ACDEFH"}
    assert got == third | {
        ("2031-02-01", "B"): ("removed", []), ("2031-02-01", "C"): ("added", []), ("2031-02-01", "E"): ("changed", ["country_incorporated"]),
        ("2031-02-01", "F"): ("changed", ["country_incorporated", "tenure"]), ("2031-02-01", "G"): ("removed", []), ("2031-03-01", "G"): ("added", []),
    }


def test_snapshot_changes_few_snapshots(spark):
    one = spark.createDataFrame(_snap([("a", "F", "X", 1, 1)]), SNAP)
    assert snapshot_changes(one, "title_number", "snapshot_date", ["tenure"], "loaded_at").collect() == []
    assert snapshot_changes(one.limit(0), "title_number", "snapshot_date", ["tenure"], "loaded_at").collect() == []


def test_latest_rows_ties(spark):
    df = spark.createDataFrame([(1, None, "z"), (1, 5, "a"), (1, 5, "b"), (2, None, None)], "k int, at int, v string")
    assert {r.k: r.v for r in latest_rows(df, ["k"], "at", ["v"]).collect()} == {1: "b", 2: None}


GAPS = "id int, g1 string, g2 string, v string, key string, row_id string, value int"


def test_mode_fills(spark):
    rows = [(1, "a", "x", "p"), (2, "a", "x", "p"), (3, "a", "x", "q"), (4, "a", "x", None), (5, "b", "x", " N/A "), (6, "b", "x", "r"), (7, "b", "x", "s"), (8, None, "x", ""), (9, None, None, "unknown"), (10, "c", "y", "-")]
    df = spark.createDataFrame([(*r, "k", "r", 0) for r in rows], GAPS)
    gap = Gap("v", [Level("fine", F.col("g1")), Level("coarse", F.col("g2"))])
    got = {r.id: (r.v_filled, r.v_is_filled, r.v_fill_level) for r in fill_missing(df, gap, "id").collect()}
    assert got[4] == ("p", True, "fine")
    assert got[5] == ("p", True, "coarse")  # a tie in the fine group
    assert got[8] == ("p", True, "coarse")
    assert got[9] == (None, False, None) and got[10] == (None, False, None)
    assert got[1] == ("p", False, None)
    assert {"key", "row_id", "value"} <= set(fill_missing(df, gap, "id").columns)
    assert fill_missing(df.limit(0), gap, "id").count() == 0
    least = Gap("v", [Level("fine", F.col("g1"), 4), Level("coarse", F.col("g2"), 2)])
    assert {r.row_id: r.fill_level for r in missing_fills(df, [least], "id").collect()} == {4: "coarse", 5: "coarse", 8: "coarse"}


def test_median_fills(spark):
    df = spark.createDataFrame([(i, "a", float(x) if x is not None else None) for i, x in enumerate([1, 9, 3, None, 7])] + [(9, "b", None)], "id int, g string, v double")
    got = {r.id: (r.v_filled, r.v_is_filled) for r in fill_missing(df, Gap("v", [Level("g", F.col("g"))]), "id", "median").collect()}
    assert got[3] == (3.0, True) and got[9] == (None, False) and got[1] == (9.0, False)
    with pytest.raises(ValueError):
        missing_fills(df, [Gap("v", [Level("g", F.col("g"))])], "id", "mean")


def test_fills_of_a_hot_group(spark):
    df = spark.range(20_000).select(F.col("id").cast("int").alias("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 997).cast("string"))).alias("g"), F.when(F.col("id") % 7 != 0, "v").alias("v"))
    got = missing_fills(df, [Gap("v", [Level("g", F.col("g"))])], "id")
    assert got.count() == df.where("v is null").count() and got.where("fill_value <> 'v'").count() == 0


def test_salted_join_equals_plain(spark):
    left = spark.range(5000).select("id", F.when(F.col("id") % 4 == 0, "hot").when(F.col("id") % 4 == 1, None).otherwise(F.col("id").cast("string")).alias("k"))
    right = spark.createDataFrame([("hot", 1), ("2", 2), ("nobody", 3)], "k string, w int")
    hot = hot_keys(left, "k", 0.1)
    assert [r.k for r in hot.collect()] == ["hot"]
    plain = Counter((r.id, r.w) for r in left.join(right, "k", "left").collect())
    assert Counter((r.id, r.w) for r in salted_left_join(left, right, "k", F.col("id"), hot, 8).collect()) == plain


def test_value_readings(spark):
    df = spark.createDataFrame([(" a ",), ("N/a",), ("\t",), (None,), ("none",), (" ",)], "v string")
    assert [r.p for r in df.select(present(F.col("v")).alias("p")).collect()][:5] == ["a", None, None, None, None]
    assert [r.p for r in df.select(folded(F.col("v")).alias("p")).collect()][:4] == ["A", "N/A", None, None]
