"""Putting labelled entities of a text together to addresses."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds of entities from the widest to the narrowest; a unit_type is attached to units.
LEVELS = ("city", "postcode", "street_name", "street_number", "building_name", "number_filter", "unit_id")
PARTS = ("unit_type", "unit_id", "number_filter", "building_name", "street_number", "street_name", "postcode", "city")
#: Characters between a unit and its number filter at most, and between a unit's type and the unit at most.
FILTER_REACH, TYPE_REACH = 15, 29

ADDRESSES = "array<struct<" + ",".join(f"{p}:string" for p in PARTS) + ">>"


def assemble(entities: list[dict]) -> list[dict[str, str | None]]:
    """Addresses of one text from its entities (type, text, start, end), as dicts of PARTS; raises KeyError on another type.

    Entities form trees: the parts of an address stand before what contains them, so an entity's container is the nearest
    one to its right among those of the next wider kind that occurs, else of still wider ones; a city contains whatever
    finds no nearer container. A number filter belongs to a unit before it only if it is near and no other unit stands
    between. Each entity that contains nothing is the end of one address, which is the chain of its containers. A unit
    takes the nearest unit type before it, if that is near.
    """
    rank = {kind: i for i, kind in enumerate(LEVELS)}
    inner = [e for e in entities if e["type"] != "unit_type"]
    nodes = sorted(inner, key=lambda e: (rank[e["type"]], e["start"]))
    kinds = sorted({rank[e["type"]] for e in nodes})
    cities = [e for e in inner if e["type"] == "city"]
    units = [e for e in nodes if e["type"] == "unit_id"]
    parent: dict[int, dict | None] = {}

    def gap(child: dict, holder: dict) -> int | None:
        if holder["type"] == "city":
            return 0
        if child["start"] >= holder["start"]:
            return None
        away = holder["start"] - child["end"]
        if child["type"] == "unit_id" and holder["type"] == "number_filter" and (away > FILTER_REACH or any(child["end"] < u["start"] < holder["start"] for u in units if u is not child)):
            return None
        return away

    for e in nodes:
        at = kinds.index(rank[e["type"]])
        parent[id(e)] = None
        for wider in range(at - 1, -1, -1):
            held = [(g, k) for k, h in enumerate(nodes) if rank[h["type"]] == kinds[wider] and (g := gap(e, h)) is not None]
            if held:
                best = nodes[min(held)[1]]
                # Reached as the last resort, the text's last city is the container.
                parent[id(e)] = cities[-1] if best["type"] == "city" and wider < at - 1 else best
                break
    holders = {id(p) for p in parent.values() if p is not None}
    types = [e for e in entities if e["type"] == "unit_type"]
    out = []
    for e in nodes:
        if id(e) in holders:
            continue
        address: dict[str, str | None] = dict.fromkeys(PARTS)
        step: dict | None = e
        while step is not None:
            address[step["type"]] = step["text"].strip()
            if step["type"] == "unit_id":
                near = [(step["start"] - t["end"], k) for k, t in enumerate(types) if t["start"] < step["start"] and step["start"] - t["end"] <= TYPE_REACH]
                if near:
                    address["unit_type"] = types[min(near)[1]]["text"].strip()
            step = parent[id(step)]
        out.append(address)
    return out


def _assembled(entities: pd.Series) -> pd.Series:
    def one(found):  # noqa: ANN001, ANN202
        try:
            return assemble([dict(e) for e in found]) if found is not None else []
        except KeyError:
            return []

    return pd.Series([one(e) for e in entities])


def assembled(entities: Column) -> Column:
    """ARRAY of addresses of a text's entities; empty for none, null, or an entity of unknown type."""
    _assembled.__annotations__ = {"entities": pd.Series, "return": pd.Series}
    return F.pandas_udf(_assembled, ADDRESSES)(entities)


def addresses_of(df: DataFrame, row_id: str = "datapoint_id", entities: str = "entities", keep: tuple[str, ...] = ()) -> DataFrame:
    """(<row_id>, leaf_pos, PARTS, kept columns): one row an address; texts without any have no row. The columns are always these."""
    rows = df.select(row_id, *keep, F.posexplode(assembled(F.col(entities))).alias("leaf_pos", "_a"))
    return rows.select(row_id, "leaf_pos", *[f"_a.{p}" for p in PARTS], *keep)


def describe_trees(entities: list[dict]) -> str:
    """The addresses of one text, one a line, for looking at."""
    return "\n".join(" > ".join(f"{k}={v}" for k, v in reversed(list(a.items())) if v is not None) for a in assemble(entities))
