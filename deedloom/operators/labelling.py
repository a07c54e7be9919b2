"""Labelled spans in address texts: rules, span operations and labellers."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deedloom.functions import label_patterns as patterns
from deedloom.functions.text import commercial_park_tag, flat_tag
from deedloom.plans.sizes import spread

SPANS = "array<struct<text:string,start:int,end:int,label:string,function:string,ord:int>>"

#: A user's rule: from a text, spans as (start, end, label).
SpanFunction = Callable[[str], Iterable[tuple[int, int, str]]]


@dataclass(frozen=True)
class SpanRule:
    """A labelling rule: a pattern, or a function of the text; ``applies`` is always, flat, not flat or not park."""

    name: str
    label: str = ""
    pattern: str = ""
    ignore_case: bool = True
    group: int = 0
    applies: str = "always"
    first_only: bool = False
    found_in_match: bool = False
    function: SpanFunction | None = field(default=None)

    def compiled(self) -> Callable[[str], Iterable[tuple[int, int, str]]]:
        if self.function:
            return self.function
        find = re.compile(self.pattern, re.IGNORECASE if self.ignore_case else 0)

        def spans(text: str) -> Iterator[tuple[int, int, str]]:
            for m in find.finditer(text):
                start, end = m.span(self.group)
                if self.found_in_match:
                    start = m.start() + m.group(0).find(m.group(self.group))
                    end = start + len(m.group(self.group))
                yield start, end, self.label
                if self.first_only:
                    return

        return spans


#: The default rules, in the order that decides between spans of one length.
DEFAULT_RULES = tuple(SpanRule(name, label, pattern, case, group, applies, name in patterns.FIRST_ONLY, name in patterns.FOUND_IN_MATCH) for name, label, pattern, case, group, applies in patterns.RULES)
#: Those that find names of buildings.
BUILDING_RULES = DEFAULT_RULES[:7]


def label_spans(text: Column, rules: Sequence[SpanRule] = DEFAULT_RULES) -> Column:
    """ARRAY of spans (text, start, end, label, function, ord) that the rules find, in the order of the rules.

    Null is an empty text. A rule that raises on a text gives no spans there; the others go on. Offsets count
    characters, from 0, end exclusive.

    The rules need offsets and look-around that the JVM's functions don't give, so they run in Python, once for each
    Arrow batch.
    """
    rules = tuple(rules)

    @F.pandas_udf(SPANS)
    def run(texts: pd.Series, flats: pd.Series, parks: pd.Series) -> pd.Series:
        ready = [(r.name, r.applies, r.compiled()) for r in rules]
        out = []
        for t, flat, park in zip(texts, flats, parks):
            t, spans = t or "", []
            for name, applies, find in ready:
                if applies == "flat" and not flat or applies == "not flat" and flat or applies == "not park" and park:
                    continue
                try:
                    found = [(t[a:b], a, b, label, name) for a, b, label in find(t)]
                except Exception:  # noqa: BLE001  a rule's failure is the rule's alone
                    continue
                spans += found
            out.append([(*s, i) for i, s in enumerate(spans)])
        return pd.Series([[dict(zip(("text", "start", "end", "label", "function", "ord"), s)) for s in spans] for spans in out])

    return run(text, flat_tag(text), commercial_park_tag(text))


def with_spans_of(df: DataFrame, text: str = "property_address", rules: Sequence[SpanRule] = DEFAULT_RULES) -> DataFrame:
    """df with flat_tag, commercial_park_tag and the labelled spans of a text."""
    return df.withColumns({"flat_tag": flat_tag(F.col(text)), "commercial_park_tag": commercial_park_tag(F.col(text)), "spans": label_spans(F.col(text), rules)})


def without_empty(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["start"] < s["end"])


def without_overlaps(spans: Column) -> Column:
    """Spans that overlap no longer one (of equal length: no earlier one), by start. One span or none stays as it is."""
    by_length = F.array_sort(spans, lambda a, b: F.when(a["end"] - a["start"] != b["end"] - b["start"], (b["end"] - b["start"]) - (a["end"] - a["start"])).otherwise(a["ord"] - b["ord"]))
    clear = lambda s, kept: ~F.exists(kept, lambda k: (s["end"] > k["start"]) & (k["end"] > s["start"]))
    kept = F.aggregate(by_length, F.array().cast(SPANS), lambda acc, s: F.when(clear(s, acc), F.concat(acc, F.array(s))).otherwise(acc))
    # Of spans with one start all but one are empty; the longer comes first.
    in_text = F.array_sort(kept, lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).when(a["end"] != b["end"], b["end"] - a["end"]).otherwise(a["ord"] - b["ord"]))
    return F.when(F.size(spans) > 1, in_text).otherwise(spans)


def exploded_spans(df: DataFrame, row_id: str, spans: str = "spans", address: str = "property_address") -> DataFrame:
    """(datapoint_id, start, end, text, label, property_address): one row a span."""
    return df.select(F.col(row_id).alias("datapoint_id"), F.explode(spans).alias("_s"), F.col(address).alias("property_address")).select("datapoint_id", "_s.start", "_s.end", "_s.text", "_s.label", "property_address")


def standard_spans(spans: Column) -> Column:
    """Distinct (start, end, label) of the spans that aren't empty, the first of each kept in place."""
    return F.array_distinct(F.transform(without_empty(spans), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["label"].alias("label"))))


def overlap_statistics(df: DataFrame, spans: str = "spans") -> DataFrame:
    """One row: n_rows, rows_with_overlaps, pct_with_overlaps, spans_before, spans_removed, spans_after; shares of nothing are null."""
    by_start = F.array_sort(F.col("_s"), lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["ord"] - b["ord"]))
    touching = F.exists(F.arrays_zip(F.slice("_t", 1, F.greatest(F.size("_t") - 1, F.lit(0))).alias("a"), F.slice("_t", 2, F.greatest(F.size("_t") - 1, F.lit(0))).alias("b")), lambda p: p["a"]["end"] > p["b"]["start"])
    rows = df.select(F.col(spans).alias("_s")).withColumn("_t", by_start).select(touching.alias("_o"), F.size("_s").alias("_before"), F.size(without_overlaps(F.col("_s"))).alias("_after"))
    out = rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("_o").alias("rows_with_overlaps"), F.coalesce(F.sum("_before"), F.lit(0)).alias("spans_before"), F.coalesce(F.sum("_after"), F.lit(0)).alias("spans_after"))
    return out.select("n_rows", "rows_with_overlaps", F.try_divide(100.0 * F.col("rows_with_overlaps"), F.col("n_rows")).alias("pct_with_overlaps"), "spans_before", (F.col("spans_before") - F.col("spans_after")).alias("spans_removed"), "spans_after")


class Labeller(Protocol):
    """A labelling engine: made once for each Python worker, given texts in batches, gives (start, end, label, confidence) spans."""

    def __call__(self, texts: list[str]) -> list[list[tuple[int, int, str, float]]]: ...


class RuleLabeller:
    """The default engine: the rules without overlaps and empty spans, each with confidence 1."""

    def __init__(self, rules: Sequence[SpanRule] = DEFAULT_RULES):
        from deedloom.functions.text import FLAT_WORDS, PARK_WORDS

        self.rules = [(r.applies, r.compiled()) for r in rules]
        self.flat, self.park = re.compile(FLAT_WORDS), re.compile(PARK_WORDS)

    def __call__(self, texts: list[str]) -> list[list[tuple[int, int, str, float]]]:
        out = []
        for t in texts:
            flat, park = bool(self.flat.search(t)), bool(self.park.search(t))
            found = [s for applies, find in self.rules if not (applies == "flat" and not flat or applies == "not flat" and flat or applies == "not park" and park) for s in find(t)]
            kept: list[tuple[int, int, str]] = []
            for s in sorted(found, key=lambda s: s[0] - s[1]):
                if all(s[1] <= k[0] or k[1] <= s[0] for k in kept):
                    kept.append(s)
            out.append([(a, b, label, 1.0) for a, b, label in sorted(kept) if a < b])
        return out


ENTITIES = "array<struct<type:string,text:string,start:int,end:int,confidence:double>>"


def label_entities(df: DataFrame, row_id: str, text: str, make: Callable[[], Labeller] = RuleLabeller, batch: int = 512) -> DataFrame:
    """(<row_id>, original_address, entities): labelled entities of each text by an engine that ``make`` builds in the worker.

    Null is an empty text, which has no entities. Texts go to the engine ``batch`` at a time, the shortest of an Arrow batch
    first, so that a model pads little; rows come back in their order.
    """
    kind = dict(df.dtypes)[row_id]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        engine = make()
        for b in batches:
            texts = [t or "" for t in b["text"]]
            order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
            found: list[list] = [[] for _ in texts]
            for k in range(0, len(order), batch):
                some = order[k : k + batch]
                for i, spans in zip(some, engine([texts[i] for i in some])):
                    found[i] = [{"type": label, "text": texts[i][a:e], "start": a, "end": e, "confidence": float(c)} for a, e, label, c in spans]
            yield pd.DataFrame({"id": b["id"], "original_address": texts, "entities": found})

    return spread(df.select(F.col(row_id).alias("id"), F.col(text).alias("text"))).mapInPandas(run, f"id {kind}, original_address string, entities {ENTITIES}").withColumnRenamed("id", row_id)


def components_by_type(entities: Column) -> Column:
    """MAP<type, ARRAY<text>> of entities, texts in order."""
    types = F.array_distinct(F.transform(entities, lambda e: e["type"]))
    return F.map_from_entries(F.transform(types, lambda t: F.struct(t, F.transform(F.filter(entities, lambda e: e["type"] == t), lambda e: e["text"]))))


def labelling_summary(df: DataFrame) -> DataFrame:
    """One row: total, successful (at least one entity), failed, success_rate (0 without rows)."""
    out = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.size("entities") > 0).alias("successful"))
    return out.select("total", "successful", (F.col("total") - F.col("successful")).alias("failed"), F.coalesce(F.try_divide(F.col("successful"), F.col("total")), F.lit(0.0)).alias("success_rate"))
