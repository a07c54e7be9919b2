"""How well predicted classes and spans agree with true ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _or_zero(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _scores(tp: Column, predicted: Column, actual: Column) -> dict[str, Column]:
    p, r = _or_zero(tp, predicted), _or_zero(tp, actual)
    return {"precision": p, "recall": r, "f1": _or_zero(2 * p * r, p + r)}


def confusion(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, label, tp, n_predicted, n_actual) of each label that occurs as true or predicted; rows with a null on a side count on the other."""
    t = df.select(*by, F.col(truth).alias("label"), F.lit(1).alias("a"), F.lit(0).alias("p"), (F.col(truth) == F.col(predicted)).cast("int").alias("tp"))
    p = df.select(*by, F.col(predicted).alias("label"), F.lit(0).alias("a"), F.lit(1).alias("p"), F.lit(0).alias("tp"))
    return t.unionByName(p).where(F.col("label").isNotNull()).groupBy(*by, "label").agg(F.coalesce(F.sum("tp"), F.lit(0)).alias("tp"), F.sum("p").alias("n_predicted"), F.sum("a").alias("n_actual"))


def classification_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """(label, precision, recall, f1, support): each class, then accuracy, macro avg and weighted avg; what is undefined is 0."""
    rows = confusion(df, truth, predicted)
    each = rows.select("label", *[c.alias(n) for n, c in _scores(F.col("tp"), F.col("n_predicted"), F.col("n_actual")).items()], F.col("n_actual").alias("support"), "tp")
    total = F.sum("support")
    accuracy = each.agg(_or_zero(F.sum("tp"), total).alias("x"), total.alias("support")).select(F.lit("accuracy").alias("label"), *[F.col("x").alias(n) for n in ("precision", "recall", "f1")], "support")
    macro = each.agg(*[F.coalesce(F.avg(n), F.lit(0.0)).alias(n) for n in ("precision", "recall", "f1")], total.alias("support")).select(F.lit("macro avg").alias("label"), "precision", "recall", "f1", "support")
    weighted = each.agg(*[_or_zero(F.sum(F.col(n) * F.col("support")), total).alias(n) for n in ("precision", "recall", "f1")], total.alias("support")).select(F.lit("weighted avg").alias("label"), "precision", "recall", "f1", "support")
    return each.drop("tp").unionByName(accuracy).unionByName(macro).unionByName(weighted)


def performance_by_rule(df: DataFrame, truth: str, predicted: str, rule: str = "matched_rule") -> DataFrame:
    """(rule, n, accuracy, precision, recall, f1): by rule, scores weighted by support."""
    rows = confusion(df, truth, predicted, [rule])
    each = rows.select(rule, *[c.alias(n) for n, c in _scores(F.col("tp"), F.col("n_predicted"), F.col("n_actual")).items()], "n_actual", "tp")
    return each.groupBy(rule).agg(F.sum("n_actual").alias("n"), _or_zero(F.sum("tp"), F.sum("n_actual")).alias("accuracy"), *[_or_zero(F.sum(F.col(n) * F.col("n_actual")), F.sum("n_actual")).alias(n) for n in ("precision", "recall", "f1")])


def span_scores(truth: DataFrame, predicted: DataFrame, per_text: bool = False, by_label: bool = True) -> DataFrame:
    """Precision, recall and f1 of spans (datapoint_id, start, end, label) that must agree in all parts.

    By default spans are pooled: equal offsets and labels of different texts are one span. ``per_text`` keeps texts apart.
    Rows by label, and with label ``overall``.
    """
    parts = [*(["datapoint_id"] if per_text else []), "start", "end", "label"]
    t, p = truth.select(*parts).distinct().withColumn("_t", F.lit(1)), predicted.select(*parts).distinct().withColumn("_p", F.lit(1))
    both = t.join(p, parts, "full").select("label", F.coalesce("_t", F.lit(0)).alias("t"), F.coalesce("_p", F.lit(0)).alias("p"))
    sums = [F.sum(F.col("t") * F.col("p")).alias("tp"), F.sum("p").alias("n_predicted"), F.sum("t").alias("n_actual")]
    overall = both.agg(*[F.coalesce(s, F.lit(0)).alias(n) for s, n in zip([F.sum(F.col("t") * F.col("p")), F.sum("p"), F.sum("t")], ("tp", "n_predicted", "n_actual"))]).withColumn("label", F.lit("overall"))
    rows = both.groupBy("label").agg(*sums).unionByName(overall) if by_label else overall
    return rows.select("label", "tp", (F.col("n_predicted") - F.col("tp")).alias("fp"), (F.col("n_actual") - F.col("tp")).alias("fn"), *[c.alias(n) for n, c in _scores(F.col("tp"), F.col("n_predicted"), F.col("n_actual")).items()])


def diagnose_class(truth: DataFrame, predicted: DataFrame, label: str) -> DataFrame:
    """(text, outcome) of each text that has spans of a label on a side: correct, incorrect, missing or false_positive.

    truth and predicted have text and spans; of several rows with a text the one with the greatest spans counts.
    """
    held = lambda df, name: df.groupBy("text").agg(F.max("spans").alias("_s")).select("text", F.array_sort(F.array_distinct(F.transform(F.filter("_s", lambda s: s["label"] == label), lambda s: F.struct(s["start"], s["end"])))).alias(name))
    both = held(truth, "_t").join(held(predicted, "_p"), "text").where((F.size("_t") > 0) | (F.size("_p") > 0))
    return both.select("text", F.when(F.size("_p") == 0, "missing").when(F.size("_t") == 0, "false_positive").when(F.col("_t") == F.col("_p"), "correct").otherwise("incorrect").alias("outcome"))


def span_errors(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """(datapoint_id, start, end, label, error): spans of one side only, as FN (true) and FP (predicted)."""
    parts = ["datapoint_id", "start", "end", "label"]
    t, p = truth.select(*parts).distinct(), predicted.select(*parts).distinct()
    return t.join(p, parts, "left_anti").withColumn("error", F.lit("FN")).unionByName(p.join(t, parts, "left_anti").withColumn("error", F.lit("FP")))


def bio_labels(tokens: Column, spans: Column) -> Column:
    """ARRAY<STRING>: for tokens (start, end) the label O, or B-/I- and the label of the span that holds it; special tokens (start = end) have null.

    The first token in a span begins it; a token belongs to the first span it overlaps.
    """
    holder = lambda t: F.try_element_at(F.filter(spans, lambda s: (t["start"] < s["end"]) & (t["end"] > s["start"])), F.lit(1))
    first = lambda t, s: ~F.exists(tokens, lambda o: (o["start"] < t["start"]) & (o["start"] < o["end"]) & (o["start"] < s["end"]) & (o["end"] > s["start"]))

    def one(t: Column) -> Column:
        s = holder(t)
        return F.when(t["start"] >= t["end"], F.lit(None).cast("string")).when(s.isNull(), "O").otherwise(F.concat(F.when(first(t, s), "B-").otherwise("I-"), s["label"]))

    return F.transform(tokens, one)


def bio_spans(labels: Column) -> Column:
    """ARRAY<STRUCT<start, end, label>> of runs in BIO labels, by token position; an I- that continues nothing begins a run."""
    start = F.struct(F.array().cast("array<struct<start:int,end:int,label:string>>").alias("done"), F.lit(0).alias("at"))

    def step(acc: Column, x: Column) -> Column:
        kind, label, at = F.substring(x, 1, 2), F.substring(x, 3, 1000), acc["at"]
        last = F.try_element_at(acc["done"], F.lit(-1))
        goes_on = (kind == "I-") & last.isNotNull() & (last["end"] == at) & (last["label"] == label)
        grown = F.concat(F.slice(acc["done"], 1, F.greatest(F.size(acc["done"]) - 1, F.lit(0))), F.array(F.struct(last["start"].alias("start"), (at + 1).alias("end"), label.alias("label"))))
        begun = F.concat(acc["done"], F.array(F.struct(at.alias("start"), (at + 1).alias("end"), label.alias("label"))))
        done = F.when(F.coalesce(goes_on, F.lit(False)), grown).when(F.coalesce(kind.isin("B-", "I-"), F.lit(False)), begun).otherwise(acc["done"])
        return F.struct(done.alias("done"), (at + 1).alias("at"))

    return F.aggregate(labels, start, step, lambda acc: acc["done"])


def truth_and_prediction(truth: DataFrame, predicted: DataFrame, key: str, suffixes: tuple[str, str] = ("_truth", "_predicted")) -> DataFrame:
    """Rows of both sides with equal keys, side by side; columns that both have get the suffixes. Null keys and keys of one side have no row; repeated ones pair."""
    both = set(truth.columns) & set(predicted.columns) - {key}
    named = lambda df, end: df.select(key, *[F.col(f"`{c}`").alias(c + end if c in both else c) for c in df.columns if c != key])
    return named(truth, suffixes[0]).join(named(predicted, suffixes[1]), key)


def error_texts(errors: DataFrame, texts: DataFrame, n: int = 10) -> DataFrame:
    """(label, error, text, n): what the wrong or missed spans of span_errors say, the ``n`` most frequent (ties by text) of each label and error.

    texts: (datapoint_id, text). Offsets count from 0. Counts are combined before they are ranked.
    """
    said = errors.join(texts.select("datapoint_id", F.col("text").alias("_t")), "datapoint_id").select("label", "error", F.substr(F.col("_t"), F.col("start") + 1, F.col("end") - F.col("start")).alias("text"))
    counts = said.groupBy("label", "error", "text").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("_k", F.row_number().over(Window.partitionBy("label", "error").orderBy(F.desc("n"), "text"))).where(F.col("_k") <= n).drop("_k")
