"""Queries p1, p2, p4 and p7 to p9, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deedloom.llm.canonical import OTHER_NAMES, map_to_list
from deedloom.llm.leaks import cleaned_texts, leaked_spans
from deedloom.llm.linkage import business_premises, link_premises, register_premises
from deedloom.llm.quality import text_kinds, text_statistics, train_kinds
from deedloom.llm.same_place import same_place_pairs, same_places, title_addresses
from deedloom.llm.tokens import encode_texts
from deedloom.plans.sizes import hot_keys, salted_left_join, small


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _countries(spark: SparkSession, folder: str) -> DataFrame:
    return map_to_list(table(spark, folder, "ocod"), "country_incorporated", table(spark, folder, "country_list"), "country_code", ["country_name", "alt_name"], OTHER_NAMES)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Records whose country isn't spelt as in the list; those that are, a good part, go before anything is joined by value."""
    names = table(spark, folder, "country_list").select(F.col("country_name").alias("value")).where(F.col("value").isNotNull()).distinct()
    typed = table(spark, folder, "ocod").select("ocod_id", F.col("country_incorporated").alias("value")).join(small(names), "value", "left_anti").where(F.trim(F.regexp_replace("value", r"\s+", " ")) != "")
    mapped = salted_left_join(typed, _countries(spark, folder), "value", F.col("ocod_id"), hot_keys(typed, "value"))
    return mapped.select("ocod_id", F.col("entry").alias("country_code")).distinct()


def p1_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    """Typed values that mean no listed country, with how many records carry them."""
    none = _countries(spark, folder).where(F.col("entry") == "NONE")
    counts = table(spark, folder, "ocod").select("ocod_id", F.col("country_incorporated").alias("value")).distinct().groupBy("value").agg(F.count(F.lit(1)).alias("n_records"))
    return none.join(counts, "value").select("value", "n_records")


def p2_links(spark: SparkSession, folder: str) -> DataFrame:
    """The matches of p2_found with their confidence."""
    links = link_premises(register_premises(table(spark, folder, "ocod")), business_premises(table(spark, folder, "voa_register")))
    return links.select(F.col("left_id").alias("ocod_id"), F.col("right_id").alias("voa_id"), "confidence")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return p2_links(spark, folder).select("ocod_id", "voa_id")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return same_place_pairs(title_addresses(table(spark, folder, "ocod")), "title_number").select(F.col("a").alias("title_a"), F.col("b").alias("title_b"))


def p4_places(spark: SparkSession, folder: str) -> DataFrame:
    """Each title with the place it belongs to; titles whose address names no place have a null one."""
    members, _ = same_places(title_addresses(table(spark, folder, "ocod")), "title_number")
    return members.select("title_number", "place")


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode_texts(table(spark, folder, "documents"), "doc_id", "text")


def _spans(spark: SparkSession, folder: str) -> DataFrame:
    return leaked_spans(table(spark, folder, "documents"), "doc_id", "text", table(spark, folder, "eval_items"), "item_id", "text")


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return _spans(spark, folder).select("doc_id", "item_id").distinct()


def p8_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """The documents without their leaked spans; mostly leaked ones are dropped."""
    return cleaned_texts(table(spark, folder, "documents"), "doc_id", "text", table(spark, folder, "eval_items"), "item_id", "text")


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = train_kinds(docs, "doc_id", "text", table(spark, folder, "doc_labels"))
    return text_kinds(docs, "doc_id", "text", model).where(F.col("text_kind") != "prose").select("doc_id", "text_kind")


def p9_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return text_statistics(table(spark, folder, "documents"), "doc_id", "text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_unmatched": p1_unmatched,
    "p2_found": p2_found,
    "p2_links": p2_links,
    "p4_found": p4_found,
    "p4_places": p4_places,
    "p7_ids": p7_ids,
    "p8_found": p8_found,
    "p8_cleaned": p8_cleaned,
    "p9_found": p9_found,
    "p9_statistics": p9_statistics,
}

ORACLE: dict[str, str] = {
    "p9_statistics": r"""WITH common AS (
  SELECT word FROM (SELECT doc_id, unnest(list_distinct(list_filter(regexp_extract_all(text, '[\pL]+'), lambda w: w = lower(w)))) AS word FROM documents)
  GROUP BY word ORDER BY count(*) DESC, word LIMIT 150
), known AS (SELECT list(word) AS ws FROM common), parts AS (
  SELECT doc_id, text, regexp_extract_all(lower(text), '[\pL]+') AS words,
    list_filter(regexp_split_to_array(text, '\r\n|\r|\n'), lambda x: regexp_matches(x, '[\pL\pN]')) AS lines
  FROM documents
)
SELECT doc_id, CAST(len(words) AS INTEGER) AS n_words,
  CASE WHEN len(words) > 0 THEN CAST(length(array_to_string(words, '')) AS DOUBLE) / len(words) END AS mean_word_length,
  CASE WHEN length(text) > 0 THEN CAST(length(regexp_replace(text, '[\pL\pN\s]', '', 'g')) AS DOUBLE) / length(text) END AS symbol_ratio,
  CASE WHEN length(text) > 0 THEN CAST(length(regexp_replace(text, '[^0-9]', '', 'g')) AS DOUBLE) / length(text) END AS digit_ratio,
  CASE WHEN len(lines) > 0 THEN CAST(len(list_filter(lines, lambda x: regexp_matches(x, '[.!?:…]["''”’)\]]*\s*$'))) AS DOUBLE) / len(lines) END AS stopped_line_ratio,
  CASE WHEN len(words) > 0 THEN CAST(len(list_filter(words, lambda w: list_contains(ws, w))) AS DOUBLE) / len(words) END AS common_word_ratio
FROM parts, known""",
}
