"""What kind of text a text is: statistics as columns, weak labels by rules of form, and boosted trees on statistics of form."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deedloom.llm.boosting import BoostedTrees, Calibration
from deedloom.llm.forms import NAMES, batch_statistics, word_hashes
from deedloom.plans.session import cut
from deedloom.plans.sizes import spread

KINDS = ("prose", "list", "table", "junk")
#: Texts on which the trees are trained (those whose ids have the least hashes), and hand-checked ones for calibration.
TRAIN_TEXTS, HOLDOUT_TEXTS = 12_000, 5_000
#: Words that count as common: so many, by how many texts hold them.
COMMON_WORDS = 150
#: Share of a text's characters from which the rules of form label it for training.
CLEAR = 0.6

# --- Per-text statistics as Columns -------------------------------------------------------------------------------


def text_words(c: Column) -> Column:
    """Runs of letters, in lower case."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+)"), F.lit(1))


def _written_words(c: Column) -> Column:
    """Words that a text writes in lower case; null for null."""
    return F.filter(F.regexp_extract_all(c, F.lit(r"(\p{L}+)"), F.lit(1)), lambda w: w == F.lower(w))


def common_words(df: DataFrame, text: str, n: int = COMMON_WORDS) -> list[str]:
    """The n words that most texts hold in lower case (ties: in alphabetical order), over all texts; n words come to the driver."""
    words = df.select(F.explode(F.array_distinct(_written_words(F.col(text)))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return [r.word for r in words.orderBy(F.desc("n"), "word").limit(n).collect()]


def text_statistics(df: DataFrame, row_id: str, text: str, common: list[str] | None = None) -> DataFrame:
    """(<row_id>, n_words, mean_word_length, symbol_ratio, digit_ratio, stopped_line_ratio, common_word_ratio) of each text.

    Words are runs of letters. Symbols are characters that are neither letters, digits nor blanks; ratios are of all
    characters, lines (of those with a letter or digit, how many end in a full stop, question or exclamation mark, colon
    or ellipsis, closing quotes and brackets aside) and words (how many are common).

    Cases: null text has null statistics; a text without words, lines or characters has 0 words and null for what would
    be divided by 0. Repeated ids come as often. Other columns are ignored; an empty table gives an empty table.

    All of it is computed in the JVM in one pass; ``common`` (by default the COMMON_WORDS words that most texts hold)
    takes one more.
    """
    common = common_words(df, text) if common is None else common
    c = F.col("_text")
    lines = F.filter(F.split(c, r"\r\n|\r|\n"), lambda x: x.rlike(r"[\p{L}\p{N}]"))
    stopped = F.filter(lines, lambda x: x.rlike(r"[.!?:…][\"'”’)\]]*\s*$"))
    words = F.col("_words")
    known = F.array(*map(F.lit, common)) if common else F.array().cast("array<string>")
    is_common = F.filter(words, lambda w: F.array_contains(known, w))
    rows = df.select(F.col(row_id).alias("_id"), F.col(text).alias("_text")).withColumn("_words", text_words(F.col("_text")))
    share = lambda part, whole: F.try_divide(part.cast("double"), whole.cast("double"))
    return rows.select(
        F.col("_id").alias(row_id), F.when(c.isNotNull(), F.size(words)).alias("n_words"),
        share(F.length(F.array_join(words, "")), F.size(words)).alias("mean_word_length"),
        share(F.length(F.regexp_replace(c, r"[\p{L}\p{N}\s]", "")), F.length(c)).alias("symbol_ratio"),
        share(F.length(F.regexp_replace(c, r"[^0-9]", "")), F.length(c)).alias("digit_ratio"),
        F.when(c.isNotNull(), share(F.size(stopped), F.size(lines))).alias("stopped_line_ratio"),
        F.when(c.isNotNull(), share(F.size(is_common), F.size(words))).alias("common_word_ratio"),
    )


# --- Weak labels: rules of form on lines -----------------------------------------------------------------------------------

_TOKEN = re.compile(r"\S+")
_LETTERS = re.compile(r"[^\W\d_]+")
_AMOUNT = re.compile(r"[£$€]\s?\d{1,3}(?:,\d{3})+")
_BULLET = re.compile(r"^\s*(?:[-*•–—·▪◦‣+]\s+|\[[ xX]?\]\s|\(?(?:\d{1,3}|[a-zA-Z]|[ivxIVX]{1,5})[.)]\s+)")
_RULE = re.compile(r"^[\s|+=¦:*_-]{4,}$")
_HTML = re.compile(r"</?[a-zA-Z][^<>]{0,80}>|&[a-z]{2,6};|\{\{.{0,20}?\}\}")
_MOJIBAKE = re.compile(r"[ÃÂ][\x80-\xbf¡-¿]|�|â€|[¤§¶][a-z]|[a-z][¤§¶]")
_VOWELS = frozenset("aeiouyàâäéèêëîïôöùûüœæáíóúŵŷåøAEIOUYÀÂÄÉÈÊËÎÏÔÖÙÛÜŒÆÁÍÓÚŴŶÅØ")
_HEX = re.compile(r"(?=[a-fA-F]*[0-9])[0-9a-fA-F]+")
# Words, phrases and marks of page furniture.
_FURNITURE_WORDS = frozenset(("about", "cookie", "cookies", "help", "home", "login", "menu", "next", "prev", "print", "privacy", "search", "share", "sitemap", "subscribe", "terms", "tweet"))
_FURNITURE_PHRASES = ("all rights reserved", "back to top", "contact us", "follow us", "log in", "sign in", "skip to", "©", "«", "»")
_SPLIT_RUN = re.compile(r"\s*(?:[;|¦•·•]|\s/\s|,\s)\s*")
_GAP = re.compile(r"\S\s{2,}\S")
_PARTED = re.compile(r"[\t|¦*]|,(?!\s)")
_SYMBOL = re.compile(r"[^\w\s]|_")
#: Marks that may part columns; a comma only where no blank follows.
_DELIMITERS = "\t|¦*,;~^"
_COMMA = re.compile(r",(?!\s)")


def _furniture(text: str, words: list[str]) -> int:
    """How many words and phrases of page furniture a text has."""
    lower = text.lower()
    return sum(w in _FURNITURE_WORDS for w in map(str.lower, words)) + sum(map(lower.count, _FURNITURE_PHRASES))


def _marks(line: str, mark: str) -> int:
    return len(_COMMA.findall(line)) if mark == "," else line.count(mark)


def _mojibake(text: str) -> int:
    return 0 if text.isascii() else len(_MOJIBAKE.findall(text))


def _markup(text: str) -> int:
    """Characters in tags, entities and placeholders."""
    return sum(map(len, _HTML.findall(text))) if "<" in text or "&" in text or "{{" in text else 0


def _junk_share(text: str, tokens: list[str], found: list[str]) -> float:
    """How surely a piece of text, of these tokens and words, is garbled, encoded, repeated or page furniture, from 0 to 1."""
    n = len(text)
    if n == 0 or not tokens:
        return 0.0
    if _mojibake(text) * 40 > n or _markup(text) * 3 > n:
        return 1.0
    if sum(map(len, found)) * 3 < n and len(_SYMBOL.findall(text)) * 5 > 2 * n:
        return 1.0
    if len(tokens) >= 8 and sum(1 for t in tokens if len(t) == 1) > 0.7 * len(tokens):
        return 1.0
    if sum(len(t) for t in tokens if len(t) >= 32) * 2 > n:
        return 1.0
    if len(tokens) >= 8 and sum(1 for t in tokens if len(t) in (2, 4, 8, 16, 32) and _HEX.fullmatch(t)) > 0.6 * len(tokens):
        return 1.0
    # The same few words over and over, looked at through a window: longer texts repeat words anyway.
    lower = [t.lower() for t in tokens]
    windows = [lower[i : i + 40] for i in range(0, len(lower), 40)]
    if len(tokens) >= 12 and sum(len(set(w)) for w in windows) < 0.3 * len(tokens):
        return 1.0
    if len(tokens) >= 8:
        furniture = _furniture(text, found)
        if furniture >= 5 and furniture > 0.15 * len(tokens):
            return 1.0
    words = [w for w in found if len(w) > 1 and (len(w) > 4 or not w.isupper())]
    if len(words) >= 8 and sum(1 for w in words if _VOWELS.isdisjoint(w)) > 0.5 * len(words):
        return 1.0
    return 0.0


def _told(words: list[str]) -> float:
    """Share of words that begin in lower case: high in sentences, low in names and codes."""
    return sum(1 for w in words if w[0].islower()) / len(words) if words else 0.0


def _is_sentence(line: str, words: list[str], common: frozenset[str]) -> bool:
    if len(words) < 6:
        return False
    if len(_PARTED.findall(line)) >= 0.4 * len(words):
        return False
    if line.isupper():
        return sum(1 for w in words if w.lower() in common) >= 0.3 * len(words)
    return _told(words) >= 0.5


def _unwrapped(lines: list[str], common: frozenset[str]) -> list[str]:
    """Lines with those put together that only a line width keeps apart: each is as long as the next one's first word lets it."""
    out, i = [], 0
    while i < len(lines):
        width, least, j = len(lines[i]), 1 << 60, i
        while j + 1 < len(lines) and not _BULLET.match(lines[j + 1]):
            longer, room = max(width, len(lines[j + 1])), min(least, len(lines[j]) + 1 + len(lines[j + 1].split(None, 1)[0]))
            if room <= longer:
                break
            width, least, j = longer, room, j + 1
        whole = " ".join(lines[i : j + 1])
        if j > i and width >= 25 and _is_sentence(whole, _LETTERS.findall(whole), common):
            out.append(whole)
            i = j + 1
        else:
            out.append(lines[i])
            i += 1
    return out


def line_kinds(text: str, common: frozenset[str]) -> dict[str, float]:
    """Shares of a text's characters in lines (or, in one long line, pieces) of each kind, by rules of form."""
    lines = [x for x in (re.sub(r"^[>\s]+|\s+$", "", x) for x in re.split(r"\r\n|\r|\n", text)) if x]
    lines = _unwrapped(lines, common)
    # Amounts hold commas that part nothing.
    plain = [_AMOUNT.sub("1", x) for x in lines]
    total = sum(map(len, lines)) or 1
    share = dict.fromkeys(KINDS, 0.0)
    words = [_LETTERS.findall(x) for x in lines]
    sentence = [_is_sentence(x, w, common) for x, w in zip(lines, words)]
    # Delimiters that several lines hold equally often make a table.
    columns = []
    for d in _DELIMITERS:
        if d not in text:
            continue
        counts = [0 if s else _marks(x, d) for x, s in zip(plain, sentence)]
        often = Counter(c for c in counts if c >= 1).most_common(1)
        if often and often[0][1] >= 3 and (often[0][0] >= 2 or d in "\t|¦"):
            columns.append((often[0][0], counts))
    # Short lines that are no sentences, three at least in a row, make a list.
    runs = [False] * len(lines)
    i = 0
    while i < len(lines):
        j = i
        while j < len(lines) and (_BULLET.match(lines[j]) or (len(lines[j]) <= 100 and not sentence[j])):
            j += 1
        for k in range(i, j):
            runs[k] = j - i >= 3
        i = max(j, i + 1)
    # Columns that blanks keep apart may have empty cells, so the number of gaps varies.
    gaps = [not s and bool(_GAP.search(x)) for x, s in zip(lines, sentence)]
    spaced = sum(gaps) >= 3 and sum(gaps) >= 0.6 * sum(not s for s in sentence)
    same = Counter(lines)
    for i, x in enumerate(lines):
        tokens = _TOKEN.findall(x)
        in_columns = (spaced and gaps[i]) or any(counts[i] > 0 and abs(counts[i] - often) <= (1 if often > 3 else 0) for often, counts in columns)
        if same[x] >= 5 and same[x] >= 0.2 * len(lines):
            kind = "junk"
        elif _RULE.match(x) and len(lines) > 2:
            kind = "table"
        elif _junk_share(x, tokens, words[i]) > 0.5 and not (in_columns and len(x) < 300 and not _HTML.search(x) and not _MOJIBAKE.search(x)):
            kind = "junk"
        elif in_columns:
            kind = "table"
        elif _BULLET.match(x) and len(lines) > 1:
            kind = "list"
        elif runs[i]:
            kind = "list"
        else:
            kind = "prose"
            parts = [p for p in _SPLIT_RUN.split(x) if p]
            if len(parts) >= 6:
                short = sum(len(p) for p in parts if len(p) <= 40)
                if short > 0.8 * sum(map(len, parts)) and _told(words[i]) < 0.4:
                    kind = "list"
        share[kind] += len(x) / total
    return share


def weak_kind(shares: dict[str, float]) -> int:
    """The kind that clearly prevails by the rules of form, or -1; for training only."""
    top = max(KINDS, key=shares.__getitem__)
    return KINDS.index(top) if shares[top] >= CLEAR else -1


class KindModel:
    """Trees, calibration and the common words they were made with."""

    def __init__(self, trees: BoostedTrees, calibration: Calibration, common: list[str]):
        self.trees, self.calibration, self.common = trees, calibration, common

    def probabilities(self, texts: list[str]) -> np.ndarray:
        return self.calibration.probabilities(self.trees.scores(batch_statistics(texts, word_hashes(self.common))))


def _words_and_sample(docs: DataFrame, doc_id: str, text: str, marked: DataFrame) -> DataFrame:
    """(word, kind, text, n) in one reading of the texts: words with how many texts hold them, and the marked texts (word null).

    Both are groups of one aggregation, so the texts are read and shuffled once; equal marked texts of a kind are one row.
    """
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(marked.select(F.col("id").alias("_id"), "kind")), "_id", "left").where(F.col("_text") != "")
    none = F.lit(None).cast("string")
    words = F.transform(F.array_distinct(_written_words(F.col("_text"))), lambda w: F.struct(w.alias("word"), none.alias("kind"), none.alias("text")))
    sample = F.when(F.col("kind").isNotNull(), F.array(F.struct(none.alias("word"), F.col("kind").alias("kind"), F.col("_text").alias("text")))).otherwise(F.array().cast("array<struct<word:string,kind:string,text:string>>"))
    return rows.select(F.explode(F.concat(words, sample)).alias("e")).groupBy("e.word", "e.kind", "e.text").agg(F.count(F.lit(1)).alias("n"))


#: The kind of marked texts that are to be labelled weakly.
_WEAK = "weak"


def train_kinds(docs: DataFrame, doc_id: str, text: str, labels: DataFrame | None = None, kind: str = "text_kind", train_texts: int = TRAIN_TEXTS, holdout_texts: int = HOLDOUT_TEXTS) -> KindModel:
    """A model of text kinds: trees on weakly labelled texts, probabilities calibrated on hand-checked ones.

    Weak labels come from rules of form on the lines (line_kinds); texts on which they are unclear take no part. The rules
    see the texts of the sample only, and what they find is no feature: the trees learn from the statistics of
    batch_statistics. They are trained on the ``train_texts`` texts whose ids have the least hashes, and calibrated on at
    most ``holdout_texts`` hand-checked ones (chosen likewise, and never trained on); what comes to the driver are so many
    rows of statistics, not texts. The common words are counted over all texts, in the same pass.
    """
    by_hash = docs.select(F.col(doc_id).alias("id")).where(F.col("id").isNotNull()).distinct().orderBy(F.xxhash64("id"), "id").limit(train_texts).withColumn("kind", F.lit(_WEAK))
    if labels is not None:
        held = labels.select(F.col(doc_id).alias("id"), F.col(kind).alias("kind")).where(F.col("kind").isin(*KINDS)).groupBy("id").agg(F.min("kind").alias("kind")).orderBy(F.xxhash64("id"), "id").limit(holdout_texts)
        # Both sides are bounded by the limits above.
        by_hash = by_hash.join(F.broadcast(held.select("id")), "id", "left_anti").unionByName(held)
    counted = cut(_words_and_sample(docs, doc_id, text, by_hash))
    common = [r.word for r in counted.where(F.col("word").isNotNull()).orderBy(F.desc("n"), "word").limit(COMMON_WORDS).collect()]
    known, hashes = frozenset(common), word_hashes(common)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            kinds = [KINDS[k] if (k := weak_kind(line_kinds(t, known))) >= 0 else "" for t in b["text"][b["kind"] == _WEAK]]
            b.loc[b["kind"] == _WEAK, "kind"] = [f"{_WEAK} {k}" for k in kinds]
            yield pd.DataFrame({"kind": b["kind"], "x": list(batch_statistics(b["text"].tolist(), hashes))})

    sample = counted.where(F.col("word").isNull()).select("kind", "text")
    cores = docs.sparkSession.sparkContext.defaultParallelism
    rows = sorted((r.kind, list(r.x)) for r in sample.repartition(cores).mapInPandas(run, "kind string, x array<double>").collect())
    weak = [(x, KINDS.index(k.removeprefix(f"{_WEAK} "))) for k, x in rows if k.startswith(_WEAK) and k != f"{_WEAK} "] or [([0.0] * len(NAMES), 0)]
    trees = BoostedTrees(len(KINDS)).fit(np.array([x for x, _ in weak]), np.array([y for _, y in weak]))
    hand = [(x, KINDS.index(k)) for k, x in rows if k in KINDS]
    calibration = Calibration()
    if hand:
        calibration.fit(trees.scores(np.array([x for x, _ in hand])), np.array([y for _, y in hand]))
    return KindModel(trees, calibration, common)


def text_kinds(docs: DataFrame, doc_id: str, text: str, model: KindModel) -> DataFrame:
    """(<doc_id>, text_kind, probability) of each text that is neither null nor empty: the likeliest kind by the trees.

    Cases: repeated ids come as often; blank texts are judged like any other (their statistics are those of no words).
    The whole text counts, however long. Other columns are ignored; an empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where(F.col("text").isNotNull() & (F.col("text") != ""))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                p = shared.value.probabilities(b["text"].tolist())
                best = p.argmax(1)
                yield pd.DataFrame({"id": b["id"], "kind": [KINDS[k] for k in best], "probability": p[np.arange(len(p)), best]})

    return spread(rows).mapInPandas(run, f"id {dict(rows.dtypes)['id']}, kind string, probability double").select(F.col("id").alias(doc_id), F.col("kind").alias("text_kind"), "probability")
