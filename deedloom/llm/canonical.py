"""Mapping of freely typed values to the entries of a reference list."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deedloom.functions.values import NO_VALUE, let, squeezed
from deedloom.plans.session import cut
from deedloom.plans.sizes import small

#: An entry is a candidate if it shares n-grams of at least this share of the value's weight.
LOOK = 0.12
#: Weighted cosine from which the best entry is accepted, and by how much it must exceed the next one's.
ACCEPT, MARGIN = 0.55, 0.02
#: Letters up to so many places apart make a gapped bigram; each further place weighs by FADE. Single letters weigh by SINGLE.
REACH, FADE, SINGLE = 4, 0.6, 0.7
#: Power of the logarithm by which rare n-grams weigh more.
RARITY = 0.6
#: Weight of forms made of other names than the main one, and of cut-off names (the more is left, the nearer to the latter).
OTHER, CUT, CUT_LEAST = 0.95, 0.9, 0.75

# Words that say nothing about which entry is meant.
IDLE_WORDS = ("A", "COMPANY", "CORPORATION", "IN", "INCORPORATED", "LAW", "LAWS", "OF", "REGISTERED", "REP", "REPUBLIC", "SAR", "STATE", "STATES", "KINGDOM", "THE", "UNDER")
# Words that say that no entry is meant, where nothing but idle words stands beside them.
NO_ENTRY_WORDS = ("ABROAD", "FOREIGN", "OFFSHORE", "OTHER", "OVERSEAS", "VARIOUS")
# Digits typed for letters.
DIGITS = {"0": "O", "1": "I", "3": "E", "4": "A", "5": "S"}
# A word and its usual short form, one word each.
SHORT_WORDS = {"SAINT": "ST"}
# Words that tell two entries apart however alike the rest is.
OPPOSITES = (("NORTH", "SOUTH"), ("EAST", "WEST"))
# What some countries call themselves or are called, by code.
OTHER_NAMES = {
    "AE": ("Emirates",), "AT": ("Oesterreich", "Osterreich"), "BE": ("Belgique", "Belgie"), "BR": ("Brasil",), "CH": ("Schweiz", "Suisse", "Svizzera", "Swiss"),
    "CN": ("People's Republic of China",), "DE": ("Deutschland",), "DK": ("Danmark",), "ES": ("Espana",), "FI": ("Suomi",), "GR": ("Hellas",), "HU": ("Magyarorszag",), "IT": ("Italia",),
    "JP": ("Nippon",), "KR": ("Korea South",), "KY": ("Caymans",), "LU": ("Luxemburg",), "NL": ("Nederland",), "NO": ("Norge",), "PL": ("Polska",), "SE": ("Sverige",), "US": ("United States", "America"),
}


def normal(c: Column) -> Column:
    """Upper case, accents off, digits between letters as letters, anything else as single blanks."""
    accented, plain = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝŽŠ", "AAAAAACEEEEIIIINOOOOOOUUUUYZS"
    bare = F.translate(F.upper(c), accented, plain)
    lettered = bare
    for digit, letter in DIGITS.items():
        lettered = F.regexp_replace(lettered, rf"(?<=[A-Z]){digit}|{digit}(?=[0-9]?[A-Z])", letter)
    dotless = F.regexp_replace(F.regexp_replace(lettered, r"&", " AND "), r"(?<=\b[A-Z])\.(?=[A-Z]\b)", "")
    return F.trim(F.regexp_replace(dotless, r"[^A-Z0-9]+", " "))


def _parts(c: Column) -> Column:
    """The whole value and the parts between its marks, each normalised and without idle words, distinct."""
    parts = F.concat(F.array(c), F.split(c, r"[,;:()\[\]/]|\s[-–]\s"))
    # Without idle words unless nothing else is there.
    idle = F.array(*map(F.lit, IDLE_WORDS))

    def clean(x: Column) -> Column:
        words = F.split(normal(x), " ")
        kept = F.filter(words, lambda w: ~F.array_contains(idle, w))
        return F.array_join(F.when(F.size(kept) > 0, kept).otherwise(words), " ")

    return F.array_distinct(F.filter(F.concat(F.transform(parts, normal), F.transform(parts, clean)), lambda x: x != ""))


def _grams(c: Column) -> Column:
    """Character bigrams and trigrams of the words (padded, so word order doesn't count) and of the value without blanks."""
    def cut(text: Column, n: int) -> Column:
        return F.when(F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1))), lambda i: F.substr(text, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))

    words = F.transform(F.split(c, " "), lambda w: F.concat(F.lit("^"), w, F.lit("$")))
    by_word = F.flatten(F.transform(words, lambda w: F.concat(cut(w, 2), cut(w, 3))))
    joined = F.concat(F.lit("^"), F.replace(c, F.lit(" "), F.lit("")), F.lit("$"))
    return F.array_distinct(F.concat(F.transform(by_word, lambda g: F.concat(F.lit("w"), g)), F.transform(F.concat(cut(joined, 2), cut(joined, 3)), lambda g: F.concat(F.lit("j"), g))))


def _whole_forms(name: Column) -> Column:
    """What a name may be written as in whole: normalised, without idle words, with usual short forms; with initials for all or the first words."""
    idle = F.array(*map(F.lit, IDLE_WORDS))

    def short(words: Column) -> Column:
        full = F.create_map(*[F.lit(x) for pair in SHORT_WORDS.items() for x in pair])
        return F.transform(words, lambda w: F.coalesce(F.try_element_at(full, w), w))

    def kept(words: Column) -> Column:
        left = F.filter(words, lambda w: ~F.array_contains(idle, w))
        return F.when(F.size(left) > 0, left).otherwise(words)

    def written(words: Column) -> Column:
        firsts = F.transform(words, lambda w: F.substring(w, 1, 1))
        some = F.when(F.size(words) > 1, F.sequence(F.lit(1), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))
        rest = lambda m: F.array_join(F.slice(words, m + 1, F.size(words)), " ")
        first_words = F.flatten(F.transform(some, lambda m: F.array(F.concat_ws(" ", F.array_join(F.slice(firsts, 1, m), ""), rest(m)), F.concat_ws(" ", F.array_join(F.slice(firsts, 1, m), " "), rest(m)))))
        initials = F.when(F.size(words) >= 3, F.array(F.array_join(firsts, ""))).otherwise(F.array().cast("array<string>"))
        return F.concat(F.array(F.array_join(words, " ")), initials, first_words)

    return let(F.split(normal(name), " "), lambda words: let(F.array(words, kept(words), short(words)), lambda ways: F.array_distinct(F.flatten(F.transform(ways, written)))))


def _forms(entries: DataFrame, entry: str, names: list[str], other_names: dict[str, tuple[str, ...]] | None) -> DataFrame:
    """(entry, form, weight, whole, base): what each entry may be written as, and the name that it is made of. What names may be cut to is shared evenly by the entries that have it."""
    given = [F.struct(F.col(n).alias("name"), F.lit(1.0 if i == 0 else OTHER).alias("weight")) for i, n in enumerate(names)]
    named = entries.select(F.col(entry).alias("entry"), F.explode(F.array(*given)).alias("n")).select("entry", "n.*")
    if other_names:
        more = entries.sparkSession.createDataFrame([(k, n, OTHER) for k, ns in other_names.items() for n in ns], "entry string, name string, weight double")
        named = named.unionByName(more.join(entries.select(F.col(entry).alias("entry")).distinct(), "entry", "left_semi"))
    named = named.where(normal(F.col("name")) != "")
    whole = named.select("entry", "weight", normal(F.col("name")).alias("base"), F.explode(_whole_forms(F.col("name"))).alias("form")).where(F.length("form") > 2)
    letters = lambda c: F.length(F.replace(c, F.lit(" "), F.lit("")))
    bases = named.select("entry", "weight", F.explode(F.array_distinct(F.array(normal(F.col("name")), F.element_at(_parts(F.col("name")), -1), *[F.regexp_replace(normal(F.col("name")), rf"\b{w}\b", s) for w, s in SHORT_WORDS.items()]))).alias("base"))
    ends = F.when(F.length("base") > 3, F.sequence(F.lit(3), F.length("base") - 1)).otherwise(F.array().cast("array<int>"))
    cuts = bases.select("entry", "weight", "base", F.explode(F.transform(ends, lambda i: F.rtrim(F.substr(F.col("base"), F.lit(1), i)))).alias("form")).where((letters(F.col("form")) < letters(F.col("base"))) & (F.length("form") > 2))
    cuts = cuts.select("entry", "form", (F.col("weight") * CUT * (CUT_LEAST + (1 - CUT_LEAST) * letters(F.col("form")) / letters(F.col("base")))).alias("weight"), F.col("weight").alias("rank"), "base")
    cuts = cuts.groupBy("entry", "form").agg(F.max(F.struct("rank", "weight", "base")).alias("m")).select("entry", "form", "m.*")
    # What main names and other names may be cut to means the main names; entries with the same claim weigh the same.
    by_form = Window.partitionBy("form")
    cuts = cuts.withColumn("top", F.max("rank").over(by_form)).where(F.col("rank") == F.col("top")).withColumn("weight", F.max("weight").over(by_form)).select("entry", "form", "weight", "base")
    both = whole.withColumn("whole", F.lit(True)).unionByName(cuts.withColumn("whole", F.lit(False)))
    return both.groupBy("entry", "form").agg(F.max("weight").alias("weight"), F.max("whole").alias("whole"), F.max("base").alias("base"))


_SIGNS = {c: i for i, c in enumerate("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789^$")}
#: Numbers of n-grams of one kind: gapped bigrams and single letters. There are two kinds: by word, and of the text without blanks.
_KIND = len(_SIGNS) ** 2 + len(_SIGNS)


def _vector(text: str) -> np.ndarray:
    """Gapped bigrams and letters of the words (padded, so their order doesn't count), and of the text without blanks, in two rows."""
    out = np.zeros((2, _KIND), dtype=np.float32)
    for kind, pieces in enumerate((text.split(" "), [text.replace(" ", "")])):
        for piece in pieces:
            signs = np.array([_SIGNS[c] for c in f"^{piece}$"])
            for gap in range(1, min(REACH, len(signs) - 1) + 1):
                np.add.at(out[kind], signs[:-gap] * len(_SIGNS) + signs[gap:], FADE ** (gap - 1))
            np.add.at(out[kind], len(_SIGNS) ** 2 + signs[1:-1], SINGLE)
    return out


def _vectors(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """(texts, 2, n-grams): weighted vectors of length 1."""
    out = np.stack([_vector(t) for t in texts]) * weights
    return out / np.maximum(np.sqrt((out**2).sum(2, keepdims=True)), 1e-9)


def _says(texts: list[str]) -> np.ndarray:
    """(texts, words): whether each text has each word of OPPOSITES, those of a pair beside each other."""
    return np.array([[w in words for pair in OPPOSITES for w in pair] for words in (set(t.split(" ")) for t in texts)])


def _opposed(values: np.ndarray, names: np.ndarray) -> np.ndarray:
    """(values, names): whether a name says the opposite of what a value says, by their _says."""
    other = names.reshape(len(names), -1, 2)[:, :, ::-1].reshape(len(names), -1)
    return values.astype(int) @ other.T.astype(int) > 0


def _entry_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        counts = np.zeros(2 * _KIND, dtype=np.int64)
        for forms in b["forms"]:
            counts += (sum(_vector(f["form"]) for f in forms) > 0).ravel()
        held = np.flatnonzero(counts)
        yield pd.DataFrame({"gram": held, "n": counts[held]})


def cosine(value: str, form: str, weights: np.ndarray | None = None) -> float:
    """Weighted cosine of two normalised texts: the better of that by words and that without blanks; 0 if they name opposites."""
    w = np.ones((2, _KIND), dtype=np.float32) if weights is None else weights
    a, b = _vectors([value, form], w)
    return 0.0 if _opposed(_says([value]), _says([form])).any() else float((a * b).sum(1).max())


def map_to_list(values: DataFrame, value: str, entries: DataFrame, entry: str, names: list[str], other_names: dict[str, tuple[str, ...]] | None = None, unmatched: str = "NONE") -> DataFrame:
    """(value, entry, score): each distinct value with the entry it means, or ``unmatched`` where none is meant.

    Method: distinct values are normalised and cut into parts at their marks. Candidates of a part come from an inverted
    index of the entries' character n-grams (bigrams and trigrams), weighted by how few entries have them. Each candidate's
    score is the weighted cosine of the part and the nearest form of the entry, over character n-grams with gaps, so that
    slips, swaps and shortened words leave most of them. Forms are the entry's names, with and without idle words, with
    initials or usual short forms, or cut off; other forms than the main name weigh a little less. An entry is accepted if
    its score is at least ACCEPT and leads the next entry's by MARGIN. Codes of two letters, which have no n-grams to speak
    of, count if they equal a part. One exact check follows: opposites (north, south) are never the same.

    ``names`` are the columns of entries with their names, the main one first; null names are left out.

    Cases: null and blank values have no row. Values that equal a name match it whatever else is alike. Words for no value
    or no entry are unmatched. Without any entries all values are unmatched. Repeated values and entries count once. Other
    columns are ignored. Letters other than A to Z (with accents) and digits are blanks.

    Scale: values are made distinct before anything else, and their parts once more; the index and the forms are broadcast
    only if a check finds them small. Scores are products of matrices in Arrow batches. To the driver come the counts of
    at most 2 * _KIND n-grams.
    """
    spark = values.sparkSession
    cores = spark.sparkContext.defaultParallelism
    distinct = values.select(F.col(value).alias("value")).where(F.trim(F.regexp_replace("value", r"\s+", " ")) != "").groupBy("value").agg(F.lit(1).alias("_")).select("value")
    nothing = F.array(*map(F.lit, (*NO_ENTRY_WORDS, *IDLE_WORDS)))
    says_none = squeezed(F.col("value")).isin(*NO_VALUE) | (F.exists(F.split(normal(F.col("value")), " "), lambda w: F.array_contains(F.array(*map(F.lit, NO_ENTRY_WORDS)), w)) & F.forall(F.split(normal(F.col("value")), " "), lambda w: F.array_contains(nothing, w)))
    # Few and short, but each is cut into many n-grams: they are dealt out over all cores.
    asked = cut(distinct.select("value", F.when(says_none, F.array().cast("array<string>")).otherwise(_parts(F.col("value"))).alias("parts")).repartition(cores, "value"))
    forms = cut(_forms(entries, entry, names, other_names))
    listed = forms.groupBy("entry").agg(F.collect_list(F.struct("form", "weight", "whole", "base")).alias("forms"))
    n_entries = forms.select("entry").distinct().count()
    rarity = np.full(2 * _KIND, np.log1p(max(1, n_entries)) ** RARITY, dtype=np.float32)
    for r in listed.mapInPandas(_entry_counts, "gram int, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        rarity[r.gram] = np.log1p(n_entries / r.n) ** RARITY
    weights = rarity.reshape(2, _KIND)

    # Candidates: n-grams of the distinct parts meet those of the entries.
    index = forms.select("entry", F.explode(_grams(F.col("form"))).alias("gram")).distinct()
    weighted = index.join(index.groupBy("gram").agg(F.log1p(F.lit(float(n_entries)) / F.count(F.lit(1))).alias("w")), "gram")
    index = cut(weighted.groupBy("gram", "w").agg(F.collect_list("entry").alias("entries")))
    parts = asked.select(F.explode("parts").alias("part")).distinct().repartition(cores, "part")
    grams = parts.select("part", F.explode(_grams(F.col("part"))).alias("gram")).join(small(index), "gram", "left")
    # A gram that no entry has weighs like one that a single entry has.
    totals = grams.groupBy("part").agg(F.sum(F.coalesce("w", F.lit(float(np.log1p(max(1, n_entries)))))).alias("total"), F.collect_list(F.struct("w", "entries")).alias("hits"))
    shared = totals.select("part", "total", F.explode("hits").alias("h")).select("part", "total", "h.w", F.explode("h.entries").alias("entry")).groupBy("part", "total", "entry").agg(F.sum("w").alias("w"))
    candidates = shared.where(F.col("w") >= LOOK * F.col("total")).select("part", "entry")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for at in range(0, len(whole), 2000):
                b = whole.iloc[at : at + 2000]
                which, texts = pd.factorize(b["part"])
                of_parts, says = _vectors(list(texts), weights), _says(list(texts))
                score, equal = np.zeros(len(b)), np.zeros(len(b), dtype=bool)
                for rows in b.groupby("entry").indices.values():
                    held = b["forms"].iloc[rows[0]]
                    names_ = [f["form"] for f in held]
                    # Of the two kinds of n-grams the better counts.
                    alike = np.maximum(*(of_parts[which[rows], k] @ _vectors(names_, weights)[:, k].T for k in (0, 1))) * np.array([f["weight"] for f in held])
                    alike[_opposed(says[which[rows]], _says([f["base"] for f in held]))] = 0
                    score[rows] = alike.max(1)
                    equal[rows] = [any(f["whole"] and f["form"] == t for f in held) for t in texts[which[rows]]]
                yield pd.DataFrame({"part": b["part"], "entry": b["entry"], "score": score, "equal": equal})

    scored = candidates.join(small(listed), "entry").select("part", "entry", "forms").mapInPandas(run, "part string, entry string, score double, equal boolean")
    codes = entries.select(F.col(entry).alias("entry"), F.upper(F.trim(entry)).alias("part")).where(F.length("part") <= 2).distinct().select("part", "entry", F.lit(0.97).cast("double").alias("score"), F.lit(True).alias("equal"))
    by_part = scored.where(F.col("score") > 0).unionByName(codes)
    found = asked.select("value", F.posexplode("parts").alias("at", "part")).join(by_part, "part")
    best = found.groupBy("value", "entry").agg(F.max(F.col("score") - F.when(F.col("at") > 0, 0.01).otherwise(0.0)).alias("score"), F.max((F.col("at") == 0) & F.col("equal")).alias("equal"))
    order = Window.partitionBy("value").orderBy(F.desc("equal"), F.desc("score"), "entry")
    first = best.withColumns({"place": F.row_number().over(order), "next": F.lead("score").over(order), "next_equal": F.lead("equal").over(order)}).where(F.col("place") == 1)
    clear = F.col("next").isNull() | (F.col("score") - F.col("next") >= MARGIN) | (F.col("equal") & ~F.col("next_equal"))
    taken = first.where((F.col("score") >= ACCEPT) & clear).select(F.col("value").alias("_v"), "entry", F.round("score", 6).alias("score"))
    return asked.join(taken, F.col("value") == F.col("_v"), "left").select("value", F.coalesce("entry", F.lit(unmatched)).alias("entry"), F.coalesce("score", F.lit(0.0)).alias("score"))
