"""Held-out evaluation texts that have slipped, wholly or in part, into a corpus."""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words in a row from which a match counts.
LEAST_WORDS = 12
#: Words of test items that one automaton takes; more items are taken in several passes, so none is left out.
WORDS_A_PASS = 500_000

# Zero-width characters and soft hyphens, which neither separate nor join words.
INVISIBLE = "­​‌‍‎‏⁠﻿"
_GONE = re.compile(f"[{INVISIBLE}]")
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters and digits after NFKC, lower case and removal of invisible characters."""
    if not text:
        return []
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    return _WORD.findall(text if text.isascii() else _GONE.sub("", text))


class ItemAutomaton:
    """Generalised suffix automaton of word sequences: each state stands for word runs that end at the same places."""

    def __init__(self, items: Iterable[tuple[int, list[str]]], least: int):
        self.least = least
        self.number: dict[str, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, ends = [-1], [0], [set()]
        for item, words in items:
            last = 0
            for w in words:
                last = self._extend(last, self.number.setdefault(w, len(self.number)), ends)
                ends[last].add(item)
        # Items of a state are those of all states linked to it, so they are handed up from the longest.
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.length[self.link[s]] >= least:
                ends[self.link[s]] |= ends[s]
        # The state of the last ``least`` words, for each state that is long enough.
        self.core = [0] * len(self.link)
        for s in sorted(range(len(self.link)), key=self.length.__getitem__):
            if self.length[s] >= least:
                self.core[s] = s if self.length[self.link[s]] < least else self.core[self.link[s]]
        # Many states have the same items; each set is kept once.
        sets: dict[frozenset[int], int] = {}
        self.held = array("i", [-1]) * len(self.link)
        for s in set(self.core):
            if s:
                self.held[s] = sets.setdefault(frozenset(ends[s]), len(sets))
        self.sets = list(sets)
        self._pack()

    def _pack(self) -> None:
        """Most states go on by one word only: these are kept in arrays, and a dict is kept for the others. An automaton that is sent around is a fraction of its size."""
        one = [next(iter(d.items())) if len(d) == 1 else (-1, 0) for d in self.next]
        self.word, self.to = array("i", [w for w, _ in one]), array("i", [t for _, t in one])
        self.more = {s: d for s, d in enumerate(self.next) if len(d) > 1}
        self.link, self.length, self.core = array("i", self.link), array("i", self.length), array("i", self.core)
        del self.next

    def _step(self, state: int, word: int) -> int:
        """The state after a word, or -1."""
        if self.word[state] == word:
            return self.to[state]
        held = self.more.get(state)
        return -1 if held is None else held.get(word, -1)

    def _copy(self, state: int, length: int, ends: list[set]) -> int:
        self.next.append(dict(self.next[state]))
        self.link.append(self.link[state])
        self.length.append(length)
        ends.append(set())
        return len(self.link) - 1

    def _redirect(self, p: int, word: int, q: int, to: int) -> None:
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = to
            p = self.link[p]

    def _extend(self, last: int, word: int, ends: list[set]) -> int:
        if word in self.next[last]:
            q = self.next[last][word]
            if self.length[q] == self.length[last] + 1:
                return q
            clone = self._copy(q, self.length[last] + 1, ends)
            self.link[q] = clone
            self._redirect(last, word, q, clone)
            return clone
        new = len(self.link)
        self.next.append({})
        self.link.append(0)
        self.length.append(self.length[last] + 1)
        ends.append(set())
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            if self.length[q] == self.length[p] + 1:
                self.link[new] = q
            else:
                clone = self._copy(q, self.length[p] + 1, ends)
                self.link[q] = self.link[new] = clone
                self._redirect(p, word, q, clone)
        return new

    def matches(self, words: list[str]) -> Iterator[tuple[int, int, int]]:
        """(item, first word, word after the last) of each longest run of the text that an item holds, as it streams by.

        A run is given once for each stretch of end positions at which the item's last ``least`` words go on matching.
        """
        numbers, step, link, length, core, least = self.number.get, self._step, self.link, self.length, self.core, self.least
        state = matched = 0
        open_runs: dict[int, list[int]] = {}
        for at, w in enumerate(words):
            n = numbers(w)
            if n is None:
                state = matched = 0
            else:
                to = step(state, n)
                while state and to < 0:
                    state = link[state]
                    matched = length[state]
                    to = step(state, n)
                if to >= 0:
                    state = to
                    matched += 1
            if matched >= least:
                found = self.sets[self.held[core[state]]]
                for item in found:
                    run = open_runs.get(item)
                    if run and run[1] == at:
                        run[1] = at + 1
                    else:
                        if run:
                            yield item, run[0], run[1]
                        open_runs[item] = [at + 1 - least, at + 1]
        for item, run in open_runs.items():
            yield item, run[0], run[1]


_SPANS = pa.schema([("row", pa.int64()), ("item", pa.int64()), ("first_word", pa.int32()), ("n_words", pa.int32()), ("text_words", pa.int32())])


def leaked_spans(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, least: int = LEAST_WORDS, words_a_pass: int = WORDS_A_PASS) -> DataFrame:
    """(<doc_id>, <item_id>, first_word, n_words, text_words): each run of at least ``least`` words of an item in a document.

    Method: the items' words go into a generalised suffix automaton; each document's words stream through it, which
    gives the longest match that ends at each word and, by the state of its last ``least`` words, all items that hold
    it. Stretches of an item that go on are one span.

    Cases: words are as words_of gives them. Null and empty texts and items of fewer words have no spans; repeated
    documents and items have theirs each. Without items or documents there are no rows. Other columns are ignored.

    Scale: one pass over the documents without a shuffle for each ``words_a_pass`` words of items (test sets are small
    against a corpus: ten million words of items are twenty passes). The automaton of a pass has at most two states
    a word, which bounds what is broadcast.
    """
    texts = docs.select(F.col(doc_id).cast("long").alias("row"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    spans = None
    for shared in _automata(items, item_id, item_text, least, words_a_pass):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            automaton = shared.value
            for b in batches:
                out: list[tuple[int, int, int, int, int]] = []
                for row, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    words = words_of(t)
                    if len(words) >= least:
                        out += [(row, item, first, end - first, len(words)) for item, first, end in automaton.matches(words)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 5, _SPANS)], schema=_SPANS)

        found = texts.mapInArrow(run, "row bigint, item bigint, first_word int, n_words int, text_words int").toDF(doc_id, item_id, "first_word", "n_words", "text_words")
        spans = found if spans is None else spans.unionByName(found)
    return docs.sparkSession.createDataFrame([], f"{doc_id} bigint, {item_id} bigint, first_word int, n_words int, text_words int") if spans is None else spans


def _automata(items: DataFrame, item_id: str, item_text: str, least: int, words_a_pass: int) -> list[Broadcast]:
    """Automata of the items, broadcast, each of about ``words_a_pass`` words.

    Items come to the driver one partition at a time and are let go of with each automaton.
    """
    sc, out, batch, size = items.sparkSession.sparkContext, [], [], 0
    for row in items.select(F.col(item_id).cast("long").alias("item"), F.col(item_text).alias("text")).where(F.col("item").isNotNull() & F.col("text").isNotNull()).toLocalIterator():
        words = words_of(row.text)
        if len(words) < least:
            continue
        if batch and size + len(words) > words_a_pass:
            out.append(sc.broadcast(ItemAutomaton(batch, least)))
            batch, size = [], 0
        batch.append((row.item, words))
        size += len(words)
    return [*out, sc.broadcast(ItemAutomaton(batch, least))] if batch else out


_CLEANED = "text string, removed_words int, dropped boolean"


def _cleaned(text: str | None, gone: set[int], most_coverage: float) -> tuple[str | None, int, bool]:
    """(text, removed_words, dropped) of a text whose words at the positions in gone are leaked."""
    if not gone:
        return text, 0, False
    places = word_places(text)
    if len(gone) > most_coverage * len(places):
        return None, len(gone), True
    return _cut(text, places, gone), len(gone), False


def without_leaks(docs: DataFrame, doc_id: str, text: str, spans: DataFrame, least: int = LEAST_WORDS, most_coverage: float = 0.5) -> DataFrame:
    """(<doc_id>, text, removed_words, dropped): the documents without their leaked spans of at least ``least`` words.

    A document of whose words more than ``most_coverage`` are leaked is dropped whole: its text is null and dropped is
    true. Documents without spans come as they are. The words taken out go with what stands between them; everything
    before and after is, byte for byte, as it was.

    Cases: null texts stay null. Documents must have distinct ids. Other columns are ignored.
    """
    ranges = spans.where(F.col("n_words") >= least).groupBy(F.col(doc_id).alias("_id")).agg(F.collect_set(F.struct("first_word", "n_words")).alias("_ranges"))
    joined = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text")).join(ranges, F.col("_doc") == F.col("_id"), "left")
    kind = docs.select(doc_id).schema[0].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            rows = [(doc, *_cleaned(t, {w for r in found for w in range(r["first_word"], r["first_word"] + r["n_words"])}, most_coverage)) for doc, t, found in zip(b["_doc"], b["_text"], b["_ranges"])]
            yield type(b)(rows, columns=["doc", "text", "removed_words", "dropped"])

    cleaned = joined.where(F.col("_ranges").isNotNull()).select("_doc", "_text", "_ranges").mapInPandas(run, f"doc {kind}, {_CLEANED}").toDF(doc_id, "text", "removed_words", "dropped")
    same = joined.where(F.col("_ranges").isNull()).select(F.col("_doc").alias(doc_id), F.col("_text").alias("text"), F.lit(0).alias("removed_words"), F.lit(False).alias("dropped"))
    return same.unionByName(cleaned)


def cleaned_texts(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, least: int = LEAST_WORDS, most_coverage: float = 0.5, words_a_pass: int = WORDS_A_PASS) -> DataFrame:
    """What without_leaks gives for the documents' leaked_spans, found and cut in one reading of the documents without a shuffle.

    Items that fill several automata are searched in several passes, whose spans are put together by document as there.
    Repeated ids are cleaned each by itself.
    """
    automata = _automata(items, item_id, item_text, least, words_a_pass)
    if len(automata) > 1:
        return without_leaks(docs, doc_id, text, leaked_spans(docs, doc_id, text, items, item_id, item_text, least, words_a_pass), least, most_coverage)
    rows = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    if not automata:
        return rows.select(F.col("doc").alias(doc_id), "text", F.lit(0).alias("removed_words"), F.lit(False).alias("dropped"))

    def run(batches: Iterator) -> Iterator:
        automaton = automata[0].value
        for b in batches:
            out = []
            for doc, t in zip(b["doc"], b["text"]):
                words = words_of(t)
                gone = {w for _, first, end in automaton.matches(words) for w in range(first, end)} if len(words) >= least else set()
                out.append((doc, *_cleaned(t, gone, most_coverage)))
            yield type(b)(out, columns=["doc", "text", "removed_words", "dropped"])

    return rows.mapInPandas(run, f"doc {dict(rows.dtypes)['doc']}, {_CLEANED}").withColumnRenamed("doc", doc_id)


def _pieces(text: str) -> Iterator[tuple[int, int, str]]:
    """(from, to, normal form) of pieces of a text that NFKC treats apart, in order: mostly single characters with their marks."""
    at, normal = 0, ""
    for i, c in enumerate(text):
        own = unicodedata.normalize("NFKC", c)
        # A piece ends where the next character neither combines with it nor begins with a mark.
        if i > at and (c.isascii() or (own and not unicodedata.combining(own[0]) and unicodedata.normalize("NFKC", text[at : i + 1]) == normal + own)):
            yield at, i, normal
            at, normal = i, own
        else:
            normal = unicodedata.normalize("NFKC", text[at : i + 1])
    if at < len(text):
        yield at, len(text), normal


def word_places(text: str) -> list[tuple[int, int]]:
    """(from, to) of each word of words_of in the text as it is written."""
    if text.isascii():
        return [m.span() for m in _WORD.finditer(text)]
    letters, froms, tos = [], [], []
    for a, b, normal in _pieces(text):
        for x in normal.lower():
            if x not in INVISIBLE:
                letters.append(x)
                froms.append(a)
                tos.append(b)
    return [(froms[m.start()], tos[m.end() - 1]) for m in _WORD.finditer("".join(letters))]


def _cut(text: str, places: list[tuple[int, int]], gone: set[int]) -> str:
    """text without the words whose positions are in gone, and what stands between two such; the rest is untouched."""
    kept, at, i = [], 0, 0
    while i < len(places):
        if i in gone:
            first = i
            while i + 1 < len(places) and i + 1 in gone:
                i += 1
            kept.append(text[at : places[first][0]])
            at = places[i][1]
        i += 1
    return "".join((*kept, text[at:]))
