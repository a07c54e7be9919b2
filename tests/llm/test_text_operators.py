"""Token encoding, leak search and text kinds."""

from __future__ import annotations

import base64
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from deedloom.llm.boosting import BoostedTrees, Calibration, softmax
from deedloom.llm.leaks import ItemAutomaton, cleaned_texts, leaked_spans, without_leaks, word_places, words_of
from deedloom.llm.forms import NAMES, batch_statistics, word_hashes
from deedloom.llm.quality import common_words, line_kinds, text_kinds, text_statistics, train_kinds
from deedloom.llm.tokens import TOKENIZERS, WORDS, WordEncoder, encode_texts, read_ranks

VOCABULARY = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
needs_vocabulary = pytest.mark.skipif(not Path(VOCABULARY).exists(), reason="no vocabulary files here")

TEXTS = [
    None, "", " ", "\n\n  \t", "The owner's name isn't known.", "naïve café — ŵy â'i", "<|endoftext|> is ordinary", "日本語のテキスト 🏠🏠", "a" * 5000, "ab" * 3000 + "9" * 2000,
    "x" + "​" + "y", "  leading and   inner   blanks  ", "CAPS and MixedCase 12345 67,890.00", "'ll 's 've 'd", "\u0000\u0001 control", "repeat", "repeat",
]


@needs_vocabulary
def test_tokens_equal_the_library(spark):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    library = tiktoken.Encoding("own", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice("abcdeé ,.'9\n日") for _ in range(rng.randint(1, 80))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit("clash")).withColumn("id", F.lit(1))
    got = {r.doc_id: r.ids for r in encode_texts(df, "doc_id", "text").collect()}
    assert got == {i: library.encode_ordinary(t) if t else [] for i, t in enumerate(texts)}
    assert encode_texts(df.limit(0), "doc_id", "text").collect() == []
    assert library.decode(got[12]) == texts[12]


@needs_vocabulary
def test_encoder_forgets_without_harm(monkeypatch):
    import deedloom.llm.tokens as tokens

    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    encoder = WordEncoder(read_ranks(VOCABULARY))
    ids, ends = encoder.encode(["one two three four five six", None, "seven eight one"])
    again, _ = WordEncoder(read_ranks(VOCABULARY)).encode(["one two three four five six", "seven eight one"])
    assert list(ids) == list(again) and list(ends)[2] == list(ends)[1]


def test_words():
    assert words_of("A​b soft­hyphen ﬁne x_y don't １２ É") == ["ab", "softhyphen", "fine", "x", "y", "don", "t", "12", "é"]
    assert words_of(None) == [] and words_of("—…") == []


def _brute(items, words, least):
    return {i for i, ws in items for k in range(len(ws) - least + 1) for j in range(len(words) - least + 1) if ws[k : k + least] == words[j : j + least]}


def test_automaton_against_brute_force():
    rng = random.Random(1)
    for _ in range(60):
        items = [(i, [rng.choice("abc") for _ in range(rng.randint(0, 25))]) for i in range(6)]
        automaton = ItemAutomaton(items, 5)
        for _ in range(5):
            words = [rng.choice("abcd") for _ in range(rng.randint(0, 60))]
            spans = list(automaton.matches(words))
            assert {i for i, _, _ in spans} == _brute(items, words, 5)
            for i, first, end in spans:
                held = dict(items)[i]
                for k in range(first, end - 4):
                    assert any(held[j : j + 5] == words[k : k + 5] for j in range(len(held)))


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, item long, row string")


def test_leaked_spans(spark):
    item = " ".join(f"w{i}" for i in range(30))
    other = " ".join(f"v{i}" for i in range(11))
    items = spark.createDataFrame([(1, item), (2, other), (3, None), (4, ""), (5, item)], "item_id long, text string")
    part = " ".join(f"w{i}" for i in range(5, 17))
    docs = _docs(spark, [
        (1, f"before {part.upper()} after", 0, ""), (2, " ".join(part.split()[:11]), 0, ""), (3, None, 0, ""), (4, "", 0, ""), (5, item, 0, ""), (6, f"{part}, {part}", 0, ""),
        (7, other, 0, ""), (8, "x " * 50_000 + part, 0, ""), (9, part.replace("w5", "w​5").replace(" ", "—"), 0, ""), (1, f"before {part} after", 0, ""),
    ])
    spans = leaked_spans(docs, "doc_id", "text", items, "item_id", "text")
    assert {(r.doc_id, r.item_id) for r in spans.collect()} == {(d, i) for d in (1, 5, 6, 8, 9) for i in (1, 5)}
    # Several passes give the same.
    assert Counter(map(tuple, spans.collect())) == Counter(map(tuple, leaked_spans(docs, "doc_id", "text", items, "item_id", "text", words_a_pass=30).collect()))
    assert leaked_spans(docs, "doc_id", "text", items.limit(0), "item_id", "text").collect() == []
    assert leaked_spans(docs.limit(0), "doc_id", "text", items, "item_id", "text").collect() == []
    one = docs.where("doc_id in (1, 3, 4, 5, 7)").dropDuplicates(["doc_id"])
    got = {r.doc_id: (r.text, r.removed_words, r.dropped) for r in without_leaks(one, "doc_id", "text", leaked_spans(one, "doc_id", "text", items, "item_id", "text"), most_coverage=0.9).collect()}
    assert got[1] == ("before  after", 12, False) and got[3] == (None, 0, False) and got[4] == ("", 0, False) and got[5] == (None, 30, True) and got[7] == (other, 0, False)


def test_places_of_words_in_the_text_as_written():
    """Each word's place in the original text normalises to the word, whatever normal form, case or invisible characters do to it."""
    rng = random.Random(11)
    texts = ["Café ① ﬁne", "e\u0301a\u0323\u0302b ＡＢ１ ㌔x ½ İstanbul ΣΑΣ", "a\u200bb\u00adc d\ufeffe", "ﾊﾞﾊ か\u3099 각 각", "x y", "日本語 text", "", "\u0301a", "ſt ﬅ"]
    texts += ["".join(rng.choice(["a", "B", "é", "e\u0301", "ﬁ", "①", " ", "-", "\u200b", "\u00ad", "ﾊ", "ﾞ", "ᄀ", "ᅡ", "ᆨ", "½", "İ", "ß", "Σ", "\u0323", "_", "９"]) for _ in range(rng.randint(1, 25))) for _ in range(500)]
    for t in texts:
        places = word_places(t)
        assert len(places) == len(words_of(t)), t
        assert all(a < b for a, b in places) and all(x[1] <= y[1] for x, y in zip(places, places[1:])), t
    plain = "Café ① ﬁne\u00a0"
    assert [plain[a:b] for a, b in word_places(plain)] == ["Café", "①", "ﬁne"]


def test_cleaned_texts(spark):
    """Outside the spans every byte stays; one reading and several passes give the same."""
    item = " ".join(f"w{i}" for i in range(30))
    items = spark.createDataFrame([(1, item), (2, " ".join(f"z{i}" for i in range(20)))], "item_id long, text string")
    leak = "—".join(item.upper().split()[4:18])
    before, after = "Café ① ﬁne e\u0301 x\u200by:\t", ";  ½ Rest\u00a0of İt " + "tail " * 20
    docs = _docs(spark, [(1, before + leak + after, 0, ""), (2, after, 0, ""), (3, None, 0, ""), (4, "", 0, ""), (5, leak, 0, ""), (6, leak.lower() + " " + before + " ".join(f"z{i}" for i in range(12)) + after * 2, 0, "")])
    got = {r.doc_id: (r.text, r.removed_words, r.dropped) for r in cleaned_texts(docs, "doc_id", "text", items, "item_id", "text").collect()}
    assert got == {1: (before + after, 14, False), 2: (after, 0, False), 3: (None, 0, False), 4: ("", 0, False), 5: (None, 14, True), 6: (" " + before + after * 2, 26, False)}
    several = cleaned_texts(docs, "doc_id", "text", items, "item_id", "text", words_a_pass=30)
    assert {r.doc_id: (r.text, r.removed_words, r.dropped) for r in several.collect()} == got
    assert cleaned_texts(docs.limit(0), "doc_id", "text", items, "item_id", "text").collect() == [] and cleaned_texts(docs, "doc_id", "text", items.limit(0), "item_id", "text").where("removed_words > 0").collect() == []


PROSE = "The owner wrote that the lease had run out. Nobody could say who had paid for the wall beside the yard."
KIND_TEXTS = {
    "prose": PROSE,
    "list": "- 12 Oak Road, Great Town\n- 9 Fir Lane, Great Town\n- 3 Elm Way, Upper Town\n- 8 Ash Row, Upper Town",
    "table": "number\tstreet\tunits\n12\tOak Road\t3\n9\tFir Lane\t8\n3\tElm Way\t1",
    "junk": "%}|@-&+!<>^~ {[#;$=]} \\&)%*(~:;@|{ }^%|<>?=+[]~#",
}


def test_line_kinds():
    words = frozenset(["the", "that", "had", "out", "of", "who", "for"])
    for kind, text in KIND_TEXTS.items():
        assert line_kinds(text, words)[kind] > 0.5, kind
    assert line_kinds("n/a " * 60, words)["junk"] == 1
    wrapped = "The owner wrote that the lease had run out and that\nthe wall beside the yard had been sold together with\nthe house, which nobody could say anything about."
    assert line_kinds(wrapped, words)["prose"] == 1


def test_batch_statistics_against_plain_counts():
    """What a batch gives is what counting text by text gives, whatever stands beside it in the batch."""
    rng = random.Random(12)
    texts = [*KIND_TEXTS.values(), "", " ", "\n\n", "x" * 20_000, "Üben wir: ÀÉ ñ 日本語 🏠🏠 𝔘 end\r\nnext  line", "a\u2028b", "(a) one\n12. two\n[ ] three\niv) four\n• five\nsix", "ab ab AB ab"]
    texts += ["".join(rng.choice("ab C,.;-|\n\t1'éŴ") for _ in range(rng.randint(0, 120))) for _ in range(200)]
    common = word_hashes(["ab", "the"])
    got = batch_statistics(texts, common)
    assert got.shape == (len(texts), len(NAMES)) and not np.isnan(got).any() and batch_statistics([], common).shape == (0, len(NAMES))
    alone = np.vstack([batch_statistics([t], common) for t in texts])
    assert np.allclose(got, alone)
    at = {name: got[:, i] for i, name in enumerate(NAMES)}
    for i, t in enumerate(texts):
        words, tokens = re.findall(r"[^\W\d_]+", t), t.split()
        lines = [x.strip() for x in re.split(r"[\n\r]", t) if x.strip()]
        share = lambda part, whole: part / whole if whole else 0.0
        chars = sum(map(len, lines))
        want = {
            "length": np.log1p(len(t)), "lines": np.log1p(len(lines)), "line_length": share(chars, len(lines)), "word_length": share(sum(map(len, words)), len(words)), "longest_token": share(max(map(len, tokens), default=0), max(1, len(t))),
            "single_tokens": share(sum(len(x) == 1 for x in tokens), len(tokens)), "digits": share(sum(map(str.isdigit, t)), len(t)), "capitals": share(sum(map(str.isupper, t)), len(t)), "different_words": share(len({w.lower() for w in words}), len(words)),
            "common_words": share(sum(w.lower() in ("ab", "the") for w in words), len(words)), "lower_words": share(sum(w[0].islower() for w in words), len(words)), "gap_lines": share(sum(len(x) for x in lines if re.search(r"\S\s{2,}\S", x)), chars),
            "delimiter_0": None, "stopped_lines": share(sum(len(x) for x in lines if re.search(r"[.!?…][\"'”’»)\]]{0,3}$", x)), chars),
        }
        for name, value in want.items():
            assert value is None or abs(at[name][i] - value) < 1e-9, (name, t, at[name][i], value)
    assert at["bullet_lines"][texts.index("(a) one\n12. two\n[ ] three\niv) four\n• five\nsix")] > 0.9


def test_text_statistics(spark):
    df = spark.createDataFrame([(1, "The cat sat.\nA dog"), (2, ""), (3, None), (4, "123 !!"), (4, "123 !!"), (5, "\n")], "doc_id long, text string").withColumn("_text", F.lit("clash")).withColumn("_id", F.lit(0))
    got = {r.doc_id: r for r in text_statistics(df, "doc_id", "text", ["the", "a"]).collect()}
    r = got[1]
    assert (r.n_words, r.mean_word_length, r.stopped_line_ratio, r.common_word_ratio) == (5, 13 / 5, 0.5, 0.4) and abs(r.symbol_ratio - 1 / 18) < 1e-12
    assert tuple(got[2])[1:] == (0, None, None, None, None, None) and tuple(got[3])[1:] == (None,) * 6
    assert got[4].n_words == 0 and got[4].symbol_ratio == 2 / 6 and got[4].digit_ratio == 0.5 and got[4].mean_word_length is None
    assert text_statistics(df.limit(0), "doc_id", "text").collect() == []
    # 'dog' and 'cat' and 'sat' tie: the alphabet decides; 'The' and 'A' are not written in lower case.
    assert common_words(df, "text", 2) == ["cat", "dog"]


def test_kinds_on_held_out_texts(spark):
    rng = random.Random(4)
    sentences = ["the owner wrote that the lease had run out", "nobody could say who had paid for it", "we walked along the road to the corner", "the roof was replaced by a firm from the north"]

    def make(kind):
        n = rng.randint(4, 12)
        if kind == "prose":
            return " ".join(rng.choice(sentences).capitalize() + "." for _ in range(n))
        if kind == "list":
            return "\n".join(f"{rng.choice(['-', '•', '*'])} {rng.randint(1, 99)} {rng.choice(['Oak', 'Elm', 'Fir'])} Road, Town" for _ in range(n))
        if kind == "table":
            return "a|b|c\n" + "\n".join(f"{rng.randint(1, 9)}|Oak Road|{rng.randint(1, 99)}" for _ in range(n))
        return "".join(rng.choice("%}|@-&+!<>^~ {[#;$=]}") for _ in range(30 * n))

    kinds = ["prose", "list", "table", "junk"]
    rows = [(i, make(kinds[i % 4]), kinds[i % 4]) for i in range(400)] + [(900, None, None), (901, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, truth string").withColumn("kind", F.lit("clash"))
    labels = df.where("doc_id < 80").select("doc_id", F.col("truth").alias("text_kind"))
    model = train_kinds(df, "doc_id", "text", labels)
    got = {r.doc_id: r.text_kind for r in text_kinds(df, "doc_id", "text", model).collect()}
    held = [r for r in rows if 80 <= r[0] < 400]
    assert set(got) == set(range(400))
    assert sum(got[i] == k for i, _, k in held) >= 0.97 * len(held)
    again = train_kinds(df.repartition(7), "doc_id", "text", labels)
    assert again.common == model.common and np.allclose(again.calibration.offset, model.calibration.offset)
    assert text_kinds(df.limit(0), "doc_id", "text", model).collect() == []


def test_boosting_learns_and_calibrates():
    rng = np.random.default_rng(2)
    x = rng.random((1500, 5))
    y = (x[:, 0] > 0.5).astype(int) + 2 * (x[:, 1] > 0.7)
    model = BoostedTrees(4, rounds=15).fit(x[:1000], y[:1000])
    scores = model.scores(x[1000:])
    assert (scores.argmax(1) == y[1000:]).mean() > 0.95
    calibrated = Calibration().fit(scores[:250], y[1000:1250]).probabilities(scores[250:])
    loss = lambda p: -np.log(p[np.arange(len(p)), y[1250:]] + 1e-12).mean()
    assert loss(calibrated) <= loss(softmax(scores[250:])) + 0.01
    assert np.allclose(Calibration().fit(np.zeros((0, 4)), np.zeros(0, dtype=int)).probabilities(scores), softmax(scores))
