"""Encoding of texts with a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deedloom.plans.sizes import spread

#: Folder with the vocabularies; its files are read on the driver and sent to the tasks.
TOKENIZERS = "/opt/tokenizers"
#: Distinct words whose encodings a task remembers. Beyond it the memory starts anew; results don't depend on it.
REMEMBERED = 400_000

# Fixed value: how byte_bpe_50k cuts a text into words before merging.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def read_ranks(path: str) -> bytes:
    """The vocabulary file (lines of a base64 token and its rank); some 1 MB, whatever the data."""
    with open(path, "rb") as f:
        return f.read()


class WordEncoder:
    """Encodes words by a traversal of the trie of their bytes.

    The encoding of a prefix is known by its last token alone: the rest is the encoding of the prefix without it. So a
    node of the trie holds one state, the last token's length and id, computed once for all words that share the
    prefix. The last token is that whose neighbour before it, the last token of the shorter prefix, stays apart from
    it: merging the two tokens' bytes by rank gives just the two.
    """

    def __init__(self, vocabulary: bytes):
        self.rank = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in vocabulary.splitlines() if line.strip())}
        self.token = {rank: token for token, rank in self.rank.items()}
        # For each last byte, the lengths of tokens that end with it, longest first.
        lengths: dict[int, set[int]] = {}
        for token in self.rank:
            lengths.setdefault(token[-1], set()).add(len(token))
        self.lengths = {byte: sorted(found, reverse=True) for byte, found in lengths.items()}
        self.whole = {rank: self.merged(token) == [rank] for token, rank in self.rank.items() if len(token) == 1}
        self.apart: dict[tuple[int, int], bool] = {}
        self.known: dict[bytes, np.ndarray] = {}

    def merged(self, text: bytes) -> list[int]:
        """Plain merging by rank; used for two tokens at a time."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get(parts[i] + parts[i + 1], 1 << 60))
            if parts[best] + parts[best + 1] not in self.rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [self.rank[p] for p in parts]

    def is_whole(self, token: int) -> bool:
        if token not in self.whole:
            self.whole[token] = self.merged(self.token[token]) == [token]
        return self.whole[token]

    def stays_apart(self, left: int, right: int) -> bool:
        pair = (left, right)
        if pair not in self.apart:
            if len(self.apart) > 4 * REMEMBERED:
                self.apart.clear()
            self.apart[pair] = self.merged(self.token[left] + self.token[right]) == [left, right]
        return self.apart[pair]

    def last_token(self, path: bytearray, lasts: list[int]) -> int:
        """The last token of the prefix ``path``, given the last tokens of all its shorter prefixes."""
        end = len(path)
        for n in self.lengths[path[-1]]:
            if n <= end:
                token = self.rank.get(bytes(path[end - n :]))
                if token is not None and self.is_whole(token) and (n == end or self.stays_apart(lasts[end - n - 1], token)):
                    return token
        raise ValueError("the vocabulary has no token for a byte")

    def learn(self, words: set[bytes]) -> None:
        """Encode words that aren't known yet: in sorted order, which is the trie's depth-first order, keeping the states of the path."""
        path, lasts = bytearray(), []
        for word in sorted(words):
            shared = 0
            limit = min(len(word), len(path))
            while shared < limit and word[shared] == path[shared]:
                shared += 1
            del path[shared:], lasts[shared:]
            for byte in word[shared:]:
                path.append(byte)
                lasts.append(self.last_token(path, lasts))
            ids, end = [], len(word)
            while end:
                ids.append(lasts[end - 1])
                end -= len(self.token[lasts[end - 1]])
            self.known[word] = np.array(ids[::-1], dtype=np.int32)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids begin and end."""
        cut = regex.compile(WORDS).findall
        words = [[w.encode("utf-8", "surrogatepass") for w in cut(t)] if t else [] for t in texts]
        new = {w for ws in words for w in ws if w not in self.known}
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = {w for ws in words for w in ws}
        self.learn(new)
        known = self.known
        ids = [known[w] for ws in words for w in ws]
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        ends = np.concatenate([[0], np.cumsum(sizes)])
        per_text = np.concatenate([[0], np.cumsum([len(ws) for ws in words])]).astype(np.int64)
        return np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32), ends[per_text]


_ENCODERS: dict[int, WordEncoder] = {}


def _encoder(vocabulary: bytes) -> WordEncoder:
    """One encoder for all tasks of a Python worker."""
    key = hash(vocabulary)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(vocabulary)
    return _ENCODERS[key]


#: Characters of text that are encoded at a time.
STEP = 2_000_000


def _steps(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t) if t else 0
        if size >= STEP:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def _in_batches(vocabulary: Callable[[], bytes], id_type: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("id", id_type), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary())
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for begin, end in _steps(texts):
                ids, offsets = encoder.encode(texts[begin:end])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, end - begin).cast(id_type), lists], schema=schema)

    return run


def encode_texts(df: DataFrame, row_id: str, text: str, path: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken") -> DataFrame:
    """(<row_id>, ids): the token ids of each text under the vocabulary at ``path``, without special tokens.

    Method: texts are cut into words; the distinct words that a task hasn't met yet are put in order of their trie,
    where each prefix's state is computed once, and the texts' ids are put together from their words.

    Cases: null and empty texts give an empty list. Strings of special tokens are ordinary text. Texts may be of any
    length; repeated ids and texts are encoded each. An empty table gives an empty table. Only the two columns named
    are read, whatever others are there.

    Scale: no shuffle; memory by word, not by corpus; the vocabulary (about 1 MB) is the one thing broadcast.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(read_ranks(path))
    kind = df.select(F.col(row_id)).schema[0].dataType
    to_arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    name = kind.simpleString()
    key = F.col(row_id) if name in to_arrow else F.col(row_id).cast("string")
    out = spread(df.select(key.alias("id"), F.col(text).alias("text"))).mapInArrow(_in_batches(lambda: shared.value, to_arrow.get(name, pa.string())), f"id {name if name in to_arrow else 'string'}, ids array<int>")
    return out.select(F.col("id").cast(kind).alias(row_id), "ids")
