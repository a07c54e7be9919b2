"""Statistics of the form of texts, worked out for a whole batch of texts at once on arrays of their characters."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

# Marks that may part columns (a comma only where no blank follows), and marks that begin an entry of a list.
DELIMITERS = "\t|¦*,;~^"
BULLETS = "-*•–—·▪◦‣+"
# Words and marks of page furniture.
FURNITURE_WORDS = ("about", "cookie", "cookies", "help", "home", "login", "menu", "next", "prev", "print", "privacy", "reserved", "rights", "search", "share", "sitemap", "subscribe", "terms", "tweet")
FURNITURE_MARKS = "©«»"
VOWELS = "aeiouyàâäéèêëîïôöùûüœæáíóúŵŷåøAEIOUYÀÂÄÉÈÊËÎÏÔÖÙÛÜŒÆÁÍÓÚŴŶÅØ"

NAMES = (
    "length", "lines", "line_length", "line_spread", "words_a_token", "word_length", "longest_token", "long_tokens", "single_tokens", "hex_tokens", "common_words", "digits", "capitals", "letters", "symbols", "stopped_lines",
    "different_words", "different_pairs", "lower_words", "vowelless_words", "furniture", "mojibake", "markup", "separators", "bullet_lines", "sentence_lines", "short_lines", "short_runs", "repeated_lines", "ruled_lines", "gap_lines", "full_lines", "sentence_paragraphs", "lower_starts", "stopless_lines",
    "symbol_lines", "spaced_lines", "vowelless_lines", "hex_lines", "mojibake_lines", "markup_lines", "long_token_lines", *(f"delimiter_{i}" for i in range(len(DELIMITERS))),
)

#: Characters up to here have their class in a table; those beyond are looked up when they occur.
_TABLE = 0x10000
_LETTER, _DIGIT, _UPPER, _LOWER, _SPACE, _SYMBOL, _VOWEL, _HEX, _SMALL, _ODD, _LEAD, _TAIL, _SEPARATOR, _FURNITURE, _RULE, _BULLET, _BREAK, _CLOSER, _STOP, _ROMAN = (1 << i for i in range(20))
# The marks of each class.
_MARKS = {
    _HEX: "0123456789abcdefABCDEF", _SMALL: "abcdefghijklmnopqrstuvwxyz", _ODD: "¤§¶", _LEAD: "ÃÂ", _TAIL: "".join(map(chr, range(0x80, 0xC0))), _SEPARATOR: ";|¦•·", _FURNITURE: FURNITURE_MARKS, _RULE: "|+=¦:*_-", _BULLET: BULLETS, _BREAK: "\n\r",
    _CLOSER: "\"'”’»)]", _STOP: ".!?…", _ROMAN: "ivxIVX", _VOWEL: VOWELS,
}


def _class(c: str) -> int:
    kinds = c.isalpha() * _LETTER | c.isdigit() * _DIGIT | c.isupper() * _UPPER | c.islower() * _LOWER | c.isspace() * _SPACE | (not c.isalnum() and not c.isspace()) * _SYMBOL
    return kinds | sum(kind for kind, marks in _MARKS.items() if c in marks)


def _lowered(c: str) -> int:
    low = c.lower()
    return ord(low) if len(low) == 1 else ord(c)


class _Characters:
    """Classes, lower case and hash values of characters; made once a worker."""

    def __init__(self):
        chars = [chr(i) for i in range(_TABLE)]
        self.classes = np.array([_class(c) for c in chars], dtype=np.uint32)
        self.lower = np.array([_lowered(c) for c in chars], dtype=np.uint32)
        self.values = np.random.default_rng(1).integers(1, 2**63, _TABLE, dtype=np.uint64)

        self._powers = self._back = np.ones(1, dtype=np.uint64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The first n powers of the hash's factor, and of its inverse."""
        if len(self._powers) < n:
            with np.errstate(over="ignore"):
                self._powers, self._back = (np.cumprod(np.r_[np.uint64(1), np.full(n - 1, f)], dtype=np.uint64) for f in (_FACTOR, _INVERSE))
        return self._powers[:n], self._back[:n]

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(classes, hash values in lower case) of characters."""
        far = codes >= _TABLE
        if not far.any():
            return self.classes[codes], self.values[self.lower[codes]]
        near = np.where(far, 0, codes)
        classes, values = self.classes[near], self.values[self.lower[near]]
        for code in np.unique(codes[far]):
            at = codes == code
            classes[at], values[at] = _class(chr(code)), np.uint64(int(code) * 0x9E3779B97F4A7C15 & 2**64 - 1)
        return classes, values


_characters: _Characters | None = None
_FACTOR, _INVERSE = np.uint64(0x5851F42D4C957F2D), np.uint64(pow(0x5851F42D4C957F2D, -1, 2**64))


def _table() -> _Characters:
    global _characters
    if _characters is None:
        _characters = _Characters()
    return _characters


def _runs(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, one past last) of the runs of neighbouring positions in a rising array."""
    if not len(at):
        return at, at
    breaks = np.flatnonzero(np.diff(at) > 1)
    return at[np.r_[0, breaks + 1]], at[np.r_[breaks, len(at) - 1]] + 1


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def word_hashes(words: Iterable[str]) -> np.ndarray:
    """Hashes of words as batch_statistics makes them."""
    out = []
    for w in words:
        values = _table().of(np.frombuffer(w.encode("utf-32-le", "surrogatepass"), dtype=np.uint32))[1]
        total, power = np.uint64(0), np.uint64(1)
        with np.errstate(over="ignore"):
            for v in values:
                total, power = total + v * power, power * _FACTOR
        out.append(total)
    return np.array(out, dtype=np.uint64)


#: Characters that are worked on at a time, about: their arrays stay near the processor.
_BLOCK = 100_000


def batch_statistics(texts: list[str], common: np.ndarray) -> np.ndarray:
    """One row a text with the statistics of NAMES, over the whole texts; ``common`` are word_hashes of the common words.

    Lines are trimmed, blank ones left out; words are runs of letters, tokens runs of anything but blanks. Shares of lines are
    weighted by their characters. A text without lines, words or tokens has 0 where a share of them is asked for.

    A text costs a few dozen passes over an array of its characters, whatever it holds; nothing is searched text by text.
    """
    out, block, size = [], [], 0
    for t in texts:
        block.append(t)
        size += len(t)
        if size >= _BLOCK:
            out.append(_block_statistics(block, common))
            block, size = [], 0
    if block:
        out.append(_block_statistics(block, common))
    return np.vstack(out) if out else np.zeros((0, len(NAMES)))


def _block_statistics(texts: list[str], common: np.ndarray) -> np.ndarray:
    n = len(texts)
    # Every text ends with a line break, so that no line, word or token goes on into the next.
    codes = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=n)
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    text_of = np.repeat(np.arange(n, dtype=np.int32), sizes + 1)
    classes, values = _table().of(codes)
    next_class = np.r_[classes[1:], np.uint32(_SPACE)]
    is_a = lambda what: (classes & what) != 0
    letter, digit, space, symbol = is_a(_LETTER), is_a(_DIGIT), is_a(_SPACE), is_a(_SYMBOL)
    sums = lambda mask: np.concatenate(([0], np.cumsum(mask, dtype=np.int32)))
    in_texts = lambda total: total[ends - 1] - total[starts]

    # Prefix sums of values times powers give the hash of any piece by two subtractions and one product.
    with np.errstate(over="ignore"):
        powers, back = _table().powers(len(codes))
        prefix = np.r_[np.uint64(0), np.cumsum(values * powers, dtype=np.uint64)]
        hashes = lambda a, b: (prefix[b] - prefix[a]) * back[a]
        of_text = lambda h, t: h ^ (t.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

        letters_, symbols_, digits_ = sums(letter), sums(symbol), sums(digit)
        # Words.
        ws, we = _runs(np.flatnonzero(letter))
        wt = text_of[ws]
        n_words = np.bincount(wt, minlength=n)
        wh = hashes(ws, we)
        different = np.bincount(wt[np.unique(of_text(wh, wt), return_index=True)[1]], minlength=n)
        same_text = wt[1:] == wt[:-1]
        pair_text = wt[1:][same_text]
        pairs = of_text(wh[:-1] * np.uint64(3) ^ (wh[1:] * np.uint64(0x5851F42D4C957F2D)), wt[1:])[same_text]
        different_pairs = np.bincount(pair_text[np.unique(pairs, return_index=True)[1]], minlength=n)
        n_pairs = np.bincount(pair_text, minlength=n)
    length = we - ws
    is_common = np.isin(wh, common)
    lower = is_a(_LOWER)[ws]
    # Short words in capitals are abbreviations, which need no vowel.
    vowels_, uppers_ = sums(is_a(_VOWEL)), sums(is_a(_UPPER))
    vowelless = (vowels_[we] == vowels_[ws]) & (length > 1) & ((length > 4) | (uppers_[we] - uppers_[ws] < length))
    by_word = lambda mask, size=n, of=None: np.bincount((wt if of is None else of)[mask], minlength=size)
    furniture = by_word(np.isin(wh, word_hashes(FURNITURE_WORDS)))

    # Tokens.
    filled = np.flatnonzero(~space)
    ts, te = _runs(filled)
    tt, tl = text_of[ts], te - ts
    n_tokens = np.bincount(tt, minlength=n)
    longest = np.zeros(n)
    np.maximum.at(longest, tt, tl)
    hex_ = sums(is_a(_HEX))
    is_hex = (hex_[te] - hex_[ts] == tl) & (digits_[te] > digits_[ts]) & np.isin(tl, (2, 4, 8, 16, 32))
    by_token = lambda mask, weight=None, size=n, of=None: np.bincount((tt if of is None else of)[mask], None if weight is None else weight[mask], minlength=size)

    # Marks.
    comes = lambda what: (next_class & what) != 0
    space_after = comes(_SPACE)
    garbled = np.zeros(len(codes), dtype=bool)
    if (codes > 127).any():
        garbled = (is_a(_LEAD) & comes(_TAIL)) | (codes == 0xFFFD) | (is_a(_ODD) & comes(_SMALL)) | (is_a(_SMALL) & comes(_ODD))
        euro = np.flatnonzero(codes == ord("€"))
        garbled[euro[codes[np.maximum(euro - 1, 0)] == ord("â")] - 1] = True
    tag = np.zeros(len(codes), dtype=bool)
    for mark, after in (("<", _LETTER), ("&", _SMALL)):
        found = np.flatnonzero(codes == ord(mark))
        tag[found[(next_class[found] & after > 0) | ((codes[np.minimum(found + 1, len(codes) - 1)] == ord("/")) & (mark == "<"))]] = True
    braces = np.flatnonzero(codes == ord("{"))
    tag[braces[codes[np.minimum(braces + 1, len(codes) - 1)] == ord("{")]] = True
    separator = is_a(_SEPARATOR) | (((codes == ord(",")) | (codes == ord("/"))) & space_after)
    garbled_, tags_ = sums(garbled), sums(tag)
    furniture = furniture + in_texts(sums(is_a(_FURNITURE)))

    # Lines that aren't blank, from their first filled character to their last.
    breaks = is_a(_BREAK)
    line_at = np.cumsum(breaks)[filled]
    first = np.r_[True, np.diff(line_at) > 0] if len(filled) else np.zeros(0, dtype=bool)
    ls, le = filled[first], (filled[np.r_[first[1:], True]] + 1 if len(filled) else filled)
    lt, ll = text_of[ls], le - ls
    m = len(ls)
    n_lines = np.bincount(lt, minlength=n)
    chars = np.bincount(lt, ll, minlength=n)
    line_of = np.cumsum(first) - 1
    word_line = np.searchsorted(ls, ws, side="right") - 1
    token_first = np.flatnonzero(np.r_[True, np.diff(filled) > 1]) if len(filled) else filled
    token_line = line_of[token_first]
    in_lines = lambda total: total[le] - total[ls]
    words_in, tokens_in = np.bincount(word_line, minlength=m), np.bincount(token_line, minlength=m)
    told, known = by_word(lower, m, word_line), by_word(is_common, m, word_line)
    at = lambda k: codes[np.minimum(ls + k, len(codes) - 1)]
    kind = lambda k: classes[np.minimum(ls + k, len(codes) - 1)]
    stop_or_bracket = lambda k: (at(k) == ord(".")) | (at(k) == ord(")"))
    bullet = (kind(0) & _BULLET > 0) & (kind(1) & _SPACE > 0)
    bullet |= (at(0) == ord("[")) & ((at(1) == ord("]")) | (np.isin(at(1), [ord(c) for c in " xX"]) & (at(2) == ord("]"))))
    for o in (0, 1):
        opened = (at(0) == ord("(")) if o else np.ones(m, dtype=bool)
        digits = np.ones(m, dtype=bool)
        for k in range(1, 4):
            digits &= kind(o + k - 1) & _DIGIT > 0
            bullet |= opened & digits & stop_or_bracket(o + k) & (kind(o + k + 1) & _SPACE > 0)
        bullet |= opened & (kind(o) & _LETTER > 0) & stop_or_bracket(o + 1) & (kind(o + 2) & _SPACE > 0)
        roman = np.ones(m, dtype=bool)
        for k in range(1, 6):
            roman &= kind(o + k - 1) & _ROMAN > 0
            bullet |= opened & roman & stop_or_bracket(o + k) & (kind(o + k + 1) & _SPACE > 0)
    shouted = in_lines(uppers_) == in_lines(letters_)
    sentence = (words_in >= 6) & np.where(shouted, known >= 0.3 * words_in, told >= 0.5 * words_in)
    short = (ll <= 100) & ~sentence
    brief = short | bullet
    run_start = np.flatnonzero(np.r_[True, (brief[1:] != brief[:-1]) | (lt[1:] != lt[:-1])]) if m else np.zeros(0, dtype=int)
    run_size = np.diff(np.r_[run_start, m])
    in_run = brief & (np.repeat(run_size, run_size) >= 3)
    last = le - 1
    for _ in range(3):
        closing = (classes[last] & _CLOSER > 0) & (last > ls)
        last = last - closing
    stopped = classes[last] & _STOP > 0
    ruled_ = sums(is_a(_RULE | _SPACE))
    ruled = (in_lines(ruled_) == ll) & (ll >= 4)
    wide = np.flatnonzero(np.diff(filled) > 2)
    wide = wide[line_of[wide] == line_of[wide + 1]] if len(wide) else wide
    gap = np.zeros(m, dtype=bool)
    gap[line_of[wide]] = True
    with np.errstate(over="ignore"):
        line_key = of_text(hashes(ls, le), lt)
    _, where, how_often = np.unique(line_key, return_inverse=True, return_counts=True) if m else (None, np.zeros(0, dtype=int), np.zeros(0, dtype=int))
    repeated = (how_often[where] >= 5) & (how_often[where] >= 0.2 * n_lines[lt]) if m else np.zeros(0, dtype=bool)
    widest = np.zeros(n)
    np.maximum.at(widest, lt, ll)
    # A line is full if the next one's first token would not have found room in it.
    full = np.zeros(m, dtype=bool)
    if m > 1:
        token_start = np.flatnonzero(np.r_[True, np.diff(token_line) > 0])
        full[:-1] = (lt[1:] == lt[:-1]) & (ll[:-1] + 1 + tl[token_start][1:] > widest[lt[:-1]])
    # Lines that only a line width keeps apart make a paragraph.
    goes_on = np.r_[False, full[:-1] & ~bullet[1:]] if m else full
    paragraph = np.cumsum(~goes_on) - 1
    in_paragraphs = lambda each: np.bincount(paragraph, each)[paragraph] if m else each
    p_words = in_paragraphs(words_in)
    p_sentence = (p_words >= 6) & np.where(in_paragraphs((~shouted).astype(int)) == 0, in_paragraphs(known) >= 0.3 * p_words, in_paragraphs(told) >= 0.5 * p_words)
    by_chars = lambda mask: _share(np.bincount(lt[mask], ll[mask], minlength=n), chars)
    spread = np.sqrt(np.maximum(0, _share(np.bincount(lt, ll.astype(float) ** 2, minlength=n), n_lines) - _share(chars, n_lines) ** 2))

    columns = []
    for d in DELIMITERS:
        mark = codes == ord(d)
        if d == ",":
            mark = mark & ~space_after
        if not mark.any():
            columns.append(np.zeros(n))
            continue
        held = in_lines(sums(mark))
        held[sentence] = 0
        some = held >= (1 if d in "\t|¦" else 2)
        most, regular = np.zeros(n), np.zeros(m, dtype=bool)
        if some.any():
            # How often each number of marks occurs in a text's lines; the commonest makes the columns.
            keys, place, times = np.unique(lt[some].astype(np.int64) << 32 | held[some], return_inverse=True, return_counts=True)
            np.maximum.at(most, keys >> 32, times)
            regular[some] = (times[place] == most[lt[some]]) & (times[place] >= 3)
        columns.append(by_chars(regular))

    out = [
        np.log1p(sizes), np.log1p(n_lines), _share(chars, n_lines), spread / (1 + _share(chars, n_lines)), _share(n_words, n_tokens), _share(np.bincount(wt, length, minlength=n), n_words), _share(longest, sizes), _share(by_token(tl >= 25, tl), sizes),
        _share(by_token(tl == 1), n_tokens), _share(by_token(is_hex), n_tokens), _share(by_word(is_common), n_words), _share(in_texts(digits_), sizes), _share(in_texts(uppers_), sizes), _share(in_texts(letters_), sizes), _share(in_texts(symbols_), sizes), by_chars(stopped),
        _share(different, n_words), _share(different_pairs, n_pairs), _share(by_word(lower), n_words), _share(by_word(vowelless), n_words), _share(furniture, n_tokens), _share(in_texts(garbled_), sizes), _share(in_texts(tags_), sizes), _share(in_texts(sums(separator)), n_tokens),
        by_chars(bullet), by_chars(sentence), by_chars(short), by_chars(in_run), by_chars(repeated), by_chars(ruled), by_chars(gap), by_chars(full), by_chars(p_sentence), by_chars(classes[ls] & _LOWER > 0), by_chars(~p_sentence & ~stopped),
        by_chars((in_lines(letters_) * 3 < ll) & (in_lines(symbols_) * 5 > 2 * ll)), by_chars((tokens_in >= 8) & (by_token(tl == 1, None, m, token_line) > 0.7 * tokens_in)), by_chars((words_in >= 8) & (by_word(vowelless, m, word_line) > 0.5 * words_in)),
        by_chars((tokens_in >= 8) & (by_token(is_hex, None, m, token_line) > 0.6 * tokens_in)), by_chars(in_lines(garbled_) * 40 > ll), by_chars(in_lines(tags_) * 12 > ll), by_chars(by_token(tl >= 32, tl, m, token_line) * 2 > ll), *columns,
    ]
    return np.stack(out, axis=1).astype(float)
