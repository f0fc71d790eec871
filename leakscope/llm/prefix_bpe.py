"""BPE encoding by dynamic programming over prefixes, and decoding, for a public word-level BPE vocabulary.

A pair of tokens is compatible if merging the symbols of both together gives just these two again. A sequence of tokens
is the encoding of its string if and only if all neighbours are compatible, so every prefix of a word has one last
token: of the tokens that are suffixes of the prefix, the one that is compatible with the last token of the prefix
before it. An automaton over the vocabulary gives the suffixes of all prefixes in one pass, pairs are told by undoing
merges from the boundary outwards, and back-pointers from the end of the word give its ids. No merge is ever replayed,
and a word costs time in proportion to its length, whatever it is.

The file is read on the driver and shared; its size (49,408 tokens here) bounds what is sent. Each task keeps the ids
of frequent words, twice ``WORDS_KEPT`` at most; that decides on cost alone. Texts are split at white space into pieces of
about ``PIECE`` characters, so a long text never is a list of words at once.

Null and empty texts have no ids and decode to an empty text. Each row is encoded on its own: rows that repeat or share
an id come out as often as they go in, a null doc_id stays null, an empty table gives an empty result, and columns
other than doc_id and text are neither read nor returned, whatever their names.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

WORDS_KEPT = 1 << 18
PAIRS_KEPT = 1 << 17
PIECE = 1 << 18
_LONG = 64  # longer words are not kept

_WHITE = regex.compile(r"\s")

# Letters and digits that Unicode 16 added, and capitals of Unicode 16 and 17 with their small letters.
# The tokenizers library knows them, Python 3.13 does not yet, and the regex library knows later ones as well.
_ADDED = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D40, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x116D0, 0x116E3), (0x11BC0, 0x11BE0),
    (0x11BF0, 0x11BF9), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16130, 0x16139), (0x16D40, 0x16D6C),
    (0x16D70, 0x16D79), (0x18CFF, 0x18CFF), (0x1CCF0, 0x1CCF9), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5FA),
)
_LOWER = {
    0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB,
    0xA7DC: 0x19B, **{c: c + 32 for c in range(0x10D50, 0x10D66)}, **{c: c + 27 for c in range(0x16EA0, 0x16EB9)},
    ord("Σ"): ord("σ"),  # letters are lowered one by one, so a final sigma is like any other
}
_FIRST_LATER = "\u0558"  # code points below this are the same in all three


@cache
def _later() -> str:
    """A set of the letters and digits that only the regex library knows, as part of a pattern."""
    known = regex.compile(r"[\p{L}\p{N}]")
    added = {c for first, last in _ADDED for c in range(first, last + 1)}
    points = [c for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn" and c not in added
              and known.match(chr(c))]
    starts = [c for i, c in enumerate(points) if not i or points[i - 1] != c - 1]
    ends = [c for i, c in enumerate(points) if i + 1 == len(points) or points[i + 1] != c + 1]
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends)) + "]"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in vocabularies of bytes: itself if it is visible, else one from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


@dataclass
class WordBpe:
    """Vocabulary, merges and word pattern of a tokenizer with word ends; what is derived is built where it is used."""

    names: list[str]
    merges: list[tuple[int, int, int]]  # left, right, result; earlier ones come first
    word_end: str
    pattern: str
    special: dict[str, int]
    _kept: dict[str, bytes] = field(default_factory=dict, repr=False)
    _older: dict[str, bytes] = field(default_factory=dict, repr=False)
    _pairs: dict[int, bool] = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return {k: getattr(self, k) for k in ("names", "merges", "word_end", "pattern", "special")} | {
            "_kept": {}, "_older": {}, "_pairs": {}}

    @cached_property
    def _words(self) -> regex.Pattern:
        return regex.compile(self.pattern)

    @cached_property
    def _words_of_any(self) -> regex.Pattern:
        """The pattern for texts with code points that the libraries don't know alike."""
        pattern = self.pattern
        for known in (r"\p{L}", r"\p{N}"):
            pattern = pattern.replace(known, f"[{known}--{_later()}]")
        return regex.compile(pattern, regex.VERSION1)

    @cached_property
    def _specials(self) -> regex.Pattern | None:
        found = sorted(self.special, key=len, reverse=True)
        return regex.compile("|".join(map(regex.escape, found))) if found else None

    @cached_property
    def _rank(self) -> dict[tuple[int, int], int]:
        return {(left, right): at for at, (left, right, _) in enumerate(self.merges)}

    @cached_property
    def _made_by(self) -> list[int]:
        """The merge that makes each token; -1 for a single symbol."""
        made = [-1] * len(self.names)
        for at, (_, _, token) in enumerate(self.merges):
            made[token] = at
        return made

    @cached_property
    def _automaton(self):
        """Tokens as strings of symbols: a byte, or 256 and a byte at the end of a word."""
        import ahocorasick

        byte = {letter: b for b, letter in enumerate(byte_letters())}
        found = ahocorasick.Automaton()
        for token, name in enumerate(self.names):
            ends = name.endswith(self.word_end)
            symbols = [byte[c] for c in (name.removesuffix(self.word_end) if ends else name)]
            if ends:
                symbols[-1] += 256
            found.add_word("".join(map(chr, symbols)), (len(symbols), token))
        found.make_automaton()
        return found

    def compatible(self, left: int, right: int) -> bool:
        """Whether the symbols of both tokens merge to just these two.

        Of all merges that build the two tokens the last ones are undone first. If the parts that then touch could merge
        with each other before the merge that was undone, it would not have come to that one.
        """
        key = left * len(self.names) + right
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= PAIRS_KEPT:
                self._pairs.clear()
            known = self._pairs[key] = self._unmerge(left, right)
        return known

    def _unmerge(self, left: int, right: int) -> bool:
        rank, made, merges = self._rank, self._made_by, self.merges
        before, at_equal = len(merges), False  # the merge across must come before this one, or with it if at_equal
        while True:
            across = rank.get((left, right))
            if across is not None and (across < before or at_equal and across == before):
                return False
            if made[left] < 0 and made[right] < 0:
                return True
            if made[left] > made[right]:
                # Of equal merges the left one comes first: what was merged on the left stands against one across.
                before, at_equal = made[left], False
                left = merges[before][1]
            else:
                before, at_equal = made[right], True
                right = merges[before][0]

    def word_ids(self, word: bytes) -> list[int]:
        """The ids of one word, given as UTF-8."""
        symbols = [*map(chr, word[:-1]), chr(word[-1] + 256)]
        last, start = [-1] * len(symbols), [0] * len(symbols)
        done = -1  # the automaton gives the suffixes of one prefix after the other
        for end, (length, token) in self._automaton.iter("".join(symbols)):
            if end == done:
                continue
            before = end - length
            if before < 0 or self.compatible(last[before], token):
                last[end], start[end], done = token, before, end
        ids, at = [], len(symbols) - 1
        while at >= 0:
            ids.append(last[at])
            at = start[at]
        return ids[::-1]

    def _packed(self, word: str) -> bytes:
        ids = self._older.get(word) or np.array(self.word_ids(word.encode("utf-8", "replace")), "<u4").tobytes()
        if len(word) <= _LONG:
            if len(self._kept) >= WORDS_KEPT:
                self._older, self._kept = self._kept, {}  # words that are still met come back from there
            self._kept[word] = ids
        return ids

    def _plain_ids(self, text: str) -> bytes:
        """Ids of a text without special tokens: composed, in lower case, cut into words."""
        words = self._words
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            most = max(text, default="")
            if most >= "Σ":
                text = text.translate(_LOWER)
            if most >= _FIRST_LATER:
                words = self._words_of_any
        get, new = self._kept.get, self._packed
        return b"".join([get(word) or new(word) for word in words.findall(text.lower())])

    def ids(self, text: str | None) -> bytes:
        """Ids of a text, packed as little-endian unsigned 32-bit integers."""
        out, begin, text = [], 0, text or ""
        specials = list(self._specials.finditer(text)) if self._specials else []
        for special in [*specials, None]:
            end = special.start() if special else len(text)
            while begin < end:
                cut = end
                if end - begin > PIECE:
                    white = _WHITE.search(text, begin + PIECE, end)
                    cut = white.start() if white else end
                out.append(self._plain_ids(text[begin:cut]))
                begin = cut
            if special:
                out.append(np.uint32(self.special[special[0]]).astype("<u4").tobytes())
                begin = special.end()
        return b"".join(out)

    @cached_property
    def _table(self) -> np.ndarray:
        table = np.full(max([len(self.names) - 1, *self.special.values()]) + 1, "", object)
        table[:len(self.names)] = self.names
        for name, token in self.special.items():
            table[token] = name
        return table

    def text(self, ids: bytes) -> str:
        """The names of the tokens with blanks between, as this vocabulary has no decoder of its own."""
        return " ".join(self._table[np.frombuffer(ids, "<u4")].tolist())


def load_word_bpe(path: str) -> WordBpe:
    """Reads a tokenizer file of kind BPE with word ends, which lowers its texts and cuts them by one pattern."""
    with open(path, encoding="utf-8") as file:
        given = json.load(file)
    model, steps = given["model"], (given["pre_tokenizer"] or {}).get("pretokenizers") or [{"type": None}]
    vocab = model["vocab"]
    if model["type"] != "BPE" or not model["end_of_word_suffix"] or steps[0]["type"] != "Split" or given["decoder"]:
        raise ValueError("not a BPE vocabulary with word ends and one word pattern")
    names = [""] * len(vocab)
    for name, token in vocab.items():
        names[token] = name
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
    special = {token["content"]: token["id"] for token in given["added_tokens"]}
    return WordBpe(names, merges, model["end_of_word_suffix"], steps[0]["pattern"]["Regex"], special)


def encode(docs: DataFrame, tokenizer: WordBpe) -> DataFrame:
    """doc_id, n_tokens and ids (packed little-endian unsigned 32-bit integers) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)  # bounded by the vocabulary file

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shared.value
        for batch in batches:
            ids = [bpe.ids(text.as_py()) for text in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()),
                                   pa.array(ids, pa.binary())], names=["doc_id", "n_tokens", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(read, f"doc_id {kind}, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, tokenizer: WordBpe) -> DataFrame:
    """doc_id, n_tokens, ids and the text that the packed ids stand for; null ids give an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(tokenizer)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shared.value
        for batch in batches:
            texts = [bpe.text(ids.as_py() or b"") for ids in batch.column(2)]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())],
                                  names=["doc_id", "n_tokens", "ids", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(
        read, f"doc_id {kind}, n_tokens bigint, ids binary, text string")
