"""Byte-pair merging with a heap over a linked list, and the splitting rules of the public byte-level vocabularies."""

from __future__ import annotations

import heapq
import json
import unicodedata

import regex

#: Fixed value: how the byte-level vocabulary splits text.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Fixed value: how the word-end vocabulary finds words in normalised text.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Visible Latin-1 characters stand for themselves, the other bytes take the code points from 256 on.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(visible) else chr(next(spare)) for b in range(256)]


def merge_pairs(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """The symbols after merging the adjacent pair of lowest rank, leftmost first, until no pair has a rank.

    A heap holds the pairs; the symbols are a linked list, so a merge costs the logarithm of the length.
    """
    n = len(symbols)
    if n < 2:
        return symbols
    parts: list = list(symbols)
    after = [*range(1, n), -1]
    before = [*range(-1, n - 1)]
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get((parts[i], parts[i + 1]))) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if j < 0 or parts[i] is None or ranks.get((parts[i], parts[j])) != rank:
            continue  # one of the two has been merged meanwhile
        parts[i] += parts[j]
        parts[j] = None
        after[i] = k = after[j]
        if k >= 0:
            before[k] = i
            if (r := ranks.get((parts[i], parts[k]))) is not None:
                heapq.heappush(heap, (r, i))
        if (h := before[i]) >= 0 and (r := ranks.get((parts[h], parts[i]))) is not None:
            heapq.heappush(heap, (r, h))
    return [p for p in parts if p is not None]


class Vocabulary:
    """Merge ranks, ids and special strings of a tokenizer file, with the byte alphabet."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(merges)}
        self.ids = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)))
        self.alphabet = byte_alphabet()

    def symbols(self, word: str) -> list[str]:
        """A word's first symbols: one per byte, the last one with the word end."""
        alphabet = self.alphabet
        out = [alphabet[b] for b in word.encode()]
        if out and self.suffix:
            out[-1] += self.suffix
        return out

    def segments(self, text: str) -> list[tuple[str, int | None]]:
        """Text between special strings, and the special strings with their ids."""
        out, at = [], 0
        for m in self.special_pattern.finditer(text):
            out += [(text[at : m.start()], None), (m[0], self.special[m[0]])]
            at = m.end()
        return [*out, (text[at:], None)]


def merge_short(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """As merge_pairs, for a word of few symbols: the ranks of all pairs in a list, searched for the least each time."""
    parts = list(symbols)
    none = len(ranks)
    get = ranks.get
    pairs = [get(p, none) for p in zip(parts, parts[1:], strict=False)]
    while pairs:
        least = min(pairs)
        if least == none:
            break
        i = pairs.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = get((parts[i], parts[i + 1]), none)
        if i:
            pairs[i - 1] = get((parts[i - 1], parts[i]), none)
    return parts


#: Symbols up to which a list is searched faster than a heap is kept.
SHORT = 48


def merged(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    return merge_short(symbols, ranks) if len(symbols) <= SHORT else merge_pairs(symbols, ranks)


_WORDS = regex.compile(WORD_PATTERN)


def run_words(run: bytes) -> list[str]:
    """normalised_words of a run without blanks; plain letters, with or without a full stop or comma, need no pattern."""
    if run.isalpha():
        return [run.lower().decode()]
    if run[-1:] in (b".", b",") and run[:-1].isalpha():
        return [run[:-1].lower().decode(), run[-1:].decode()]
    return normalised_words(run.decode())


def normalised_words(text: str) -> list[str]:
    """Words of the word-end vocabulary: canonical composition, lower case letter by letter, split by its pattern.

    Python lower-cases a final capital sigma by its context; the library goes letter by letter.
    """
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return _WORDS.findall(text.lower())
