"""Pre-tokens of the byte-level BPE, found by array operations, and the pieces of distinct pre-tokens.

The pattern that splits texts before byte-level BPE is

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

Each code point is a letter, a number, white space or other, so a split is where the class changes, with three
additions: the last white space before other text is split off; a plain space there belongs to what follows; an
apostrophe that begins a pre-token takes the contraction after it. BPE works within a pre-token, therefore a distinct
pre-token has to be encoded only once. A special string inside a text is one id and parts the text.
"""

from __future__ import annotations

import json
import os
from itertools import chain
from string import ascii_lowercase

import numpy as np
import regex
from tokenizers import Tokenizer, pre_tokenizers

from cohortry.llm.scan import mix, span_hashes

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
_classes: np.ndarray | None = None


def classes() -> np.ndarray:
    """Class of each code point."""
    global _classes
    if _classes is None:
        table = np.full(0x110000, OTHER, np.uint8)
        points = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            for found in regex.finditer(pattern, points):
                table[ord(found[0][0]) : ord(found[0][-1]) + 1] = kind
        # Characters that are newer than the library's own tables are other characters to it.
        split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        for kind, neighbour in ((LETTER, "a"), (NUMBER, "0")):
            members = np.flatnonzero(table == kind)
            joined = neighbour + neighbour.join(map(chr, members.tolist()))
            for _, (a, b) in split.pre_tokenize_str(joined):
                if a % 2 and b == a + 1:
                    table[ord(joined[a])] = OTHER
        _classes = table
    return _classes


def pretokens(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each pre-token and the number of its text; each ends where the next starts. ``offsets`` parts the texts."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = classes()[points]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    edge = edge[:-1]
    start = edge.copy()
    start[1:] |= kind[1:] != kind[:-1]
    # The last white space of a run that other text follows stands alone, or leads what follows if it is a space.
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~edge[1:])
    start[last] = True
    start[last[points[last] == 32] + 1] = False
    # Contractions: an apostrophe that begins a pre-token of its own, before a letter.
    mark = np.flatnonzero((points[:-1] == 39) & start[:-1] & (kind[1:] == LETTER) & ~edge[1:])
    if len(mark):
        def at(i: np.ndarray, reach: int) -> np.ndarray:
            """Code point ``reach`` places on, 0 beyond the text."""
            to = i + reach
            inside = to < n
            inside[inside] = offsets[np.searchsorted(offsets, i[inside], "right")] > to[inside]
            return np.where(inside, points[np.minimum(to, n - 1)], 0)

        one, two = at(mark, 1), at(mark, 2)
        long = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
        short = np.isin(one, [115, 116, 109, 100])
        for chosen, width in ((mark[long], 3), (mark[short], 2)):
            start[chosen + 1] = False
            beyond = chosen + width
            beyond = beyond[beyond < n]
            start[beyond] = True
    starts = np.flatnonzero(start)
    return starts, np.searchsorted(offsets, starts, "right") - 1


#: Normalisers that leave a word of small ASCII letters as it is, and the pre-tokeniser that keeps such a word whole.
NEUTRAL = ({"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "})
SUFFIX = "</w>"
KEEPS_WORDS = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def _model_of_words(tokenizer: Tokenizer, special: dict[str, int]) -> Tokenizer | None:
    """The tokenizer's model alone, if it gives a word of ASCII letters in lower case the ids that the tokenizer gives the word.

    Its last id is then one with the suffix, as each letter has an id with it and one without.
    """
    made = json.loads(tokenizer.to_str())
    steps = (made["normalizer"] or {}).get("normalizers", [])
    lowers = {"type": "Lowercase"} in steps and all(x in NEUTRAL or x == {"type": "Lowercase"} for x in steps)
    model = made["model"]
    closed = model.get("end_of_word_suffix") == SUFFIX and model["dropout"] is None and all(c + SUFFIX in model["vocab"] and c in model["vocab"] for c in ascii_lowercase)
    if lowers and closed and made["pre_tokenizer"] == KEEPS_WORDS and not any(s.isalpha() for s in special):
        return Tokenizer(tokenizer.model)
    return None


class Encoder:
    """A tokenizer file and the ids of pre-tokens met before, at most ``limit`` of them at a time.

    The library's own threads stay off unless the environment asks for them: tasks fill the cores already.
    """

    def __init__(self, path: str, limit: int = 600_000) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.pattern = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.words = _model_of_words(self.tokenizer, self.special)
        #: Whether an id is the last one of a word: its string has the suffix.
        self.ending = np.zeros(self.tokenizer.get_vocab_size(), bool)
        if self.words is not None:
            self.ending[[i for t, i in self.words.get_vocab().items() if t.endswith(SUFFIX)]] = True
        self.limit = limit
        self._clear()

    def _clear(self) -> None:
        empty = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        #: Sorted hashes, first place and number of ids: many, and the few that came last.
        self.known, self.recent = empty, empty
        self.ids = np.zeros(1 << 16, np.uint32)
        self.filled = 0

    def split(self, text: str, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Start, end, hash and text number of each pre-token of ``text``, whose parts are the texts.

        A special string is a pre-token too; its hash is that of its text, as no other pre-token contains it.
        """
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        found = [(m.start(), m.end()) for m in self.pattern.finditer(text)] if any(s in text for s in self.special) else []
        if found:
            edges = np.array(found, np.int64)
            owners = np.searchsorted(offsets, edges, "right") - 1
            inside = (edges[:, 1] <= offsets[owners[:, 0] + 1])
            edges = edges[inside]
            parted = np.unique(np.concatenate([offsets, edges.ravel()]))
            starts, _ = pretokens(points, parted)
            ends = np.append(starts[1:], len(points))
            # What lies within a special string is one pre-token.
            within = np.searchsorted(edges[:, 0], starts, "right") - 1
            covered = (within >= 0) & (starts < edges[np.maximum(within, 0), 1]) if len(edges) else np.zeros(len(starts), bool)
            keep = ~covered | np.isin(starts, edges[:, 0])
            starts = starts[keep]
            ends = np.append(starts[1:], len(points))
        else:
            starts, _ = pretokens(points, offsets)
            ends = np.append(starts[1:], len(points))
        values = mix((points.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        owner = np.searchsorted(offsets, starts, "right") - 1
        return starts, ends, span_hashes(values, starts, ends), owner

    def encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        """Ids of single pre-tokens."""
        return [x.ids for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def encode_flat(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First place and number of the ids of single pre-tokens, and these ids.

        Words of ASCII letters go to the model directly, in one call, where that is the same.
        """
        plain = np.zeros(len(pieces), bool)
        first, count, ids = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64), np.zeros(0, np.uint32)
        if self.words is not None:
            plain = np.fromiter((p.isascii() and p.isalpha() for p in pieces), bool, len(pieces))
            words = [pieces[i].lower() for i in np.flatnonzero(plain).tolist()]
            if words:
                ids = np.array(self.words.encode_batch_fast([words], is_pretokenized=True, add_special_tokens=False)[0].ids, np.uint32)
                ends = np.flatnonzero(self.ending[ids]) + 1
                if len(ends) != len(words):
                    raise ValueError("a word without an id that ends it")
                count[plain] = np.diff(ends, prepend=0)
                first[plain] = ends - count[plain]
        lists = self.encode_pieces([pieces[i] for i in np.flatnonzero(~plain).tolist()])
        count[~plain] = np.fromiter(map(len, lists), np.int64, len(lists))
        first[~plain] = len(ids) + np.cumsum(count[~plain]) - count[~plain]
        return first, count, np.concatenate([ids, np.fromiter(chain.from_iterable(lists), np.uint32)])

    def lookup(self, hashes: np.ndarray, text: str, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First place in ``self.ids`` and number of ids of each distinct pre-token; encodes those not met before."""
        if len(self.known[0]) + len(self.recent[0]) + len(hashes) > self.limit:
            self._clear()
        first, count = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        fresh = np.ones(len(hashes), bool)
        for table in (self.known, self.recent):
            if len(table[0]):
                at = np.minimum(np.searchsorted(table[0], hashes), len(table[0]) - 1)
                met = table[0][at] == hashes
                first[met], count[met] = table[1][at[met]], table[2][at[met]]
                fresh &= ~met
        fresh = np.flatnonzero(fresh)
        if len(fresh):
            place, count[fresh], made = self.encode_flat([text[a:b] for a, b in zip(starts[fresh].tolist(), ends[fresh].tolist(), strict=True)])
            more = len(made)
            first[fresh] = self.filled + place
            if self.filled + more > len(self.ids):
                self.ids = np.concatenate([self.ids[: self.filled], np.zeros(max(more, self.filled), np.uint32)])
            self.ids[self.filled : self.filled + more] = made
            self.filled += more
            self.recent = self._merged(self.recent, (hashes[fresh], first[fresh], count[fresh]))
            if len(self.recent[0]) > 20_000 + len(self.known[0]) // 8:
                self.known, self.recent = self._merged(self.known, self.recent), tuple(x[:0] for x in self.recent)
        return first, count

    @staticmethod
    def _merged(table: tuple, more: tuple) -> tuple:
        joined = [np.concatenate(x) for x in zip(table, more, strict=True)]
        order = np.argsort(joined[0], kind="stable")
        return tuple(x[order] for x in joined)


_encoders: dict[str, Encoder] = {}


def encoder(path: str, limit: int = 600_000) -> Encoder:
    """One encoder for each file in a worker; it outlives the task. The largest limit that was asked for holds."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, limit)
    _encoders[path].limit = max(_encoders[path].limit, limit)
    return _encoders[path]


def code_point_offsets(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Offsets in code points, from offsets in UTF-8 bytes."""
    heads = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
    return heads[offsets]
