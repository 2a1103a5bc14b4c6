"""Public tokenizer files: splitting texts into pre-tokens and encoding pre-tokens.

The text of a document is cut into *units* first: pre-tokens, which are encoded
one by one, and added tokens (``<|endoftext|>``), which have an id of their own.
A unit's ids do not depend on its neighbours, which is what lets the operators
encode each distinct unit once.

Texts of Latin-1 characters are split by a compiled pattern with the character
classes written out; all others by the tokenizers library itself, so that its
Unicode tables decide. A test holds the two against each other for every Latin-1
character.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np

_LETTER, _NUMBER, _SPACE = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", "\\t-\\r \\x85\\xa0"
_SHORT = "'(?:s|t|re|ve|m|ll|d)"
#: What the two pre-tokenizers match, for Latin-1 texts.
_WITH_SPACE = (
    rf"{_SHORT}| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
_NO_SPACE = rf"{_SHORT}|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+"

#: Pre-tokens of more bytes go to the library: merging them takes a round for each distinct rank.
LONG_UNIT = 256
_NONE = np.iinfo(np.int32).max


def default_path(name: str) -> str:
    """Where the public tokenizer files of this machine lie."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next free one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(free)) for b in range(256)]


class PairRanks:
    """Rank of a pair of symbols: one probe of a sparse table, a search for the few pairs that collide in it."""

    BITS = 21
    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: np.ndarray):
        self.keys = keys.astype(np.uint64)
        slots = self._slot(self.keys)
        self.table = np.zeros(1 << self.BITS, np.int32)
        self.table[slots] = np.arange(len(keys), dtype=np.int32)
        lost = np.flatnonzero(self.table[slots] != np.arange(len(keys)))
        self.crowded = np.zeros(1 << self.BITS, bool)
        self.crowded[slots[lost]] = True
        order = np.argsort(self.keys[lost])
        self.lost_ranks, self.lost_keys = lost[order].astype(np.int32), self.keys[lost][order]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * self.FACTOR) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slots = self._slot(keys)
        ranks = self.table[slots]
        found = self.keys[ranks] == keys
        ranks = np.where(found, ranks, _NONE)
        again = np.flatnonzero(self.crowded[slots] & ~found)
        if len(again):
            at = np.minimum(np.searchsorted(self.lost_keys, keys[again]), len(self.lost_keys) - 1)
            hit = self.lost_keys[at] == keys[again]
            ranks[again[hit]] = self.lost_ranks[at[hit]]
        return ranks


class Units:
    """One tokenizer file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.lower = spec["normalizer"] is not None
        self.pattern = re.compile(_NO_SPACE if self.lower else _WITH_SPACE)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.hints = tuple(self.added)
        model, alphabet = spec["model"], byte_alphabet()
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.n_ids = max(chain(self.vocab.values(), self.added.values())) + 1
        self.byte_ids = np.array([self.vocab[c] for c in alphabet], np.int32)
        self.end_ids = np.array([self.vocab[c + self.suffix] for c in alphabet], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merged = np.array([self.vocab[a + b] for a, b in pairs], np.int32)
        self.ranks = PairRanks(np.array([self.vocab[a] * self.n_ids + self.vocab[b] for a, b in pairs]))

    # ---- splitting -----------------------------------------------------------

    def _split_plain(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            if self.library.normalizer is not None:
                text = self.library.normalizer.normalize_str(text)
            # the library gives byte-level pieces; the offsets are those of its own text
            return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return self.pattern.findall(text.lower() if self.lower else text)

    def split(self, text: str) -> list[str]:
        """The units of a text, in order. An added token is the unit of its own string."""
        if not any(h in text for h in self.hints):
            return self._split_plain(text)
        return list(
            chain.from_iterable(
                [part] if part in self.added else self._split_plain(part) for part in self.cut.split(text) if part
            )
        )

    # ---- encoding ------------------------------------------------------------

    def library_ids(self, units: list[str]) -> list[list[int]]:
        """Ids of each unit by the library."""
        plain = [u for u in units if u not in self.added]
        ids: list[list[int]] = [[] for _ in plain]
        encoded = self.library.encode(plain, is_pretokenized=True, add_special_tokens=False)
        for unit, token in zip(encoded.word_ids, encoded.ids):
            ids[unit].append(token)
        rest = iter(ids)
        return [[self.added[u]] if u in self.added else next(rest) for u in units]

    def merge(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units in one array, and how many each has.

        Rank-synchronous: all units are held as one ragged array of symbols. In
        every round each unit merges all places of its own lowest-rank pair,
        from the left where they overlap, and units without a known pair leave.
        """
        raw = [u.encode() for u in units]
        apart = [k for k, (u, r) in enumerate(zip(units, raw)) if len(r) > LONG_UNIT or u in self.added]
        known = dict(zip(apart, self.library_ids([units[k] for k in apart]))) if apart else {}
        for k in apart:
            raw[k] = b""
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.byte_ids[flat]
        if self.suffix:
            last = np.cumsum(sizes)[sizes > 0] - 1
            symbols[last] = self.end_ids[flat[last]]
        owner = np.repeat(np.arange(len(raw)), sizes)
        done = [(np.full(len(v), k), np.array(v, np.int32)) for k, v in known.items() if v]
        width = np.uint64(self.n_ids)
        while len(symbols):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            ranks = np.full(len(symbols), _NONE, np.int32)
            inner = np.flatnonzero(owner[1:] == owner[:-1])
            ranks[inner] = self.ranks(symbols[inner].astype(np.uint64) * width + symbols[inner + 1].astype(np.uint64))
            best = np.repeat(np.minimum.reduceat(ranks, first), np.diff(np.r_[first, len(symbols)]))
            over = best == _NONE
            if over.any():
                done.append((owner[over], symbols[over]))
                symbols, owner, ranks, best = symbols[~over], owner[~over], ranks[~over], best[~over]
            if not len(symbols):
                break
            hit = ranks == best
            places = np.flatnonzero(hit)
            # a run of touching places is one symbol repeated: take every other one
            fresh = np.r_[True, np.diff(places) != 1]
            nth = np.arange(len(places)) - np.maximum.accumulate(np.where(fresh, np.arange(len(places)), 0))
            places = places[nth % 2 == 0]
            symbols[places] = self.merged[ranks[places]]
            stay = np.ones(len(symbols), bool)
            stay[places + 1] = False
            symbols, owner = symbols[stay], owner[stay]
        if not done:
            return np.zeros(0, np.int32), np.zeros(len(units), np.int64)
        owner, symbols = np.concatenate([o for o, _ in done]), np.concatenate([s for _, s in done])
        return symbols[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(units))

    # ---- decoding ------------------------------------------------------------

    def pieces(self) -> list[bytes | None]:
        """The bytes of every id (None: no such id)."""
        back = {c: b for b, c in enumerate(byte_alphabet())}
        out: list[bytes | None] = [None] * self.n_ids
        for piece, k in self.vocab.items():
            text, end = (piece[: -len(self.suffix)], b" ") if self.suffix and piece.endswith(self.suffix) else (piece, b"")
            out[k] = bytes(back[c] for c in text) + end if all(c in back for c in text) else piece.encode()
        for piece, k in self.added.items():
            out[k] = piece.encode()
        return out


@lru_cache(maxsize=4)
def load_units(path: str) -> Units:
    """The tokenizer of a file, once per Python process."""
    return Units(path)
