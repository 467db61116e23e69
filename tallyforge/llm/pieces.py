"""Texts as pieces between spaces, whose token ids a worker works out once and remembers.

A byte-level pattern never joins what stands before and after a space that has a character other than
white space on either side, so a text's ids are those of its pieces, one after another.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from .text import HashIndex, U, prefix_hash, span_hash
from .text import flat as flat_bytes

#: Bytes of the longest piece that is remembered.
_LONGEST = 64
#: Another value for each byte, for a second hash.
_SCRAMBLED = np.random.default_rng(1).permutation(256).astype(np.uint8)
_SPLIT = re.compile(r"(?<!\s) | (?!\s)")
_ASCII_SPACE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
_ODD_SPACE = re.compile(r"[^\S \n]")
def _odd(text: str) -> bool:
    """Whether a space may stand between two characters of white space; such texts are split with care."""
    if text.isascii() and not any(c in text for c in _ASCII_SPACE):
        return "   " in text or ("\n " in text and " \n" in text)
    return "   " in text or ("\n " in text and " \n" in text) or _ODD_SPACE.search(text) is not None


def pieces(text: str) -> list[str]:
    """Pieces of a text: the first as it is, every other one without the space before it."""
    return _SPLIT.split(text) if _odd(text) else text.split(" ")


def gather(flat: np.ndarray, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The concatenated lists of ``rows`` of a ragged array, and the list sizes."""
    size = at[rows + 1] - at[rows]
    total = int(size.sum())
    if not total:
        return flat[:0], size
    return flat[np.repeat(at[rows] - (np.cumsum(size) - size), size) + np.arange(total)], size


class Memo:
    """Ragged integer values of strings; ``solve`` gets those that it doesn't know.

    Strings are known by 63 bits of one hash and 32 of another, so that none are kept; those over
    ``_LONGEST`` bytes are solved each time. It forgets all when it holds over half its slots.
    """

    def __init__(self, solve: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], bits: int = 22):
        self.solve, self.bits = solve, bits
        self.forget()

    def forget(self) -> None:
        self.index: HashIndex | None = None
        self.flat, self.at, self.used, self.n = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64), 0, 0
        self.check = np.zeros(1 << 14, np.uint32)

    def _add(self, flat: np.ndarray, size: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Stores values; their rows."""
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.n + len(size) + 1 > len(self.at):
            self.at, self.check = np.concatenate([self.at, np.zeros_like(self.at)]), np.concatenate([self.check, np.zeros_like(self.check)])
        rows = np.arange(self.n, self.n + len(size))
        self.flat[self.used : self.used + len(flat)] = flat
        self.at[rows + 1] = self.used + np.cumsum(size)
        self.check[rows] = check
        self.used, self.n = self.used + len(flat), self.n + len(size)
        return rows

    def rows(self, keys: pa.Array, first: np.ndarray) -> np.ndarray:
        """Positions of the values of keys (distinct but for first ones) in flat and at, until the next call.

        Before a key that isn't ``first``, a space is understood.
        """
        if 2 * self.n > 1 << self.bits:
            self.forget()
        if self.index is None:
            self.index = HashIndex(self.bits)
        buf, at = flat_bytes(keys)
        sums, down = prefix_hash(buf)
        h = span_hash(sums, down, at[:-1], at[1:])
        other = span_hash(prefix_hash(_SCRAMBLED[buf])[0], down, at[:-1], at[1:])
        key = (np.where(first, ~h, h) >> U(1)).view(np.int64)
        check = (other >> U(32)).astype(np.uint32)
        rows = self.index.find(key).astype(np.int64)
        known = rows >= 0
        new = ~known & (np.diff(at) <= _LONGEST)
        known[known] = self.check[rows[known]] == check[known]
        if len(miss := np.flatnonzero(~known)):
            texts = [p if f else " " + p for p, f in zip(keys.take(pa.array(miss)).to_pylist(), first[miss].tolist(), strict=True)]
            rows[miss] = self._add(*self.solve(texts), check[miss])
            own = np.flatnonzero(new)
            _, one = np.unique(key[own], return_index=True)
            self.index.put(key[own[one]], rows[own[one]].astype(np.int32))
        return rows


class PieceMemo(Memo):
    """Values of the pieces of texts."""

    def texts(self, texts: list[str | None], limit: int = 1 << 21) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Runs i..j of texts of about ``limit`` characters: rows of all their pieces, pieces of each text.

        Arrow splits a run's texts and finds their distinct pieces; only these are looked up.
        """
        i = 0
        while i < len(texts):
            j, size = i, 0
            while j < len(texts) and (not size or size + len(texts[j] or "") <= limit):
                size += len(texts[j] or "") + 1
                j += 1
            run = [t or "" for t in texts[i:j]]
            odd = [k for k, t in enumerate(run) if t and _odd(t)]
            split = pc.split_pattern(pa.array(run, pa.large_string()), " ")
            counts = split.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            coded = split.flatten().dictionary_encode()
            keys, extra = coded.dictionary, []
            index = coded.indices.to_numpy().astype(np.int64)
            if odd:
                parts, at, edge = [], 0, np.concatenate([[0], np.cumsum(counts)])
                for k in odd:
                    own = _SPLIT.split(run[k])
                    parts += [index[at : edge[k]], np.arange(len(keys) + len(extra), len(keys) + len(extra) + len(own))]
                    extra += own
                    counts[k], at = len(own), edge[k + 1]
                index = np.concatenate([*parts, index[at:]])
            if len(empty := [k for k, t in enumerate(run) if not t]):  # Arrow makes one empty piece of an empty text
                index = np.delete(index, np.cumsum(counts)[empty] - 1)
                counts[empty] = 0
            first = (np.cumsum(counts) - counts)[counts > 0]
            keys = pa.concat_arrays([keys, pa.array(extra, pa.large_string())])
            heads = keys.take(pa.array(index[first]))
            index[first] = np.arange(len(keys), len(keys) + len(heads))
            at_start = np.arange(len(keys) + len(heads)) >= len(keys)
            yield i, j, self.rows(pa.concat_arrays([keys, heads]), at_start)[index], counts
            i = j

    def values(self, texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Runs i..j of texts: their concatenated values, and the number of values of each text."""
        for i, j, rows, counts in self.texts(texts):
            flat, size = gather(self.flat, self.at, rows)
            ends = np.concatenate([[0], np.cumsum(size)])
            edge = np.concatenate([[0], np.cumsum(counts)])
            yield i, j, flat, np.diff(ends[edge])


class WordMemo(Memo):
    """Values of the words of a pattern; values() makes those of pieces from them."""

    def __init__(self, solve: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], pattern: str):
        super().__init__(solve)
        self.words_of = regex.compile(pattern).findall

    def _split(self, pieces: list[str]) -> tuple[list[str], np.ndarray]:
        """Words of all pieces, and their number in each. Pieces whose first two characters are a space and
        none are split in one go: a word never spans two of them."""
        joint = np.fromiter((p[:1] == " " and len(p) > 1 and not p[1].isspace() for p in pieces), bool, len(pieces))
        own = [p for p, j in zip(pieces, joint.tolist(), strict=True) if j]
        words = self.words_of("".join(own))
        ends, edge = np.cumsum(np.fromiter(map(len, own), np.int64, len(own))), np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        last = np.searchsorted(edge, ends)
        if len(own) and not (edge[last] == ends).all():
            raise AssertionError("a word spans two pieces")
        counts = np.zeros(len(pieces), np.int64)
        counts[joint] = np.diff(np.concatenate([[-1], last]))
        if joint.all():
            return words, counts
        place = {i: self.words_of(pieces[i]) for i in np.flatnonzero(~joint).tolist()}
        out, at = [], 0
        for i, n in enumerate(counts.tolist()):
            if i in place:
                out += place[i]
                counts[i] = len(place[i])
            else:
                out += words[at : at + n]
                at += n
        return out, counts

    def values(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words, counts = self._split(pieces)
        coded = pa.array(words, pa.large_string()).dictionary_encode()
        rows = self.rows(coded.dictionary, np.ones(len(coded.dictionary), bool))[coded.indices.to_numpy()]
        flat, size = gather(self.flat, self.at, rows)
        return flat, np.diff(np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)])])
