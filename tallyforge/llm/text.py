"""Vectorised text primitives on Arrow batches: words, hashes and windows of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes of texts that a worker works on at once (or one longer text): its arrays take some hundred bytes for each.
CHUNK = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_PRIME = (1 << 61) - 1
_PRIME_BASE = 0x1F0A3D5C7B9E2467
_M30, _M31 = U((1 << 30) - 1), U((1 << 31) - 1)
_tables: dict[str, tuple[np.ndarray, ...]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection on 64-bit words."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & U(_PRIME)) + (x >> U(61))
    return np.where(x >= U(_PRIME), x - U(_PRIME), x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo 2**61 - 1 of numbers below that, in halves of 31 bits."""
    a1, a0, b1, b0 = a >> U(31), a & _M31, b >> U(31), b & _M31
    mid = a1 * b0 + a0 * b1
    return _reduced((a1 * b1 << U(1)) + (mid >> U(30)) + ((mid & _M30) << U(31)) + a0 * b0)


def _kept_tables(name: str, n: int, make) -> tuple[np.ndarray, ...]:
    """make(size) of n values or more, kept but for one very long text's."""
    if name not in _tables or len(_tables[name][0]) < n:
        made = make(max(n, CHUNK))
        if len(made[0]) > 16 * CHUNK:
            return made
        _tables[name] = made
    return _tables[name]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""

    def make(size: int):
        table = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            step = np.full(size, base, U)
            step[0] = 1
            table.append(np.cumprod(step))
        return tuple(table)

    return _kept_tables("word", n, make)


def _prime_powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base**i modulo 2**61 - 1 for i < n, its low 31 bits and the rest, and base**-i."""

    def make(size: int):
        table = []
        for base in (_PRIME_BASE, pow(_PRIME_BASE, -1, _PRIME)):
            out = np.ones(1, U)
            while len(out) < size:
                out = np.concatenate([out, _times(out, np.array([pow(base, len(out), _PRIME)], U))])
            table.append(out[:size])
        return (table[0] & _M31).astype(np.uint32), (table[0] >> U(31)).astype(np.uint32), table[1].copy()

    return _kept_tables("prime", n, make)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = column.buffers()
    at = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if column.null_count:
        size = np.diff(at) * column.is_valid().to_numpy(zero_copy_only=False)
        if (size != np.diff(at)).any():
            return flat(column.fill_null(""))
    return buf[at[0] : at[-1]], at - at[0]


def chunks(buf: np.ndarray, at: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of documents i..j with at most limit bytes (or one longer document), with own bytes and offsets."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield i, j, buf[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def words(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and documents of the words [^\\x20\\x09-\\x0D]+; none spans two documents."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~((buf == 32) | ((buf >= 9) & (buf <= 13)))
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    first = at[:-1][np.diff(at) > 0]
    before[first] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[first[1:] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(at, starts, "right") - 1


def prefix_hash(buf: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Prefix sums of byte * base**i modulo 2**61 - 1, in two halves, and base**-i."""
    low, high, down = _prime_powers(len(buf) + 1)
    low, high = (np.multiply(buf, x[: len(buf)], dtype=U) for x in (low, high))
    if len(buf) > 1 << 24:  # sums of so many could pass 64 bits: reduce each
        low, high = low & _M31, high + (low >> U(31))
        low, high = low + (high >> U(30)), high & _M30
    sums = np.zeros((2, len(buf) + 1), U)
    np.cumsum(low, out=sums[0, 1:])
    np.cumsum(high, out=sums[1, 1:])
    return (sums[0], sums[1]), down


def span_hash(sums: tuple[np.ndarray, np.ndarray], down: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans' contents, independent of where they stand.

    Two contents of n values collide for n / 2**61 of all bases at most; modulo a power of two some
    contents would collide for every base.
    """
    low, high = (s[ends] - s[starts] for s in sums)
    whole = _reduced((high >> U(30)) + ((high & _M30) << U(31)) + low)
    return mix(_times(whole, down[starts]) + (ends - starts).astype(U) * U(0x9E3779B97F4A7C15))


def prefix_sums(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As prefix_hash(), modulo 2**64: cheaper, for spans under 512 values, or where a collision does no harm."""
    up, down = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, U)
    np.cumsum((values.astype(U) + U(1)) * up[: len(values)], out=total[1:])
    return total, down


def quick_hash(total: np.ndarray, down: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """As span_hash(), of prefix_sums()."""
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U))


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return np.where((buf >= 65) & (buf <= 90), buf + np.uint8(32), buf)


def windows(word: np.ndarray, doc: np.ndarray, n_docs: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, their documents and first words; no run spans two documents."""
    k = len(word) - size + 1
    if k <= 0:
        z = np.zeros(0, np.int64)
        return np.zeros(0, U), z, z
    h = np.zeros(k, U)
    for i in range(size):
        h = mix(h + word[i : i + k] + U(i + 1))
    ok = np.flatnonzero(doc[:k] == doc[size - 1 :])
    return h[ok], doc[ok], ok


def shingle_sets(buf: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every document and n + 1 offsets.

    Words are lower-cased (A-Z); a text with fewer words than ``size`` has its whole sequence as its
    one shingle, a text without words the empty set.
    """
    n = len(at) - 1
    starts, ends, doc = words(buf, at)
    word = span_hash(*prefix_hash(lower_ascii(buf)), starts, ends)
    h, owner, _ = windows(word, doc, n, size)
    count = np.bincount(doc, minlength=n)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        first = np.searchsorted(doc, short)
        last = first + count[short]
        whole = np.zeros(len(short), U)
        for i in range(size - 1):
            live = first + i < last
            whole[live] = mix(whole[live] + word[first[live] + i] + U(i + 1))
        h, owner = np.concatenate([h, mix(whole + U(size))]), np.concatenate([owner, short])
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[keep], owner[keep]
    return h, np.searchsorted(owner, np.arange(n + 1))


class HashIndex:
    """An open-addressed table of non-negative 64-bit keys -> 32-bit values, searched side by side."""

    def __init__(self, bits: int):
        self.bits = bits
        self.clear()

    def clear(self) -> None:
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        self.n = 0

    def _slots(self, key: np.ndarray) -> np.ndarray:
        slot = ((key.view(U) * U(0x9E3779B97F4A7C15)) >> U(64 - self.bits)).astype(np.int64)
        found = self.keys[slot]
        todo = np.flatnonzero((found != key) & (found != -1))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[todo]]
            todo = todo[(found != key[todo]) & (found != -1)]
        return slot

    def put(self, key: np.ndarray, value: np.ndarray) -> None:
        """Adds distinct keys; the table is to stay at most half full."""
        todo = np.arange(len(key))
        while len(todo):
            slot = self._slots(key[todo])
            self.keys[slot] = key[todo]  # of several for a free slot the last one stays
            own = self.keys[slot] == key[todo]
            self.values[slot[own]] = value[todo[own]]
            todo = todo[~own]
        self.n += len(key)

    def find(self, key: np.ndarray) -> np.ndarray:
        """Values, -1 where a key is missing."""
        slot = self._slots(key)
        return np.where(self.keys[slot] == key, self.values[slot], -1)
