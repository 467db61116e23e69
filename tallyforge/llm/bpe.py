"""Byte-level BPE in numpy: all distinct words of a batch are merged side by side.

Words are grouped by length into padded matrices of token ids, one row for each. In every round each
row merges its leftmost pair of lowest rank; ranks are looked up in a hash table of pairs, only the two
pairs next to a merge anew, and rows without a pair leave the matrix. Words over ``_LONG`` bytes use a
heap of pairs instead, as a row of them would need as many rounds as it has bytes.

encode() returns what the rank file's library does: words of the pattern apart, a word that is itself a
token at once. Rows: a null text counts as empty and has no ids; nothing depends on doc_id, so null and
repeated ones are kept as they are.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import kept, lean
from .pieces import PieceMemo, gather

_LONG = 256
_NONE = np.int32(0x7FFFFFFF)


class PairTable:
    """Open-addressed hash table of token pairs -> (rank, id of the merged token)."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        self.bits = max(4, (3 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.rank = np.full(1 << self.bits, _NONE, np.int32)
        self.made = np.full(1 << self.bits, -1, np.int32)
        key = np.array([a << 32 | b for a, b in pairs], np.int64).reshape(-1)
        value = np.array(list(pairs.values()), np.int32).reshape(-1, 2)
        slot, todo = self._slot(key), np.arange(len(key))
        while len(todo):
            free = todo[self.keys[slot[todo]] == -1]
            self.keys[slot[free]] = key[free]  # of several for a slot the last one stays
            own = todo[self.keys[slot[todo]] == key[todo]]
            self.rank[slot[own]], self.made[slot[own]] = value[own, 0], value[own, 1]
            todo = todo[self.keys[slot[todo]] != key[todo]]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slots of the pairs; a slot without a pair has rank _NONE. Padding is -1."""
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        key = np.where((left < 0) | (right < 0), np.int64(-2), key)
        slot = self._slot(key)
        todo = np.flatnonzero((self.keys[slot] != key) & (self.keys[slot] != -1))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[todo]]
            todo = todo[(found != key[todo]) & (found != -1)]
        return slot


class BytePairs:
    """tokens: bytes -> id. pairs: (id, id) -> (rank, id). whole: words that are tokens aren't split."""

    def __init__(self, tokens: dict[bytes, int], pairs: dict[tuple[int, int], tuple[int, int]], whole: bool):
        self.tokens, self.whole, self.pairs = tokens, whole, pairs
        self.single = np.array([tokens[bytes([i])] for i in range(256)], np.int32)
        self.table = PairTable(pairs)
        by_id = [b""] * (max(tokens.values()) + 1)
        for k, v in tokens.items():
            by_id[v] = k
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.bytes_at = np.concatenate([[0], np.cumsum([len(x) for x in by_id])])

    @classmethod
    def from_ranks(cls, path: str) -> BytePairs:
        """A rank file: a line for each token, its bytes in base64 and its rank, which is its id."""
        with open(path, "rb") as f:
            tokens = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        pairs = {}
        for t, rank in tokens.items():
            for i in range(1, len(t)):
                if (a := tokens.get(t[:i])) is not None and (b := tokens.get(t[i:])) is not None:
                    pairs[a, b] = (rank, rank)
        return cls(tokens, pairs, True)

    @classmethod
    def from_merges(cls, path: str) -> BytePairs:
        """A tokenizer file in JSON of kind byte-level BPE, with its list of merges."""
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        char = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        tokens = {bytes(char[c] for c in k): v for k, v in model["vocab"].items() if all(c in char for c in k)}
        ids, pairs = model["vocab"], {}
        for rank, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            pairs.setdefault((ids[a], ids[b]), (rank, ids[a + b]))
        return cls(tokens, pairs, False)

    def _long(self, word: bytes) -> list[int]:
        ids = [int(self.single[b]) for b in word]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(self.pairs[p][0], i, p) for i in range(len(ids) - 1) if (p := (ids[i], ids[i + 1])) in self.pairs]
        heapq.heapify(heap)
        while heap:
            _, i, (a, b) = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue  # one of the two is part of another merge by now
            ids[i], ids[j] = self.pairs[a, b][1], -1
            after[i] = after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < len(ids) and (p := (ids[x], ids[y])) in self.pairs:
                    heapq.heappush(heap, (self.pairs[p][0], x, p))
        return [x for x in ids if x >= 0]

    def _bucket(self, words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of at most ``width`` bytes: rows of a matrix and their lengths."""
        # a column of padding on either side, so that a merge always has neighbours
        size = np.fromiter(map(len, words), np.int64, len(words))
        cols = np.arange(width + 2)
        rows = np.full((len(words), width + 2), -1, np.int32)
        rows[(cols > 0) & (cols <= size[:, None])] = self.single[np.frombuffer(b"".join(words), np.uint8)]
        out, live = np.full((len(words), width), -1, np.int32), np.arange(len(words))
        rank = np.full_like(rows, _NONE)  # of each column and the next
        rank[:, :-1] = self.table.rank[self.table.find(rows[:, :-1].ravel(), rows[:, 1:].ravel())].reshape(len(words), width + 1)
        while len(live):
            j = rank.argmin(axis=1)  # the leftmost of the lowest
            at = np.arange(len(live))
            more = rank[at, j] != _NONE
            if not more.all():
                out[live[~more]] = rows[~more, 1:-1]
                live, rows, rank, j = live[more], rows[more], rank[more], j[more]
                at = at[: len(live)]
                if not len(live):
                    break
            made = self.table.made[self.table.find(rows[at, j], rows[at, j + 1])]
            shift = np.minimum(cols + (cols > j[:, None]), width + 1)
            rows, rank = np.take_along_axis(rows, shift, axis=1), np.take_along_axis(rank, shift, axis=1)
            rows[at, j] = made
            new = self.table.rank[self.table.find(np.concatenate([rows[at, j - 1], made]), np.concatenate([made, rows[at, j + 1]]))]
            rank[at, j - 1], rank[at, j] = new[: len(live)], new[len(live) :]
        return out, (out >= 0).sum(axis=1)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Concatenated ids of words, and the number of ids of each."""
        ids: list = [None] * len(words)
        size = np.zeros(len(words), np.int64)
        buckets: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if self.whole and (t := self.tokens.get(w)) is not None:
                ids[i] = (t,)
                size[i] = 1
            elif len(w) > _LONG:
                ids[i] = self._long(w)
                size[i] = len(ids[i])
            elif w:
                buckets.setdefault(max(4, 1 << (len(w) - 1).bit_length()) if len(w) > 16 else max(4, -(-len(w) // 4) * 4), []).append(i)
        solved = []
        for width, own in buckets.items():
            for k in range(0, len(own), step := max(1, (1 << 20) // width)):
                part = own[k : k + step]
                rows, n = self._bucket([words[i] for i in part], width)
                size[part] = n
                solved.append((np.array(part), rows[rows >= 0], n))
        at = np.concatenate([[0], np.cumsum(size)])
        flat = np.zeros(at[-1], np.int32)
        for i, x in enumerate(ids):
            if x is not None:
                flat[at[i] : at[i + 1]] = x
        for own, values, n in solved:
            flat[np.repeat(at[own] - (np.cumsum(n) - n), n) + np.arange(len(values))] = values
        return flat, size

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Concatenated bytes of lists of ids, and the number of bytes of each list."""
        flat, size = gather(self.bytes, self.bytes_at, ids)
        total = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(sizes)])]
        return flat.tobytes(), np.diff(total)


class Encoder:
    """Ids of whole texts, by way of their distinct pieces and words."""

    def __init__(self, pairs: BytePairs, pattern: str):
        self.pairs, self.pattern = pairs, regex.compile(pattern)
        self.memo = PieceMemo(self._solve, bits=21)

    def _solve(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        place: dict[str, int] = {}
        rows, counts = [], np.zeros(len(pieces), np.int64)
        for i, p in enumerate(pieces):
            own = self.pattern.findall(p)
            counts[i] = len(own)
            rows += [place.setdefault(w, len(place)) for w in own]
        flat, size = self.pairs.encode_words([w.encode() for w in place])
        values, n = gather(flat, np.concatenate([[0], np.cumsum(size)]), np.array(rows, np.int64))
        edge = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(counts)])]
        return values, np.diff(edge)

    def texts(self, texts: list[str | None]):
        """Runs i..j of texts: concatenated ids, and the number of ids of each text."""
        return self.memo.values(texts)


def encoder(path: str, pattern: str) -> Encoder:
    """One for each worker process; it reads the rank file where it runs."""
    return kept(("bpe", path, pattern), lambda: Encoder(BytePairs.from_ranks(path), pattern))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>) of every row of docs(doc_id, text)."""

    def run(batches):
        e = encoder(path, pattern)
        for b in batches:
            for i, j, ids, n in e.texts(b["text"].to_pylist()):
                yield pa.RecordBatch.from_arrays([b["doc_id"].slice(i, j - i), pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(ids, pa.int32()))], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(lean(run, ("bpe", path, pattern)), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, data binary): the bytes of every row of encoded(doc_id, ids)."""

    def run(batches):
        e = encoder(path, pattern)
        for b in batches:
            lists = b["ids"].fill_null([])
            data, n = e.pairs.decode(lists.flatten().to_numpy(), lists.value_lengths().to_numpy())
            edge = np.concatenate([[0], np.cumsum(n)])
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array([data[s:t] for s, t in zip(edge, edge[1:])], pa.binary())], ["doc_id", "data"])

    return encoded.mapInArrow(lean(run, ("bpe", path, pattern)), "doc_id long, data binary")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each text is encoded, and its ids are decoded, in one pass."""

    def run(batches):
        e = encoder(path, pattern)
        for b in batches:
            for i, j, ids, n in e.texts(b["text"].to_pylist()):
                data, size = e.pairs.decode(ids, n)
                raw, at, to = ids.astype("<u4").tobytes(), np.concatenate([[0], np.cumsum(n)]) * 4, np.concatenate([[0], np.cumsum(size)])
                own = [hashlib.sha256(raw[s:t]).hexdigest() for s, t in zip(at, at[1:])]
                back = [hashlib.sha256(data[s:t]).hexdigest() for s, t in zip(to, to[1:])]
                yield pa.RecordBatch.from_arrays([b["doc_id"].slice(i, j - i), pa.array(n), pa.array(own), pa.array(back)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        e.memo.forget()  # an idle worker keeps the ranks only

    return docs.select("doc_id", "text").mapInArrow(lean(run, ("bpe", path, pattern)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
