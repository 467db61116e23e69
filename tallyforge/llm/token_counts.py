"""Exact token counts of every prefix, by dynamic programming over the prefixes of words.

Of each prefix of a word exactly one token can be the last of its byte-pair encoding: the one that
ends there, and that stays apart from the last token of the prefix before it. So the table of last tokens
fills from short to long prefixes, and with it the number of tokens: count[i] = count[i - |token|] + 1.
Whether two tokens stay apart is a fact about the pair, found once by encoding both together. With the
counts of all prefixes, truncation to a budget is a look-up; no text is encoded again.

Rows: a null text counts as empty, with 0 tokens. Nothing depends on doc_id; null and repeated ones are
kept as they are. Extra columns aren't returned.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .bpe import BytePairs
from .common import kept, lean
from .pieces import PieceMemo, pieces
from .text import HashIndex, U, prefix_sums, quick_hash

#: Words over so many bytes aren't put in a matrix.
_WIDE = 32
#: Ends of prefixes of long words in one block, and bytes of long words that are joined.
_ENDS, _RUN = 4096, 1 << 16
_CONTRACTIONS = ("'re", "'ve", "'ll")


class PrefixCounter:
    def __init__(self, pairs: BytePairs, pattern: str, special: list[str]):
        self.pairs, self.pattern = pairs, regex.compile(pattern)
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        names = list(pairs.tokens)
        size = np.array(list(map(len, names)))
        ends = np.cumsum(size)
        h = quick_hash(*prefix_sums(np.frombuffer(b"".join(names), np.uint8)), ends - size, ends)
        self.index = HashIndex(3 + len(names).bit_length())
        self.index.put((h >> U(1)).view(np.int64), np.array(list(pairs.tokens.values()), np.int32))
        self.longest = int(size.max())
        self.by_id = {v: k for k, v in pairs.tokens.items()}
        self.known = HashIndex(22)

    def _apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each pair of tokens is the encoding of its joint bytes."""
        key = left << 32 | right
        found = self.known.find(key)
        if len(miss := np.flatnonzero(found < 0)):
            new = np.unique(key[miss])
            ids, size = self.pairs.encode_words([self.by_id[k >> 32] + self.by_id[k & 0xFFFFFFFF] for k in new.tolist()])
            first = np.cumsum(size) - size
            ok = size == 2
            ok[ok] = (ids[first[ok]] == new[ok] >> 32) & (ids[first[ok] + 1] == (new[ok] & 0xFFFFFFFF))
            if 2 * (self.known.n + len(new)) > 1 << self.known.bits:  # what a worker remembers is bounded
                self.known.clear()
            self.known.put(new, ok.astype(np.int32))
            found[miss] = ok[np.searchsorted(new, key[miss])]
        return found > 0

    def _matrix(self, words: list[bytes]) -> np.ndarray:
        """count[i, j]: tokens of the first j bytes of word i."""
        size = np.array(list(map(len, words)))
        start = np.cumsum(size) - size
        total, down = prefix_sums(np.frombuffer(b"".join(words), np.uint8))
        width = int(size.max())
        count, last = np.zeros((len(words), width + 1), np.int32), np.zeros((len(words), width + 1), np.int64)
        for i in range(1, width + 1):
            todo = np.flatnonzero(size >= i)
            for n in range(min(i, self.longest), 0, -1):
                h = quick_hash(total, down, start[todo] + (i - n), start[todo] + i)
                token = self.index.find((h >> U(1)).view(np.int64)).astype(np.int64)
                hit = np.flatnonzero(token >= 0)
                if not len(hit):
                    continue
                row, token = todo[hit], token[hit]
                if n < i:
                    ok = self._apart(last[row, i - n], token)
                    hit, row, token = hit[ok], row[ok], token[ok]
                last[row, i], count[row, i] = token, count[row, i - n] + 1
                left = np.ones(len(todo), bool)
                left[hit] = False
                todo = todo[left]
                if not len(todo):
                    break
        return count

    def _ending(self, total: np.ndarray, down: np.ndarray, low: int, base: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """End, length and id of every token that ends at low, low + 1, ... in a word that begins at base; by end, the longest first."""
        found, ends = [], np.arange(low, low + len(base))
        for n in range(min(self.longest, int((ends - base).max())), 0, -1):
            end = ends[ends - base >= n]
            token = self.index.find((quick_hash(total, down, end - n, end) >> U(1)).view(np.int64))
            hit = token >= 0
            found.append((end[hit], np.full(int(hit.sum()), n), token[hit].astype(np.int64)))
        end, size, token = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(end, kind="stable")
        return end[order], size[order], token[order]

    def _joint(self, words: list[bytes]) -> list[np.ndarray]:
        """Tokens of the first 0, 1, ... bytes of each of some long words, joined, a block of ends at a time.

        The last token of a prefix is one of the few that end there, so whether they stay apart is asked for all
        pairs of a block at once; only the choice goes from end to end. Every byte is a token.
        """
        sizes = list(map(len, words))
        begin = np.cumsum([0, *sizes])
        base = np.repeat([0, *begin[:-1]], [1, *sizes])  # by end, where its word begins; no word ends at 0
        total, down = prefix_sums(np.frombuffer(b"".join(words), np.uint8))
        count, used = [0] * len(base), [0] * len(base)
        for a in range(1, len(base), _ENDS):
            low, stop = max(1, a - self.longest), min(a + _ENDS, len(base))
            end, size, token = self._ending(total, down, low, base[low:stop])
            edge = np.searchsorted(end, np.arange(low, stop + 1))
            before = end - size
            inner = before > base[end]
            at = np.where(inner, np.maximum(before - low, 0), 0)
            many = np.where((end >= a) & inner, edge[at + 1] - edge[at], 0)
            right = np.repeat(np.arange(len(end)), many)
            place = np.cumsum(many) - many
            left = np.arange(len(right)) - place[right] + edge[at[right]]
            ok = self._apart(token[left], token[right]).tolist()
            edge, size, place, inner = edge.tolist(), size.tolist(), place.tolist(), inner.tolist()
            nth = [size.index(used[i], edge[i - low]) - edge[i - low] for i in range(low, a)]  # of the tokens at an end, the chosen one
            for i in range(a, stop):
                first = edge[i - low]
                for c in range(first, edge[i - low + 1]):
                    j = i - size[c]
                    if not inner[c] or ok[place[c] + nth[j - low]]:
                        nth.append(c - first)
                        used[i], count[i] = size[c], (count[j] if inner[c] else 0) + 1
                        break
        return [np.array([0, *count[b + 1 : b + n + 1]], np.int32) for b, n in zip(begin.tolist(), sizes)]

    def _long(self, words: list[bytes]) -> list[np.ndarray]:
        """_joint() of runs of words of at most _RUN bytes together, or of one longer word."""
        out: list[np.ndarray] = []
        run: list[bytes] = []
        n = 0
        for w in words:
            if run and n + len(w) > _RUN:
                out += self._joint(run)
                run, n = [], 0
            run.append(w)
            n += len(w)
        return out + self._joint(run) if run else out

    def word_prefixes(self, words: list[bytes]) -> list[np.ndarray]:
        """Token counts of the first 0, 1, ... bytes of each word."""
        out: list = [None] * len(words)
        short = [i for i, w in enumerate(words) if len(w) <= _WIDE]
        for width in range(0, _WIDE, 4):
            own = [i for i in short if width < len(words[i]) <= width + 4 or (not width and not words[i])]
            if own and (some := [i for i in own if words[i]]):
                for i, row in zip(some, self._matrix([words[i] for i in some]), strict=True):
                    out[i] = row[: len(words[i]) + 1]
        long = [i for i, w in enumerate(words) if len(w) > _WIDE]
        for i, x in zip(long, self._long([words[i] for i in long]), strict=True):
            out[i] = x
        return [np.zeros(1, np.int32) if x is None else x for x in out]

    def totals(self, words: list[bytes]) -> np.ndarray:
        """Tokens of each word: the last entries of its prefix table."""
        out = np.zeros(len(words), np.int64)
        size = np.array(list(map(len, words)), np.int64)
        for width in range(0, _WIDE, 4):
            own = np.flatnonzero((size > width) & (size <= width + 4))
            for k in range(0, len(own), 50_000):
                part = own[k : k + 50_000]
                out[part] = self._matrix([words[i] for i in part])[np.arange(len(part)), size[part]]
        long = np.flatnonzero(size > _WIDE)
        for i, x in zip(long, self._long([words[i] for i in long]), strict=True):
            out[i] = x[-1]
        return out

    def _ordinary(self, text: str) -> np.ndarray:
        """Token counts of the first 0, 1, ... characters of a text in which nothing is special."""
        out, base = [0], 0
        spans = [m.span() for m in self.pattern.finditer(text)]
        tables = self.word_prefixes([text[s:t].encode() for s, t in spans])

        def by_char(part: str, table: np.ndarray) -> list[int]:
            return table[np.cumsum([len(c.encode()) for c in part])].tolist()

        run = 0  # characters of white space before this word that a prefix ending there would take as one word
        for (s, t), table in zip(spans, tables, strict=True):
            part = text[s:t]
            counts = by_char(part, table)
            if run and (part[0] == " " or part.isspace()):
                # a prefix that ends after the white space has all of it as one word
                whole = text[s - run : s] + part[0]
                counts[0] = int(self.word_prefixes([whole.encode()])[0][-1]) - run_count
            if part in _CONTRACTIONS:
                counts[1] = counts[0] + int(self.word_prefixes([part[1].encode()])[0][-1])
            out += [base + c for c in counts]
            base += int(table[-1])
            run, run_count = (len(part), int(table[-1])) if part.isspace() else (0, 0)
        return np.array(out, np.int64)

    def prefixes(self, text: str) -> np.ndarray:
        """Token counts of the first 0, 1, ... characters of a text."""
        out, base, at = [np.zeros(1, np.int64)], 0, 0
        for m in self.special.finditer(text) if self.special else ():
            part = self._ordinary(text[at : m.end() - 1])
            out += [base + part[1:]]
            base += int(self._ordinary(text[at : m.start()])[-1]) + 1
            out += [np.array([base])]
            at = m.end()
        out.append(base + self._ordinary(text[at:])[1:])
        return np.concatenate(out)

    def solve(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each piece."""
        place: dict[bytes, int] = {}
        rows, counts, extra = [], np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        for i, p in enumerate(pieces):
            parts = [p]
            if self.special and self.special.search(p):
                parts = self.special.split(p)
                extra[i] = len(parts) - 1
            own = [w.encode() for x in parts for w in self.pattern.findall(x)]
            counts[i] = len(own)
            rows += [place.setdefault(w, len(place)) for w in own]
        each = self.totals(list(place))[np.array(rows, np.int64)] if rows else np.zeros(0, np.int64)
        edge = np.concatenate([[0], np.cumsum(counts)])
        sums = np.concatenate([[0], np.cumsum(each)])
        return (sums[edge[1:]] - sums[edge[:-1]] + extra).astype(np.int32), np.ones(len(pieces), np.int64)


def counter(path: str, pattern: str) -> tuple[PrefixCounter, PieceMemo]:
    """One for each worker process."""
    return kept(("counts", path, pattern), lambda: _load(path, pattern))


def _load(path: str, pattern: str) -> tuple[PrefixCounter, PieceMemo]:
    with open(path, encoding="utf-8") as f:
        special = [t["content"] for t in json.load(f)["added_tokens"]]
    own = PrefixCounter(BytePairs.from_merges(path), pattern, special)
    return own, PieceMemo(own.solve)


def count(docs: DataFrame, path: str, pattern: str, limit: int) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fits_chars) of every row of docs(doc_id, text).

    fits_chars is the number of characters of the longest prefix of at most ``limit`` tokens.
    """

    def run(batches):
        table, memo = counter(path, pattern)
        for b in batches:
            texts = b["text"].to_pylist()
            for i, j, rows, n in memo.texts(texts):
                each = memo.flat[rows].astype(np.int64)  # one value a piece
                sums = np.concatenate([[0], np.cumsum(each)])
                edge = np.concatenate([[0], np.cumsum(n)])
                total = sums[edge[1:]] - sums[edge[:-1]]
                chars = np.array([len(t or "") for t in texts[i:j]], np.int64)
                for k in np.flatnonzero(total > limit):
                    # pieces before the one in which the budget ends, and that piece's own prefixes
                    p = int(np.searchsorted(sums[edge[k] : edge[k + 1] + 1] - sums[edge[k]], limit, "right")) - 1
                    own = pieces(texts[i + k])
                    before = sum(map(len, own[:p])) + max(0, p - 1) + (p > 0)
                    before -= p > 0  # the space goes with the piece
                    piece = (" " if p else "") + own[p]
                    counts = table.prefixes(piece)
                    chars[k] = before + int(np.flatnonzero(counts <= limit - (sums[edge[k] + p] - sums[edge[k]]))[-1])
                size = np.array([len((t or "").encode()) for t in texts[i:j]], np.int64)
                yield pa.RecordBatch.from_arrays([b["doc_id"].slice(i, j - i), pa.array(size), pa.array(total), pa.array(total > limit), pa.array(chars)], ["doc_id", "n_bytes", "n_tokens", "over_limit", "fits_chars"])

    return docs.select("doc_id", "text").mapInArrow(lean(run, ("counts", path, pattern)), "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fits_chars long")
