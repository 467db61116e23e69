"""Line dedup: a line goes if it stood before, or if one within a few edits of it did.

Order is by doc_id (null first), then text hash and line number. A line with a word is dropped if the
same line has an earlier place, or if an earlier different line is near. Two lines are near if their edit
distance (insertions, deletions, replacements of characters) is within one edit for every ``per_edit``
characters of the shorter one, ``tau`` at most; so lines under ``per_edit`` characters are near to none.

The near lines come from a segment-partition join. A line that allows t edits is split into t + 1 segments,
of which an edited line keeps one, moved by t places at most; a line sends its segments as index keys (its
length, the segment's number and content) and, for each length up to tau below its own, the substrings that
can be a segment's copy as probes (the multi-match-aware places). Only keys with an index row and a second
line go on; a batch deals the rows of a key beyond two to 64 salts, so that a frequent passage spreads.
The lines of a key meet with their texts. Each needs one earlier near line only, so no pairs leave a task:
counts of characters in twelve classes, which are part of a line's id, bound the distance from below, and
what is left is verified by a banded bit-parallel edit distance, many pairs side by side, one earlier line
first, then two, four and so on until one is near. In a key of more lines than a block, one block of them
(leaders) meets all blocks first; then the lines that are near to no earlier leader meet each other and all others.

Rows: a null text stays null, an empty one empty. Lines without a word stay and are never copies. Rows
that repeat both doc_id and text lose the same lines. A text whose every worded line goes is ``emptied``.
Extra columns stay; one named like an added column (n_lines, n_exact, n_near, emptied) is a ValueError.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Tables, bitmap_of, free_name, in_bitmap, lean, partitions
from .jaccard import _dealt, _led, _unled
from .text import U, chunks, flat, mix, prefix_hash, prefix_sums, quick_hash, span_hash

_SALTS = 64
_CLASSES = 12
_SPACE = np.zeros(33, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class Lines:
    """The lines of a run of texts: code points, places, content hashes."""

    def __init__(self, buf: np.ndarray, at: np.ndarray):
        lead = (buf & 0xC0) != 0x80
        self.buf, self.byte = buf, np.append(np.flatnonzero(lead), len(buf))  # where each code point begins
        self.codes = np.frombuffer(buf.tobytes().decode().encode("utf-32-le"), np.uint32)
        at = np.concatenate([[0], np.cumsum(lead)])[at]
        cuts = np.flatnonzero(self.codes == 10)
        doc = np.concatenate([np.searchsorted(at, cuts, "right") - 1, np.arange(len(at) - 1)])
        end = np.concatenate([cuts, at[1:]])
        order = np.lexsort((end, doc))
        self.doc, self.end = doc[order], end[order]
        self.start = np.concatenate([[0], self.end[:-1] + 1])
        new = np.ones(len(self.doc), bool)
        new[1:] = self.doc[1:] != self.doc[:-1]
        self.start[new] = at[self.doc[new]]
        self.number = np.arange(len(self.doc)) - np.flatnonzero(new)[np.cumsum(new) - 1]
        plain = np.concatenate([[0], np.cumsum(~((self.codes <= 32) & _SPACE[np.minimum(self.codes, 32)]))])
        self.worded = plain[self.end] > plain[self.start]
        self.size = self.end - self.start
        self.sums = prefix_hash(buf)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return span_hash(*self.sums, self.byte[start], self.byte[end])

    def other_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A second hash, independent of the first."""
        return quick_hash(*prefix_sums(self.buf), self.byte[start], self.byte[end])

    def ids(self, use: np.ndarray) -> np.ndarray:
        """Of each line: character counts modulo 8 of the classes, 27 bits of its hash, a zero bit."""
        size = self.size[use]
        row = np.repeat(np.arange(len(use)) * _CLASSES, size)
        take = np.repeat(self.start[use] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        count = np.bincount(row + self.codes[take] % _CLASSES, minlength=len(use) * _CLASSES).reshape(-1, _CLASSES).astype(U) & U(7)
        sketch = (count << (U(3) * np.arange(_CLASSES, dtype=U))).sum(axis=1, dtype=U)
        return sketch << U(28) | short_hash(self.hash(self.start[use], self.end[use])) << U(1)


def short_hash(h: np.ndarray) -> np.ndarray:
    """The bits of a line's hash that are part of its id."""
    return h >> U(37)


def segments(length: np.ndarray, tau: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Start and size of the tau + 1 segments of a line, the longer ones last."""
    short = length // (tau + 1)
    long = length - short * (tau + 1)
    out, start = [], np.zeros_like(length)
    for i in range(tau + 1):
        size = short + (i >= tau + 1 - long)
        out.append((start, size))
        start = start + size
    return out


def edits(length: np.ndarray, tau: int, per_edit: int) -> np.ndarray:
    """Edits that a pair allows whose shorter line has this length."""
    return np.clip(length // per_edit, 0, tau)


def segment_keys(lines: Lines, use: np.ndarray, tau: int, per_edit: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Keys and ids of the lines; an id's low bit is 1 for a probe, 0 for a segment of the line itself."""
    keys, rows, ids = [], [], lines.ids(use)
    size, start = lines.size[use], lines.start[use]

    def send(which: np.ndarray, length: np.ndarray, i: int, begin: np.ndarray, width: np.ndarray, probe: int) -> None:
        at = start[which] + begin
        keys.append(mix(lines.hash(at, at + width) + length.astype(U) * U(0x9E3779B97F4A7C15) + U(i)))
        rows.append(ids[which] | U(probe))

    for shorter in range(tau + 1):
        allowed = edits(size - shorter, tau, per_edit)
        for t in range(max(1, shorter), tau + 1):
            mine = np.flatnonzero((allowed == t) & (size - shorter > t))
            own_size = size[mine]
            length = own_size - shorter
            for i, (begin, width) in enumerate(segments(length, t)):
                # places where the segment's copy can start if the edits before and after it are few
                low = np.maximum(np.maximum(begin - i, begin + shorter - (t - i)), 0)
                high = np.minimum(np.minimum(begin + i, begin + shorter + (t - i)), own_size - width)
                for step in range(2 * t + 1):
                    place = low + step
                    ok = place <= high
                    if not shorter:
                        ok &= place != begin
                    ok = np.flatnonzero(ok)
                    if len(ok):
                        send(mine[ok], length[ok], i, place[ok], width[ok], 1)
                if not shorter and len(mine):
                    send(mine, length, i, begin, width, 0)
    if not keys:
        return np.zeros(0, U), np.zeros(0, U)
    return np.concatenate(keys), np.concatenate(rows)


def _key_rows(tau: int, per_edit: int) -> Callable:
    def run(batches):
        for b in batches:
            keys, ids, seen = [np.zeros(0, U)], [np.zeros(0, U)], np.zeros(0, U)
            buf, at = flat(b["text"])
            for _, _, own, own_at in chunks(buf, at):
                lines = Lines(own, own_at)
                use = np.flatnonzero(lines.worded & (lines.size >= per_edit))
                h, first = np.unique(lines.hash(lines.start[use], lines.end[use]), return_index=True)
                if len(seen):
                    first = first[seen[np.minimum(np.searchsorted(seen, h), len(seen) - 1)] != h]
                seen = np.union1d(seen, h)
                k, f = segment_keys(lines, use[first], tau, per_edit)
                keys.append(k)
                ids.append(f)
            k, f = np.concatenate(keys), np.concatenate(ids)
            probe = (f & U(1)).astype(bool)
            k, f = (np.concatenate([x[~probe], x[probe]]) for x in (k, f))  # index rows first, so that a key's unsalted rows have one
            order = np.argsort(k, kind="stable")
            k, f = k[order], f[order]
            first = np.ones(len(k), bool)
            first[1:] = k[1:] != k[:-1]
            rank = np.arange(len(k)) - np.flatnonzero(first)[np.cumsum(first) - 1]
            salt = np.where(rank < 2, 0, 1 + (f >> U(1) & U(_SALTS - 1)).astype(np.int64)).astype(np.int32)
            for i in range(0, len(k), 1 << 17):
                own = slice(i, i + (1 << 17))
                yield pa.RecordBatch.from_arrays([pa.array(k[own].view(np.int64)), pa.array(salt[own]), pa.array(f[own].view(np.int64))], ["k", "salt", "f"])

    return run


def _shared_keys(batches):
    """Rows (k, salt, f) sorted by k and salt: (k, f) of keys with an index row and another row.

    Unsalted rows of a key are few: two from each batch.
    """
    held_k, held_f = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def sift(k: np.ndarray, f: np.ndarray):
        first = np.ones(len(k), bool)
        first[1:] = k[1:] != k[:-1]
        begin, run = np.flatnonzero(first), np.cumsum(first) - 1
        some = np.zeros(len(begin), bool)
        some[run[f != f[begin][run]]] = True
        index = np.zeros(len(begin), bool)
        index[run[(f & 1) == 0]] = True
        keep = (some & index)[run]
        return k[keep], f[keep]

    for b in batches:
        k, salt, f = (b[x].to_numpy() for x in ("k", "salt", "f"))
        salted = salt > 0
        own_k, own_f = np.concatenate([held_k, k[~salted]]), np.concatenate([held_f, f[~salted]])
        last = np.searchsorted(own_k, own_k[-1]) if len(own_k) else 0  # sorted: the last key may go on
        held_k, held_f = own_k[last:], own_f[last:]
        if len(held_f) > 64:
            held_k, held_f = held_k[: (n := len(np.unique(held_f)))], np.unique(held_f)[:n]
        out_k, out_f = sift(own_k[:last], own_f[:last])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([out_k, k[salted]])), pa.array(np.concatenate([out_f, f[salted]]))], ["k", "f"])
    out_k, out_f = sift(held_k, held_f)
    yield pa.RecordBatch.from_arrays([pa.array(out_k), pa.array(out_f)], ["k", "f"])


def sketch_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Twice a lower bound of the edit distance of lines with these ids: an edit changes two counts by one at most."""
    out = np.zeros(np.broadcast(a, b).shape, np.int64)
    for i in range(_CLASSES):
        shift = U(28 + 3 * i)
        d = (((a >> shift) & U(7)).astype(np.int64) - ((b >> shift) & U(7)).astype(np.int64)) & 7
        out += np.minimum(d, 8 - d)
    return out


#: Characters from which on what two lines share at both ends is left out before they are compared.
_TRIM = 512


def _middle(a: str, b: str) -> tuple[str, str]:
    """What is left of two strings without their common start and end."""
    x, y = (np.frombuffer(s.encode("utf-32-le"), np.uint32) for s in (a, b))
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[:n] != y[:n])
    head = int(differ[0]) if len(differ) else n
    differ = np.flatnonzero(x[len(x) - n + head :][::-1] != y[len(y) - n + head :][::-1])
    tail = int(differ[0]) if len(differ) else n - head
    return a[head : len(a) - tail], b[head : len(b) - tail]


def edit_within(a: list[str], b: list[str], tau: int) -> np.ndarray:
    """Whether each pair of strings is within tau edits: a banded bit-parallel distance, side by side.

    A column's vertical differences stand in one 64-bit word a pair, whose top bit is the band's last
    row; from column to column the band moves a row down, so the word moves a bit down.
    """
    m, n = np.array(list(map(len, a))), np.array(list(map(len, b)))
    ok = np.abs(m - n) <= tau
    out = np.zeros(len(a), bool)
    if tau and (m > _TRIM).any():
        a, b = map(list, zip(*(_middle(x, y) if len(x) > _TRIM else (x, y) for x, y in zip(a, b, strict=True)), strict=True))
        m, n = np.array(list(map(len, a))), np.array(list(map(len, b)))
    if not ok.all():
        some = np.flatnonzero(ok)
        out[some] = edit_within([a[i] for i in some], [b[i] for i in some], tau) if len(some) else False
        return out
    if not len(a) or tau == 0:
        return np.array([x == y for x, y in zip(a, b, strict=True)], bool)
    # rows of a, padded before by tau and behind to where the band may look
    width = int(max(m.max(), n.max())) + 2 * tau + 1
    rows, cols = np.zeros((len(a), width), np.uint32), np.zeros((len(a), width), np.uint32)
    for at, text, size, pad in ((rows, a, m, tau), (cols, b, n, 0)):
        place = np.arange(width) - pad
        at[(place >= 0) & (place < size[:, None])] = np.frombuffer("".join(text).encode("utf-32-le"), np.uint32) + 1
    cols[cols == 0] = 0xFFFFFFFF
    rows, cols = np.ascontiguousarray(rows.T), np.ascontiguousarray(cols.T)
    vp, vn = np.full(len(a), ((1 << tau + 1) - 1) << (63 - tau), U), np.zeros(len(a), U)
    score, top = np.minimum(m, tau), U(1 << 63)
    for j in range(int(n.max())):
        x = np.zeros(len(a), U)
        for d in range(2 * tau + 1):  # row j + d - tau stands at bit 63 - 2 tau + d
            x |= (rows[j + d] == cols[j]).astype(U) << U(63 - 2 * tau + d)
        d0 = (((x & vp) + vp) ^ vp) | x | vn
        hp, hn = vn | ~(d0 | vp), d0 & vp
        slant = j < m - tau  # the last row isn't reached yet: the score goes down the band's edge
        bit = U(1) << np.clip(63 - 2 * tau + (m - 1 - j + tau), 0, 63).astype(U)
        flat_step = (hp & bit > 0).astype(np.int64) - (hn & bit > 0)
        score += np.where(j < n, np.where(slant, d0 & top == 0, flat_step), 0)
        vp, vn = hn | ~((d0 >> U(1)) | hp), (d0 >> U(1)) & hp
    return score <= tau


def _near(a: list[str], b: list[str], tau: int, per_edit: int) -> np.ndarray:
    """Whether each pair of lines is near."""
    ok = np.zeros(len(a), bool)
    allowed = edits(np.array([min(len(x), len(y)) for x, y in zip(a, b, strict=True)], np.int64), tau, per_edit).tolist()
    order = sorted(range(len(a)), key=lambda i: (allowed[i], len(a[i])))
    i = 0
    while i < len(order):
        j = i + 1
        while j < len(order) and allowed[order[j]] == allowed[order[i]] and (j - i + 1) * len(a[order[j]]) <= 1 << 20:
            j += 1
        part = order[i:j]
        ok[part] = edit_within([a[k] for k in part], [b[k] for k in part], allowed[part[0]])
        i = j
    return ok


#: Pairs that a task looks at side by side.
_PAIRS = 1 << 18


def _ranks(rows: pa.Table) -> np.ndarray:
    """Of each row the rank of its line's first place, equal for rows of the same line."""
    doc_id = rows["doc_id"]
    place = [doc_id.is_valid().to_numpy(), doc_id.fill_null(0).to_numpy(), rows["row"].to_numpy(), rows["line"].to_numpy()]
    order = np.lexsort(place[::-1])
    new = np.zeros(len(order), bool)
    for x in place:
        new[1:] |= x[order][1:] != x[order][:-1]
    out = np.zeros(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _partners(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """For each row of whole units the range of rows that it meets: the other side's, or the later ones of the only side."""
    unit, side = [rows[x].to_numpy() for x in ("unit", "i", "j")], rows["side"].to_numpy()
    new = np.ones(len(side), bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in unit])
    begin, run = np.flatnonzero(new), np.cumsum(new) - 1
    end, right = np.append(begin[1:], len(side)), np.bincount(run, side > side[begin][run], len(begin)).astype(np.int64)
    here, mid = np.arange(len(side)), (end - right)[run]
    low = np.where(right[run] > 0, mid, here + 1)
    return low, np.where((right[run] > 0) & (here >= mid), low, end[run])


def _witnessed(tau: int, per_edit: int) -> Callable:
    """Rows sorted by (unit, i, j, side): (h1, h2) of the open lines to which an earlier line of their unit is near."""

    def solve(rows: pa.Table) -> np.ndarray:
        f, size, text = rows["f"].to_numpy().view(U), rows["size"].to_numpy(), rows["text"].to_pylist()
        rank, low_high = _ranks(rows), _partners(rows)
        wanted = np.zeros(len(f) + 1, bool)
        wanted[rank[rows["open"].to_numpy()]] = True
        found = np.zeros(len(f), bool)
        many = np.cumsum(low_high[1] - low_high[0])

        def resolve(late: np.ndarray, early: np.ndarray) -> None:
            code = rank[late] * len(f) + rank[early]
            _, once = np.unique(code, return_index=True)  # by the later line, its earliest partner first
            late, early = late[once], early[once]
            tried = 1
            while True:
                more = ~found[rank[late]]
                late, early = late[more], early[more]
                if not len(late):
                    return
                first = np.ones(len(late), bool)
                first[1:] = rank[late[1:]] != rank[late[:-1]]
                nth = np.arange(len(late)) - np.flatnonzero(first)[np.cumsum(first) - 1]
                now = np.flatnonzero(nth < tried)
                ok = _near([text[i] for i in early[now]], [text[i] for i in late[now]], tau, per_edit)
                found[rank[late[now[ok]]]] = True
                late, early = late[nth >= tried], early[nth >= tried]
                tried *= 2

        waiting, n_waiting, at = [], 0, 0
        while at < len(f):
            to = max(at + 1, int(np.searchsorted(many, (many[at - 1] if at else 0) + _PAIRS, "right")))
            low, n = low_high[0][at:to], (low_high[1] - low_high[0])[at:to]
            x = np.repeat(np.arange(at, to), n)
            y = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)
            late, early = np.where(rank[x] > rank[y], x, y), np.where(rank[x] > rank[y], y, x)
            allowed = edits(np.minimum(size[x], size[y]), tau, per_edit)
            ok = (rank[x] != rank[y]) & wanted[rank[late]] & ~found[rank[late]] & (f[x] & f[y] & U(1) == 0) & (np.abs(size[x] - size[y]) <= allowed)
            late, early, allowed = late[ok], early[ok], allowed[ok]
            ok = sketch_distance(f[late], f[early]) <= 2 * allowed
            waiting.append((late[ok], early[ok]))
            n_waiting, at = n_waiting + len(waiting[-1][0]), to
            if n_waiting >= _PAIRS or at == len(f):
                resolve(*map(np.concatenate, zip(*waiting, strict=True)))
                waiting, n_waiting = [], 0
        _, once = np.unique(rank, return_index=True)
        return once[found[: len(once)]]

    def run(batches):
        held = None
        for b in batches:
            rows = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            if not len(rows):
                continue
            last = [rows[x].to_numpy() for x in ("unit", "i", "j")]
            cut = len(rows) - int(np.argmin(np.append(np.logical_and.reduce([x[::-1] == x[-1] for x in last]), False)))  # the last unit may go on
            held = rows.slice(cut)
            if cut:
                yield from hashes(rows.slice(0, cut))
        if held is not None:
            yield from hashes(held)

    def hashes(rows: pa.Table):
        late = pa.array(solve(rows))
        yield from rows.select(["h1", "h2"]).take(late).combine_chunks().to_batches()

    return run


_PLACES = "h1 long, h2 long, doc_id long, row long, line int, id long, text string"


def _places(bitmap: np.ndarray, per_edit: int) -> Callable:
    """Rows _PLACES of all worded lines; those that the bitmap holds by short_hash() have id and text."""

    def run(batches):
        for b in batches:
            buf, at = flat(b["text"])
            doc_id, row = b["doc_id"], b["row"].to_numpy()
            for i, _, own, own_at in chunks(buf, at):
                lines = Lines(own, own_at)
                use = np.flatnonzero(lines.worded)
                h1, h2 = (h(lines.start[use], lines.end[use]) for h in (lines.hash, lines.other_hash))
                near = np.flatnonzero((lines.size[use] >= per_edit) & in_bitmap(bitmap, short_hash(h1).view(np.int64)))
                ids, text = np.zeros(len(use), np.int64), np.full(len(use), None, object)
                ids[near] = lines.ids(use[near]).view(np.int64)
                text[near] = [lines.codes[s:e].tobytes().decode("utf-32-le") for s, e in zip(lines.start[use[near]], lines.end[use[near]], strict=True)]
                rest = np.ones(len(use), bool)
                rest[near] = False
                doc = lines.doc[use] + i
                cols = [pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), doc_id.take(pa.array(doc)), pa.array(row[doc]), pa.array(lines.number[use].astype(np.int32)), pa.array(ids, mask=rest), pa.array(text, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, ["h1", "h2", "doc_id", "row", "line", "id", "text"])

    return run


def shared_keys(tables: Tables, docs: DataFrame, tau: int, per_edit: int) -> DataFrame:
    """(k, f): keys that lines within tau edits share, and the ids of their lines; the low bit is 1 for a probe."""
    parts = partitions(docs.sparkSession)
    keys = docs.select("text").mapInArrow(lean(_key_rows(tau, per_edit)), "k long, salt int, f long")
    return tables.put(keys.repartition(parts, "k", "salt").sortWithinPartitions("k", "salt").mapInArrow(_shared_keys, "k long, f long").distinct(), "shared")


#: Characters that count as one more line of a key, where its lines are longer on average.
_LONG = 4096


def _weight(some: Column) -> Column:
    """Lines of a key, or more if they are long, so that a block of them stays small."""
    return F.greatest(F.count(F.when(some, 1)), F.ceil(F.sum(F.when(some, F.col("size")).otherwise(0)) / _LONG))


def near_dropped(tables: Tables, places: DataFrame, shared: DataFrame, tau: int, per_edit: int, block: int) -> DataFrame:
    """(h1, h2) of the lines with an earlier line that is near.

    A key of M lines of which m are near to no earlier leader takes M + m * (M + m) / block rows.
    """
    parts = partitions(places.sparkSession)
    held = places.where("id is not null").groupBy("id", "h1", "h2", "text").agg(F.min(F.struct("doc_id", "row", "line")).alias("at"))
    held = held.select("id", "h1", "h2", "at.*", F.length("text").cast("long").alias("size"), "text")
    members = shared.join(held, F.col("f").bitwiseAND(F.lit(-2)) == F.col("id")).drop("id").withColumn("open", F.lit(True))
    members = tables.put(members, "members")
    tables.drop(shared)

    def meet(units: DataFrame) -> DataFrame:
        return _dealt(units.drop("k"), parts).mapInArrow(lean(_witnessed(tau, per_edit)), "h1 long, h2 long").distinct()

    sizes = members.groupBy("k").agg(F.count("*").alias("n"), _weight(F.lit(True)).alias("members")).where("n > 1").drop("n")
    first = tables.put(meet(_led(members, sizes, "k", "h1", block)), "near")
    large = tables.put(sizes.where(F.col("members") > block), "large")
    if large.isEmpty():
        tables.drop(members, large)
        return first
    known = members.join(large.select(F.col("k").alias("large")), F.col("k") == F.col("large")).join(first.withColumn("component", F.lit(1)), ["h1", "h2"], "left")
    known = known.drop("large").withColumn("component", F.coalesce("component", F.lit(0))).withColumn("open", F.col("component") == 0)
    known = tables.put(known, "known")
    tops = known.groupBy("k").agg(F.lit(1).alias("top"), _weight(F.col("open")).alias("n_rest"), _weight(~F.col("open")).alias("n_top")).where("n_rest > 0")
    second = tables.put(meet(_unled(known, tops, "k", "h1", block)), "near")
    tables.drop(members, large, known)
    return first.union(second).distinct()


def _without(columns: list[T.StructField], gone: str, near: str) -> Callable:
    def run(batches):
        for b in batches:
            out, counts = [], []
            for text, drop, n in zip(b["text"], b[gone].to_pylist(), b[near].to_pylist(), strict=True):
                kept = text = text.as_py()
                n_lines = 0 if text is None else text.count("\n") + 1
                if drop:
                    numbers = set(drop)
                    kept = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in numbers)
                out.append(kept)
                counts.append((n_lines, len(drop or ()) - (n or 0), n or 0, bool(drop) and not kept.strip(" \t\n\x0b\x0c\r")))
            cols = [pa.array(out, pa.string()) if f.name == "text" else b[f.name] for f in columns]
            extra = [pa.array([c[i] for c in counts], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*cols, *extra], [*(f.name for f in columns), *_ADDED])

    return run


_ADDED = ("n_lines", "n_exact", "n_near", "emptied")


def dedup(docs: DataFrame, tau: int = 2, per_edit: int = 20, block: int = 1024) -> DataFrame:
    """docs with the remaining text of every row, and n_lines, n_exact, n_near (lines dropped) and emptied.

    The lines to drop meet the texts in a shuffled hash join, whose hash table has the lines' numbers of one
    partition: texts are shuffled once and not sorted.
    """
    if clash := {c.lower() for c in docs.columns} & set(_ADDED):
        raise ValueError(f"docs has columns {sorted(clash)} already")
    tables = Tables(docs.sparkSession, "lines")
    fields = docs.schema.fields
    row, gone_row, gone_id, gone, near_count = (free_name(docs, x) for x in ("row_hash", "gone_row", "gone_id", "gone_lines", "gone_near"))
    rows = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    keyed = rows.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col(row).alias("row"), "text")
    shared = shared_keys(tables, keyed, tau, per_edit)
    bitmap = bitmap_of(shared.select(F.shiftright("f", 1).bitwiseAND(F.lit((1 << 27) - 1)).alias("id")).distinct())
    places = tables.put(keyed.mapInArrow(lean(_places(bitmap, per_edit)), _PLACES), "places")
    near = near_dropped(tables, places, shared, tau, per_edit, block).withColumn("near", F.lit(True))
    at = F.struct("doc_id", "row", "line")
    first = places.groupBy("h1", "h2").agg(F.min(at).alias("at"), F.count("*").alias("n")).where("n > 1")
    marks = tables.put(first.join(near, ["h1", "h2"], "full").select("h1", "h2", "at", F.coalesce("near", F.lit(False)).alias("near")), "marks")
    found = (
        places.join(marks, ["h1", "h2"]).where(F.col("near") | (at != F.col("at")))
        .groupBy("doc_id", "row").agg(F.collect_set("line").alias(gone), F.countDistinct(F.when(F.coalesce(at == F.col("at"), F.lit(True)), F.col("line"))).alias(near_count))
    )
    found = tables.put(found.select(F.col("doc_id").alias(gone_id), F.col("row").alias(gone_row), gone, near_count), "gone")
    tables.drop(places, marks)
    joined = rows.join(found.hint("shuffle_hash"), (F.col(row) == F.col(gone_row)) & F.col("doc_id").cast("long").eqNullSafe(F.col(gone_id)), "left")
    kinds = T.StructType([*fields, *(T.StructField(x, T.LongType()) for x in _ADDED[:3]), T.StructField("emptied", T.BooleanType())])
    return joined.select(*docs.columns, gone, near_count).mapInArrow(lean(_without(fields, gone, near_count)), kinds)
