"""Periodic runs of words by Lyndon arrays over an ordered alphabet, in linear time.

A run is a stretch of words with smallest period q that no neighbour extends; those of at least
``exponent`` * q words are reported. Each run repeats a Lyndon word of length q under one of two orders of
the words, an order and its reverse, and that word is the longest Lyndon word from its start i, which ends
where the next smaller suffix begins. So the next smaller suffix of every position, under both orders, and
how far the two suffixes agree, give all runs:

* Positions are taken from left to right with a stack of previous smaller suffixes. A comparison with the
  next one of the stack starts from what is known: if the one just popped agrees with both by different
  lengths, the smaller is the answer; if by the same, comparing goes on from there.
* The furthest matched extension is kept. Inside it a comparison is a copy of one made earlier, up to its
  end, from which comparing goes on. So a word is matched anew only beyond all that was matched before.

No suffix array or tree and no hash is used. A batch's words are sorted once and ranked, so that comparing two
is comparing two numbers.

Which stretches can hold a run at all is found first, for all documents of a batch at once: in a run of
period q all words after the first q have occurred within the last q. So for each power of two, positions
whose word occurred within that distance must follow one another long enough; runs lie wholly within such
stretches (with the period before them), which are all that the Lyndon arrays are built for.

Rows: a null text has no words and no runs. Words are separated by space, tab to carriage return. Repeated
rows are treated alike. Extra columns are returned; one whose name is that of a result column raises
ValueError. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lean

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
RESULT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])

#: Bytes of texts worked on at once (or one longer text).
CHUNK = 1 << 20


def next_smaller(w: list[int]) -> tuple[list[int], list[int]]:
    """For each suffix of w the start of the next smaller one (len(w) if there is none), and how many words the two share.

    Of a suffix and a prefix of it the prefix is the smaller.
    """
    n = len(w)
    after, after_lce = [n] * n, [0] * n
    before, before_lce = [-1] * n, [0] * n
    low = reach = shift = 0  # w[low:reach] equals what stands shift before it
    for j in range(1, n):
        i, known = j - 1, 0
        while True:
            k = known
            copied = False
            if low <= i and j < reach:
                a, b = i - shift, j - shift
                seen = after_lce[a] if after[a] == b else before_lce[b] if before[b] == a else -1
                if seen >= 0:
                    if seen < reach - j:
                        k, copied = seen, True
                    elif reach - j > k:
                        k = reach - j
            if not copied:
                x, y = i + k, j + k
                while y < n and w[x] == w[y]:
                    x += 1
                    y += 1
                k = y - j
                if y > reach:
                    low, reach, shift = j, y, j - i
            if j + k < n and w[j + k] > w[i + k]:
                before[j], before_lce[j] = i, k
                break
            # suffix j is smaller than suffix i, and so than those of the stack that share more with i
            after[i], after_lce[i] = j, k
            above = before[i]
            while above >= 0 and before_lce[i] > k:
                i = above
                after[i], after_lce[i] = j, k
                above = before[i]
            if above < 0:
                break
            if before_lce[i] < k:
                before[j], before_lce[j] = above, before_lce[i]
                break
            i, known = above, k
    return after, after_lce


def runs_of(w: list[int], exponent: int = 4, shortest: int = 6) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of w of at least ``shortest`` words and ``exponent`` (2 or more) periods."""
    found = set()
    for order in (w, [-x for x in w]):
        after, lce = next_smaller(order)
        n = len(w)
        for i, j in enumerate(after):
            right = lce[i]
            p = j - i
            # the first of a run's Lyndon words has under p words of the run before it
            if right <= (exponent - 2) * p:
                continue
            if i >= p and after[i - p] == i and lce[i - p] >= p:
                continue
            x, y = i - 1, j - 1
            while x >= 0 and w[x] == w[y]:
                x -= 1
                y -= 1
            start, end = x + 1, j + right
            if end - start >= max(shortest, exponent * p):
                found.add((start, end - start, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(ids: np.ndarray, at: np.ndarray, exponent: int = 4, shortest: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of a batch's words that hold all its runs of that exponent, in order and apart.

    ids: ranks of the words; document d has those from at[d] up to at[d + 1].
    """
    n = len(ids)
    none = np.zeros(0, np.int64)
    if not n:
        return none, none
    order = np.argsort(ids, kind="stable")
    doc_start = np.repeat(at[:-1], np.diff(at))
    gap = np.full(n, n + 1, np.int64)
    same = ids[order[1:]] == ids[order[:-1]]
    back = order[1:][same]
    earlier = order[:-1][same]
    inside = earlier >= doc_start[back]
    gap[back[inside]] = (back - earlier)[inside]
    longest = int(np.diff(at).max())
    edges, reach = [none, none], 1
    while True:
        near = np.zeros(n + 2, np.int8)
        near[1:-1] = gap <= reach
        step = np.diff(near)
        starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        # a first word of a document has no earlier one, so a stretch is of one document
        period = reach // 2 + 1
        enough = ends - starts >= max((exponent - 1) * period, shortest - reach)
        starts, ends = starts[enough], ends[enough]
        edges[0] = np.concatenate([edges[0], np.maximum(starts - reach, doc_start[starts])])
        edges[1] = np.concatenate([edges[1], ends])
        if exponent * (reach + 1) > longest:
            break
        reach *= 2
    if not len(edges[0]):
        return none, none
    order = np.argsort(edges[0], kind="stable")
    starts, ends = edges[0][order], np.maximum.accumulate(edges[1][order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] >= ends[:-1]
    first = np.flatnonzero(new)
    return starts[first], ends[np.concatenate([first[1:] - 1, [len(ends) - 1]])]


def runs_of_texts(texts: pa.Array, exponent: int = 4, shortest: int = 6) -> pa.RecordBatch:
    """RESULT's columns of a batch of texts."""
    words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = words.flatten()
    owner = pc.list_parent_indices(words)
    real = pc.greater(pc.binary_length(flat), 0)
    flat, owner = flat.filter(real), owner.filter(real).to_numpy()
    at = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))]).astype(np.int64)
    ids = pc.rank(flat, tiebreaker="dense").to_numpy().astype(np.int64) if len(flat) else np.zeros(0, np.int64)
    dropped = np.zeros(len(flat) + 1, np.int64)
    runs, run_doc = [], []
    for x, y in zip(*map(np.ndarray.tolist, stretches(ids, at, exponent, shortest)), strict=True):
        doc = int(np.searchsorted(at, x, "right") - 1)
        for start, length, period in runs_of(ids[x:y].tolist(), exponent, shortest):
            runs.append((x + start - int(at[doc]), length, period))
            run_doc.append(doc)
            dropped[x + start + period] += 1
            dropped[x + start + length] -= 1
    kept = np.cumsum(dropped[:-1]) == 0
    left = np.concatenate([[0], np.cumsum(np.bincount(owner[kept], minlength=len(texts)))])
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(left, pa.int32()), flat.filter(pa.array(kept))), " ")
    counts = np.concatenate([[0], np.cumsum(np.bincount(run_doc, minlength=len(texts)))])
    parts = [pa.array([r[k] for r in runs], pa.int64()) for k in range(3)]
    listed = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.StructArray.from_arrays(parts, ["start", "length", "period"]))
    return pa.RecordBatch.from_arrays([pa.array(np.diff(at)), listed, collapsed], ["n_words", "runs", "collapsed"])


def _blocks(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most CHUNK bytes, or of one row."""
    start = total = 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > CHUNK:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def find(docs: DataFrame, exponent: int = 4, shortest: int = 6) -> DataFrame:
    """docs' columns but text, with n_words, runs (by start, then period) and collapsed.

    collapsed: the text's words joined by one space, without those that stand after the first period of any run.
    """
    if exponent < 3:
        raise ValueError("exponent: 3 or more")
    taken = {c.lower() for c in docs.columns} & set(RESULT.names)
    if taken:
        raise ValueError(f"columns that the result names itself: {sorted(taken)}")
    carried = [c for c in docs.columns if c.lower() != "text"]
    schema = T.StructType([*(docs.schema[c] for c in carried), *RESULT])

    def run(batches):
        for batch in batches:
            texts = batch.column(len(carried))
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            for start, end in _blocks(sizes):
                rows = batch.slice(start, end - start)
                found = runs_of_texts(rows.column(len(carried)), exponent, shortest)
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], *found.columns], schema.names)

    return docs.select(*carried, "text").mapInArrow(lean(run), schema)


def best(runs: str):
    """The run of greatest exact length / period of an array column; of equal ones the first. Null if there is none."""
    none = F.lit(None).cast(RUN)
    better = lambda a, b: a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"])
    return F.aggregate(F.col(runs), none, lambda a, b: F.when(better(a, b), b).otherwise(a))
