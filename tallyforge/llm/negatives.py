"""Hard negatives by branch and bound over ball trees, one tree a partition of the vectors.

For each anchor its first positives are the rows of its label with the largest inner products; for each
positive the first negatives are rows of another label whose score lies in a window under the positive's.

1. Vectors are dealt by (label, nearest pivot, hash), so that a tree holds one label and, mostly, vectors that
   are close to each other. Pivots are PIVOTS rows (the smallest hashes); they decide on the layout alone. A
   partition is cut into trees of at most TREE_ROWS vectors, each a row of a written table.
2. A tree's node is a ball: a centre and a radius. For an anchor a the inner products of a node lie between
   a·centre - |a| radius and a·centre + |a| radius.
3. Anchors meet trees in blocks of BLOCK anchors and GROUP trees, each pair of blocks a group of one shuffle. In
   such a task nodes are visited from the most promising on, with those anchors that still need them: a node
   is pruned for an anchor if all its scores are outside the anchor's windows or strictly beneath the current
   last one of the wanted (an equal score may win by its vec_id). Leaves are scored exactly.
4. Each task's first ones are ranked again over all tasks.

Anchors of the first search meet trees of their label only, those of the second all trees, of which those
of their label are passed by. The stated anchors are compared with all rows in blocks; nothing is capped.

Rows: those with a null vec_id, label or vector or with a null or non-finite component take no part, nor do
vectors whose squared norm passes 2**62, as their scores would not fit a long. Components are multiplied
by ``scale`` and rounded down. A shorter vector counts as if zeros followed. Rows with the same vec_id are
rows of their own, but none is another's positive or negative. Extra columns are ignored. Empty tables, and
anchors without positives or negatives, give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Tables

#: Rows that the layout is fitted on; vectors of a tree and of a leaf; anchors and trees of a block.
PIVOTS, TREE_ROWS, LEAF_ROWS, BLOCK, GROUP = 64, 2048, 64, 2048, 16
#: Components of a tree's vectors; long vectors make smaller trees.
TREE_CELLS = 1 << 18
#: Anchors that walk through a tree together.
_TOGETHER = 256

_TREE = "label long, dim int, ids binary, kind string, vectors binary, centres binary, radii binary, spans binary"
_TREE_COLUMNS = ("tree", *(c.split()[0] for c in _TREE.split(", ")))
_ANCHOR = ("anchor_row", "anchor_id", "label", "vector", "lows", "highs")
_FOUND = pa.schema([("anchor_row", pa.int64()), ("window", pa.int32()), ("score", pa.int64()), ("vec_id", pa.int64())])


def points(rows: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part, with whole numbers as components."""
    x = F.col("embedding")
    real = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * scale))
    norm = F.aggregate("vector", F.lit(0.0), lambda s, v: s + v.cast("double") * v)
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull()).where(real)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), whole.alias("vector"))
    return rows.where(norm < 2.0**62)


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def _matrix(lists: pa.Array, dim: int | None = None) -> np.ndarray:
    """Rows of whole numbers from lists, zeros after short ones."""
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), max(int(sizes.max(initial=0)), dim or 0)), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def _nearest(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    dim = max(vectors.shape[1], pivots.shape[1])
    wide = lambda m: np.pad(m.astype(np.float64), ((0, 0), (0, dim - m.shape[1])))
    v, p = wide(vectors), wide(pivots)
    return np.argmin((p * p).sum(1) - 2 * v @ p.T, axis=1) if len(p) else np.zeros(len(v), np.int64)


def build(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A ball tree: the order of its rows, and its nodes' centres, radii and (first row, end row, left child, right child).

    A node of over LEAF_ROWS rows is cut at the median of the coordinate along its widest direction, from the
    row furthest from its centre to the row furthest from that. Child -1: a leaf.
    """
    v = vectors.astype(np.float64)
    order = np.arange(len(v))
    centres, radii, spans = [], [], []
    todo = [(0, len(v), -1, 0)]
    while todo:
        start, end, parent, side = todo.pop()
        own = v[order[start:end]]
        centre = own.mean(axis=0)
        far = np.sqrt(((own - centre) ** 2).sum(axis=1))
        if parent >= 0:
            spans[parent][2 + side] = len(spans)
        centres.append(centre)
        radii.append(far.max() * (1 + 1e-9) + 1e-9)
        spans.append([start, end, -1, -1])
        if end - start > LEAF_ROWS and far.max() > 0:
            one = own[far.argmax()]
            other = own[((own - one) ** 2).sum(axis=1).argmax()]
            along = np.argsort(own @ (other - one), kind="stable")
            order[start:end] = order[start:end][along]
            half = (start + end) // 2
            todo += [(half, end, len(spans) - 1, 1), (start, half, len(spans) - 1, 0)]
    return order, np.array(centres), np.array(radii), np.array(spans, np.int64)


def trees(rows: DataFrame) -> DataFrame:
    """_TREE's columns and tree, a number: one row for each tree over points(); to be written before it is used."""
    best = F.xxhash64("vec_id", "vector")
    chosen = rows.select("vector", best.alias("h"), "vec_id").orderBy("h", "vec_id").limit(PIVOTS).toArrow()["vector"]
    pivots = _matrix(_one(chosen))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = _nearest(_matrix(b.column(2)), pivots)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near, pa.int32())], ["vec_id", "label", "vector", "cell"])

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, label = [], None
        for b in batches:
            # rows come by label; a tree ends with its label or when it is full
            labels = b.column(1).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(labels)) + 1, [len(labels)]])
            for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if y == x:
                    continue
                if labels[x] != label:
                    yield from _grown(held, label)
                    held, label = [], int(labels[x])
                while x < y:
                    most = max(LEAF_ROWS, min(TREE_ROWS, TREE_CELLS // max(1, len(b.column(2)[x]))))
                    held.append(b.slice(x, min(max(1, most - sum(map(len, held))), y - x)))
                    x += len(held[-1])
                    if sum(map(len, held)) >= most:
                        yield from _grown(held, label)
                        held = []
        yield from _grown(held, label)

    dealt = rows.select("vec_id", "label", "vector").mapInArrow(cells, "vec_id long, label long, vector array<long>, cell int")
    n = max(1, -(-rows.count() // (4 * TREE_ROWS)))
    dealt = dealt.withColumn("h", best).repartitionByRange(n, "label", "cell", "h").sortWithinPartitions("label", "cell", "h")
    made = dealt.select("vec_id", "label", "vector").mapInArrow(grown, _TREE)
    return made.withColumn("tree", F.monotonically_increasing_id())


def _grown(held: list[pa.RecordBatch], label: int | None) -> Iterator[pa.RecordBatch]:
    if not held:
        return
    rows = pa.Table.from_batches(held)
    v = _matrix(_one(rows["vector"]))
    order, centres, radii, spans = build(v)
    most = int(np.abs(v).max(initial=0))
    kind = next(k for k in ("int16", "int32", "int64") if most <= np.iinfo(k).max)
    cells = [label, v.shape[1], rows["vec_id"].to_numpy()[order].tobytes(), kind, v[order].astype(kind).tobytes(), centres.tobytes(), radii.tobytes(), spans.tobytes()]
    names = ["label", "dim", "ids", "kind", "vectors", "centres", "radii", "spans"]
    types = [pa.int64(), pa.int32(), pa.binary(), pa.string(), *[pa.binary()] * 4]
    yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, types, strict=True)], names)


class Tree:
    """A row of trees()."""

    def __init__(self, row: dict, dim: int):
        n, own = len(row["ids"]) // 8, row["dim"]
        wide = lambda m: np.pad(m.reshape(-1, own).astype(m.dtype), ((0, 0), (0, dim - own)))
        self.label = row["label"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.vectors = wide(np.frombuffer(row["vectors"], row["kind"])) if own else np.zeros((n, dim), np.int64)
        self.radii = np.frombuffer(row["radii"])
        self.centres = wide(np.frombuffer(row["centres"])) if own else np.zeros((len(self.radii), dim))
        self.spans = np.frombuffer(row["spans"], np.int64).reshape(-1, 4)


class Search:
    """The first ``k`` rows for each window of each anchor, over any number of trees.

    vectors: the anchors'; low, high: (anchors, windows), the scores that count (both included).
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
        self.ids, self.k = ids, k
        self.vectors = vectors
        self.floats = vectors.astype(np.float64)
        self.norms = np.sqrt((self.floats**2).sum(axis=1))
        self.low, self.high = low, high
        #: Found so far: window (anchor * windows + window), score, id; in the order of windows, then rank.
        self.at = np.zeros(0, np.int64)
        self.scores = np.zeros(0, np.int64)
        self.found = np.zeros(0, np.int64)
        #: The least score that can still enter a window.
        self.least = low.copy()
        self.visited = self.scored = 0

    def bounds(self, tree: Tree, node: int, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the largest score that rows of a node can have, for some anchors; safe against rounding."""
        centre, radius = tree.centres[node], tree.radii[node]
        middle = self.floats[who] @ centre
        spread = self.norms[who] * radius
        spread = spread + 1e-9 * (self.norms[who] * (np.sqrt(centre @ centre) + radius) + 1)
        return middle - spread, middle + spread

    def needed(self, tree: Tree, node: int, who: np.ndarray) -> tuple[np.ndarray, float]:
        """Those of ``who`` for which the node may hold a row that is wanted, and its mean upper bound."""
        lower, upper = self.bounds(tree, node, who)
        wanted = (upper[:, None] >= self.least[who]) & (lower[:, None] <= self.high[who])
        return who[wanted.any(axis=1)], float(upper.mean()) if len(who) else 0.0

    def visit(self, tree: Tree, who: np.ndarray) -> None:
        todo = [(0, who)]
        while todo:
            node, who = todo.pop()
            who, _ = self.needed(tree, node, who)
            if not len(who):
                continue
            self.visited += 1
            start, end, left, right = tree.spans[node].tolist()
            if left < 0:
                self.score(tree, start, end, who)
                continue
            # the more promising child is taken first: it raises what the other has to beat
            order = sorted((left, right), key=lambda c: self.bounds(tree, c, who)[1].mean())
            todo += [(c, who) for c in order]

    def score(self, tree: Tree, start: int, end: int, who: np.ndarray) -> None:
        rows, anchors = tree.vectors[start:end], self.vectors[who]
        self.scored += len(rows) * len(who)
        if float(self.norms[who].max()) * float(np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1).max(initial=0))) < 2**52:
            scores = (self.floats[who] @ rows.astype(np.float64).T).astype(np.int64)  # exact: all partial sums are below 2**53
        else:
            scores = (anchors.astype(object) @ rows.astype(object).T).astype(np.int64)
        other = self.ids[who][:, None] != tree.ids[start:end]
        at, which, ids = [], [], []
        for w in range(self.low.shape[1]):
            a, r = np.nonzero(other & (scores >= self.least[who, w][:, None]) & (scores <= self.high[who, w][:, None]))
            at.append(who[a] * self.low.shape[1] + w)
            which.append(scores[a, r])
            ids.append(tree.ids[start:end][r])
        self.add(np.concatenate(at), np.concatenate(which), np.concatenate(ids))

    def add(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(at):
            return
        at, scores, ids = np.concatenate([self.at, at]), np.concatenate([self.scores, scores]), np.concatenate([self.found, ids])
        order = np.lexsort((ids, -scores, at))
        at, scores, ids = at[order], scores[order], ids[order]
        first = np.searchsorted(at, at, "left")
        rank = np.arange(len(at)) - first
        keep = rank < self.k
        last = rank == self.k - 1
        least = self.least.reshape(-1)
        least[at[last]] = np.maximum(least[at[last]], scores[last])
        self.at, self.scores, self.found = at[keep], scores[keep], ids[keep]


def _searched(anchors: pa.Table, rows: pa.Table, k: int, same: bool) -> pa.Table:
    """The first k of a block of anchors in a group of trees, of the anchors' label or of others: _FOUND's columns."""
    parts = [_FOUND.empty_table()]
    if len(anchors) and len(rows):
        vectors = _matrix(_one(anchors["vector"]), max(rows["dim"].to_pylist()))
        ids, labels, own = (anchors[c].to_numpy() for c in ("anchor_id", "label", "anchor_row"))
        lows, highs = (_one(anchors[c]).flatten().to_numpy().reshape(len(ids), -1) for c in ("lows", "highs"))
        grown = [Tree(r, vectors.shape[1]) for r in rows.to_pylist()]
        # anchors that are alike walk together
        order = np.lexsort((_nearest(vectors, vectors[:16]), labels))
        for start in range(0, len(order), _TOGETHER):
            who = order[start : start + _TOGETHER]
            search = Search(ids[who], vectors[who], lows[who], highs[who], k)
            for tree in sorted(grown, key=lambda t: -search.bounds(t, 0, np.arange(len(search.ids)))[1].mean()):
                search.visit(tree, np.flatnonzero((labels[who] == tree.label) == same))
            anchor, window = np.divmod(search.at, lows.shape[1])
            parts.append(pa.table([own[who][anchor], window.astype(np.int32), search.scores, search.found], schema=_FOUND))
    return pa.concat_tables(parts)


def _search(tables: Tables, anchors: DataFrame, forest: DataFrame, k: int, same: bool) -> DataFrame:
    """(anchor_row, window, score, vec_id, rank): the first k of each window of anchors (_ANCHOR).

    Blocks of anchors and groups of trees are numbered within a label if only trees of the own label count.
    """
    blocks, groups = (lambda n: F.ceil(n / BLOCK)), (lambda n: F.ceil(n / GROUP))
    if same:
        sizes = anchors.groupBy("label").agg(blocks(F.count("*")).alias("blocks")).join(forest.groupBy("label").agg(groups(F.count("*")).alias("groups")), "label")
        sizes = tables.put(sizes, "sizes")
        anchors, forest, keys = anchors.join(sizes, "label"), forest.join(sizes, "label"), ("label", "block", "group")
    else:
        sizes = {"blocks": blocks(F.lit(anchors.count())), "groups": groups(F.lit(forest.count()))}
        anchors, forest, keys = anchors.withColumns(sizes), forest.withColumns(sizes), ("block", "group")
    some = lambda key, n: F.pmod(F.xxhash64(key), F.col(n))
    every = lambda n: F.explode(F.when(F.col(n) > 0, F.sequence(F.lit(0).cast("long"), F.col(n) - 1)))
    left = anchors.select(*_ANCHOR, some("anchor_row", "blocks").alias("block"), every("groups").alias("group"))
    right = forest.select(*_TREE_COLUMNS, some("tree", "groups").alias("group"), every("blocks").alias("block"))
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(lambda a, t: _searched(a, t, k, same), "anchor_row long, window int, score long, vec_id long")
    ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("anchor_row", "window").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k)


def mine(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100), scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows(vec_id, embedding, label).

    anchors: which rows are anchors, a condition on vec_id. A negative's score is at least share[0] / share[1]
    of its positive's and at most the positive's.
    """
    tables = Tables(rows.sparkSession, "negatives")
    own = tables.put(points(rows, scale), "points")
    forest = tables.put(trees(own), "trees")
    wide = lambda x: F.array(F.lit(x).cast("long"))
    first = own.where(anchors).select(F.monotonically_increasing_id().alias("anchor_row"), F.col("vec_id").alias("anchor_id"), "label", "vector")
    first = tables.put(first, "anchors")
    all_scores = first.withColumns({"lows": wide(-(2**63)), "highs": wide(2**63 - 1)})
    good = _search(tables, all_scores, forest, positives, True)
    good = tables.put(good.select("anchor_row", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    num, den = share
    scaled = F.col("positive_score").cast("decimal(28,0)") * num
    least = F.when(scaled > 0, scaled + (den - 1)).otherwise(scaled)
    windows = good.select("anchor_row", "window", "positive_score", least.alias("scaled")).withColumn("low", F.expr(f"scaled div {den}"))
    windows = windows.groupBy("anchor_row").agg(F.sort_array(F.collect_list(F.struct("window", "low", "positive_score"))).alias("w"))
    # missing positives have a window without scores
    filled = lambda c, x: F.slice(F.concat(F.col(f"w.{c}"), F.array_repeat(F.lit(x).cast("long"), positives)), 1, positives)
    second = first.join(windows.select("anchor_row", filled("low", 1).alias("lows"), filled("positive_score", 0).alias("highs")), "anchor_row")
    second = tables.put(second, "windows")
    bad = _search(tables, second, forest, negatives, False)
    named = bad.join(good, ["anchor_row", "window"]).join(first.select("anchor_row", "anchor_id"), "anchor_row")
    return named.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
