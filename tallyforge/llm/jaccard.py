"""N-gram Jaccard join: documents whose word-shingle sets reach a Jaccard threshold, without losing a link.

1. Blocking. For a band of set sizes, two linked sets differ in at most H elements, so if the elements
   are dealt by hash to more than H parts, some part is the same in both. A set sends one key per
   non-empty part, under the scheme of its own band and of the bands that smaller partners may lie in.
   Empty parts are not keys; a set with so many empty ones that its agreeing parts might all be empty
   also sends its prefix-filter keys, which suffices because a pair is unsafe only if both sets are.
   Most keys have one holder; the others' holders get their signatures joined. A batch deals the
   holders of a key that it has beyond two to 64 salts, as these are known to share it, so the rows of
   a hot key spread.
2. Signature trees (nodes with OR-ed token bitmaps and size ranges) over the holders of a key are
   traversed in pairs: a pair of nodes goes when its largest possible overlap misses the threshold, or
   when all its sets are connected already. Keys with over ``block`` holders are dealt to blocks. Only
   which sets are connected counts, so all blocks meet one block of leaders first; then the sets outside
   the largest connected part meet each other and that part, in pairs of blocks in different tasks.
3. Sets that surviving pairs connect form a candidate cluster. Each set moves to its cluster, and the
   same traversal there, with bitmaps of whole sets, compares what is left exactly, on sorted arrays.

Classes are the components of the links. Sets are compared by 64-bit shingle hashes.
Rows: a null or wordless text has the empty set and no links; a text shorter than a shingle is one
shingle. Rows that share a doc_id count as one document; a row with a null doc_id can't be named, so it
gets a null component and links to nothing. Other columns of docs aren't returned.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Tables, bitmap_of, components, in_bitmap, lean, partitions
from .text import U, chunks, flat, mix, shingle_sets

_BAND = 1.4
_SALTS = 64
_LEAF, _FAN = 8, 8


def least_overlap(a, b, num: int, den: int):
    """The smallest intersection of linked sets of sizes a and b: den * i >= num * (a + b - i)."""
    return -(-(num * (a + b)) // (num + den))


class Bands:
    """Bands of set sizes up to ``top``, with the number of parts that their scheme needs."""

    def __init__(self, num: int, den: int, top: int):
        self.num, self.den = num, den
        low = [1]
        while low[-1] <= top:
            low.append(max(low[-1] + 1, int(low[-1] * _BAND)))
        self.low = np.array(low)
        last = self.low[1:] - 1
        most = last * den // num
        self.differ = (last + most) * (den - num) // (den + num)  # H of a pair whose smaller set lies in the band
        self.parts = self.differ + 1 + (self.differ + 1) // 12 + np.minimum(self.differ, 3)

    def of(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, n, "right") - 1


def _fingerprints(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit fingerprints of every set, 0 for the empty one."""
    n, full = len(at) - 1, np.flatnonzero(np.diff(at))
    out = np.zeros((2, n), U)
    for i in range(2):
        if len(full):
            out[i, full] = mix(np.add.reduceat(mix(h + U(0x51ED270B * (i + 1))), at[:-1][full]) + U(i))
    return out[0], out[1]


def block_keys(h: np.ndarray, at: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys, whose low six bits are the band of their scheme, and the index of the set that sends each."""
    size = np.diff(at)
    if not size.any():
        return np.zeros(0, U), np.zeros(0, np.int64)
    bands = Bands(num, den, int(size.max()))
    own = bands.of(np.maximum(size, 1))
    lowest = bands.of(np.maximum(-(-size * num // den), 1))
    keys, who = [], []
    for step in range(int((own - lowest).max()) + 1):
        band = own - step
        use = np.flatnonzero((size > 0) & (band >= lowest))
        if not len(use):
            continue
        m = bands.parts[band[use]].astype(U)
        n = size[use]
        row = np.repeat(np.arange(len(use)), n)
        take = np.repeat(at[:-1][use] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        own_h = h[take]
        part = ((own_h >> U(32)) * m[row]) >> U(32)  # monotone in the hash, so a part's elements stand together
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (part[1:] != part[:-1])
        begin = np.flatnonzero(new)
        content = np.add.reduceat(mix(own_h), begin)
        scheme = band.astype(U) & U(63)
        who.append(use[row[begin]])
        keys.append(mix(content + mix(part[begin])) & ~U(63) | scheme[who[-1]])
        empty = m.astype(np.int64) - np.bincount(row[begin], minlength=len(use))
        risky = use[empty >= m.astype(np.int64) - bands.differ[band[use]]]
        if len(risky):  # prefix filter: of linked sets, the first size - overlap + 1 elements meet
            prefix = size[risky] - -(-size[risky] * num // den) + 1
            row = np.repeat(np.arange(len(risky)), prefix)
            take = np.repeat(at[:-1][risky] - (np.cumsum(prefix) - prefix), prefix) + np.arange(prefix.sum())
            who.append(risky[row])
            keys.append(mix(h[take] ^ U(0x7F4A7C15)) & ~U(63) | scheme[who[-1]])
    return np.concatenate(keys), np.concatenate(who)


def _level(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For bands of sets of ``low`` elements or more: elements with so many zero bits at the end of their
    hash are in the signature (all, a half or a quarter), and the signature's bits."""
    level = (low >= 200).astype(np.int64) + (low >= 800)
    return level, np.left_shift(1, np.clip(np.ceil(np.log2(2.0 * low)).astype(np.int64) - level, 8, 15))


def _marks(h: np.ndarray, level: int, bits: int) -> tuple[int, bytes]:
    """Number of the set's elements in its signature, and the signature."""
    own = h[(h & U((1 << level) - 1)) == 0]
    bit = (own >> U(8)) & U(bits - 1)
    out = np.zeros(bits, np.uint8)
    out[bit.astype(np.int64)] = 1
    return len(own), np.packbits(out, bitorder="little").tobytes()


def _key_rows(size: int, num: int, den: int) -> Callable:
    """Rows (k, salt, f): the keys of a batch and their holders' fingerprints."""

    def run(batches):
        for b in batches:
            keys, nodes = [np.zeros(0, U)], [np.zeros(0, U)]
            buf, at = flat(b["text"])
            for _, _, own, own_at in chunks(buf, at):
                h, offsets = shingle_sets(own, own_at, size)
                k, who = block_keys(h, offsets, num, den)
                keys.append(k)
                nodes.append(_fingerprints(h, offsets)[0][who])
            k, f = np.concatenate(keys), np.concatenate(nodes)
            order = np.lexsort((f, k))
            k, f = k[order], f[order]
            new = np.ones(len(k), bool)
            new[1:] = (k[1:] != k[:-1]) | (f[1:] != f[:-1])
            k, f = k[new], f[new]
            first = np.ones(len(k), bool)
            first[1:] = k[1:] != k[:-1]
            rank = np.arange(len(k)) - np.flatnonzero(first)[np.cumsum(first) - 1]
            salt = np.where(rank < 2, 0, 1 + (f & U(_SALTS - 1)).astype(np.int64)).astype(np.int32)
            for i in range(0, len(k), 1 << 17):
                own = slice(i, i + (1 << 17))
                yield pa.RecordBatch.from_arrays([pa.array(k[own].view(np.int64)), pa.array(salt[own]), pa.array(f[own].view(np.int64))], ["k", "salt", "f"])

    return run


def _shared_keys(batches):
    """Rows (k, salt, f) sorted by k and salt: the holders (k, f) of keys that have two; some come twice."""
    last, hub, told = None, None, False
    for b in batches:
        k, salt, f = (b[x].to_numpy() for x in ("k", "salt", "f"))
        if not len(k):
            continue
        first = np.ones(len(k), bool)
        first[1:] = (k[1:] != k[:-1]) | (salt[1:] != salt[:-1])
        begin, run = np.flatnonzero(first), np.cumsum(first) - 1
        hubs, known = f[begin], np.zeros(len(begin), bool)
        if last == (k[0], salt[0]):
            hubs[0], known[0] = hub, told
        other = (f != hubs[run]) | (salt > 0)
        shared = np.bincount(run[other], minlength=len(begin)) > 0
        say = shared & ~known & (salt[begin] == 0)
        out_k, out_f = np.concatenate([k[other], k[begin][say]]), np.concatenate([f[other], hubs[say]])
        last, hub, told = (k[-1], salt[-1]), hubs[-1], bool(known[-1] or shared[-1])
        yield pa.RecordBatch.from_arrays([pa.array(out_k), pa.array(out_f)], ["k", "f"])


def _signatures(size: int, num: int, den: int) -> Callable:
    """Rows (f, band, n, c, marks): each set's size, and its signature in the bands that it has keys of."""

    def run(batches):
        for b in batches:
            buf, at = flat(b["text"])
            seen: set = set()
            for _, _, own, own_at in chunks(buf, at):
                h, offsets = shingle_sets(own, own_at, size)
                n = np.diff(offsets)
                if not n.any():
                    continue
                f, bands = _fingerprints(h, offsets)[0].view(np.int64).tolist(), Bands(num, den, int(n.max()))
                top, least = bands.of(np.maximum(n, 1)).tolist(), bands.of(np.maximum(-(-n * num // den), 1)).tolist()
                level, bits = _level(bands.low)
                rows = []
                for i in np.flatnonzero(n).tolist():
                    if f[i] not in seen:
                        seen.add(f[i])
                        own_h, made = h[offsets[i] : offsets[i + 1]], {}
                        for band in range(least[i], top[i] + 1):
                            kind = int(level[band]), int(bits[band])
                            if kind not in made:
                                made[kind] = _marks(own_h, *kind)
                            rows.append((f[i], band, len(own_h), *made[kind]))
                if rows:
                    cols = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.binary())], ["f", "band", "n", "c", "marks"])

    return run


def _profiles(size: int, bitmap: np.ndarray) -> Callable:
    """Size and fingerprints of every row's set, and the set itself where a candidate link may exist."""

    def run(batches):
        for b in batches:
            buf, at = flat(b["text"])
            for i, j, own, own_at in chunks(buf, at):
                h, offsets = shingle_sets(own, own_at, size)
                f1, f2 = _fingerprints(h, offsets)
                n = np.diff(offsets)
                want = in_bitmap(bitmap, f1.view(np.int64)) & (n > 0)
                sets = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n * want)])), pa.array(h[np.repeat(want, n)].view(np.int64)))
                sets = pa.ListArray.from_arrays(sets.offsets.cast(pa.int32()), sets.values)
                yield pa.RecordBatch.from_arrays([b["doc_id"].slice(i, j - i), pa.array(n.astype(np.int64)), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), sets, pa.array(want)], ["doc_id", "n", "f", "g", "shingles", "candidate"])

    return run


class _Forest:
    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return int(i)

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


class SignatureTree:
    """Sets in size order. ``marks`` are bitmaps of ``sampled`` elements of each set; a node has the OR of
    its sets' bitmaps, its range of sizes, the most elements in and beside a bitmap, and the most that
    share a bit with another element of their set."""

    def __init__(self, sizes: np.ndarray, sampled: np.ndarray, marks: np.ndarray):
        self.order = np.argsort(sizes, kind="stable")
        self.sizes, self.sampled, self.marks = sizes[self.order], sampled[self.order], marks[self.order]
        self.beside = self.sizes - self.sampled
        self.shared = self.sampled - np.bitwise_count(self.marks).sum(axis=1, dtype=np.int64)
        level = [(i, min(i + _LEAF, len(sizes)), []) for i in range(0, len(sizes), _LEAF)]
        while len(level) > 1:
            level = [(g[0][0], g[-1][1], g) for g in (level[i : i + _FAN] for i in range(0, len(level), _FAN))]
        self.root = self._node(*level[0])

    def _node(self, begin: int, end: int, below: list) -> dict:
        own = slice(begin, end)
        return {
            "begin": begin, "end": end, "kids": [self._node(*x) for x in below], "marks": np.bitwise_or.reduce(self.marks[own], axis=0),
            "low": int(self.sizes[begin]), "high": int(self.sizes[end - 1]), "sampled": int(self.sampled[own].max()),
            "beside": int(self.beside[own].max()), "shared": int(self.shared[own].max()),
        }


def _may_link(a: dict, b: dict, num: int, den: int) -> bool:
    """Whether the largest possible overlap of a set below a and one below b reaches the threshold."""
    if a["high"] * den < b["low"] * num or b["high"] * den < a["low"] * num:
        return False
    common = int(np.bitwise_count(a["marks"] & b["marks"]).sum()) + min(a["shared"], b["shared"])
    most = min(a["sampled"], b["sampled"], common) + min(a["beside"], b["beside"])
    return min(most, a["high"], b["high"]) >= least_overlap(a["low"], b["low"], num, den)


def tree_links(left: SignatureTree, right: SignatureTree | None, num: int, den: int, linked: Callable | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links between two trees (or inside one), as positions left, then right.

    ``linked(p, q)`` decides on what the bounds leave; without it they decide.
    """
    other, base = right or left, len(left.sizes) if right else 0
    total = len(left.sizes) + (len(other.sizes) if right else 0)
    forest, out = _Forest(total), []
    names = np.concatenate([left.order, base + other.order]) if right else left.order

    def compare(own: slice, tos: slice) -> None:
        sa, sb = left.sizes[own, None], other.sizes[None, tos]
        common = np.bitwise_count(left.marks[own, None] & other.marks[None, tos]).sum(axis=2, dtype=np.int64)
        most = np.minimum(common + np.minimum(left.shared[own, None], other.shared[None, tos]), np.minimum(left.sampled[own, None], other.sampled[None, tos]))
        most = np.minimum(most + np.minimum(left.beside[own, None], other.beside[None, tos]), np.minimum(sa, sb))
        for x, y in np.argwhere(most >= least_overlap(sa, sb, num, den)).tolist():
            p, q = own.start + x, base + tos.start + y
            if p != q and forest.find(p) != forest.find(q) and (linked is None or linked(int(names[p]), int(names[q]))):
                forest.join(p, q)
                out.append((int(names[p]), int(names[q])))

    # a few sets against all others first: in a family of near copies they connect nearly everything
    for p in {0, len(left.sizes) // 2}:
        compare(slice(p, p + 1), slice(0, len(other.sizes)))
    todo = [(left.root, other.root)]
    while todo:
        a, b = todo.pop()
        if not _may_link(a, b, num, den):
            continue
        root = forest.find(a["begin"])
        if all(forest.find(x) == root for x in range(a["begin"], a["end"])) and all(forest.find(base + x) == root for x in range(b["begin"], b["end"])):
            continue
        if a["kids"] or b["kids"]:
            todo += [(x, y) for x in a["kids"] or [a] for y in b["kids"] or [b] if right or x["begin"] <= y["begin"]][::-1]
        else:
            compare(slice(a["begin"], a["end"]), slice(b["begin"], b["end"]))
    return out


def _candidates(num: int, den: int) -> Callable:
    """Links that signatures allow, in a unit of rows (f, n, c, marks) by side."""

    def solve(sides: list[list[tuple]]) -> list[tuple[int, int]]:
        if len(sides) == 1 and len(sides[0]) == 2:  # two leaves: the bound of their pair
            (f, n, c, a), (g, m, d, b) = sides[0]
            a, b = int.from_bytes(a, "little"), int.from_bytes(b, "little")
            common = (a & b).bit_count() + min(c - a.bit_count(), d - b.bit_count())
            return [(f, g)] if min(min(c, d, common) + min(n - c, m - d), n, m) >= least_overlap(n, m, num, den) else []
        trees = [SignatureTree(np.array([r[1] for r in x]), np.array([r[2] for r in x]), np.frombuffer(b"".join(r[3] for r in x), U).reshape(len(x), -1)) for x in sides]
        names = [r[0] for x in sides for r in x]
        return [(names[p], names[q]) for p, q in tree_links(trees[0], trees[1] if len(trees) > 1 else None, num, den)]

    return _by_unit(solve, ["f", "n", "c", "marks"])


def _verified(num: int, den: int) -> Callable:
    """Exact links in a unit of rows (rep, shingles) by side."""

    def solve(sides: list[list[tuple]]) -> list[tuple[int, int]]:
        sets = [r[1].values.to_numpy().view(U) for x in sides for r in x]
        names = [r[0] for x in sides for r in x]
        bits = min(1 << 16, max(512, 1 << (4 * max(map(len, sets)) - 1).bit_length()))
        marks = np.frombuffer(b"".join(_marks(s, 0, bits)[1] for s in sets), U).reshape(len(sets), -1)
        sizes, cut = np.array(list(map(len, sets))), len(sides[0])
        trees = [SignatureTree(sizes[x], sizes[x], marks[x]) for x in (slice(0, cut), slice(cut, None)) if len(sizes[x])]

        def linked(p: int, q: int) -> bool:
            s, t = sorted((sets[p], sets[q]), key=len)
            overlap = int((t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s).sum())
            return den * overlap >= num * (len(s) + len(t) - overlap)

        return [(names[p], names[q]) for p, q in tree_links(trees[0], trees[1] if len(trees) > 1 else None, num, den, linked)]

    return _by_unit(solve, ["rep", "shingles"])


def _by_unit(solve: Callable, columns: list[str]) -> Callable:
    """Rows sorted by (unit, i, j, side): what ``solve`` makes of each unit's rows by side."""

    def run(batches):
        unit, sides = None, {}
        for b in batches:
            found = []
            heads = zip(*(b[x].to_pylist() for x in ("unit", "i", "j", "side")), strict=True)
            data = zip(*(b[x] if x == "shingles" else b[x].to_pylist() for x in columns), strict=True)
            for (u, i, j, side), row in zip(heads, data, strict=True):
                if (u, i, j) != unit:
                    if sum(map(len, sides.values())) > 1:
                        found += solve(list(sides.values()))
                    unit, sides = (u, i, j), {}
                sides.setdefault(side, []).append(row)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], ["a", "b"])
        if sum(map(len, sides.values())) > 1:
            found = solve(list(sides.values()))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], ["a", "b"])

    return run


def _dealt(units: DataFrame, parts: int) -> DataFrame:
    return units.repartition(parts, "unit", "i", "j").sortWithinPartitions("unit", "i", "j", "side")


def _blocks_of(n: str, block: int) -> Column:
    return F.ceil(F.col(n) / block).cast("int")


def _led(rows: DataFrame, sizes: DataFrame, unit: str, name: str, block: int) -> DataFrame:
    """rows dealt by unit; in one of over ``block`` rows block 0 meets every block."""
    key = F.col(unit).bitwiseXOR(F.lit(0x5DEECE66D)).alias("unit")  # keyed anew, so that AQE can split a large unit's join
    rows = rows.withColumn("unit", key).join(sizes.select(key, "members"), "unit").withColumn("blocks", _blocks_of("members", block))
    own = F.pmod(F.xxhash64(name), F.col("blocks")).cast("int")
    return (
        rows.withColumn("own", own).withColumn("j", F.explode(F.when(F.col("own") == 0, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("own"))))
        .withColumns({"i": F.lit(0), "side": F.when(F.col("own") == 0, 0).otherwise(1)}).drop("members", "blocks", "own")
    )


def _unled(members: DataFrame, tops: DataFrame, unit: str, name: str, block: int) -> DataFrame:
    """Rows (unit, name, component) of units with the rows outside their largest component: these meet each other and all others."""
    key = F.col(unit).bitwiseXOR(F.lit(0x5DEECE66D)).alias("unit")
    rows = members.withColumn("unit", key).join(tops.select(key, "top", "n_rest", "n_top"), "unit")
    rows = rows.withColumns({"r": _blocks_of("n_rest", block), "g": _blocks_of("n_top", block), "rest": F.col("component") != F.col("top")})
    rows = rows.withColumn("own", F.pmod(F.xxhash64(name), F.when(F.col("rest"), F.col("r")).otherwise(F.col("g"))).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("rest"), F.col("r") + F.col("g")).otherwise(F.col("r")) - 1)))
    inside = F.col("rest") & (F.col("other") < F.col("r"))
    return rows.withColumns({
        "i": F.when(inside, F.least("own", "other")).when(F.col("rest"), F.col("own")).otherwise(F.col("other")),
        "j": F.when(inside, F.greatest("own", "other")).when(F.col("rest"), F.col("other")).otherwise(F.col("r") + F.col("own")),
        "side": F.when(F.col("rest") & (F.col("other") >= F.col("own")), 0).otherwise(1),
    }).drop("top", "n_rest", "n_top", "r", "g", "rest", "own", "other", "component")


def _linked(tables: Tables, rows: DataFrame, unit: str, name: str, block: int, meet: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(a, b): links that connect what the links of each unit's rows do; meet() finds them in dealt rows.

    A unit of M rows of which m aren't connected by the leaders takes M + m * (M + m) / block rows.
    """
    sizes = rows.groupBy(unit).agg(F.count("*").alias("members")).where("members > 1")
    first = tables.put(meet(_led(rows, sizes, unit, name, block)), "first")
    large = tables.put(sizes.where(F.col("members") > block), "large")
    if large.isEmpty():
        return first
    known = components(tables, first).withColumnRenamed("node", "of")
    members = rows.join(large.select(F.col(unit).alias("large")), F.col(unit) == F.col("large")).join(known, F.col(name) == F.col("of"), "left")
    members = tables.put(members.select(*rows.columns, F.coalesce("component", name).alias("component")), "members")
    by_part = members.groupBy(unit, "component").agg(F.count("*").alias("n")).groupBy(unit).agg(F.max(F.struct("n", "component")).alias("most"), F.sum("n").alias("total"))
    tops = by_part.select(unit, F.col("most.component").alias("top"), F.col("most.n").alias("n_top"), (F.col("total") - F.col("most.n")).alias("n_rest")).where("n_rest > 0")
    second = tables.put(meet(_unled(members, tops, unit, name, block)), "second")
    tables.drop(members, large)
    return first.union(second)


def classes(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, block: int = 256) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs(doc_id, text).

    Links: den * |x & y| >= num * |x | y| of the sets of ``size`` words; component_id is the smallest
    doc_id that links reach. ``block`` bounds the sets of one side of a comparing task.
    """
    spark = docs.sparkSession
    tables, parts = Tables(spark, "jaccard"), partitions(spark)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    named = docs.where("doc_id is not null")
    keys = named.select("text").mapInArrow(lean(_key_rows(size, num, den)), "k long, salt int, f long")
    shared = keys.repartition(parts, "k", "salt").sortWithinPartitions("k", "salt").mapInArrow(lean(_shared_keys), "k long, f long").distinct()
    shared = tables.put(shared, "shared")
    signatures = named.select("text").mapInArrow(lean(_signatures(size, num, den)), "f long, band long, n long, c long, marks binary").distinct()

    def meet_signatures(units: DataFrame) -> DataFrame:
        holders = units.withColumn("band", F.col("k").bitwiseAND(F.lit(63))).drop("k").join(signatures, ["f", "band"])
        return _dealt(holders, parts).mapInArrow(lean(_candidates(num, den)), "a long, b long").distinct()

    hints = _linked(tables, shared, "k", "f", 4 * block, meet_signatures)
    clusters = tables.put(components(tables, hints), "clusters")
    tables.drop(shared)
    bitmap = bitmap_of(clusters.select(F.col("node").alias("id")))
    kinds = "doc_id long, n long, f long, g long, shingles array<long>, candidate boolean"
    profile = tables.put(docs.mapInArrow(lean(_profiles(size, bitmap)), kinds), "profiles")
    equal = profile.where("doc_id is not null and n > 0").groupBy("f", "g", "n").agg(F.min("doc_id").alias("rep"))
    equal = tables.put(equal, "equal")
    # the sets of one document of each class of equal sets, with its cluster
    held = equal.join(clusters, equal.f == clusters.node).select("rep", F.col("f").alias("ef"), F.col("g").alias("eg"), F.col("component").alias("cluster"))
    sets = profile.where("candidate").select("doc_id", "f", "g", "shingles")

    def meet_sets(units: DataFrame) -> DataFrame:
        rows = sets.join(units.drop("cluster"), (F.col("doc_id") == F.col("rep")) & (F.col("f") == F.col("ef")) & (F.col("g") == F.col("eg")))
        return _dealt(rows.select("unit", "i", "j", "side", "rep", "shingles"), parts).mapInArrow(lean(_verified(num, den)), "a long, b long")

    links = _linked(tables, tables.put(held, "held"), "cluster", "rep", block, meet_sets)
    found = tables.put(components(tables, links), "components")
    # equal sets share a representative; then a row's document takes the component of its representative
    own = profile.where("doc_id is not null and n > 0").join(equal.select("f", "g", "n", "rep"), ["f", "g", "n"]).select("doc_id", "rep")
    same = own.where("doc_id <> rep").distinct()
    if not same.join(same.groupBy("doc_id").agg(F.count("*").alias("reps")).where("reps > 1"), "doc_id", "left_semi").isEmpty() or not same.join(same.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").isEmpty():
        # a repeated doc_id holds different texts: its rows are one document, so they join their classes
        found = tables.put(components(tables, found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(same.select("doc_id", "rep"))), "components")
        named_as = found.select(F.col("node").alias("doc"), "component")
        joined = profile.join(named_as, F.col("doc_id") == F.col("doc"), "left")
        return joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    lead = equal.join(found, equal.rep == found.node, "left").select(F.col("f").alias("lf"), F.col("g").alias("lg"), F.col("n").alias("ln"), F.coalesce("component", "rep").alias("lead"))
    out = profile.join(lead, (F.col("f") == F.col("lf")) & (F.col("g") == F.col("lg")) & (F.col("n") == F.col("ln")) & F.col("doc_id").isNotNull() & (F.col("n") > 0), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("lead", "doc_id")).alias("component_id"))
