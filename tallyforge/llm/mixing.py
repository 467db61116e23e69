"""Mixing sources to target weights: soft domain membership, and document rates by projected gradient.

A classifier fitted on a table of labelled documents gives each document a posterior over the domains of
that table. It is a multinomial logistic regression on the ``most`` hashed words that a test finds to tell
the domains apart best, and on a few measures of form cut into bins; its scores are scaled on labelled
rows that it did not see. The sample and the number of features are bounded, so the driver fits the
weights; posteriors are of all documents, from whole texts.

Rates r >= 0 minimise, over all documents i with t tokens (words) and posteriors p,

    sum_k (weight of the targets) / share_k * (sum_i r_i t_i p_ik / T - target_k)^2 + sum_i t_i / T * (r_i - 1)^2

with T the corpus' tokens and share_k domain k's expected share of them: expected domain totals go to the
targets while rates stay near 1. A miss counts by the domain's own share, so a rare domain is held to its
target like a common one: of the way from its share to its target a domain of sure members is left
1 / (1 + weight), whatever its share. A projected gradient step of a document needs only the K residuals of the totals, so each round is one pass that
applies all rounds so far to a document's own numbers and adds up K sums; the driver holds the residuals.
Targets are shares of T; a target of 0 sends a domain's sure members to rate 0, and members of the other
domains keep their rates.

Rows: a null or wordless text has 0 tokens, the posterior of no evidence (the prior) and the rate that
goes with it. Null and repeated doc_ids are rated like others; labels with a null or unknown doc_id are
left out. Without labels every document has rate 1. Extra columns stay; one named like an added column
(n_tokens, posterior, domain, rate) is a ValueError, which ``mark`` avoids.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Tables, _give_back, lean
from .text import U, chunks, flat, lower_ascii, prefix_hash, span_hash, words

_FORMS = 8  # bins of each measure of form
_DOMAINS = 250  # at most: feature counts are keyed by feature * 256 + domain


@dataclass(frozen=True)
class DomainModel:
    domains: tuple[str, ...]
    prior: np.ndarray  # log-probabilities
    weights: np.ndarray  # (features, domains): what a present feature adds to each domain's score
    scale: float

    @property
    def buckets(self) -> int:
        return len(self.weights) - 4 * _FORMS


def features(buf: np.ndarray, at: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents and features (distinct by document), and the number of words of each document.

    Features are hashed lower-cased words without the marks around them, and binned measures: share of
    capitals, symbols by word, share of the most frequent word, characters by word.
    """
    n = len(at) - 1
    starts, ends, doc = words(buf, at)
    low = lower_ascii(buf)
    mark = ((low < 48) | ((low > 57) & (low < 97)) | ((low > 122) & (low < 128)))

    for _ in range(4):  # up to four marks on either side
        keep = ends - starts > 1
        starts = starts + (keep & mark[starts])
        keep = ends - starts > 1
        ends = ends - (keep & mark[ends - 1])
    h = span_hash(*prefix_hash(low), starts, ends)
    bucket = (h >> U(64 - int(buckets).bit_length() + 1)).astype(np.int64)
    key = np.sort(doc * buckets + bucket)
    edge = np.ones(len(key) + 1, bool)
    edge[1:-1] = key[1:] != key[:-1]
    begin = np.flatnonzero(edge)
    runs, own = np.diff(begin), key[begin[:-1]]
    n_words = np.bincount(doc, minlength=n)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, own // buckets, runs)
    sums = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[at])
    letters = sums((low >= 97) & (low <= 122))
    per = np.maximum(n_words, 1)
    symbol = np.isin(buf, np.frombuffer(b"#*$%&|<>", np.uint8))
    measured = [sums((buf >= 65) & (buf <= 90)) / np.maximum(letters, 1), np.minimum(sums(symbol) / per, 1), most / per, np.minimum(np.diff(at) / per / 32, 1)]
    some = np.flatnonzero(n_words)
    forms = [buckets + _FORMS * i + np.minimum((np.sqrt(m[some]) * _FORMS).astype(np.int64), _FORMS - 1) for i, m in enumerate(measured)]
    return np.concatenate([own // buckets, *[some] * 4]), np.concatenate([own % buckets, *forms]), n_words


def _feature_counts(buckets: int):
    def run(batches):
        for b in batches:
            buf, at = flat(b["text"])
            domain = b["domain"].to_numpy(zero_copy_only=False).astype(np.int64)
            for i, j, own, own_at in chunks(buf, at):
                doc, feature, _ = features(own, own_at, buckets)
                code, count = np.unique(feature * 256 + domain[i:j][doc], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(code // 256), pa.array(code % 256), pa.array(count)], ["feature", "domain", "n"])

    return run


def scores(model: DomainModel, buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unscaled scores (documents, domains) beside the prior, and the number of words."""
    doc, feature, n_words = features(buf, at, model.buckets)
    use = model.weights[feature].any(axis=1)
    out = np.zeros((len(at) - 1, len(model.domains)))
    np.add.at(out, doc[use], model.weights[feature[use]])
    return out, n_words


def posterior(model: DomainModel, score: np.ndarray) -> np.ndarray:
    z = model.prior + model.scale * score
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def _regression(x: np.ndarray, y: np.ndarray, prior: np.ndarray, ridge: float, rounds: int = 200) -> np.ndarray:
    """Weights of a multinomial logistic regression beside the prior, by accelerated gradient descent."""
    w = np.zeros((x.shape[1], len(prior)), np.float32)
    if not x.size:
        return w
    v, hot, prior = w, np.eye(len(prior), dtype=np.float32)[y], prior.astype(np.float32)
    step = np.float32(1.0 / (0.5 * float(np.linalg.eigvalsh((x.T @ x).astype(np.float64))[-1]) + ridge))
    for k in range(rounds):
        z = x @ v + prior
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        new = v - step * (x.T @ (p - hot) + np.float32(ridge) * v)
        v, w = new + np.float32(k / (k + 3)) * (new - w), new
    return w


def fit(docs: DataFrame, labelled: DataFrame, sample: int = 40_000, buckets: int = 1 << 17, strength: float = 30.0, most: int = 512, ridge: float = 2.0) -> DomainModel | None:
    """The model of labelled(doc_id, domain), of about ``sample`` rows chosen by a hash of doc_id.

    A feature counts if it is among the ``most`` of the greatest G statistic, and that is over ``strength``.
    All domains of labelled are in the model, also those without a row in the sample; too many are an error.
    """
    known = labelled.where("doc_id is not null and domain is not null").select(F.col("doc_id").alias("labelled_id"), F.col("domain").cast("string").alias("name")).distinct()
    total = known.count()
    if not total:
        return None
    roll = F.pmod(F.xxhash64("labelled_id", F.lit("mixing")), F.lit(1_000_000)) / 1_000_000
    names = tuple(r["name"] for r in known.groupBy("name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "name").limit(_DOMAINS + 1).collect())
    if len(names) > _DOMAINS:
        raise ValueError(f"labelled has more than {_DOMAINS} domains")
    known = known.withColumn("roll", roll).where(F.col("roll") < sample / total)
    place = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i))])
    cut = min(1.0, sample / total) * 0.75
    rows = docs.where("text is not null").select("doc_id", "text").join(known, F.col("doc_id") == F.col("labelled_id")).select("text", place[F.col("name")].alias("domain"), "roll").where("domain is not null")
    rows = Tables(docs.sparkSession, "mixing_sample").put(rows, "sample")
    counted = rows.where(F.col("roll") < cut)
    sizes = np.zeros(len(names))
    for r in counted.groupBy("domain").agg(F.count("*").alias("n")).collect():
        sizes[r["domain"]] = r["n"]
    if not sizes.sum():
        return None
    found = counted.select("text", "domain").mapInArrow(_feature_counts(buckets), "feature long, domain long, n long").groupBy("feature", "domain").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros((buckets + 4 * _FORMS, len(names)))
    n[found["feature"].to_numpy(), found["domain"].to_numpy()] = found["n"].to_numpy()
    share = n.sum(axis=1, keepdims=True) / sizes.sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        g = 2 * np.nansum(np.where(n > 0, n * np.log(n / (sizes * share)), 0) + np.where(sizes - n > 0, (sizes - n) * np.log((sizes - n) / (sizes * (1 - share))), 0), axis=1)
    best = np.argsort(-g, kind="stable")[:most]
    best = np.sort(best[g[best] > strength])
    spot = np.full(len(g), -1)
    spot[best] = np.arange(len(best))

    def present(batches):
        for b in batches:
            buf, at = flat(b["text"])
            domain = b["domain"].to_numpy(zero_copy_only=False).astype(np.int64)
            for i, j, own, own_at in chunks(buf, at):
                doc, feature, _ = features(own, own_at, buckets)
                use = spot[feature] >= 0
                order = np.argsort(doc[use], kind="stable")
                lists = np.split(spot[feature[use]][order], np.cumsum(np.bincount(doc[use], minlength=j - i))[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(domain[i:j]), pa.array(lists, pa.list_(pa.int32()))], ["domain", "on"])

    taught = counted.select("text", "domain").mapInArrow(present, "domain long, on array<int>").toArrow()
    x = np.zeros((taught.num_rows, len(best)), np.float32)
    on = taught["on"].combine_chunks()
    x[np.repeat(np.arange(len(on)), on.value_lengths().to_numpy()), on.flatten().to_numpy()] = 1
    prior, weights = np.log((sizes + 1) / (sizes + 1).sum()), np.zeros((len(g), len(names)), np.float32)
    weights[best] = _regression(x, taught["domain"].to_numpy(), prior, ridge)
    model = DomainModel(names, prior, weights, 1.0)
    del x, on, taught
    _give_back()  # the sample is large beside the model
    shared = docs.sparkSession.sparkContext.broadcast(model)
    grid = np.array([0.1, 0.2, 0.3, 0.5, 0.7, 1.0, 1.5])

    def losses(batches):
        sums = np.zeros(len(grid))
        for b in batches:
            buf, at = flat(b["text"])
            domain = b["domain"].to_numpy(zero_copy_only=False).astype(np.int64)
            for i, j, own, own_at in chunks(buf, at):
                score, _ = scores(shared.value, own, own_at)
                for k, s in enumerate(grid):
                    p = posterior(DomainModel(model.domains, model.prior, model.weights[:0], s), score)
                    sums[k] -= np.log(np.maximum(p[np.arange(j - i), domain[i:j]], 1e-12)).sum()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(grid)), pa.int64()), pa.array(sums)], ["k", "loss"])

    held = rows.where(F.col("roll") >= cut).select("text", "domain").mapInArrow(losses, "k long, loss double").groupBy("k").agg(F.sum("loss").alias("loss")).collect()
    scale = grid[min(held, key=lambda r: (r["loss"], r["k"]))["k"]] if held else 1.0
    return DomainModel(model.domains, model.prior, model.weights, float(scale))


def memberships(docs: DataFrame, model: DomainModel, mark: str = "", keep_text: bool = False, then: Callable | None = None, more: tuple[T.StructField, ...] = ()) -> DataFrame:
    """docs' columns (text only if kept), with n_tokens (words) and posterior array<double> in the model's order.

    ``then`` makes the columns ``more`` of a batch's posteriors, in the same worker.
    """
    beside = [f for f in docs.schema.fields if keep_text or f.name != "text"]
    names = [mark + "n_tokens", mark + "posterior"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            buf, at = flat(b["text"])
            for i, j, own, own_at in chunks(buf, at):
                score, n = scores(shared.value, own, own_at)
                p = posterior(shared.value, score)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, p.size + 1, p.shape[1]), pa.int32()), pa.array(p.ravel()))
                rest = b.slice(i, j - i)
                last = then(p) if then else []
                yield pa.RecordBatch.from_arrays([*(rest[f.name] for f in beside), pa.array(n.astype(np.int64)), lists, *last], [*(f.name for f in beside), *names, *(f.name for f in more)])

    kinds = T.StructType([*beside, T.StructField(names[0], T.LongType()), T.StructField(names[1], T.ArrayType(T.DoubleType())), *more])
    return docs.mapInArrow(lean(run), kinds)


def _rate(p: np.ndarray, history: np.ndarray, pull: float) -> tuple[np.ndarray, np.ndarray]:
    """Rates of documents with posteriors p after an accelerated projected gradient step for each row of
    residuals, and the points where the next residuals are to be taken.

    The gradient by r_i has the factor t_i / T in both parts; the steps are taken in that metric.
    """
    bend = 1.0 + pull  # of the objective at most; at least it is 1
    speed = (np.sqrt(bend) - 1) / (np.sqrt(bend) + 1)
    r = ahead = np.ones(len(p))
    for residual in history:
        new = np.maximum(0, ahead - (p @ residual + (ahead - 1)) / bend)
        r, ahead = new, new + speed * (new - r)
    return r, ahead


def expected(members: DataFrame, history: np.ndarray, pull: float) -> np.ndarray:
    """Expected domain totals, as shares of all tokens, at the rates of these residuals."""

    def totals(batches):
        sums = np.zeros(history.shape[1] + 1)
        for b in batches:
            lists = b["posterior"]
            p = lists.flatten().to_numpy().reshape(len(lists), -1)
            t = b["n_tokens"].to_numpy()
            sums[:-1] += (_rate(p, history, pull)[0] * t) @ p
            sums[-1] += t.sum()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int64()), pa.array(sums)], ["k", "v"])

    sums = np.zeros(history.shape[1] + 1)
    for r in members.select("n_tokens", "posterior").mapInArrow(totals, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect():
        sums[r["k"]] = r["v"]
    return sums[:-1] / max(sums[-1], 1)


def fit_rates(members: DataFrame, targets: np.ndarray, pull: float = 200.0, rounds: int = 600, tolerance: float = 1e-5, relative: bool = False) -> np.ndarray:
    """Residuals of all rounds; _rate() makes a document's rate of them.

    The weight of the targets is ``pull``, with ``relative`` divided by the domain's expected share, which
    bends the objective no more. A round is one pass over members; its K + 1 sums reach the driver.
    """
    history, weight = np.zeros((0, len(targets))), pull
    for _ in range(rounds):

        def totals(batches, history=history):
            sums = np.zeros(len(targets) + 1)
            for b in batches:
                lists = b["posterior"]
                p = lists.flatten().to_numpy().reshape(len(lists), -1)
                t = b["n_tokens"].to_numpy()
                sums[:-1] += (_rate(p, history, pull)[1] * t) @ p
                sums[-1] += t.sum()
            yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int64()), pa.array(sums)], ["k", "v"])

        found = members.select("n_tokens", "posterior").mapInArrow(totals, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
        sums = np.zeros(len(targets) + 1)
        for r in found:
            sums[r["k"]] = r["v"]
        if not sums[-1]:
            break
        share = sums[:-1] / sums[-1]
        if relative and not len(history):  # the first totals are those of rates of 1
            weight = pull / np.where(share > 0, share, 1)
        residual = weight * (share - targets)
        if len(history) and np.abs(residual - history[-1]).max() < tolerance * pull:
            break
        history = np.vstack([history, residual])
    return history


def rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, pull: float = 200.0, mark: str = "", keep_text: bool = False, **settings) -> DataFrame:
    """docs' columns, with n_tokens, posterior, domain (the likeliest) and rate >= 0; names take ``mark``.

    ``targets`` are domains' token totals as shares of the corpus'; a domain without one keeps its expected
    share. With keep_text the rows have their text, and are scored a second time rather than joined to what
    was stored of them.

    Targets of 0 can be reached only as far as posteriors are sure: a rate serves all domains of a document.
    The result's attribute ``tallyforge_totals`` has each domain's (share, target, expected total at the rates).
    """
    added = [mark + x for x in ("n_tokens", "posterior", "domain", "rate")]
    if clash := {c.lower() for c in docs.columns} & set(added):
        raise ValueError(f"docs has columns {sorted(clash)} already: give another mark")
    model = fit(docs, labelled, **settings)
    if model is None:
        model = DomainModel(("all",), np.zeros(1), np.zeros(((1 << 4) + 4 * _FORMS, 1), np.float32), 1.0)
        targets = None
    if lost := sorted(d for d, x in (targets or {}).items() if x and d not in model.domains):
        raise ValueError(f"no labelled document is of the domains {lost}, which have targets")
    members = Tables(docs.sparkSession, "mixing").put(memberships(docs.select("text") if keep_text else docs, model, mark), "members")
    stored = members.select(F.col(added[0]).alias("n_tokens"), F.col(added[1]).alias("posterior"))
    share = expected(stored, np.zeros((0, len(model.domains))), pull)
    goal = np.array([(targets or {}).get(d, float(s)) for d, s in zip(model.domains, share, strict=True)])
    history = fit_rates(stored, goal, pull, relative=True)
    names = np.array(model.domains, object)

    more = (T.StructField(added[2], T.StringType()), T.StructField(added[3], T.DoubleType()))

    def rated(p: np.ndarray) -> list[pa.Array]:
        return [pa.array(names[p.argmax(axis=1)], pa.string()), pa.array(_rate(p, history, pull)[0])]

    def run(batches):
        for b in batches:
            lists = b[added[1]]
            yield pa.RecordBatch.from_arrays([*b.columns, *rated(lists.flatten().to_numpy().reshape(len(lists), -1))], [*b.schema.names, *added[2:]])

    if keep_text:  # one worker a task: scoring and rating in one function
        out = memberships(docs, model, mark, True, rated, more)
    else:
        out = members.mapInArrow(run, T.StructType([*members.schema.fields, *more]))
    out.tallyforge_totals = {d: tuple(map(float, x)) for d, *x in zip(model.domains, share, goal, expected(stored, history, pull), strict=True)}
    return out
