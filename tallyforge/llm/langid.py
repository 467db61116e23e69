"""Language identification by interpolated Kneser-Ney character models.

One model per language gives the probability of each character of a word (and of its end) from up to
``order - 1`` characters before it, inside the word. Spark counts the n-grams of a bounded labelled
sample and their continuations; the finished log-probabilities of all languages stand in one sorted
hash array per order, which each task searches. A text's language is the one of the lowest
cross-entropy per character over its whole text. Its excess over the language's typical cross-entropy, in
units of how widely texts of its length scatter, is held against the conformal limit of that language:
the quantile of labelled texts that the model wasn't fitted on. Beyond it the text is rejected. A language
with under 1 / alpha - 1 such texts has no limit, as none could be certified.

Letters are the characters of Unicode's categories L. Rows: a null text, or one without letters, has
language ``und``, score 0 and is rejected. Null and repeated doc_ids are predicted like others (a null one
is never learned from). Without labelled rows every text is ``und``. Extra columns stay; one named like an
added column (lang_pred, score, entropy, rejected) is a ValueError, which ``prefix`` avoids. Ties go to the
alphabetically first language.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import _give_back, lean
from .text import CHUNK, U, mix

UNKNOWN = "und"
START, END = "\x02", "\x03"
_LETTERS = re.compile(r"[^\W\d_]+")
#: Words and characters of words that a worker remembers.
_MEMO_WORDS, _MEMO_CHARS = 200_000, 3_000_000


@dataclass(frozen=True)
class LanguageModel:
    langs: tuple[str, ...]
    order: int
    floor: float  # log-probability of a character that no model has seen
    root: np.ndarray  # log weight of that floor, by language
    hashes: tuple[np.ndarray, ...]  # by order, sorted
    logp: tuple[np.ndarray, ...]  # by order, (n, languages), nan where a language lacks the n-gram
    back: tuple[np.ndarray, ...]  # by order, (n, languages): log weight of backing off from this context
    expect: np.ndarray  # typical cross-entropy of a language's own texts
    scatter: tuple[float, float]  # variance of the excess: first + second / characters
    limit: np.ndarray  # largest accepted excess in units of its scatter, see reject()


def _gram_hash(codes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k characters ending at each position (from position k - 1 on)."""
    n = len(codes) - k + 1
    h = np.zeros(max(n, 0), U)
    for i in range(k):
        h = mix(h * U(31) + codes[i : i + n] + U(1))
    return h


def is_training(doc_id: Column) -> Column:
    """Rows that may be learned from: crc32(doc_id as text) mod 3 is not 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1, F.lit(False))


def _words_of(text: str) -> list[str]:
    """Runs of letters, in which digits beyond decimal ones may stand (as in m²): see letters()."""
    return _LETTERS.findall(text.lower())


def letters(word: str) -> str:
    return word if word.isalpha() else "".join(c for c in word if c.isalpha())


def _count_words(batches):
    for b in batches:
        seen: Counter = Counter()
        for lang, text in zip(b["lang"].to_pylist(), b["text"].to_pylist(), strict=True):
            seen.update(zip(repeat(lang), _words_of(text)))
        odd = [k for k in seen if not k[1].isalpha()]
        for k in odd:
            n = seen.pop(k)
            if letters(k[1]):
                seen[k[0], letters(k[1])] += n
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.string()), pa.array(list(seen.values()), pa.int64())],
            ["lang", "word", "n"],
        )


def _grams(words: DataFrame, order: int) -> pa.Table:
    """(lang, gram, n): counts of the highest order, counts of distinct characters before below it."""
    padded = F.concat(F.lit(START * (order - 1)), F.col("word"), F.lit(END))
    top = (
        words.select("lang", "n", F.explode(F.transform(F.sequence(F.lit(1), F.length(padded) - (order - 1)), lambda i: padded.substr(i, F.lit(order)))).alias("gram"))
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    levels, level = [top], top
    for k in range(order - 1, 0, -1):
        level = level.select("lang", F.col("gram").substr(2, k).alias("gram")).groupBy("lang", "gram").agg(F.count("*").alias("n"))
        levels.append(level)
    out = levels[0]
    for x in levels[1:]:
        out = out.unionByName(x)
    return out.toArrow()


def _codes(strings: pa.Array, k: int) -> np.ndarray:
    """The characters of strings of k characters, a row each."""
    size = int(np.frombuffer(strings.buffers()[1], np.int32)[strings.offset + len(strings)]) if len(strings) else 0
    return np.frombuffer(strings.buffers()[2].to_pybytes()[:size].decode().encode("utf-32-le") if size else b"", np.uint32).astype(U).reshape(-1, k)


def _chained(codes: np.ndarray) -> np.ndarray:
    """_gram_hash() of each row as a whole."""
    h = np.zeros(len(codes), U)
    for i in range(codes.shape[1]):
        h = mix(h * U(31) + codes[:, i] + U(1))
    return h


def _of_language(h: np.ndarray, lang: np.ndarray) -> np.ndarray:
    return mix(h ^ (lang.astype(U) + U(1)) * U(0xD1B54A32D192ED03))


def _smoothed(grams: pa.Table, order: int) -> LanguageModel:
    """The model of interpolated probabilities p of each n-gram and the back-off weight of each context.

    Strings are hashed at once, order by order, so the driver holds numbers only: some 40 bytes an n-gram of an order.
    """
    names = grams["lang"].combine_chunks().dictionary_encode()
    names = names.chunk(0) if isinstance(names, pa.ChunkedArray) else names
    langs = tuple(sorted(names.dictionary.to_pylist()))
    lang = np.array([langs.index(x) for x in names.dictionary.to_pylist()])[names.indices.to_numpy()]
    text, n = grams["gram"].combine_chunks(), grams["n"].to_numpy()
    text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
    length = pc.utf8_length(text).to_numpy()
    alphabet = pc.count_distinct(text.filter(pa.array(length == 1))).as_py() + 1

    levels, lower, root = [], None, np.zeros(len(langs))
    for k in range(1, order + 1):
        at = np.flatnonzero(length == k)
        codes, own, count = _codes(text.take(pa.array(at)), k), lang[at], n[at].astype(float)
        ones, twos = (np.bincount(own[count == i], minlength=len(langs)).astype(float) for i in (1, 2))
        discount = np.divide(ones, ones + 2 * twos, out=np.full(len(langs), 0.5), where=ones + twos > 0).clip(0.1, 0.9)[own]
        context = _chained(codes[:, :-1])
        _, first, group = np.unique(_of_language(context, own), return_index=True, return_inverse=True)
        total = np.bincount(group, weights=count)[group]
        back = discount * np.bincount(group)[group] / total
        if k == 1:
            below = 1.0 / alphabet
            root[own[first]] = np.log(back[first])
        else:
            below = lower[1][np.searchsorted(lower[0], _of_language(_chained(codes[:, 1:]), own))]
        p = np.maximum(count - discount, 0) / total + back * below
        h = _chained(codes)
        key = _of_language(h, own)
        by = np.argsort(key)
        lower = key[by], p[by]
        levels.append((h, own, np.log(p).astype(np.float32), context[first], own[first], np.log(back[first]).astype(np.float32)))

    hashes, logp, backs = [], [], []
    for k in range(order):
        h, own, value, *_ = levels[k]
        above = levels[k + 1][3:] if k + 1 < order else (h[:0], own[:0], value[:0])
        known = np.unique(np.concatenate([h, above[0]]))
        tables = [np.full((len(known), len(langs)), np.nan, np.float32), np.zeros((len(known), len(langs)), np.float32)]
        tables[0][np.searchsorted(known, h), own] = value
        tables[1][np.searchsorted(known, above[0]), above[1]] = above[2]
        hashes.append(known)
        logp.append(tables[0])
        backs.append(tables[1])
    zeros = np.zeros(len(langs))
    return LanguageModel(langs, order, -math.log(alphabet), root, tuple(hashes), tuple(logp), tuple(backs), zeros, (1.0, 0.0), zeros + np.inf)


def score_words(model: LanguageModel, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Log-probability of each word by language, and its number of predicted characters."""
    pad = START * (model.order - 1)
    codes = np.frombuffer("".join(f"{pad}{w}{END}" for w in words).encode("utf-32-le"), np.uint32).astype(U)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    start = np.cumsum(size + model.order - 1) - size  # first predicted position of each word
    live = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
    lp = np.full((len(live), len(model.langs)), model.floor, np.float32) + model.root.astype(np.float32)
    context = None
    for k in range(1, model.order + 1):
        # the n-grams ending at each predicted position, and those ending one before it, which are contexts of the next order
        h = _gram_hash(codes, k)
        table = model.hashes[k - 1]

        def at(end: np.ndarray, h=h, table=table, k=k) -> np.ndarray:
            own = h[end - k + 1]
            i = np.minimum(np.searchsorted(table, own), len(table) - 1)
            return np.where(table[i] == own, i, -1)

        if context is not None:
            lp += np.where(context[:, None] >= 0, model.back[k - 2][context], np.float32(0))
        i = at(live)
        found = np.where(i[:, None] >= 0, model.logp[k - 1][i], np.float32(np.nan))
        lp = np.where(np.isnan(found), lp, found)
        if k < model.order:
            context = at(live - 1)
    return np.add.reduceat(lp.astype(np.float64), np.cumsum(size) - size, axis=0), size


class _Scorer:
    """Cross-entropies of texts; remembers a bounded number of words' scores."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.memo: dict[str, int] = {}
        self.chars = 0
        self.table = np.zeros((0, len(self.model.langs) + 1))

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        """(texts, languages + 1): nats per character by language, and the number of characters."""
        out = np.zeros((len(texts), len(self.model.langs) + 1))
        i = 0
        while i < len(texts):
            words, counts, size, first = [], [], 0, i
            while i < len(texts) and (not size or size + len(texts[i] or "") <= CHUNK):
                own = _words_of(texts[i] or "")
                words += own
                counts.append(len(own))
                size += len(texts[i] or "")
                i += 1
            if words:
                sums = np.zeros((len(counts), out.shape[1]))
                full = np.flatnonzero(counts)
                begin = np.cumsum([0, *counts])[:-1][full]
                sums[full] = np.add.reduceat(self.rows(words), begin, axis=0)
                out[first:i] = sums
        out[:, :-1] /= -np.maximum(out[:, -1:], 1)
        return out

    def _scored(self, words: list[str]) -> np.ndarray:
        clean = list(map(letters, words))
        some = np.fromiter(map(bool, clean), bool, len(clean))
        out = np.zeros((len(words), self.table.shape[1]))
        if some.any():
            out[some] = np.column_stack(score_words(self.model, [w for w in clean if w]))
        return out

    def rows(self, words: list[str]) -> np.ndarray:
        if len(self.memo) > _MEMO_WORDS or self.chars > _MEMO_CHARS:
            self.clear()
        new = list({w for w in words if w not in self.memo})
        if new:
            parts, part, size = [], [], 0
            for w in new:
                part.append(w)
                size += len(w) + self.model.order
                if size > CHUNK // 8:
                    parts.append(part)
                    part, size = [], 0
            rows = np.concatenate([self._scored(p) for p in (*parts, part) if p])
            self.memo.update(zip(new, range(len(self.table), len(self.table) + len(new))))
            self.chars += sum(map(len, new))
            self.table = np.concatenate([self.table, rows])
        return self.table[np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))]


def _units(model: LanguageModel, entropy: np.ndarray, lang: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """The excess of each text's cross-entropy over its language's typical one, in units of its scatter."""
    flat, by_length = model.scatter
    return (entropy - model.expect[lang]) / np.sqrt(flat + by_length / np.maximum(chars, 1))


def reject(model: LanguageModel, entropy: np.ndarray, best: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """Whether a text's cross-entropy lies beyond its language's calibrated limit."""
    return (chars == 0) | (_units(model, entropy, best, chars) > model.limit[best])


def _calibrated(model: LanguageModel, held: pd.DataFrame, alpha: float) -> LanguageModel:
    """The model with expect, scatter and limit of held(lang, entropy, chars): texts that it wasn't fitted on."""
    if not len(held):
        return model
    expect = np.array([held.entropy[held.lang == x].median() for x in model.langs])
    expect = np.where(np.isnan(expect), held.entropy.median(), expect)
    own, chars = held.lang.map({x: i for i, x in enumerate(model.langs)}).to_numpy(int), held.chars.to_numpy(float)
    square = (held.entropy.to_numpy() - expect[own]) ** 2
    # the excess' variance as flat + by_length / chars, by weighted least squares without negative parts
    x = np.column_stack([np.ones(len(held)), 1 / chars])
    w = np.minimum(chars, 1000.0)[:, None]
    flat, by_length = np.linalg.lstsq(x * w, square * w[:, 0], rcond=None)[0]
    if flat <= 0 or by_length < 0:
        flat, by_length = (0.0, float((square * chars).mean())) if flat <= 0 else (float(square.mean()), 0.0)
    model = LanguageModel(**{**model.__dict__, "expect": expect, "scatter": (max(float(flat), 1e-9), float(by_length))})
    units = _units(model, held.entropy.to_numpy(), own, chars)
    limit = np.full(len(model.langs), np.inf)
    for i in range(len(model.langs)):
        mine = np.sort(units[own == i])
        rank = math.ceil((len(mine) + 1) * (1 - alpha))
        if rank <= len(mine):
            limit[i] = mine[rank - 1]
    return LanguageModel(**{**model.__dict__, "limit": limit})


def fit(docs: DataFrame, per_language: int = 2000, calibrate: int = 1000, order: int = 5, alpha: float = 0.002) -> LanguageModel | None:
    """Models of all non-null ``lang`` values of the rows of is_training().

    The sample is bounded: about ``per_language`` whole documents of each language, chosen by a hash of
    doc_id, for the counts, and ``calibrate`` others for the limits. ``alpha`` is the share of a
    language's own texts that the conformal limit may reject.
    """
    rows = docs.where(is_training(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    roll = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("language")), F.lit(1_000_000)) / 1_000_000
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, (per_language + calibrate) / n)])[F.col("lang")]
    part = per_language / (per_language + calibrate)
    sample = rows.select("lang", "text", (roll / F.least(share, F.lit(1.0))).alias("at")).where("at < 1")
    words = sample.where(F.col("at") < part).select("lang", "text").mapInArrow(_count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    grams = _grams(words, order)
    if not len(grams):
        return None
    model = _smoothed(grams, order)
    del grams
    _give_back()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches):
        score, place = _Scorer(shared.value), {x: i for i, x in enumerate(shared.value.langs)}
        for b in batches:
            found, lang = score(b["text"].to_pylist()), b["lang"].to_pylist()
            own = [found[i, place[x]] if x in place else np.nan for i, x in enumerate(lang)]
            yield pa.RecordBatch.from_arrays([b["lang"], pa.array(own, pa.float64()), pa.array(found[:, -1])], ["lang", "entropy", "chars"])

    held = sample.where(F.col("at") >= part).select("lang", "text").mapInArrow(measure, "lang string, entropy double, chars double").where("chars > 0 and not isnan(entropy)").toPandas()
    shared.destroy()
    model = _calibrated(model, held, alpha)
    del held
    _give_back()
    return model


def predict(docs: DataFrame, model: LanguageModel | None, prefix: str = "") -> DataFrame:
    """docs with lang_pred, score, entropy (nats per character) and rejected; names take ``prefix``."""
    names = [prefix + x for x in ("lang_pred", "score", "entropy", "rejected")]
    if clash := {x.lower() for x in names} & {c.lower() for c in docs.columns}:
        raise ValueError(f"docs has columns {sorted(clash)} already: give another prefix")
    if model is None:
        return docs.select("*", F.lit(UNKNOWN).alias(names[0]), F.lit(0.0).alias(names[1]), F.lit(None).cast("double").alias(names[2]), F.lit(True).alias(names[3]))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        score, langs = _Scorer(m), np.array([*m.langs, UNKNOWN], object)
        for b in batches:
            found = score(b["text"].to_pylist())
            chars, ce = found[:, -1], found[:, :-1]
            best = ce.argmin(axis=1)
            own = ce[np.arange(len(ce)), best]
            sure = 1 / np.exp(-(ce - own[:, None]) * chars[:, None]).sum(axis=1)
            none = chars == 0
            cols = [pa.array(langs[np.where(none, len(m.langs), best)], pa.string()), pa.array(np.where(none, 0.0, sure)), pa.array(own, mask=none), pa.array(reject(m, own, best, chars))]
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], [*b.schema.names, *names])

    kinds = (T.StringType(), T.DoubleType(), T.DoubleType(), T.BooleanType())
    return docs.mapInArrow(lean(run), T.StructType([*docs.schema.fields, *[T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]]))
