"""Personal data: base patterns, and a semi-Markov conditional random field that adds spans.

Base spans (email, ip, card, phone) are the leftmost non-overlapping matches of a fixed pattern of each
kind that pass its test. They are found in linear time, whatever the text.

The field looks at islands: runs of tokens with a digit or an at-sign, one space apart. An island is split
into atoms (letters, digits, other characters). Its segmentations consist of single atoms outside and of
entities: a candidate runs from atom to atom, has ``REACH`` atoms at most (the bound on entities, which base
spans don't have), and a kind. Features are of
whole spans (checksum, groups of digits, parts of an address, neighbours); as a candidate needs a digit or
an at-sign, what lies outside islands can't change the best segmentation. Dynamic programming over atoms
chooses boundaries and kinds jointly. Weights maximise the conditional likelihood of islands of a bounded
sample, labelled by the base patterns, and of made-up variants of all kinds with known spans, among them
look-alikes that are none. Spans of the field stand beside the base ones where they overlap none.

Rows: a null text counts as empty. Nothing depends on doc_id; null and repeated ones are kept as they are.
Places count code points, their end is exclusive. Extra columns aren't returned.
"""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean

KINDS = ("email", "ip", "card", "phone")
REACH = 24
_TRIGGER = re.compile(r"[0-9@]")
_SPACE = re.compile(r"[ \t\n\r\x0b\x0c]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ATOM = re.compile(r"[A-Za-z]+|[0-9]+|.", re.S)

Span = tuple[int, int, int]  # start, end, kind


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Base spans by start, then kind."""
    out: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end(), 0))
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", done)
    if _TRIGGER.search(text):
        for m in _CHAIN.finditer(text):
            parts = m.group().split(".")
            edge = m.start()
            for k in range(0, len(parts) - 3, 4):
                four = parts[k : k + 4]
                size = sum(map(len, four)) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p[-6:]) <= 255 for p in four):
                    out.append((edge, edge + size, 1))
                edge += size + 1
        for m in _CARD.finditer(text):
            if 12 <= len(d := only_digits(m.group())) <= 19 and luhn(d):
                out.append((m.start(), m.end(), 2))
        for m in _PHONE.finditer(text):
            if 9 <= len(only_digits(m.group())) <= 15:
                out.append((m.start(), m.end(), 3))
    return sorted(out, key=lambda x: (x[0], x[2]))


def islands(text: str) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    m, edge = _TRIGGER.search(text), 0
    while m:
        start = 1 + max(edge - 1, *(text.rfind(c, edge, m.start()) for c in " \t\n\r\x0b\x0c"))
        space = _SPACE.search(text, m.start())
        end = space.start() if space else len(text)
        if out and out[-1][1] + 1 == start and text[start - 1] == " ":
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
        edge = end
        m = _TRIGGER.search(text, end)
    return out


# features of a span, by kind; the first of each is always on
_NAMES = {
    0: ("any", "one_at", "dotted_domain", "letter_end", "odd_part", "left_open", "right_open"),
    1: ("any", "octets", "too_large", "not_four", "left_open", "right_open", "padded"),
    2: ("any", "checksum", "no_checksum", "usual_size", "first_3_to_6", "even_groups", "odd_separator", "left_open", "right_open"),
    3: ("any", "plus", "area_in_brackets", "ends_3_4", "ten_to_fifteen", "seven_to_nine", "too_few_or_many", "one_group", "open_bracket", "left_open", "right_open", "card_like", "octets"),
}
_OFFSET = {k: sum(len(_NAMES[j]) for j in range(k)) for k in range(4)}
SIZE = sum(map(len, _NAMES.values()))
_EMAIL_END = re.compile(r"[A-Za-z]{2,}\Z")


def span_features(s: str, left: str, right: str) -> list[tuple[int, list[int]]]:
    """(kind, features on) of the kinds that a span may have, with the character before it and two after it."""
    out = []
    goes_on = right[:1] == "." and right[1:].isalnum()
    right = right[:1]

    def put(kind: int, *on: bool) -> None:
        out.append((kind, [_OFFSET[kind] + i for i, x in enumerate((True, *on)) if x]))

    if "@" in s:
        if s[0].isalnum() and s[-1].isalnum():
            local, _, domain = s.partition("@")
            labels = domain.split(".")
            odd = not local or any(c not in _LOCAL for c in local) or not all(labels) or any(not (c.isalnum() and c.isascii() or c in ".-") for c in domain)
            put(0, s.count("@") == 1, len(labels) > 1, bool(_EMAIL_END.search(domain)), odd, left.isalnum() or left in ("-", ".", "_", "@") and left != "", right.isalnum() or goes_on or right in ("-", "@") and right != "")
        return out
    if not all("0" <= c <= "9" or c in " +().-/" for c in s) or not ("0" <= s[-1] <= "9"):
        return out
    digits = only_digits(s)
    open_left, open_right = left.isalnum() or left == "_", right.isalnum() or right == "_"
    parts = s.split(".")
    four = len(parts) == 4 and all(p.isdigit() and p.isascii() for p in parts)
    octets = four and all(len(p) < 4 and int(p) <= 255 for p in parts)
    if s[0].isdigit():
        if four or len(parts) > 2 and all(p.isdigit() for p in parts):
            put(1, octets, four and not octets, not four, open_left or left == ".", open_right or goes_on, any(len(p) > 1 and p[0] == "0" for p in parts))
        if 12 <= len(digits) <= 19:
            ok = luhn(digits)
            groups = re.split(r"[^0-9]", s)
            put(2, ok, not ok, len(digits) in (15, 16), digits[0] in "3456", all(len(g) == 4 for g in groups), any(c in "+()/" for c in s) or any(not g for g in groups), open_left or left in ("-", "+", "."), open_right or right == "-")
    if 7 <= len(digits) <= 17 and (s[0].isdigit() or s[0] in "+("):
        groups = [g for g in re.split(r"[^0-9]+", s) if g]
        n = len(digits)
        brackets = s.count("(") == s.count(")") == 1 and s.find("(") < s.find(")")
        put(3, s[0] == "+", brackets, len(groups) > 1 and (len(groups[-2]), len(groups[-1])) == (3, 4), 10 <= n <= 15, n < 10, n > 15, len(groups) == 1, "(" in s or ")" in s and not brackets, open_left or left in ("+", "-", ".", "(", "/"), open_right or right == "-", n >= 12 and luhn(digits), octets)
    return out


def candidates(island: str) -> tuple[int, list[list[tuple[int, int, list[int]]]], list[int]]:
    """Number of atoms; for each end the candidates (first atom, kind, features); places of the atoms."""
    places = [m.start() for m in _ATOM.finditer(island)] + [len(island)]
    n = len(places) - 1
    ends: list[list[tuple[int, int, list[int]]]] = [[] for _ in range(n + 1)]
    for i in range(n):
        first = island[places[i]]
        if first not in "+(" and not first.isalnum():
            continue
        for j in range(i + 1, min(n, i + REACH) + 1):
            s = island[places[i] : places[j]]
            if not s[-1].isalnum() or "@" not in s and len(s) < 7:
                continue
            if first.isalpha() and "@" not in island[places[i] : places[min(n, i + REACH)]]:
                break
            for kind, on in span_features(s, island[places[i] - 1] if i else "", island[places[j] : places[j] + 2]):
                ends[j].append((i, kind, on))
    return n, ends, places


def decode(island: str, weights: np.ndarray) -> list[Span]:
    """The best segmentation's entities: the sum of their weights, nothing for an atom outside."""
    n, ends, places = candidates(island)
    if not any(ends):
        return []
    best: list[float] = [0.0] * (n + 1)
    back: list[tuple[int, int] | None] = [None] * (n + 1)
    for j in range(1, n + 1):
        best[j] = best[j - 1]
        for i, kind, on in ends[j]:
            value = best[i] + sum(weights[x] for x in on)
            if value > best[j]:
                best[j], back[j] = value, (i, kind)
    out, j = [], n
    while j > 0:
        if back[j]:
            i, kind = back[j]
            out.append((places[i], places[j], kind))
            j = i
        else:
            j -= 1
    return out[::-1]


def _invented(rng: random.Random) -> tuple[str, list[Span]]:
    """An island with an entity, two, or a look-alike, and its spans."""
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9)))

    def card(good: bool) -> str:
        while True:
            d = rng.choice("3456") + number(rng.choice([14, 15, 15, 15]))
            if luhn(d) == good:
                sep = rng.choice(["", "", " ", "-", "."])
                return sep.join(d[i : i + 4] for i in range(0, len(d), 4)) if sep else d

    def entity() -> tuple[str, int]:
        kind = rng.randrange(4)
        if kind == 0:
            return f"{word()}{rng.choice(['', '.', '_', '+'])}{rng.choice([word(), number(2)])}@{word()}{rng.choice(['', number(1)])}.{rng.choice(['com', 'org', 'example.com', 'co.uk', 'net'])}", 0
        if kind == 1:
            return ".".join(str(rng.randint(0, 255)) for _ in range(4)), 1
        if kind == 2:
            return card(True), 2
        area, rest = number(3), f"{number(3)}-{number(4)}"
        return rng.choice([f"+1 ({area}) {rest}", f"({area}) {rest}", f"{area}-{rest}", f"+{rng.randint(1, 99)} {area} {number(7)}", f"{area}.{rest.replace('-', '.')}"]), 3

    def decoy() -> str:
        return rng.choice([
            card(False), number(rng.randint(1, 6)), f"{number(1)}.{number(1)}", f"{number(4)}-{number(2)}-{number(2)}", f"{number(2)}:{number(2)}:{number(2)}",
            "".join(rng.choice("0123456789abcdef") for _ in range(40)), f"@{word()}", ".".join([str(rng.randint(256, 999)), *(str(rng.randint(0, 255)) for _ in range(3))]),
            f"{number(1)}.{number(1)}.{number(2)}", number(rng.randint(8, 11)), number(20), f"{number(5)}-{number(5)}-{number(6)}", f"{word()}{number(3)}@",
        ])

    text, spans = "", []
    for i in range(rng.choice([1, 1, 1, 2])):
        text += " " if i else ""
        text += rng.choice(["", "", "", '"', "(", "[", word() + ":"])
        if rng.random() < 0.6:
            s, kind = entity()
            spans.append((len(text), len(text) + len(s), kind))
            text += s
        else:
            text += decoy()
        text += rng.choice(["", "", ".", ",", ")", '"', "!!", "%%%"])
    return text, spans


def train(examples: list[tuple[str, list[Span]]], rounds: int = 60, ridge: float = 0.5) -> np.ndarray:
    """Weights of the greatest penalised conditional likelihood, by accelerated gradient ascent."""
    sets = []
    for text, spans in examples:
        n, ends, places = candidates(text)
        at = {p: i for i, p in enumerate(places)}
        gold = {(at.get(s), at.get(e), k) for s, e, k in spans}
        known = {(i, j, k) for j in range(n + 1) for i, k, _ in ends[j]}
        if any(ends) and gold <= known:
            sets.append((n, ends, gold))
    w = v = np.zeros(SIZE)
    step = 0.5
    for r in range(rounds):
        grad = -ridge * v / max(1, len(sets))
        for n, ends, gold in sets:
            score = [[sum(v[x] for x in on) for _, _, on in e] for e in ends]
            fore = np.zeros(n + 1)
            for j in range(1, n + 1):
                fore[j] = np.logaddexp.reduce([fore[j - 1], *(fore[i] + s for (i, _, _), s in zip(ends[j], score[j]))])
            rear = np.full(n + 1, -np.inf)
            rear[n] = 0.0
            for j in range(n, 0, -1):
                rear[j - 1] = np.logaddexp(rear[j - 1], rear[j])
                for (i, kind, on), s in zip(ends[j], score[j]):
                    rear[i] = np.logaddexp(rear[i], rear[j] + s)
            for j in range(1, n + 1):
                for (i, kind, on), s in zip(ends[j], score[j]):
                    grad[on] += (((i, j, kind) in gold) - np.exp(fore[i] + s + rear[j] - fore[n])) / len(sets)
        new = v + step * grad
        v, w = new + r / (r + 3) * (new - w), new
    return w


def fit(docs: DataFrame, islands_sampled: int = 600, invented: int = 900, seed: int = 7, longest: int = 200) -> np.ndarray:
    """Weights, of ``invented`` examples and at most ``islands_sampled`` different islands of docs.

    The islands are those of the least hashes among those of up to ``longest`` characters, which bounds the
    driver's work; they don't depend on partitions.
    """

    def sampled(batches):
        for b in batches:
            found = [text[s:e] for text in b["text"].to_pylist() for s, e in islands(text)]
            yield pa.RecordBatch.from_arrays([pa.array([f for f in found if len(f) <= longest], pa.string())], ["island"])

    rows = docs.where("text is not null").select("text").mapInArrow(lean(sampled), "island string")
    found = rows.groupBy("island").agg(F.count("*").alias("n")).orderBy(F.xxhash64("island"), "island").limit(islands_sampled).collect()
    rng = random.Random(seed)
    examples = [_invented(rng) for _ in range(invented)]
    for r in found:
        spans = base_spans(r["island"])
        if all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False)):
            examples.append((r["island"], spans))
    return train(examples)


def all_spans(text: str, weights: np.ndarray, memo: dict[str, list[Span]]) -> tuple[list[Span], list[Span]]:
    """Base spans, and these with the field's that overlap none of them."""
    base = base_spans(text)
    out = list(base)
    for start, end in islands(text):
        own = text[start:end]
        found = memo.get(own)
        if found is None:
            found = decode(own, weights)
            if len(own) <= 100 and len(memo) < 50_000:
                memo[own] = found
        out += [(start + s, start + e, k) for s, e, k in found if not any(s + start < y and x < e + start for x, y, _ in base)]
    return base, sorted(out, key=lambda x: (x[0], x[2]))


def find(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """(doc_id, base, spans) of every row of docs(doc_id, text): arrays of struct(kind, start, end)."""
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        memo: dict[str, list[Span]] = {}
        for b in batches:
            both = [all_spans(t, weights, memo) if t else ([], []) for t in b["text"].to_pylist()]
            cols = [pa.array([[{"kind": KINDS[k], "start": s, "end": e} for s, e, k in x[i]] for x in both], pa.list_(kind)) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([b["doc_id"], *cols], ["doc_id", "base", "spans"])

    shape = "array<struct<kind:string,start:long,end:long>>"
    return docs.select("doc_id", "text").mapInArrow(lean(run), f"doc_id long, base {shape}, spans {shape}")
