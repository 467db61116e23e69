"""Encoding, decoding, files and counts against the public libraries."""

import base64
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
import tokenizers

from tallyforge.llm import bpe, queries, token_counts, token_ids
from tallyforge.llm.pieces import pieces

RANKS, JSON = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")
rng = random.Random(4)
ALPHABET = "ab  \n\t're'vesré日本 \xa0　  \x1c\x85 .,!12٣\U0001f642‍"
FUZZ = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 30))) for _ in range(1500)]
FUZZ += ["", " ", "   a", "x" * 700, "ab" * 400, "a <|endoftext|> b<|endoftext|>", "<|endoftext|>", "don't we're they'll'll've", "日本" * 300, None]


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    return tokenizers.Tokenizer.from_file(JSON)


def test_pieces_put_texts_together():
    for t in FUZZ:
        if t:
            assert " ".join(pieces(t)) == t


def test_encoding_and_decoding(library):
    encoder = bpe.encoder(RANKS, P.PATTERN)
    for i, j, ids, n in encoder.texts(FUZZ):
        edge = np.concatenate([[0], np.cumsum(n)])
        assert [ids[a:b].tolist() for a, b in zip(edge, edge[1:])] == [library.encode_ordinary(t or "") for t in FUZZ[i:j]]
        data, sizes = encoder.pairs.decode(ids, n)
        assert data == "".join(t or "" for t in FUZZ[i:j]).encode() and sizes.tolist() == [len((t or "").encode()) for t in FUZZ[i:j]]


def test_round_trip_of_tables(spark, documents, odd):
    docs = documents(odd)
    got = bpe.decode(bpe.encode(docs, RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    assert sorted((r["doc_id"] or 0, bytes(r["data"]).decode()) for r in got) == sorted((i or 0, t or "") for i, t in odd)
    assert bpe.digests(docs.where("false"), RANKS, P.PATTERN).count() == 0


def test_counts_of_every_prefix(tokenizer):
    table, memo = token_counts.counter(JSON, P.PATTERN)
    size = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    for t in FUZZ[-10:-1] + FUZZ[:300]:
        assert table.prefixes(t[:60]).tolist() == [size(t[:i]) for i in range(len(t[:60]) + 1)]


@pytest.mark.parametrize("letters", ["a", "ab", "theandinger", "éüß日本", "".join(chr(0x4E00 + i) for i in range(500))])
def test_long_words(tokenizer, letters):
    table, _ = token_counts.counter(JSON, P.PATTERN)
    for n in (33, 127, 129, 4095, 4097, 9000):
        word = "".join(rng.choices(letters, k=n))
        counts, again, short = table._joint([word.encode(), word.encode(), word[:40].encode()])
        assert (counts == again).all() and (short == counts[: len(short)]).all()
        assert counts[-1] == len(tokenizer.encode(word, add_special_tokens=False).ids)
        if n < 200:
            assert (counts == table._matrix([word.encode()])[0]).all()


def test_counts_and_budgets(spark, documents, odd, tokenizer):
    rows = [*odd, *((100 + i, t) for i, t in enumerate(FUZZ))]
    size = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    want = sorted((i or 0, len((t or "").encode()), size(t or "")) for i, t in rows)
    got = token_counts.count(documents(rows), JSON, P.PATTERN, 40).collect()
    assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in got) == want
    texts = dict(rows)
    for r in got:
        t = texts[r["doc_id"]] or "" if r["doc_id"] not in (4, None) else None
        if t is None:
            continue
        assert r["over_limit"] == (r["n_tokens"] > 40)
        cut = r["fits_chars"]
        assert size(t[:cut]) <= 40
        assert all(size(t[:k]) > 40 for k in range(cut + 1, min(len(t), cut + 12) + 1))


def test_elias_fano():
    for n, top in ((0, 1), (1, 0), (1, 10**9), (1000, 5000), (3000, 10**12), (5, 2), (700, 700)):
        values = np.sort(np.array([rng.randint(0, top) for _ in range(n)], np.int64))
        own, _ = token_ids.EliasFano.from_bytes(token_ids.EliasFano.of(values).to_bytes())
        assert (own.values() == values).all() and [own.select(i) for i in range(n)] == values.tolist()
    dense = token_ids.EliasFano.of(np.arange(0, 1_000_000, 100))
    assert len(dense.to_bytes()) * 8 / 10_000 < 2 + np.log2(100) + 1


def test_files(spark, documents, odd, tokenizer, tmp_path):
    rows = [*odd, *((100 + i, t) for i, t in enumerate(FUZZ[:200]))]
    written = token_ids.write(documents(rows), f"file://{tmp_path}/ids", JSON, P.PATTERN, end_id=2).cache()
    got = token_ids.read_back(written).collect()
    want, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4"))))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    file = token_ids.Reader(next(r["file"] for r in written.collect() if r["documents"]))
    assert [len(file.document(i)) for i in range(file.n)] == np.diff([file.offset(i) for i in range(file.n + 1)]).tolist()
    empty = token_ids.write(documents(rows).where("false"), f"file://{tmp_path}/none", JSON, P.PATTERN, end_id=2).cache()
    assert token_ids.read_back(empty).count() == 0


def test_queries_on_tables(spark, sf, library, tokenizer):
    import hashlib

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op6_byte_bpe(spark, sf).collect():
        ids = np.array(library.encode_ordinary(docs[r["doc_id"]]), "<u4")
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest())
    for r in queries.op9_token_counts(spark, sf).collect():
        assert r["n_tokens"] == len(tokenizer.encode(docs[r["doc_id"]], add_special_tokens=False).ids)
