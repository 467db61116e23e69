"""The stages against plain versions of what they decide, each on its own input."""

import corpus_pipeline
from tallyforge.llm import queries

from .test_jaccard import brute as classes
from .test_lines import INK
from .test_lines import brute as remaining
from .test_lines import numbered


def test_stages(spark, sf):
    from tallyforge.llm.common import Tables

    tables, docs = Tables(spark, "test"), spark.read.parquet(f"{sf}/documents.parquet")
    names, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = tables.put(stage(spark, docs, sf), name)
        assert docs.columns == names or name == "byte_bpe"
        seen[name] = (before, docs.collect())
    before, after = seen["language_id"]
    assert {r["doc_id"] for r in after} == {i for i, t in before.items() if any(c.isalpha() for c in t)}
    before, after = seen["line_dedup"]
    want = remaining(sorted(before.items()), 2, 20)
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in after} == {i: (t, len(t)) for i, t in want.items() if INK.search(t) or not INK.search(before[i])}
    before, after = seen["jaccard_join"]
    assert {r["doc_id"] for r in after} == {i for i, c in classes(sorted(before.items()), 5, 80, 100).items() if i == c}
    before, after = seen["mixing"]
    assert {r["doc_id"]: r["text"] for r in after}.items() <= before.items()
    before, after = seen["byte_bpe"]
    assert {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in after} == {(i, *encoded(t)) for i, t in before.items()}
    assert len(after) == len(before)
    # the language of every document that stays is the one predicted for it on the whole input
    found = {r["doc_id"]: r["lang_pred"] for r in queries.op1_language_id(spark, sf).collect()}
    assert all(r["lang"] == found[r["doc_id"]] for r in seen["language_id"][1])


def encoded(text):
    """Number of ids, and digests of ids and bytes, by the public library."""
    import base64
    import hashlib

    import numpy as np
    import public_tokenizers
    import tiktoken

    if not hasattr(encoded, "coder"):
        with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        encoded.coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = encoded.coder.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_repeated_and_null_ids(spark, documents):
    copy, other, last = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(7, copy), (7, copy), (None, copy), (None, copy), (3, other), (8, other), (8, "quite another text"), (None, last), (None, last)]
    got = corpus_pipeline.near_duplicates(spark, documents(rows), "").collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got) == sorted([(7, copy), (3, other), (8, "quite another text"), (0, last)])


def test_names():
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in queries.queries()}


def test_line_dedup_of_a_family_of_near_lines(spark, documents, monkeypatch):
    """The stage's tables grow with the lines, not with their near pairs; the first line stays."""
    from tallyforge.llm import lines

    made, put = [], lines.Tables.put

    def counted(self, df, name):
        out = put(self, df, name)
        made.append((out.count(), name))
        return out

    monkeypatch.setattr(lines.Tables, "put", counted)
    rows = list(enumerate(numbered(range(300))))
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, documents(rows), "").collect()}
    assert got[0] == rows[0][1] and got.items() <= dict(rows).items()
    assert max(made)[0] < 20 * len(rows), made
