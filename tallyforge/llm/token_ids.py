"""Token ids in binary files whose document boundaries are Elias-Fano coded.

A file holds the ids of a run of documents in ascending doc_id order, two bytes each where the
vocabulary allows (four otherwise), then the boundaries: the position where each document ends. Of every
position the low bits stand in a packed array, the high ones in unary, so a document costs about
2 + log2(ids / documents) bits; a sample of every 256th one-bit, itself in 32 bits, makes select() a
short scan. The doc_ids are coded likewise. Tasks write one file each into a folder that all executors
share, under a name of their own, renamed when complete: a task that runs again writes the same file.

Rows: a null text is an empty document (the end id only); null doc_ids come first, in text order, and
repeated ones stand in text order. Other columns aren't written.
"""

from __future__ import annotations

import os
import struct
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, lean, partitions
from .pieces import PieceMemo, WordMemo

_MAGIC, _SAMPLE = b"TFEF0001", 256
_HEAD = struct.Struct("<8sqqqqqqq")


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """Bytes of the values' low ``width`` bits, one after another."""
    if not width or not len(values):
        return np.zeros(0, np.uint8)
    bits = (values[:, None].astype(np.uint64) >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")


def unpack_bits(data: np.ndarray, width: int, n: int) -> np.ndarray:
    if not width:
        return np.zeros(n, np.uint64)
    bits = np.unpackbits(data, count=n * width, bitorder="little").reshape(n, width)
    return (bits.astype(np.uint64) << np.arange(width, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


class EliasFano:
    """A non-decreasing sequence of n values from 0 to top."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, sample: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.sample = n, low_bits, low, high, sample

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n, top = len(values), int(values[-1]) if len(values) else 0
        width = max(0, (top // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        bits = np.zeros((int(ones[-1]) + 64 if n else 0) // 64 * 64, np.uint8)
        bits[ones] = 1
        return cls(n, width, pack_bits(values & np.uint64((1 << width) - 1), width), np.packbits(bits, bitorder="little").view(np.uint64), ones[::_SAMPLE].astype(np.uint32))

    def to_bytes(self) -> bytes:
        head = struct.pack("<qqqqq", self.n, self.low_bits, len(self.low), len(self.high), len(self.sample))
        return head + self.low.tobytes() + self.high.tobytes() + self.sample.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, at: int = 0) -> tuple[EliasFano, int]:
        n, width, *sizes = struct.unpack_from("<qqqqq", data, at)
        at += 40
        parts = []
        for size, kind in zip(sizes, (np.uint8, np.uint64, np.uint32), strict=True):
            parts.append(np.frombuffer(data, kind, size, at))
            at += size * np.dtype(kind).itemsize
        return cls(n, width, *parts), at

    def select(self, i: int) -> int:
        """The i-th value: from the sampled one-bit before it, over whole words."""
        place = int(self.sample[i // _SAMPLE])
        left = i % _SAMPLE
        word, shift = divmod(place, 64)
        bits = int(self.high[word]) >> shift << shift
        while (count := bits.bit_count()) <= left:
            left -= count
            word += 1
            bits = int(self.high[word])
        for _ in range(left):
            bits &= bits - 1
        one = word * 64 + (bits & -bits).bit_length() - 1
        start = i * self.low_bits
        raw = int.from_bytes(self.low[start // 8 : (start + self.low_bits + 7) // 8].tobytes(), "little")
        return (one - i) << self.low_bits | (raw >> start % 8) & ((1 << self.low_bits) - 1)

    def values(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))[: self.n]
        return ((ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits) | unpack_bits(self.low, self.low_bits, self.n)).astype(np.int64)


class Writer:
    """One file: ids are appended as they come, the boundaries follow at its end."""

    def __init__(self, files: fs.FileSystem, path: str, width: int):
        self.files, self.path, self.width = files, path, width
        self.own = f"{path}.{os.getpid()}-{TaskContext.get().taskAttemptId() if TaskContext.get() else 0}.part"
        self.out = files.open_output_stream(self.own)
        self.ends: list[np.ndarray] = [np.zeros(0, np.int64)]
        self.doc_ids: list[np.ndarray] = [np.zeros(0, np.int64)]
        self.total = self.nulls = 0

    def add(self, doc_ids: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.out.write(ids.astype(f"<u{self.width}").tobytes())
        self.ends.append(self.total + np.cumsum(sizes))
        self.nulls += doc_ids.null_count
        self.doc_ids.append(doc_ids.drop_null().to_numpy())
        self.total += int(sizes.sum())

    def close(self) -> tuple[int, int]:
        ends, names = np.concatenate(self.ends), np.concatenate(self.doc_ids)
        least = int(names[0]) if len(names) else 0
        tail = EliasFano.of(ends).to_bytes() + EliasFano.of((names.view(np.uint64) - np.uint64(least & (1 << 64) - 1))).to_bytes()
        self.out.write(tail)
        self.out.write(_HEAD.pack(_MAGIC, self.width, len(ends), self.total, self.nulls, least, len(tail), 0))
        self.out.close()
        self.files.move(self.own, self.path)
        return len(ends), self.total


class Reader:
    def __init__(self, uri: str):
        files, path = fs.FileSystem.from_uri(uri)
        self.file = files.open_input_file(path)
        size = self.file.size()
        magic, self.width, self.n, self.total, self.nulls, self.least, tail, _ = _HEAD.unpack(self.file.read_at(_HEAD.size, size - _HEAD.size))
        if magic != _MAGIC:
            raise ValueError(f"{uri} isn't a token file")
        data = self.file.read_at(tail, size - _HEAD.size - tail)
        self.ends, at = EliasFano.from_bytes(data)
        self.names, _ = EliasFano.from_bytes(data, at)

    def doc_ids(self) -> pa.Array:
        own = (self.names.values().view(np.uint64) + np.uint64(self.least & (1 << 64) - 1)).view(np.int64)
        return pa.array(np.concatenate([np.zeros(self.nulls, np.int64), own]), mask=np.arange(self.n) < self.nulls)

    def offset(self, i: int) -> int:
        """Where document i begins."""
        return self.ends.select(i - 1) if i else 0

    def ids(self, begin: int, end: int) -> np.ndarray:
        return np.frombuffer(self.file.read_at((end - begin) * self.width, begin * self.width), f"<u{self.width}")

    def document(self, i: int) -> np.ndarray:
        return self.ids(self.offset(i), self.offset(i + 1))


def _library(path: str, pattern: str) -> tuple[PieceMemo, int]:
    return kept(("ids", path, pattern), lambda: _load(path, pattern))


def _load(path: str, pattern: str) -> tuple[PieceMemo, int]:
    """The tokenizers library behind memories of pieces and words, and the bytes that an id takes.

    ``pattern`` is the file's own byte-level split; a piece with the string of an added token goes to the
    library as it is.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.no_truncation()
    own.no_padding()
    added = [t.content for t in own.get_added_tokens_decoder().values()]

    def library(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in own.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(ids), np.int32), np.fromiter(map(len, ids), np.int64, len(ids))

    words = WordMemo(library, pattern)

    def solve(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if any(a in p for a in added for p in pieces):
            return library(pieces)
        return words.values(pieces)

    return PieceMemo(solve), 2 if own.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


def write(docs: DataFrame, folder: str, tokenizer: str, pattern: str, end_id: int) -> DataFrame:
    """Writes docs(doc_id, text) as token files of ``folder``, a URI that all executors reach.

    Returns one row for each file: (part, file, documents, ids), in doc_id order of their contents.
    """
    files, path = fs.FileSystem.from_uri(folder)
    files.create_dir(path, recursive=True)

    def run(batches):
        memo, width = _library(tokenizer, pattern)
        files, path = fs.FileSystem.from_uri(folder)
        part = TaskContext.get().partitionId()
        out = Writer(files, f"{path}/ids-{part:06d}.bin", max(width, 2 if end_id < 1 << 16 else 4))
        for b in batches:
            for i, j, ids, n in memo.values(b["text"].to_pylist()):
                ended = np.full(len(ids) + j - i, end_id, np.int32)
                place = np.ones(len(ended), bool)
                place[np.cumsum(n + 1) - 1] = False
                ended[place] = ids
                out.add(b["doc_id"].slice(i, j - i), ended, n + 1)
        documents, total = out.close()
        yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([f"{folder}/ids-{part:06d}.bin"]), pa.array([documents]), pa.array([total])], ["part", "file", "documents", "ids"])

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return (
        rows.repartitionByRange(partitions(docs.sparkSession), F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
        .mapInArrow(lean(run, ("ids", tokenizer, pattern)), "part long, file string, documents long, ids long")
    )


def read_back(written: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of the files of write(), read from them.

    ``start`` counts the ids of all documents before it. The driver sees one row a file.
    """
    spark = written.sparkSession
    files = [r for r in sorted(written.collect(), key=lambda r: r["part"]) if r["documents"]]
    starts, total = [], 0
    for r in files:
        starts.append((r["file"], total))
        total += r["ids"]

    def run(batches):
        for b in batches:
            for uri, start in zip(b["file"].to_pylist(), b["start"].to_pylist(), strict=True):
                own = Reader(uri)
                names, step = own.doc_ids(), 4096
                for i in range(0, own.n, step):
                    e = np.array([own.offset(k) for k in range(i, min(i + step, own.n) + 1)], np.int64)  # by select()
                    data = own.ids(int(e[0]), int(e[-1])).astype("<u4")
                    sums = [zlib.crc32(data[s:t]) for s, t in zip(e - e[0], e[1:] - e[0])]
                    yield pa.RecordBatch.from_arrays([names.slice(i, len(sums)), pa.array(e[:-1] + start), pa.array(np.diff(e)), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    rows = spark.createDataFrame(starts, "file string, start long").repartition(max(1, min(len(starts), 10_000)), "file")
    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
