"""Token ids in directly addressable codes.

An id is cut into bytes. Level 0 of a file holds the low byte of every id, level 1 the next byte of those ids that have
one, and so on; a bitmap beside each level says which of its entries go on, and a directory holds the number of set bits
before every 512th. The rank of a position in the bitmap is the position in the next level, so any id, or the ids of any
document, are read from a few bytes without decoding what stands before them.

File layout, all numbers little-endian: `DAC1`; u32 levels; u64 ids, documents; per document i64 id (0 if null) and u8 null
flag; u64 start of each document and end of the last; per level u64 entries, the bytes, the bitmap (low bit first) and the
directory of u32. A part of the id range is cut into files of about `FILE_IDS` ids; a document is never divided.

Files lie as binary rows (`part, place, before, n_ids, content`) of a table in the shared folder, so that Spark's commit
decides which task's files count when executors are lost. Documents are dealt by ranges of their id and sorted within.

Defined cases: a null or empty text has the end id alone. Null ids come first; equal ids are in the order of their texts.
An empty table has no files.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from itertools import repeat
from operator import attrgetter

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from listing_analytics.llm.chunks import MAX_CHUNK_CHARS, ChunkTable, gathered, grouped, ragged
from listing_analytics.staging import stage_path

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
FILE_IDS = 1 << 21
BLOCK = 512
#: Texts of about so many characters are encoded together: words that repeat among them are looked up once.
GROUP_CHARS = 1 << 22
#: Pieces that a worker keeps the ids of; the table is emptied beyond.
MAX_PIECES = 250_000
_MAGIC = b"DAC1"


def pack(doc_ids: list[int | None], starts: np.ndarray, ids: np.ndarray) -> bytes:
    """One file: `ids` of all documents, document i from `starts[i]` to `starts[i + 1]`."""
    levels, rest = [], ids.astype(np.uint32)
    while len(rest) or not levels:
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(more, np.arange(0, len(more), BLOCK)) if len(more) else np.zeros(0, np.int64)
        directory = np.concatenate(([0], np.cumsum(ones))).astype("<u4")
        levels.append(b"".join((np.uint64(len(rest)).tobytes(), (rest & 255).astype(np.uint8).tobytes(), bits.tobytes(), directory.tobytes())))
        rest = rest[more] >> 8
    return b"".join((
        _MAGIC, np.uint32(len(levels)).tobytes(), np.array([len(ids), len(doc_ids)], "<u8").tobytes(),
        np.array([x or 0 for x in doc_ids], "<i8").tobytes(), np.array([x is None for x in doc_ids], np.uint8).tobytes(),
        starts.astype("<u8").tobytes(), *levels,
    ))


class CodeFile:
    """Random access to a file's ids."""

    def __init__(self, content: bytes):
        if content[:4] != _MAGIC:
            raise ValueError("not a file of directly addressable codes")
        n_levels = int(np.frombuffer(content, "<u4", 1, 4)[0])
        self.n_ids, n_docs = (int(x) for x in np.frombuffer(content, "<u8", 2, 8))
        at = 24

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(content, kind, n, at)
            at += found.nbytes
            return found

        ids, null = take("<i8", n_docs), take("u1", n_docs)
        self.doc_ids = [None if no else int(x) for x, no in zip(ids, null)]
        self.starts = take("<u8", n_docs + 1).astype(np.int64)
        self.levels = []
        for _ in range(n_levels):
            n = int(take("<u8", 1)[0])
            self.levels.append((take("u1", n), take("u1", -(-n // 8)), take("<u4", -(-n // BLOCK) + 1)))

    def rank(self, level: int, position: int) -> int:
        """Entries of a level before `position` that go on in the next."""
        _, bits, directory = self.levels[level]
        block = position // BLOCK
        part = bits[block * BLOCK // 8:-(-position // 8)]
        ones = np.unpackbits(part, bitorder="little")[:position - block * BLOCK]
        return int(directory[block]) + int(ones.sum())

    def range(self, lo: int, hi: int, level: int = 0) -> np.ndarray:
        """The ids at positions lo to hi."""
        chunks, bits, _ = self.levels[level]
        found = chunks[lo:hi].astype(np.uint32)
        if lo < hi and level + 1 < len(self.levels):
            first, last = self.rank(level, lo), self.rank(level, hi)
            if last > first:
                more = np.unpackbits(bits[lo // 8:-(-hi // 8)], bitorder="little")[lo % 8:lo % 8 + hi - lo].astype(bool)
                found[more] |= self.range(first, last, level + 1) << 8
        return found

    def __getitem__(self, position: int) -> int:
        return int(self.range(position, position + 1)[0])

    def document(self, i: int) -> np.ndarray:
        return self.range(int(self.starts[i]), int(self.starts[i + 1]))


class Pieces:
    """Ids of chunks by the tokenizers library: its model for each piece of a chunk that is not known yet.

    For tokenizers of bytes that split by the public pattern; a chunk with the text of an added token, and any chunk of
    another kind of tokenizer, goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        kind = json.loads(self.tokenizer.to_str())
        split = kind["pre_tokenizer"] or {}
        self.plain = (
            kind["normalizer"] is None and kind["post_processor"] is None and kind["model"]["type"] == "BPE"
            and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        )
        added = [t["content"] for t in kind["added_tokens"]]
        self.added = regex.compile("|".join(map(regex.escape, added)) or r"(?!)").search
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        # the signs that stand for bytes: printable ones themselves, the others from 256 upwards
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        self.signs = {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.starts, self.ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def whole(self, chunks: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def pieces(self, chunks: list[str]) -> list[str]:
        """The pieces of all chunks in their order.

        A chunk that begins with a space before another sign and does not end in white space splits alike between its like,
        so these are split at once; the others by themselves.
        """
        size = np.fromiter(map(len, chunks), np.int64, len(chunks))
        bare = np.fromiter(map(len, map(str.strip, chunks)), np.int64, len(chunks))
        spaced = np.fromiter(map(str.startswith, chunks, repeat(" ")), bool, len(chunks))
        found, done = [], 0
        for i in np.flatnonzero(~spaced | (bare == 0) | (size - bare > 1)).tolist():
            found += self.split("".join(chunks[done:i]))
            found += self.split(chunks[i])
            done = i + 1
        return found + self.split("".join(chunks[done:]))

    def _learn(self, pieces: list[str]) -> None:
        model, signs, id_of, space = self.tokenizer.model.tokenize, self.signs, attrgetter("id"), chr(self.signs[32])
        lengths, ids = [], []
        for p in pieces:
            # all printable ASCII signs but the space stand for themselves
            plain = p.isascii() and p.isprintable()
            tokens = model(p.replace(" ", space) if plain else p.encode().decode("latin-1").translate(signs))
            lengths.append(len(tokens))
            ids.extend(map(id_of, tokens))
        self.known.update(zip(pieces, range(len(self.starts) - 1, len(self.starts) - 1 + len(pieces))))
        self.starts = np.concatenate((self.starts, self.starts[-1] + np.cumsum(lengths, dtype=np.int64)))
        self.ids = np.concatenate((self.ids, np.array(ids, np.uint32)))

    def __call__(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not self.plain or self.added("\0".join(chunks)):
            return ragged(self.whole(chunks))
        if len(self.starts) > MAX_PIECES or len(self.ids) > 16 * MAX_PIECES:
            self.clear()
        pieces, known = self.pieces(chunks), self.known
        new = [p for p in dict.fromkeys(pieces) if p not in known]
        self._learn(new)
        numbers = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
        for p in new:
            if len(p) > MAX_CHUNK_CHARS:
                del known[p]
        starts = self.starts[numbers]
        ids, ends = gathered(self.ids, starts, self.starts[numbers + 1] - starts)
        # a chunk ends with a piece: their places in the text tell how many pieces it has, and these its ids
        piece_stops, stops = (np.cumsum(np.fromiter(map(len, x), np.int64, len(x))) for x in (pieces, chunks))
        upto = np.append(0, ends)[np.searchsorted(piece_stops, stops, "right")]
        return np.diff(upto, prepend=0), ids


_tables: dict[str, ChunkTable] = {}


def id_table(path: str) -> ChunkTable:
    """The tokenizer of a file, one for each Python worker."""
    if path not in _tables:
        _tables[path] = ChunkTable(Pieces(path))
    return _tables[path]


def write(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID, file_ids: int = FILE_IDS) -> None:
    """Encode `docs (doc_id, text, ...)` and write the files, ids in ascending order of doc_id, below `folder`."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = id_table(path)
        doc_ids, pieces, size, place, before = [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            nonlocal doc_ids, pieces, size, place, before
            starts = np.concatenate(([0], np.cumsum([len(p) for p in pieces]))).astype(np.int64)
            row = [place, before, size, pack(doc_ids, starts, np.concatenate(pieces))]
            doc_ids, pieces, size, place, before = [], [], 0, place + 1, before + size
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], ["place", "before", "n_ids", "content"])

        end = np.array([end_id], np.uint32)
        for batch in batches:
            texts = (t.as_py() for t in batch.column("text"))
            encoded = (ids for group in grouped(texts, GROUP_CHARS) for ids in table.encode_all(group))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded):
                ids = np.concatenate((ids, end))
                doc_ids.append(doc_id)
                pieces.append(ids)
                size += len(ids)
                if size >= file_ids:
                    yield close()
        if pieces:
            yield close()
        table.clear()
        table.encode_chunks.clear()

    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
        .mapInArrow(run, "place int, before long, n_ids long, content binary")
        .withColumn("part", F.spark_partition_id())
        .write.parquet(folder)
    )


def read(spark: SparkSession, folder: str) -> DataFrame:
    """`doc_id, start, ids` of every document in the files: start counts the ids of all documents before it."""
    return _documents(spark, folder, "ids array<long>", lambda ids: pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64())), "ids")


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """`doc_id, start, n_tokens, ids_crc32` of every document in the files."""
    crc = _documents(
        spark, folder, "ids_crc32 long, n_tokens long",
        lambda ids: pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()), "ids_crc32",
    )
    return crc.select("doc_id", "start", "n_tokens", "ids_crc32")


def _documents(spark: SparkSession, folder: str, columns: str, summary, name: str) -> DataFrame:
    files = spark.read.schema("place int, before long, n_ids long, content binary, part int").parquet(folder)
    # one number for each part, that is for each task that wrote
    sizes = {r.part: r.n for r in files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    base, total = {}, 0
    for part in sorted(sizes):
        base[part], total = total, total + sizes[part]
    counted = "n_tokens" in columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, before, content in zip(*(batch.column(c) for c in ("part", "before", "content"))):
                file = CodeFile(content.as_py())
                first = base[part.as_py()] + before.as_py()
                for lo in range(0, len(file.doc_ids), 1000):
                    at = range(lo, min(lo + 1000, len(file.doc_ids)))
                    ids = [file.document(i) for i in at]
                    arrays = [pa.array([file.doc_ids[i] for i in at], pa.int64()), pa.array(file.starts[lo:lo + len(at)] + first), summary(ids)]
                    names = ["doc_id", "start", name]
                    if counted:
                        arrays.append(pa.array([len(x) for x in ids], pa.int64()))
                        names.append("n_tokens")
                    yield pa.RecordBatch.from_arrays(arrays, names)

    return files.select("part", "before", "content").mapInArrow(run, f"doc_id long, start long, {columns}")


def write_and_digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write `docs` to new files in the shared folder and read their digests back."""
    spark = docs.sparkSession
    folder = stage_path(spark, "codes")
    write(docs, folder, path)
    return read_digests(spark, folder)
