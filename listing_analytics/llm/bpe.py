"""Byte-level BPE encoding and decoding with a segment tree for the merges.

A piece of text (a match of the vocabulary's pattern) starts as its bytes. The leaves of a segment tree hold the rank of
the pair that begins at each byte, every node the lower rank of its two children, so the root leads to the leftmost pair of
the lowest rank. A merge changes the pairs that begin at the merged token and at its live left neighbour and removes that
of its right one: three point updates of logarithmic cost, so a piece of n bytes costs n log n however long it is.

Defined cases: a null text is encoded like an empty one, to no ids. Repeated rows, empty tables and other columns make no
difference. Special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from listing_analytics.llm.chunks import MAX_CHUNK_CHARS, ChunkTable, grouped, ragged

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Pieces that a worker keeps the ids of; the table is emptied beyond.
MAX_PIECES = 250_000
_NONE = 1 << 60
_NO_RANK = (1 << 31) - 1
#: Pieces of up to so many bytes are merged many at a time.
WIDTHS = (8, 16, 32)


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece; lowest rank first, of equal ones the leftmost."""
    if piece in ranks:
        return [ranks[piece]]
    n, get = len(piece), ranks.get
    leaves = 1
    while leaves < n:
        leaves *= 2
    tree = [_NONE] * (2 * leaves)
    for i in range(n - 1):
        tree[leaves + i] = get(piece[i:i + 2], _NONE)
    for k in range(leaves - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    end = list(range(1, n + 1))  # of the token that begins at a live byte
    before = list(range(-1, n))  # the live byte before

    def put(at: int, rank: int) -> None:
        k = leaves + at
        tree[k] = rank
        k >>= 1
        while k:
            a, b = tree[2 * k], tree[2 * k + 1]
            low = a if a < b else b
            if tree[k] == low:
                break
            tree[k] = low
            k >>= 1

    while tree[1] != _NONE:
        k, low = 1, tree[1]
        while k < leaves:
            k *= 2
            if tree[k] != low:
                k += 1
        at = k - leaves
        right = end[at]
        stop = end[at] = end[right]
        put(right, _NONE)
        if stop < n:
            before[stop] = at
            put(at, get(piece[at:end[stop]], _NONE))
        else:
            put(at, _NONE)
        if at:
            left = before[at]
            put(left, get(piece[left:stop], _NONE))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at:end[at]]])
        at = end[at]
    return ids


class PairRanks:
    """The rank of the token that two neighbouring tokens make, for arrays of them."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k] for k in self.keys.tolist()], np.int32)
        self.of_byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(left.shape, _NO_RANK, np.int32)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NO_RANK)


def merge_many(pieces: list[bytes], width: int, pair_rank: PairRanks) -> list[list[int]]:
    """`merge` for pieces of at most `width` bytes (a power of two): a row of a matrix is a piece's segment tree."""
    n = np.array([len(p) for p in pieces])
    token = pair_rank.of_byte[np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)]
    columns = np.arange(width)
    live = columns < n[:, None]
    end = np.tile(np.arange(1, width + 1), (len(pieces), 1))
    before = np.tile(np.arange(-1, width - 1), (len(pieces), 1))
    tree = np.full((len(pieces), 2 * width), _NO_RANK, np.int32)
    inside = columns[1:] < n[:, None]
    tree[:, width:-1][inside] = pair_rank(token[:, :-1][inside], token[:, 1:][inside])
    level = width // 2
    while level:
        below = tree[:, 2 * level:4 * level]
        tree[:, level:2 * level] = np.minimum(below[:, ::2], below[:, 1::2])
        level //= 2
    row = np.arange(len(pieces))
    while len(row := row[tree[row, 1] != _NO_RANK]):
        low = tree[row, 1]
        k = np.ones(len(row), np.int64)
        for _ in range(width.bit_length() - 1):
            k *= 2
            k += tree[row, k] != low
        at = k - width
        right = end[row, at]
        stop = end[row, right]
        token[row, at], end[row, at], live[row, right] = low, stop, False
        more, some = stop < n[row], at > 0
        next_ = np.minimum(stop, width - 1)
        before[row[more], stop[more]] = at[more]
        left = np.maximum(before[row, at], 0)
        tree[row, width + right] = _NO_RANK
        tree[row, width + at] = np.where(more, pair_rank(low.astype(np.int64), token[row, next_]), _NO_RANK)
        new_left = pair_rank(token[row, left], low.astype(np.int64))
        tree[row[some], width + left[some]] = new_left[some]
        nodes = np.stack((right, at, left)) + width
        for _ in range(width.bit_length() - 1):
            nodes >>= 1
            tree[row, nodes] = np.minimum(tree[row, 2 * nodes], tree[row, 2 * nodes + 1])
    ids = token[live].tolist()
    cuts = np.cumsum(live.sum(1)).tolist()
    return [ids[a:b] for a, b in zip([0, *cuts], cuts)]


class Coder:
    """A vocabulary of ranks, with the chunks seen so far."""

    _loaded: dict[tuple[str, str], "Coder"] = {}

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.bytes_of = {i: b for b, i in self.ranks.items()}
        self.text_of = {i: str(i) for i in self.bytes_of}
        self.split = regex.compile(pattern).findall
        self.table = ChunkTable(lambda chunks: ragged(self._ids_of(chunks)))
        self.pieces: dict[str, list[int]] = {}
        self.pair_rank = PairRanks(self.ranks)

    @classmethod
    def of(cls, path: str, pattern: str) -> "Coder":
        """One for each Python worker."""
        if (path, pattern) not in cls._loaded:
            cls._loaded[path, pattern] = cls(path, pattern)
        return cls._loaded[path, pattern]

    def _ids_of(self, chunks: list[str]) -> list[list[int]]:
        known = self.pieces
        if len(known) > MAX_PIECES:
            known.clear()
        cut = [self.split(c) for c in chunks]
        fresh = list({p: None for pieces in cut for p in pieces if p not in known})
        new = dict(zip(fresh, self._merged([p.encode() for p in fresh])))
        found = []
        for pieces in cut:
            ids: list[int] = []
            for piece in pieces:
                ids += new[piece] if piece in new else known[piece]
            found.append(ids)
        known.update((p, ids) for p, ids in new.items() if len(p) <= MAX_CHUNK_CHARS)
        return found

    def _merged(self, pieces: list[bytes]) -> list[list[int]]:
        found: list = [None] * len(pieces)
        by_width: dict[int, list[int]] = {w: [] for w in WIDTHS}
        for i, piece in enumerate(pieces):
            if piece in self.ranks:
                found[i] = [self.ranks[piece]]
            elif len(piece) > WIDTHS[-1]:
                found[i] = merge(piece, self.ranks)
            else:
                by_width[next(w for w in WIDTHS if len(piece) <= w)].append(i)
        for width, places in by_width.items():
            if places:
                for i, ids in zip(places, merge_many([pieces[i] for i in places], width, self.pair_rank)):
                    found[i] = ids
        return found

    def forget(self) -> None:
        """Empty the tables of chunks and pieces: a task's memory is not the next one's."""
        self.table.clear()
        self.pieces = {}

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        for group in grouped(texts):
            yield from self.table.encode_all(group)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def joined(self, ids: list[int]) -> str:
        return ",".join(map(self.text_of.__getitem__, ids))


def encode(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """`doc_id, ids (array of int)` of `docs (doc_id, text, ...)`; `path`: a file of ranks that every executor has."""
    path = path or public_tokenizers.path(VOCABULARY)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder.of(path, pattern)
        for batch in batches:
            ids = pa.array([x.astype(np.int32) for x in coder.encode(batch.column("text").to_pylist())], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])
        coder.forget()

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """`doc_id, content (binary)` of `tokens (doc_id, ids)`; null ids decode to no bytes."""
    path = path or public_tokenizers.path(VOCABULARY)
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder.of(path, public_tokenizers.PATTERN)
        for batch in batches:
            content = [coder.decode(x.as_py() or []) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(content, pa.binary())], ["doc_id", "content"])

    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, content binary")


def round_trip(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """`doc_id, n_tokens, ids_sha256, decoded_sha256`: each text encoded and its ids decoded, in one pass."""
    path = path or public_tokenizers.path(VOCABULARY)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder.of(path, pattern)
        for batch in batches:
            n, ids_hash, decoded_hash = [], [], []
            for found in coder.encode(batch.column("text").to_pylist()):
                ids = found.tolist()
                n.append(len(ids))
                ids_hash.append(hashlib.sha256(coder.joined(ids).encode()).hexdigest())
                decoded_hash.append(hashlib.sha256(coder.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(decoded_hash, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )
        coder.forget()

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
