"""Near duplicates by SimHash and a Gray-order hierarchical index.

Fingerprints: one bit per position, set where more than half of the shingles' hashes have it. Equal fingerprints are
one entry of the index. Two entries within `max_bits` differing bits agree in full on two of `max_bits + 2` blocks of
bits (or on three of `max_bits + 3`, ...), so each entry is posted once under every choice of such blocks. Postings are
range-partitioned by choice, agreed bits and Gray rank. Up to `NODE` neighbours in this order form a tree: each node holds
the bits that all below it share and its parent's do not, and a search adds up the differences on the way down, drops a
node with too many and takes a node whole if the bits left open cannot exceed the limit. Longer runs of one key become
several trees; pairs of trees under a key are compared, in tasks of their own, where the differences of their shared
bits allow it. A tree gives only a spanning forest of its links, so a group of near copies costs links in proportion to
its size. Components of the links follow by star contraction.

Defined cases: a null or empty text, or one of blanks, has no word and fingerprint zero; a text with fewer words than a
shingle is one shingle. Rows with equal ids are told apart by their texts. A null id never names a component unless all
its ids are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from listing_analytics.llm.components import components
from listing_analytics.llm.words import free_name
from listing_analytics.staging import stage

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: Entries of one tree at most; bounds the memory of a comparison, not the size of a group.
NODE = 1024
FANOUT = 8


def fingerprint(text: str | None, words_per_shingle: int = SHINGLE) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - words_per_shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    first, last = starts[:n].tolist(), ends[min(words_per_shingle, len(words)) - 1:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(first[at:at + 65536], last[at:at + 65536])], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, words_per_shingle: int = SHINGLE) -> DataFrame:
    """`doc_id, text_hash, fingerprint (long)` for each row of `docs (doc_id, text, ...)`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([fingerprint(t.as_py(), words_per_shingle) for t in batch.column("text")], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), found], ["doc_id", "text_hash", "fingerprint"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        run, f"doc_id {kind}, text_hash long, fingerprint long"
    )


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the Gray sequence."""
    rank = codes.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank ^ (rank >> np.uint64(shift))
    return rank


class GrayTree:
    """Shared bits of codes in Gray order, level by level from the top."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.levels = codes, []
        width, open_above = FANOUT, None
        widths = [1]
        while widths[-1] < len(codes):
            widths.append(widths[-1] * width)
        for size in reversed(widths):
            at = np.arange(0, len(codes), size)
            shared = ~(np.bitwise_or.reduceat(codes, at) ^ np.bitwise_and.reduceat(codes, at))
            if open_above is None:
                own = shared
            else:
                own = shared & ~np.repeat(open_above, FANOUT)[: len(at)]
            self.levels.append((size, codes[at], own, shared))
            open_above = shared

    def search(self, queries: np.ndarray, max_bits: int) -> np.ndarray:
        """Matrix queries x codes: within `max_bits` or not."""
        n = len(self.codes)
        edges = np.zeros((len(queries), n + 1), np.int16)
        query = np.arange(len(queries))
        node, apart = np.zeros(len(queries), np.int64), np.zeros(len(queries), np.int64)
        for depth, (size, pattern, own, shared) in enumerate(self.levels):
            apart = apart + np.bitwise_count((queries[query] ^ pattern[node]) & own[node])
            whole = apart + np.bitwise_count(~shared[node]) <= max_bits
            np.add.at(edges, (query[whole], node[whole] * size), 1)
            np.add.at(edges, (query[whole], np.minimum((node[whole] + 1) * size, n)), -1)
            left = ~whole & (apart <= max_bits)
            if depth + 1 == len(self.levels) or not left.any():
                break
            below = len(self.levels[depth + 1][1])
            query = np.repeat(query[left], FANOUT)
            apart = np.repeat(apart[left], FANOUT)
            node = (node[left][:, None] * FANOUT + np.arange(FANOUT)).ravel()
            there = node < below
            query, node, apart = query[there], node[there], apart[there]
        return np.cumsum(edges[:, :n], axis=1) > 0


def spanning(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of a symmetric matrix of links, as two arrays of places."""
    new, a, b = linked.any(1), [], []
    while new.any():
        frontier = np.array([new.argmax()])
        new[frontier] = False
        while len(frontier):
            reached = np.flatnonzero(linked[frontier].any(0) & new)
            if len(reached):
                a.append(frontier[linked[np.ix_(frontier, reached)].argmax(0)])
                b.append(reached)
            new[reached] = False
            frontier = reached
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def tree_links(codes: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among codes in Gray order."""
    linked = GrayTree(codes).search(codes, max_bits)
    np.fill_diagonal(linked, False)
    a, b = spanning(linked)
    return codes[a], codes[b]


def cross_links(left: np.ndarray, right: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two trees."""
    between = GrayTree(right).search(left, max_bits)
    rows, cols = np.flatnonzero(between.any(1)), np.flatnonzero(between.any(0))
    n = len(rows)
    linked = np.zeros((n + len(cols),) * 2, bool)
    linked[:n, n:] = between[np.ix_(rows, cols)]
    linked[n:, :n] = linked[:n, n:].T
    a, b = spanning(linked)
    codes = np.concatenate((left[rows], right[cols]))
    return codes[a], codes[b]


def block_masks(max_bits: int, spare: int) -> list[int]:
    """Masks of every choice of `spare` among `max_bits + spare` blocks that divide 64 bits."""
    n = max_bits + spare
    cuts = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(cuts, cuts[1:])]
    return [sum(blocks[i] for i in chosen) for chosen in combinations(range(n), spare)]


def _links(batches: Iterator[pa.RecordBatch], max_bits: int, masks: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows `choice, bits, place, first, a, b, codes`: links, and the trees that share their key with others.

    The input is sorted by choice, agreed bits and Gray rank. A key at the edge of a partition may go on in the next
    one, so its trees are handed on as well.
    """
    size, began = 0, True
    left = (np.zeros(0, np.int32), np.zeros(0, np.uint64))

    def out(links=(), trees=()):
        none = len(links[0]) if links else 0
        choice = [None] * none + [t[0] for t in trees]
        bits = [None] * none + [t[1] for t in trees]
        place = [None] * none + [t[2] for t in trees]
        pair = [x.view(np.int64).tolist() + [None] * len(trees) for x in links] if links else [[None] * len(trees)] * 2
        codes = [None] * none + [t[3].view(np.int64) for t in trees]
        return pa.RecordBatch.from_arrays(
            [pa.array(choice, pa.int32()), pa.array(bits, pa.int64()), pa.array(place, pa.int32()),
             pa.array(pair[0], pa.int64()), pa.array(pair[1], pa.int64()), pa.array(codes, pa.list_(pa.int64()))],
            ["choice", "bits", "place", "a", "b", "codes"],
        )

    def close(choice: np.ndarray, codes: np.ndarray, first: bool, last: bool):
        """Links of all keys in the arrays; `first`, `last`: the partition begins or ends with them."""
        nonlocal size
        key = codes & masks[choice]
        starts = np.flatnonzero(np.concatenate(([True], (choice[1:] != choice[:-1]) | (key[1:] != key[:-1]))))
        stops = np.append(starts[1:], len(codes))
        group = np.repeat(np.arange(len(starts)), stops - starts)
        lengths = stops - starts
        small = lengths <= FANOUT
        a, b, trees = [], [], []
        for shift in range(1, FANOUT):
            at = np.flatnonzero((group[shift:] == group[:-shift]) & small[group[shift:]]) if shift < len(codes) else []
            if len(at):
                at = at[np.bitwise_count(codes[at] ^ codes[at + shift]) <= max_bits]
                a.append(codes[at])
                b.append(codes[at + shift])
        for i in np.flatnonzero(~small):
            for lo in range(starts[i], stops[i], NODE):
                x, y = tree_links(codes[lo:min(lo + NODE, stops[i])], max_bits)
                a.append(x)
                b.append(y)
        edge = {i for i, wanted in ((0, first), (len(starts) - 1, last)) if wanted}
        for i in sorted(edge | set(np.flatnonzero(lengths > NODE).tolist())):
            for lo in range(starts[i], stops[i], NODE):
                size += 1
                k = int(choice[lo])
                trees.append((k, int(key[lo].astype(np.int64)), size, codes[lo:min(lo + NODE, stops[i])]))
        none = np.zeros(0, np.uint64)
        return out([np.concatenate([none, *a]), np.concatenate([none, *b])], trees)

    for batch in batches:
        choice = np.concatenate((left[0], batch.column("choice").to_numpy(zero_copy_only=False)))
        codes = np.concatenate((left[1], batch.column("code").to_numpy(zero_copy_only=False).view(np.uint64)))
        if not len(codes):
            continue
        key = codes & masks[choice]
        same = (choice == choice[-1]) & (key == key[-1])
        cut = len(codes) - int(same[::-1].argmin()) if not same.all() else 0
        if cut:
            yield close(choice[:cut], codes[:cut], began, False)
            began = False
        rest = len(codes) - cut
        if rest > 8 * NODE:  # a long run of one key: its full trees go now
            full = cut + (rest - 1) // NODE * NODE
            yield close(choice[cut:full], codes[cut:full], True, True)
            cut, began = full, True
        left = (choice[cut:], codes[cut:])
    if len(left[1]):
        yield close(*left, began, True)


def spare_blocks(n: int) -> int:
    """Blocks to agree on, so that a key holds few entries: 21, 27, 32 bits and so on with four differing bits."""
    spare = 2
    while n > 64 << (64 * spare // (MAX_BITS + spare)) and spare < 8:
        spare += 1
    return spare


def links(entries: DataFrame, max_bits: int = MAX_BITS, spare: int | None = None) -> DataFrame:
    """`a, b`: links between distinct values of `entries (fingerprint)` that span the same components as all links.

    `spare`: blocks that a key agrees on; more of them mean shorter keys' lists and more postings.
    """
    spark = entries.sparkSession
    masks = block_masks(max_bits, spare or spare_blocks(entries.count()))
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    array = np.array(masks, np.uint64)
    code = F.col("fingerprint")
    rank = code
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    posted = entries.select(code.alias("code"), rank.alias("rank"), F.posexplode(F.array(*[F.lit(m) for m in signed])).alias("choice", "mask"))
    posted = posted.select("choice", F.col("code").bitwiseAND(F.col("mask")).alias("bits"), "rank", "code")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    sorted_ = posted.repartitionByRange(parts, "choice", "bits", "rank").sortWithinPartitions("choice", "bits", "rank")
    found = stage(
        sorted_.select("choice", "code").mapInArrow(
            lambda batches: _links(batches, max_bits, array),
            "choice int, bits long, place int, a long, b long, codes array<long>",
        ).withColumn("part", F.spark_partition_id()),
        "links",
    )
    # nodes of keys that have several trees; what all codes of a tree share decides whether two trees are compared
    trees = found.where("choice IS NOT NULL").select(
        "choice", "bits", F.struct("part", "place").alias("tree"), "codes",
        F.aggregate("codes", F.lit(-1).cast("long"), lambda s, c: s.bitwiseAND(c)).alias("all_set"),
        F.aggregate("codes", F.lit(0).cast("long"), lambda s, c: s.bitwiseOR(c)).alias("any_set"),
    )
    several = trees.groupBy("choice", "bits").agg(F.count("*").alias("n")).where("n > 1").select("choice", "bits")
    trees = trees.join(several, ["choice", "bits"], "left_semi")
    one, two = trees.alias("one"), trees.alias("two")
    shared = F.bitwise_not(
        F.col("one.all_set").bitwiseXOR(F.col("one.any_set")).bitwiseOR(F.col("two.all_set").bitwiseXOR(F.col("two.any_set")))
    )
    pairs = one.join(
        two,
        (F.col("one.choice") == F.col("two.choice")) & (F.col("one.bits") == F.col("two.bits")) & (F.col("one.tree") < F.col("two.tree"))
        & (F.bit_count(F.col("one.all_set").bitwiseXOR(F.col("two.all_set")).bitwiseAND(shared)) <= max_bits),
    ).select(F.col("one.codes").alias("left"), F.col("two.codes").alias("right"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right in zip(batch.column("left"), batch.column("right")):
                a, b = cross_links(
                    left.values.to_numpy().view(np.uint64), right.values.to_numpy().view(np.uint64), max_bits
                )
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    crossing = pairs.repartition(parts).mapInArrow(compare, "a long, b long")
    return found.where("a IS NOT NULL").select("a", "b").unionByName(crossing)


def near_duplicates(docs: DataFrame, words_per_shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """`doc_id, text_hash, fingerprint (long), component, component_id`: a row for each row of `docs (doc_id, text, ...)`.

    component_id: the smallest id that links of at most `max_bits` differing bits reach; component: its least fingerprint.
    """
    prints = stage(with_fingerprint(docs, words_per_shingle), "fingerprints")
    entries = stage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "entries")
    found = components(links(entries.select("fingerprint"), max_bits)).withColumnsRenamed({"node": "fingerprint"})
    rooted = entries.join(found, "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint"))
    least = rooted.groupBy("component").agg(F.min("least").alias("component_id"))
    named = rooted.select("fingerprint", "component").join(least, "component")
    return prints.join(named, "fingerprint").select("doc_id", "text_hash", "fingerprint", "component", "component_id")


def deduplicate(docs: DataFrame, words_per_shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of `docs` that stand for their component: its smallest id, of rows with that id one."""
    groups = near_duplicates(docs, words_per_shingle, max_bits)
    id_, hash_ = free_name(docs, "kept_id"), free_name(docs, "kept_hash")
    kept = (
        groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("row"))
        .select(F.col("row.doc_id").alias(id_), F.col("row.text_hash").alias(hash_))
    )
    return docs.join(
        kept, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(hash_))
    ).drop(id_, hash_).dropDuplicates(["doc_id", "text"])
