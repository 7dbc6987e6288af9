"""Benchmark decontamination: suffix arrays of document shards, searched for every suffix of every benchmark item.

A shard is the documents of one Arrow batch. Their words become numbers, zero where no benchmark item has the word; a
verbatim match of a window cannot contain such a word, so only runs of known words as long as the shortest window enter the
shard's suffix array, and none that could match is left out. The array is sorted by prefix doubling over the first words
that a window can have. Each test suffix is then binary-searched, all of them at once; the hits of successive suffixes of
an item at successive places are one longest match with its location. No shuffle: a document is judged where it is read.

The benchmark goes to the tasks in blocks of at most `BLOCK_BYTES` of text, each block over all documents. More than one
block: spans and items are united by document.

Defined cases: a null or empty document has no words, no hits and is clean. Items with a null id, a null text or no words
take no part; items that share an id are one. Repeated documents are judged each. Words of a repeated window are hit once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F

from listing_analytics.llm.words import free_name

WINDOW = 13
#: Benchmark text held by a task at once.
BLOCK_BYTES = 8 << 20
#: A document is contaminated if at least this share of its words is hit.
SHARE = 0.05
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_MATCH = "struct<item_id:string,item_word:int,doc_word:int,n_words:int>"


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words: runs of 0-9, a-z and all signs beyond ASCII."""
    return (text or "").encode().translate(_WORD_BYTES).split()


class TestWindows:
    """The windows of a block of benchmark items, as word numbers, and the items and places that have them."""

    def __init__(self, items: list[Row], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        self.item_ids = sorted({str(r.item_id) for r in items})
        number = {x: i for i, x in enumerate(self.item_ids)}
        for row in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(row.text)]
            size = min(window, len(ids))
            for at in range(len(ids) - size + 1 if ids else 0):
                windows.setdefault(tuple(ids[at:at + size]), []).append((number[str(row.item_id)], at))
        self.lengths = np.array([len(w) for w in windows], np.int64)
        self.depth = max(map(len, windows), default=0)
        self.least = min(map(len, windows), default=0)
        self.words = np.zeros((len(windows), self.depth), np.int64)
        for i, w in enumerate(windows):
            self.words[i, :len(w)] = w
        counts = [len(v) for v in windows.values()]
        self.first_place = np.concatenate(([0], np.cumsum(counts))).astype(np.int64)
        places = [p for v in windows.values() for p in v]
        self.place_item = np.array([p[0] for p in places], np.int64)
        self.place_word = np.array([p[1] for p in places], np.int64)


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Places of `words` in the order of their suffixes' first `depth` words (or more)."""
    rank, width = words.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while width < depth:
        second = np.zeros(len(rank), np.int64)
        second[:-width] = rank[width:] + 1 if width < len(rank) else 0
        both = rank * (int(rank.max()) + 2 if len(rank) else 1) + second
        order = np.argsort(both, kind="stable")
        step = np.concatenate(([0], np.diff(both[order]) != 0)).cumsum() if len(rank) else order
        rank = np.empty_like(rank)
        rank[order] = step
        width *= 2
    return order


def search(words: np.ndarray, order: np.ndarray, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window the range of `order` whose suffixes begin with it; all windows halve their ranges together."""
    depth = windows.shape[1]
    padded = np.concatenate((words, np.zeros(depth, words.dtype)))
    bounds = []
    for after in (False, True):
        lo, hi = np.zeros(len(windows), np.int64), np.full(len(windows), len(order), np.int64)
        while (open_ := lo < hi).any():
            mid = (lo + hi) // 2
            at = order[np.minimum(mid, len(order) - 1)]
            below, equal = np.zeros(len(windows), bool), open_.copy()
            for k in range(depth):
                word = padded[at + k]
                live = equal & (k < lengths)
                below |= live & (word < windows[:, k])
                equal &= (k >= lengths) | (word == windows[:, k])
            right = open_ & (below | (equal if after else False))
            lo, hi = np.where(right, mid + 1, lo), np.where(open_ & ~right, mid, hi)
        bounds.append(lo)
    return bounds[0], bounds[1]


def shard_matches(texts: list[str | None], test: TestWindows) -> tuple[np.ndarray, list[np.ndarray]]:
    """Words per document, and the longest matches as arrays: document, item, item word, document word, words."""
    n_words = np.zeros(len(texts), np.int64)
    parts, docs, froms = [], [], []
    get = test.vocabulary.get
    for i, text in enumerate(texts):
        words = words_of(text)
        n_words[i] = len(words)
        if not test.least or len(words) < test.least:
            continue
        ids = np.fromiter(map(get, words, repeat(0)), np.int32, len(words))
        change = np.flatnonzero(np.diff(np.concatenate(([0], ids > 0, [0])).astype(np.int8)))
        starts, stops = change[::2], change[1::2]
        for lo, hi in zip(starts, stops):
            if hi - lo >= test.least:
                parts += [ids[lo:hi], np.zeros(1, np.int32)]
                docs.append(i)
                froms.append(lo)
    none = np.zeros(0, np.int64)
    if not parts:
        return n_words, [none] * 5
    shard = np.concatenate(parts).astype(np.int64)
    run_start = np.concatenate(([0], np.cumsum([len(p) for p in parts])[1::2]))[:-1]
    order = suffix_array(shard, test.depth)
    lo, hi = search(shard, order, test.words, test.lengths)
    found = hi - lo
    window = np.repeat(np.arange(len(found)), found)
    at = order[np.repeat(lo, found) + np.arange(found.sum()) - np.repeat(np.cumsum(found) - found, found)]
    uses = (test.first_place[1:] - test.first_place[:-1])[window]
    place = np.repeat(test.first_place[window], uses) + np.arange(uses.sum()) - np.repeat(np.cumsum(uses) - uses, uses)
    at, window = np.repeat(at, uses), np.repeat(window, uses)
    item, item_word = test.place_item[place], test.place_word[place]
    by = np.lexsort((at, at - item_word, item))
    at, item, item_word, size = at[by], item[by], item_word[by], test.lengths[window[by]]
    if not len(at):
        return n_words, [none] * 5
    begins = np.concatenate(([True], (item[1:] != item[:-1]) | (at[1:] != at[:-1] + 1) | (item_word[1:] != item_word[:-1] + 1)))
    first = np.flatnonzero(begins)
    length = np.diff(np.append(first, len(at))) - 1 + size[first]
    run = np.searchsorted(run_start, at[first], "right") - 1
    doc = np.array(docs)[run]
    doc_word = at[first] - run_start[run] + np.array(froms)[run]
    by = np.lexsort((item_word[first], doc_word, item[first], doc))
    return n_words, [doc[by], item[first][by], item_word[first][by], doc_word[by], length[by]]


def covered(starts: np.ndarray, stops: np.ndarray) -> int:
    """Places inside any of the spans."""
    by = np.argsort(starts, kind="stable")
    starts, stops = starts[by], np.maximum.accumulate(stops[by])
    before = np.concatenate(([0], stops[:-1]))
    return int(np.maximum(stops - np.maximum(starts, before), 0).sum())


def blocks_of(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[Row]]:
    """The items, a block at a time: a stated query set."""
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("string"), "text")
    total = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = -(-total // block_bytes)
    for i in range(n):
        yield items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).collect()


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`doc_id, text_hash, n_words, n_hit, items, matches`, a row for each row of `docs (doc_id, text, ...)`.

    items: the ids, as sorted strings, of the items with a window in the document. matches: `item_id, item_word,
    doc_word, n_words` of each longest verbatim match.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_hash long, n_words long, n_hit long, items array<string>, matches array<{_MATCH}>"
    source = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))

    def one_block(items: list[Row]) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(TestWindows(items, window))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            test = shared.value
            names = pa.array(test.item_ids, pa.string())
            for batch in batches:
                n = len(batch)
                n_words, (doc, item, item_word, doc_word, length) = shard_matches(batch.column("text").to_pylist(), test)
                cut = np.searchsorted(doc, np.arange(n + 1))
                n_hit, own = np.zeros(n, np.int64), [[]] * n
                for i in np.unique(doc):
                    part = slice(cut[i], cut[i + 1])
                    n_hit[i] = covered(doc_word[part], doc_word[part] + length[part])
                    own[i] = [test.item_ids[x] for x in np.unique(item[part])]
                rows = pa.StructArray.from_arrays(
                    [names.take(pa.array(item)), *(pa.array(x, pa.int32()) for x in (item_word, doc_word, length))],
                    ["item_id", "item_word", "doc_word", "n_words"],
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("text_hash"), pa.array(n_words), pa.array(n_hit),
                     pa.array(own, pa.list_(pa.string())), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), rows)],
                    ["doc_id", "text_hash", "n_words", "n_hit", "items", "matches"],
                )

        return source.mapInArrow(run, schema)

    found = [one_block(items) for items in blocks_of(benchmark, block_bytes)] or [one_block([])]
    if len(found) == 1:
        return found[0]
    every = found[0].withColumn("copies", F.lit(1))
    for other in found[1:]:
        every = every.unionByName(other.withColumn("copies", F.lit(0)))
    united = every.groupBy("doc_id", "text_hash").agg(
        F.max("n_words").alias("n_words"), F.sum("copies").alias("copies"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("matches")))).alias("matches"),
    )
    ends = F.array_sort(F.transform("matches", lambda m: F.struct(m["doc_word"].alias("lo"), (m["doc_word"] + m["n_words"]).alias("hi"))))
    seen = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to"))
    hit = F.aggregate(ends, seen, lambda s, x: F.struct(
        (s["n"] + F.greatest(x["hi"] - F.greatest(x["lo"], s["to"]), F.lit(0))).cast("long").alias("n"),
        F.greatest(s["to"], x["hi"]).alias("to"),
    ))["n"]
    return united.select(
        "doc_id", "text_hash", "n_words", hit.alias("n_hit"),
        F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"]))).alias("items"), "matches",
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy"),
    ).drop("_copy")


def is_contaminated(share: float = SHARE):
    """At least `share` of the words are hit, and at least one."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") >= F.col("n_words") * F.lit(share)) if share != SHARE else (
        (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """The rows of `docs` that are not contaminated."""
    id_, hash_ = free_name(docs, "bad_id"), free_name(docs, "bad_hash")
    bad = (
        matches(docs, benchmark, window).where(is_contaminated(share))
        .select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_)).distinct()
    )
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(hash_)), "left_anti")
