"""Repeated byte strings removed across documents, by merged Burrows-Wheeler transforms.

A byte goes if a string of `WIDTH` bytes that covers it also starts in a document with a smaller id.

*Where a repeat can be.* Each string of `WIDTH` bytes is filed under one of its `GRAM`-byte grams, the leftmost of least
hash, so equal strings are filed under equal grams. Neighbouring strings filed at one place form a segment. Grams of only
one document cannot hold a repeat; a first pass finds those of several, as 32 bits in buckets of their leading bits, and
leaves a bit table of fixed size. Segments that the table lets through by chance do no harm.

*What repeats.* Equal segments are one, with the least id that has it. A segment that is alone under its gram repeats as a
whole. The others, by buckets of their grams, have the gram that is in all their strings written as one symbol, told from
others by its bytes, and are cut into shards; each shard's suffixes are sorted and its transform taken;
the transforms are merged by iterative interleave refinement: round h takes the interleave that is in the order of the
first h - 1 symbols, deals the shards' symbols in that order into their buckets, and has the order of the first h
symbols, with the places where it is not equal to its neighbour. Common prefixes and repeated intervals come from these
places; no suffix is sorted again. Within an interval of equal `WIDTH`-byte strings the least id decides.

*Where it is removed.* Occurrences meet their segments in joins that split frequent ones, a slice of the grams at a time, and
their spans meet the texts. What is written between is deleted once the spans are.

Defined cases: a null text is empty. A null id is above all others and its rows are not above each other. Rows with
equal ids do not remove from each other. Texts shorter than `WIDTH` bytes stay whole. Strings are told apart by their
bytes; equal segments are found by their length and 123 bits, the hashes of the segment and of its gram, rows of one id by 64 bits of their text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, functions as F

from listing_analytics.llm.words import byte_groups
from listing_analytics.staging import stage_path

WIDTH = 50
GRAM = 34
#: Bits of the table of grams that several documents have: 16 MB, whatever the corpus.
TABLE_BITS = 27
BUCKET_BITS = 12
SHARDS = 2
#: Bits for the number of strings in a segment, `WIDTH - GRAM + 1` at most.
PLACES = 5
#: Bytes of segments in a group that is merged, about.
GROUP_BYTES = 1 << 18
#: Occurrences meet their segments in so many joins, one after the other: the disk that shuffles need is that of one.
SLICES = 4
#: Equal segments are counted in so many parts, one after the other, for the same reason.
COUNT_SLICES = 2
#: Bytes of text whose hashes are worked on at once: as much as stays near the processor.
TEXT_BYTES = 1 << 14
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_NO_ID = (1 << 63) - 1
_BASE = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of each gram, by doubling."""
    power, width = [data.astype(np.uint64) + np.uint64(1)], [1]
    base = [np.uint64(_BASE)]
    while width[-1] * 2 <= gram:
        h, w = power[-1], width[-1]
        power.append(h[:-w] * base[-1] + h[w:])
        base.append(base[-1] * base[-1])
        width.append(w * 2)
    n = len(data) - gram + 1
    total, at = None, 0
    for h, w, b in zip(reversed(power), reversed(width), reversed(base)):
        if gram - at >= w:
            total = h[at:at + n] if total is None else total * b + h[at:at + n]
            at += w
    total = (total ^ (total >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return total ^ (total >> np.uint64(32))


def segments(
    data: np.ndarray, lengths: np.ndarray, width: int = WIDTH, gram: int = GRAM
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last string start of each segment, the hash of its gram, and its text's number.

    `data` has texts of `lengths` one after the other; all their strings are in one segment each.
    """
    none = np.zeros(0, np.int64)
    if lengths.max(initial=0) < width:
        return none, none, np.zeros(0, np.uint64), none
    with np.errstate(over="ignore"):
        hashes = gram_hashes(data, gram)
    wanted = width - gram + 1
    least, size = hashes, 1
    while size * 2 <= wanted:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < wanted:
        least = np.minimum(least[:size - wanted], least[wanted - size:])
    # the leftmost gram of least hash is another one behind a string that begins with it, and where a lesser one comes in
    begins = np.ones(len(least), bool)
    begins[1:] = (hashes[:len(least) - 1] == least[:-1]) | (least[1:] < least[:-1])
    ends = np.cumsum(lengths)
    starts = ends - lengths
    begins[starts[starts < len(least)]] = True
    first = np.flatnonzero(begins)
    text = np.searchsorted(ends, first, "right")
    stop = np.minimum(np.append(first[1:], len(least)), (ends - width + 1)[text])
    own = first < stop  # not a string across texts
    first, text = first[own], text[own]
    # the least hashes are small numbers: mixed again, their leading bits are spread evenly
    with np.errstate(over="ignore"):
        chosen = least[first] * np.uint64(_BASE)
        chosen = (chosen ^ (chosen >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return first, stop[own] - 1, chosen, text


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8 bytes one after the other, and their lengths; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, places, content = texts.buffers()
    if not len(texts) or content is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts), np.int64)
    ends = np.frombuffer(places, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    return np.frombuffer(content, np.uint8)[ends[0]:ends[-1]], np.diff(ends)


def repeated_grams(docs: DataFrame, bucket_bits: int = BUCKET_BITS, table_bits: int = TABLE_BITS) -> np.ndarray:
    """The bit table: set for the leading bits of the hash of each gram that is in more than one row."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, rows, n = [], [], 0
            for block in byte_groups(batch, "text", TEXT_BYTES):
                _, _, grams, text = segments(*bytes_of(block.column("text")))
                own.append(grams)
                rows.append(text + n)
                n += len(block)
            if not own:
                continue
            found, row = np.concatenate(own), np.concatenate(rows)
            order = np.argsort(found)
            found, row = found[order], row[order]
            cuts = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1]))) if len(found) else []
            # once, or twice if several rows of the batch have it
            if len(cuts):
                found = np.repeat(found[cuts], 1 + (np.minimum.reduceat(row, cuts) != np.maximum.reduceat(row, cuts)))
            bucket = (found >> np.uint64(64 - bucket_bits)).astype(np.int32)
            cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else []
            short = (found >> np.uint64(32 - bucket_bits)).astype(np.uint32)
            parts = [x.tobytes() for x in np.split(short, cuts[1:])] if len(bucket) else []
            yield pa.RecordBatch.from_arrays([pa.array(bucket[cuts] if len(bucket) else [], pa.int32()), pa.array(parts, pa.binary())], ["bucket", "grams"])

    slice_bits = table_bits - bucket_bits

    def merge(table: pa.Table) -> pa.Table:
        grams = np.frombuffer(b"".join(table.column("grams").to_pylist()), np.uint32)
        found, times = np.unique(grams, return_counts=True)
        bits = np.zeros(1 << slice_bits, bool)
        bits[found[times > 1] >> np.uint32(32 - slice_bits)] = True
        packed = np.packbits(bits, bitorder="little").tobytes() if bits.any() else None
        return pa.table({"bucket": pa.array([table.column("bucket")[0].as_py()], pa.int32()), "bits": pa.array([packed], pa.binary())})

    with shuffles_deleted(docs.sparkSession):
        rows = (
            docs.select("text").mapInArrow(collect, "bucket int, grams binary")
            .groupBy("bucket").applyInArrow(merge, "bucket int, bits binary").where("bits IS NOT NULL")
        )
        return _table(rows.collect(), bucket_bits, table_bits)


def _table(rows: Iterable[Row], bucket_bits: int, table_bits: int) -> np.ndarray:
    """The bit table of its slices: one of fixed size for each bucket, 16 MB in all."""
    table = np.zeros(1 << (table_bits - 3), np.uint8)
    size = 1 << (table_bits - bucket_bits - 3)
    for row in rows:
        table[row.bucket * size:(row.bucket + 1) * size] = np.frombuffer(row.bits, np.uint8)
    return table


def gram_table(grams: DataFrame, bucket_bits: int = BUCKET_BITS, table_bits: int = TABLE_BITS) -> np.ndarray:
    """The bit table of the column `gram`."""
    slice_bits = table_bits - bucket_bits

    def fill(table: pa.Table) -> pa.Table:
        bits = np.zeros(1 << slice_bits, bool)
        bits[table.column("slot").to_numpy()] = True
        packed = np.packbits(bits, bitorder="little").tobytes()
        return pa.table({"bucket": table.column("bucket").slice(0, 1), "bits": pa.array([packed], pa.binary())})

    slot = F.shiftrightunsigned("gram", 64 - table_bits)
    slots = grams.select(
        F.shiftright(slot, slice_bits).cast("int").alias("bucket"), slot.bitwiseAND(F.lit((1 << slice_bits) - 1)).alias("slot")
    )
    with shuffles_deleted(grams.sparkSession):
        return _table(slots.groupBy("bucket").applyInArrow(fill, "bucket int, bits binary").collect(), bucket_bits, table_bits)


def in_table(bits: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Which grams the bit table has."""
    slot = grams >> np.uint64(64 - TABLE_BITS)
    return (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def candidates(docs: DataFrame, table) -> DataFrame:
    """`id, row, gram, hash, start, segment` of the segments whose grams the broadcast bit table has.

    The hash ends with the number of the segment's strings (`PLACES` bits). Of equal segments that are written together, only
    the first has its bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = table.value
        names = ["id", "row", "gram", "hash", "start", "segment"]

        def out(found: list[tuple], parts: list[bytes]) -> pa.RecordBatch:
            ids, rows, grams, starts, places = (np.concatenate(c) for c in zip(*found))
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
            hashes = (hashes << np.uint64(PLACES) | places.astype(np.uint64)).view(np.int64)
            seen: set[bytes] = set()
            first = [None if p in seen else seen.add(p) or p for p in parts]
            columns = [ids, rows, grams.view(np.int64), hashes, starts.astype(np.int32)]
            return pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), pa.array(first, pa.binary())], names)

        found, parts = [], []
        for batch in batches:
            for block in byte_groups(batch, "text", TEXT_BYTES):
                data, lengths = bytes_of(block.column("text"))
                first, last, gram, text = segments(data, lengths)
                hit = np.flatnonzero(in_table(bits, gram))
                if not len(hit):
                    continue
                first, last, text, content = first[hit], last[hit], text[hit], data.tobytes()
                parts += [content[a:b] for a, b in zip(first.tolist(), (last + WIDTH).tolist())]
                ids, rows = (block.column(c).to_numpy()[text] for c in ("id", "row"))
                found.append((ids, rows, gram[hit], first - (np.cumsum(lengths) - lengths)[text], last - first + 1))
                if len(parts) > 300_000:
                    yield out(found, parts)
                    found, parts = [], []
        if parts:
            yield out(found, parts)

    return docs.mapInArrow(run, "id long, row long, gram long, hash long, start int, segment binary")


class Shard:
    """Suffixes of strings, each string followed by a mark, in the order of their first `depth` symbols."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, depth: int):
        lengths = lengths + 1
        text = np.zeros(lengths.sum(), symbols.dtype)  # 0 is the mark
        ends = np.cumsum(lengths) - 1
        body = np.ones(len(text), bool)
        body[ends] = False
        text[body] = symbols
        rank, size, base = text.astype(np.int64), 1, int(text.max()) + 1
        while size < depth and base ** (size + 1) < 1 << 62:  # symbols that fit in a number are sorted at once
            rank = rank * base + np.roll(text, -size)
            size += 1
        self.order = np.argsort(rank, kind="stable")
        while size < depth:
            ordered = rank[self.order]
            rank[self.order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
            rank = rank * (int(rank.max()) + 1) + np.roll(rank, -size)
            self.order = np.argsort(rank, kind="stable")
            size *= 2
        self.transform = text[self.order - 1]  # the symbol before each suffix, the last one before the first
        self.string = np.repeat(np.arange(len(lengths)), lengths)[self.order]
        self.offset = self.order - (ends - lengths + 1)[self.string]


def merged(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The interleave (a shard for each place) and the interval of equal first `depth` symbols of each place.

    Round h refines the order of the first h - 1 symbols to that of the first h.
    """
    interleave = np.repeat(np.arange(len(shards), dtype=np.uint8), [len(s.order) for s in shards])
    interval = np.zeros(len(interleave), np.int32)
    symbol = np.empty(len(interleave), np.result_type(*(s.transform for s in shards)))
    for _ in range(depth):
        for i, shard in enumerate(shards):
            symbol[interleave == i] = shard.transform
        dealt = np.argsort(symbol, kind="stable")
        interleave, dealt_symbol, before = interleave[dealt], symbol[dealt], interval[dealt]
        differs = (dealt_symbol[1:] != dealt_symbol[:-1]) | (before[1:] != before[:-1])
        interval = np.concatenate(([0], np.cumsum(differs))).astype(np.int32)
    return interleave, interval


def symbols(strings: list[bytes], width: int = WIDTH, gram: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of the strings one after the other, above 0, and the strings' lengths in symbols.

    Of segments, the gram of `gram` bytes that all strings of `width` bytes in a segment hold is one symbol: such a string is
    `width - gram + 1` symbols long, and equal to another one if all these are.
    """
    data, lengths = np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings])
    if not gram:  # where a byte of 0 occurs, symbols are wider
        return (data.astype(np.uint16) + 1 if (data == 0).any() else data), lengths
    with np.errstate(over="ignore"):
        hashes = gram_hashes(data, gram)
    starts = np.cumsum(lengths) - lengths
    at = starts + hashes[starts[:, None] + np.arange(width - gram + 1)].argmin(1)  # the leftmost of least hash
    inside = at[:, None] + np.arange(gram)
    # all have one length, so that no byte of 0 at an end is lost
    distinct, number = np.unique(data[inside].view(f"S{gram}").ravel(), return_inverse=True)
    kind = np.uint16 if len(distinct) < (1 << 16) - 257 else np.uint32
    found = data.astype(kind) + 1
    found[at] = (number + 257).astype(kind)
    keep = np.ones(len(data), bool)
    keep[inside[:, 1:]] = False
    return found[keep], lengths - (gram - 1)


def least_of_places(
    strings: list[bytes], ids: np.ndarray, width: int = WIDTH, n_shards: int = SHARDS, gram: int = 0
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """String, place in it and the least id among the strings that hold the `width` bytes there, in the order of the places.

    With `gram` the strings are segments, see `symbols`.
    """
    text, lengths = symbols(strings, width, gram)
    width -= max(gram - 1, 0)
    number = np.arange(len(strings)) % n_shards
    parts = [np.flatnonzero(number == i) for i in range(min(n_shards, len(strings)))]
    of_text = np.repeat(number, lengths)
    shards = [Shard(text[of_text == i], lengths[part], width) for i, part in enumerate(parts)]
    interleave, interval = merged(shards, width)
    string, offset = np.empty(len(interleave), np.int64), np.empty(len(interleave), np.int64)
    for i, (shard, part) in enumerate(zip(shards, parts)):
        own = interleave == i
        string[own], offset[own] = part[shard.string], shard.offset
    whole = offset + width <= lengths[string]
    begins = np.flatnonzero(np.concatenate(([True], interval[1:] != interval[:-1])))
    least = np.minimum.reduceat(np.where(whole, ids[string], _NO_ID), begins)
    found = least[interval]
    string, offset, found = string[whole], offset[whole], found[whole]
    order = np.argsort(string * (int(lengths.max()) + 1) + offset)
    return string[order], offset[order], found[order]


def least_ids(strings: list[bytes], ids: np.ndarray, width: int = WIDTH, n_shards: int = SHARDS, gram: int = 0) -> list[np.ndarray]:
    """For each string the least id among the strings that hold the `width` bytes at each of its places."""
    string, _, found = least_of_places(strings, ids, width, n_shards, gram)
    return np.split(found, np.searchsorted(string, np.arange(1, len(strings))))


def runs_of(string: np.ndarray, offset: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """String, first place, place behind the last and id of each run of places of a string with one least id."""
    if not len(string):
        return string, offset.astype(np.int32), offset.astype(np.int32), found
    first = np.flatnonzero(np.concatenate(([True], (found[1:] != found[:-1]) | (string[1:] != string[:-1]))))
    last = np.append(first[1:], len(found)) - 1
    return string[first], offset[first].astype(np.int32), (offset[last] + 1).astype(np.int32), found[first]


def compact(df: DataFrame, path: str) -> DataFrame:
    """Written to the shared folder as small as may be; the shuffles behind it are deleted."""
    with shuffles_deleted(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Spark deletes a job's shuffle files as soon as its result is there; lost executors are made up for until then.

    This holds for frames that are made here, or written here, not for others that are only collected here.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def repeats(found: DataFrame, folder: str) -> DataFrame:
    """`gram, hash, since, upto, least` of the distinct segments of `candidates`: from which place on and up to which which least id holds."""
    key = ["gram", "hash"]
    of_gram, shared = Window.partitionBy("gram"), []
    for i in range(COUNT_SLICES):
        own = found.where(F.pmod("gram", F.lit(COUNT_SLICES)) == i)
        distinct = own.groupBy(*key).agg(F.min("id").alias("least"), F.max("id").alias("most"))
        # a gram of one segment in one document came through the table by chance
        counted = distinct.select(
            *key, "least", F.count("*").over(of_gram).alias("n"), F.min("least").over(of_gram).alias("a"), F.max("most").over(of_gram).alias("b")
        )
        shared.append(compact(counted.where("a < b").select(*key, "least", "n"), f"{folder}/shared/{i}"))
    shared = reduce(DataFrame.unionByName, shared)
    places = F.col("hash").bitwiseAND(F.lit((1 << PLACES) - 1)).cast("int")
    whole = shared.where("n = 1").select(*key, F.lit(0).alias("since"), places.alias("upto"), "least")
    several = shared.where("n > 1").select(*key, "least")
    groups = 1 + (several.count() * 2 * WIDTH) // GROUP_BYTES
    table = found.sparkSession.sparkContext.broadcast(gram_table(several))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = table.value
        for batch in batches:
            yield batch.filter(pa.array(in_table(bits, batch.column("gram").to_numpy().view(np.uint64))))

    # bytes are shuffled only where segments are compared; several tasks may have written those of a segment
    content = found.where("segment IS NOT NULL").select(*key, "segment").mapInArrow(keep, "gram long, hash long, segment binary")
    several = several.join(content, key).dropDuplicates(key)

    def merge(table: pa.Table) -> pa.Table:
        least = least_of_places(table.column("segment").to_pylist(), table.column("least").to_numpy(), gram=GRAM)
        string, since, upto, ids = runs_of(*least)
        own = table.select(key).take(pa.array(string))
        return own.append_column("since", pa.array(since)).append_column("upto", pa.array(upto)).append_column("least", pa.array(ids))

    kind = "gram long, hash long, since int, upto int, least long"
    compared = several.withColumn("bucket", F.pmod(F.xxhash64("gram"), F.lit(groups))).groupBy("bucket").applyInArrow(merge, kind)
    return whole.unionByName(compact(compared, f"{folder}/compared"))


def _row() -> Column:
    """Tells rows of one id apart, by 64 bits of the text."""
    return F.xxhash64("text")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """`doc_id, n_bytes, n_removed, n_spans, kept (binary)` of each row of `docs (doc_id, text, ...)`."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("id"), _row().alias("row"), "text")
    table = docs.sparkSession.sparkContext.broadcast(repeated_grams(docs))
    spark, folder = docs.sparkSession, stage_path(docs.sparkSession, "repeats")
    work, kept = f"{folder}/work", f"{folder}/spans"
    occurrences = compact(candidates(source, table), f"{work}/occurrences")
    runs = repeats(occurrences, work)
    parts = []
    for i in range(SLICES):
        own = F.pmod("gram", F.lit(SLICES)) == i
        held = runs.where(own).select("gram", "hash", "least", "since", (F.col("upto") - F.col("since") + WIDTH - 1).alias("size"))
        joined = occurrences.where(own).select("id", "row", "gram", "hash", "start").join(held.hint("shuffle_hash"), ["gram", "hash"])
        # a span in one number: its start, and its length of fewer than 256 bytes
        span = (F.col("start") + F.col("since")).cast("long") * 256 + F.col("size")
        parts.append(compact(joined.where("least < id").select("id", "row", span.alias("span")), f"{kept}-{i}"))
    delete(spark, work)
    spans = reduce(DataFrame.unionByName, parts)
    spans = spans.groupBy("id", "row").agg(F.collect_set("span").alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
        for batch in batches:
            out: list = [[] for _ in range(4)]
            text, lengths = bytes_of(batch.column("text"))
            stops = np.cumsum(lengths).tolist()
            spans = batch.column("spans")
            places, stop_places = spans.flatten().to_numpy(), np.cumsum(pc.fill_null(pc.list_value_length(spans), 0).to_numpy()).tolist()
            for lo, hi, from_, to in zip([0, *stops], stops, [0, *stop_places], stop_places):
                data, own = text[lo:hi], places[from_:to]
                edge = np.zeros(len(data) + 1, np.int32)
                np.add.at(edge, own >> 8, 1)
                np.add.at(edge, (own >> 8) + (own & 255), -1)
                gone = np.cumsum(edge[:-1]) > 0
                begins = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                for column, value in zip(out, (len(data), int(gone.sum()), begins, data[~gone].tobytes())):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.binary())], names
            )

    keyed = docs.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("id"), _row().alias("row"))
    return keyed.join(spans, ["id", "row"], "left").select("doc_id", "text", "spans").mapInArrow(
        cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary"
    )
