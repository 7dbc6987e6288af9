"""Log-bilinear language model, trained in numpy with noise-contrastive estimation.

The model knows the most frequent words, the end, and "another word": `CLASSES` tokens, and more as the vocabulary grows
(`PER_ROOT` times the square root of its size). The vector predicted for the next
token is the sum of the two previous tokens' vectors, each through the matrix of its distance; a token's score is its inner
product with that vector plus the log of its frequency, which stays as it is. Training tells tokens of the corpus from noise drawn by frequency. Every task trains
on its documents from the same start, and the parameters are averaged by tokens seen; the average is the start of the next of
`ROUNDS` rounds, so that what one part of the text teaches reaches the others. Partitions of few tokens are trained on in one
task (`TASK_TOKENS`), as an average of many short trainings would stay near the start. All training text takes part in each.
The tokens with those before them are counted once in groups of documents and written; each round reads these counts.
Scoring normalises: sums over all tokens come from batched matrix products, for each pair of the `TABLE` most frequent tokens
once, in blocks that tasks share, and for other pairs where they occur. Another word is spread over the vocabulary by its
counts plus one, so any text has a probability.

Counts of words come from the whole training text by aggregation. The `HEAD` most frequent words with their counts go to
every task (a bounded table); the rest of a document's words meets their counts in a join, where no word is frequent.

Defined cases: a null or empty text is the end alone. A null id is hashed like an empty text. Repeated rows are texts of
their own. Without training text every count is zero, the model knows the end and "another word" only.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from functools import cached_property
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from listing_analytics.operators.kernel import packed_sums
from listing_analytics.staging import stage

CLASSES = 512
PER_ROOT = 2.0
#: Sums over all tokens are tabulated for pairs of so many most frequent tokens.
TABLE = 4096
NORM_ROWS = 256
WIDTH = 24
NOISE, SHARED_NOISE = 10, 128
HEAD = 200_000
BATCH = 8192
#: Rows of a batch whose noise is worked on at once: as much as stays near the processor.
NOISE_ROWS = 512
#: Rows of a place that are added together with other places' rows.
FEW_ROWS = 8
RATE = 0.1
SEED = 5
ROUNDS = 3
#: Tokens that a training task sees, at least: small partitions are trained on together.
TASK_TOKENS = 4_000_000
#: Tokens handled at once, at least; documents are not divided.
TOKENS = 1 << 19
#: Groups of so many tokens whose counts are merged for training.
MERGED = 4
#: Bytes of text divided into words at once, at most.
TEXT_BYTES = 1 << 20
#: Words that are counted at once, or meet the vocabulary at once, at least.
COUNTED = 1 << 20
LOOKED_UP = 3 << 18
END, OTHER = 0, 1  # of the model's tokens


def is_held_out(doc_id: object, parts: int = 7, part: int = 2) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % parts == part


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def words_in(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """`words_of` each text, one after the other (large binary), and how many each has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    words, ends = lists.flatten(), np.cumsum(pc.list_value_length(lists).to_numpy())
    full = pc.greater(pc.binary_length(words), 0)  # whitespace at an end of a text has an empty word beyond it
    before = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False))))
    return words.filter(full).cast(pa.large_binary()), np.diff(before[ends], prepend=0)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of at most `TEXT_BYTES` of text; a longer text is a batch of its own."""
    for batch in batches:
        ends, lo = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(), dtype=np.int64), 0
        while lo < len(batch):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + TEXT_BYTES, "right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def _give_back() -> None:
    """What a task has freed goes back to the system: a Python worker that waits for its next task keeps little."""
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()


def word_counts(docs: DataFrame, held_out=is_held_out) -> DataFrame:
    """`word (binary), n` over the training documents; the end is the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size, ends = [], 0, 0

        def counted(words: pa.Array) -> pa.RecordBatch:
            values, n = words.value_counts().flatten()
            return pa.RecordBatch.from_arrays([values.cast(pa.binary()), n], ["word", "n"])

        for batch in _pieces(batches):
            learnt = [not held_out(i) for i in batch.column("doc_id").to_pylist()]
            ends += sum(learnt)
            words, _ = words_in(batch.column("text").filter(pa.array(learnt, pa.bool_())))
            found.append(words)
            size += len(words)
            if size >= COUNTED:
                yield counted(pa.chunked_array(found))
                found, size = [], 0
        if size:
            yield counted(pa.chunked_array(found))
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array([b""], pa.binary()), pa.array([ends])], ["word", "n"])
        _give_back()

    return docs.select("doc_id", "text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """The frequent words with their counts, and totals of all words."""

    def __init__(self, counts: DataFrame, head: int = HEAD, classes: int | None = None):
        total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
        self.n, self.v = total.n or 0, total.v
        classes = classes or max(CLASSES, math.ceil(PER_ROOT * math.sqrt(self.v)))
        # bins of counts: 16 for each power of two, so at most about a thousand rows
        bins = counts.groupBy(F.floor(F.log2("n") * 16).alias("bin")).agg(F.count("*").alias("v"), F.min("n").alias("n")).orderBy(F.desc("bin")).collect()
        taken, least = 0, None
        for row in bins:
            if taken + row.v > head:
                break
            taken, least = taken + row.v, row.n
        rows = []
        if least is not None:  # `head` rows at most
            found = counts.where(F.col("n") >= least).select("word", "n").toArrow()
            rows = sorted(((n, w) for w, n in zip(found.column("word").to_pylist(), found.column("n").to_pylist()) if w), key=lambda x: (-x[0], x[1]))
        self.end_count = self._count_of_end(counts)
        self.words = pa.array([w for _, w in rows], pa.large_binary())
        n_known = min(classes - 2, len(rows))
        # the last place stands for words that are not in the table
        self.counts = np.array([n for n, _ in rows] + [0], np.int64)
        self.log = np.log10(self.counts + 1.0)
        self.token = np.full(len(rows) + 1, OTHER, np.int32)
        self.token[:n_known] = np.arange(2, 2 + n_known)
        known = self.counts[:n_known]
        self.classes = 2 + n_known
        self.other_n = self.n - self.end_count - int(known.sum())
        self.other_v = self.v - n_known - (self.end_count > 0)
        frequency = np.concatenate(([self.end_count, self.other_n], known)).astype(float) + 1
        self.frequency = frequency / frequency.sum()

    @staticmethod
    def _count_of_end(counts: DataFrame) -> int:
        row = counts.where(F.octet_length("word") == 0).first()
        return row.n if row else 0

    @cached_property
    def place(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.words.to_pylist())}

    def places(self, words: pa.Array) -> np.ndarray:
        """Numbers of the words (large binary) in the table, -1 where it lacks one."""
        return pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy()


class Model:
    """Parameters: context vectors r, token vectors q, one matrix for each distance; the biases b are logs of frequencies."""

    def __init__(self, frequency: np.ndarray, width: int = WIDTH, seed: int = SEED):
        random, k = np.random.default_rng(seed), len(frequency)
        self.noise = frequency
        self.r = random.normal(0, 0.1, (k, width)).astype(np.float32)
        self.q = random.normal(0, 0.1, (k, width)).astype(np.float32)
        self.c = np.stack([np.eye(width), np.eye(width)]).astype(np.float32)
        self.b = np.log(frequency).astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.r, self.q, self.c)])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for x in (self.r, self.q, self.c):
            x[...] = flat[at:at + x.size].reshape(x.shape)
            at += x.size

    def train(self, first: np.ndarray, second: np.ndarray, token: np.ndarray, weight: np.ndarray, memory: list[np.ndarray], random) -> None:
        """One pass of Adagrad over tokens with the tokens one and two places before, each as often as its weight.

        Noise is drawn by frequency, whose log is the bias: a score less the log of the noise is the inner product less `behind`.
        """
        behind, cumulated = np.float32(math.log(NOISE)), np.cumsum(self.noise)
        # batches write into the same memory
        room = np.empty((min(BATCH, len(token)), SHARED_NOISE), np.float32)
        grads, squares, roots = ([np.empty_like(x) for x in (self.r, self.q, self.c)] for _ in range(3))
        for at in range(0, len(token), BATCH):
            part = slice(at, at + BATCH)
            one, two, w = first[part], second[part], token[part]
            share = (weight[part] / weight[part].sum()).astype(np.float32)[:, None]
            predicted = (self.r @ self.c[0]).take(one, 0)
            predicted += (self.r @ self.c[1]).take(two, 0)
            drawn = np.minimum(np.searchsorted(cumulated, random.random(SHARED_NOISE), "right"), len(self.noise) - 1)
            own, q_drawn = self.q.take(w, 0), self.q[drawn]
            right = np.einsum("ij,ij->i", predicted, own) - behind
            down = np.matmul(predicted, q_drawn.T, out=room[:len(w)])
            for lo in range(0, len(down), NOISE_ROWS):
                some = down[lo:lo + NOISE_ROWS]
                np.subtract(behind, some, out=some)
                np.exp(some, out=some)
                some += 1
                np.divide(-share[lo:lo + NOISE_ROWS] * np.float32(NOISE / SHARED_NOISE), some, out=some)
            up = share / (1 + np.exp(right))[:, None]
            own *= up
            d_predicted = down @ q_drawn
            d_predicted += own
            grads[0].fill(0)
            for i, context in enumerate((one, two)):
                total = _add_rows(context, d_predicted, len(self.noise))
                grads[0] += total @ self.c[i].T
                grads[2][i] = self.r.T @ total
            to_drawn = (predicted.T @ down).T
            predicted *= up
            grads[1] = _add_rows(w, predicted, len(self.noise))
            np.add.at(grads[1], drawn, to_drawn)
            for x, g, m, square, root in zip((self.r, self.q, self.c), grads, memory, squares, roots):
                m += np.multiply(g, g, out=square)
                np.sqrt(m, out=root)
                root += 1e-6
                g *= RATE
                g /= root
                x += g

    def norms(self, lo: int, hi: int, second: int) -> np.ndarray:
        """Natural log of the sum over all tokens after each pair of tokens `lo` to `hi` one and 0 to `second` two places before."""
        behind = np.exp((self.r[:second] @ self.c[1]) @ self.q.T)
        ahead = np.exp((self.r[lo:hi] @ self.c[0]) @ self.q.T + self.b)
        return np.log(ahead @ behind.T)

    def log_chance(self, first: np.ndarray, second: np.ndarray, token: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """Natural log of each token's probability after those one and two places before.

        `norm` has the sums for pairs of the first tokens, which are the most frequent; those for other pairs that occur
        are computed here.
        """
        k, known = len(self.b), len(norm)
        sums = np.empty(len(token))
        inside = (first < known) & (second < known)
        sums[inside] = norm.take((first.astype(np.int64) * known + second)[inside])
        outside = np.flatnonzero(~inside)
        pairs, place = np.unique(first[outside].astype(np.int64) * k + second[outside], return_inverse=True)
        ahead, behind = (self.r @ self.c[i] for i in (0, 1))
        own = np.empty(len(pairs))
        for at in range(0, len(pairs), 1024):
            one, two = np.divmod(pairs[at:at + 1024], k)
            own[at:at + 1024] = np.log(np.exp((ahead[one] + behind[two]) @ self.q.T + self.b).sum(1, dtype=np.float64))
        sums[outside] = own[place]
        found = np.empty(len(token))
        for at in range(0, len(token), 1 << 16):
            part = slice(at, at + (1 << 16))
            predicted = ahead.take(first[part], 0) + behind.take(second[part], 0)
            found[part] = np.einsum("ij,ij->i", predicted, self.q.take(token[part], 0)) + self.b[token[part]]
        return found - sums


def _add_rows(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows with the same place."""
    # short numbers are sorted by their digits, in the same order
    order = np.argsort(at.astype(np.uint16) if n <= 1 << 16 else at, kind="stable")
    sorted_ = at[order]
    starts = np.flatnonzero(np.concatenate(([True], sorted_[1:] != sorted_[:-1])))
    sizes = np.diff(starts, append=len(at))
    total = np.zeros((n, rows.shape[1]), np.float32)
    many = sizes > FEW_ROWS
    if many.any():
        ends = np.cumsum(sizes[many])
        total[sorted_[starts[many]]] = np.add.reduceat(rows.take(order[np.repeat(many, sizes)], 0), ends - sizes[many])
    # most places have few rows: the second rows of all of them, then the third ones are added, in the order of `reduceat`
    few = np.flatnonzero(~many)
    few = few[np.argsort(-sizes[few], kind="stable")]
    starts, sizes = starts[few], sizes[few]
    sums = rows.take(order[starts], 0)
    have = np.searchsorted(-sizes, -np.arange(FEW_ROWS))  # how many places have more than 0, 1, ... rows
    rest = rows.take(order[starts[:have[1]] + 1], 0)
    for i, m in enumerate(have[2:], 2):
        rest[:m] += rows.take(order[starts[:m] + i], 0)
    sums[:have[1]] += rest
    total[sorted_[starts]] = sums
    return total


class Texts(Sequence):
    """The words of documents, a list for each; `words` has all of them one after the other."""

    def __init__(self, words: pa.Array, sizes: np.ndarray):
        self.words, self.ends = words, np.cumsum(sizes)

    def __len__(self) -> int:
        return len(self.ends)

    def __getitem__(self, at):
        if isinstance(at, slice):
            return [self[i] for i in range(*at.indices(len(self)))]
        end, begin = self.ends[at], self.ends[at - 1] if at else 0
        return self.words.slice(begin, end - begin).to_pylist()


def _looked_up(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, wanted) -> Iterator[tuple]:
    """Ids, words, places of the words and numbers of words of documents with about `LOOKED_UP` words."""
    ids, words, sizes, n = [], [], [], 0
    for batch in chain(_pieces(batches), [None]):
        if ids and (batch is None or n >= LOOKED_UP):
            found, size = pa.concat_arrays(words), np.concatenate(sizes)
            words.clear()  # before the next ones are read
            yield ids, found, vocabulary.places(found), size
            ids, sizes, n, found = [], [], 0, None
        if batch is not None:
            own = batch.column("doc_id").to_pylist()
            taken = [wanted(i) for i in own]
            found, size = words_in(batch.column("text").filter(pa.array(taken, pa.bool_())))
            ids += compress(own, taken)
            words.append(found)
            sizes.append(size)
            n += len(found)


def _groups(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, wanted) -> Iterator[tuple]:
    """Documents in groups of about `TOKENS` tokens: ids, words' lists, places, and the tokens with those before.

    Two ends stand before each text, and its end behind it.
    """
    ids, words, places, sizes = [], pa.array([], pa.large_binary()), np.zeros(0, np.int32), np.zeros(0, np.int64)

    def close(lo: int, hi: int) -> tuple:
        begin, end = int(sizes[:lo].sum()), int(sizes[:hi].sum())
        own, at, lengths = words.slice(begin, end - begin), places[begin:end], sizes[lo:hi] + 1
        tokens = np.zeros(len(at) + 3 * (hi - lo), np.int32)
        tokens[np.arange(len(at)) + np.repeat(3 * np.arange(hi - lo) + 2, lengths - 1)] = vocabulary.token[at]
        keep = np.ones(len(tokens), bool)
        begins = np.concatenate(([0], np.cumsum(lengths + 2)[:-1]))
        keep[begins] = keep[begins + 1] = False
        kept = np.flatnonzero(keep)
        by_text = np.split(at, np.cumsum(lengths - 1)[:-1])
        return ids[lo:hi], Texts(own, lengths - 1), by_text, lengths, tokens[kept - 1], tokens[kept - 2], tokens[kept]

    for new_ids, new_words, new_places, new_sizes in _looked_up(batches, vocabulary, wanted):
        ids, words = ids + new_ids, pa.concat_arrays([words, new_words])
        places, sizes = np.concatenate([places, new_places]), np.concatenate([sizes, new_sizes])
        del new_words, new_places
        ends, lo = np.cumsum(sizes + 1), 0
        while (hi := int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + TOKENS)) + 1) <= len(ids):
            yield close(lo, hi)
            lo = hi
        begin = int(sizes[:lo].sum())
        ids, words, places, sizes = ids[lo:], words.slice(begin), places[begin:], sizes[lo:]
    if ids:
        yield close(0, len(ids))


def token_triples(docs: DataFrame, vocabulary, held_out=is_held_out) -> DataFrame:
    """`triples, times, seen` of groups of training documents: sorted numbers of a token and the two before, as differences."""
    words = vocabulary.value
    k = words.classes

    def counted(group: tuple) -> tuple[np.ndarray, np.ndarray]:
        one, two, token = group[-3:]
        triple, times = np.unique((one.astype(np.int64) * k + two) * k + token, return_counts=True)
        return triple, times.astype(np.uint32)

    def row(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        found, times = (np.concatenate(p) for p in zip(*parts))
        parts.clear()  # here and below, what is done with goes before more is made
        order = np.argsort(found, kind="stable")  # quick on sorted parts
        found, times = found[order], times[order]
        del order
        starts = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
        triple, times = found[starts], np.add.reduceat(times, starts)
        del found, starts
        cells = [np.diff(triple, prepend=0).astype("<i8").tobytes(), times.astype("<u4").tobytes()]
        return pa.RecordBatch.from_arrays([*(pa.array([c], pa.binary()) for c in cells), pa.array([int(times.sum())])], ["triples", "times", "seen"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for part in map(counted, _groups(batches, vocabulary.value, lambda i: not held_out(i))):
            parts.append(part)
            if len(parts) == MERGED:
                yield row(parts)
        if parts:
            yield row(parts)
        _give_back()

    # merges partitions, without a shuffle
    docs = docs.select("doc_id", "text").coalesce(max(1, words.n // TASK_TOKENS))
    return docs.mapInArrow(run, "triples binary, times binary, seen long")


def train(docs: DataFrame, vocabulary, held_out=is_held_out, rounds: int = ROUNDS) -> np.ndarray:
    """Parameters after `rounds` passes over all training documents; `vocabulary` is broadcast."""
    model = Model(vocabulary.value.frequency)
    k, size = len(vocabulary.value.frequency), 1 + len(model.flat())
    groups = stage(token_triples(docs, vocabulary, held_out), "triples")
    adders = max(1, math.isqrt(groups.rdd.getNumPartitions()))
    for _ in range(rounds):
        start = docs.sparkSession.sparkContext.broadcast(model.flat())

        def run(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            own, random, seen = Model(vocabulary.value.frequency), np.random.default_rng(SEED), 0
            own.load(start.value)
            memory = [np.full_like(x, 1e-4) for x in (own.r, own.q, own.c)]
            for batch in batches:
                for triples, times, n in zip(*(batch.column(c) for c in ("triples", "times", "seen"))):
                    triple, weight = np.cumsum(np.frombuffer(triples.as_py(), "<i8")), np.frombuffer(times.as_py(), "<u4")
                    order = random.permutation(len(triple))
                    triple, weight = triple[order], weight[order].astype(np.int64)
                    # equal triples are one, with a weight
                    own.train(triple // (k * k), triple // k % k, triple % k, weight, memory, random)
                    seen += n.as_py()
            _give_back()
            return np.append(float(seen), own.flat().astype(np.float64) * seen)

        total = packed_sums(groups, size, adders, run)
        start.destroy()
        if total[0]:
            model.load((total[1:] / total[0]).astype(np.float32))
    return model.flat()


def norm_table(spark: SparkSession, vocabulary, parameters) -> np.ndarray:
    """`Model.norms` for the `TABLE` most frequent tokens, computed in blocks of rows by as many tasks."""
    known = min(TABLE, vocabulary.value.classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(vocabulary.value.frequency)
        model.load(parameters.value)
        for batch in batches:
            for lo in batch.column("lo").to_pylist():
                block = model.norms(lo, min(lo + NORM_ROWS, known), known).astype("<f4")
                yield pa.RecordBatch.from_arrays([pa.array([lo]), pa.array([block.tobytes()], pa.binary())], ["lo", "block"])

    blocks = -(-known // NORM_ROWS)
    rows = spark.range(0, known, NORM_ROWS, blocks).withColumnRenamed("id", "lo").mapInArrow(run, "lo long, block binary")
    rows, table = stage(rows, "norms"), np.empty((known, known), np.float32)  # TABLE ** 2 numbers at most
    for row in rows.toLocalIterator():  # some blocks at a time
        block = np.frombuffer(row.block, "<f4").reshape(-1, known)
        table[row.lo:row.lo + len(block)] = block
    return table


def score(docs: DataFrame, held_out=is_held_out, rounds: int = ROUNDS) -> DataFrame:
    """`doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score` of each row of `docs (doc_id, text, ...)`.

    base_score: by counts plus one; score: the model's. Both log10. `held_out(doc_id)` says which documents not to learn from.
    """
    spark = docs.sparkSession
    counts = stage(word_counts(docs, held_out), "word_counts")
    words = Vocabulary(counts)
    vocabulary = spark.sparkContext.broadcast(words)
    parameters = spark.sparkContext.broadcast(train(docs, vocabulary, held_out, rounds))
    norm = spark.sparkContext.broadcast(norm_table(spark, vocabulary, parameters))
    kind = docs.schema["doc_id"].dataType.simpleString()
    end_log = math.log10(words.end_count + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        model = Model(known.frequency)
        model.load(parameters.value)
        place = 0

        def row_of_each(group: tuple) -> pa.RecordBatch:
            nonlocal place
            ids, texts, places, lengths, one, two, token = group
            begins = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            logs = model.log_chance(one, two, token, norm.value)
            sums = np.add.reduceat(logs, begins)
            others = np.add.reduceat((token == OTHER).astype(np.int64), begins)
            is_end = np.zeros(len(token), bool)
            is_end[begins + lengths - 1] = True
            at = np.concatenate(places)
            logs = np.full(len(token), end_log)
            logs[~is_end] = known.log[at]
            log_sums = np.add.reduceat(logs, begins)
            other_log_sums = np.add.reduceat(np.where(token == OTHER, logs, 0.0), begins)
            in_table = np.full(len(token), int(known.end_count > 0))
            in_table[~is_end] = at >= 0
            # rare words are counted by text
            rare = np.flatnonzero(at < 0)
            rare_words = texts.words.take(pa.array(rare)).dictionary_encode()
            n_rare = max(1, len(rare_words.dictionary))
            pairs, times = np.unique(np.repeat(np.arange(len(ids)), lengths - 1)[rare] * n_rare + rare_words.indices.to_numpy(), return_counts=True)
            text, word = np.divmod(pairs, n_rare)
            rare_ends = np.searchsorted(text, np.arange(len(ids) + 1))
            rare_pairs = pa.StructArray.from_arrays(
                [rare_words.dictionary.take(pa.array(word)).cast(pa.binary()), pa.array(times, pa.int32())], ["word", "n"]
            )
            batch = pa.RecordBatch.from_arrays(
                [pa.array(ids, batch_kind), pa.array(np.arange(place, place + len(ids))), pa.array([held_out(i) for i in ids]),
                 pa.array(lengths.astype(np.int64)), pa.array(np.add.reduceat(in_table, begins)), pa.array(log_sums),
                 pa.array(other_log_sums), pa.array(sums / math.log(10)), pa.array(others),
                 pa.ListArray.from_arrays(pa.array(rare_ends, pa.int32()), rare_pairs)],
                ["doc_id", "place", "held_out", "n_tokens", "n_known", "log_sum", "other_log_sum", "model_sum", "n_other", "rare"],
            )
            place += len(ids)
            return batch

        # a group's arrays go before the next one is made
        yield from map(row_of_each, _groups(batches, known, lambda i: True))
        _give_back()

    from pyspark.sql.pandas.types import to_arrow_type

    batch_kind = to_arrow_type(docs.schema["doc_id"].dataType)
    scored = stage(
        docs.select("doc_id", "text").mapInArrow(
            run, f"doc_id {kind}, place long, held_out boolean, n_tokens long, n_known long, log_sum double, "
            "other_log_sum double, model_sum double, n_other long, rare array<struct<word:binary,n:int>>",
        ).withColumn("part", F.spark_partition_id()),
        "scored",
    )
    for shared in (vocabulary, parameters, norm):  # nothing below needs them: what they made is written
        shared.destroy()
    rare = (
        scored.select("part", "place", F.explode("rare").alias("r")).select("part", "place", "r.word", F.col("r.n").alias("times"))
        .join(counts, "word")
        .groupBy("part", "place").agg(F.sum("times").alias("rare_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("rare_log"))
    )
    known, log = F.coalesce("rare_known", F.lit(0)), F.coalesce("rare_log", F.lit(0.0))
    base_norm, other_norm = math.log10(words.n + words.v + 1), math.log10(words.other_n + words.other_v + 1)
    return scored.drop("rare").join(rare, ["part", "place"], "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + known).cast("long").alias("n_known"),
        F.lit(words.n).cast("long").alias("train_tokens"),
        (F.col("log_sum") + log - F.col("n_tokens") * base_norm).alias("base_score"),
        (F.col("model_sum") + F.col("other_log_sum") + log - F.col("n_other") * other_norm).alias("score"),
    )
