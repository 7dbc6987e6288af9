"""Token counts of whole texts for a piece BPE model, by rank-synchronous merging of ragged arrays.

The model puts a sign `▁` before a text and in place of each blank, and merges the pair whose joined piece scores best, of
equal ones the leftmost, until no pair is a piece. No piece holds `▁` behind another sign, so a text falls into pre-tokens: a
`▁` and the signs up to the next one. The different new pre-tokens of a batch lie one after the other in one array,
cut further between signs that no piece has side by side. Each round finds every sequence's lowest rank by a segmented
minimum and joins all its pairs of that rank that do not overlap, from the left. Where a joined piece would form a pair of
the same or a lower rank with its neighbour, which the model would join first, the pairs to the right of it wait for
a later round; so the result is the model's whatever its ranks are. The surviving signs are counted: one token each, a sign
that the model lacks one for each byte.

Pieces of several `▁` score lower than all others and alike, so they join last and from the left, which fills a piece of
the greatest length before the next: runs of left-over `▁` are counted by division. A model without these properties is refused when it is
loaded, and so is one that the library does not count alike on a set of probes.

Workers keep the counts of up to `MAX_KNOWN` short pre-tokens, which changes no result. A batch of texts is cut into groups
of about `GROUP_BYTES`, so memory follows the longest text and not the batch.

Defined cases: a null or empty text has no bytes and no tokens. Strings that look like control pieces are ordinary text.
Ids may be null or repeated: one row comes back for each given row, other columns make no difference.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from listing_analytics.llm.words import byte_groups

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
MAX_KNOWN = 400_000
MAX_KNOWN_CHARS = 64
GROUP_BYTES = 4 << 20
BLANK = "▁"
_NONE = np.int32((1 << 31) - 1)
_SLOTS = 1 << 20
_PROBES = (
    "", " ", "a", " a  b ", "the cat's 12,345 " * 3, "\t\n x\r\n\r", " " * 50 + "q" + " " * 33, "ξένος żółw 日本語 🙂🙂 ௵",
    "<s> </s><unk><0x41> ▁▁x", "aaaaaaaaaaaaaaaaaaaaaaa thththth ReReReturnreturn ======----", "\x00\x01 é ﬁ",
)


class PieceModel:
    """Ranks and pairs of a model's pieces, and counts of texts."""

    def __init__(self, path: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = library.get_piece_size()
        ordinary = [i for i in range(n) if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i))]
        ids = {library.id_to_piece(i): i for i in ordinary}
        scores = {p: library.get_score(i) for p, i in ids.items()}
        self.blank_tokens = self._blanks(scores)
        joined = [p for p in ids if len(p) > 1 and set(p) != {BLANK}]
        rank = {s: r for r, s in enumerate(sorted({scores[p] for p in joined}, reverse=True))}
        self.rank = np.full(n + 1, _NONE, np.int32)
        for p in joined:
            self.rank[ids[p]] = rank[scores[p]]

        self.n_ids = n
        self.symbol = np.full(0x110000, -1, np.int32)
        dense = np.zeros(n, np.int64)
        single = [p for p in ids if len(p) == 1]
        for k, p in enumerate(single):
            self.symbol[ord(p)], dense[ids[p]] = ids[p], k
        self.dense, self.n_single = dense, len(single)
        self.beside = np.zeros(self.n_single ** 2, bool)
        keys, results = [], []
        self.risky = np.zeros(n + 1, bool)  # pieces in a piece of the same or a lower rank
        for p in joined:
            for a, b in zip(p, p[1:]):
                if a in ids and b in ids:
                    self.beside[dense[ids[a]] * self.n_single + dense[ids[b]]] = True
            for cut in range(1, len(p)):
                a, b = ids.get(p[:cut]), ids.get(p[cut:])
                if a is not None and b is not None:
                    keys.append(a * n + b)
                    results.append(ids[p])
                    for part in (a, b):
                        self.risky[part] |= self.rank[part] != _NONE and self.rank[ids[p]] <= self.rank[part]
        self._fill(np.array(keys, np.int64), np.array(results, np.int32))
        self.known: dict[str, int] = {}
        expected = [len(x) for x in library.encode(list(_PROBES), num_threads=1)]
        if self.count(pa.array(_PROBES)).tolist() != expected:
            raise ValueError(f"{path} does not count tokens by merges of pieces alone")

    @staticmethod
    def _blanks(scores: dict[str, float]) -> np.ndarray:
        """Tokens of runs of up to twice the longest piece of `▁`s; checks what the counting relies on."""
        runs = {len(p): s for p, s in scores.items() if len(p) > 1 and set(p) == {BLANK}}
        others = [s for p, s in scores.items() if len(p) > 1 and set(p) != {BLANK}]
        longest = max(runs, default=1)
        counts = []
        for n in range(2 * longest + 1):
            tokens = [1] * n
            while at := [i for i, pair in enumerate(zip(tokens, tokens[1:])) if sum(pair) in runs]:
                tokens[at[0]:at[0] + 2] = [sum(tokens[at[0]:at[0] + 2])]
            counts.append(len(tokens))
        if (
            any(BLANK in p[1:] for p in scores if set(p) != {BLANK}) or len(set(runs.values())) > 1
            or (runs and others and max(runs.values()) >= min(others))
            or any(counts[n + longest] != counts[n] + 1 for n in range(longest + 1))
        ):
            raise ValueError("the model joins blanks in another way than this count knows")
        return np.array(counts[:longest], np.int64)

    def _fill(self, keys: np.ndarray, results: np.ndarray) -> None:
        """An open table of pairs: key in `slots`, joined piece in `joined`."""
        self.slots = np.full(_SLOTS + 64, -1, np.int64)
        self.joined = np.full(_SLOTS + 64, self.n_ids, np.int32)
        for key, result, at in zip(keys.tolist(), results.tolist(), self._place(keys).tolist()):
            while self.slots[at] not in (-1, key):
                at += 1
            self.slots[at], self.joined[at] = key, result
        if self.slots[-1] != -1:
            raise ValueError("too many pieces for the table of pairs")

    @staticmethod
    def _place(keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair joins to, or the number of ids (of no rank) if none."""
        keys = left.astype(np.int64) * self.n_ids + right
        at = self._place(keys)
        found = self.slots[at]
        result = np.where(found == keys, self.joined[at], np.int32(self.n_ids))
        left_over = np.flatnonzero((found != keys) & (found != -1))
        while len(left_over):
            at[left_over] += 1
            found = self.slots[at[left_over]]
            hit = found == keys[left_over]
            result[left_over[hit]] = self.joined[at[left_over[hit]]]
            left_over = left_over[~hit & (found != -1)]
        return result

    def merge(self, symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Which signs still begin a token once no pair is left; `first` marks where sequences begin."""
        alive = np.ones(len(symbols), bool)
        piece = np.full(len(symbols), self.n_ids, np.int32)  # of the pair that begins here
        inner = np.flatnonzero(~first[1:])
        piece[inner] = self.join(symbols[inner], symbols[inner + 1])
        place = np.arange(len(symbols))
        rank = self.rank[piece]
        while len(symbols):
            starts = np.flatnonzero(first)
            low = np.minimum.reduceat(rank, starts)
            sizes = np.diff(starts, append=len(symbols))
            go_on = low != _NONE
            if not go_on.all():
                kept = np.repeat(go_on, sizes)
                symbols, first, piece, place, rank = (x[kept] for x in (symbols, first, piece, place, rank))
                low, sizes = low[go_on], sizes[go_on]
                if not len(symbols):
                    break
            sequence = np.repeat(np.arange(len(low)), sizes)
            at = np.flatnonzero(rank == low[sequence])
            order = np.arange(len(at))
            begins = np.ones(len(at), bool)
            begins[1:] = np.diff(at) > 1
            at = at[(order - np.maximum.accumulate(np.where(begins, order, 0))) % 2 == 0]
            new = piece[at]
            if self.risky[new].any():
                held = self._held(symbols, first, at, new, low[sequence[at]], sequence[at])
                at, new = at[~held], new[~held]
            symbols[at] = new
            alive[place[at + 1]] = False
            kept = np.ones(len(symbols), bool)
            kept[at + 1] = False
            at -= np.arange(len(at))  # places after the joined ones have gone
            symbols, first, piece, place = (x[kept] for x in (symbols, first, piece, place))
            changed = np.zeros(len(symbols), bool)
            changed[at] = True
            changed[at[~first[at]] - 1] = True
            changed = np.flatnonzero(changed)
            ends = np.append(first[1:], True)[changed]
            piece[changed[ends]] = self.n_ids
            open_ = changed[~ends]
            piece[open_] = self.join(symbols[open_], symbols[open_ + 1])
            rank = self.rank[piece]
        return alive

    def _held(self, symbols, first, at, new, low, sequence) -> np.ndarray:
        """Pairs to join later: those behind one whose piece makes a pair of no higher rank with a neighbour."""
        after = at + 2
        has_right = np.append(first, True)[np.minimum(after, len(first))] == 0
        has_left = ~first[at]
        adjacent = np.zeros(len(at), bool)
        adjacent[1:] = (np.diff(at) == 2) & (sequence[1:] == sequence[:-1])
        left = symbols[at - 1]
        left[adjacent] = new[:-1][adjacent[1:]]
        early = np.zeros(len(at), bool)
        for ask, a, b in ((has_right, new, symbols[np.minimum(after, len(symbols) - 1)]), (has_left, left, new)):
            ask = np.flatnonzero(ask & self.risky[new])
            early[ask] |= self.rank[self.join(a[ask], b[ask])] <= low[ask]
        before = np.cumsum(early) - early
        opens = np.ones(len(at), bool)
        opens[1:] = sequence[1:] != sequence[:-1]
        return before > np.maximum.accumulate(np.where(opens, before, 0))

    def learn(self, words: list[str]) -> np.ndarray:
        """Twice the tokens of `▁` and each word, plus one where the `▁` stays a token of its own."""
        signs = np.frombuffer((BLANK + BLANK.join(words)).encode("utf-32-le"), np.uint32)
        symbols = self.symbol[signs]
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        begins = np.cumsum(sizes) - sizes
        first = np.zeros(len(signs) + 1, bool)
        first[begins] = True
        first[-1] = True
        lacking = symbols < 0
        own = self.dense[symbols]
        first[1:-1] |= lacking[1:] | lacking[:-1] | ~self.beside[own[:-1] * self.n_single + own[1:]]
        alone = first[:-1] & first[1:]
        alive = np.ones(len(signs), bool)
        alive[~alone] = self.merge(symbols[~alone], first[:-1][~alone])
        cost = alive.astype(np.int64)
        c = signs[lacking]
        cost[lacking] = 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)
        lone = np.append(alive, True)[begins + 1] | (sizes == 1)
        return 2 * np.add.reduceat(cost, begins) + lone

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        if not len(texts):
            return np.zeros(0, np.int64)
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        parts = pc.split_pattern(pc.replace_substring(texts, BLANK, " "), " ")
        offsets = parts.offsets.to_numpy()
        offsets = offsets - offsets[0]
        coded = parts.flatten().dictionary_encode()
        codes, names = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > MAX_KNOWN:
            self.known.clear()
        value = np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(value < 0)
        if len(new):
            words = [names[i] for i in new.tolist()]
            value[new] = self.learn(words)
            self.known.update((w, v) for w, v in zip(words, value[new].tolist()) if len(w) <= MAX_KNOWN_CHARS)
        value = value[codes]
        tokens, lone = value >> 1, value & 1
        # `▁`s stand side by side where a word is empty
        empty = np.fromiter(map(len, names), np.int64, len(names))[codes] == 0
        opens = np.ones(len(codes), bool)
        opens[1:] = ~empty[:-1]
        opens[offsets[:-1]] = True
        runs = np.flatnonzero(opens)
        length = np.add.reduceat(lone, runs)
        longest = len(self.blank_tokens)
        tokens[runs] -= length - length // longest - self.blank_tokens[length % longest]
        counts = np.add.reduceat(tokens, offsets[:-1])
        counts[pc.binary_length(texts).to_numpy() == 0] = 0
        return counts


_models: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """The model of a file, one for each Python worker."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep`, `n_bytes`, `n_tokens` and `over_limit` of every row of `docs (text, ...)`; no shuffle."""
    path = path or public_tokenizers.path(MODEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            for part in byte_groups(batch, "text", GROUP_BYTES):
                text = part.column("text")
                n_bytes = pc.fill_null(pc.binary_length(text), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("row"), n_bytes, pa.array(own.count(text))], ["row", "n_bytes", "n_tokens"])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(run, StructType([rows.schema["row"]]).add("n_bytes", "long").add("n_tokens", "long"))
    return counted.select("row.*", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
