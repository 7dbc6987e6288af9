"""Token ids of texts by their chunks, for tokenizers that split a text before they merge.

Such a tokenizer starts a new piece before each space that stands between two signs that are not white space, whatever
comes before or after. A text may therefore be cut there, and the ids of a chunk looked up or found once. The table of
chunks is emptied when it is full and at the end of a task, which bounds a worker's memory and changes no result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import chain, repeat
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MAX_CHUNKS = 400_000
MAX_CHUNK_CHARS = 256
#: Texts of about so many characters are encoded together.
GROUP_CHARS = 1 << 20


def ragged(rows: list[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The length of each row, and all rows one after the other."""
    lengths = np.fromiter(map(len, rows), np.int64, len(rows))
    return lengths, np.fromiter(chain.from_iterable(rows), np.uint32, int(lengths.sum()))


def gathered(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of `ids` from `starts` one after the other, and where each ends."""
    ends = np.cumsum(lengths)
    return ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)], ends


class ChunkTable:
    """Ids of chunks seen, one after the other in one array; `encode` gives chunks as `ragged` does."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.encode_chunks = encode
        self.clear()

    def clear(self) -> None:
        self.after_space: dict[str, int] = {}
        self.whole: dict[str, int] = {}
        self.ids = np.zeros(1 << 20, np.uint32)
        self.starts = np.zeros(1 << 16, np.int64)
        self.n_chunks = 0

    def _add(self, chunks: list[str]) -> list[int]:
        """Numbers of new chunks."""
        if not chunks:
            return []
        lengths, ids = self.encode_chunks(chunks)
        begin = int(self.starts[self.n_chunks])
        stop = begin + len(ids)
        if stop > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(max(stop, len(self.ids)), np.uint32)))
        first, last = self.n_chunks, self.n_chunks + len(lengths)
        if last + 1 >= len(self.starts):
            self.starts = np.concatenate((self.starts, np.zeros(len(self.starts) + len(lengths), np.int64)))
        self.ids[begin:stop] = ids
        self.starts[first + 1:last + 1] = begin + np.cumsum(lengths)
        self.n_chunks = last
        return list(range(first, last))

    def _learn(self, chunks: list[str], after_space: bool) -> list[int]:
        """Numbers of different chunks that are not in the table; those of ordinary length enter it."""
        numbers = self._add([" " + c for c in chunks] if after_space else chunks)
        kept = self.after_space if after_space else self.whole
        if max(map(len, chunks), default=0) <= MAX_CHUNK_CHARS:
            kept.update(zip(chunks, numbers))
        else:
            kept.update((c, n) for c, n in zip(chunks, numbers) if len(c) <= MAX_CHUNK_CHARS)
        return numbers

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; words are told apart by Arrow, and what the table lacks is found at once."""
        if self.n_chunks > MAX_CHUNKS or self.starts[self.n_chunks] > 16 * MAX_CHUNKS:
            self.clear()
        parts = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        begins = parts.offsets.to_numpy()[:-1]
        words = parts.flatten().dictionary_encode()
        codes, names = words.indices.to_numpy(), words.dictionary.to_numpy(zero_copy_only=False).tolist()
        n = len(codes)
        bare = np.fromiter(map(eq, names, map(str.strip, names)), bool, len(names))
        bare &= np.fromiter(map(bool, names), bool, len(names))
        heads, tails = bare.copy(), bare
        for i in np.flatnonzero(~bare).tolist():
            heads[i], tails[i] = (not names[i][0].isspace(), not names[i][-1].isspace()) if names[i] else (False, False)
        heads, tails = heads[codes], tails[codes]
        cuts = np.ones(n, bool)
        cuts[1:] = heads[1:] & tails[:-1]
        cuts[begins] = True
        first = np.flatnonzero(cuts)
        last = np.append(first[1:], n)
        leads = np.zeros(n, bool)
        leads[begins] = True
        leads = leads[first]  # chunks that no space precedes
        plain = ~leads & (last - first == 1)
        numbers = np.zeros(len(first), np.int64)

        single = codes[first[plain]]
        used = np.flatnonzero(np.bincount(single, minlength=len(names)))
        after = [names[c] for c in used.tolist()]
        known = np.fromiter(map(self.after_space.get, after, repeat(-1)), np.int64, len(after))
        lacking = np.flatnonzero(known < 0)
        known[lacking] = self._learn([after[i] for i in lacking.tolist()], True)
        number_of = np.zeros(len(names), np.int64)
        number_of[used] = known
        numbers[plain] = number_of[single]

        others = np.flatnonzero(~plain)
        spans = zip(first[others].tolist(), last[others].tolist(), leads[others].tolist())
        chunks = [("" if lead else " ") + " ".join([names[c] for c in codes[i:j].tolist()]) for i, j, lead in spans]
        unknown = list(dict.fromkeys(c for c in chunks if c not in self.whole))
        new = dict(zip(unknown, self._learn(unknown, False)))
        numbers[others] = np.fromiter((new[c] if c in new else self.whole[c] for c in chunks), np.int64, len(chunks))

        starts = self.starts[numbers]
        lengths = self.starts[numbers + 1] - starts
        ids, ends = gathered(self.ids, starts, lengths)
        # a text's ids end where its last chunk's do
        return np.split(ids, ends[np.flatnonzero(leads)[1:] - 1]) if n else []


def grouped(texts: Iterable[str | None], chars: int = GROUP_CHARS) -> Iterator[list[str]]:
    """Texts in groups of about `chars` characters, nulls as empty ones."""
    group, size = [], 0
    for text in texts:
        group.append(text or "")
        size += len(group[-1])
        if size >= chars:
            yield group
            group, size = [], 0
    if group:
        yield group
