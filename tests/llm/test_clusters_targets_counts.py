"""Centroid clustering, target resampling and token counts against brute force and the library, on odd rows too."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece

from listing_analytics.llm import piececounts, targetresampling, vafile

# `score`, `rank`, `row`, `n_words` and `cluster` are also names that the operators use
SCHEMA = "doc_id long, text string, score string, `rank` int, `row` string, n_words int, cluster string, `a.b` string"
EXTRA = ("s", 1, "r", 2, "c", "x")
LONG = "lorem ipsum don't " * 60_000
TEXTS = [
    (1, "One two three. One two three four five six!" * 3), (2, None), (3, ""), (4, "  \n\t "), (None, "null id " * 30), (None, "null id " * 30),
    (5, "word " * 3000), (5, "word " * 3000), (6, "é ü 日本 don't 12345 ---\n\n x ▁▁ a  b"), (5, "another text with this id " * 9), (7, LONG),
    (8, "<s> </s> <unk> <0x41>\x00\x01 " * 9), (9, "x" * 100_000), (10, " " * 5000), (11, "ÀB" * 70), (12, "th" * 5000),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*t, *EXTRA) for t in TEXTS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(piececounts.MODEL))


def sorted_rows(found):
    return sorted(found, key=lambda r: tuple((x is not None, x) for x in r))


def test_counts_are_the_library_s(odd, empty, library):
    expected = [(i, len((t or "").encode()), n, n > 4096) for i, t in TEXTS for n in [len(library.encode(t or ""))]]
    found = piececounts.token_counts(odd)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted_rows(tuple(r) for r in found.collect()) == sorted_rows(expected)
    assert piececounts.token_counts(empty).count() == 0
    assert piececounts.token_counts(odd, limit=5, keep=("score", "a.b")).where("over_limit").count() > 0


def test_counts_of_random_texts(library):
    draw, own = random.Random(1), piececounts.model(public_tokenizers.path(piececounts.MODEL))
    signs = [" ", " ", "\n", "\r", "a", "t", "h", "e", "r", "n", "R", "=", "-", "é", "日", "🙂", "▁", "1", "<", "th", " the", "return", "௵", "ра"]
    texts = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 100))) for _ in range(4000)]
    texts += [" " * n for n in range(70)] + ["▁" * n + "x" for n in range(40)]
    assert own.count(pa.array(texts)).tolist() == [len(x) for x in library.encode(texts)]


def test_counts_of_given_documents(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    expected = {r.doc_id: len(library.encode(r.text or "")) for r in docs.select("doc_id", "text").collect()}
    assert {r.doc_id: r.n_tokens for r in piececounts.token_counts(docs).collect()} == expected


def test_models_of_another_kind_are_refused():
    assert piececounts.PieceModel._blanks({"▁": -1.0, "▁▁": -1e9, "ab": -2.0}).tolist() == [0, 1]
    with pytest.raises(ValueError, match="blanks"):
        piececounts.PieceModel._blanks({"▁": -1.0, "a▁": -3.0})
    with pytest.raises(ValueError, match="blanks"):
        piececounts.PieceModel._blanks({"▁": -1.0, "▁▁": -1.0, "ab": -2.0})


def words_of(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())


def buckets_of(text, longest, buckets):
    w = words_of(text)
    return [zlib.crc32(b" ".join(w[i:i + n])) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def brute_scores(docs, target, longest=3, buckets=10_000, seed=42):
    s, t = np.zeros(buckets, int), np.zeros(buckets, int)
    for texts, counts in ((docs, s), (target, t)):
        for _, text in texts:
            for b in buckets_of(text, longest, buckets):
                counts[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.sum() + buckets) / ((s[b] + 1) * (t.sum() + buckets)))) for b in range(buckets)]
    found = []
    for i, text in docs:
        own = buckets_of(text, longest, buckets)
        weight = sum(gain[b] for b in own)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        found.append((i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    return found


TARGET = [(0, "one two three four"), (1, None), (2, ""), (3, "lorem ipsum, don't another text")]


def test_scores_follow_the_formulas(spark, odd, empty):
    target = spark.createDataFrame(TARGET, "item_id long, text string")
    scores = targetresampling.scored(odd, target)
    found = [(r.doc_id, r.n_features, r.weight, r.score) for r in scores.collect()]
    assert sorted_rows(found) == sorted_rows(brute_scores(TEXTS, TARGET))
    few = targetresampling.scored(odd, target, longest=2, buckets=7, seed=1)
    assert sorted_rows((r.doc_id, r.n_features, r.weight, r.score) for r in few.collect()) == sorted_rows(brute_scores(TEXTS, TARGET, 2, 7, 1))
    assert {r.row["score"] for r in scores.select("row").collect()} == {"s"}
    assert targetresampling.ranked(targetresampling.scored(empty, target)).count() == 0
    nothing = target.limit(0)
    assert targetresampling.scored(odd, nothing).count() == len(TEXTS)


@pytest.mark.parametrize("percent", [0, 5, 30, 60, 100])
def test_the_highest_scores_are_drawn(spark, odd, percent):
    target = spark.createDataFrame(TARGET, "item_id long, text string")
    all_scores = brute_scores(TEXTS, TARGET)
    long_enough = [x for x, (_, t) in zip(all_scores, TEXTS) if len(words_of(t)) >= 20]
    order = sorted(long_enough, key=lambda x: (-x[3], x[0] is not None, x[0]))
    k = percent * len(order) // 100
    ranked = targetresampling.ranked(targetresampling.scored(odd, target), percent).collect()
    assert [(r.doc_id, r.score) for r in sorted((r for r in ranked if r.rank), key=lambda r: r.rank)] == [(x[0], x[3]) for x in order[:k]]
    assert sorted(r.rank for r in ranked if r.rank) == list(range(1, k + 1)) and len(ranked) == len(TEXTS)
    drawn = targetresampling.resample(odd, target, percent)
    assert drawn.columns == [*odd.columns, "_score"]
    last = order[k - 1][3] if k else None
    assert sorted(r["_score"] for r in drawn.collect()) == sorted(x[3] for x in order if k and (x in order[:k] or (x[3], x[0]) == (last, order[k - 1][0])))


def test_repeated_rows_fill_a_draw(spark):
    rows = [(7, "same words again and again " * 8)] * 300 + [(None, "same words again and again " * 8)] * 100
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    ranked = targetresampling.ranked(targetresampling.scored(docs, docs), 50).collect()
    assert sorted(r.rank for r in ranked if r.rank) == list(range(1, 201))


def test_crc_of_joined_texts():
    draw = random.Random(2)
    heads = [bytes(draw.randrange(256) for _ in range(draw.randint(0, 20))) for _ in range(2000)]
    tails = [bytes(draw.randrange(256) for _ in range(draw.randint(1, 1500))) for _ in heads]
    crc = np.array([zlib.crc32(h) for h in heads], np.uint32)
    own = np.array([zlib.crc32(t) for t in tails], np.uint32)
    found = targetresampling.shifted(crc, np.array(list(map(len, tails)))) ^ own
    assert found.tolist() == [zlib.crc32(h + t) for h, t in zip(heads, tails)]


def brute_clusters(vectors, k, rounds, dimensions=64):
    kept = [
        (i, [math.floor(256 * x) for x in v]) for i, v in vectors
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [r[1] for r in order[:k]]

    def assign(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = [assign(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            members = [v for (_, v), c in zip(kept, own) if c == n]
            if members:
                centroids[n] = [sum(x) // len(members) for x in zip(*members)]
    own = [assign(v) for _, v in kept]
    inertia = {}
    for d, c in own:
        inertia[c] = inertia.get(c, 0) + d
    return [
        (i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
        for (i, _), (d, c) in zip(kept, own)
    ]


VECTORS = "vec_id long, embedding array<float>, cluster int, distance string, vector int, cells string"


def some_vectors(n, dimensions=64):
    draw = np.random.default_rng(4)
    found = [(i, draw.normal(0, 0.2, dimensions).astype(np.float32).tolist()) for i in range(n)]
    found += [(n + i, found[i % 3][1]) for i in range(40)]  # copies
    found += [(5, found[0][1]), (None, found[1][1]), (None, found[2][1]), (n + 99, [0.0] * dimensions), (n + 100, [9000.0] * dimensions)]
    odd = [None, [], [0.5] * (dimensions - 1), [None] + [0.5] * (dimensions - 1), [math.nan] + [0.5] * (dimensions - 1), [math.inf] * dimensions]
    return found + [(n + 200 + i, v) for i, v in enumerate(odd)]


@pytest.mark.parametrize("bits, k, dimensions", [(1, 5, 64), (4, 40, 64), (6, 40, 64), (8, 7, 64), (4, 6, 3)])
def test_clusters(spark, bits, k, dimensions):
    vectors = some_vectors(150, dimensions)
    table = spark.createDataFrame([(i, v, 3, "d", 1, "c") for i, v in vectors], VECTORS).repartition(4)
    found = vafile.cluster(table, k, bits=bits, dimensions=dimensions)
    assert sorted_rows(tuple(r) for r in found.collect()) == sorted_rows(brute_clusters(vectors, k, 5, dimensions))


def test_clusters_of_few_and_no_vectors(spark):
    table = spark.createDataFrame([(i, v, 3, "d", 1, "c") for i, v in some_vectors(3)[:2]], VECTORS)
    assert sorted_rows(tuple(r) for r in vafile.cluster(table).collect()) == sorted_rows(brute_clusters(some_vectors(3)[:2], 40, 5))
    none = vafile.cluster(table.limit(0))
    assert none.count() == 0 and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    same = spark.createDataFrame([(1, [0.5] * 64, 3, "d", 1, "c")] * 50, VECTORS)
    assert {(r.cluster, r.distance, r.inertia) for r in vafile.cluster(same).collect()} == {(0, 0, 0)}


def test_intervals_spare_vectors(spark):
    draw = np.random.default_rng(8)
    centres = draw.normal(0, 1, (8, 64))
    rows = [(i, (centres[i % 8] + draw.normal(0, 0.05, 64)).tolist()) for i in range(800)]
    file = vafile.VAFile(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=8)
    _, looked_at = file.round(np.floor(256 * centres).astype(np.int64))
    assert looked_at < 80
    with pytest.raises(Exception, match="64 bits"):
        vafile.VAFile(spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>"))
