"""Operators of the text folder against brute force on small tables with odd rows."""

import hashlib
import itertools
import math
import random
import time

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from listing_analytics.llm import (
    bilinear, bpe, bwt, components, decontamination, directcodes, linespread, permutation, preference, resampling, simhash,
)

SCHEMA = "doc_id long, text string, source string, line string"
ODD = [
    (1, "One two three. One two three four five six!", "a", "x"), (2, None, "b", "x"), (3, "", None, None), (4, "  \n\t ", "a", "x"),
    (None, "One two three. One two three four five six!", "c", "x"), (5, "word " * 3000, "a", "x"),
    (5, "word " * 3000, "a", "x"), (6, "é ü 日本 don't 12345 ---\n\n x", "b", "x"), (5, "another text with this id", "c", "x"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=lambda r: tuple((x is not None, x) for x in r))


def same(df, expected, *columns):
    assert rows(df, *columns) == sorted(expected, key=lambda r: tuple((x is not None, x) for x in r))


def coder():
    return bpe.Coder.of(public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN)


def test_merges_agree_with_library():
    own = coder()
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    draw = random.Random(3)
    texts = ["".join(draw.choice(" \n\tabcé'sü1.-🙂  theing") for _ in range(draw.randint(0, 80))) for _ in range(400)]
    texts += [None, "", " ", "a" * 500, " " * 70 + "q", "\x1c a \x85b", "'s 're <|endoftext|>"]
    found = list(own.encode(texts))
    assert [x.tolist() for x in found] == [library.encode_ordinary(t or "") for t in texts]
    assert [own.decode(x.tolist()) for x in found] == [(t or "").encode() for t in texts]


def test_round_trip(odd, empty):
    expected = [(i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t, *_ in ODD]
    same(bpe.round_trip(odd), expected, "doc_id", "decoded_sha256")
    same(bpe.decode(bpe.encode(odd)), [(i, (t or "").encode()) for i, t, *_ in ODD], "doc_id", "content")
    assert bpe.round_trip(empty).count() == 0


def test_direct_codes(spark, odd, empty):
    ids = np.array([5, 300, 70_000, 255, 256, 0, 50_000] * 400, np.uint32)
    file = directcodes.CodeFile(directcodes.pack([7, None], np.array([0, 3, len(ids)]), ids))
    assert [file[i] for i in range(0, len(ids), 37)] == ids[::37].tolist()
    assert file.document(1).tolist() == ids[3:].tolist() and file.doc_ids == [7, None]
    found = directcodes.write_and_digest(odd).orderBy("start").collect()
    assert [r.doc_id for r in found] == sorted((i for i, *_ in ODD), key=lambda x: (x is not None, x))
    assert [r.start for r in found] == np.cumsum([0] + [r.n_tokens for r in found])[:-1].tolist()
    assert directcodes.write_and_digest(empty).count() == 0


def brute_print(text):
    words = (text or "").encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(odd, empty):
    same(simhash.near_duplicates(odd).select("doc_id", F.hex("fingerprint").alias("f")),
         [(i, f"{brute_print(t):X}") for i, t, *_ in ODD], "doc_id", "f")
    kept = rows(simhash.deduplicate(odd), "doc_id", "text", "line")
    assert [k[0] for k in kept] == [1, 2, 5, 5, 6] and {k[2] for k in kept} == {"x"}
    assert simhash.near_duplicates(empty).count() == 0 and simhash.deduplicate(empty).count() == 0


@pytest.mark.parametrize("node", [4, 1024])
def test_links_span_all_near_pairs(spark, monkeypatch, node):
    draw = np.random.default_rng(5)
    centres = draw.integers(0, 1 << 63, 40, dtype=np.uint64)
    codes = {int(c) for c in centres}
    for c in centres[:3]:
        for _ in range(150):
            codes.add(int(c) ^ sum(1 << int(b) for b in draw.choice(64, draw.integers(1, 5), replace=False)))
    codes = np.array(sorted(codes), np.uint64)
    near = np.bitwise_count(codes[:, None] ^ codes[None]) <= 4
    label = np.arange(len(codes))
    while (new := np.where(near, label[None], len(codes)).min(1)).tolist() != label.tolist():
        label = new
    by_rank = codes[np.argsort(simhash.gray_rank(codes))]
    assert (simhash.GrayTree(by_rank).search(codes, 4) == (np.bitwise_count(codes[:, None] ^ by_rank[None]) <= 4)).all()
    for size in (node,):
        left, right = by_rank[:len(codes) // 2], by_rank[len(codes) // 2:]
        pairs = [simhash.tree_links(left, 4), simhash.tree_links(right, 4), simhash.cross_links(left, right, 4)]
        a, b = (np.concatenate([p[i] for p in pairs]) for i in (0, 1))
        assert (np.bitwise_count(a ^ b) <= 4).all()
    entries = spark.createDataFrame([(int(c.astype(np.int64)),) for c in codes], "fingerprint long")
    found = {r.node: r.component for r in components.components(simhash.links(entries, 4, 2)).collect()}
    groups = {}
    for code, own in zip(codes.astype(np.int64).tolist(), label.tolist()):
        groups.setdefault(found.get(code, code), set()).add(own)
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(label.tolist()))


def brute_hits(text, items, window=13):
    words, hit, found = decontamination.words_of(text), set(), set()
    for item_id, item in items:
        own = decontamination.words_of(item)
        size = min(window, len(own))
        for j in range(len(own) - size + 1 if own else 0):
            for i in range(len(words) - size + 1):
                if words[i:i + size] == own[j:j + size]:
                    hit |= set(range(i, i + size))
                    found.add(str(item_id))
    return len(words), len(hit), sorted(found)


def test_decontamination(spark, odd, empty):
    draw = random.Random(1)
    long = " ".join(draw.choice("abcdefg") for _ in range(60))
    docs = ODD + [(10, f"x y {long} z", "a", "x"), (11, " ".join(long.split()[:20]).upper(), "a", "x"), (12, " ".join(long.split()[:12]), "a", "x")]
    items = [(1, long), (2, "Six"), (3, None), (4, "..."), (10, " ".join(long.split()[5:30])), (2, "dont know")]
    docs_df = spark.createDataFrame(docs, SCHEMA)
    items_df = spark.createDataFrame([*items, (None, "one two")], "item_id long, text string")
    expected = [(i, *brute_hits(t, items)) for i, t, *_ in docs]
    for block in (1 << 20, 150):
        same(decontamination.matches(docs_df, items_df, block_bytes=block), expected, "doc_id", "n_words", "n_hit", "items")
    longest = [m for r in decontamination.matches(docs_df, items_df).where("doc_id = 10").collect() for m in r.matches]
    assert ("1", 0, 2, 60) in [tuple(m) for m in longest]
    assert 10 not in {r.doc_id for r in decontamination.decontaminate(docs_df, items_df).collect()}
    assert decontamination.matches(empty, items_df).count() == 0
    assert decontamination.decontaminate(odd, items_df.limit(0)).count() == len(ODD)


def test_line_spread(spark, empty):
    sites = [(i, f"Menu here\nown {i}\n\nMenu here", f"s{i}", "x") for i in range(12)]
    extra = [(20, None, "s1", "x"), (21, "", "s2", "x"), (22, "Menu here", None, "x"), (22, "Menu here", None, "x")]
    found = {r.doc_id: r for r in linespread.remove_boilerplate(spark.createDataFrame(sites + extra, SCHEMA), 10).collect()}
    assert found[0].text == "Menu here\nown 0\n" and found[3].text == "own 3\n" and found[3].n_removed == 2
    assert found[20].text is None and found[21].text == "" and found[22].text == "" and found[22].line == "x"
    few = linespread.remove_boilerplate(spark.createDataFrame(sites[:9], SCHEMA), 10)
    assert few.agg(F.sum("n_removed")).first()[0] == 0
    assert linespread.remove_boilerplate(empty).count() == 0


def test_interleave_gives_least_ids():
    draw = random.Random(2)
    strings = ["".join(draw.choice("ab\0") for _ in range(draw.randint(0, 30))).encode() for _ in range(60)]
    ids = np.array([draw.randint(0, 9) for _ in strings])
    for shards in (1, 2, 5):
        for own, found in zip(strings, bwt.least_ids(strings, ids, 4, shards)):
            expected = [min(i for s, i in zip(strings, ids) if own[p:p + 4] in s) for p in range(len(own) - 3)]
            assert found.tolist() == expected


def texts_with_repeats(draw):
    """Also bytes of 0, periods, copies, and texts of no string or one."""
    shared = bytes(draw.choice(b"abc\0") for _ in range(400))
    own = [bytes(draw.choice(b"abcdefg\0\xff") for _ in range(draw.randint(0, 90))) for _ in range(30)]
    texts = [x + shared[at:at + draw.randint(0, 200)] + y for x, y, at in zip(own, own[::-1], range(0, 300, 10))]
    return [*texts, b"", b"a" * 200, b"ab" * 90, b"\0" * 120, b"ba" * 70, shared[:50], shared[:49], shared, shared]


def test_segments_of_joined_texts():
    texts = texts_with_repeats(random.Random(6))
    lengths = np.array([len(t) for t in texts])
    starts, expected = np.cumsum(lengths) - lengths, []
    for number, text in enumerate(texts):
        if len(text) < bwt.WIDTH:
            continue
        with np.errstate(over="ignore"):
            hashes, wanted = bwt.gram_hashes(np.frombuffer(text, np.uint8)), bwt.WIDTH - bwt.GRAM + 1
        places = [p + int(hashes[p:p + wanted].argmin()) for p in range(len(text) - bwt.WIDTH + 1)]
        for _, own in itertools.groupby(range(len(places)), key=places.__getitem__):
            own = list(own)
            expected.append((number, int(starts[number]) + own[0], int(starts[number]) + own[-1]))
    first, last, gram, number = bwt.segments(np.frombuffer(b"".join(texts), np.uint8), lengths)
    assert list(zip(number.tolist(), first.tolist(), last.tolist())) == expected
    alone = [bwt.segments(np.frombuffer(t, np.uint8), np.array([len(t)]))[2] for t in texts]
    assert np.concatenate(alone).tolist() == gram.tolist()


def test_segments_are_merged_with_their_gram_as_one_symbol(monkeypatch):
    texts = texts_with_repeats(random.Random(7))
    data = b"".join(texts)
    first, last, _, _ = bwt.segments(np.frombuffer(data, np.uint8), np.array([len(t) for t in texts]))
    strings = sorted({data[a:b + bwt.WIDTH] for a, b in zip(first, last)})
    ids = np.array([random.Random(8).randint(0, 99) for _ in strings])
    sizes, merged = [], bwt.merged
    monkeypatch.setattr(bwt, "merged", lambda shards, depth: sizes.append((sum(len(s.order) for s in shards), depth)) or merged(shards, depth))
    for shards in (1, 2, 5):
        found = bwt.least_ids(strings, ids, bwt.WIDTH, shards, bwt.GRAM)
        for own, least in zip(strings, found):
            assert least.tolist() == [min(i for s, i in zip(strings, ids) if own[p:p + bwt.WIDTH] in s) for p in range(len(own) - bwt.WIDTH + 1)]
        held = [[-1] * len(least) for least in found]
        for string, since, upto, least in zip(*bwt.runs_of(*bwt.least_of_places(strings, ids, bwt.WIDTH, shards, bwt.GRAM))):
            held[string][since:upto] = [int(least)] * (upto - since)
        assert held == [least.tolist() for least in found]
    # as many rounds as a string has symbols, over symbols instead of all bytes
    assert set(sizes) == {(sum(len(s) + 1 - (bwt.GRAM - 1) for s in strings), bwt.WIDTH - bwt.GRAM + 1)}


def test_equal_segments_are_counted_in_slices(spark, monkeypatch):
    written, compact = [], bwt.compact
    monkeypatch.setattr(bwt, "compact", lambda df, path: written.append(path) or compact(df, path))
    shared = "a passage of more than fifty bytes that two documents share, and no more"
    docs = spark.createDataFrame([(i, f"{i} {shared} {i * i}", "a", "x") for i in range(3)], SCHEMA)
    assert {r.doc_id: r.n_removed for r in bwt.remove_repeats(docs).collect()}[0] == 0
    assert sum("/shared/" in p for p in written) == bwt.COUNT_SLICES > 1


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_shuffles_of_grams_are_deleted(spark):
    docs = spark.createDataFrame([(i, f"{i} a passage of more than fifty bytes that all documents share, {i}", "a", "x") for i in range(40)], SCHEMA)
    before = shuffle_files(spark)
    assert bwt.repeated_grams(docs.repartition(3)).any()
    for _ in range(50):  # files go in the background
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left


def test_repeats(spark, odd, empty):
    draw = random.Random(4)
    shared = "".join(draw.choice("abcdefgh ") for _ in range(200))
    docs = ODD + [(30, "start " + shared, "a", "x"), (31, shared[20:120] + " é " + shared[:49], "a", "x"), (32, shared[:70] * 3, "a", "x")]
    first, expected = {}, []
    for i, text, *_ in docs:
        data = (text or "").encode()
        for p in range(len(data) - 49):
            first[data[p:p + 50]] = min(first.get(data[p:p + 50], math.inf), math.inf if i is None else i)
    for i, text, *_ in docs:
        data, gone = (text or "").encode(), set()
        for p in range(len(data) - 49):
            if first[data[p:p + 50]] < (math.inf if i is None else i):
                gone |= set(range(p, p + 50))
        spans = sum(p - 1 not in gone for p in gone)
        expected.append((i, len(data), len(gone), spans, bytes(b for p, b in enumerate(data) if p not in gone)))
    same(bwt.remove_repeats(spark.createDataFrame(docs, SCHEMA)), expected, "doc_id", "n_bytes", "n_removed", "n_spans", "kept")
    assert bwt.remove_repeats(empty).count() == 0


def test_repeats_of_null_ids_with_one_short_hash(spark):
    shared = "a passage of more than fifty bytes that two documents share, and no more"
    texts = spark.range(200_000).select(F.when(F.col("id") % 2 == 0, F.concat(F.col("id"), F.lit(" " + shared)))
                                        .otherwise(F.concat(F.lit("own text "), F.col("id"))).alias("text"))
    short = F.hash(F.lit(None).cast("long"), "text")
    pairs = texts.groupBy(short).agg(F.collect_set("text").alias("t")).where("size(t) > 1").collect()
    mixed = [r.t for r in pairs if len({shared in x for x in r.t}) == 2]
    assert mixed
    docs = [(1, shared, "a", "x")] + [(None, x, "a", "x") for t in mixed for x in t]
    kept = {bytes(r.kept) for r in bwt.remove_repeats(spark.createDataFrame(docs, SCHEMA)).where("doc_id IS NULL").collect()}
    assert kept == {x.replace(shared, "").encode() for t in mixed for x in t}


def test_language_model(odd, empty):
    found = bilinear.score(odd).collect()
    train = [t for i, t, *_ in ODD if not bilinear.is_held_out(i)]
    counts = {}
    for text in train:
        for w in [*bilinear.words_of(text), b""]:
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for own in {(i, t) for i, t, *_ in ODD}:
        tokens = [*bilinear.words_of(own[1]), b""]
        base = sum(math.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in tokens)
        assert any(r.doc_id == own[0] and r.n_tokens == len(tokens) and abs(r.base_score - base) < 1e-6 * abs(base)
                   and r.n_known == sum(w in counts for w in tokens) and r.train_tokens == n and r.score < 0 for r in found)
    assert bilinear.score(empty).count() == 0


def test_language_model_grows_and_learns_across_partitions(spark):
    counts = spark.createDataFrame([(f"w{i}".encode(), 5) for i in range(90_000)], "word binary, n long")
    assert bilinear.Vocabulary(counts).classes == 600
    draw = random.Random(6)
    pairs = [("red", "apple"), ("blue", "sky"), ("green", "leaf"), ("grey", "stone")]
    texts = [(i, " ".join(w for _ in range(30) for w in draw.choice(pairs))) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(40)
    row = bilinear.score(docs).where("held_out").agg(F.sum("score").alias("own"), F.sum("base_score").alias("base")).first()
    assert row.own > 0.95 * row.base


def softmax_logs(model, first, second):
    """Log chances of all tokens after a pair, from the definition."""
    scores = (model.r[first].astype(float) @ model.c[0] + model.r[second].astype(float) @ model.c[1]) @ model.q.T.astype(float) + model.b
    return scores - np.log(np.exp(scores).sum())


def test_language_model_by_pairs():
    random_, frequency = np.random.default_rng(4), np.array([0.4, 0.3, 0.2, 0.1])
    model = bilinear.Model(frequency)
    model.load(random_.normal(0, 0.5, len(model.flat())).astype(np.float32))
    one, two, token = (random_.integers(0, 4, 50) for _ in range(3))
    expected = [softmax_logs(model, a, b)[t] for a, b, t in zip(one, two, token)]
    norm = np.vstack([model.norms(0, 3, 4), model.norms(3, 4, 4)])
    for known in (0, 1, 3, 4):  # sums from the table, or computed for the pairs beyond it
        assert np.allclose(model.log_chance(one, two, token, norm[:known, :known]), expected, atol=1e-4)
    assert np.allclose(np.exp([softmax_logs(model, 0, 1)]).sum(), 1)


def test_language_model_scores_by_definition(spark, monkeypatch):
    draw = random.Random(9)
    texts = [(i, " ".join(draw.choice(["the", "Cat", "sat", "on", f"w{draw.randint(0, 900)}"]) for _ in range(draw.randint(0, 40)))) for i in range(120)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    words = bilinear.Vocabulary(bilinear.word_counts(docs), classes=60)
    shared = spark.sparkContext.broadcast(words)
    model = bilinear.Model(words.frequency)
    model.load(bilinear.train(docs, shared))
    monkeypatch.setattr(bilinear.Vocabulary, "__init__", lambda self, counts: self.__dict__.update(words.__dict__))
    counts = {bytes(r.word): r.n for r in bilinear.word_counts(docs).collect()}
    for row in bilinear.score(docs).collect():
        tokens = [*bilinear.words_of(dict(texts)[row.doc_id]), b""]
        known = [0 if t == b"" else int(words.token[words.place[t]]) if t in words.place else bilinear.OTHER for t in tokens]
        total, before = 0.0, [0, 0]
        for word, token in zip(tokens, known):
            total += softmax_logs(model, before[-1], before[-2])[token] / math.log(10)
            if token == bilinear.OTHER:
                total += math.log10((counts.get(word, 0) + 1) / (words.other_n + words.other_v + 1))
            before.append(token)
        assert abs(row.score - total) < 1e-4 * abs(total)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_language_model_beats_counts_on_held_out_text(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    row = bilinear.score(docs).where("held_out").agg(F.sum("score").alias("own"), F.sum("base_score").alias("base")).first()
    assert row.own > row.base


def test_permutation_index(spark):
    draw = np.random.default_rng(0)
    vectors = draw.normal(size=(300, 8)).astype(np.float32)
    vectors[50:90] = vectors[50]
    table = [(i, v.tolist()) for i, v in enumerate(vectors)]
    bad = [(400, None), (420, [0.0] * 8), (440, [float("nan")] * 8), (460, [None] * 8), (480, [1.0] * 3), (None, [1.0] * 8)]
    df = spark.createDataFrame(table + bad, "vec_id long, embedding array<float>")
    found = {}
    for r in permutation.search(df, F.col("vec_id") % 20 == 0, 5).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    exact = vectors.astype(float) @ vectors.astype(float).T
    for q in range(0, 300, 20):
        order = [i for i in np.lexsort((np.arange(300), -exact[q])) if i != q][:5]
        assert found[q] == order
    assert set(found) == set(range(0, 300, 20))
    assert permutation.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_permutation_index_scores_ties():
    draw = np.random.default_rng(1)
    copies = np.ones((1000, 4)) + draw.normal(scale=1e-6, size=(1000, 4))
    order = np.tile(np.arange(4), (1000, 1))
    found = permutation.best(np.array([-1]), np.ones((1, 4)), order[:1], np.arange(1000), copies, order, 4, 5)
    assert found.vec_id.tolist() == np.argsort(-copies.sum(1))[:5].tolist()


def test_permutation_index_finds_neighbours_of_many_vectors(spark):
    vectors = np.random.default_rng(2).normal(size=(50_000, 64))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(50_000), "embedding": list(vectors)})).repartition(8)
    found = {(r.query_id, r.vec_id) for r in permutation.search(df, F.col("vec_id") % 1000 == 0, 10).collect()}
    hits = 0
    for q in range(0, 50_000, 1000):
        score = vectors @ vectors[q]
        score[q] = -np.inf
        hits += sum((q, i) in found for i in np.argsort(-score)[:10].tolist())
    assert hits >= 0.9 * 500


def test_preference_pairs(spark):
    kind = "pair_id long, turn long, role string, text string"
    chosen = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", None), (3, 0, None, "a"), (3, 0, None, "a")]
    rejected = [(1, 0, "user", "hi"), (1, 1, "assistant", "no"), (1, 2, "user", "?"), (2, 0, "user", ""), (3, 0, None, "a"), (3, 1, None, "a")]
    found = {r.pair_id: r for r in preference.preference_pairs(
        spark.createDataFrame(chosen, kind), spark.createDataFrame(rejected, kind)).collect()}
    assert found[1].prompt == "<|user|>\nhi<|end|>\n" and found[1].n_common == 1
    assert found[1].chosen == "<|assistant|>\nyes<|end|>\n"
    assert [(m.n_chars, m.trained) for m in found[1].rejected_mask] == [(14, False), (10, True), (9, False), (9, False)]
    assert found[2].n_common == 0 and found[3].n_common == 2 and found[3].chosen == ""


def test_swapped_replies_keep_conversations_without_partner(spark):
    turns = [(0, 0, "user", "hi"), (0, 1, "assistant", "yes"), (1, 0, "assistant", None), (2, 0, "assistant", "alone"),
             (3, 0, "user", "no reply"), (None, 0, "assistant", "null id")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    partner = F.col("conv_id") + 1 - 2 * (F.col("conv_id") % 2)
    found = {r.pair_id: r for r in preference.preference_pairs(*preference.swapped_replies(df, partner)).collect()}
    assert set(found) == {0, 1, 2, 3, None}
    assert found[0].rejected == "<|assistant|>\n<|end|>\n" and found[1].rejected == "<|assistant|>\nyes<|end|>\n"
    assert all(found[i].rejected == "" and found[i].chosen and found[i].n_common == 0 for i in (2, 3, None))
    skipped = preference.preference_pairs(*preference.swapped_replies(df, partner, unpaired="skip"))
    assert {r.pair_id for r in skipped.collect()} == {0, 1}


def test_resampling(spark):
    good = [(i, f"plain words number {i % 7} in a text", "a", "x") for i in range(300)]
    bad = [(1000 + i, f"plain words awful{'x' * (i % 3)} awful in a text", "a", "x") for i in range(100)]
    docs = spark.createDataFrame(good + bad + [(5000, None, "a", "x"), (None, "plain words", "a", "x")], SCHEMA)
    labels = spark.createDataFrame([(i, 1, int(i >= 1000)) for i, *_ in good[::2] + bad[::2]] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in resampling.resample(docs, labels).collect()}
    assert kept >= {i for i, *_ in good} and not kept & {i for i, *_ in bad} and {5000, None} <= kept
    assert resampling.resample(docs, labels, k=10).count() == 10
    assert resampling.resample(docs, labels.limit(0)).count() == docs.count()
    assert resampling.resample(docs.limit(0), labels).count() == 0


def test_resampling_rejects_toxic_documents_of_small_tables(spark):
    good = [(i, f"plain words number {i % 7} in a text", "a", "x") for i in range(80)]
    toxic = [(1000 + i, f"plain words number {i % 7} in a nasty text", "a", "x") for i in range(12)]
    docs = spark.createDataFrame(good + toxic, SCHEMA)
    labels = spark.createDataFrame([(i, 1, int(i >= 1000)) for i, *_ in good[::2] + toxic[:8]], "doc_id long, quality int, toxic int")
    assert {r.doc_id for r in resampling.resample(docs, labels).collect()} == {i for i, *_ in good}


def test_new_words_of_a_group_are_split_at_once():
    coder = directcodes.Pieces(public_tokenizers.path(directcodes.VOCABULARY))
    split, texts = coder.split, []
    coder.split = lambda text: texts.append(text) or split(text)
    chunks = [f" w{i}rt,é{'!' * (i % 3)}" for i in range(500)]
    chunks += [" a\n", "  b", "", " ", "c", " \x1cd", " d\x1c", " 12　", " it's", " " + "long" * 200, "\u0000", " z"]
    lengths, ids = coder(chunks)
    assert len(texts) < 30
    # as the whole tokenizer gives each chunk, also when the pieces are known and when the table was emptied
    assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] == coder.whole(chunks)
    assert all(len(p) <= directcodes.MAX_CHUNK_CHARS for p in coder.known)
    again = coder(chunks[::-1])
    assert [x.tolist() for x in np.split(again[1], np.cumsum(again[0])[:-1])] == coder.whole(chunks[::-1])
    assert [x.tolist() for x in coder([])] == [[], []]


def test_words_of_a_group_meet_the_vocabulary_at_once(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"the cat {'sat ' * (i % 3)}É{i % 5}\n") for i in range(40)] + [(40, None), (41, " ")], "doc_id long, text string")
    vocabulary = bilinear.Vocabulary(bilinear.word_counts(docs), head=4)
    calls, whole = [], vocabulary.places
    monkeypatch.setattr(vocabulary, "places", lambda words: calls.append(len(words)) or whole(words))
    batches = docs.toArrow().to_batches()
    groups = list(bilinear._groups(iter(batches), vocabulary, lambda i: True))
    assert len(groups) == 1 and len(calls) == 1
    ids, words, places, lengths, _, _, tokens = groups[0]
    assert ids == list(range(42)) and [len(p) + 1 for p in places] == lengths.tolist() and words[40:] == [[], []]
    table = vocabulary.words.to_pylist()
    assert 1 < len(table) <= 4 and all([table.index(w) if w in table else -1 for w in own] == p.tolist() for own, p in zip(words, places))
    assert len(tokens) == lengths.sum()


def test_words_are_found_for_many_texts_at_once(spark, monkeypatch):
    texts = [None, "", " ", "\n\t a B\x0b\x0cC\r", "Éa É  ZZ", "\x1cx\x1d \x00", " 12　 a", "".join(map(chr, range(128))), "b " * 300, "x" * 5000]
    expected = [bilinear.words_of(t) for t in texts]
    words, sizes = bilinear.words_in(pa.array(["cut", *texts], pa.string()).slice(1))
    assert words.to_pylist() == [w for own in expected for w in own] and sizes.tolist() == [len(own) for own in expected]
    assert [len(x) for x in bilinear.words_in(pa.array([], pa.string()))] == [0, 0]
    docs = spark.createDataFrame(list(enumerate(texts * 3)), "doc_id long, text string")
    vocabulary, batches = bilinear.Vocabulary(bilinear.word_counts(docs)), docs.toArrow().to_batches()
    whole = [bilinear._groups(iter(batches), vocabulary, lambda i: i % 7 != 3)]
    ids, own, _, _, one, two, token = next(whole[0])
    assert ids == [i for i in range(30) if i % 7 != 3] and list(own) == [expected[i % 10] for i in ids]
    # groups of few tokens are cut where they were cut text by text, and their words meet the vocabulary together
    calls, places = [], vocabulary.places
    monkeypatch.setattr(vocabulary, "places", lambda words: calls.append(len(words)) or places(words))
    monkeypatch.setattr(bilinear, "words_of", None)
    monkeypatch.setattr(bilinear, "TOKENS", 20)
    monkeypatch.setattr(bilinear, "TEXT_BYTES", 100)
    groups = list(bilinear._groups(iter(batches), vocabulary, lambda i: i % 7 != 3))
    assert len(calls) == 1 and len(groups) > 2 and [i for g in groups for i in g[0]] == ids
    assert all(g[3].sum() >= 20 > g[3][:-1].sum() for g in groups[:-1])
    assert all(np.array_equal(np.concatenate([g[k] for g in groups]), x) for k, x in ((4, one), (5, two), (6, token)))
    monkeypatch.setattr(bilinear, "LOOKED_UP", 10)
    again = list(bilinear._groups(iter(batches), vocabulary, lambda i: i % 7 != 3))
    assert len(calls) > 3 and [g[0] for g in again] == [g[0] for g in groups]
    assert all(np.array_equal(a[6], g[6]) and list(a[1]) == list(g[1]) for a, g in zip(again, groups))


def test_rows_are_added_by_place():
    draw = np.random.default_rng(8)
    for n, size in ((1, 1), (1, 40), (7, 300), (300, 300), (70_000, 500), (40, 8)):
        at, rows = np.minimum(draw.geometric(0.1, size) - 1, n - 1), draw.normal(size=(size, 3)).astype(np.float32)
        total = np.zeros((n, 3))
        np.add.at(total, at, rows)
        assert np.allclose(bilinear._add_rows(at, rows, n), total, atol=1e-4)
