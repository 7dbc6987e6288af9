"""Tables whose columns have the operators' own names, and the pipeline's stages against brute force."""

import hashlib
from collections import defaultdict

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_llm import ODD, brute_hits, brute_print, coder

import corpus_pipeline
from listing_analytics.llm import (
    bilinear, bpe, bwt, decontamination, directcodes, linespread, permutation, piececounts, preference, resampling, simhash,
    targetresampling, vafile,
)

NAMES = (
    "n_removed n_lines paired last_turn reply last partner hash text_hash row part place score rank weight n_words cluster vector cells id word "
    "fingerprint component component_id node line h1 h2 first bad_id kept_id gone_id value n bucket log_weight sample_key content order pivot"
).split()


def cluttered(df):
    """`df` with a text column under each name that it does not have."""
    taken = {c.lower() for c in df.columns}
    return df.select("*", *[F.lit("odd").alias(n) for n in NAMES if n not in taken])


@pytest.fixture(scope="module")
def docs(spark):
    shared = "\n".join(["the same line on many sites"] * 2)
    more = [(100 + i, f"{shared}\nown words {i} of document number {i % 5}", f"site{i % 12}", "x") for i in range(30)]
    return spark.createDataFrame(ODD + more, "doc_id long, text string, source string, lang string").repartition(3)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "One two three. One two"), (2, None), (3, "own words 3")], "item_id long, text string")


OPERATORS = {
    "matches": lambda d, i: decontamination.matches(d, i).drop("matches"),
    "decontaminate": lambda d, i: decontamination.decontaminate(d, i).select("doc_id", "text"),
    "lines": lambda d, i: linespread.remove_boilerplate(d).select("doc_id", "text"),
    "codes": lambda d, i: directcodes.write_and_digest(d),
    "bpe": lambda d, i: bpe.round_trip(d),
    "simhash": lambda d, i: simhash.near_duplicates(d).select("doc_id", "fingerprint", "component_id"),
    "deduplicate": lambda d, i: simhash.deduplicate(d).select("doc_id", "text"),
    "repeats": lambda d, i: bwt.remove_repeats(d),
    "counts": lambda d, i: piececounts.token_counts(d),
    "targets": lambda d, i: targetresampling.ranked(targetresampling.scored(d, i)).drop("rank"),
    "drawn": lambda d, i: targetresampling.resample(d, i, 50).select("doc_id", "text"),
    "language model": lambda d, i: bilinear.score(d).select("doc_id", "n_tokens", "n_known"),
    "resampling": lambda d, i: resampling.resample(d, i.select(F.col("item_id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic")), columns=["doc_id"]),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_other_columns_make_no_difference(docs, items, name):
    # a result column may have underscores before its name
    plain, odd = ([tuple(r) for r in OPERATORS[name](d, i).collect()] for d, i in ((docs, items), (cluttered(docs), cluttered(items))))
    assert sorted(map(str, odd)) == sorted(map(str, plain))


def test_other_columns_of_conversations_and_vectors(spark):
    turns = spark.createDataFrame(
        [(0, 0, "user", "hi"), (0, 1, "assistant", "yes"), (1, 0, "assistant", "no"), (2, 0, "user", "alone")],
        "conv_id long, turn long, role string, text string",
    )
    partner = F.col("conv_id") + 1 - 2 * (F.col("conv_id") % 2)
    plain, odd = (sorted(map(str, preference.preference_pairs(*preference.swapped_replies(t, partner)).collect())) for t in (turns, cluttered(turns)))
    assert plain == odd and len(plain) == 3
    long = "word " * 200_000  # a megabyte
    large = preference.preference_pairs(*preference.swapped_replies(turns.withColumn("text", F.lit(long)), partner)).collect()
    assert sorted(len(r.prompt) + len(r.chosen) for r in large)[-1] > 2_000_000
    assert preference.preference_pairs(*preference.swapped_replies(turns.limit(0), partner)).count() == 0
    vectors = spark.createDataFrame([(i, [float(i % 7), float(i % 5), 1.0]) for i in range(60)], "vec_id long, embedding array<double>")
    for run in (
        lambda v: permutation.search(v, F.col("vec_id") % 10 == 0, 5), lambda v: vafile.cluster(v, 4, dimensions=3),
    ):
        assert sorted(map(str, run(vectors).collect())) == sorted(map(str, run(cluttered(vectors)).collect()))


def test_lengths_follow_the_texts_of_the_line_stage(spark, docs):
    for table in (docs, cluttered(docs)):
        table = table.withColumn("n_chars", F.length("text").cast("long"))
        clean = corpus_pipeline.lines(spark, table, "")
        assert clean.columns == table.columns and clean.count() == table.count()
        changed = clean.where("doc_id BETWEEN 100 AND 129")
        assert changed.where(F.length("text") < 40).count() == 29  # the first occurrence stays
        assert clean.where("text IS NOT NULL AND n_chars <> length(text)").count() == 0


def brute_lines(docs):
    sites, first = defaultdict(set), {}
    for i, text, source in docs:
        for place, line in enumerate(text.split("\n") if text else []):
            if line.strip(" \t\r"):
                if source is not None:
                    sites[line].add(source)
                first[line] = min(first.get(line, (i, place)), (i, place))
    gone = {line for line, s in sites.items() if len(s) >= linespread.MIN_SITES}
    return {
        i: text and "\n".join(x for place, x in enumerate(text.split("\n")) if x not in gone or first[x] == (i, place)) for i, text, _ in docs
    }


def brute_groups(prints):
    ids, group = sorted(prints), {}
    for i in ids:
        if i in group:
            continue
        group[i], open_ = i, [i]
        while open_:
            a = open_.pop()
            for b in ids:
                if b not in group and bin(prints[a] ^ prints[b]).count("1") <= 4:
                    group[b] = i
                    open_.append(b)
    return group


def test_pipeline_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    drawn = {r.doc_id for r in corpus_pipeline.quality(spark, docs, sf).collect()}
    assert 0 < len(drawn) <= len(rows)
    texts = brute_lines([(r.doc_id, r.text, r.source) for r in rows if r.doc_id in drawn])
    group = brute_groups({i: brute_print(t) for i, t in texts.items()})
    kept = {i: t for i, t in texts.items() if group[i] == i}
    for i, text in list(kept.items()):
        n_words, n_hit, _ = brute_hits(text, items)
        if n_hit and 20 * n_hit >= n_words:
            del kept[i]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder().ranks, special_tokens={})
    expected = set()
    for i, text in kept.items():
        ids = library.encode_ordinary(text or "")
        expected.add((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    found = corpus_pipeline.run(spark, sf).collect()
    assert {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found} == expected and len(found) == len(expected)


def test_direct_codes_are_the_library_s(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(directcodes.VOCABULARY))
    signs = [chr(c) for c in (0xA7CE, 0x088F, 0x10940, 0x378, 0xE000, 0x1F9FF, 0x2028, 0xFEFF, 0x300, 0x661, 0xBD, 0x1C89)]
    texts = [" ".join(f"a{s}b 1{s}{s} {s}" for s in signs), "don't I'LL <|endoftext|> x", "  two\n\n three \t", None, "", "naïve 日本語 ½"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    folder = directcodes.stage_path(spark, "codes")
    directcodes.write(df, folder)
    found = {r.doc_id: list(r.ids) for r in directcodes.read(spark, folder).collect()}
    assert found == {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [directcodes.END_ID] for i, t in enumerate(texts)}
