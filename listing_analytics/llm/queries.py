"""The queries of this folder's operators on the given tables, and their SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from listing_analytics.llm import (
    bilinear, bpe, bwt, decontamination, directcodes, linespread, permutation, piececounts, preference, resampling, simhash,
    targetresampling, vafile,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def hex16(column: str):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


DECONTAMINATION_SQL = r"""
    WITH d AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    b AS (
        SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    bw AS (
        SELECT item_id, len(w) AS size, array_to_string(w, ' ') AS key FROM b WHERE len(w) BETWEEN 1 AND 12
        UNION ALL
        SELECT item_id, 13, array_to_string(w[i:i + 12], ' ')
        FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS i FROM b WHERE len(w) >= 13)),
    sizes AS (SELECT DISTINCT size FROM bw),
    dw AS (
        SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS key
        FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
    hit AS (SELECT DISTINCT doc_id, i, dw.size, item_id FROM dw JOIN bw USING (key)),
    covered AS (
        SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id),
    items AS (
        SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""


@query("op1_decontamination", DECONTAMINATION_SQL)
def op1_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontamination.matches(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), decontamination.is_contaminated().alias("contaminated"),
    )


PREFERENCE_SQL = """
    WITH last AS (
        SELECT conv_id, max(turn) AS last_turn FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
    reply AS (
        SELECT conv_id, max(text) AS reply FROM conversations JOIN last USING (conv_id)
        WHERE role = 'assistant' AND turn = last_turn GROUP BY conv_id),
    sides AS (
        SELECT c.conv_id, turn, role, text, last_turn IS NOT NULL AND reply.conv_id IS NOT NULL AS paired,
               CASE WHEN role = 'assistant' AND turn = last_turn THEN reply ELSE text END AS other
        FROM conversations c LEFT JOIN last ON last.conv_id = c.conv_id
        LEFT JOIN reply ON reply.conv_id = c.conv_id + 1 - 2 * (c.conv_id % 2)),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place FROM sides),
    common AS (
        SELECT conv_id, CASE WHEN bool_or(paired) THEN coalesce(min(place) FILTER (text <> other) - 1, count(*)) ELSE 0 END AS n_common
        FROM placed GROUP BY conv_id),
    parts AS (
        SELECT placed.*, n_common, '<|' || role || '|>' || chr(10) AS head, text || '<|end|>' || chr(10) AS body,
               other || '<|end|>' || chr(10) AS other_body, CASE WHEN role = 'assistant' THEN ' +' ELSE ' -' END AS sign
        FROM placed JOIN common USING (conv_id))
    SELECT conv_id AS pair_id, any_value(n_common) AS n_common,
           coalesce(string_agg(head || body, '' ORDER BY place) FILTER (place <= n_common), '') AS prompt,
           coalesce(string_agg(head || body, '' ORDER BY place) FILTER (place > n_common), '') AS chosen,
           coalesce(string_agg('-' || length(head) || sign || length(body), ' ' ORDER BY place) FILTER (place > n_common), '')
               AS chosen_mask,
           coalesce(string_agg(head || other_body, '' ORDER BY place) FILTER (place > n_common AND paired), '') AS rejected,
           coalesce(string_agg('-' || length(head) || sign || length(other_body), ' ' ORDER BY place)
               FILTER (place > n_common AND paired), '') AS rejected_mask
    FROM parts GROUP BY conv_id"""


@query("op2_preference_pairs", PREFERENCE_SQL)
def op2_preference_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Each conversation against itself with the last reply of its neighbour (ids 2k and 2k + 1), if both have one."""
    turns = table(spark, sf, "conversations")
    chosen, rejected = preference.swapped_replies(turns, F.col("conv_id") + 1 - 2 * (F.col("conv_id") % 2))

    def as_text(mask: str):
        return F.array_join(F.transform(mask, lambda m: F.concat(F.when(m["trained"], "+").otherwise("-"), m["n_chars"])), " ")

    return preference.preference_pairs(chosen, rejected).withColumns(
        {m: as_text(m) for m in ("chosen_mask", "rejected_mask")}
    )


@query("op3_permutation_index")
def op3_permutation_index(spark: SparkSession, sf: str) -> DataFrame:
    return permutation.search(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query("op4_log_bilinear")
def op4_log_bilinear(spark: SparkSession, sf: str) -> DataFrame:
    return bilinear.score(table(spark, sf, "documents"))


@query("op5_merged_transforms")
def op5_merged_transforms(spark: SparkSession, sf: str) -> DataFrame:
    return bwt.remove_repeats(table(spark, sf, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op6_direct_codes")
def op6_direct_codes(spark: SparkSession, sf: str) -> DataFrame:
    return directcodes.write_and_digest(table(spark, sf, "documents"))


LINES_SQL = rf"""
    WITH l AS (
        SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place
        FROM documents),
    spread AS (
        SELECT line, min({{'id': doc_id, 'place': place}}) AS first FROM l WHERE trim(line, ' ' || chr(9) || chr(13)) <> ''
        GROUP BY line HAVING count(DISTINCT source) >= {linespread.MIN_SITES}),
    marked AS (
        SELECT doc_id, place, l.line, first IS NOT NULL AND NOT (first.id = doc_id AND first.place = place) AS gone
        FROM l LEFT JOIN spread ON l.line = spread.line),
    left_over AS (
        SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '') AS text,
               count(*) AS n_lines, count(*) FILTER (gone) AS n_removed
        FROM marked GROUP BY doc_id)
    SELECT doc_id, CASE WHEN d.text = '' THEN '' ELSE left_over.text END AS text,
           CASE WHEN coalesce(d.text, '') = '' THEN 0 ELSE n_lines END AS n_lines, coalesce(n_removed, 0) AS n_removed
    FROM documents d LEFT JOIN left_over USING (doc_id)"""


@query("op7_line_spread", LINES_SQL)
def op7_line_spread(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    return linespread.remove_boilerplate(docs).select("doc_id", "text", "n_lines", "n_removed")


@query("op8_byte_bpe")
def op8_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf, "documents"))


@query("op9_importance_resampling")
def op9_importance_resampling(spark: SparkSession, sf: str) -> DataFrame:
    """The documents drawn: ids of those that the classifier keeps."""
    return resampling.resample(table(spark, sf, "documents"), table(spark, sf, "labels"), columns=["doc_id"])


@query("op10_simhash")
def op10_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents")).select(
        "doc_id", hex16("fingerprint").alias("fingerprint"), "component_id"
    )


def _clustering_sql(k: int = 40, rounds: int = 5) -> str:
    """Rounds written out one after the other."""
    def assign(name: str, centroids: str) -> str:
        return f"""
    {name} AS MATERIALIZED (
        SELECT vec_id, any_value(v.x) AS x, min({{'d': apart, 'c': c}}) AS best
        FROM (SELECT vec_id, v.x, c, CAST(list_sum(list_transform(list_zip(v.x, m.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS apart
              FROM kept v, {centroids} m) v
        GROUP BY vec_id),"""

    steps = []
    for i in range(rounds):
        steps.append(assign(f"a{i}", f"m{i}") + f"""
    m{i + 1} AS MATERIALIZED (
        SELECT c, coalesce(moved, m{i}.x) AS x FROM m{i} LEFT JOIN (
            SELECT c, list((total - ((total % n) + n) % n) // n ORDER BY place) AS moved FROM (
                SELECT best.c AS c, place, CAST(sum(x[place]) AS BIGINT) AS total, count(*) AS n
                FROM a{i}, range(1, 65) r(place) GROUP BY best.c, place) GROUP BY c) USING (c)),""")
    return f"""
    WITH kept AS MATERIALIZED (
        SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
        FROM embeddings
        WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
    m0 AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, x FROM kept ORDER BY sha256('2:' || vec_id) LIMIT {k}),
    {"".join(steps)}{assign("final", f"m{rounds}")}
    hashes AS (SELECT c, sha256(array_to_string(x, ',')) AS centroid_sha256 FROM m{rounds})
    SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, best.d AS distance,
           CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
           centroid_sha256
    FROM final JOIN hashes ON hashes.c = best.c"""


CLUSTERING_SQL = _clustering_sql()


@query("op11_vafile_clustering", CLUSTERING_SQL)
def op11_vafile_clustering(spark: SparkSession, sf: str) -> DataFrame:
    return vafile.cluster(table(spark, sf, "embeddings"))


# CRC-32 is linear: each byte's part depends on itself and the number of bytes behind it, and parts join by exclusive or.
TARGET_SQL = r"""
    WITH RECURSIVE
    bits(b, k, v) AS (
        SELECT b, 0, b FROM range(256) r(b)
        UNION ALL
        SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
    step AS MATERIALIZED (SELECT b, v FROM bits WHERE k = 8),
    texts AS (
        SELECT true AS own, doc_id AS id, text FROM documents UNION ALL SELECT false, item_id, text FROM benchmark),
    words AS MATERIALIZED (
        SELECT own, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
    grams AS MATERIALIZED (
        SELECT own, id, array_to_string(w[i:i + n - 1], ' ') AS g
        FROM (SELECT own, id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, range(1, 4) r(n))),
    kinds AS MATERIALIZED (SELECT g, hex(encode(g)) AS bytes, octet_length(encode(g)) AS n FROM (SELECT DISTINCT g FROM grams)),
    part(d, b, v) AS (
        SELECT 0, b, v FROM step
        UNION ALL
        SELECT d + 1, part.b, xor(part.v >> 8, step.v) FROM part JOIN step ON step.b = part.v & 255
        WHERE d + 1 < (SELECT max(n) FROM kinds)),
    parts AS MATERIALIZED (SELECT d, format('{:02X}', b) AS b, v FROM part),
    empty_part(n, v) AS (
        SELECT 0, 4294967295
        UNION ALL
        SELECT n + 1, xor(empty_part.v >> 8, step.v) FROM empty_part JOIN step ON step.b = empty_part.v & 255
        WHERE n < (SELECT max(n) FROM kinds)),
    buckets AS MATERIALIZED (
        SELECT g, xor(xor(bit_xor(parts.v), any_value(empty_part.v)), 4294967295) % 10000 AS bucket
        FROM (SELECT g, n, unnest(range(n)) AS i, bytes FROM kinds) k
        JOIN parts ON parts.d = n - 1 - i AND parts.b = substr(bytes, 2 * i + 1, 2)
        JOIN empty_part ON empty_part.n = k.n
        GROUP BY g),
    counts AS (SELECT bucket, count(*) FILTER (own) AS s, count(*) FILTER (NOT own) AS t FROM grams JOIN buckets USING (g) GROUP BY bucket),
    totals AS (SELECT CAST(sum(s) AS BIGINT) AS ss, CAST(sum(t) AS BIGINT) AS tt FROM counts),
    gains AS (
        SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (ss + 10000) AS DOUBLE) / CAST((s + 1) * (tt + 10000) AS DOUBLE))) AS BIGINT) AS gain
        FROM counts, totals),
    weights AS (
        SELECT id, CAST(sum(gain) AS BIGINT) AS weight, count(*) AS n_features
        FROM grams JOIN buckets USING (g) JOIN gains USING (bucket) WHERE own GROUP BY id),
    scored AS (
        SELECT id AS doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
               coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
                   (CAST('0x' || substr(sha256('42:' || id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
        FROM words LEFT JOIN weights USING (id) WHERE own),
    places AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * n // 100 THEN place END AS rank
    FROM scored LEFT JOIN places USING (doc_id)"""


@query("op12_target_resampling", TARGET_SQL)
def op12_target_resampling(spark: SparkSession, sf: str) -> DataFrame:
    scores = targetresampling.scored(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return targetresampling.ranked(scores).select("doc_id", "n_features", "weight", "score", "rank")


@query("op13_token_counts")
def op13_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return piececounts.token_counts(table(spark, sf, "documents"))
