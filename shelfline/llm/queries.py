"""The registered queries of the operators: each applies one, with its
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import (
    ann,
    bpe,
    common,
    decontamination,
    hadamard_clusters,
    hard_negatives,
    huffman,
    language_id,
    license_scan,
    line_dedup,
    pii,
    simhash_dedup,
    source_mix,
    url_filter,
)

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_decontamination(spark: SparkSession, root: str) -> DataFrame:
    common.prepare(spark)
    found = decontamination.judge(decontamination.find_matches(
        common.table(spark, root, "documents"), common.table(spark, root, "benchmark"),
        ["doc_id"], window=13))
    names = F.sort_array(F.transform("items", lambda i: i.cast("string")))
    return found.select("row.doc_id", "n_words", "n_hit",
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
                        "contaminated")


def op2_ann(spark: SparkSession, root: str) -> DataFrame:
    common.prepare(spark)
    vectors = common.table(spark, root, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op3_language_id(spark: SparkSession, root: str) -> DataFrame:
    common.prepare(spark)
    docs = common.table(spark, root, "documents")
    found = language_id.label(docs, language_id.fit(docs), ["doc_id"], with_runs=False)
    return found.select("row.doc_id", language_id.held_out("row.doc_id").alias("held_out"),
                        "lang_pred", "score")


def op4_huffman_ids(spark: SparkSession, root: str) -> DataFrame:
    common.prepare(spark)
    files = huffman.write_ids(common.table(spark, root, "documents"), TOKENIZER,
                              common.shared_folder(spark), end_id=1)
    return huffman.document_digests(spark, files)


def op5_bpe(spark: SparkSession, root: str) -> DataFrame:
    common.prepare(spark)
    docs = common.table(spark, root, "documents")
    return bpe.digests(bpe.encode_and_decode(docs, TOKENIZER))


def op6_url_filter(spark: SparkSession, root: str) -> DataFrame:
    common.prepare(spark)
    model = url_filter.train(url_filter.labelled_urls(spark))
    return url_filter.judge(common.table(spark, root, "pages"), model)


def op7_simhash_dedup(spark: SparkSession, root: str) -> DataFrame:
    common.prepare(spark)
    return simhash_dedup.near_duplicates(common.table(spark, root, "documents"),
                                         shingle=3, most=3)


def op8_license_scan(spark: SparkSession, root: str) -> DataFrame:
    common.prepare(spark)
    return license_scan.scan(common.table(spark, root, "documents"), least=0.8)


def op9_pii(spark: SparkSession, root: str) -> DataFrame:
    common.prepare(spark)
    found = pii.sanitise(common.table(spark, root, "documents"))
    base = F.filter("spans", lambda x: x["kind"] < 4)
    counts = [F.expr(f"cast(size(filter(spans, x -> x.kind = {k})) as bigint)").alias(f"n_{name}")
              for k, name in enumerate(pii.KINDS)]
    names = [*pii.KINDS, "term", "term"]
    return found.select("doc_id", *counts, F.sha2(pii.as_text(base, names), 256)
                        .alias("base_sha256"), pii.as_text(F.col("spans"), names).alias("spans"))


def op10_line_dedup(spark: SparkSession, root: str) -> DataFrame:
    common.prepare(spark)
    found = line_dedup.dedup_lines(common.table(spark, root, "documents"),
                                   most=None, similarity=0.8)
    return found.select("row.doc_id", "row.text", "n_lines", "n_removed")


def op11_hard_negatives(spark: SparkSession, root: str) -> DataFrame:
    common.prepare(spark)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(common.table(spark, root, "embeddings"),
                               F.col("vec_id") % 50 == 0, relabel=label)


def op12_hadamard_clusters(spark: SparkSession, root: str) -> DataFrame:
    common.prepare(spark)
    found, centres = hadamard_clusters.cluster(common.table(spark, root, "embeddings"))
    return hadamard_clusters.with_inertia(found, centres).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia",
        F.sha2("centre", 256).alias("centroid_sha256"))


def op13_source_mix(spark: SparkSession, root: str) -> DataFrame:
    common.prepare(spark)
    mixed = source_mix.mix(common.table(spark, root, "documents"), weights=(5, 2, 1), cap=3)
    return mixed.select("row.doc_id", "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).alias("taken"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_decontamination, op2_ann, op3_language_id, op4_huffman_ids, op5_bpe,
        op6_url_filter, op7_simhash_dedup, op8_license_scan, op9_pii, op10_line_dedup,
        op11_hard_negatives, op12_hadamard_clusters, op13_source_mix)}

WORDS = r"""regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP1_SQL = f"""
WITH items AS (
    SELECT item_id, w, least(len(w), 13) AS n
    FROM (SELECT item_id, {WORDS} AS w FROM benchmark) WHERE len(w) > 0),
windows AS (
    SELECT item_id, n, unnest([array_to_string(w[i:i + n - 1], ' ')
                               FOR i IN range(1, len(w) - n + 2)]) AS gram FROM items),
docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce({WORDS}, []) AS w FROM documents),
grams AS (
    SELECT r, n, unnest(range(1, len(w) - n + 2)) AS i,
        unnest([array_to_string(w[i:i + n - 1], ' ') FOR i IN range(1, len(w) - n + 2)]) AS gram
    FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
hits AS (SELECT DISTINCT r, i, g.n, item_id FROM grams g JOIN windows USING (n, gram)),
words AS (
    SELECT r, count(DISTINCT i + j) AS n_hit
    FROM (SELECT r, i, unnest(range(n)) AS j FROM hits) GROUP BY r),
named AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN named USING (r)
"""

_FINITE = """embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

OP11_SQL = f"""
WITH kept AS (
    SELECT row_number() OVER () AS r, vec_id,
        CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE label IS NOT NULL AND {_FINITE}),
scored AS (
    SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS alike,
        CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT)
            AS score
    FROM kept a JOIN kept b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
positives AS (
    SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS place
    FROM scored WHERE alike QUALIFY place <= 5),
negatives AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id,
        p.score AS positive_score, n.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY n.score DESC, n.vec_id) AS rank
    FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.alike
        AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score,
    negative_score
FROM negatives WHERE rank <= 3
"""


def _op12_sql(clusters: int = 8, rounds: int = 10) -> str:
    """Every round spelled out: distances to all centroids, then exact means."""
    parts = [f"""
kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id,
        list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE len(embedding) = 64 AND {_FINITE}),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS cluster, v AS c FROM kept
    QUALIFY cluster < {clusters})"""]
    for i in range(rounds + 1):
        parts.append(f"""
a{i} AS MATERIALIZED (
    SELECT r, cluster, d FROM (
        SELECT r, cluster, CAST(list_sum(list_transform(range(1, 65),
            lambda j: (v[j] - c[j]) * (v[j] - c[j]))) AS BIGINT) AS d FROM kept, c{i})
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, cluster) = 1)""")
        if i < rounds:
            parts.append(f"""
s{i} AS (
    SELECT cluster, j, sum(x) AS t, count(*) AS n
    FROM (SELECT cluster, unnest(v) AS x, unnest(range(64)) AS j FROM a{i} JOIN kept USING (r))
    GROUP BY cluster, j),
c{i + 1} AS MATERIALIZED (
    SELECT cluster, coalesce(m, c) AS c FROM c{i} LEFT JOIN (
        SELECT cluster, list(CAST((t - ((t % n) + n) % n) // n AS BIGINT) ORDER BY j) AS m
        FROM s{i} GROUP BY cluster) USING (cluster))""")
    return f"""WITH {",".join(parts)}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, d AS distance,
    CAST(sum(d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
    CAST(sum(d) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN c{rounds} USING (cluster)"""


# Each pass of the recursion caps the sources whose share of the rest is above three times
# their size.
OP13_SQL = r"""
WITH RECURSIVE docs AS MATERIALIZED (
    SELECT doc_id, source, coalesce(text, '') AS t,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
    FROM documents),
sources AS MATERIALIZED (
    SELECT source, CAST(sum(size) AS BIGINT) AS s,
        [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
    FROM docs GROUP BY source),
shares AS (
    SELECT 0 AS pass, source, s, w, false AS capped, sum(s) OVER () AS rest, sum(w) OVER () AS ws
    FROM sources
    UNION ALL
    SELECT pass + 1, source, s, w, now,
        sum(s) OVER () - 3 * sum(CASE WHEN now THEN s ELSE 0 END) OVER (),
        sum(CASE WHEN now THEN 0 ELSE w END) OVER ()
    FROM (SELECT *, capped OR w * rest > 3 * s * ws AS now FROM shares
          QUALIFY bool_or(now <> capped) OVER ())),
targets AS (
    SELECT source, s, CASE WHEN capped THEN 3.0::DOUBLE * s
        ELSE CAST(w * rest AS DOUBLE) / CAST(ws AS DOUBLE) END AS target
    FROM shares WHERE pass = (SELECT max(pass) FROM shares)),
rates AS (
    SELECT doc_id, size, s, target,
        CASE WHEN s > 0 THEN least(target / CAST(s AS DOUBLE), 3.0::DOUBLE) ELSE 0.0::DOUBLE END
            AS rate,
        CAST('0x' || substr(sha256('13:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':'
            || sha256(t)), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS coin
    FROM docs JOIN targets ON docs.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, s AS source_size, target,
    CAST(size * (floor(rate) + CASE WHEN coin < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT)
        AS taken
FROM rates
"""

ORACLE_SQL: dict[str, str] = {
    "op1_decontamination": OP1_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op12_hadamard_clusters": _op12_sql(),
    "op13_source_mix": OP13_SQL,
}
