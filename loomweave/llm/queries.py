"""Registered queries of this package: name -> (spark, sf_dir) -> DataFrame, and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomweave.llm.io import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    from loomweave.llm import pack_gga

    out = pack_gga.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak-label posterior and quality score of every document."""
    from loomweave.llm import weak_quality

    return weak_quality.quality(table(spark, sf_dir, "documents"))


@query
def op3_ann_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors found for every row whose vec_id is divisible by 50."""
    from loomweave.llm import ann_forest

    return ann_forest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    from loomweave.llm import simhash_gph

    out = simhash_gph.near_groups(table(spark, sf_dir, "documents"), n=3, distance=3)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicate groups of all documents; the largest doc_id stays."""
    from loomweave.llm import chunk_dedup

    out = chunk_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op5_exact_dedup"] = f"""
WITH t AS (SELECT doc_id, sha256({_AZ}) AS text_sha256, {_AZ} AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY norm)
"""


@query
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from loomweave.llm import html_consensus

    return html_consensus.main_text(table(spark, sf_dir, "pages"))


@query
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    from loomweave.llm import pii_boost

    return pii_boost.personal_data(table(spark, sf_dir, "documents"))


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; learned from documents that are not held out."""
    from loomweave.llm import lang_kn

    docs = table(spark, sf_dir, "documents")
    out = lang_kn.predict(docs, lang_kn.train(docs))
    return out.select("doc_id", "held_out", "lang_pred", "score", "accepted")


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    from loomweave.llm import token_counts

    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query
def op10_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to source weights 3, 1, 2 over 150 % of all words."""
    from loomweave.llm import pareto_mix

    out = pareto_mix.mix(table(spark, sf_dir, "documents"), weights=(3.0, 1.0, 2.0), total_share=1.5, most_copies=2)
    return out.select("doc_id", "size", "source_size", "target", "taken", "copies")


def _pareto_sql(top_ups: int = 2, seed: str = "mix:") -> str:
    turns = []
    for k in range(1 + top_ups):
        if k == 0:
            turns.append("r0 AS (SELECT *, odds IS NOT NULL AS open, remain AS need FROM q0)")
        else:
            turns.append(f"""r{k} AS (SELECT q{k}.* EXCLUDE (open, need, ahead),
                remain - sum(extra * size) OVER (PARTITION BY source) AS need,
                odds IS NOT NULL AND extra = 0 AND size <= remain - sum(extra * size) OVER (PARTITION BY source) AS open FROM q{k})""")
        turns.append(f"""s{k} AS (SELECT *, coalesce(sum(CASE WHEN open THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY NOT open, odds, doc_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM r{k})""")
        turns.append(f"q{k + 1} AS (SELECT * REPLACE (extra + CASE WHEN open AND 2 * ahead + size <= 2 * need THEN 1 ELSE 0 END AS extra) FROM s{k})")
    return f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
z AS (SELECT *, CAST(length(bin(size + 1)) - 1 AS BIGINT) AS z FROM d),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(sum(size * z) AS BIGINT) AS z_sum,
        min(CASE WHEN size > 0 THEN z END) AS z_min, max(z) AS z_max FROM z GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w,
      source_size * 2.0::DOUBLE AS cap FROM src),
lv AS (SELECT *, ((SELECT sum(source_size) FROM src) * 1.5::DOUBLE
        - coalesce(sum(cap) OVER (ORDER BY cap / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(w) OVER (ORDER BY cap / w, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
g AS (SELECT source, source_size, z_sum, z_min, z_max, CASE WHEN source_size = 0 THEN 0 ELSE
        coalesce(least(cap, (SELECT max(level) FROM lv WHERE level <= cap / w) * w), cap) END AS target FROM lv),
p AS (SELECT *, CAST(CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size) END AS BIGINT) AS sure FROM g),
f AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE target / source_size - sure END AS f,
        CASE WHEN source_size = 0 THEN 0 ELSE target - sure * source_size END AS remain,
        z_sum::DOUBLE / source_size AS mid FROM p),
i AS (SELECT z.*, f.source_size, f.target, f.sure, f.remain, f.f,
        f.f * (1 + (1 - f.f) * (CASE WHEN greatest(z_max - mid, mid - z_min) > 0 THEN (z.z - mid) / greatest(z_max - mid, mid - z_min) ELSE 0 END)) AS pi,
        (CAST('0x' || substr(md5('{seed}' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT)::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
      FROM z JOIN f ON z.source IS NOT DISTINCT FROM f.source),
q0 AS (SELECT doc_id, source, size, source_size, target, sure, remain, 0 AS extra,
        CASE WHEN pi > 0 AND pi < 1 AND size > 0 THEN (u / (1 - u)) / (pi / (1 - pi)) END AS odds FROM i),
{', '.join(turns)}
SELECT doc_id, size, source_size, target, CAST(CASE WHEN size > 0 THEN (sure + extra) * size ELSE 0 END AS BIGINT) AS taken,
       CAST(CASE WHEN size > 0 THEN sure + extra ELSE 0 END AS BIGINT) AS copies
FROM q{top_ups + 1}
"""


ORACLE["op10_pareto_mix"] = _pareto_sql()


@query
def op11_topk_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest integer inner products of every row whose vec_id is divisible by 50."""
    from loomweave.llm import topk_blocks

    return topk_blocks.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256.0)


_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

ORACLE["op11_topk_blocks"] = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
           FROM embeddings WHERE vec_id IS NOT NULL AND {_FINITE}),
s AS (SELECT q.vec_id AS query_id, c.vec_id, max(CAST(list_sum(list_transform(list_zip(q.w, c.w, true), lambda p: p[1] * p[2])) AS BIGINT)) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query
def op12_qdwh_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors whitened by the first 32 components of their covariance."""
    from loomweave.llm import qdwh_whiten

    return qdwh_whiten.whiten(table(spark, sf_dir, "embeddings"), components=32)


@query
def op13_sharded_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors of 64 components in 8 clusters after 10 rounds."""
    from loomweave.llm import lloyd_shards

    return lloyd_shards.clusters(table(spark, sf_dir, "embeddings"), k=8, rounds=10, dimensions=64)


def _lloyd_sql(k: int = 8, rounds: int = 10) -> str:
    turns = []
    for r in range(rounds + 1):
        turns.append(f"""a{r} AS MATERIALIZED (SELECT v.row, min(struct_pack(d := CAST(list_sum(list_transform(list_zip(v.w, c.w), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT),
            c := c.cluster)) AS best FROM v CROSS JOIN c{r} c GROUP BY v.row)""")
        if r < rounds:
            turns.append(f"""m{r} AS (SELECT best.c AS cluster, i, CAST(floor(sum(w[i])::DOUBLE / count(*)) AS BIGINT) AS x
            FROM a{r} JOIN v USING (row) CROSS JOIN (SELECT unnest(range(1, 65)) AS i) GROUP BY ALL)""")
            turns.append(f"""c{r + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(n.w, c.w) AS w FROM c{r} c
            LEFT JOIN (SELECT cluster, list(x ORDER BY i) AS w FROM m{r} GROUP BY cluster) n USING (cluster))""")
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
       FROM embeddings WHERE len(embedding) = 64 AND {_FINITE}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), w) - 1 AS cluster, w FROM v ORDER BY 1 LIMIT {k}),
{', '.join(turns)}
SELECT v.vec_id, CAST(best.c AS INTEGER) AS cluster, best.d AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.w, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (row) JOIN c{rounds} c ON c.cluster = best.c
"""


ORACLE["op13_sharded_lloyd"] = _lloyd_sql()
