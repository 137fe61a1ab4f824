"""The driver queries of this subpackage and their SQL oracles.

Each query applies its operator, with production parameters, to the whole
table and derives the contract's columns from the operator's output.
"""

from __future__ import annotations

from airtrace.llm.common import fold, load
from airtrace.llm.exact_dedup import exact_groups
from airtrace.llm.fingerprints import digest, edited_fingerprints
from airtrace.llm.importance import (
    BUCKETS,
    LEAST_WORDS,
    PERCENT,
    resample,
)
from airtrace.llm.importance import SEED as DRAW_SEED
from airtrace.llm.langid import fit as fit_languages
from airtrace.llm.langid import identify
from airtrace.llm.maxent_lm import score_texts
from airtrace.llm.mixing import EPOCHS, SEED, TEMPERATURE, mix
from airtrace.llm.near_dups import near_groups
from airtrace.llm.packing import digested, pack
from airtrace.llm.pii import KINDS, find_personal_data, listing
from airtrace.llm.quality import fit_quality, score_quality
from airtrace.llm.token_counts import count_all
from airtrace.llm.toxicity import fit_toxicity, score_toxicity
from airtrace.llm.vafile import DIMS, ROUNDS, SCALE, K, cluster_vectors
from airtrace.llm.vafile import SEED as CLUSTER_SEED

MAX_TOKENS = 1024
QUALITY_THRESHOLD = 0.3
TOXIC_THRESHOLD = 0.5


def op1_fingerprints(spark, sf_dir):
    """Winnowed fingerprints of every text and of its edited text."""
    prints = edited_fingerprints(load(spark, sf_dir, "documents"))
    return prints.selectExpr(
        "doc_id", "n_chars", "edited_sha256", f"{digest('prints')} AS fingerprint",
        f"{digest('edited_prints')} AS edited_fingerprint", "near_edited", "near_next",
        "size(prints) AS n_prints",
    )


def op2_minhash(spark, sf_dir):
    """Near-duplicate components of all documents over 2-word shingles."""
    return near_groups(load(spark, sf_dir, "documents"), k=2)


def op3_language_id(spark, sf_dir):
    """Language of every text, learnt from two of three folds."""
    docs = load(spark, sf_dir, "documents")
    model = fit_languages(docs.where(fold("doc_id", 3) != 1))
    return identify(docs, model).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score"
    )


def op4_exact_dedup(spark, sf_dir):
    """Groups of texts that are equal without their white space."""
    return exact_groups(load(spark, sf_dir, "documents"), hash_all=True)


def op5_mix_sources(spark, sf_dir):
    """Every copy that the mix holds of each document, and its place.

    The digest is taken of the texts as they arrive from the global shuffle.
    """
    return mix(load(spark, sf_dir, "documents")).selectExpr(
        "doc_id", "copy", "source", "n_chars", "position", "sha2(coalesce(text, ''), 256) AS text_sha256"
    )


def op6_quality(spark, sf_dir):
    """Quality of every text by compression, learnt from four of five folds."""
    docs = load(spark, sf_dir, "documents")
    model = fit_quality(docs, load(spark, sf_dir, "labels"), where=fold("_id", 5) != 0,
                        dictionary_where=fold("_id", 5) != 4)
    scored = score_quality(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
        (scored["score"] >= QUALITY_THRESHOLD).cast("int").alias("predicted"),
    )


def op7_toxicity(spark, sf_dir):
    """Toxicity of every text, learnt from four of five folds."""
    docs = load(spark, sf_dir, "documents")
    model = fit_toxicity(docs, load(spark, sf_dir, "labels"), where=fold("_id", 5) != 0,
                         part=fold("_id", 5) - 1)
    scored = score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
        (scored["score"] >= TOXIC_THRESHOLD).cast("int").alias("predicted"),
    )


def op8_pack(spark, sf_dir):
    """Pieces of all documents, packed best-fit after dominance reduction.

    The digest is taken of the ids as they arrive from the packing.
    """
    return digested(pack(load(spark, sf_dir, "documents"), with_ids=True))


def op9_token_counts(spark, sf_dir):
    """Token counts of all texts with the whole-token shortcut."""
    return count_all(load(spark, sf_dir, "documents")).selectExpr(
        "doc_id", "cast(octet_length(coalesce(text, '')) as bigint) AS n_bytes", "n_tokens",
        f"n_tokens > {MAX_TOKENS} AS over_limit",
    )


def op10_maxent_lm(spark, sf_dir):
    """Language-model scores of all texts, learnt from four of five folds."""
    return score_texts(load(spark, sf_dir, "documents"), fold("doc_id", 5) != 1)


def op11_importance(spark, sf_dir):
    """Documents drawn in proportion to their likeness to the benchmark."""
    return resample(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op12_pii(spark, sf_dir):
    """Personal data in every text: base spans, and those the span classifier adds."""
    found = find_personal_data(load(spark, sf_dir, "documents"))
    base = "filter(spans, s -> s.base)"
    counts = [f"cast(size(filter({base}, s -> s.kind = {k})) as bigint) AS n_{kind}" for k, kind in enumerate(KINDS)]
    return found.selectExpr(
        "doc_id", *counts, f"sha2({listing(base)}, 256) AS base_sha256", f"{listing('spans')} AS spans",
        f"cast(size(spans) - size({base}) as bigint) AS n_added",
    )


def op13_cluster(spark, sf_dir):
    """Clusters of all vectors, assigned by their cells where these decide."""
    return cluster_vectors(load(spark, sf_dir, "embeddings"))


def _cluster_sql() -> str:
    """Lloyd's rounds over whole components, one pair of CTEs a round."""
    steps = [f"""
    v AS MATERIALIZED (
      SELECT row_number() OVER () AS r, vec_id,
             list_transform(embedding, lambda c: CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS BIGINT)) AS x
      FROM embeddings
      WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda c: isfinite(c))) = {DIMS}),
    p AS MATERIALIZED (SELECT r, unnest(x) AS x, unnest(range({DIMS})) AS d FROM v),
    c0 AS MATERIALIZED (
      SELECT c, unnest(x) AS x, unnest(range({DIMS})) AS d FROM (
        SELECT row_number() OVER (ORDER BY sha256('{CLUSTER_SEED}:' || vec_id), x) - 1 AS c, x FROM v)
      WHERE c < {K})"""]
    for i in range(ROUNDS + 1):
        steps.append(f"""
    a{i} AS MATERIALIZED (
      SELECT r, min(struct_pack(dist := dist, c := c)) AS best FROM (
        SELECT p.r, c.c, sum((p.x - c.x) * (p.x - c.x)) AS dist FROM p JOIN c{i} c USING (d) GROUP BY p.r, c.c)
      GROUP BY r)""")
        if i < ROUNDS:
            steps.append(f"""
    m{i} AS MATERIALIZED (
      SELECT a.best.c AS c, p.d, sum(p.x) AS s, count(*) AS n FROM p JOIN a{i} a USING (r) GROUP BY 1, 2),
    c{i + 1} AS MATERIALIZED (
      SELECT c.c, c.d, CAST(CASE WHEN n IS NULL THEN c.x
                            ELSE (s - ((s % n) + n) % n) // n END AS BIGINT) AS x
      FROM c{i} c LEFT JOIN m{i} m ON c.c = m.c AND c.d = m.d)""")
    return "WITH " + ",".join(steps) + f"""
    , f AS (SELECT v.vec_id, a.best.c AS cluster, CAST(a.best.dist AS BIGINT) AS distance
            FROM a{ROUNDS} a JOIN v USING (r)),
    h AS (SELECT c AS cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256
          FROM c{ROUNDS} GROUP BY c)
    SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
           CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
           CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
    FROM f JOIN h USING (cluster)"""


def _importance_sql() -> str:
    """Gains of crc32 buckets; the CRC table is built by its rule."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
    WITH crc AS MATERIALIZED (
      SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, _: CASE
                 WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) g(i))),
    d AS MATERIALIZED (
      SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM documents),
    b AS MATERIALIZED (
      SELECT unnest(regexp_extract_all(
        translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
    f AS MATERIALIZED (SELECT r, unnest(w) AS w FROM d),
    k AS MATERIALIZED (
      SELECT w, xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(range(1, len(hex(encode(w))) // 2 + 1),
                     lambda i: CAST('0x' || substr(hex(encode(w)), 2 * i - 1, 2) AS BIGINT))),
        lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]))) % {BUCKETS} AS bucket
      FROM (SELECT DISTINCT w FROM (SELECT w FROM f UNION ALL SELECT w FROM b)), crc),
    s AS (SELECT bucket, count(*) AS n FROM f JOIN k USING (w) GROUP BY bucket),
    t AS (SELECT bucket, count(*) AS n FROM b JOIN k USING (w) GROUP BY bucket),
    z AS (SELECT (SELECT count(*) FROM f) AS s_all, (SELECT count(*) FROM b) AS t_all),
    g AS MATERIALIZED (
      SELECT s.bucket, CAST(floor(1000 * ln(
               CAST((coalesce(t.n, 0) + 1) * (s_all + {BUCKETS}) AS DOUBLE)
               / CAST((s.n + 1) * (t_all + {BUCKETS}) AS DOUBLE))) AS BIGINT) AS gain
      FROM s LEFT JOIN t USING (bucket), z),
    w AS (SELECT r, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM f JOIN k USING (w) JOIN g USING (bucket) GROUP BY r),
    o AS (
      SELECT r, doc_id, CAST(len(d.w) AS BIGINT) AS n_features, coalesce(w.weight, 0) AS weight,
             coalesce(w.weight, 0) + CAST(floor(-1000 * ln(-ln(
               (CAST('0x' || substr(sha256('{DRAW_SEED}:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
      FROM d LEFT JOIN w USING (r)),
    q AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
          FROM o WHERE n_features >= {LEAST_WORDS})
    SELECT doc_id, n_features, weight, score,
           CASE WHEN place <= {PERCENT} * n // 100 THEN place END AS rank
    FROM o LEFT JOIN q USING (r)"""


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_minhash": op2_minhash,
    "op3_language_id": op3_language_id,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_mix_sources": op5_mix_sources,
    "op6_quality": op6_quality,
    "op7_toxicity": op7_toxicity,
    "op8_pack": op8_pack,
    "op9_token_counts": op9_token_counts,
    "op10_maxent_lm": op10_maxent_lm,
    "op11_importance": op11_importance,
    "op12_pii": op12_pii,
    "op13_cluster": op13_cluster,
}

ORACLES = {
    "op4_exact_dedup": r"""
    WITH t AS (
      SELECT doc_id, length(coalesce(text, '')) AS n,
             sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
      FROM documents),
    g AS (
      SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
             first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id
      FROM t)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g""",
    "op5_mix_sources": f"""
    WITH RECURSIVE n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
    r AS (SELECT source, pow(n, {TEMPERATURE}) / (SELECT sum(pow(n, {TEMPERATURE})) FROM n)
                         * {EPOCHS} * (SELECT sum(n) FROM n) / n AS rate FROM n),
    cdf(source, rate, k, p, below) AS (
      SELECT source, rate, 0, exp(-rate), CAST(0 AS DOUBLE) FROM r
      UNION ALL
      SELECT source, rate, k + 1, p * rate / (k + 1), below + p FROM cdf
      WHERE k < ceil(rate + 12 * sqrt(rate) + 30)),
    d AS (SELECT *, CAST('0x' || substr(md5('{SEED}/' || doc_id), 1, 13) AS BIGINT) / pow(2, 52) AS u
          FROM documents)
    SELECT d.doc_id, CAST(cdf.k - 1 AS INTEGER) AS copy, d.source, d.n_chars,
           CAST('0x' || substr(md5('{SEED + 1}/' || d.doc_id || '/' || (cdf.k - 1)), 1, 13) AS BIGINT)
             / pow(2, 52) AS position,
           sha256(coalesce(d.text, '')) AS text_sha256
    FROM d JOIN cdf ON d.source IS NOT DISTINCT FROM cdf.source AND cdf.k > 0 AND cdf.below <= d.u""",
    "op11_importance": _importance_sql(),
    "op13_cluster": _cluster_sql(),
}
