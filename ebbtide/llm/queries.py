"""The registered queries of the corpus operators, with the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import (
    alignment, exact_dedup, hard_negatives, html_text, licenses, mixing, ngram_join, packing, quality, secrets, simhash,
    substring_dedup, toxicity)
from .common import ROW, read, stored_rows


def _of_kind(found: Column, kind: str) -> Column:
    return F.filter(found, lambda s: s["kind"] == kind)


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = F.col("found")
    kinds = [rule.name for rule in secrets.BASE]
    base = F.filter(found, lambda s: s["rank"] < len(kinds))
    counts = [F.size(_of_kind(found, k)).cast("long").alias(f"n_{k}") for k in kinds]
    return secrets.scan(read(spark, folder, "documents")).select(
        "doc_id", *counts, F.sha2(F.encode(secrets.written(base), "UTF-8"), 256).alias("base_sha256"),
        secrets.written(found).alias("spans"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    model = toxicity.fit(docs, read(spark, folder, "labels"))
    return toxicity.score(docs, model, "doc_id").select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    names = F.array_join(F.transform("licenses", lambda x: x["license"]), ",")
    best = F.coalesce(F.array_max(F.transform("licenses", lambda x: x["score"])), F.lit(0.0))
    return licenses.in_texts(read(spark, folder, "documents")).select(
        "doc_id", names.alias("licenses"), F.size("licenses").cast("long").alias("n_licenses"),
        F.round(best, 6).alias("best_score"))


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.plan(read(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("n_copies")).alias("taken"))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(read(spark, folder, "documents")).drop("distance")


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.deduplicate(read(spark, folder, "documents"))


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    near = simhash.near_groups(docs.withColumn(ROW, F.monotonically_increasing_id()))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return near.select("doc_id", digits.alias("fingerprint"), "component_id")


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = stored_rows(read(spark, folder, "documents").select("doc_id", "text"), "documents")
    return exact_dedup.exact_groups(rows).drop(ROW)


def op10_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(read(spark, folder, "pages"))


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))


def op12_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_groups(read(spark, folder, "documents"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mine(read(spark, folder, "embeddings"))


WORDS_SQL = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

OWN = {name: licenses.bigrams_of(text) for name, text in licenses.TEMPLATES.items()}
TEMPLATES_SQL = ", ".join(
    f"('{name}', [{', '.join(map(repr, own))}], {licenses.bounds(own)[0]}, {licenses.bounds(own)[1]})" for name, own in OWN.items())

SQL = {
    "op3_license_scan": rf"""
WITH templates(license, own, fewest, longest) AS (VALUES {TEMPLATES_SQL}),
rows AS (SELECT row_number() OVER () AS i, doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT i, [x for x in regexp_split_to_array(lower(regexp_replace(
            text, '(?im)^[^a-z0-9]*copyright\b[^\n]*$', '', 'g')), '[^a-z0-9]+') if x <> ''] AS w FROM rows),
pairs AS (SELECT i, [w[k] || ' ' || w[k + 1] for k in range(1, len(w))] AS p FROM words),
near AS (SELECT i, p, t.* FROM pairs, templates t WHERE len(list_intersect(p, own)) >= fewest),
hits AS (SELECT *, [k for k in range(1, len(p) + 1) if list_contains(own, p[k])] AS hit FROM near),
ends AS (SELECT *, unnest(hit) AS b FROM (SELECT *, unnest(hit) AS a FROM hits)),
runs AS (SELECT i, license, own, p[a:b] AS run FROM ends WHERE b >= a AND b - a < longest),
scores AS (SELECT i, license, 2.0::DOUBLE * len(list_intersect(run, own)) / (len(list_distinct(run)) + len(own)) AS score FROM runs),
found AS (SELECT i, license, max(score) AS score FROM scores WHERE score >= 0.8 GROUP BY ALL)
SELECT doc_id, coalesce(string_agg(license, ',' ORDER BY license), '') AS licenses,
       count(license)::BIGINT AS n_licenses, round(coalesce(max(score), 0), 6) AS best_score
FROM rows LEFT JOIN found USING (i) GROUP BY i, doc_id""",
    "op4_mixing": f"""
WITH sizes AS (SELECT doc_id, source, {WORDS_SQL}::BIGINT AS size FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
ranked AS (SELECT *, ([5.0, 2.0, 1.0]::DOUBLE[])[1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT] AS w,
                  (3 * source_size)::DOUBLE AS most FROM totals),
summed AS (SELECT *, (sum(source_size) OVER ())::DOUBLE AS total, sum(w) OVER () AS ws,
                  coalesce(sum(most) OVER b, 0) AS most_before, coalesce(sum(w) OVER b, 0) AS w_before FROM ranked
           WINDOW b AS (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
filled AS (SELECT *, most / w <= (total - most_before) / (ws - w_before) AS is_full FROM summed),
targets AS (SELECT source, source_size, CASE WHEN is_full THEN most ELSE
                   (total - sum(CASE WHEN is_full THEN most ELSE 0 END) OVER ())
                   / nullif(ws - sum(CASE WHEN is_full THEN w ELSE 0 END) OVER (), 0) * w END AS target FROM filled),
rated AS (SELECT s.doc_id, s.size, t.source_size, t.target,
                 CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
                 ('0x' || md5('17:' || coalesce(doc_id::VARCHAR, ''))[1:13])::BIGINT::DOUBLE / 4503599627370496 AS chance
          FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN chance < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM rated""",
    "op9_exact_dedup": """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256 FROM d WINDOW g AS (PARTITION BY t)""",
    "op12_ngram_join": r"""
WITH RECURSIVE words AS (SELECT row_number() OVER () AS i, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT i, doc_id, list_distinct([w[k : least(k + 2, len(w))] for k in range(1, greatest(len(w) - 2, least(len(w), 1)) + 1)]) AS own FROM words),
listed AS (SELECT i, len(own) AS n, unnest(own) AS shingle FROM sets),
links AS (SELECT a.i AS u, b.i AS v FROM listed a JOIN listed b USING (shingle) WHERE a.i <> b.i GROUP BY a.i, b.i, a.n, b.n
          HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach(i, j) AS (SELECT i, i FROM sets UNION SELECT r.i, l.v FROM reach r JOIN links l ON l.u = r.j)
SELECT s.doc_id, len(s.own)::BIGINT AS n_shingles, min(t.doc_id) AS component_id
FROM sets s JOIN reach r ON r.i = s.i JOIN sets t ON t.i = r.j GROUP BY s.i, s.doc_id, s.own""",
    "op13_hard_negatives": """
WITH rows AS (SELECT row_number() OVER () AS i, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                     [floor(256 * x::DOUBLE) for x in embedding] AS v FROM embeddings
              WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (SELECT a.i AS anchor, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
           FROM rows a JOIN rows b ON a.i <> b.i WHERE a.vec_id % 100 = 0),
near AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS k FROM scored WHERE same),
far AS (SELECT n.anchor_id, n.vec_id AS positive_id, s.vec_id AS negative_id, n.score AS positive_score, s.score AS negative_score,
               row_number() OVER (PARTITION BY n.anchor, n.k ORDER BY s.score DESC, s.vec_id) AS rank
        FROM near n JOIN scored s ON s.anchor = n.anchor AND NOT s.same WHERE n.k <= 5
         AND 30 * n.score <= 100 * s.score AND 100 * s.score <= 90 * n.score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM far WHERE rank <= 10""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    found = {name: f for name, f in globals().items() if name.startswith("op") and "_" in name}
    return {**found, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    return SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
