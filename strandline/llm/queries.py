"""Registered queries of this package, each with its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from strandline.llm import (
    audit,
    binary,
    chunk_codec,
    licenses,
    line_dedup,
    minhash,
    mixing,
    negatives,
    packing,
    quality,
    substring_dedup,
    suffix_dedup,
    topk,
)
from strandline.session import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_pack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), with_ids=False)


def op2_lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(docs)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


LINES = r"""
WITH lines AS (
  SELECT doc_id, i - 1 AS line, ls[i] AS full_line,
         list_filter(string_split_regex(ls[i], '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM (SELECT doc_id, ls, unnest(generate_series(1, len(ls))) AS i
        FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))
), worded AS (
  SELECT doc_id, line, w, len(w) AS n, array_to_string(w, ' ') AS x FROM lines WHERE len(w) > 0
), firsts AS (
  SELECT x, any_value(w) AS w, any_value(n) AS n, min((doc_id, line)) AS one FROM worded GROUP BY x
), short AS (
  SELECT x, length(x) AS n, one FROM firsts WHERE n < 8 AND length(x) >= 12
), cuts AS (
  SELECT 'words' AS units, x, n, one, p, array_to_string(list_concat(w[1:p - 1], w[p + 1:]), ' ') AS v
  FROM (SELECT *, unnest(generate_series(1, n)) AS p FROM firsts WHERE n >= 8)
  UNION ALL
  SELECT 'chars', x, n, one, p, substring(x, 1, p - 1) || substring(x, p + 1)
  FROM (SELECT *, unnest(generate_series(1, n)) AS p FROM short)
), replaced AS (
  SELECT x FROM cuts QUALIFY one > min(one) OVER (PARTITION BY units, n, p, v)
), whole AS (
  SELECT 'words' AS units, x, one FROM firsts WHERE n >= 8 UNION ALL SELECT 'chars', x, one FROM short
), near AS (
  SELECT x FROM replaced
  UNION SELECT CASE WHEN c.one > f.one THEN c.x ELSE f.x END
  FROM cuts c JOIN whole f ON f.x = c.v AND f.units = c.units
), gone AS (
  SELECT doc_id, line FROM worded JOIN firsts USING (x)
  WHERE (doc_id, line) > one OR x IN (SELECT x FROM near)
), kept AS (
  SELECT doc_id, count(*) AS n_lines, count(gone.line) AS n_removed,
         coalesce(string_agg(full_line, chr(10) ORDER BY line) FILTER (gone.line IS NULL), '') AS t
  FROM lines LEFT JOIN gone USING (doc_id, line) GROUP BY doc_id
)
SELECT doc_id, CASE WHEN text IS NULL THEN 0 ELSE n_lines END AS n_lines, n_removed,
       CASE WHEN text IS NULL THEN NULL ELSE sha256(t) END AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""


def op3_substring(spark: SparkSession, folder: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, folder, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SUBSTRING = r"""
WITH words AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), starts AS (
  SELECT doc_id, unnest(generate_series(1, len(w) - 34)) AS i, w FROM words WHERE len(w) >= 35
), windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM starts
), repeated AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY h) > 1
), gone AS (
  SELECT doc_id, list(DISTINCT p) AS places
  FROM (SELECT doc_id, unnest(generate_series(i, i + 34)) AS p FROM repeated) GROUP BY doc_id
), kept AS (
  SELECT doc_id, len(w) AS n_words, coalesce(len(places), 0) AS n_removed,
         list_filter(w, lambda x, p: NOT list_contains(coalesce(places, []), p)) AS k
  FROM words LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, n_words, n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept
"""


def op4_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def _template_rows() -> str:
    rows = []
    for name, text in licenses.TEMPLATES.items():
        grams = ", ".join(f"'{g}'" for g in licenses.template_bigrams(text))
        rows.append(f"('{name}', {len(licenses.template_words(text)) - 1}, [{grams}])")
    return ", ".join(rows)


LICENSES = rf"""
WITH templates(license, m, t) AS (VALUES {_template_rows()}),
blocks AS (
  SELECT doc_id, unnest(list_distinct(list_concat(
    string_split(text, chr(10)), string_split_regex(text, '\n[ \t\r]*\n'), [text]))) AS block
  FROM documents
), words AS (
  SELECT doc_id, string_split(trim(regexp_replace(lower(block), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM blocks
), grams AS (
  SELECT doc_id, list_distinct(list_transform(
    generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) AS g
  FROM words WHERE len(w) > 1
), matches AS (
  SELECT doc_id, license, 2.0::DOUBLE * len(list_intersect(g, t)) / (len(g) + len(t)) AS dice
  FROM grams, templates
), whole AS (
  SELECT doc_id, string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM documents
), ordered AS (
  SELECT doc_id, list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]) AS b
  FROM whole WHERE len(w) > 1
), likely AS (
  SELECT doc_id, b, license, m, t FROM ordered JOIN templates ON len(b) >= m AND len(list_intersect(b, t)) > 0.6 * len(t)
), starts AS (
  SELECT doc_id, license, s, list_distinct(b[s:s + m - 1]) AS g, t
  FROM (SELECT *, unnest(generate_series(1, len(b) - m + 1)) AS s FROM likely)
), windows AS (
  SELECT doc_id, license, s, 2.0::DOUBLE * len(list_intersect(g, t)) / (len(g) + len(t)) AS dice FROM starts
), places AS (
  SELECT doc_id, license, dice, s - coalesce(lag(s) OVER (PARTITION BY doc_id, license ORDER BY s), -1) > 1 AS fresh
  FROM windows WHERE dice >= {licenses.THRESHOLD}
), hits AS (
  SELECT doc_id, license, 1 AS n_blocks, 0 AS n_places, dice FROM matches WHERE dice >= {licenses.THRESHOLD}
  UNION ALL SELECT doc_id, license, 0, fresh::INT, dice FROM places
)
SELECT doc_id, license, sum(n_blocks)::BIGINT AS n_blocks, sum(n_places)::BIGINT AS n_places, max(dice) AS dice
FROM hits GROUP BY doc_id, license
"""


def op5_mix(spark: SparkSession, folder: str) -> DataFrame:
    out = mixing.mix(
        table(spark, folder, "documents"),
        table(spark, folder, "labels"),
        mixing.label_domain(),
        {"good": 1.25, "plain": 0.75, "toxic": 0.25},
        carried=["doc_id", "source"],
    )
    return out.select("doc_id", "source", "mix__.*")


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    # the texts themselves are not needed behind the metrics
    metrics = quality.judge(docs, carried=["doc_id", "source"])
    return metrics.select("doc_id", "quality__.*")


QUALITY = r"""
WITH texts AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM texts WHERE len(w) >= 3)
), repeated AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, x) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY doc_id
), base AS (
  SELECT doc_id, source, len(w) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM texts LEFT JOIN covered USING (doc_id)
), failed AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base
), hosts AS (
  SELECT source, count(*) AS n, count_if(base_failed) AS f FROM failed GROUP BY source
), sums AS (
  SELECT sum(n) AS total, sum(f) / sum(n) AS mean, sum(f * f / n) AS squares, count(*) AS hosts FROM hosts
), priors AS (
  SELECT mean, squares / total - mean * mean - mean * (1 - mean) * hosts / total AS spread FROM sums
), strengths AS (
  SELECT mean, CASE WHEN spread > 0 THEN least(1e6, greatest(1, mean * (1 - mean) / spread - 1))
                    ELSE 1e6 END AS strength FROM priors
), verdicts AS (
  SELECT source, (f + mean * strength) / (n + strength) > 0.5 AS rejected FROM hosts, strengths
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rejected AS kept
FROM failed JOIN verdicts ON failed.source IS NOT DISTINCT FROM verdicts.source
"""


def op7_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


NEAR = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k
  FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY u, v
), links AS (
  SELECT u, v FROM shared JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
  WHERE 100 * k >= 75 * (x.n + y.n - k)
), reach(node, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT node, v FROM reach JOIN links ON other = u
), roots AS (
  SELECT node AS doc_id, min(other) AS component_id FROM reach GROUP BY node
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM roots LEFT JOIN sizes USING (doc_id)
"""


def op8_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(table(spark, folder, "embeddings"), "vec_id % 20 = 0", 20)


TOPK = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[]) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id, score
FROM scored QUALIFY rank <= 20
"""


def op9_suffix(spark: SparkSession, folder: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, folder, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_binary(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "shards")
    binary.write_shards(table(spark, folder, "documents"), path)
    return binary.read_shards(spark, path)


def op11_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit.interactions(
        table(spark, folder, "documents"),
        table(spark, folder, "labels"),
        {"good_lost": "quality = 1", "toxic_lost": "toxic = 1"},
    )


AUDIT = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), marks AS (
  SELECT doc_id, max((quality = 1)::INTEGER) AS good, max((toxic = 1)::INTEGER) AS toxic FROM labels GROUP BY doc_id
), failed AS (
  SELECT part, doc_id, len(w) < 50 AS fa, 100 * len(list_distinct(w)) < 65 * len(w) AS fb,
         100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) AS fc,
         regexp_matches(t, '[#$%&*|]') AS fd,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), FALSE) AS fe
  FROM texts
), masks AS (
  SELECT part, concat(CASE WHEN fa THEN 'A' END, CASE WHEN fb THEN 'B' END, CASE WHEN fc THEN 'C' END,
                      CASE WHEN fd THEN 'D' END, CASE WHEN fe THEN 'E' END) AS fails,
         count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM failed LEFT JOIN marks USING (doc_id) GROUP BY ALL
), letters(l) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM letters a JOIN letters b ON b.l <> a.l JOIN letters c ON c.l NOT IN (a.l, b.l)
  JOIN letters d ON d.l NOT IN (a.l, b.l, c.l) JOIN letters e ON e.l NOT IN (a.l, b.l, c.l, d.l)
), steps AS (
  SELECT filter_order, step, filter_order[step] AS f, filter_order[1:step - 1] AS before
  FROM (SELECT filter_order, unnest(generate_series(1, 5))::INTEGER AS step FROM orders)
), counts AS (
  SELECT part, filter_order, step, f,
         sum(n) FILTER (translate(fails, before || f, '') = fails) AS kept,
         sum(n) FILTER (contains(fails, f) AND translate(fails, before, '') = fails) AS removed,
         sum(n) FILTER (contains(fails, f) AND translate(fails, before, '') <> fails) AS redundant,
         sum(n) FILTER (fails = f) AS unique_fails,
         sum(good) FILTER (contains(fails, f) AND translate(fails, before, '') = fails) AS good_lost,
         sum(toxic) FILTER (contains(fails, f) AND translate(fails, before, '') = fails) AS toxic_lost
  FROM masks, steps GROUP BY ALL
)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       sum(coalesce(removed, 0)) OVER (PARTITION BY part, f)::BIGINT AS shapley
FROM counts
"""


def op12_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", moved), "vec_id % 50 = 0")


NEGATIVES = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
         CAST(list_inner_product(a.v::DOUBLE[], b.v::DOUBLE[]) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


def op13_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return chunk_codec.encode_documents(table(spark, folder, "documents"), digests=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pack": op1_pack,
    "op2_lines": op2_lines,
    "op3_substring": op3_substring,
    "op4_licenses": op4_licenses,
    "op5_mix": op5_mix,
    "op6_quality": op6_quality,
    "op7_minhash": op7_minhash,
    "op8_topk": op8_topk,
    "op9_suffix": op9_suffix,
    "op10_binary": op10_binary,
    "op11_audit": op11_audit,
    "op12_negatives": op12_negatives,
    "op13_chunks": op13_chunks,
    "pipeline": corpus_pipeline.run,
}

TWINS: dict[str, str] = {
    "op2_lines": LINES,
    "op3_substring": SUBSTRING,
    "op4_licenses": LICENSES,
    "op6_quality": QUALITY,
    "op7_minhash": NEAR,
    "op8_topk": TOPK,
    "op11_audit": AUDIT,
    "op12_negatives": NEGATIVES,
}
