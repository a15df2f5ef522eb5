"""Queries op1 to op13 over the given tables, and DuckDB SQL where it can express them.

Each query applies its operator with production parameters to the whole table and derives the digest columns from what the
operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podelta.llm import (conversation_repair, html_text, mixing, orchard, order_minhash, piece_codec, pii, quality_classifier,
                         quality_rules, recompression, secret_scan, simhash, url_rules)
from podelta.llm.common import read_table

MODEL = "piece_bpe_32k.model"


def model_path() -> str:
    """Where the public tokenizers' package keeps the model file; pass another path to the codec to use another."""
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def _of_kind(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text: counts of the base kinds, digest of the base spans, all spans."""
    found = secret_scan.find_secrets(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.BASE_KINDS))
    return found.select("doc_id", *(_of_kind("spans", k).alias(f"n_{k}") for k in secret_scan.BASE_KINDS),
                        F.sha2(secret_scan.render(base), 256).alias("base_sha256"),
                        secret_scan.render(F.col("spans")).alias("spans"))


def op2_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts, base rule, zstandard ratio and verdict of every text."""
    return quality_rules.assess(read_table(spark, sf_dir, "documents"))


def op3_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text by a lasso-weighted rule ensemble."""
    return quality_classifier.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by wrapper induction."""
    return html_text.main_text(read_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op5_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents replicated by Poisson draws towards sources weighted by the root of their size, globally shuffled."""
    return mixing.mix(read_table(spark, sf_dir, "documents"), copy="copy").withColumn("copy", F.col("copy").cast("long"))


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order MinHash fingerprints of every text and its edited text, and likeness to that and to the next text."""
    out = order_minhash.compare_with_edits(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"),
                      order_minhash.render(F.col("parts")).alias("fingerprint"),
                      order_minhash.render(F.col("edited_parts")).alias("edited_fingerprint"), "near_edited", "near_next")


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL by fixed and mined rules."""
    return url_rules.judge(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels"))


def op8_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and length and digest of the text that they decode to."""
    encoded = piece_codec.encode(read_table(spark, sf_dir, "documents"), model_path())
    return piece_codec.decode(encoded, model_path(), keep_ids=True).select(
        "doc_id", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids", F.length("text").cast("long").alias("n_chars"),
        F.sha2("text", 256).alias("text_sha256"))


def op9_simhash_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op10_pii_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text: counts of the base kinds, digest of the base spans, all spans."""
    found = pii.find_personal_data(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", *(_of_kind("base", k).alias(f"n_{k}") for k in pii.KINDS),
                        F.sha2(pii.render(F.col("base")), 256).alias("base_sha256"), pii.render(F.col("spans")).alias("spans"))


def op11_weighted_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest structure repair of every damaged conversation."""
    given = read_table(spark, sf_dir, "conversations")
    return conversation_repair.repair(conversation_repair.damage(given), given)


def op12_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every text, those that repeated windows cover, and the digest of the text without them."""
    kept = recompression.dedup(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op13_orchard_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster and squared distance of every vector, inertia, and the digest of its centroid."""
    return orchard.with_inertia(*orchard.cluster(read_table(spark, sf_dir, "embeddings")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_secret_scan, op2_compression_bands, op3_rule_ensemble, op4_wrapper_text, op5_poisson_mix, op6_order_minhash,
    op7_url_rules, op8_piece_codec, op9_simhash_vptree, op10_pii_boosted, op11_weighted_repair, op12_recompression,
    op13_orchard_clusters)}

def _clusters_sql() -> str:
    """Rounds of assignment and update as a chain of tables; every distance is computed."""
    near = """SELECT rid, arg_min(c, struct_pack(d := d, c := c)) AS c, min(d) AS d FROM (
  SELECT rid, c, list_sum(list_transform(range(1, {parts} + 1), lambda i: (k.v[i] - u.v[i]) * (k.v[i] - u.v[i]))) AS d
  FROM kept k, c{r} u) GROUP BY rid"""
    sql = f"""
WITH doubles AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x
                 FROM embeddings WHERE len(embedding) = {orchard.PARTS}),
kept AS MATERIALIZED (SELECT rid, vec_id, list_transform(x, lambda e: CAST(floor({orchard.SCALE} * e) AS BIGINT)) AS v FROM doubles
                      WHERE len(list_filter(x, lambda e: isfinite(e))) = {orchard.PARTS}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (
  SELECT sha256('{orchard.SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM kept ORDER BY h, v LIMIT {orchard.CENTROIDS}))"""
    for r in range(orchard.ROUNDS + 1):
        sql += f",\na{r} AS MATERIALIZED ({near.format(r=r, parts=orchard.PARTS)})"
        if r < orchard.ROUNDS:
            sql += f""",
c{r + 1} AS MATERIALIZED (SELECT c{r}.c, coalesce(m.v, c{r}.v) AS v FROM c{r} LEFT JOIN (
  SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (
    SELECT c, i, sum(v[i]) AS s, count(*) AS n FROM a{r} JOIN kept USING (rid), range(1, {orchard.PARTS} + 1) t(i) GROUP BY c, i)
  GROUP BY c) m ON c{r}.c = m.c)"""
    last = orchard.ROUNDS
    return sql + f"""
SELECT vec_id, CAST(a{last}.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY a{last}.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c{last}.v, ',')) AS centroid_sha256
FROM a{last} JOIN kept USING (rid) JOIN c{last} ON a{last}.c = c{last}.c"""


#: Repair by strings: states carry (cost, audit), whose least pair is kept; texts are put together from the audits.
_REPAIR_SQL = f"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
faults AS (
  SELECT *, xor(list_reduce(list_transform(string_split(name, ''), lambda x: CAST(ascii(x) AS BIGINT)),
                            lambda c, x: list_reduce(range(8), lambda e, i: xor(e >> 1, 3988292384 * (e & 1)), xor(c, x)),
                            4294967295), 4294967295) % {conversation_repair.FAULTS} AS f FROM given),
damaged AS (
  SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role,
         CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM faults, range(CASE f WHEN 3 THEN 2 ELSE 1 END) WHERE f <> 0),
numbered AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, substr(role, 1, 1) AS initial,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS tail FROM damaged),
judged AS MATERIALIZED (
  SELECT *, CASE WHEN tail = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN tail NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS step FROM numbered),
inserts(a, b, letters) AS (VALUES ('', '', ''), ('s', 's', ''), ('u', 'u', ''), ('a', 'a', ''), ('', 'u', 'I'), ('s', 'u', 'I'),
                                  ('a', 'u', 'I'), ('u', 'a', 'I'), ('', 'a', 'II'), ('s', 'a', 'II')),
follows(a, b) AS (VALUES ('', 's'), ('', 'u'), ('s', 'u'), ('a', 'u'), ('u', 'a')),
paths AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, '' AS state, struct_pack(cost := CAST(0 AS BIGINT), audit := '') AS best
  FROM (SELECT DISTINCT conv_id FROM judged)
  UNION ALL
  SELECT conv_id, i, state, min(struct_pack(cost := CAST(cost AS BIGINT), audit := audit)) FROM (
    SELECT r.conv_id, r.i, CASE m.edit WHEN 'D' THEN n.b ELSE m.b END AS state,
           best.cost + 2 * len(n.letters) + m.cost + CAST(m.edit <> 'D' AND r.fault = 'truncated' AS BIGINT) AS cost,
           best.audit || n.letters || m.edit AS audit
    FROM paths p JOIN judged r ON p.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = p.i + 1
    JOIN inserts n ON n.a = p.state
    JOIN (SELECT a, b, 'K' AS edit, 0 AS cost FROM follows UNION ALL SELECT a, b, 'R', 2 FROM follows WHERE b <> 's'
          UNION ALL SELECT DISTINCT b, '', 'D', 3 FROM inserts) m ON m.a = n.b
    WHERE m.edit = 'D' OR (r.fault NOT IN ('blank', 'duplicate') AND (m.edit = 'R' OR r.initial = m.b)))
  GROUP BY conv_id, i, state),
counted AS (
  SELECT conv_id, max(i) AS rows, CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (step NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
ended AS MATERIALIZED (
  SELECT c.conv_id, min(struct_pack(cost := best.cost + 2 * len(n.letters), audit := best.audit || n.letters)) AS best
  FROM counted c JOIN paths p ON p.conv_id IS NOT DISTINCT FROM c.conv_id AND p.i = c.rows JOIN inserts n ON n.a = p.state
  WHERE n.b IN ('', 'a') GROUP BY c.conv_id),
letters AS (SELECT conv_id, unnest(string_split(best.audit, '')) AS edit, generate_subscripts(string_split(best.audit, ''), 1) AS step
            FROM ended WHERE best.audit <> ''),
placed AS (
  SELECT *, sum(CAST(edit <> 'I' AS INT)) OVER w AS i, sum(CAST(edit <> 'D' AS INT)) OVER w AS place,
         sum(CAST(edit <> 'D' AS INT)) OVER (PARTITION BY conv_id) AS n
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY step)),
texts AS (
  SELECT p.conv_id, string_agg(CASE WHEN edit = 'K' THEN j.role WHEN (n - place) % 2 = 0 THEN 'assistant' ELSE 'user' END || ':'
                               || CASE WHEN edit = 'I' THEN '' ELSE j.text END, chr(10) ORDER BY p.step) AS t
  FROM placed p LEFT JOIN judged j ON p.conv_id IS NOT DISTINCT FROM j.conv_id AND p.i = j.i WHERE edit <> 'D' GROUP BY p.conv_id)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, coalesce(best.cost, 0) AS cost, coalesce(best.audit, '') AS audit,
       sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended e ON o.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN texts x ON o.conv_id IS NOT DISTINCT FROM x.conv_id"""

_WINDOWS_SQL = f"""
WITH split AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS MATERIALIZED (
  SELECT r, doc_id, i, array_to_string(words[i : i + {recompression.WINDOW - 1}], ' ') AS w FROM (
    SELECT *, unnest(range(1, len(words) - {recompression.WINDOW - 2})) AS i FROM split)),
gone AS (
  SELECT DISTINCT r, i + k AS i FROM windows JOIN (SELECT w, min(doc_id) AS least FROM windows GROUP BY w) USING (w),
         range({recompression.WINDOW}) t(k) WHERE doc_id > least),
kept AS (
  SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM (
    SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM split) ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (r)"""

#: The others need zstandard, xxHash with a seed, trained models, DOM trees or an automaton; brute-force tests stand in.
ORACLE: dict[str, str] = {"op5_poisson_mix": f"""
WITH counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (SELECT source, (SELECT sum(n) FROM counts) * pow(n, {mixing.TEMPERATURE}) / (SELECT sum(pow(n, {mixing.TEMPERATURE})) FROM counts) / n AS rate
          FROM counts),
tables AS (SELECT source, list_transform(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 31) AS BIGINT)),
                                         lambda k: exp(k * ln(rate) - rate - lgamma(k + 1))) AS p FROM rates),
draws AS (SELECT d.*, p, (CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(d.source, '')), 1, 13) AS BIGINT)
                          + 0.5) / 4503599627370496.0 AS u
          FROM documents d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source),
counted AS (SELECT *, len(list_filter(range(1, len(p) + 1), lambda k: list_sum(p[1:k]) <= u)) AS copies FROM draws)
SELECT doc_id, text, lang, source, n_chars, unnest(range(0, copies)) AS copy FROM counted WHERE copies > 0
""", "op11_weighted_repair": _REPAIR_SQL, "op12_recompression": _WINDOWS_SQL, "op13_orchard_clusters": _clusters_sql()}
