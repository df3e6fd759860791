"""The queries of the corpus operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import brown_lm, embedding_dedup, exact_dedup, line_dedup, mixing, packing, pii, quality, secrets_scan, simhash


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op2_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.score_texts(_table(spark, sf_dir, "documents"))


def op3_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mixture(_table(spark, sf_dir, "documents"))
    return rows.withColumns({c: F.round(c, 9) for c in ("weight", "position")})


def op4_int8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_groups(_table(spark, sf_dir, "embeddings"))


def op5_line_edit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(_table(spark, sf_dir, "documents"))


def op6_secret_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return secrets_scan.scan_secrets(docs, secrets_scan.train_on(docs))


def op7_simhash_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(_table(spark, sf_dir, "documents"), width=3, max_bits=2)


def op8_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op9_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.grade_documents(docs, quality.train(docs, quality.grades_of_labels(_table(spark, sf_dir, "labels"))))


#: The key under which the test tables are rewritten, so that results can be repeated; it protects nothing.
TEST_KEY = "tidewright"


def op10_pii_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pii.pseudonymize(_table(spark, sf_dir, "documents"), TEST_KEY)
    found = [F.coalesce(F.try_element_at("pii_finds", F.lit(kind)), F.lit(0)).alias(f"n_{kind}") for kind in pii.KINDS]
    return docs.select("doc_id", "text", "lang", "source", *found)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_exact_dedup_trie, op2_brown_lm, op3_temperature_mix, op4_int8_near_dup, op5_line_edit_dedup, op6_secret_markov, op7_simhash_ball, op8_cost_packing, op9_ordinal_quality, op10_pii_feistel)}


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS cp, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
), g AS (
  SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY cp DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""


OP3_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id AS id, coalesce('=' || source, 'null') AS key, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n FROM documents
), s AS (
  SELECT key, sum(n)::BIGINT AS tokens, ceil(sqrt(count(*)))::BIGINT AS n_blocks FROM d GROUP BY key
), t AS (
  SELECT sum(tokens)::DOUBLE AS total, (min(tokens) FILTER (tokens > 0))::DOUBLE AS least, max(tokens)::DOUBLE AS most FROM s
), bisected(lo, hi, step) AS (
  SELECT 0::BIGINT, 1073741824::BIGINT, 0 UNION ALL
  SELECT CASE WHEN met THEN lo ELSE mid END, CASE WHEN met THEN mid ELSE hi END, step + 1 FROM (
    SELECT lo, hi, step, (lo + hi) // 2 AS mid, (pow(least / total, (lo + hi) // 2 / 1073741824.0::DOUBLE) / (least / total)) / (pow(most / total, (lo + hi) // 2 / 1073741824.0::DOUBLE) / (most / total)) <= 2.0 AS met FROM bisected, t
  ) WHERE step < 30
), a AS (
  SELECT CASE WHEN (1 / (least / total)) / (1 / (most / total)) <= 2.0 THEN 0.0 ELSE (SELECT max(hi) FROM bisected WHERE step = 30) / 1073741824.0::DOUBLE END AS a FROM t
), x AS (
  SELECT s.*, CASE WHEN tokens > 0 THEN pow(tokens / total, a) ELSE 0.0 END AS x FROM s, t, a
), z AS (SELECT sum(x) AS z, max(CASE WHEN tokens > 0 THEN tokens / x END) AS whole FROM x),
b AS (SELECT key, tokens, n_blocks, x / z AS weight, CASE WHEN tokens > 0 THEN round(x / z * (whole * z))::BIGINT ELSE 0 END AS budget FROM x, z),
w AS (SELECT *, CASE WHEN tokens > 0 THEN budget // tokens ELSE 1 END AS epochs, CASE WHEN tokens > 0 THEN budget - budget // tokens * tokens ELSE 0 END AS rest FROM b),
placed AS (SELECT d.*, ('0x' || substr(md5('mix:' || id), 1, 15))::BIGINT % n_blocks AS block FROM d JOIN w USING (key)),
blocks AS (SELECT key, block, sum(n)::BIGINT AS block_tokens FROM placed GROUP BY key, block),
e AS (SELECT blocks.*, tokens, budget, epochs, rest, weight, unnest(range(0, CASE WHEN rest > 0 THEN epochs + 1 ELSE greatest(epochs, 1) END)) AS epoch FROM blocks JOIN w USING (key)),
o AS (SELECT *, coalesce(sum(block_tokens) OVER (PARTITION BY key, epoch ORDER BY ('0x' || substr(md5('mix:order:' || epoch || ':' || key || ':' || block), 1, 15))::BIGINT, block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM e),
c AS (
  SELECT p.id, p.key, p.n, epoch, block_tokens, before, tokens, budget, epochs, rest, weight, ('0x' || substr(md5('mix:doc:' || epoch || ':' || p.id), 1, 15))::BIGINT AS place, p.block
  FROM o JOIN placed p USING (key, block) WHERE epoch < epochs OR before < rest
), u AS (SELECT *, sum(n) OVER (PARTITION BY key, block, epoch ORDER BY place, id) AS upto FROM c)
SELECT id AS doc_id, CASE WHEN key = 'null' THEN NULL ELSE substr(key, 2) END AS source, n AS n_tokens, epoch, round(weight, 9) AS weight,
  CASE WHEN budget > 0 THEN round((epoch * tokens + before + place / 1152921504606846976.0::DOUBLE * block_tokens) / budget, 9) ELSE 0.0 END AS position
FROM u WHERE epoch < epochs OR before + block_tokens <= rest OR upto <= rest - before
"""

OP4_SQL = r"""
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(e, lambda x: abs(x))) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
named AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = named.vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM named
"""

#: Lines that share a segment, as its own part of the shorter and anywhere near in the longer one, within the edits of the shorter.
OP5_SQL = r"""
WITH RECURSIVE o AS (
  SELECT doc_id, unnest(range(0, len(string_split(coalesce(text, ''), chr(10)))))::INT AS line_no, unnest(string_split(coalesce(text, ''), chr(10))) AS raw FROM documents
), t AS (SELECT doc_id, line_no, trim(raw, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line FROM o),
l AS (SELECT line, length(line) AS n, CASE WHEN length(line) >= 24 THEN 2 WHEN length(line) >= 12 THEN 1 ELSE 0 END AS e FROM (SELECT DISTINCT line FROM t WHERE line <> '')),
own AS (SELECT line, n, e, i, substr(line, n * i // (e + 1) + 1, n * (i + 1) // (e + 1) - n * i // (e + 1)) AS part FROM l, range(0, 3) r(i) WHERE i <= e AND e > 0),
ask AS (SELECT line, m, e, i, substr(line, m * i // (e + 1) + s + 1, m * (i + 1) // (e + 1) - m * i // (e + 1)) AS part FROM (
  SELECT line, n - d AS m, CASE WHEN n - d >= 24 THEN 2 WHEN n - d >= 12 THEN 1 ELSE 0 END AS e, i, s FROM l, range(0, 3) a(d), range(0, 3) b(i), range(-2, 3) c(s)
) WHERE e > 0 AND i <= e AND m * i // (e + 1) + s >= 0),
pairs AS (SELECT DISTINCT own.line AS a, ask.line AS b, own.e FROM own JOIN ask ON own.n = ask.m AND own.i = ask.i AND own.part = ask.part AND own.line <> ask.line),
near AS (SELECT a, b FROM pairs WHERE levenshtein(a, b) <= e),
links AS (SELECT a, b FROM near UNION SELECT b, a FROM near),
reach(a, b) AS (SELECT a, a FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
class AS (SELECT a AS line, min(b) AS root FROM reach GROUP BY a),
c AS (SELECT t.*, coalesce(root, line) AS root, row_number() OVER (PARTITION BY coalesce(root, line) ORDER BY doc_id, line_no) AS r FROM t LEFT JOIN class USING (line) WHERE line <> '')
SELECT doc_id, len(string_split(coalesce(text, ''), chr(10)))::INT AS n_lines, (SELECT count(*) FROM c WHERE c.doc_id = d.doc_id AND r > 1)::INT AS n_removed,
  coalesce((SELECT list(line_no ORDER BY line_no) FROM c WHERE c.doc_id = d.doc_id AND r > 1), []::INT[]) AS removed_lines FROM documents d
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup_trie": OP1_SQL, "op3_temperature_mix": OP3_SQL, "op4_int8_near_dup": OP4_SQL, "op5_line_edit_dedup": OP5_SQL}
