"""The registered queries of the text operators, and the SQL they are compared with where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.llm import forest, html_extract, language, line_dedup, manifest, minhash, mixing, negatives, packing, quality
from spanlake.llm import suffix, token_files, toxicity
from spanlake.llm.common import lower_ascii, table, whole, words

# op1: token shares asked for
TARGETS = {"clean": 0.9, "low": 0.06, "toxic": 0.04}

Query = Callable[[SparkSession, str], DataFrame]

SQL: dict[str, str] = {}


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return mixing.rates(docs, mixing.domains(table(spark, sf_dir, "labels")), TARGETS)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept")


_STOP = ", ".join(f"'{w}'" for w in sorted({f for w in quality.STOP_WORDS for f in (w, w.capitalize())}))

SQL["op2_quality_rules"] = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), g AS (
  SELECT doc_id, i, list_aggregate(w[i:i+2], 'string_agg', ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), r AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
    FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1)
  GROUP BY doc_id
), c AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(l) AS BIGINT) AS n_lines,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(len(list_filter(l, lambda x: regexp_matches(x, '^[ \t]*[-*•]|(\.\.\.|…)[ \t\r]*$'))) AS BIGINT) AS n_loose_lines,
         CAST(len(list_filter(w, lambda x: x IN ({_STOP}))) AS BIGINT) AS n_stop_words,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN r USING (doc_id)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c
)
SELECT *, NOT base_failed AND word_chars BETWEEN 2 * n_words AND 14 * n_words AND n_symbols <= 0.1 * n_words
  AND n_stop_words >= 0.01 * n_words AND n_dup_lines <= 0.5 * n_lines AND n_loose_lines <= 0.9 * n_lines AS kept
FROM b
"""


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_dedup.drop_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select(
        "doc_id",
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_dropped").alias("n_dropped"),
        F.sha2(F.col("text"), 256).alias("kept_sha256"),
    )


SQL["op7_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), k AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), f AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), m AS (
  SELECT k.*, f.key IS NULL OR k.doc_id >= f.keeper AS stays FROM k LEFT JOIN f ON k.key = f.key
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (NOT stays) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (stays), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = token_files.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # a token per word, and one for the end
    return packing.pack(docs.select("doc_id", (F.size(words(whole())) + 1).alias("n_tokens")))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted", "flagged")


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.mark(table(spark, sf_dir, "documents").select("doc_id", "text"), size=2)


def op5_embedding_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.mark(table(spark, sf_dir, "embeddings"))


def op10_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


SQL["op11_hard_negatives"] = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, e.vec_id AS id, e.label = a.label AS same, CAST(list_dot_product(a.v, e.v) AS BIGINT) AS score
  FROM e AS a JOIN e ON len(a.v) = len(e.v) AND a.vec_id <> e.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), n AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 100 * s.score BETWEEN 30 * positive_score AND 90 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    built = manifest.build(docs, {"text": lower_ascii(F.col("text"))}, tampered)
    return manifest.climb(built).withColumnRenamed("id", "doc_id")


def _field(value: str) -> str:
    return f"coalesce(CAST(strlen({value}) AS VARCHAR) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text))) + ")"


# the crc bit by bit, over the digits of the id
_CRC = """xor(list_reduce(flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda c: list_transform(range(8), lambda k: CAST((ascii(c) >> k) & 1 AS BIGINT)))),
    lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384), 4294967295), 4294967295)"""

SQL["op12_merkle_manifest"] = f"""
WITH RECURSIVE d AS (
  SELECT *, coalesce('s' || source, '') AS tree, {_leaf('text')} AS leaf,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low, {_CRC} % 5 = 0 AS tampered
  FROM documents
), l AS (
  SELECT doc_id, tree, leaf, CASE WHEN tampered THEN {_leaf('low')} ELSE leaf END AS start,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n
  FROM d
), up AS (
  SELECT tree, 0 AS level, i, n, leaf AS h FROM l
  UNION ALL
  SELECT tree, level + 1, i // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY i))
  FROM up WHERE n > 1 GROUP BY tree, level, i // 16, (n + 15) // 16
), s AS (
  SELECT tree AS sub, 'top' AS tree, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n, h FROM up WHERE n = 1
), top AS (
  SELECT tree, 0 AS level, i, n, h FROM s
  UNION ALL
  SELECT tree, level + 1, i // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY i))
  FROM top WHERE n > 1 GROUP BY tree, level, i // 16, (n + 15) // 16
), fam AS (
  SELECT tree, level, i // 16 AS p, (n + 15) // 16 AS m, list(h ORDER BY i) AS hs
  FROM (SELECT * FROM up UNION ALL SELECT * FROM top) WHERE n > 1 GROUP BY tree, level, i // 16, (n + 15) // 16
), climb AS (
  SELECT doc_id, tree, tree AS own, 0 AS level, i, n, start AS fold, '' AS proof FROM l
  UNION ALL
  SELECT c.doc_id, coalesce(f.tree, 'top'), c.own, CASE WHEN f.tree IS NULL THEN 0 ELSE c.level + 1 END,
         CASE WHEN f.tree IS NULL THEN s.i ELSE f.p END, CASE WHEN f.tree IS NULL THEN s.n ELSE f.m END,
         CASE WHEN f.tree IS NULL THEN c.fold
              ELSE sha256(array_to_string(list_concat(hs[1:c.i % 16], [c.fold], hs[c.i % 16 + 2:]), '')) END,
         CASE WHEN f.tree IS NULL THEN c.proof
              ELSE c.proof || array_to_string(list_concat(hs[1:c.i % 16], hs[c.i % 16 + 2:]), '') END
  FROM climb c LEFT JOIN fam f ON c.n > 1 AND f.tree = c.tree AND f.level = c.level AND f.p = c.i // 16
  LEFT JOIN s ON c.n = 1 AND s.sub = c.tree
  WHERE NOT (c.tree = 'top' AND c.n = 1)
)
SELECT l.doc_id, l.leaf, s.h AS subroot, r.h AS root, sha256(c.proof) AS proof_sha256, c.fold AS folded_root, c.fold = r.h AS verified
FROM climb c JOIN l USING (doc_id) JOIN s ON s.sub = l.tree CROSS JOIN (SELECT h FROM top WHERE n = 1) r
WHERE c.tree = 'top' AND c.n = 1
"""


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    found = language.predict(docs, language.fit(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def queries() -> dict[str, Query]:
    found = {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
    return dict(sorted(found.items(), key=lambda kv: int(kv[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
