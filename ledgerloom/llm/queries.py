"""The queries of the training-data operators and, where SQL can express them, their twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    chat,
    code_compression,
    decontaminate,
    embedding_dedup,
    filter_audit,
    lm_scoring,
    packing,
    quality_classifier,
    quality_rules,
    simhash,
    substring_dedup,
    token_counts,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query("op1_substring_dedup", sql=f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
  places AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13),
  windows AS (SELECT doc_id, i, w[i:i + 12] AS x FROM places),
  firsts AS (SELECT x, min(doc_id) AS least FROM windows GROUP BY x HAVING min(doc_id) < max(doc_id)),
  gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM windows JOIN firsts USING (x) WHERE doc_id > least),
  lost AS (SELECT doc_id, list(i) AS g FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(g), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN g IS NULL THEN w ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(g, i)), lambda i: w[i]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN lost USING (doc_id)
""")
def op1_substring_dedup(spark, sf_dir):
    return substring_dedup.digests(table(spark, sf_dir, "documents"))


@query("op3_quality_rules", sql=rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
  places AS (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8),
  windows AS (SELECT doc_id, i, w[i:i + 7] AS x FROM places),
  twice AS (SELECT doc_id, x FROM windows GROUP BY ALL HAVING count(*) > 1),
  covered AS (SELECT doc_id, count(DISTINCT j) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 8)) AS j FROM windows JOIN twice USING (doc_id, x)) GROUP BY doc_id),
  long_places AS (SELECT doc_id, w, unnest(range(1, len(w) - 99)) AS i FROM d JOIN covered USING (doc_id) WHERE len(w) > 100),
  long_repeat AS (SELECT DISTINCT doc_id FROM (
    SELECT doc_id, md5(array_to_string(w[i:i + 100], ' ')) AS x FROM long_places GROUP BY ALL HAVING count(*) > 1)),
  facts AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
      length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
      (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
      long_repeat.doc_id IS NOT NULL AS too_long
    FROM (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d)
    LEFT JOIN covered USING (doc_id) LEFT JOIN long_repeat USING (doc_id)),
  judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM facts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT too_long AND 100 * n_symbols <= 5 * word_chars AS kept
FROM judged
""")
def op3_quality_rules(spark, sf_dir):
    measured = quality_rules.quality_measures(table(spark, sf_dir, "documents"), keep=("doc_id",))
    return quality_rules.verdicts(measured).drop("longest_repeat")


@query("op2_simhash_near_dedup")
def op2_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_decontamination")
def op4_decontamination(spark, sf_dir):
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_best_fit_packing")
def op9_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def remainder(divisor: int, value: int):
    """Whether the CRC-32 of an id's digits leaves ``value``."""
    return lambda i: F.crc32(i.cast("string")) % divisor == value


def scored(frame: DataFrame, held_out, limit: float) -> DataFrame:
    return frame.select(
        F.col("id").alias("doc_id"), F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= limit).cast("int").alias("predicted"))


@query("op10_quality_classifier")
def op10_quality_classifier(spark, sf_dir):
    docs, held_out = table(spark, sf_dir, "documents"), remainder(3, 1)
    trees = quality_classifier.fit(docs, table(spark, sf_dir, "labels"), "quality", held_out)
    return scored(quality_classifier.score(docs, trees), held_out, 0.5)


#: The conversation whose texts hold the template's own control strings.
TRAP = r"\### Assistant: </turn> ok"


@query("op7_chat_format", sql=rf"""
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '{TRAP}' UNION ALL SELECT -7, 1, 'assistant', '{TRAP}'),
  e AS (SELECT *, text || regexp_replace(text, '[^\\<#]', '', 'g') AS escaped FROM c)
SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text, '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(4 + length(role) + 2 + length(escaped) + 8)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
""")
def op7_chat_format(spark, sf_dir):
    trap = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRAP).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(trap)
    read = chat.read_back(chat.render(chat.fold_events(chat.as_events(rows))))
    spelled = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(spelled, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2(F.col("loss_text"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


@query("op6_lm_scoring")
def op6_lm_scoring(spark, sf_dir):
    return lm_scoring.score(table(spark, sf_dir, "documents"), F.col("lang") == "en")


@query("op8_token_counts")
def op8_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@query("op5_toxicity")
def op5_toxicity(spark, sf_dir):
    docs, held_out = table(spark, sf_dir, "documents"), remainder(4, 2)
    parameters = toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic", held_out)
    return scored(toxicity.score(docs, parameters), held_out, 0.3)


def _lloyd_sql(rounds: int, entries: int) -> str:
    """Lloyd rounds in SQL: ``parts`` to codebooks ``b<rounds>`` and the last assignment ``a<rounds>``."""
    steps = [f"b0 AS MATERIALIZED (SELECT p, e, v, list_inner_product(v, v) AS vv FROM (SELECT p, v, row_number() OVER (PARTITION BY p ORDER BY vec_id, x) - 1 AS e FROM parts) WHERE e < {entries})"]
    for r in range(rounds + 1):
        # Distances are whole numbers, so the entry rides along as the last digits.
        steps.append(f"""a{r} AS MATERIALIZED (SELECT k, p, any_value(s.v) AS v, min((s.vv - 2 * list_inner_product(s.v, b.v) + b.vv) * 1024 + e) AS m FROM parts s JOIN b{r} b USING (p) GROUP BY k, p)""")
        if r < rounds:
            steps.append(f"""m{r} AS (SELECT p, e, list(floor(t / n) ORDER BY i) AS v FROM (SELECT p, m % 1024 AS e, i, sum(v[i]) AS t, count(*) AS n
    FROM (SELECT p, m, v, unnest(range(1, len(v) + 1)) AS i FROM a{r}) GROUP BY ALL) GROUP BY ALL),
  b{r + 1} AS MATERIALIZED (SELECT p, e, w AS v, list_inner_product(w, w) AS vv FROM (SELECT b.p, b.e, coalesce(m.v, b.v) AS w FROM b{r} b LEFT JOIN m{r} m ON m.p = b.p AND m.e = b.e))""")
    return ",\n  ".join(steps)


@query("op11_code_compression", sql=f"""
WITH kept AS (SELECT row_number() OVER () AS k, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
  parts AS MATERIALIZED (SELECT k, vec_id, x, p, v, list_inner_product(v, v) AS vv FROM (
    SELECT k, vec_id, x, p, x[p * (len(x) // {code_compression.PARTS}) + 1:(p + 1) * (len(x) // {code_compression.PARTS})] AS v FROM kept, range({code_compression.PARTS}) t(p))),
  {_lloyd_sql(code_compression.ROUNDS, code_compression.ENTRIES)},
  coded AS (SELECT k, string_agg(lpad(to_hex((m % 1024)::INTEGER), 2, '0'), '' ORDER BY p) AS code, sum(floor(m / 1024))::BIGINT AS error FROM a{code_compression.ROUNDS} GROUP BY k),
  digest AS (SELECT sha256(string_agg(array_to_string(list_transform(v, lambda x: x::BIGINT), ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{code_compression.ROUNDS})
SELECT vec_id, lower(code) AS code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM coded JOIN kept USING (k), digest
""")
def op11_code_compression(spark, sf_dir):
    return code_compression.compress(table(spark, sf_dir, "embeddings"))


@query("op12_filter_audit", sql=rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
  firsts AS (SELECT t, min(doc_id) AS least FROM d GROUP BY t),
  marks AS (SELECT doc_id, max((quality = 1)::INTEGER) AS q, max((toxic = 1)::INTEGER) AS x FROM labels GROUP BY doc_id),
  facts AS (SELECT part, coalesce(q, 0) AS good, coalesce(x, 0) AS toxic, [
      CASE WHEN len(w) < 100 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' END,
      CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' END,
      CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END, CASE WHEN doc_id > least THEN 'E' END] AS f
    FROM d JOIN firsts USING (t) LEFT JOIN marks USING (doc_id)),
  masks AS (SELECT part, array_to_string(f, '') AS mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM facts GROUP BY ALL),
  l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
  orders AS (SELECT a.c || b.c || c.c || d.c || e.c AS o FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
  steps AS (SELECT o, step, o[step] AS own FROM orders, (SELECT unnest(range(1, 6))) s(step)),
  -- The step at which a set of failed filters is removed; 6: never.
  ranks AS (SELECT part, mask, n, good, toxic, o, coalesce(list_min(list_transform(string_split(mask, ''), lambda c: CASE WHEN c <> '' THEN strpos(o, c) END)), 6) AS gone FROM masks, orders),
  counts AS (SELECT part, s.o AS filter_order, step, own, sum(n) FILTER (gone > step) AS kept, sum(n) FILTER (gone = step) AS removed,
      sum(n) FILTER (contains(mask, own) AND gone < step) AS redundant, sum(n) FILTER (mask = own) AS unique_fails,
      sum(good) FILTER (gone = step) AS good_lost, sum(toxic) FILTER (gone = step) AS toxic_lost
    FROM ranks JOIN steps s USING (o) GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, {", ".join(f"coalesce({m}, 0)::BIGINT AS {m}" for m in filter_audit.MEASURES[:-1])},
  coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
FROM counts
""")
def op12_filter_audit(spark, sf_dir):
    return filter_audit.interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op13_embedding_near_dedup", sql="""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
  links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.x) = len(b.x) AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.x, b.x) >= 0.93),
  reach AS (SELECT a AS id, b AS other FROM links UNION SELECT id, b FROM reach JOIN links ON other = a),
  degree AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a),
  least AS (SELECT id AS vec_id, min(other) AS other FROM reach GROUP BY id)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(other, vec_id)) AS component_id, vec_id <= coalesce(other, vec_id) AS kept
FROM embeddings LEFT JOIN degree USING (vec_id) LEFT JOIN least USING (vec_id)
""")
def op13_embedding_near_dedup(spark, sf_dir):
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))
