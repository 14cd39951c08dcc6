"""The registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from speechlake.llm import (
    decontaminate, filters, language, licenses, lines, mixing, pages, pii, secrets, simhash, substrings, vectors, whitening,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from each document."""
    return mixing.mix_sources(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence families stated in each document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan(docs, licenses.train(docs)).select("doc_id", "licenses")
    families = F.array_sort(F.array_distinct(F.transform("licenses", lambda x: x["family"])))
    return found.select(
        "doc_id", F.size("licenses").cast("long").alias("n_statements"), F.array_join(families, ",").alias("families"),
        F.round(F.array_max(F.transform("licenses", lambda x: x["probability"])), 4).alias("best_probability"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of each document."""
    return simhash.fingerprint_components(_table(spark, sf_dir, "documents"))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of each document; the model never sees the held-out third."""
    docs = _table(spark, sf_dir, "documents")
    model = language.train(docs.where(~held_out(F.col("doc_id"))))
    return language.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words and items in each document."""
    found = decontaminate.document_hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that repeated passages cover, and what is left."""
    return substrings.remove_repeated(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of each vector."""
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document, those removed as repeated passages, and what is left."""
    return lines.dedup_lines(_table(spark, sf_dir, "documents"), counts=True).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op8_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page."""
    return pages.extract_text(_table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in each document."""
    found = pii.find_pii(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "pii")

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(
            ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("pii", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("pii", lambda x: x["kind"].isin(*pii.BASE))
    return found.select(
        "doc_id", *[count(kind) for kind in pii.BASE],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("pii")).alias("spans"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of each vector, one row for each component."""
    rows = _table(spark, sf_dir, "embeddings")
    white = whitening.whiten(rows, whitening.fit(rows)).select("vec_id", "whitening.*")
    parts = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "part")
    return white.select("vec_id", "n", "deviation", "identity_error", parts).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", F.expr("try_cast(deviation as bigint)").alias("deviation"), "part.whitened",
        "part.explained", "identity_error", F.col("deviation").alias("deviation_exact"))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets and linked parts of credentials in each document."""
    found = secrets.find_secrets(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "secrets")
    base = F.filter("secrets", lambda x: x["kind"].isin(*secrets.BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(kind) for kind in secrets.BASE],
        F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("secrets")).alias("spans"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each filter removes in every order of the five."""
    return filters.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_mix_sources": op1_mix_sources, "op2_licenses": op2_licenses, "op3_simhash": op3_simhash, "op4_language": op4_language,
    "op5_decontaminate": op5_decontaminate, "op6_substrings": op6_substrings, "op7_line_dedup": op7_line_dedup, "op8_page_text": op8_page_text,
    "op9_pii": op9_pii, "op10_near_vectors": op10_near_vectors,
    "op11_whitening": op11_whitening, "op12_secrets": op12_secrets, "op13_filter_audit": op13_filter_audit,
}

_OP5 = r"""
WITH letters AS (SELECT '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+' AS word),
docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), word) AS w FROM documents, letters),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), word) AS w FROM benchmark, letters),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
probes AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, p.n, item_id FROM probes p JOIN windows USING (win)),
covered AS (SELECT doc_id, count(DISTINCT spot) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS spot FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

_OP6 = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM docs WHERE len(w) >= 20)),
repeated AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS k FROM windows) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS spot FROM repeated),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS spot FROM docs),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY spot) AS kept, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, spot) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

_OP13 = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
firsts AS (SELECT t, min(doc_id) AS first_id FROM words GROUP BY t),
said AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
         FROM labels GROUP BY doc_id),
flags AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, len(w) < 200 AS a,
    100 * len(list_distinct(w)) < 50 * len(w) AS b,
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
    coalesce(words.doc_id > first_id, words.doc_id IS NULL AND first_id IS NOT NULL) AS e
  FROM words JOIN firsts USING (t) LEFT JOIN said ON words.doc_id = said.doc_id),
counted AS (SELECT part, good, toxic, map(['A', 'B', 'C', 'D', 'E'], [a, b, c, d, e]) AS f, count(*) AS n FROM flags GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT [p.x, q.x, r.x, s.x, t.x] AS o FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
steps AS (SELECT o, unnest(range(1, 6)) AS step FROM orders),
judged AS (
  SELECT part, o, step, o[step] AS x, n, good, toxic, f[o[step]] AS fails,
    len([y FOR y IN o[:step - 1] IF f[y]]) > 0 AS gone,
    len([y FOR y IN o IF f[y]]) = 1 AS lone
  FROM counted, steps),
totals AS (
  SELECT part, array_to_string(o, '') AS filter_order, step, x,
    sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END) AS kept, sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails AND lone THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN fails AND NOT gone AND good THEN n ELSE 0 END) AS good_lost,
    sum(CASE WHEN fails AND NOT gone AND toxic THEN n ELSE 0 END) AS toxic_lost
  FROM judged GROUP BY part, o, step, x)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM totals
"""

ORACLES = {"op5_decontaminate": _OP5, "op6_substrings": _OP6, "op13_filter_audit": _OP13}
