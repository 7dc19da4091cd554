"""The queries of this subpackage: each reads its whole table and derives the contract's columns from an operator's result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from granary.llm import (
    bestfit_packing,
    html_wrappers,
    language_id,
    license_scan,
    maxscore_search,
    minhash_dedup,
    quality_rules,
    secret_scan,
    sentencepiece_codec,
    toxicity,
)
from granary.sources.tables import table


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_labels(license_scan.license_findings(table(spark, sf_dir, "documents")))


def op3_maxscore_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return maxscore_search.search(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op4_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit_packing.best_fit(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.scan(docs, secret_scan.train(known=secret_scan.vocabulary(docs)))
    secret = F.filter("findings", lambda f: f.secret)
    return found.select(
        "doc_id",
        F.size("findings").cast("long").alias("n_candidates"),
        F.size(secret).cast("long").alias("n_secrets"),
        F.coalesce(F.array_max(F.transform("findings", lambda f: f.score)), F.lit(0.0)).alias("score"),
        F.array_join(F.transform(secret, lambda f: F.concat_ws("-", f.start, f.end)), ",").alias("spans"),
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(True))
    model = toxicity.train(docs, labels.where(~held_out))
    return toxicity.toxicity(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
        "n_matches", "n_quoted", "n_misspelled",
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.quality_report(table(spark, sf_dir, "documents"))
    own = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select("doc_id", *[F.col(f"stats.{c}").alias(c) for c in own], "base_failed", "kept", "posterior")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode(table(spark, sf_dir, "documents")).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "n_byte_tokens", F.xxhash64("ids").alias("ids_hash"), "round_trip"
    )


def op9_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = html_wrappers.extract(pages, html_wrappers.wrappers(pages))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_languages(table(spark, sf_dir, "documents"))


def license_base_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op2 SQL can say: the base places (-1 for no place)."""
    places = [F.coalesce(c, F.lit(-1)).alias(c) for c in ("first_word", "last_word")]
    return op2_license_scan(spark, sf_dir).select("doc_id", "n_words", "n_base", *places, "base_labels")


def quality_base_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op7 SQL can say: the statistics and the base rules."""
    return op7_quality_rules(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def packing_by_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op4 SQL can say: the pieces of each document, and that no bin of one breaks a rule."""
    placed = op4_bestfit_packing(spark, sf_dir)
    n = F.count(F.lit(1))
    of_bin = placed.groupBy("bin_id").agg(F.sum("n_words").alias("held"), F.max("bin_words").alias("told"), n.alias("pieces"), F.countDistinct("cluster").alias("clusters"))
    of_source = placed.groupBy("bin_id", "source").agg(n.alias("n")).groupBy("bin_id").agg(F.max("n").alias("most"))
    broken = (F.col("held") > bestfit_packing.CAPACITY) | (F.col("held") != F.col("told")) | (F.col("pieces") > F.col("clusters")) | (F.col("most") > bestfit_packing.SOURCE_SLOTS)
    judged = of_bin.join(of_source, "bin_id").select("bin_id", broken.alias("broken"))
    per = placed.join(judged, "bin_id").groupBy("doc_id")
    return per.agg(n.alias("pieces"), F.sum("n_words").alias("n_words"), F.max("first_word").alias("last_piece"), F.count_if("broken").alias("broken"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash_dedup, op2_license_scan, op3_maxscore_search, op4_bestfit_packing, op5_secret_scan, op6_toxicity,
        op7_quality_rules, op8_sentencepiece, op9_html_wrappers, op10_language_id, license_base_columns, quality_base_columns, packing_by_document,
    )
}

_WORDS_LOWER = (
    "list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"
)

_WORDS = "list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"
_FOLDED = _WORDS_LOWER.replace("[\\x20\\x09-\\x0D]", "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]")

ORACLES: dict[str, str] = {
    "license_base_columns": f"""
WITH w AS (SELECT doc_id, {_FOLDED} AS ws FROM documents),
p(phrase, label) AS (VALUES (['gnu', 'general', 'public', 'license'], 'gpl'), (['apache', 'license'], 'apache'), (['cc', 'by'], 'cc-by'), (['mit', 'license'], 'mit')),
h AS (SELECT doc_id, label, unnest(list_filter(range(1, len(ws) + 1), lambda i: ws[i] = phrase[1] AND ws[i:i + len(phrase) - 1] = phrase)) - 1 AS pos FROM w, p),
g AS (SELECT doc_id, count(*) AS n, min(pos) AS lo, max(pos) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM h GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, coalesce(lo, -1) AS first_word, coalesce(hi, -1) AS last_word, coalesce(labels, '') AS base_labels FROM w LEFT JOIN g ON g.doc_id = w.doc_id
""",
    "quality_base_columns": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS ws FROM documents),
c AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
v AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM d), x AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS s FROM v),
m AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM x) WHERE n > 1),
r AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM m) GROUP BY 1)
SELECT c.doc_id, n_words, word_chars, n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
  n_words < 50 OR 100 * coalesce(r.n, 0) > 50 * n_words AS base_failed FROM c LEFT JOIN r ON r.doc_id = c.doc_id
""",
    "packing_by_document": f"""
WITH w AS (SELECT doc_id, CAST(len({_WORDS}) AS BIGINT) AS n FROM documents)
SELECT doc_id, greatest(1, (n + 4095) // 4096) AS pieces, n AS n_words, (greatest(1, (n + 4095) // 4096) - 1) * 4096 AS last_piece, 0::BIGINT AS broken FROM w
""",
    "op1_minhash_dedup": f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS_LOWER} AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w),
n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, md5(array_to_string(list_sort(sh), chr(10))) AS fp FROM s),
c AS (SELECT fp, min(doc_id) AS rep, count(*) AS class_size FROM n WHERE n_shingles > 0 GROUP BY fp),
u AS (SELECT doc_id AS d, unnest(sh) AS x FROM s WHERE doc_id IN (SELECT rep FROM c)),
rare AS (SELECT x FROM u GROUP BY x HAVING count(*) > 1),
v AS (SELECT d, u.x FROM u JOIN rare USING (x)),
p AS (SELECT a.d AS a, b.d AS b, count(*) AS k FROM v a JOIN v b ON a.x = b.x AND a.d < b.d GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * k >= 75 * (na.n_shingles + nb.n_shingles - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT rep AS x, rep AS y FROM c UNION SELECT r.x, e.b FROM r JOIN e ON e.a = r.y),
m AS (SELECT x, min(y) AS least FROM r GROUP BY x)
SELECT n.doc_id, n.n_shingles, coalesce(m.least, n.doc_id) AS component_id, n.doc_id = coalesce(m.least, n.doc_id) AS kept,
  CAST(CASE WHEN n.n_shingles > 0 THEN c.class_size ELSE 1 END AS BIGINT) AS class_size
FROM n LEFT JOIN c ON c.fp = n.fp AND n.n_shingles > 0 LEFT JOIN m ON m.x = c.rep
""",
    "op3_maxscore_search": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
}
