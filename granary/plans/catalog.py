"""The library's queries on the driver's tables, and the SQL each equals.

The tables hold no photographs, so each operator runs on a stand-in: documents are photographs with their text as content,
events are photographs of the families ``user_id``, embeddings are 8 by 8 components or outlines, parts are maps and tiles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions import geometry, hashing, labels, lattice, names
from granary.operators import dedup, episodes, lineage, review, sampling, splits, tiling, validate
from granary.operators import labels as vocabulary
from granary.sources import archive, sheets
from granary.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL that it equals."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _text_key():
    return F.md5("text")


@query("SELECT md5(text) AS group_key, count(*) AS members, count(DISTINCT source) AS datasets, min(doc_id) AS first_uid FROM documents GROUP BY 1 HAVING count(*) > 1")
def exact_duplicate_groups(spark, d):
    return dedup.keyed_groups(table(spark, d, "documents"), _text_key(), "doc_id", "source")


@query("SELECT 'exact' AS group_kind, md5(text) AS group_key, doc_id AS image_uid FROM documents WHERE text IN (SELECT text FROM documents GROUP BY 1 HAVING count(*) > 1)")
def exact_duplicate_members(spark, d):
    return dedup.group_members(table(spark, d, "documents"), _text_key(), "doc_id")


@query("SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS r FROM documents) WHERE r = 1")
def dedup_keep_first(spark, d):
    return dedup.keep_first(table(spark, d, "documents").withColumn("k", _text_key()), F.col("k"), "doc_id").select("doc_id", "source")


@query("""
WITH g AS (SELECT md5(text) AS k, count(*) AS n, count(DISTINCT source) AS s FROM documents GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(k) AS n_keys, count(*) FILTER (n > 1) AS n_groups, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS n_members,
  CAST(sum(n - 1) AS BIGINT) AS n_redundant, count(*) FILTER (n > 1 AND s > 1) AS n_cross, CAST(coalesce(max(n) FILTER (n > 1), 0) AS BIGINT) AS largest FROM g
""")
def duplicate_report_totals(spark, d):
    return dedup.report_totals(table(spark, d, "documents"), _text_key(), "source")


_STEM = """
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'DJI_' || lpad(CAST(event_id % 10000 AS VARCHAR), 4, '0') || '_x' ELSE
  'DJI_2025' || lpad(CAST(event_id % 12 + 1 AS VARCHAR), 2, '0') || lpad(CAST(event_id % 28 + 1 AS VARCHAR), 2, '0') || lpad(CAST(event_id % 24 AS VARCHAR), 2, '0')
  || lpad(CAST(event_id % 60 AS VARCHAR), 2, '0') || lpad(CAST((event_id * 7) % 60 AS VARCHAR), 2, '0') || '_' || lpad(CAST(event_id % 10000 AS VARCHAR), 4, '0')
  || CASE event_id % 4 WHEN 0 THEN '_D' WHEN 1 THEN '_W.b' WHEN 2 THEN '_V_' ELSE '_X' END || CASE WHEN event_id % 7 = 0 THEN '_Phantom' ELSE '' END END AS s FROM events
"""


@query(f"""
WITH e AS ({_STEM}), m AS (SELECT event_id, s, regexp_extract(s, 'DJI_(\\d{{14}})_(\\d{{4}})', 1) AS ts, regexp_extract(s, 'DJI_(\\d{{14}})_(\\d{{4}})', 2) AS q,
  regexp_extract(s, 'DJI_(\\d{{4}})(?:[^\\d]|$)', 1) AS o FROM e)
SELECT event_id, CASE WHEN lower(s) LIKE '%phantom%' THEN 'DJI Phantom' WHEN ts <> '' OR o <> '' THEN 'DJI' ELSE '' END AS sensor,
  CASE WHEN ts = '' THEN '' ELSE ts[1:4] || '-' || ts[5:6] || '-' || ts[7:8] || ' ' || ts[9:10] || ':' || ts[11:12] || ':' || ts[13:14] END AS capture_datetime,
  coalesce(TRY_CAST(ts[1:4] AS BIGINT), -1) AS capture_year, CASE WHEN ts = '' THEN '' ELSE 'DJI_' || ts END AS flight_id,
  CASE WHEN ts <> '' THEN 'DJI_' || ts || '_' || q WHEN o <> '' THEN 'DJI_' || o ELSE '' END AS source_mosaic,
  regexp_extract(s, '_(D|W|V)(?:[._]|$)', 1) AS band FROM m
""")
def filename_provenance(spark, d):
    e = F.col("event_id")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    four = F.lpad((e % 10000).cast("string"), 4, "0")
    tail = F.when(e % 4 == 0, "_D").when(e % 4 == 1, "_W.b").when(e % 4 == 2, "_V_").otherwise("_X")
    stamp = F.concat(F.lit("DJI_2025"), two(e % 12 + 1), two(e % 28 + 1), two(e % 24), two(e % 60), two((e * 7) % 60), F.lit("_"), four, tail, F.when(e % 7 == 0, "_Phantom").otherwise(""))
    named = table(spark, d, "events").select("event_id", F.when(e % 5 == 0, F.concat(F.lit("DJI_"), four, F.lit("_x"))).otherwise(stamp).alias("s"))
    got = names.parsed(F.col("s"))
    return named.select("event_id", *[got[c].alias(c) for c in ("sensor", "capture_datetime", "capture_year", "flight_id", "source_mosaic", "band")])


@query("""
WITH n AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'north_' || p_size || ' (' || p_partkey || ', ' || p_size || ')' WHEN 1 THEN 'Tile_R' || p_size || '_c' || p_partkey
  WHEN 2 THEN 'splitted_1_-' || p_size || '.5_' || p_partkey || '.25' ELSE 'crop_' || p_size || '_' || p_partkey || '_7' END AS s FROM part),
m AS (SELECT *, regexp_extract(s, '\\((\\d+)\\s*,\\s*(\\d+)\\)', 1) AS x, regexp_extract(s, '\\((\\d+)\\s*,\\s*(\\d+)\\)', 2) AS y,
  regexp_extract(s, 'crop_(\\d+)_(\\d+)_(\\d+)', 1) AS c, regexp_extract(s, 'crop_(\\d+)_(\\d+)_(\\d+)', 2) AS cx, regexp_extract(s, 'crop_(\\d+)_(\\d+)_(\\d+)', 3) AS cy FROM n)
SELECT p_partkey, CASE WHEN x <> '' THEN regexp_replace(rtrim(split_part(s, '(', 1), '_ '), '_\\d+$', '') WHEN c <> '' THEN 'crop_' || c ELSE '' END AS source_mosaic,
  coalesce(TRY_CAST(CASE WHEN c <> '' THEN cx ELSE x END AS BIGINT), -1) AS tile_x, coalesce(TRY_CAST(CASE WHEN c <> '' THEN cy ELSE y END AS BIGINT), -1) AS tile_y,
  coalesce(TRY_CAST(regexp_extract(s, '(?i)tile_r(\\d+)_c(\\d+)', 1) AS BIGINT), -1) AS tile_row, coalesce(TRY_CAST(regexp_extract(s, '(?i)tile_r(\\d+)_c(\\d+)', 2) AS BIGINT), -1) AS tile_col,
  coalesce(TRY_CAST(regexp_extract(s, 'splitted_\\d+_(-?\\d+\\.\\d+)_(-?\\d+\\.\\d+)', 1) AS DOUBLE), -1) AS geo_x,
  coalesce(TRY_CAST(regexp_extract(s, 'splitted_\\d+_(-?\\d+\\.\\d+)_(-?\\d+\\.\\d+)', 2) AS DOUBLE), -1) AS geo_y FROM m
""")
def tile_name_parsing(spark, d):
    k, s = F.col("p_partkey"), F.col("p_size")
    own = (
        F.when(k % 4 == 0, F.format_string("north_%d (%d, %d)", s, k, s)).when(k % 4 == 1, F.format_string("Tile_R%d_c%d", s, k))
        .when(k % 4 == 2, F.format_string("splitted_1_-%d.5_%d.25", s, k)).otherwise(F.format_string("crop_%d_%d_7", s, k))
    )
    got = names.parsed(F.col("s"))
    return table(spark, d, "part").select("p_partkey", own.alias("s")).select("p_partkey", *[got[c].alias(c) for c in ("source_mosaic", "tile_x", "tile_y", "tile_row", "tile_col", "geo_x", "geo_y")])


@query("""
WITH p AS (SELECT page_id, list_extract(string_split(regexp_extract(url, '^[a-z]+://([^?#]*)', 1), '/'), -1) AS b, url FROM pages)
SELECT page_id, b AS base_name, regexp_replace(b, '([^.])\\.[^.]*$', '\\1') AS stem, lower(regexp_extract(b, '[^.]\\.([^.]*)$', 1)) AS extension,
  regexp_matches(url || '.JPG', '(?i)\\.(jpg|jpeg|png|tif|tiff|bmp|webp)$') AND page_id % 2 = 0 AS is_image FROM p
""")
def url_path_parts(spark, d):
    b = names.base_name(F.regexp_extract("url", "^[a-z]+://([^?#]*)", 1))
    image = names.is_image(F.concat("url", F.when(F.col("page_id") % 2 == 0, ".JPG").otherwise(".html")))
    return table(spark, d, "pages").select("page_id", b.alias("base_name"), names.stem(b).alias("stem"), names.extension(b).alias("extension"), image.alias("is_image"))


@query("SELECT doc_id, sha1(source || '::' || CAST(doc_id AS VARCHAR)) AS image_uid, md5(text) AS content_hash FROM documents")
def image_uids(spark, d):
    return table(spark, d, "documents").select("doc_id", names.image_uid(F.col("source"), F.col("doc_id").cast("string")).alias("image_uid"), hashing.content_hash(F.col("text")).alias("content_hash"))


#: CRC-32 of each byte, by the rule of its polynomial, and the remainder folded over a text's bytes.
_CRC_STEP = "CASE WHEN {0} % 2 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END"
_CRC_ROWS = ", ".join(f"c{k} AS (SELECT i, {_CRC_STEP.format('v')} AS v FROM c{k - 1})" for k in range(1, 9))


@query(f"""
WITH c0 AS (SELECT CAST(range AS BIGINT) AS i, CAST(range AS BIGINT) AS v FROM range(256)), {_CRC_ROWS}, crc AS (SELECT list(v ORDER BY i) AS t FROM c8),
b AS (SELECT page_id, hex(encode(html)) AS h FROM pages),
r AS (SELECT page_id, len(h) // 2 AS n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(h) // 2), lambda k: CAST('0x' || h[2 * k + 1:2 * k + 2] AS BIGINT))),
  lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295::BIGINT) AS crc FROM b, crc)
SELECT page_id, lpad(lower(hex(crc)), 8, '0') || '-' || n AS content_key FROM r
""")
def content_keys(spark, d):
    body = F.col("html").cast("binary")
    return table(spark, d, "pages").select("page_id", names.content_key(F.crc32(body), F.octet_length(body)).alias("content_key"))


@query("SELECT o_orderkey, coalesce(TRY_CAST(CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE CAST(o_orderkey AS VARCHAR) END AS BIGINT), -1) AS n, CASE WHEN o_custkey % 5 > 0 THEN round(CAST(o_orderkey AS DOUBLE) * o_custkey / 1e6, 3) ELSE 0 END AS megapixels FROM orders")
def safe_numbers(spark, d):
    k = F.col("o_orderkey")
    text = F.when(k % 3 == 0, F.col("o_orderstatus")).otherwise(k.cast("string"))
    size = F.when(F.col("o_custkey") % 5 > 0, names.megapixels(k, F.col("o_custkey"))).otherwise(F.lit(0.0))
    return table(spark, d, "orders").select("o_orderkey", names.number(text).alias("n"), size.alias("megapixels"))


_RAW_SQL = "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN upper(p_name) || ' ' || p_size WHEN 1 THEN ' ' || p_name || '-' || p_size || '!' ELSE p_name || 's' END AS raw FROM part"


def _raw_label():
    k = F.col("p_partkey") % 3
    loud, quiet = F.concat(F.upper("p_name"), F.lit(" "), F.col("p_size")), F.concat(F.lit(" "), F.col("p_name"), F.lit("-"), F.col("p_size"), F.lit("!"))
    return F.when(k == 0, loud).when(k == 1, quiet).otherwise(F.concat("p_name", F.lit("s")))


_KEY_SQL = """
a AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_replace(raw, '^\\s+|\\s+$', '', 'g')), '[\\s\\-]+', '_', 'g'), '[^a-z0-9_]', '', 'g') AS s FROM r),
b AS (SELECT *, CASE WHEN len(regexp_replace(s, '_?[0-9]+$', '')) >= 4 THEN regexp_replace(s, '_?[0-9]+$', '') ELSE s END AS t FROM a),
c AS (SELECT *, CASE WHEN len(t) > 3 THEN regexp_replace(t, 's$', '') ELSE t END AS u FROM b),
k AS (SELECT *, CASE WHEN u = '' THEN 'unknown' ELSE u END AS label_key FROM c)
"""


@query(f"WITH r AS ({_RAW_SQL}), {_KEY_SQL} SELECT p_partkey, label_key FROM k")
def label_key(spark, d):
    return table(spark, d, "part").select("p_partkey", labels.label_key(_raw_label()).alias("label_key"))


_MODIFIERS = ", ".join(f"'{m}'" for m in labels.MODIFIERS)


@query(f"""
WITH q AS ({_RAW_SQL}), r AS (SELECT raw, count(*) AS n FROM q GROUP BY 1), {_KEY_SQL}
SELECT raw AS label_raw, n AS count, label_key, first_value(raw) OVER (PARTITION BY label_key ORDER BY n DESC, raw) AS suggested_canon,
  count(*) OVER (PARTITION BY label_key) AS spellings, CAST(sum(n) OVER (PARTITION BY label_key) AS BIGINT) AS key_total,
  CASE WHEN label_key IN ({_MODIFIERS}) THEN 'modifier, not a species?' WHEN regexp_full_match(label_key, '[a-z]{{1,3}}[0-9]+') THEN 'SHORT CODE -- separate plots, not spellings?'
    WHEN count(*) OVER (PARTITION BY label_key) > 1 THEN count(*) OVER (PARTITION BY label_key) || ' spellings share this key' ELSE '' END AS note FROM k
""")
def label_proposal(spark, d):
    return vocabulary.propose(table(spark, d, "part").select(_raw_label().alias("label_raw")))


@query("""
WITH o(label_raw, label_canon, decision) AS (VALUES ('click', 'tap', 'merge'), ('view', 'view', 'keep'), ('purchase', '', 'drop'))
SELECT event_id, coalesce(trim(label_canon), '') AS label_canon FROM events LEFT JOIN o ON event_type = label_raw WHERE coalesce(decision, '') <> 'drop'
""")
def label_apply(spark, d):
    rows = [("click", " tap ", "merge", "", "p"), ("view", "view", "keep", "", "p"), ("purchase", "", "drop", "", "p")]
    sheet = spark.createDataFrame(rows, "label_raw string, label_canon string, decision string, domain string, approved_by string")
    decided = vocabulary.ontology(sheet, "2025-01-01T00:00:00Z")
    return vocabulary.apply(table(spark, d, "events").select("event_id", F.col("event_type").alias("label_raw")), decided).select("event_id", "label_canon")




def _flat():
    return F.transform("embedding", lambda x: F.round(x.cast("double") * 1000, 0) + 0.0)


_FLAT_SQL = "SELECT vec_id, list_transform(embedding, lambda x: round(CAST(x AS DOUBLE) * 1000, 0) + 0.0) AS p FROM embeddings"


def _marks(spark, d, kind):
    rows = table(spark, d, "embeddings").select("vec_id", F.posexplode(geometry.marks(F.lit(kind), _flat())).alias("i", "m"))
    return rows.select("vec_id", "i", *[F.round(f"m.{c}", 6).alias(c) for c in ("x", "y", "w", "h", "area_px")])


@query(f"WITH f AS ({_FLAT_SQL}) SELECT vec_id, CAST(i AS INTEGER) AS i, p[2 * i + 1] AS x, p[2 * i + 2] AS y, 0.0::DOUBLE AS w, 0.0::DOUBLE AS h, 0.0::DOUBLE AS area_px FROM f, unnest(range(32)) t(i)")
def points_explode(spark, d):
    return _marks(spark, d, "points")


@query(f"""
WITH f AS ({_FLAT_SQL}), b AS (SELECT vec_id, least(p[1], p[3]) AS l, greatest(p[1], p[3]) AS r, least(p[2], p[4]) AS t, greatest(p[2], p[4]) AS u FROM f)
SELECT vec_id, 0 AS i, (l + r) / 2 AS x, (t + u) / 2 AS y, r - l AS w, u - t AS h, (r - l) * (u - t) AS area_px FROM b
""")
def box_normalise(spark, d):
    return _marks(spark, d, "rectangle")


_OUTLINE_SQL = f"""
WITH f AS ({_FLAT_SQL}), v AS (SELECT vec_id, i, p[2 * i + 1] AS x, p[2 * i + 2] AS y, p[2 * ((i + 1) % 32) + 1] AS nx, p[2 * ((i + 1) % 32) + 2] AS ny FROM f, unnest(range(32)) t(i))
SELECT vec_id, 0 AS i, round(sum(x) / 32, 6) AS x, round(sum(y) / 32, 6) AS y, max(x) - min(x) AS w, max(y) - min(y) AS h, AREA AS area_px FROM v GROUP BY vec_id
"""


@query(_OUTLINE_SQL.replace("AREA", "abs(sum(x * ny - nx * y)) / 2"))
def polygon_area(spark, d):
    return _marks(spark, d, "polygon")


@query(_OUTLINE_SQL.replace("AREA", "(max(x) - min(x)) * (max(y) - min(y))"))
def polyline_box(spark, d):
    return _marks(spark, d, "polyline")


@query(f"""
WITH f AS ({_FLAT_SQL}) SELECT vec_id, 'POLYGON((' || array_to_string(list_transform(range(32), lambda i: CAST(CAST(p[2 * i + 1] AS BIGINT) AS VARCHAR) || '.0 ' ||
  CAST(CAST(p[2 * i + 2] AS BIGINT) AS VARCHAR) || '.0'), ', ') || '))' AS points_wkt FROM f
""")
def polygon_outline(spark, d):
    plain = F.transform(_flat(), lambda x: x + F.lit(0.0))
    return table(spark, d, "embeddings").select("vec_id", geometry.outline_text(geometry.pairs(plain)).alias("points_wkt"))


_BITS_SQL = """
SELECT vec_id, list_transform(range(64), lambda i: CASE WHEN i > 0 AND CAST(embedding[i + 1] AS DOUBLE) > list_sort(list_transform(embedding[2:64], lambda x: CAST(x AS DOUBLE)))[32] THEN 1 ELSE 0 END) AS bits FROM embeddings
"""
_VALUE_SQL = f"SELECT vec_id, CAST(list_sum(list_transform(range(64), lambda i: bits[i + 1] * CAST(pow(2, 63 - i) AS HUGEINT))) AS BIGINT) AS v FROM ({_BITS_SQL})"
#: Bits apart at which the stand-in's vectors, which are no near copies of each other, begin to pair.
NEAR_BITS = 18


def _bits(spark, d):
    return table(spark, d, "embeddings").select("vec_id", hashing.packed(hashing.coarse_bits(F.col("embedding"))).alias("bits"))


@query(f"SELECT vec_id, array_to_string(bits, '') AS bits FROM ({_BITS_SQL})")
def perceptual_bits(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.array_join(F.transform(hashing.coarse_bits(F.col("embedding")), lambda b: b.cast("string")), "").alias("bits"))


@query(f"SELECT vec_id, v AS bits, lower(lpad(hex(v), 16, '0')) AS phash FROM ({_VALUE_SQL})")
def perceptual_hash(spark, d):
    return _bits(spark, d).withColumn("phash", hashing.hex_of_bits(F.col("bits")))


@query(f"""
WITH h AS (SELECT DISTINCT v FROM ({_VALUE_SQL}))
SELECT a.v AS a, b.v AS b, CAST(bit_count(xor(a.v, b.v)) AS INTEGER) AS distance FROM h a JOIN h b ON a.v < b.v AND bit_count(xor(a.v, b.v)) <= {NEAR_BITS}
""")
def hamming_pairs(spark, d):
    return dedup.hamming_pairs(_bits(spark, d), NEAR_BITS)


@query(f"""
WITH RECURSIVE s AS MATERIALIZED ({_VALUE_SQL}), h AS MATERIALIZED (SELECT DISTINCT v FROM s),
e AS MATERIALIZED (SELECT a.v AS a, b.v AS b FROM h a JOIN h b ON a.v <> b.v AND bit_count(xor(a.v, b.v)) <= {NEAR_BITS}),
r AS (SELECT v AS x, v AS y FROM h UNION SELECT r.x, e.b FROM r JOIN e ON e.a = r.y),
m AS (SELECT x, min(y) AS k FROM r GROUP BY 1), n AS (SELECT vec_id, k FROM s JOIN m ON s.v = m.x)
SELECT k AS group_key, vec_id AS image_uid FROM n WHERE k IN (SELECT k FROM n GROUP BY 1 HAVING count(*) > 1)
""")
def perceptual_components(spark, d):
    return dedup.perceptual_groups(_bits(spark, d), "vec_id", "bits", NEAR_BITS)


@query(f"WITH h AS ({_VALUE_SQL}), g AS (SELECT v, count(*) AS n FROM h GROUP BY 1) SELECT CAST(sum(n) AS BIGINT) AS hashed, count(*) AS distinct_hashes, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS sharing FROM g")
def perceptual_stats(spark, d):
    return dedup.perceptual_summary(_bits(spark, d))


def _tiles(spark, d):
    k = F.col("p_partkey")
    return table(spark, d, "part").select(
        k.alias("image_uid"), F.col("p_brand").alias("source_mosaic"), ((k * 37) % 1000).alias("tile_x"), ((k * 91) % 1000).alias("tile_y"),
        (F.col("p_size") + 20).cast("bigint").alias("width"), (F.col("p_size") * 2 + 10).cast("bigint").alias("height"),
    )


_TILES_SQL = "SELECT p_partkey AS u, p_brand AS m, (p_partkey * 37) % 1000 AS x, (p_partkey * 91) % 1000 AS y, p_size + 20 AS w, p_size * 2 + 10 AS h FROM part"
_SIZES_SQL = f"SELECT m, CAST(trunc(median(w)) AS BIGINT) AS w, CAST(trunc(median(h)) AS BIGINT) AS h, count(*) AS tiles FROM ({_TILES_SQL}) GROUP BY 1 HAVING count(*) > 1"


@query(f"SELECT m AS source_mosaic, w, h, tiles FROM ({_SIZES_SQL})")
def median_tile_size(spark, d):
    return dedup.tile_sizes(_tiles(spark, d))


@query(f"""
WITH t AS ({_TILES_SQL}), s AS ({_SIZES_SQL})
SELECT DISTINCT a.m AS group_key, a.u AS image_uid FROM t a JOIN t b ON a.m = b.m AND a.u <> b.u JOIN s ON s.m = a.m AND abs(a.x - b.x) < s.w AND abs(a.y - b.y) < s.h
""")
def tile_overlap(spark, d):
    return dedup.overlaps(_tiles(spark, d))


@query("""
WITH w AS (SELECT *, count(*) OVER (PARTITION BY source, lang) AS n, lead(doc_id) OVER o AS b, lead(n_chars) OVER o AS nb, lead(md5(text)) OVER o AS kb, md5(text) AS ka FROM documents
  WINDOW o AS (PARTITION BY source, lang ORDER BY n_chars, doc_id))
SELECT source, lang, doc_id AS a, b, n_chars AS size_a, nb AS size_b FROM w WHERE n BETWEEN 2 AND 4000 AND b IS NOT NULL AND ka <> kb AND n_chars > 0 AND abs(nb - n_chars) / n_chars <= 0.02
""")
def near_size_pairs(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", "lang", "n_chars", _text_key().alias("k"))
    return dedup.near_sizes(docs, ["source", "lang"], "n_chars", "doc_id", "k")


def _families(spark, d):
    keys = {1: _text_key(), 2: F.md5(F.lower(F.nullif(F.regexp_replace("text", "[^A-Za-z]+", ""), F.lit("")))), 3: F.concat_ws(":", "source", "lang", "n_chars")}
    return lineage.families(table(spark, d, "documents"), keys, F.col("source"), "doc_id")


_FAMILY_SQL = """
WITH RECURSIVE k AS (SELECT doc_id AS u, 1 AS r, md5(text) AS k FROM documents UNION ALL SELECT doc_id, 2, md5(lower(nullif(regexp_replace(text, '[^A-Za-z]+', '', 'g'), ''))) FROM documents
  UNION ALL SELECT doc_id, 3, source || ':' || lang || ':' || n_chars FROM documents),
g AS (SELECT r, k, min(u) AS h FROM k GROUP BY 1, 2 HAVING count(*) > 1), s AS (SELECT u, k.r, h FROM k JOIN g ON k.r = g.r AND k.k = g.k),
e AS (SELECT u AS a, h AS b FROM s UNION SELECT h, u FROM s), c AS (SELECT DISTINCT a AS x, a AS y FROM e UNION SELECT c.x, e.b FROM c JOIN e ON e.a = c.y),
m AS (SELECT x, min(y) AS f FROM c GROUP BY 1), q AS (SELECT u, min(r) AS r FROM s GROUP BY 1),
t AS (SELECT doc_id AS uid, CASE WHEN f IS NULL THEN min(CASE WHEN f IS NULL THEN doc_id END) OVER (PARTITION BY source) ELSE f END AS family, coalesce(r, 6) AS k
  FROM documents LEFT JOIN m ON doc_id = x LEFT JOIN q ON doc_id = q.u),
fam AS (SELECT uid, family, CASE k WHEN 1 THEN 'duplicate' WHEN 2 THEN 'mosaic' WHEN 3 THEN 'flight' ELSE 'site' END AS evidence, CAST(k AS BIGINT) AS evidence_rank FROM t)
"""


@query(f"{_FAMILY_SQL} SELECT * FROM fam")
def lineage_groups(spark, d):
    return _families(spark, d)


@query(f"{_FAMILY_SQL} SELECT uid, 'g' || lpad(CAST(dense_rank() OVER (ORDER BY family) - 1 AS VARCHAR), 6, '0') AS leakage_group_id FROM fam")
def lineage_names(spark, d):
    found = _families(spark, d)
    return found.join(lineage.family_names(found), "family").select("uid", "leakage_group_id")


@query(f"""
{_FAMILY_SQL}, z AS (SELECT family, count(*) AS n FROM fam GROUP BY 1), w AS (SELECT count(*) AS n_families, max(n) AS largest, list_sort(list(n))[count(*) // 2 + 1] AS median_size FROM z)
SELECT evidence, count(*) AS photos, count(DISTINCT family) AS families, any_value(n_families) AS n_families, any_value(largest) AS largest, any_value(median_size) AS median_size FROM fam, w GROUP BY evidence
""")
def family_stats(spark, d):
    return lineage.family_stats(_families(spark, d))


@query("""
SELECT c_custkey, coalesce(nullif(trim(CASE WHEN n_nationkey % 3 = 0 THEN '  ' ELSE n_name END), ''), c_name) AS farm,
  coalesce(nullif(coalesce(nullif(trim(CASE WHEN n_nationkey % 2 = 0 THEN '' ELSE n_name END), ''), ''), ''), CAST(c_nationkey AS VARCHAR)) AS site_id FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def site_map_overlay(spark, d):
    photos = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("dataset"), F.col("c_name").alias("farm"), F.lit("").alias("site_id"))
    k = F.col("n_nationkey")
    sheet = table(spark, d, "nation").select(k.alias("dataset"), F.when(k % 3 == 0, "  ").otherwise(F.col("n_name")).alias("farm"), F.when(k % 2 == 0, "").otherwise(F.col("n_name")).alias("site_id"))
    out = lineage.site_overlay(photos, sheet, "dataset", ["farm", "site_id"], "site_id", F.col("dataset").cast("string"))
    return out.select("c_custkey", "farm", "site_id")


_SPLIT_SQL = """
WITH RECURSIVE f AS (SELECT user_id AS family, count(*) AS n FROM events GROUP BY 1), o AS (SELECT *, row_number() OVER (ORDER BY n DESC, family) AS i FROM f),
g AS (SELECT 0::BIGINT AS i, [0 - 0.6::DOUBLE * count(*), 0 - 0.1::DOUBLE * count(*), 0 - 0.1::DOUBLE * count(*), 0 - 0.1::DOUBLE * count(*), 0 - 0.1::DOUBLE * count(*)] AS d, 0 AS p FROM events
  UNION ALL SELECT o.i, list_transform(range(1, 6), lambda j: CASE WHEN j = list_position(g.d, list_min(g.d)) THEN g.d[j] + o.n ELSE g.d[j] END), list_position(g.d, list_min(g.d)) FROM g JOIN o ON o.i = g.i + 1),
a AS (SELECT family, n, ['train', 'dev_cal', 'dev_select', 'dev_confirm', 'sealed_test'][p] AS split FROM g JOIN o ON o.i = g.i)
"""


def _assigned(spark, d):
    return splits.assign(splits.family_sizes(table(spark, d, "events"), "user_id"))


@query(f"{_SPLIT_SQL} SELECT family, n, split FROM a")
def split_assignment(spark, d):
    return _assigned(spark, d)


@query(f"""
{_SPLIT_SQL}, s(split, target) AS (VALUES ('train', 0.6::DOUBLE), ('dev_cal', 0.1), ('dev_select', 0.1), ('dev_confirm', 0.1), ('sealed_test', 0.1))
SELECT s.split, CAST(coalesce(sum(n), 0) AS BIGINT) AS photographs, round(coalesce(sum(n), 0) / (SELECT sum(n) FROM a), 4) AS share, any_value(target) AS target, count(n) AS families FROM s LEFT JOIN a ON s.split = a.split GROUP BY 1
""")
def split_summary(spark, d):
    return splits.summary(_assigned(spark, d))


@query(f"{_SPLIT_SQL} SELECT event_id, coalesce(split, '') AS split FROM events LEFT JOIN a ON user_id = family")
def split_of_events(spark, d):
    return splits.split_of_photos(table(spark, d, "events"), _assigned(spark, d), "user_id").select("event_id", "split")


@query("SELECT user_id AS family, count(DISTINCT event_type) AS splits FROM events GROUP BY 1 HAVING count(DISTINCT event_type) > 1")
def split_leaks(spark, d):
    return splits.leaks(table(spark, d, "events"), "user_id", "event_type")


_PCT = "round(100.0::DOUBLE * bad / greatest(total, 1), 6) AS pct"


@query(f"""
WITH c AS (
SELECT 'order unique' AS "check", count(*) - count(DISTINCT o_orderkey) AS bad, count(*) AS total, true AS fatal FROM orders
UNION ALL SELECT 'line has order', count(*) FILTER (o_orderkey IS NULL), count(*), true FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
UNION ALL SELECT 'line has part', count(*) FILTER (p_partkey IS NULL), count(*), true FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
UNION ALL SELECT 'discount in range', count(*) FILTER (l_discount < 0 OR l_discount > 0.05), count(*), false FROM lineitem
UNION ALL SELECT 'document labelled', count(*) FILTER (l.doc_id IS NULL), count(*), false FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id)
SELECT *, {_PCT} FROM c
""")
def validation_gate(spark, d):
    lines, orders = table(spark, d, "lineitem"), table(spark, d, "orders")
    parts = [
        validate.unique(orders, "o_orderkey", "order unique"),
        validate.missing(lines, "l_orderkey", orders, "o_orderkey", "line has order"),
        validate.missing(lines, "l_partkey", table(spark, d, "part"), "p_partkey", "line has part"),
        validate.checks(lines, validate.holds(lines, "discount in range", (F.col("l_discount") < 0) | (F.col("l_discount") > 0.05), False)),
        validate.missing(table(spark, d, "documents"), "doc_id", table(spark, d, "labels"), "doc_id", "document labelled", False),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(f"""
WITH i AS (SELECT l_quantity AS x, l_quantity * 2 AS y, l_linenumber - 1 AS w, l_linenumber AS h, CASE WHEN l_linenumber % 3 = 0 THEN 'points' ELSE 'rectangle' END AS t,
  l_linenumber * l_linenumber AS a, p_size AS pw, p_size * 2 - 20 AS ph FROM lineitem JOIN part ON l_partkey = p_partkey),
c AS (SELECT 'centre inside photo' AS "check", count(*) FILTER (pw > 0 AND ph > 0 AND (x > pw OR y > ph)) AS bad, count(*) FILTER (pw > 0 AND ph > 0) AS total, true AS fatal FROM i
UNION ALL SELECT 'box has size', count(*) FILTER (t <> 'points' AND NOT (w > 0 AND h > 0)), count(*) FILTER (t <> 'points'), true FROM i
UNION ALL SELECT 'area within box', count(*) FILTER (t <> 'points' AND a > 1.01 * w * h), count(*) FILTER (t <> 'points'), true FROM i
UNION ALL SELECT 'dimensions known', count(*) FILTER (NOT (pw > 0 AND ph > 0)), count(*), false FROM i) SELECT *, {_PCT} FROM c
""")
def geometry_gate(spark, d):
    n = F.col("l_linenumber").cast("double")
    marks = table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("image_uid"), F.col("l_quantity").alias("x"), (F.col("l_quantity") * 2).alias("y"), (n - 1).alias("w"), n.alias("h"),
        (n * n).alias("area_px"), F.when(F.col("l_linenumber") % 3 == 0, "points").otherwise("rectangle").alias("shape_type"),
    )
    photos = table(spark, d, "part").select(F.col("p_partkey").alias("image_uid"), F.col("p_size").alias("width"), (F.col("p_size") * 2 - 20).alias("height"))
    return validate.geometry_checks(marks, photos)


@query(f"""
WITH s AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1), c AS (
SELECT 'largest family' AS "check", CASE WHEN max(n) > 0.5 * sum(n) THEN max(n) ELSE 0 END AS bad, CAST(sum(n) AS BIGINT) AS total, true AS fatal FROM s
UNION ALL SELECT 'enough families', greatest(30 - count(*), 0), count(*), true FROM s
UNION ALL SELECT 'completed share', CASE WHEN count(*) FILTER (event_type = 'purchase') < 0.05 * count(*) THEN count(*) - count(*) FILTER (event_type = 'purchase') ELSE 0 END, count(*), false FROM events)
SELECT *, {_PCT} FROM c
""")
def family_gate(spark, d):
    events = table(spark, d, "events")
    done = events.withColumn("task_status", F.when(F.col("event_type") == "purchase", "completed").otherwise("annotation"))
    return validate.family_checks(events.withColumn("leakage_group_id", F.col("user_id"))).unionByName(validate.checks(done, validate.coverage(done)))


@query("SELECT doc_id, source FROM documents ORDER BY md5('7:' || doc_id), doc_id LIMIT 100")
def seeded_sample(spark, d):
    return sampling.fixed_sample(table(spark, d, "documents").select("doc_id", "source"), 100, 7, "doc_id")


_STRATA = """
WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5('3:' || doc_id), doc_id) AS r FROM documents),
q AS (SELECT greatest(120 // count(DISTINCT source), 1) AS q FROM documents), p AS (SELECT doc_id, source FROM r, q WHERE r <= q ORDER BY md5('3:' || doc_id), doc_id LIMIT 120)
"""


@query(f"{_STRATA} SELECT * FROM p")
def stratified_sample(spark, d):
    return sampling.stratified_sample(table(spark, d, "documents").select("doc_id", "source"), 120, 3, "doc_id", "source")


@query("""
WITH o AS (SELECT o_orderkey AS u, o_orderpriority AS ds, o_orderstatus AS st FROM orders WHERE regexp_matches(o_orderpriority, '(?i)[1-3]-')), n AS (SELECT count(DISTINCT ds) AS k FROM o),
r AS (SELECT *, row_number() OVER (PARTITION BY ds ORDER BY md5('0:' || u), u) AS r FROM o), p AS (SELECT u, ds, st FROM r, n WHERE r <= greatest(60 // k, 1) ORDER BY md5('0:' || u), u LIMIT 60)
SELECT CAST(u AS VARCHAR) AS image, ds AS dataset, st AS task_status, (SELECT count(*) FROM lineitem WHERE l_orderkey = u) AS marked, '' AS missed_count, '' AS exhaustive, '' AS reviewer FROM p
""")
def exhaustiveness_sheet(spark, d):
    k = F.col("o_orderkey")
    photos = table(spark, d, "orders").select(k.alias("image_uid"), k.cast("string").alias("image_name"), F.col("o_orderpriority").alias("dataset"), F.col("o_orderstatus").alias("task_status"), F.lit(1).alias("has_annotation"))
    return review.exhaustiveness_sample(photos, table(spark, d, "lineitem").select(F.col("l_orderkey").alias("image_uid")), 60, 0, "[1-3]-")


#: Episodes a split in the stand-in.
PER_SPLIT = {"train": 200, "dev_cal": 50, "sealed_test": 50}
_DRAW = "('0x' || substr(md5('{}'), 1, 8))::BIGINT"
_EPISODE_SQL = """
WITH ph AS (SELECT o_orderkey AS u, CASE ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT % 5 WHEN 0 THEN 'dev_cal' WHEN 1 THEN 'sealed_test' ELSE 'train' END AS split, o_custkey AS fam FROM orders),
mk AS (SELECT split, p_brand AS label, u, fam, l_orderkey || '-' || l_linenumber AS iid, l_extendedprice AS x, l_quantity AS y FROM lineitem JOIN ph ON l_orderkey = u JOIN part ON l_partkey = p_partkey),
rk AS (SELECT *, row_number() OVER (PARTITION BY split, label ORDER BY u) - 1 AS ph FROM (SELECT DISTINCT split, label, u, fam FROM mk)),
lb AS (SELECT split, label, count(*) AS n FROM rk GROUP BY 1, 2 HAVING count(*) >= 2), pl AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY label) - 1 AS place, count(*) OVER (PARTITION BY split) AS labels FROM lb),
ct(split, k) AS (VALUES ('train', 200), ('dev_cal', 50), ('sealed_test', 50)), ep AS (SELECT split, unnest(range(k)) AS i FROM ct),
ch AS (SELECT ep.split, ep.i, label, n FROM ep JOIN pl ON pl.split = ep.split AND place = ('0x' || substr(md5('11:' || ep.split || ':' || ep.i || ':label'), 1, 8))::BIGINT % labels),
tw AS (SELECT *, ('0x' || substr(md5('11:' || split || ':' || i || ':support'), 1, 8))::BIGINT % n AS s, ('0x' || substr(md5('11:' || split || ':' || i || ':query'), 1, 8))::BIGINT % (n - 1) + 1 AS st FROM ch),
pr AS (SELECT t.split, t.i, t.label, a.u AS su, b.u AS qu, a.fam AS sf, b.fam AS qf FROM tw t JOIN rk a ON a.split = t.split AND a.label = t.label AND a.ph = t.s
  JOIN rk b ON b.split = t.split AND b.label = t.label AND b.ph = (t.s + t.st) % t.n),
sp AS (SELECT p.split, p.i, x, y, row_number() OVER (PARTITION BY p.split, p.i ORDER BY md5('11:' || p.split || ':' || p.i || ':s:' || iid), iid, x, y) AS r FROM pr p JOIN mk m ON m.split = p.split AND m.label = p.label AND m.u = p.su),
qp AS (SELECT p.split, p.i, x, y, row_number() OVER (PARTITION BY p.split, p.i ORDER BY md5('11:' || p.split || ':' || p.i || ':q:' || iid), iid, x, y) AS r FROM pr p JOIN mk m ON m.split = p.split AND m.label = p.label AND m.u = p.qu),
sa AS (SELECT split, i, list(x ORDER BY r) AS sx, list(y ORDER BY r) AS sy FROM sp WHERE r <= 10 GROUP BY 1, 2), qa AS (SELECT split, i, list(x ORDER BY r) AS qx, list(y ORDER BY r) AS qy FROM qp WHERE r <= 20 GROUP BY 1, 2),
ez AS (SELECT p.split || '-' || lpad(CAST(p.i AS VARCHAR), 6, '0') AS episode_id, p.split, p.label, CAST(su AS VARCHAR) AS support_uid, CAST(qu AS VARCHAR) AS query_uid, sx AS support_x, sy AS support_y, qx AS query_x, qy AS query_y,
  len(sx) AS n_support, len(qx) AS n_query, CAST(sf = qf AS BIGINT) AS same_family, 1::BIGINT AS sampler_version, ('0x' || substr(md5('11:' || p.split || ':' || p.i || ':seed'), 1, 8))::BIGINT % 2147483648 AS seed
  FROM pr p JOIN sa ON sa.split = p.split AND sa.i = p.i JOIN qa ON qa.split = p.split AND qa.i = p.i)
"""


def _episode_tables(spark, d):
    k = F.col("o_orderkey")
    bucket = F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint") % 5
    photos = table(spark, d, "orders").select(
        k.cast("string").alias("image_uid"), F.when(bucket == 0, "dev_cal").when(bucket == 1, "sealed_test").otherwise("train").alias("split"),
        F.col("o_custkey").cast("string").alias("leakage_group_id"), k.cast("string").alias("content_hash"), F.lit("").alias("content_key"), k.alias("place"),
    )
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    own = F.col("l_orderkey").cast("string")
    marks = lines.select(
        own.alias("image_uid"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("instance_id"), F.lit("").alias("label_canon"), F.col("p_brand").alias("label_raw"),
        F.col("l_extendedprice").alias("x"), F.col("l_quantity").alias("y"),
    )
    return photos, marks


def _episodes(spark, d):
    photos, marks = _episode_tables(spark, d)
    return episodes.build_episodes(photos, marks, PER_SPLIT, seed=11, order="place")


@query(_EPISODE_SQL.replace("ORDER BY u) - 1 AS ph", "ORDER BY CAST(u AS VARCHAR)) - 1 AS ph") + "SELECT * FROM ez")
def few_shot_episodes(spark, d):
    return _episodes(spark, d)


@query(_EPISODE_SQL.replace("ORDER BY u) - 1 AS ph", "ORDER BY CAST(u AS VARCHAR)) - 1 AS ph") + """
SELECT count(*) AS episodes, count(DISTINCT label) AS labels, round(coalesce(avg(same_family), 0), 6) AS same_family, count(*) FILTER (support_uid = query_uid) AS same_photo,
  count(*) FILTER (a.split IS DISTINCT FROM ez.split OR b.split IS DISTINCT FROM ez.split) AS cross_split
FROM ez LEFT JOIN ph a ON CAST(a.u AS VARCHAR) = support_uid LEFT JOIN ph b ON CAST(b.u AS VARCHAR) = query_uid
""")
def episode_leakage_audit(spark, d):
    return episodes.leakage_audit(_episodes(spark, d), _episode_tables(spark, d)[0])


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_todo(spark, d):
    return dedup.resume_todo(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id").select("doc_id", "source")


@query("SELECT doc_id, CAST(toxic AS BIGINT) AS v FROM labels UNION ALL SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def upsert_rows(spark, d):
    old = table(spark, d, "documents").select("doc_id", F.col("n_chars").alias("v"))
    return dedup.upsert(old, table(spark, d, "labels").select("doc_id", F.col("toxic").cast("bigint").alias("v")), "doc_id")


@query("""
SELECT l_orderkey, l_linenumber, CAST(floor((l_quantity - 20) / 16) AS BIGINT) AS cell, CAST(floor(l_extendedprice / 32) AS BIGINT) AS cells, (CAST(floor((l_quantity - 20) / 16) AS BIGINT) + 0.5) * 16 AS centre,
  CAST(ceil(l_quantity / 32) * 32 AS BIGINT) AS halo FROM lineitem
""")
def grid_cells(spark, d):
    x = F.col("l_quantity")
    cell = lattice.cell_of(x - 20, 16)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", cell.alias("cell"), lattice.grid_size(F.col("l_extendedprice"), 32).alias("cells"), lattice.centre_of(cell, 16).alias("centre"), lattice.rounded_halo(x, 32).alias("halo"))


_PLAN_SQL = """
WITH p AS (SELECT p_partkey, p_size * 37 + 200 AS w, p_size * 29 + 150 AS h FROM part), y AS (SELECT *, unnest(range(0, h, 128)) AS y FROM p), t AS (SELECT *, unnest(range(0, w, 128)) AS x FROM y),
q AS (SELECT p_partkey, w, h, CAST(greatest(0, x - 32) AS INTEGER) AS read_x0, CAST(greatest(0, y - 32) AS INTEGER) AS read_y0, CAST(least(w, x + 160) AS INTEGER) AS read_x1, CAST(least(h, y + 160) AS INTEGER) AS read_y1,
  CAST(x // 16 AS INTEGER) AS keep_col0, CAST(y // 16 AS INTEGER) AS keep_row0, CAST((x - greatest(0, x - 32)) // 16 AS INTEGER) AS trim_left, CAST((y - greatest(0, y - 32)) // 16 AS INTEGER) AS trim_top FROM t)
"""


def _maps(spark, d):
    return table(spark, d, "part").select("p_partkey", (F.col("p_size") * 37 + 200).alias("w"), (F.col("p_size") * 29 + 150).alias("h"))


def _plan(spark, d):
    return tiling.plan(_maps(spark, d), F.col("w"), F.col("h"), 128, 32, 16)


@query(f"{_PLAN_SQL} SELECT p_partkey, read_x0, read_y0, read_x1, read_y1, keep_col0, keep_row0, trim_left, trim_top FROM q")
def tile_plan(spark, d):
    return _plan(spark, d).drop("w", "h")


@query(f"""
{_PLAN_SQL}, c AS (SELECT p_partkey, keep_row0 + i AS r, keep_col0 + j AS c FROM q, unnest(range(8)) a(i), unnest(range(8)) b(j) WHERE keep_row0 + i < h // 16 AND keep_col0 + j < w // 16),
n AS (SELECT p_partkey, r, c, count(*) AS n FROM c GROUP BY 1, 2, 3), s AS (SELECT p_partkey, count(*) AS written, count(*) FILTER (n > 1) AS doubles FROM n GROUP BY 1)
SELECT p.p_partkey, CAST((h // 16) * (w // 16) AS BIGINT) AS cells, CAST((h // 16) * (w // 16) - coalesce(written, 0) AS BIGINT) AS holes, coalesce(doubles, 0) AS doubles FROM p LEFT JOIN s ON s.p_partkey = p.p_partkey
""")
def tile_write_once(spark, d):
    images = _maps(spark, d)
    spans = tiling.kept_spans(_plan(spark, d), ["p_partkey"], F.col("w"), F.col("h"), 128, 16)
    return tiling.write_counts(spans, images, "p_partkey", F.col("w"), F.col("h"), 16)


@query("""
WITH e AS (SELECT event_id, event_id % 8 AS x, (event_id // 8) % 5 AS y, (event_id // 40) % 2 = 1 AS fx, (event_id // 80) % 2 = 1 AS fy, (event_id // 160) % 4 AS k FROM events),
f AS (SELECT event_id, k, CASE WHEN fx THEN 7 - x ELSE x END AS x, CASE WHEN fy THEN 4 - y ELSE y END AS y FROM e)
SELECT event_id, CASE k WHEN 1 THEN y WHEN 2 THEN 7 - x WHEN 3 THEN 4 - y ELSE x END AS new_x, CASE k WHEN 1 THEN 7 - x WHEN 2 THEN 4 - y WHEN 3 THEN x ELSE y END AS new_y FROM f
""")
def map_points(spark, d):
    e = F.col("event_id")
    part = lambda n, m: F.floor(e / n).cast("bigint") % m
    x, y = geometry.mapped_point(e % 8, part(8, 5), F.lit(8), F.lit(5), part(40, 2) == 1, part(80, 2) == 1, part(160, 4))
    return table(spark, d, "events").select("event_id", x.cast("bigint").alias("new_x"), y.cast("bigint").alias("new_y"))


@query("""
SELECT vec_id, round((abs(CAST(embedding[1] AS DOUBLE)) * 255 / 255 - 0.485) / 0.229, 6) AS r, round((abs(CAST(embedding[2] AS DOUBLE)) * 255 / 255 - 0.456) / 0.224, 6) AS g,
  round((abs(CAST(embedding[3] AS DOUBLE)) * 255 / 255 - 0.406) / 0.225, 6) AS b FROM embeddings
""")
def normalise_channels(spark, d):
    v = lambda k: F.abs(F.get("embedding", F.lit(k)).cast("double")) * 255
    return table(spark, d, "embeddings").select("vec_id", *[F.round(geometry.normalised(v(k), k), 6).alias(c) for k, c in enumerate("rgb")])


@query("SELECT p_brand, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 5")
def top_labels(spark, d):
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return vocabulary.most_used(lines, "p_brand").withColumnRenamed("label", "p_brand")


@query("SELECT event_id, unnest(map_keys(CAST(CAST(props AS JSON) AS MAP(VARCHAR, BIGINT)))) AS k, unnest(map_values(CAST(CAST(props AS JSON) AS MAP(VARCHAR, BIGINT)))) AS v FROM events")
def json_map_explode(spark, d):
    return table(spark, d, "events").select("event_id", sheets.exploded(F.col("props"), "bigint"))


@query("SELECT doc_id AS uid, coalesce(nullif(CASE WHEN doc_id % 3 = 0 THEN '' ELSE md5(text) END, ''), source) AS dedup_key FROM documents")
def dedup_keys(spark, d):
    hashed = F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.md5("text"))
    return table(spark, d, "documents").select(F.col("doc_id").alias("uid"), hashing.dedup_key(hashed, F.col("source")).alias("dedup_key"))


#: Task folders of the stand-in for archives, in which orders are photographs and line items marks.
TASKS = 200


def _members(spark, d):
    """Members as the archive source reads them: photographs, and a task.json, manifest.jsonl and annotations.json for each task."""
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    task, zip_ = lambda c: F.concat(F.lit("task_"), c % TASKS), lambda c: F.concat(F.lit("Set "), c % TASKS % 3, F.lit(".v1.zip"))
    name = F.concat(F.lit("IMG_"), F.lpad(k.cast("string"), 8, "0"))

    def member(archive_, path, ordinal, content, crc=F.lit(0), size=F.lit(0)):
        return [
            archive_.alias("archive"), F.lit(0).alias("archive_ordinal"), path.alias("member"), ordinal.cast("int").alias("ordinal"), crc.cast("bigint").alias("crc"),
            size.cast("bigint").alias("size_bytes"), content.cast("binary").alias("content"), F.lit(None).cast("string").alias("error"),
        ]

    t = F.col("o_custkey")
    photos = o.select(*member(zip_(t), F.concat(task(t), F.lit("/data/"), name, F.lit(".jpg")), k, k.cast("string"), k, F.length(k.cast("string"))))
    line = F.to_json(F.struct(name.alias("name"), F.lit(".jpg").alias("extension"), (k % 1000 + 1).alias("width"), (k % 700 + 1).alias("height")))
    listed = o.where(k % 5 != 0).groupBy((t % TASKS).alias("t")).agg(F.array_sort(F.collect_list(F.struct("o_orderdate", "o_orderkey", line.alias("line")))).alias("x"))
    lines = F.concat(F.lit('{"version":"1.1"}\nno json\n'), F.array_join(F.transform("x", lambda r: r.line), "\n"))
    n = F.col("t")
    manifests = listed.select(*member(zip_(n), F.concat(task(n), F.lit("/data/manifest.jsonl")), F.lit(-1), lines))
    info = F.to_json(F.struct(F.concat(F.lit("task "), n).alias("name"), F.when(n % 3 == 0, "completed").otherwise("annotation").alias("status")))
    infos = listed.where(n % 7 != 0).select(*member(zip_(n), F.concat(task(n), F.lit("/task.json")), F.lit(-2), info))
    q, i = F.col("l_quantity").cast("double"), F.col("l_linenumber").cast("double")
    dot = F.col("l_linenumber") % 2 == 1
    shape = F.struct(
        (F.col("l_orderkey") % 50).alias("frame"), F.when(dot, "points").otherwise("rectangle").alias("type"), F.col("l_returnflag").alias("label"),
        F.when(dot, F.array(q, i)).otherwise(F.array(q + 10, i + 20, q, i)).alias("points"),
    )
    drawn = table(spark, d, "lineitem").groupBy((F.col("l_suppkey") % TASKS).alias("t")).agg(F.array_sort(F.collect_list(F.struct("l_orderkey", "l_linenumber", shape.alias("s")))).alias("x"))
    shapes = F.to_json(F.struct(F.transform("x", lambda r: r.s).alias("shapes")))
    marks = drawn.select(*member(zip_(n), F.concat(task(n), F.lit("/annotations.json")), F.lit(-3), shapes))
    return photos.unionByName(manifests).unionByName(infos).unionByName(marks)


_ARCHIVE_SQL = """
WITH p AS (SELECT o_orderkey AS k, o_custkey % 200 AS t, o_orderdate AS dt, o_orderkey % 5 <> 0 AS listed FROM orders), l AS (SELECT t, count(*) AS n FROM p WHERE listed GROUP BY 1),
f AS (SELECT p.*, CASE WHEN listed THEN row_number() OVER (PARTITION BY p.t, listed ORDER BY dt, k) - 1 ELSE coalesce(n, 0) + row_number() OVER (PARTITION BY p.t, listed ORDER BY k) - 1 END AS frame FROM p LEFT JOIN l ON l.t = p.t),
s AS (SELECT l_suppkey % 200 AS t, l_orderkey % 50 AS frame, row_number() OVER (PARTITION BY l_suppkey % 200, l_orderkey % 50 ORDER BY l_orderkey, l_linenumber, l_returnflag, l_quantity) - 1 AS place, l_returnflag AS label, l_linenumber % 2 = 1 AS dot,
  CAST(l_quantity AS DOUBLE) AS q, CAST(l_linenumber AS DOUBLE) AS i FROM lineitem),
m AS (SELECT t, frame, count(*) AS n FROM s GROUP BY 1, 2),
u AS (SELECT *, 'Set ' || t % 3 || '.v1' AS ds, 'task_' || t || '/data/IMG_' || lpad(CAST(k AS VARCHAR), 8, '0') || '.jpg' AS mb FROM f)
"""


@query(f"""
{_ARCHIVE_SQL} SELECT sha1(ds || '::' || mb) AS image_uid, ds || '.zip' AS archive, mb AS member, md5(CAST(k AS VARCHAR)) AS content_hash, lpad(lower(hex(k)), 8, '0') || '-' || len(CAST(k AS VARCHAR)) AS content_key, ds AS dataset,
  CASE WHEN u.t % 7 = 0 THEN '' ELSE 'task ' || u.t END AS task_name, CASE WHEN u.t % 7 = 0 THEN '' WHEN u.t % 3 = 0 THEN 'completed' ELSE 'annotation' END AS task_status, CAST(u.frame AS BIGINT) AS frame_index,
  CASE WHEN listed THEN k % 1000 + 1 ELSE -1 END AS width, CASE WHEN listed THEN k % 700 + 1 ELSE -1 END AS height, CAST(n IS NOT NULL AS BIGINT) AS has_annotation, CAST(coalesce(n, 0) AS BIGINT) AS n_annotations
FROM u LEFT JOIN m ON m.t = u.t AND m.frame = u.frame
""")
def archive_manifest(spark, d):
    manifest, _ = archive.catalogue(_members(spark, d))
    return manifest.select("image_uid", "archive", "member", "content_hash", "content_key", "dataset", "task_name", "task_status", "frame_index", "width", "height", "has_annotation", "n_annotations")


@query(f"""
{_ARCHIVE_SQL} SELECT sha1(ds || '::' || mb) AS image_uid, sha1(ds || '::' || mb) || '-' || place || '-0' AS instance_id, label AS label_raw, CASE WHEN dot THEN 'points' ELSE 'rectangle' END AS shape_type,
  CASE WHEN dot THEN q ELSE q + 5 END AS x, CASE WHEN dot THEN i ELSE i + 10 END AS y, CASE WHEN dot THEN 0.0::DOUBLE ELSE 10 END AS w, CASE WHEN dot THEN 0.0::DOUBLE ELSE 20 END AS h, CASE WHEN dot THEN 0.0::DOUBLE ELSE 200 END AS area_px
FROM u JOIN s ON s.t = u.t AND s.frame = u.frame
""")
def archive_instances(spark, d):
    _, instances = archive.catalogue(_members(spark, d))
    return instances.select("image_uid", "instance_id", "label_raw", "shape_type", "x", "y", "w", "h", "area_px")


@query("""
WITH g AS (SELECT md5(text) AS k, doc_id FROM documents WHERE doc_id % 3 <> 0), w AS (SELECT k FROM g WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY 1 HAVING count(*) > 1)
SELECT doc_id AS uid, k AS key FROM g WHERE doc_id IN (SELECT doc_id FROM labels) AND k IN (SELECT k FROM w)
""")
def reported_groups(spark, d):
    report = table(spark, d, "documents").where("doc_id % 3 <> 0").select(_text_key().alias("group_key"), F.col("doc_id").alias("image_uid"))
    return lineage.reported_keys(report, table(spark, d, "labels"), "doc_id")


@query("SELECT lineitem.* FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders ORDER BY md5('5:' || o_orderkey), o_orderkey LIMIT 50)")
def sampled_marks(spark, d):
    picked = sampling.fixed_sample(table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey")), 50, 5, "l_orderkey")
    return review.sampled_marks(picked, table(spark, d, "lineitem"), "l_orderkey")
