"""Registered queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldbook.llm import contamination, jaccard, language, lines, linkgraph, lm, mixing, repeats, sharding, turns, vafile, warc, whitening
from fieldbook.llm.tables import table

# A host without a rule is blocked from a hundredth of a blocked seed's own distrust on.
LEAST_DISTRUST = 0.01


def op1_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    found = language.identified(docs.select("doc_id", "text", "lang"))
    return found.select(
        "row.doc_id", language.held_out(F.col("row.doc_id")).alias("held_out"), F.col("found.lang").alias("lang_pred"), "found.score",
        F.size("found.spans").alias("n_spans"),
    )


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words every document adds to the mix of sources."""
    return mixing.mix_plan(table(spark, sf_dir, "documents"))


def op3_shard_by_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near equal bytes."""
    docs = table(spark, sf_dir, "documents")
    text = F.col("text")
    # The text itself stays behind: its hash orders the rows, its length weighs them.
    narrow = docs.select(
        "doc_id", F.xxhash64("text").alias("key"), F.xxhash64("doc_id").alias("tie"),
        sharding.text_bytes(text).alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    )
    done = sharding.shard(narrow, F.col("key"), F.col("tie"), F.col("size"))
    return done.select(
        "row.doc_id", "size", "row.text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op4_zip_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records in ZIP packages, read back by ranges."""
    return warc.round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op5_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All page urls judged by rules, else by what trust and distrust their hosts get over links."""
    return linkgraph.judged(table(spark, sf_dir, "pages").select("page_id", "url", "html"), least=LEAST_DISTRUST)


def op6_drop_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document has too."""
    done = lines.without_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.sha2(F.col("kept.text").cast("binary"), 256)
    return done.select("row.doc_id", "kept.n_lines", "kept.n_dropped", kept.alias("kept_sha256"))


def op7_benchmark_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside windows of benchmark texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination.scanned(docs, table(spark, sf_dir, "benchmark"))
    names = F.sort_array(F.transform("report.items", lambda item: item.cast("string")))
    return found.select(
        "row.doc_id", "report.n_words", "report.n_hit", F.size("report.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        contamination.contaminated(F.col("report.n_hit"), F.col("report.n_words")).alias("contaminated"),
    )


def op8_hashed_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probabilities of every document under add-one counts and under the hashed model."""
    return lm.scored(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_shingle_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with three quarters of their shingles in common."""
    found = jaccard.grouped(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id")


def op10_vector_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 rows of largest inner product with every twentieth vector."""
    return vafile.top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)


def op11_run_length_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the strings of 200 bytes that occur again."""
    done = repeats.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("row.doc_id", "cut.n_bytes", "cut.n_removed", "cut.n_spans", F.sha2("cut.text", 256).alias("kept_sha256"))


def op12_lanczos_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every complete vector, one row a component."""
    done = whitening.whitened(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "pair")
    return done.select("row.vec_id", "n", "deviation", "identity_error", each).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "pair.whitened", "pair.explained", "identity_error"
    )


def op13_rollup_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations."""
    return turns.prefix_trie(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


QUERIES = {f.__name__: f for f in (
    op1_language_spans, op2_mix_sources, op3_shard_by_splitters, op4_zip_packages, op5_link_graph, op6_drop_repeated_lines, op7_benchmark_windows,
    op8_hashed_maxent, op9_shingle_components, op10_vector_cells, op11_run_length_repeats, op12_lanczos_whitening,
    op13_rollup_prefix_trie,
)}

SQL: dict[str, str] = {
    "op2_mix_sources": """
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), md5(text), '')) AS digest
  FROM documents
), coins AS (
  SELECT *, CAST(('0x' || substr(digest, 1, 13))::BIGINT AS DOUBLE) / 4503599627370496.0 AS coin FROM sized
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), sources AS (
  SELECT source, source_size, 2.0::DOUBLE * source_size AS cap,
         [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight
  FROM totals
), filled AS (
  SELECT *, coalesce(sum(cap) OVER before, 0.0) AS used, sum(weight) OVER rest AS open
  FROM sources
  WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         rest AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), levels AS (
  SELECT arg_min(level, cap / weight) AS level
  FROM (SELECT cap, weight, (1.5::DOUBLE * (SELECT sum(source_size) FROM sources) - used) / open AS level FROM filled)
  WHERE level <= cap / weight
), goals AS (
  SELECT source, source_size, least(cap, weight * level) AS target FROM sources, levels
), rated AS (
  SELECT c.*, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END AS rate
  FROM coins c JOIN goals g ON c.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target, CAST(floor(rate) AS BIGINT) + CAST(coin < rate - floor(rate) AS BIGINT) AS copies,
       size * (CAST(floor(rate) AS BIGINT) + CAST(coin < rate - floor(rate) AS BIGINT)) AS taken
FROM rated
""",
    "op6_drop_repeated_lines": """
WITH lines AS (
  SELECT row_id, doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos
  FROM (SELECT row_number() OVER () AS row_id, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), repeated AS (
  SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT row_id, doc_id, line, pos, first IS NOT NULL AND first <> doc_id AS gone FROM keyed LEFT JOIN repeated USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY row_id, doc_id
""",
    "op7_benchmark_windows": """
WITH words AS (
  SELECT doc_id, w, row_number() OVER () AS row_id
  FROM (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents)
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT item_id, len(w) AS size, array_to_string(w, ' ') AS gram FROM items WHERE len(w) BETWEEN 1 AND 12
  UNION ALL
  SELECT item_id, 13, array_to_string(w[pos:pos + 12], ' ') FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS pos FROM items WHERE len(w) >= 13)
), sizes AS (SELECT DISTINCT size FROM windows
), grams AS (
  SELECT row_id, pos, size, array_to_string(w[pos:pos + size - 1], ' ') AS gram
  FROM (SELECT row_id, w, size, unnest(range(1, len(w) - size + 2)) AS pos FROM words, sizes WHERE len(w) >= size)
), hits AS (SELECT DISTINCT row_id, pos, g.size, item_id FROM grams g JOIN windows USING (size, gram)
), places AS (
  SELECT row_id, count(DISTINCT place) AS n_hit
  FROM (SELECT row_id, unnest(range(pos, pos + size)) AS place FROM (SELECT DISTINCT row_id, pos, size FROM hits)) GROUP BY row_id
), held AS (
  SELECT row_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT row_id, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY row_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN places USING (row_id) LEFT JOIN held USING (row_id)
""",
    "op10_vector_cells": """
WITH rows AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM rows q JOIN rows c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
""",
    "op4_zip_packages": """
WITH rows AS (
  SELECT page_id, strlen(coalesce(html, '')) AS size, sha1(coalesce(html, '')) AS digest FROM pages
), groups AS (
  SELECT digest, max(page_id) AS first FROM rows WHERE size >= 1000 GROUP BY digest
)
SELECT page_id, size AS payload_bytes, digest AS payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM rows LEFT JOIN groups USING (digest)
""",
    "op11_run_length_repeats": """
WITH texts AS (
  SELECT row_number() OVER () AS row_id, doc_id, encode(coalesce(text, '')) AS b FROM documents
), windows AS (
  SELECT row_id, pos, md5(b[pos:pos + 199]) AS h FROM (SELECT row_id, b, unnest(range(1, octet_length(b) - 198)) AS pos FROM texts)
), repeated AS (
  SELECT h FROM windows GROUP BY h HAVING count(*) > 1
), starts AS (
  SELECT row_id, pos, coalesce(pos - lag(pos) OVER (PARTITION BY row_id ORDER BY pos) > 200, TRUE) AS fresh FROM windows SEMI JOIN repeated USING (h)
), numbered AS (
  SELECT row_id, pos, sum(CAST(fresh AS INT)) OVER (PARTITION BY row_id ORDER BY pos) AS span FROM starts
), spans AS (
  SELECT row_id, min(pos) AS lo, max(pos) + 199 AS hi FROM numbered GROUP BY row_id, span
), gaps AS (
  SELECT row_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY row_id ORDER BY lo), 0) AS before FROM spans
), cuts AS (
  SELECT row_id, count(*) AS n_spans, sum(hi - lo + 1) AS n_removed,
         string_agg(hex(b[before + 1:lo - 1]), '' ORDER BY lo) || hex(b[max(hi) + 1:octet_length(b)]) AS kept
  FROM gaps JOIN texts USING (row_id) GROUP BY row_id, b
)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(coalesce(unhex(kept), b)) AS kept_sha256
FROM texts LEFT JOIN cuts USING (row_id)
""",
    "op13_rollup_prefix_trie": """
WITH bits AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc
), turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT conv_id, pos, strlen(text) AS bytes, md5(CAST(strlen(role) AS VARCHAR) || ':' || role || text) AS id FROM turns
), convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
         xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
             lambda c, b: xor(crc[xor(c & 255, b) + 1], c >> 8))) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM ids), bits
), held AS (
  SELECT conv_id AS base, count(*) AS has FROM ids GROUP BY conv_id
), plan AS (
  SELECT conv_id, base, h, least(h, coalesce(has, 0)) AS taken FROM convs LEFT JOIN held USING (base)
), rebuilt AS (
  SELECT p.conv_id, i.pos, id, bytes FROM plan p JOIN ids i ON i.conv_id = p.base AND i.pos < p.taken
  UNION ALL
  SELECT p.conv_id, i.pos - p.h + p.taken, id, bytes FROM plan p JOIN ids i ON i.conv_id = p.conv_id AND i.pos >= p.h
), lists AS (
  SELECT conv_id, coalesce(list(id ORDER BY pos) FILTER (id IS NOT NULL), []) AS ids, coalesce(list(bytes ORDER BY pos) FILTER (id IS NOT NULL), []) AS sizes
  FROM plan LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id
), prefixes AS (
  SELECT conv_id, ids, sizes, depth, array_to_string(ids[1:depth], ' ') AS key, len(ids) = depth AS ends
  FROM (SELECT conv_id, ids, sizes, unnest(range(0, len(ids) + 1)) AS depth FROM lists)
), nodes AS (
  SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(ids[1:depth]) AS path,
         (count(*) - 1) * coalesce(any_value(sizes[depth]), 0) AS saved, CASE WHEN depth > 0 THEN array_to_string(any_value(ids[1:depth - 1]), ' ') END AS parent,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY key, depth
), children AS (
  SELECT parent AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent
), above AS (
  SELECT array_to_string(path[1:up], ' ') AS key, saved, n_children IS NULL AS leaf
  FROM (SELECT n.*, n_children, unnest(range(0, depth + 1)) AS up FROM nodes n LEFT JOIN children USING (key))
), summed AS (
  SELECT key, sum(saved) AS saved_tokens, count(*) FILTER (leaf) AS n_leaves FROM above GROUP BY key
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, s.n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN summed s USING (key) LEFT JOIN children c USING (key) LEFT JOIN nodes p ON n.parent = p.key
""",
}
