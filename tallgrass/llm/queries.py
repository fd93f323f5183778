"""The registered queries of this subpackage, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.llm import graph_ann, html_text, language, mixing, tokens, warc
from tallgrass.llm.contamination import contained_items
from tallgrass.llm.lines import fuzzy_lines
from tallgrass.llm.near_dups import near_duplicates
from tallgrass.llm.repeated import remove_repeats
from tallgrass.plans.durable import scratch
from tallgrass.sources.tables import table


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.learn(docs))
    return found.withColumn("held_out", language.held_out(F.col("doc_id"))).select("doc_id", "held_out", "lang_pred", "score")


def op2_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    index = warc.write_bundles(table(spark, sf_dir, "pages"), folder)
    return warc.read_bundles(spark, folder, index).drop("target")


def op3_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens")
    tokens.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_file())
    return tokens.with_crc(tokens.read_tokens(spark, path))


def op5_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op6_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return graph_ann.search(graph_ann.build_index(vectors), vectors.where(F.col("vec_id") % 20 == 0))


def op7_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines(table(spark, sf_dir, "documents"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op9_minhash_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=4)


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_warc_bundles": op2_warc_bundles,
    "op3_benchmark_containment": op3_benchmark_containment,
    "op4_token_files": op4_token_files,
    "op5_html_main_text": op5_html_main_text,
    "op6_graph_neighbours": op6_graph_neighbours,
    "op7_fuzzy_lines": op7_fuzzy_lines,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_minhash_near_dups": op9_minhash_near_dups,
    "op10_mix_sources": op10_mix_sources,
}

ORACLES = {
    "op2_warc_bundles": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS top FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN top <> page_id THEN top END AS refers_to
FROM m
""",
    "op3_benchmark_containment": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS ws FROM documents WHERE text IS NOT NULL),
d AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))) AS s FROM w),
v AS (SELECT item_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS ws FROM benchmark WHERE text IS NOT NULL),
b AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))) AS s FROM v),
n AS (SELECT item_id, count(*) AS n_shingles FROM b GROUP BY item_id)
SELECT d.doc_id, b.item_id, n.n_shingles, count(*) AS n_shared, count(*) / n.n_shingles AS containment
FROM d JOIN b ON d.s = b.s JOIN n ON b.item_id = n.item_id
GROUP BY d.doc_id, b.item_id, n.n_shingles HAVING count(*) * 100 >= n.n_shingles * 80
""",
    "op7_fuzzy_lines": r"""
WITH RECURSIVE t AS (SELECT doc_id, string_split(text, chr(10)) AS own FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, unnest(range(len(own))) AS line, unnest(own) AS s FROM t),
v AS (SELECT doc_id, line::BIGINT AS line, s FROM l WHERE regexp_matches(s, '[^\x00-\x20]')),
c AS (SELECT s, row_number() OVER (ORDER BY s) AS id FROM (SELECT DISTINCT s FROM v)),
g AS (SELECT id, list_distinct(list_transform(range(1, greatest(length(s) - 6, 1) + 1), lambda i: substring(s, i, 7))) AS sh FROM c),
e AS (SELECT id, len(sh) AS n, unnest(sh) AS h FROM g),
o AS (SELECT h, count(*) AS often FROM e GROUP BY h),
k AS (SELECT id, n, h, row_number() OVER (PARTITION BY id ORDER BY often, h) AS place FROM e JOIN o USING (h)),
f AS (SELECT id, n, h FROM k WHERE place <= n - ceil(n * 80 / 100) + 1),
q AS (SELECT DISTINCT x.id AS a, y.id AS b FROM f x JOIN f y ON x.h = y.h AND x.id < y.id AND x.n * 100 >= 80 * y.n AND y.n * 100 >= 80 * x.n),
p AS (SELECT a, b FROM (SELECT a, b, len(list_intersect(x.sh, y.sh)) AS shared, len(x.sh) + len(y.sh) AS total FROM q JOIN g x ON x.id = a JOIN g y ON y.id = b)
      WHERE shared * 100 >= 80 * (total - shared)),
r AS (SELECT id AS v, id AS u FROM c UNION SELECT r.v, z.b FROM r JOIN (SELECT a, b FROM p UNION ALL SELECT b, a FROM p) z ON r.u = z.a),
m AS (SELECT v AS id, min(u) AS root FROM r GROUP BY v),
w AS (SELECT doc_id, line, root FROM v JOIN c USING (s) JOIN m USING (id)),
d AS (SELECT root, doc_id AS first_doc_id, line AS first_line FROM w QUALIFY row_number() OVER (PARTITION BY root ORDER BY doc_id NULLS LAST, line) = 1)
SELECT doc_id, line, first_doc_id, first_line, (doc_id IS NOT DISTINCT FROM first_doc_id AND line = first_line) AS kept
FROM w JOIN d USING (root)
""",
    "op8_suffix_array_dedup": r"""
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99, 250)) AS a FROM b),
v AS (SELECT doc_id, a, substring(h, 2 * a + 1, 698) AS piece, unnest(range(least(250, len(h) // 2 - 99 - a))) AS j FROM c),
m AS (SELECT doc_id, i FROM (SELECT doc_id, a + j AS i, row_number() OVER (PARTITION BY substring(piece, 2 * j + 1, 200) ORDER BY doc_id NULLS FIRST, a + j) AS nth FROM v) WHERE nth > 1),
s AS (SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 100, true) AS fresh FROM m),
r AS (SELECT doc_id, i, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM s),
p AS (SELECT doc_id, min(i) AS x, max(i) + 100 AS y FROM r GROUP BY doc_id, run),
k AS (SELECT doc_id, x, y, coalesce(lag(y) OVER (PARTITION BY doc_id ORDER BY x), 0) AS z FROM p),
g AS (SELECT k.doc_id, count(*) AS n_spans, sum(y - x) AS n_removed, string_agg(substring(h, 2 * z + 1, 2 * (x - z)), '' ORDER BY x) || substring(any_value(h), 2 * max(y) + 1) AS kept
      FROM k JOIN b ON k.doc_id IS NOT DISTINCT FROM b.doc_id GROUP BY k.doc_id)
SELECT b.doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM b LEFT JOIN g ON b.doc_id IS NOT DISTINCT FROM g.doc_id
""",
    "op9_minhash_near_dups": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text,''),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i+3], ' '))
      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w),
n AS (SELECT doc_id, len(sh)::BIGINT AS n, list_sort(sh) as sh FROM g),
c AS (SELECT min(doc_id) AS id, sh, any_value(n) AS n FROM n WHERE n > 0 GROUP BY sh),
e AS (SELECT id, n, unnest(sh) AS s FROM c),
p AS (SELECT a.id AS a, b.id AS b FROM e a JOIN e b ON a.s = b.s AND a.id < b.id AND a.n * 100 >= 80 * b.n AND b.n * 100 >= 80 * a.n
      GROUP BY a.id, b.id, a.n, b.n HAVING count(*) * 100 >= 80 * (a.n + b.n - count(*))),
r AS (SELECT id AS v, id AS u FROM c UNION SELECT r.v, q.b FROM r JOIN (SELECT a, b FROM p UNION ALL SELECT b, a FROM p) q ON r.u = q.a),
m AS (SELECT v, min(u) AS component_id FROM r GROUP BY v)
SELECT n.doc_id, n.n AS n_shingles, CASE WHEN n.n > 0 THEN m.component_id ELSE n.doc_id END AS component_id, n.doc_id = coalesce(m.component_id, n.doc_id) AS kept
FROM n LEFT JOIN c ON n.sh = c.sh LEFT JOIN m ON m.v = c.id
""",
    "op10_mix_sources": r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS draw FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank, sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE AS wanted FROM s),
w AS (SELECT *, ([3.0, 1.0, 2.0][(rank % 3) + 1])::DOUBLE AS weight, source_size * 2.0::DOUBLE AS cap FROM r),
f AS (SELECT *, cap / weight AS full_at,
    (wanted - coalesce(sum(cap) OVER o, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
  FROM w WINDOW o AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, CASE WHEN full_at <= level THEN cap ELSE weight *
    ((wanted - coalesce(sum(CASE WHEN full_at <= level THEN cap END) OVER (), 0)) / nullif(sum(CASE WHEN full_at <= level THEN 0 ELSE weight END) OVER (), 0)) END AS target FROM f),
g AS (SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS whole FROM t),
c AS (SELECT d.*, g.source_size, g.target, g.whole, g.target - g.whole * g.source_size AS spare,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN spare > 0 AND ahead + size / 2.0 <= spare THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
""",
}
