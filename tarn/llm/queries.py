"""The registered queries of this subpackage: thin digests over the operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from .bitsliced import top_k
from .bpe import encode_digest
from .decontaminate import decontamination_digest
from .frames import table
from .html import extract_text
from .jaccard import jaccard_components
from .licences import licence_scan
from .linededup import line_dedup_digest
from .merkle import manifest_proofs
from .quality import quality_scores
from .resample import resampling_digest
from .substring import substring_digest
from .suffixtree import suffix_tree_scores
from .warc import round_trip


#: Vocabulary of the registered tokenising query; the operator takes any rank file.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_byte_bpe(spark, sf_dir):
    return encode_digest(table(spark, sf_dir, "documents"), RANKS)


def op2_html_extraction(spark, sf_dir):
    return extract_text(table(spark, sf_dir, "pages"))


def op3_ngram_jaccard_join(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark, sf_dir):
    return substring_digest(table(spark, sf_dir, "documents"))


def op5_suffix_tree_scoring(spark, sf_dir):
    return suffix_tree_scores(table(spark, sf_dir, "documents"))


def op6_warc(spark, sf_dir):
    return round_trip(table(spark, sf_dir, "pages"))


def op7_quality_classifier(spark, sf_dir):
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_topk_bitsliced(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op9_licence_scan(spark, sf_dir):
    return licence_scan(table(spark, sf_dir, "documents"))


def op10_decontamination(spark, sf_dir):
    return decontamination_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_line_dedup(spark, sf_dir):
    return line_dedup_digest(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark, sf_dir):
    return manifest_proofs(table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark, sf_dir):
    return resampling_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_ALL = (
    op1_byte_bpe, op2_html_extraction, op3_ngram_jaccard_join, op4_substring_dedup, op5_suffix_tree_scoring, op6_warc, op7_quality_classifier,
    op8_topk_bitsliced, op9_licence_scan, op10_decontamination, op11_line_dedup, op12_merkle_manifest, op13_importance_resampling,
)
QUERIES = {f.__name__: f for f in _ALL}
#: CRC-32 in SQL: its table of 256 entries by rule, and the byte values of a string's UTF-8 form.
_CRC_TABLE = "(SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))) AS tab)"


def _crc(bytes_sql: str) -> str:
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {bytes_sql}), lambda c, b: xor(tab[xor(c, b) % 256 + 1], c >> 8)), 4294967295)"


def _bytes(text: str) -> str:
    return f"list_transform(range(strlen({text})), lambda i: CAST('0x' || substr(hex(encode({text})), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))"


ORACLES: dict[str, str] = {
    "op3_ngram_jaccard_join": r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(w[pos : pos + 4], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS pos FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a),
h AS (SELECT doc_id, md5(string_agg(g, '' ORDER BY g)) AS digest FROM s GROUP BY doc_id),
k AS (SELECT e.a AS doc_id, count(DISTINCT y.digest) AS n_links FROM e JOIN h x ON x.doc_id = e.a JOIN h y ON y.doc_id = e.b WHERE x.digest <> y.digest GROUP BY e.a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id) LEFT JOIN k USING (doc_id)
""",
    "op4_substring_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT r, doc_id, pos, md5(array_to_string(w[pos : pos + 49], ' ')) AS k FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS pos FROM d WHERE len(w) >= 50)),
m AS (SELECT k, min(doc_id) AS lo FROM p GROUP BY k),
g AS (SELECT DISTINCT r, unnest(range(pos, pos + 50)) AS x FROM p JOIN m USING (k) WHERE lo < doc_id),
u AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS x FROM d),
t AS (SELECT u.r, string_agg(word, ' ' ORDER BY u.x) AS kept, count(*) AS n FROM u LEFT JOIN g ON u.r = g.r AND u.x = g.x WHERE g.x IS NULL GROUP BY u.r)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN t USING (r)
""",
    "op6_warc": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
k AS (SELECT digest, n, max(page_id) AS keeper FROM p WHERE n >= 1000 GROUP BY ALL)
SELECT page_id, CAST(p.n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN keeper IS NOT NULL AND keeper IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keeper IS DISTINCT FROM page_id THEN keeper END AS refers_to
FROM p LEFT JOIN k ON p.digest = k.digest AND p.n = k.n
""",
    "op8_topk_bitsliced": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op10_decontamination": r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark WHERE item_id IS NOT NULL),
g AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[pos : pos + least(len(w), 10) - 1], ' ') AS gram
      FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS pos FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM g),
p AS (SELECT doc_id, pos, n, array_to_string(w[pos : pos + n - 1], ' ') AS gram FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS pos FROM d, sizes)),
h AS (SELECT doc_id, pos, p.n, item_id FROM p JOIN g ON p.n = g.n AND p.gram = g.gram),
c AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS x FROM h) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN i USING (doc_id)
""",
    "op11_line_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT r, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM d),
k AS (SELECT r, i, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM x),
c AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
s AS (SELECT r, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE c.key IS NULL), '') AS kept, count(*) AS n, count(c.key) AS gone FROM k LEFT JOIN c ON k.key = c.key GROUP BY r)
SELECT doc_id, CAST(n AS BIGINT) AS n_lines, CAST(gone AS BIGINT) AS n_dropped, sha256(kept) AS kept_sha256 FROM d JOIN s USING (r)
""",
    "op12_merkle_manifest": f"""
WITH RECURSIVE crc AS {_CRC_TABLE},
low AS (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered FROM documents),
f AS (SELECT doc_id, lang, lowered, text,
             concat(coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head FROM low),
v AS (SELECT doc_id, coalesce('1' || lang, '0') AS tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
             CASE WHEN {_crc(_bytes("CAST(doc_id AS VARCHAR)"))} % 3 = 0 THEN sha256(head || coalesce(strlen(lowered) || ':' || lowered, '-')) END AS changed FROM f, crc),
l AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM v),
a AS (SELECT tree, 0 AS lvl, pos, leaf AS d, count(*) OVER (PARTITION BY tree) AS n FROM l
      UNION ALL SELECT tree, min(lvl) + 1, pos // 8, sha256(string_agg(d, '' ORDER BY pos)), (min(n) + 7) // 8 FROM a WHERE n > 1 GROUP BY tree, pos // 8),
nodes AS MATERIALIZED (SELECT * FROM a),
sub AS MATERIALIZED (SELECT tree, row_number() OVER (ORDER BY tree) - 1 AS pos, d FROM nodes WHERE n = 1),
b AS (SELECT 0 AS lvl, pos, d, count(*) OVER () AS n FROM sub
      UNION ALL SELECT min(lvl) + 1, pos // 8, sha256(string_agg(d, '' ORDER BY pos)), (min(n) + 7) // 8 FROM b WHERE n > 1 GROUP BY pos // 8),
upper AS MATERIALIZED (SELECT * FROM b),
runs AS MATERIALIZED (SELECT tree, lvl, pos, tree AS up, lvl + 1 AS up_lvl, pos // 8 AS up_pos, true AS hashed,
       coalesce(string_agg(d, '') OVER (PARTITION BY tree, lvl, pos // 8 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
       coalesce(string_agg(d, '') OVER (PARTITION BY tree, lvl, pos // 8 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt
       FROM (SELECT tree, lvl, pos, d FROM nodes WHERE n > 1 UNION ALL SELECT '' AS tree, lvl, pos, d FROM upper WHERE n > 1)
       UNION ALL SELECT tree, lvl, nodes.pos, '', 0, sub.pos, false, '', '' FROM nodes JOIN sub USING (tree) WHERE n = 1),
p AS (SELECT tree AS own, pos AS place, tree, 0 AS lvl, pos, coalesce(changed, leaf) AS cur, '' AS proof FROM l
      UNION ALL SELECT p.own, p.place, up, up_lvl, up_pos, CASE WHEN hashed THEN sha256(lft || cur || rgt) ELSE cur END, proof || lft || rgt FROM p JOIN runs ON p.tree = runs.tree AND p.lvl = runs.lvl AND p.pos = runs.pos),
e AS (SELECT own, place, cur, proof FROM p JOIN upper ON p.tree = '' AND upper.n = 1 AND upper.lvl = p.lvl AND upper.pos = p.pos)
SELECT doc_id, leaf, sub.d AS subroot, (SELECT d FROM upper WHERE n = 1) AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = (SELECT d FROM upper WHERE n = 1) AS verified
FROM l JOIN e ON l.tree = e.own AND l.pos = e.place JOIN sub ON sub.tree = l.tree
""",
    "op13_importance_resampling": rf"""
WITH crc AS {_CRC_TABLE},
t AS (SELECT 0 AS kind, row_number() OVER () AS r, doc_id, text FROM documents UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark),
w AS MATERIALIZED (SELECT kind, r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM t),
f AS MATERIALIZED (SELECT kind, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g FROM w),
h AS MATERIALIZED (SELECT g, {_crc(_bytes("g"))} % 10000 AS bucket FROM (SELECT DISTINCT g FROM f), crc),
c AS MATERIALIZED (SELECT kind, r, bucket, count(*) AS n FROM f JOIN h USING (g) GROUP BY ALL),
m AS (SELECT b.bucket, CAST(coalesce(sum(n) FILTER (WHERE kind = 0), 0) AS DOUBLE) AS s, CAST(coalesce(sum(n) FILTER (WHERE kind = 1), 0) AS DOUBLE) AS t FROM (SELECT unnest(range(10000)) AS bucket) b LEFT JOIN c ON b.bucket = c.bucket GROUP BY b.bucket),
o AS (SELECT sum(s) AS ss, sum(t) AS tt FROM m),
gain AS (SELECT bucket, CAST(floor(1000 * ln((t + 1) * (ss + 10000) / ((s + 1) * (tt + 10000)))) AS BIGINT) AS gain FROM m, o),
u AS (SELECT r, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS total FROM c JOIN gain USING (bucket) WHERE kind = 0 GROUP BY r),
z AS (SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, CASE WHEN n_features > 0 THEN (total - ((total % n_features) + n_features) % n_features) // n_features ELSE 0 END AS weight,
             CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) AS h FROM w LEFT JOIN u ON w.r = u.r WHERE kind = 0),
y AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM z),
k AS (SELECT *, n_words >= 20 AND score IS NOT NULL AS enough FROM y),
q AS (SELECT *, row_number() OVER (PARTITION BY enough ORDER BY score DESC, doc_id, n_features) AS place, count(*) OVER (PARTITION BY enough) AS n FROM k)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score, CASE WHEN enough AND place <= 25 * n // 100 THEN CAST(place AS BIGINT) END AS rank FROM q
""",
}
