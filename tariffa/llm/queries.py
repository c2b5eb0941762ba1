"""Queries of the subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from tariffa.llm import bpe, chat, decontaminate, divergence, forest, langid, minhash, periods, pii, quality, sharding, subspaces, substrings

QUERIES = {"op1_gear_chunks": substrings.op1_gear_chunks, "op10_site_quality": quality.op10_site_quality, "op11_subspace_join": subspaces.op11_subspace_join, "op12_source_divergence": divergence.op12_source_divergence, "op13_periodic_runs": periods.op13_periodic_runs, "op2_prefix_forest": forest.op2_prefix_forest, "op3_byte_bpe": bpe.op3_byte_bpe, "op4_spaced_seeds": decontaminate.op4_spaced_seeds, "op5_minhash_join": minhash.op5_minhash_join, "op6_hilbert_shards": sharding.op6_hilbert_shards, "op7_kneser_ney": langid.op7_kneser_ney, "op8_prefix_tree": chat.op8_prefix_tree, "op9_pii_anchors": pii.op9_pii_anchors}
#: The operators that SQL can express. MinHash may miss a link at the threshold once in ten thousand.
ORACLE_SQL: dict[str, str] = {
    "op11_subspace_join": r"""
WITH RECURSIVE t AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings WHERE vec_id IS NOT NULL),
u AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS size FROM t WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE list_dot_product(a.v, b.v) >= 0.95 * a.size * b.size),
r(k, root) AS (SELECT vec_id, vec_id FROM t UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.k),
c AS (SELECT k, min(root) AS root FROM r GROUP BY k),
n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.root AS component_id, vec_id = c.root AS kept FROM t JOIN c ON c.k = vec_id LEFT JOIN n ON n.a = vec_id""",
    "op12_source_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
o AS (SELECT r, lang, source, unnest(terms) AS term FROM d),
k AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT g.lang, count(k.term)::HUGEINT AS v FROM (SELECT DISTINCT lang FROM g) g LEFT JOIN k USING (lang) GROUP BY g.lang),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM o JOIN k USING (lang, term) GROUP BY lang, source, term),
s AS (SELECT g.lang, g.source, coalesce(sum(n), 0)::HUGEINT AS own FROM g LEFT JOIN c USING (lang, source) GROUP BY g.lang, g.source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (s.own + v.v) AS p
  FROM g JOIN k USING (lang) JOIN v USING (lang) JOIN s USING (lang, source) LEFT JOIN c USING (lang, source, term)),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 1)::HUGEINT) // (sum(sum(n)) OVER (PARTITION BY lang) + any_value(v.v))::HUGEINT AS q FROM p JOIN v USING (lang) GROUP BY lang, term),
m AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum(((x.p - y.p) * (x.p - y.p)) // y.p), 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
t AS (SELECT lang, source, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM m
UNION ALL SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER FROM t QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) <= 200""",
    "op5_minhash_join": r"""
WITH RECURSIVE t AS (SELECT doc_id, coalesce(text, '') AS body FROM documents WHERE doc_id IS NOT NULL),
c AS (SELECT body, min(doc_id) AS class_id, count(*)::BIGINT AS n_copies FROM t GROUP BY body),
w AS (SELECT class_id, list_filter(string_split_regex(lower(body), '[\t\n\x0b\x0c\r \x1c-\x1f]+'), lambda x: x <> '') AS words FROM c),
s AS (SELECT DISTINCT class_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
      ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT class_id, count(*) AS n FROM s GROUP BY class_id),
p AS (SELECT a.class_id AS a, b.class_id AS b, count(*) AS n FROM s a JOIN s b ON a.g = b.g AND a.class_id <> b.class_id GROUP BY ALL),
e AS (SELECT p.a, p.b FROM p JOIN n x ON x.class_id = p.a JOIN n y ON y.class_id = p.b WHERE p.n >= 0.8 * (x.n + y.n - p.n)),
r(k, root) AS (SELECT class_id, class_id FROM c UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.k),
h AS (SELECT k, min(root) AS group_id FROM r GROUP BY k),
l AS (SELECT a, count(*)::BIGINT AS n_links FROM e GROUP BY a)
SELECT doc_id, class_id, n_copies, group_id, coalesce(n_links, 0) AS n_links FROM t JOIN c USING (body) JOIN h ON h.k = class_id LEFT JOIN l ON l.a = class_id""",
    "op8_prefix_tree": r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, i, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r)),
o AS (SELECT *, replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n') AS line, replace(replace(text, '\', '\\'), '<|', '<\|') AS body FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  sum(length(line) + length(body) + 24)::BIGINT AS formatted_chars FROM o GROUP BY conv_id""",
}
