"""The same results in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op1_exact_topk"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

SQL["op3_line_dedup"] = r"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), rows AS (
    SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split
), keyed AS (
    SELECT doc_id, line, pos, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM rows
), frequent AS (
    SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
    SELECT k.*, f.key IS NOT NULL AS drop_it FROM keyed k LEFT JOIN frequent f ON k.key = f.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (drop_it)::BIGINT AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT drop_it), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

SQL["op2_suffix_dedup"] = r"""
WITH docs AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), parts AS (
    SELECT doc_id, length(x) // 2 AS n, start, substr(x, 2 * start + 1, 2 * (256 + 99)) AS part
    FROM (SELECT *, unnest(range(0, length(x) // 2, 256)) AS start FROM docs)
), places AS (
    SELECT *, unnest(range(least(256, n - start))) AS k FROM parts
), windows AS (
    SELECT doc_id, start + k AS i, substr(part, 2 * k + 1, 2) AS byte,
        CASE WHEN start + k + 100 <= n THEN md5(substr(part, 2 * k + 1, 200)) END AS k
    FROM places
), repeats AS (
    SELECT *, k IS NOT NULL AND row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1 AS again FROM windows
), covered AS (
    SELECT *, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone FROM repeats
), runs AS (
    SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS begins FROM covered
), kept AS (
    SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_spans,
        coalesce(string_agg(byte, '' ORDER BY i) FILTER (NOT gone), '') AS rest
    FROM runs GROUP BY doc_id
)
SELECT doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
    coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(rest, ''))) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

SQL["op6_chosen_path"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
        lambda w: w <> '') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) < 2 THEN w
        ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
    FROM words
), shingles AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
    SELECT doc_id, doc_id AS root FROM sets
    UNION
    SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.doc_id
), lowest AS (
    SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN lowest USING (doc_id)
"""

SQL["op11_merkle_manifest"] = r"""
WITH RECURSIVE
texts AS (
  SELECT doc_id, source, lang, n_chars, text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
    list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(length(doc_id::VARCHAR)), lambda k: ascii(substr(doc_id::VARCHAR, k + 1, 1))::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda s, k: CASE WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END)
    ) AS crc
  FROM documents
),
coded AS (
  SELECT doc_id, source, lowered, text,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS others,
    xor(crc, 4294967295) % 5 = 0 AS changed
  FROM texts
),
leaves AS (
  SELECT doc_id, source, sha256(others || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN changed THEN sha256(others || coalesce(strlen(lowered) || ':' || lowered, '-')) END AS claimed
  FROM coded
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree
  FROM leaves
),
lower_tree AS (
  SELECT tree, 0 AS level, i, n, leaf AS h FROM placed
  UNION ALL
  SELECT tree, level + 1, i // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY i)) FROM lower_tree WHERE n > 1 GROUP BY tree, level, i // 16, n
),
upper_tree AS (
  SELECT 0 AS level, tree AS i, count(*) OVER () AS n, h FROM lower_tree WHERE n = 1
  UNION ALL
  SELECT level + 1, i // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY i)) FROM upper_tree WHERE n > 1 GROUP BY level, i // 16, n
),
runs AS (
  SELECT tree, level, i // 16 AS run, list(h ORDER BY i) AS members FROM lower_tree WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT -1, level, i // 16, list(h ORDER BY i) FROM upper_tree WHERE n > 1 GROUP BY ALL
),
walk AS (
  SELECT row_number() OVER () AS leaf_no, doc_id, leaf, tree AS top, tree AS at_tree, 0 AS level, i, coalesce(claimed, leaf) AS v, '' AS siblings, false AS done FROM placed
  UNION ALL
  SELECT leaf_no, doc_id, leaf, top,
    CASE WHEN r.run IS NULL THEN -1 ELSE at_tree END,
    CASE WHEN r.run IS NULL THEN 0 ELSE w.level + 1 END,
    CASE WHEN r.run IS NULL THEN top ELSE i // 16 END,
    CASE WHEN r.run IS NULL THEN v
      ELSE sha256(array_to_string(members[1 : i % 16], '') || v || array_to_string(members[i % 16 + 2 :], '')) END,
    CASE WHEN r.run IS NULL THEN siblings
      ELSE siblings || array_to_string(members[1 : i % 16], '') || array_to_string(members[i % 16 + 2 :], '') END,
    r.run IS NULL AND at_tree = -1
  FROM walk w LEFT JOIN runs r ON r.tree = w.at_tree AND r.level = w.level AND r.run = w.i // 16
  WHERE NOT done
)
SELECT w.doc_id, w.leaf, s.h AS subroot, t.h AS root, sha256(w.siblings) AS proof_sha256, w.v AS folded_root, w.v = t.h AS verified
FROM walk w JOIN lower_tree s ON s.tree = w.top AND s.n = 1 JOIN upper_tree t ON t.n = 1
WHERE w.done
"""

SQL["op13_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?' || chr(11) || chr(12) || chr(13) || chr(9), 'abcdefghijklmnopqrstuvwxyz' || repeat(chr(10), 9) || ' '), chr(10))) AS piece
  FROM documents
),
words AS (SELECT lang, list_filter(string_split(piece, ' '), lambda w: w <> '') AS w FROM pieces),
grams AS (
  SELECT lang, m, array_to_string(w[s : s + m - 1], ' ') AS phrase, w[s : s + m - 1] AS parts
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM words, (VALUES (1), (2), (3), (4)) AS sizes(m) WHERE len(w) >= m)
),
f AS MATERIALIZED (SELECT lang, m, phrase, any_value(parts) AS parts, count(*) AS f FROM grams GROUP BY lang, m, phrase),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
candidates AS (SELECT * FROM f WHERE m > 1 AND f >= 30),
halves AS MATERIALIZED (
  SELECT lang, phrase, f AS a, k, array_to_string(parts[1 : k], ' ') AS head, array_to_string(parts[k + 1 :], ' ') AS rest
  FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates)
),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a // (x.f::HUGEINT + y.f))::BIGINT AS score
  FROM halves c JOIN f x ON x.lang = c.lang AND x.phrase = c.head JOIN f y ON y.lang = c.lang AND y.phrase = c.rest
),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(parts[s : s + k - 1], ' ') AS phrase, max(f) AS longer
  FROM (SELECT *, unnest(range(1, m - k + 2)) AS s FROM (SELECT *, unnest(range(2, m)) AS k FROM candidates WHERE m > 2))
  GROUP BY ALL
),
kept AS (
  SELECT b.*, t.n, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, encode(b.phrase)) AS rank
  FROM best b JOIN totals t USING (lang) LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE i.longer IS NULL OR 100::HUGEINT * i.longer < 80::HUGEINT * b.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM kept WHERE rank <= 2000
"""
