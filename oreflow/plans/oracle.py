"""SQL equivalents of the registered queries, over the same tables."""

from __future__ import annotations

from oreflow.operators import lloyd, messages
from oreflow.operators.clusters import TOP_TERMS
from oreflow.plans.catalog import (
    EMBEDDING_DIMS,
    EVENTS_PER_BATCH,
    K,
    LLOYD_ITERATIONS,
    LOW_OVERLAP,
    LARGE_ID,
    PAIR_SUPPORT,
    STREAM_FILES,
    SUPPORT,
    TAG_PLACES,
)

_SURVEY = """
survey AS (
  SELECT n_name AS country,
    CASE WHEN o_orderkey % 10 = 0 THEN 'NA'
         WHEN o_orderkey % 10 = 1 THEN '0'
         WHEN o_orderkey % 10 = 2 THEN NULL
         ELSE (CASE WHEN whole >= 1000
                    THEN CAST(whole // 1000 AS VARCHAR) || ',' || lpad(CAST(whole % 1000 AS VARCHAR), 3, '0')
                    ELSE CAST(whole AS VARCHAR) END)
              || (CASE WHEN o_orderkey % 500 = 3 THEN '000000' ELSE '' END) END AS salary,
    CASE o_orderkey % 4 WHEN 0 THEN 'Monthly' WHEN 1 THEN 'weekly' WHEN 2 THEN 'Yearly' ELSE 'NA' END AS salary_type
  FROM (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS whole FROM orders) o
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
), valid AS (
  SELECT *,
    CAST(replace(salary, ',', '') AS BIGINT)
      * (CASE lower(salary_type) WHEN 'monthly' THEN 12 WHEN 'weekly' THEN 52 ELSE 1 END) AS yearly
  FROM survey WHERE salary IS NOT NULL AND salary NOT IN ('NA', '0')
)"""

_COUNTS = f"WITH {_SURVEY} SELECT country, count(*) AS n FROM valid GROUP BY country"


def _salary_stats(lowest: str, highest: str) -> str:
    return f"""WITH {_SURVEY}
SELECT country, count(*) AS n, {lowest} AS min_salary, {highest} AS max_salary,
  CAST((2 * 100 * sum(yearly) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS mean_salary
FROM valid GROUP BY country"""


_CLAMPED = _salary_stats(
    "CAST(least(min(yearly), 2147483647) AS INTEGER)", "CAST(least(max(yearly), 2147483647) AS INTEGER)"
)

_RATINGS = """
ratings AS (
  SELECT o_custkey AS u, l_suppkey AS i, avg(1 + l_partkey % 5) AS r
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2
), train AS (
  SELECT * FROM ratings
  WHERE ((u * 31 + i) % 10 <> 0 OR (u + i) % 7 = 0) AND u % 50 <> 0 AND i % 25 <> 0
), test AS (
  SELECT * FROM ratings WHERE (u * 31 + i) % 10 = 0 OR u % 50 = 0 OR i % 25 = 0
), us AS (
  SELECT u, avg(r) AS um, sqrt(sum(r * r)) AS norm, count(*) AS ratings, count(*) > 20 AS heavy FROM train GROUP BY u
), its AS (
  SELECT i, avg(r) AS im, count(*) AS raters FROM train GROUP BY i
)"""


def _weights(overlap: int, centering: str = "sum") -> str:
    factor = "(n - 2)" if centering == "sum" else "(-1.0 / n)"
    return f"""{_RATINGS}, co AS (
  SELECT a.u AS u, b.u AS v, count(*) AS n, sum(a.r) AS sa, sum(b.r) AS sb,
    sum(a.r * b.r) AS sab, sum(a.r * a.r) AS saa, sum(b.r * b.r) AS sbb
  FROM train a JOIN us x ON a.u = x.u AND NOT x.heavy
  JOIN train b ON a.i = b.i JOIN us y ON b.u = y.u AND y.heavy
  GROUP BY 1, 2 HAVING count(*) > {overlap}
), w AS (
  SELECT co.u, co.v, n AS overlap, sab / (x.norm * y.norm) AS cosine, sb / n AS vm,
    coalesce((sab + {factor} * sa * sb)
      / nullif(sqrt(greatest((saa + {factor} * sa * sa) * (sbb + {factor} * sb * sb), 0)), 0), 0) AS weight
  FROM co JOIN us x ON co.u = x.u JOIN us y ON co.v = y.u
  WHERE sab / (x.norm * y.norm) > 0.5
)"""


def _neighbours(overlap: int, centering: str = "sum") -> str:
    return f"""WITH {_weights(overlap, centering)}
SELECT u AS "user", v AS neighbour, overlap, round(cosine, 6) AS cosine, round(weight, 6) AS weight,
  round(vm, 6) AS neighbour_mean FROM w"""


def _predicted(overlap: int = 12, centering: str = "sum", iuf: bool = True, clamp: bool = False) -> str:
    scale = "* (ln((SELECT count(*) FROM us)) - ln(raters))" if iuf else ""
    value = f"""CASE rule WHEN 1 THEN 2.5 WHEN 2 THEN im WHEN 3 THEN um WHEN 4 THEN known
    ELSE CASE WHEN s IS NULL THEN (um + im) / 2 ELSE (um + coalesce(p / nullif(s, 0), 0)) {scale} END END"""
    if clamp:
        value = f"least(greatest({value}, 1.0), 5.0)"
    return f"""WITH {_weights(overlap, centering)}, tagged AS (
  SELECT t.u, t.i, t.r, us.um, us.heavy, its.im, its.raters, k.r AS known,
    CASE WHEN us.u IS NULL AND its.i IS NULL THEN 1 WHEN us.u IS NULL THEN 2
         WHEN its.i IS NULL OR us.heavy THEN 3 WHEN k.r IS NOT NULL THEN 4 ELSE 5 END AS rule
  FROM test t LEFT JOIN us ON t.u = us.u LEFT JOIN its ON t.i = its.i
  LEFT JOIN train k ON t.u = k.u AND t.i = k.i
), votes AS (
  SELECT g.u, g.i, sum((b.r - w.vm) * w.weight) AS p, sum(abs(w.weight)) AS s
  FROM tagged g JOIN w ON g.u = w.u JOIN train b ON b.u = w.v AND b.i = g.i
  WHERE g.rule = 5 GROUP BY 1, 2
), scored AS (
  SELECT g.u, g.i, g.r, g.rule, {value} AS prediction
  FROM tagged g LEFT JOIN votes ON g.u = votes.u AND g.i = votes.i
)"""


_PREDICTION_COLUMNS = 'SELECT u AS "user", i AS item, rule, round(prediction, 6) AS prediction FROM scored'


def _bands(error: str) -> str:
    return f"""{_predicted()}, bands(band, label, low, high) AS (
  VALUES (0, '>=0 and <1', -1e300, 1.0), (1, '>=1 and <2', 1.0, 2.0), (2, '>=2 and <3', 2.0, 3.0),
         (3, '>=3 and <4', 3.0, 4.0), (4, '>=4', 4.0, 1e300))
SELECT CAST(band AS INTEGER) AS band, label, count(e) AS n
FROM bands LEFT JOIN (SELECT {error} AS e FROM scored) s ON e >= low AND e < high
GROUP BY band, label"""


_BASKETS = """
baskets AS (
  SELECT DISTINCT o_custkey AS b, l_suppkey AS i FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""


def _levels(support: int) -> str:
    """Itemsets of one to four items; the fourth level shows that larger sets are complete."""
    return f"""{_BASKETS}, l1 AS (
  SELECT i AS i1, count(*) AS freq FROM baskets GROUP BY 1 HAVING count(*) >= {support}
), l2 AS (
  SELECT a.i AS i1, c.i AS i2, count(*) AS freq FROM baskets a JOIN baskets c ON a.b = c.b AND a.i < c.i
  GROUP BY 1, 2 HAVING count(*) >= {support}
), l3 AS (
  SELECT p.i1, p.i2, c.i AS i3, count(*) AS freq
  FROM l2 p JOIN baskets a ON a.i = p.i1 JOIN baskets d ON d.b = a.b AND d.i = p.i2
  JOIN baskets c ON c.b = a.b AND c.i > p.i2
  GROUP BY 1, 2, 3 HAVING count(*) >= {support}
), l4 AS (
  SELECT t.i1, t.i2, t.i3, e.i AS i4, count(*) AS freq
  FROM l3 t JOIN baskets a ON a.i = t.i1 JOIN baskets d ON d.b = a.b AND d.i = t.i2
  JOIN baskets c ON c.b = a.b AND c.i = t.i3 JOIN baskets e ON e.b = a.b AND e.i > t.i3
  GROUP BY 1, 2, 3, 4 HAVING count(*) >= {support}
), found AS (
  SELECT 1 AS size, '(' || i1 || ')' AS label, freq FROM l1 UNION ALL
  SELECT 2, '(' || i1 || ', ' || i2 || ')', freq FROM l2 UNION ALL
  SELECT 3, '(' || i1 || ', ' || i2 || ', ' || i3 || ')', freq FROM l3 UNION ALL
  SELECT 4, '(' || i1 || ', ' || i2 || ', ' || i3 || ', ' || i4 || ')', freq FROM l4
)"""


_ITEMSETS = f"WITH {_levels(SUPPORT)} SELECT CAST(size AS INTEGER) AS size, label, freq FROM found"

# Words of a text: trailing spaces dropped, then split on single spaces.
_WORDS = """
lines AS (
  SELECT doc_id, lang, replace(text, chr(10), ' ') AS line FROM documents
), words AS (
  SELECT doc_id, lang, unnest(CASE WHEN line = '' THEN [''] WHEN rtrim(line, ' ') = '' THEN []
                              ELSE string_split(rtrim(line, ' '), ' ') END) AS word
  FROM lines
)"""

_VECTORS = f"""
vectors AS (
  SELECT vec_id, unnest(range({EMBEDDING_DIMS})) AS dim, CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings
), start AS (
  SELECT vec_id, row_number() OVER (ORDER BY md5('{lloyd.SEED}-' || vec_id), vec_id) - 1 AS cluster
  FROM embeddings ORDER BY md5('{lloyd.SEED}-' || vec_id), vec_id LIMIT {K}
), c0 AS (
  SELECT cluster, dim, value FROM vectors JOIN start USING (vec_id)
)"""


def _assignment(name: str, centroids: str) -> str:
    return f"""{name} AS (
  SELECT vec_id, arg_min(cluster, (d2, cluster)) AS cluster, min(d2) AS d2
  FROM (SELECT v.vec_id, c.cluster, sum((v.value - c.value) * (v.value - c.value)) AS d2
        FROM vectors v JOIN {centroids} c ON v.dim = c.dim GROUP BY 1, 2) GROUP BY vec_id
)"""


def _lloyd() -> str:
    parts = [_VECTORS]
    for i in range(LLOYD_ITERATIONS + 1):
        parts.append(_assignment(f"a{i}", f"c{i}"))
        parts.append(f"""c{i + 1} AS (
  SELECT c.cluster, c.dim, coalesce(m.value, c.value) AS value FROM c{i} c
  LEFT JOIN (SELECT a.cluster, v.dim, avg(v.value) AS value FROM vectors v JOIN a{i} a ON v.vec_id = a.vec_id
             GROUP BY 1, 2) m ON m.cluster = c.cluster AND m.dim = c.dim
)""")
    parts.append(_assignment("final", f"c{LLOYD_ITERATIONS + 1}"))
    return ",".join(parts)


_MESSAGES = """
messages AS (
  SELECT event_id AS id, 'evt' || chr(10) || '#' || event_type || ' #' || event_type || '#u' || user_id AS text
  FROM events
)"""

# The three tags of a message, in order, as its construction gives them.
_TAGS = f"""
tags AS (
  SELECT event_id * {TAG_PLACES} + 1 AS seq, event_type AS tag FROM events UNION ALL
  SELECT event_id * {TAG_PLACES} + 2, event_type FROM events UNION ALL
  SELECT event_id * {TAG_PLACES} + 3, 'u' || user_id FROM events
)"""

_SAMPLE = f"""{_MESSAGES}, sample AS (
  SELECT id, text, md5('{messages.SEED}-' || id) AS priority FROM messages
  ORDER BY priority, id LIMIT {messages.SAMPLE_SIZE}
), sample_tags AS (
  SELECT tag, count(*) AS n FROM (
    SELECT unnest([regexp_extract(text, '\\n#([^ ]*) ', 1), regexp_extract(text, ' #([^#]*)#', 1),
                   regexp_extract(text, '#(u[0-9]+)$', 1)]) AS tag FROM sample) GROUP BY tag
)"""

_HOT = f"(SELECT tag, n FROM sample_tags ORDER BY n DESC, tag LIMIT {messages.HOT_TAGS})"

_BLOOM = f"""{_TAGS}, hashed AS (
  SELECT tag, min(seq) AS seq,
    list_reduce(list_transform(string_split(tag, ''), lambda c: CAST(unicode(c) AS BIGINT)),
                lambda a, x: (a * 31 + x) & 4294967295) AS raw
  FROM tags GROUP BY tag
), by_tag AS (
  SELECT tag, seq, CAST(CASE WHEN raw > 2147483647 THEN raw - 4294967296 ELSE raw END AS INTEGER) AS tag_hash
  FROM hashed
), by_hash AS (
  SELECT tag_hash, min(seq) AS seq FROM by_tag GROUP BY tag_hash
), slots AS (
  SELECT slot, min(seq) AS since FROM (
    SELECT abs(tag_hash % 64) AS slot, seq FROM by_hash UNION ALL SELECT abs(tag_hash % 59), seq FROM by_hash)
  GROUP BY slot
)"""


def _marked(first: str) -> str:
    return f"""(SELECT f.*, (a.since < f.seq AND b.since < f.seq) AS false_positive FROM {first} f
  JOIN slots a ON a.slot = abs(f.tag_hash % 64) JOIN slots b ON b.slot = abs(f.tag_hash % 59))"""


_BLOOM_SUMMARY = f"""WITH {_BLOOM}, counts AS (
  SELECT count(*) AS unique_tags, count(*) FILTER (false_positive) AS incorrect FROM {_marked('by_hash')}
), total AS (SELECT count(*) AS arrivals FROM tags)"""

SQL: dict[str, str] = {
    "survey_total_valid": f"WITH {_SURVEY} SELECT count(*) AS n FROM valid",
    "survey_country_counts": _COUNTS,
    "survey_csv_report": _COUNTS,
    "survey_report": f"""WITH {_SURVEY} SELECT 'Total' AS country, count(*) AS n FROM valid
UNION ALL SELECT country, count(*) FROM valid GROUP BY country""",
    "survey_salary_stats": _CLAMPED,
    "survey_csv_scan": _CLAMPED,
    "survey_salary_stats_unclamped": _salary_stats("min(yearly)", "max(yearly)"),
    "partition_profile": f"""WITH {_SURVEY}
SELECT layout, count(*) AS n, count(DISTINCT country) AS keys
FROM survey CROSS JOIN (VALUES ('standard'), ('partition')) v(layout) GROUP BY layout""",
    "partition_by_key": f"""WITH {_SURVEY}
SELECT count(*) AS n, count(DISTINCT country) AS keys, CAST(0 AS BIGINT) AS split_keys FROM survey""",
    "user_stats": f"""WITH {_RATINGS}
SELECT u AS "user", round(um, 6) AS user_mean, round(norm, 6) AS norm, ratings, heavy FROM us""",
    "item_stats": f"WITH {_RATINGS} SELECT i AS item, round(im, 6) AS item_mean, raters FROM its",
    "neighbour_weights": _neighbours(12),
    "neighbour_weights_low_overlap": _neighbours(LOW_OVERLAP),
    "neighbour_weights_pearson": _neighbours(LOW_OVERLAP, "mean"),
    "cf_predictions": f"{_predicted()} {_PREDICTION_COLUMNS}",
    "cf_predictions_low_overlap": f"{_predicted(LOW_OVERLAP)} {_PREDICTION_COLUMNS}",
    "cf_predictions_clamped": f"{_predicted(LOW_OVERLAP, 'mean', iuf=False, clamp=True)} {_PREDICTION_COLUMNS}",
    "cf_error_bands": _bands("round(abs(r - prediction), 9)"),
    "cf_error_bands_signed": _bands("round(r - prediction, 9)"),
    "cf_rmse": f"""{_predicted()}
SELECT count(*) AS n, round(sqrt(avg((r - prediction) * (r - prediction))), 6) AS rmse FROM scored""",
    "cf_csv_report": f"""{_predicted()} SELECT CAST(u AS VARCHAR) AS "user", CAST(i AS VARCHAR) AS item,
  round(prediction, 6) AS prediction FROM scored""",
    "ratings_csv_scan": f"""WITH {_RATINGS}
SELECT CAST(u AS VARCHAR) AS "user", count(*) AS n, round(sum(r), 6) AS total FROM ratings GROUP BY u""",
    "id_index": f"""WITH {_RATINGS}
SELECT count(*) AS n, count(*) AS n_numbers, CAST(0 AS BIGINT) AS lowest, count(*) - 1 AS highest
FROM (SELECT u FROM train UNION SELECT u FROM test)""",
    "als_coverage": f"""WITH {_RATINGS} SELECT u AS "user", i AS item FROM test
WHERE u IN (SELECT u FROM us) AND i IN (SELECT i FROM its)""",
    "baskets": f"WITH {_BASKETS} SELECT b AS basket_id, i AS item FROM baskets",
    "baskets_csv_scan": f"""WITH {_BASKETS}
SELECT CAST(b AS VARCHAR) AS basket_id, CAST(i AS VARCHAR) AS item FROM baskets""",
    "frequent_items": f"""WITH {_BASKETS}
SELECT i AS item, count(*) AS freq FROM baskets GROUP BY i HAVING count(*) >= {SUPPORT}""",
    "frequent_pairs": f"""WITH {_BASKETS}
SELECT a.i AS item_1, c.i AS item_2, count(*) AS freq FROM baskets a JOIN baskets c ON a.b = c.b AND a.i < c.i
GROUP BY 1, 2 HAVING count(*) >= {PAIR_SUPPORT}""",
    "frequent_triples": f"WITH {_levels(SUPPORT)} SELECT i1 AS item_1, i2 AS item_2, i3 AS item_3, freq FROM l3",
    "frequent_itemsets": _ITEMSETS,
    "frequent_itemsets_many_chunks": _ITEMSETS,
    "frequent_itemsets_fpgrowth": _ITEMSETS,
    "itemset_sizes": f"""WITH {_levels(SUPPORT)}
SELECT CAST(size AS INTEGER) AS size, count(*) AS n FROM found GROUP BY size""",
    "itemset_report": f"""WITH {_levels(PAIR_SUPPORT)}, heads AS (
  SELECT size, min(label) AS head FROM found GROUP BY size
) SELECT CAST(size AS INTEGER) AS size, label,
  CASE WHEN label <> head THEN ', ' WHEN size = 1 THEN '' ELSE chr(10) || chr(10) END || label AS piece
FROM found JOIN heads USING (size)""",
    "documents_text_scan": """SELECT count(*) AS n, count(*) AS n_ids,
  CAST(sum(CASE WHEN line = '' THEN 1 WHEN rtrim(line, ' ') = '' THEN 0
           ELSE len(string_split(rtrim(line, ' '), ' ')) END) AS BIGINT) AS n_words
FROM (SELECT replace(replace(text, chr(10), ' '), chr(13), ' ') AS line FROM documents)""",
    "term_frequency": f"WITH {_WORDS} SELECT doc_id, word, count(*) AS n FROM words GROUP BY doc_id, word",
    "tf_idf": f"""WITH {_WORDS}, tf AS (
  SELECT doc_id, word, count(*) AS n FROM words GROUP BY doc_id, word
), df AS (SELECT word, count(*) AS df FROM tf GROUP BY word)
SELECT doc_id, word, n, df, round(n * ln(((SELECT count(*) FROM documents) + 1.0) / (df + 1)), 6) AS tf_idf
FROM tf JOIN df USING (word)""",
    "tf_hashed_totals": f"""WITH {_WORDS}
SELECT doc_id, CAST(count(word) AS BIGINT) AS n_words FROM documents LEFT JOIN words USING (doc_id) GROUP BY doc_id""",
    "nearest_centroid": f"""WITH {_VECTORS}, {_assignment('a0', 'c0')}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, round(d2, 6) AS distance2 FROM a0""",
    "lloyd_kmeans": f"""WITH {_lloyd()}
SELECT CAST(cluster AS INTEGER) AS cluster, CAST(dim AS INTEGER) AS dim, round(value, 6) AS value
FROM c{LLOYD_ITERATIONS + 1}""",
    "cluster_metrics": f"""WITH {_lloyd()}
SELECT CAST(cluster AS INTEGER) AS cluster, count(*) AS size, round(sum(d2), 6) AS error,
  round(sum(d2 * d2), 6) AS sum_sq_error FROM final GROUP BY cluster""",
    "cluster_wsse": f"""WITH {_lloyd()}
SELECT round(sum(d2), 6) AS wsse, round(sum(d2 * d2), 6) AS sum_sq_error FROM final""",
    "cluster_word_counts": f"WITH {_WORDS} SELECT lang AS cluster, word, count(*) AS n FROM words GROUP BY 1, 2",
    "cluster_top_terms": f"""WITH {_WORDS}, counts AS (
  SELECT lang AS cluster, word, count(*) AS n FROM words GROUP BY 1, 2
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, word) AS place FROM counts
) SELECT cluster, word, n, CAST(place AS INTEGER) AS place FROM ranked WHERE place <= {TOP_TERMS}""",
    "message_tags": f"WITH {_TAGS} SELECT seq, tag FROM tags",
    "reservoir_sample": f"WITH {_SAMPLE} SELECT id, text, priority FROM sample",
    "stream_reservoir": f"WITH {_SAMPLE} SELECT id, text, (SELECT count(*) FROM messages) AS seen FROM sample",
    "hashtag_counts": f"WITH {_SAMPLE} SELECT tag, n FROM sample_tags",
    "hot_hashtags": f"WITH {_SAMPLE} SELECT tag, n FROM {_HOT}",
    "mean_message_length": f"WITH {_SAMPLE} SELECT round(avg(length(text)), 6) AS mean_length FROM sample",
    "bloom_false_positives": f"WITH {_BLOOM} SELECT tag, tag_hash, seq, false_positive FROM {_marked('by_tag')}",
    "bloom_slots": f"WITH {_BLOOM} SELECT CAST(slot AS INTEGER) AS slot, since FROM slots",
    "bloom_bits": f"""WITH {_BLOOM}
SELECT CAST(slot // 32 AS INTEGER) AS word, bit_or(CAST(1 AS BIGINT) << (slot % 32)) AS bits FROM slots GROUP BY 1""",
    "bloom_summary": f"""{_BLOOM_SUMMARY}
SELECT arrivals, arrivals - incorrect AS correct, incorrect, unique_tags FROM counts, total""",
    "stream_bloom_report": f"""{_BLOOM_SUMMARY}
SELECT arrivals - incorrect AS correct, incorrect, unique_tags, incorrect AS false_positives FROM counts, total""",
    "bloom_batch_report": f"""WITH {_BLOOM}, sizes AS (
  SELECT seq // {EVENTS_PER_BATCH * TAG_PLACES} AS batch, count(*) AS arrivals FROM tags GROUP BY 1
), news AS (
  SELECT seq // {EVENTS_PER_BATCH * TAG_PLACES} AS batch, count(*) AS fresh,
    count(*) FILTER (false_positive) AS incorrect FROM {_marked('by_hash')} GROUP BY 1
) SELECT batch, arrivals - coalesce(incorrect, 0) AS correct, coalesce(incorrect, 0) AS incorrect,
  CAST(sum(coalesce(fresh, 0)) OVER (ORDER BY batch) AS BIGINT) AS unique_tags,
  CAST(sum(coalesce(incorrect, 0)) OVER (ORDER BY batch) AS BIGINT) AS false_positives
FROM sizes LEFT JOIN news USING (batch)""",
}

SQL["reservoir_report"] = f"""WITH {_SAMPLE} SELECT (SELECT count(*) FROM messages) AS seen,
  (SELECT string_agg(tag || ':' || n, ',' ORDER BY n DESC, tag) FROM {_HOT}) AS hot_tags,
  (SELECT round(avg(length(text)), 6) FROM sample) AS mean_length"""

# The streams see ids of nineteen digits, which give the sample's messages other priorities.
_LARGE_SAMPLE = _SAMPLE.replace(f"'{messages.SEED}-' || id", f"'{messages.SEED}-' || (id + {LARGE_ID})")
SQL["stream_reservoir"] = f"""WITH {_LARGE_SAMPLE}
SELECT id, text, (SELECT count(*) FROM messages) AS seen FROM sample"""
SQL["stream_reservoir_report"] = SQL["reservoir_report"].replace(_SAMPLE, _LARGE_SAMPLE)
_STREAM_BATCH = f"CAST(floor(event_id * {STREAM_FILES}.0 / ((SELECT max(event_id) FROM events) + 1)) AS BIGINT)"
SQL["stream_reservoir_batches"] = f"""SELECT batch_id, CAST(sum(n) OVER (ORDER BY batch_id) AS BIGINT) AS seen
FROM (SELECT {_STREAM_BATCH} AS batch_id, count(*) AS n FROM events GROUP BY 1)"""
_SEQ_BATCH = _STREAM_BATCH.replace("event_id *", f"(seq // {TAG_PLACES}) *")
SQL["stream_bloom_batches"] = f"""WITH {_BLOOM}, sizes AS (
  SELECT {_SEQ_BATCH} AS batch_id, count(*) AS arrivals FROM tags GROUP BY 1
), news AS (
  SELECT {_SEQ_BATCH} AS batch_id, count(*) AS fresh,
    count(*) FILTER (false_positive) AS wrong FROM {_marked('by_hash')} GROUP BY 1
) SELECT batch_id, arrivals - coalesce(wrong, 0) AS correct, coalesce(wrong, 0) AS incorrect,
  CAST(sum(coalesce(fresh, 0)) OVER (ORDER BY batch_id) AS BIGINT) AS unique_tags,
  CAST(sum(coalesce(wrong, 0)) OVER (ORDER BY batch_id) AS BIGINT) AS false_positives
FROM sizes LEFT JOIN news USING (batch_id)"""

SQL["survey_salary_stats_any_size"] = """WITH survey AS (
  SELECT n_name AS country, CASE o_orderkey % 97 WHEN 5 THEN 12 * 1e30 WHEN 6 THEN 12 * 1e40
    ELSE 12.0 * floor(o_totalprice) END::DOUBLE AS yearly
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE o_orderkey % 97 NOT IN (7, 8, 9, 10)
)
SELECT country, count(*) AS n, min(yearly)::BIGINT AS min_salary,
  CASE WHEN max(yearly) >= 1e18 THEN 9223372036854775807 ELSE max(yearly)::BIGINT END AS max_salary,
  max(yearly) >= 1e18 AS has_large, round(sum(yearly) / count(*) / 1e36, 3) AS mean_e36
FROM survey GROUP BY country"""

# Totals in three parts of eighteen digits, divided from the top. Twelve times 1e30 is 12000000000000001e15 as a double.
SQL["survey_exact_means"] = """WITH survey AS (
  SELECT n_name AS country, o_orderkey % 97 AS kind, CAST(floor(o_totalprice) AS HUGEINT) * 12 AS yearly
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE o_orderkey % 97 NOT IN (7, 8, 9, 10)
), totals AS (
  SELECT country, count(*)::HUGEINT AS n, (count(*) FILTER (kind = 6))::HUGEINT * 120000 AS high,
    (count(*) FILTER (kind = 5))::HUGEINT * 12000000000000 AS middle, coalesce(sum(yearly) FILTER (kind NOT IN (5, 6)), 0)::HUGEINT + (count(*) FILTER (kind = 5))::HUGEINT * 1000000000000000 AS low
  FROM survey GROUP BY country
), first AS (
  SELECT *, high // n AS q1, (high % n) * 1000000000000000000 + middle AS rest1 FROM totals
), second AS (
  SELECT *, rest1 // n AS q2, (rest1 % n) * 1000000000000000000 + low AS rest2 FROM first
), third AS (
  SELECT *, rest2 // n + (200 * (rest2 % n) + n) // (2 * n) // 100 AS q3, (200 * (rest2 % n) + n) // (2 * n) % 100 AS cents FROM second
)
SELECT country, n::BIGINT AS n,
  CASE WHEN q1 > 0 THEN q1::VARCHAR || lpad(q2::VARCHAR, 18, '0') || lpad(q3::VARCHAR, 18, '0')
    WHEN q2 > 0 THEN q2::VARCHAR || lpad(q3::VARCHAR, 18, '0') ELSE q3::VARCHAR END || '.' || lpad(cents::VARCHAR, 2, '0') AS mean_salary
FROM third"""

SQL["dataset_labels"] = """SELECT 'small' AS label, count(*) AS n FROM orders
UNION ALL SELECT 'large', count(*) FROM orders"""
SQL["cf_evaluation_lines"] = f"""SELECT label AS metric, CAST(n AS DOUBLE) AS value FROM ({SQL['cf_error_bands']})
UNION ALL SELECT 'RMSE', rmse FROM ({SQL['cf_rmse']})"""
SQL["itemset_file"] = f"""WITH {_levels(PAIR_SUPPORT)} SELECT label, CAST(size AS INTEGER) AS size FROM found"""
SQL["cluster_report"] = f"""WITH {_lloyd()}, {_WORDS}, counts AS (
  SELECT cluster, word, count(*) AS n FROM words JOIN final ON doc_id = vec_id GROUP BY 1, 2
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, word) AS place FROM counts
), terms AS (
  SELECT cluster, string_agg(word, ' ' ORDER BY place) AS terms FROM ranked WHERE place <= {TOP_TERMS} GROUP BY 1
)
SELECT 'K-Means' AS algorithm, (SELECT round(sum(d2), 6) FROM final) AS "WSSE", CAST(cluster + 1 AS INTEGER) AS id,
  count(*) AS size, round(sum(d2), 6) AS error, coalesce(any_value(terms), '') AS terms
FROM final LEFT JOIN terms USING (cluster) GROUP BY cluster"""
SQL["cluster_file"] = SQL["cluster_report"]
SQL["kmeans_totals"] = "SELECT CAST(8 AS BIGINT) AS clusters, count(*) AS documents, true AS adds_up FROM documents"
SQL["bisecting_totals"] = SQL["kmeans_totals"]
SQL["mixture_totals"] = "SELECT CAST(3 AS BIGINT) AS components, CAST(1 AS DOUBLE) AS weight, true AS symmetric"


def _als_step(name: str, fixed: str, known: str, wanted: str) -> str:
    """The factors of one side for those of the other: two equations with two unknowns for each id."""
    return f"""{name} AS MATERIALIZED (
  SELECT {wanted}, (b0 * a11 - b1 * a10) / (a00 * a11 - a10 * a10) AS f0, (b1 * a00 - b0 * a10) / (a00 * a11 - a10 * a10) AS f1
  FROM (
    SELECT {wanted}, sum(f0 * f0) + 0.28 * count(*) AS a00, sum(f0 * f1) AS a10, sum(f1 * f1) + 0.28 * count(*) AS a11,
      sum(rating * f0) AS b0, sum(rating * f1) AS b1
    FROM rated JOIN {fixed} USING ({known}) GROUP BY {wanted}
  )
)"""


def _als(rounds: int = 2) -> str:
    starts = ", ".join(
        f"('0x' || substr(md5('42-{k}-' || i), 1, 8))::BIGINT / 4294967296.0::DOUBLE + 0.1::DOUBLE AS f{k}" for k in range(2)
    )
    steps = [f"items0 AS MATERIALIZED (SELECT i, {starts} FROM (SELECT DISTINCT i FROM train))"]
    for n in range(1, rounds + 1):
        steps += [_als_step(f"users{n}", f"items{n - 1}", "i", "u"), _als_step(f"items{n}", f"users{n}", "u", "i")]
    return f"{_RATINGS}, rated AS (SELECT u, i, r::FLOAT::DOUBLE AS rating FROM train), " + ", ".join(steps)


SQL["als_by_sums_factors"] = f"WITH {_als()} SELECT i AS item, round(f0, 6) AS f0, round(f1, 6) AS f1 FROM items2"
SQL["als_by_sums_errors"] = f"""WITH {_als()}
SELECT count(*) AS n, round(sqrt(avg(pow(t.r - (x.f0 * y.f0 + x.f1 * y.f1), 2))), 6) AS rmse
FROM test t JOIN users2 x ON x.u = t.u JOIN items2 y ON y.i = t.i"""
