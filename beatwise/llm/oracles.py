"""DuckDB SQL of the queries that SQL can express, over the raw test tables."""

#: Host rules: windows, lines and hosts as plain relations, no shared code with the operator.
HOST_QUALITY = r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS body,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
win AS (
  SELECT r, i, list_slice(words, i, i + 7) AS gram
  FROM w, LATERAL (SELECT unnest(range(1, len(words) - 6)) AS i)),
rep AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, gram) > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, range(0, 8) AS t(k) GROUP BY r),
f AS (
  SELECT doc_id, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM w LEFT JOIN cov USING (r)),
g AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         n_words < 20 OR 100 * n_repeat_words > 30 * n_words
           OR 100 * n_symbols > 50 * word_chars OR 100 * n_dup_lines > 50 * n_lines AS rule_failed FROM f),
h AS (SELECT source, count(*) AS n, count(*) FILTER (rule_failed) AS k FROM g WHERE source IS NOT NULL GROUP BY source),
m AS (SELECT avg(k / n) AS mean, var_pop(k / n) AS v FROM h),
p AS (SELECT mean, CASE WHEN v > 1e-12 THEN least(greatest(mean * (1 - mean) / v - 1, 1), 1000) ELSE 1000 END AS s FROM m),
verdict AS (SELECT source, (k + mean * s) / (n + s) AS rate FROM h, p)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND coalesce(rate, 0) <= 0.5 AS kept
FROM g LEFT JOIN verdict USING (source)
"""

#: Every window of 50 words as a list; a word goes if one of its windows has a smaller first document.
BLOCK_ANCHORS = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
win AS (
  SELECT r, doc_id, i, list_slice(words, i, i + 49) AS gram
  FROM d, LATERAL (SELECT unnest(range(1, len(words) - 48)) AS i)),
gone AS (SELECT r, i FROM win QUALIFY doc_id > min(doc_id) OVER (PARTITION BY gram)),
cov AS (SELECT DISTINCT r, i + k AS p FROM gone, range(0, 50) AS t(k)),
w AS (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM d),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS body FROM w ANTI JOIN cov USING (r, p) GROUP BY r),
lost AS (SELECT r, count(*) AS n FROM cov GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN lost USING (r) LEFT JOIN kept USING (r)
"""

#: Every string of 50 bytes (100 hex digits); runs of removed bytes are gaps and islands.
SUFFIX_DEDUP = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (
  SELECT r, doc_id, i, substr(h, 2 * i - 1, 100) AS gram
  FROM d, LATERAL (SELECT unnest(range(1, length(h) // 2 - 48)) AS i)),
gone AS (SELECT r, i FROM win QUALIFY doc_id > min(doc_id) OVER (PARTITION BY gram)),
step AS (SELECT r, i, coalesce(i > 50 + lag(i) OVER (PARTITION BY r ORDER BY i), true) AS fresh FROM gone),
part AS (SELECT r, i, sum(fresh::INT) OVER (PARTITION BY r ORDER BY i) AS run FROM step),
span AS (SELECT r, run, min(i) AS a, max(i) + 50 AS b FROM part GROUP BY r, run),
gap AS (
  SELECT r, run, substr(h, 2 * b - 1, 2 * (coalesce(lead(a) OVER w, length(h) // 2 + 1) - b)) AS piece
  FROM (SELECT r, run, a, b FROM span UNION ALL SELECT r, 0, 1, 1 FROM d) JOIN d USING (r)
  WINDOW w AS (PARTITION BY r ORDER BY run)),
kept AS (SELECT r, string_agg(piece, '' ORDER BY run) AS body FROM gap GROUP BY r),
lost AS (SELECT r, sum(b - a) AS n, count(*) AS spans FROM span GROUP BY r)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed,
       coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(body, ''))) AS kept_sha256
FROM d LEFT JOIN lost USING (r) LEFT JOIN kept USING (r)
"""

WARC = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
d AS (SELECT page_id, n, sha1(body) AS digest FROM p),
r AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY digest, n) END AS last FROM d)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN last IS DISTINCT FROM page_id AND last IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN last IS DISTINCT FROM page_id THEN last END AS refers_to, true AS digest_ok
FROM r
"""

#: Bytes of every prefix of every row; the shortest that fits is the shard.
SHARDING = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(strlen(text), 0) AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h
  FROM documents),
lv AS (
  SELECT r, doc_id, k, h >> (60 - k) AS place, sum(size) OVER (PARTITION BY k, h >> (60 - k)) AS bytes
  FROM d, range(0, 61) AS t(k)),
pick AS (SELECT * FROM lv WHERE bytes <= 1048576 OR k = 60 QUALIFY k = min(k) OVER (PARTITION BY r))
SELECT doc_id, CASE WHEN k = 0 THEN '' ELSE lpad(bin(place), k::INT, '0') END AS shard, k::INT AS depth,
       bytes::BIGINT AS shard_bytes
FROM pick
"""

#: Centroids as rows (c, i, v); each round unrolled: all distances, the nearest, floors of the means.
_CLUSTER_ROUND = """
d{r} AS (SELECT v.r, c.c, sum((v.x - c.v) * (v.x - c.v)) AS d FROM x v JOIN c{r} c USING (i) GROUP BY v.r, c.c),
a{r} AS (SELECT r, c, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)"""
_CLUSTER_MEANS = """,
m{r} AS (SELECT a.c, x.i, sum(x.x) AS s, count(*) AS n FROM a{r} a JOIN x USING (r) GROUP BY a.c, x.i),
c{next} AS (SELECT c.c, c.i, CASE WHEN n IS NULL THEN v WHEN s >= 0 THEN s // n ELSE -((n - 1 - s) // n) END AS v
            FROM c{r} c LEFT JOIN m{r} USING (c, i))"""

CENTROID_CLUSTERS = """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda y: floor(256 * y::DOUBLE)) AS vec FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda y: y IS NOT NULL AND abs(256 * y::DOUBLE) < 134217728)) = 64),
x AS (SELECT r, unnest(range(64)) AS i, unnest(vec)::HUGEINT AS x FROM e),
f AS (SELECT r, row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, vec) - 1 AS c FROM e
      QUALIFY c < 40),
c0 AS (SELECT c, i, x AS v FROM f JOIN x USING (r)),""" + ",".join(
    _CLUSTER_ROUND.format(r=r) + (_CLUSTER_MEANS.format(r=r, next=r + 1) if r < 5 else "") for r in range(6)) + """,
g AS (SELECT c, sha256(string_agg(v::BIGINT::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c5 GROUP BY c)
SELECT vec_id, c::INT AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM e JOIN a5 USING (r) JOIN g USING (c)
"""

#: CRC-32 from its bits; near words share a pattern with one letter masked or taken out; roots by recursion.
SPELLING_GROUPS = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, z: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END)) AS t),
run AS (
  SELECT id, run, count(*) AS n FROM (
    SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM (
      SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run
      FROM documents) WHERE length(run) >= 6) GROUP BY ALL),
code AS (SELECT *, hex(encode(id || ':' || run)) AS x FROM run),
mark AS (
  SELECT run, n, xor(4294967295, list_reduce([4294967295] || list_transform(range(length(x) // 2),
    lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS h
  FROM code, crc),
occ AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM mark),
w AS (SELECT word, sum(n)::BIGINT AS n FROM occ WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
p AS (SELECT word, n, i, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS mask,
             substr(word, 1, i - 1) || substr(word, i + 1) AS cut
      FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM p a JOIN p b ON a.mask = b.mask AND a.word <> b.word
  UNION SELECT p.word, w.word, w.n FROM p JOIN w ON p.cut = w.word
  UNION SELECT w.word, p.word, p.n FROM p JOIN w ON p.cut = w.word),
top AS (SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS m FROM near GROUP BY word),
f AS (SELECT w.word, CASE WHEN m >= 5 * n THEN other END AS form, n, coalesce(n_near, 0) AS n_near,
             CASE WHEN m >= 5 * n THEN m END AS form_n FROM w LEFT JOIN top USING (word)),
up AS (SELECT word, word AS root FROM f UNION ALL
       SELECT up.word, f.form FROM up JOIN f ON f.word = up.root WHERE f.form IS NOT NULL)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n FROM f JOIN up USING (word)
WHERE root IN (SELECT word FROM f WHERE form IS NULL)
"""

#: Targets in closed form: by cap over weight, a source is full if its share of what is left would exceed its cap.
SOURCE_MIX = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, md5(concat(coalesce(doc_id::VARCHAR, ''), '|', md5(coalesce(text, '')))) AS key,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::HUGEINT AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::HUGEINT AS w FROM d GROUP BY source),
o AS (
  SELECT *, sum(source_size) OVER () AS total, sum(w) OVER (ORDER BY source_size * 3.0 / w, source DESC NULLS LAST
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS shared,
         coalesce(sum(3 * source_size) OVER (ORDER BY source_size * 3.0 / w, source DESC NULLS LAST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS given FROM s),
c AS (SELECT *, w * (total - given) > 3 * source_size * shared AS full_ FROM o),
t AS (
  SELECT source, source_size, CASE WHEN full_ THEN (3 * source_size)::DOUBLE ELSE
    (w * (max(total) OVER () - coalesce(sum(3 * source_size) FILTER (full_) OVER (), 0)))::DOUBLE
      / (sum(w) FILTER (NOT full_) OVER ())::DOUBLE END AS target FROM c),
k AS (
  SELECT doc_id, size, source_size, target, target / nullif(source_size::DOUBLE, 0) AS rate,
         row_number() OVER (PARTITION BY d.source ORDER BY size, key) AS place,
         ('0x' || substr(md5(concat('13:', coalesce(d.source, ''))), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
       (size * coalesce(floor(rate * place + u) - floor(rate * (place - 1) + u), 0))::BIGINT AS taken
FROM k
"""

ORACLES = {"op11_centroid_clusters": CENTROID_CLUSTERS, "op12_spelling_groups": SPELLING_GROUPS, "op13_source_mix": SOURCE_MIX,
           "op1_warc": WARC, "op3_sharding": SHARDING, "op5_host_quality": HOST_QUALITY, "op8_block_anchors": BLOCK_ANCHORS, "op9_suffix_dedup": SUFFIX_DEDUP}
