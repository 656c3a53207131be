"""DuckDB SQL for the corpus queries that SQL can express."""


def _round(n: int) -> str:
    """One assignment of all vectors to centroids c{n} and their update to c{n+1}."""
    return f"""
near{n} AS MATERIALIZED (
  SELECT row, cluster, distance FROM (
    SELECT v.row, c.cluster, sum((v.x - c.x) * (v.x - c.x)) AS distance,
           row_number() OVER (PARTITION BY v.row ORDER BY sum((v.x - c.x) * (v.x - c.x)), c.cluster) AS nth
    FROM cells v JOIN c{n} c USING (dim) GROUP BY v.row, c.cluster) WHERE nth = 1),
c{n + 1} AS MATERIALIZED (
  SELECT c.cluster, c.dim, coalesce(m.x, c.x) AS x FROM c{n} c LEFT JOIN (
    SELECT cluster, dim, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS x
    FROM near{n} JOIN cells USING (row) GROUP BY cluster, dim) m USING (cluster, dim)),"""


def _checksum_table() -> str:
    """The byte table of CRC-32, from its rule."""
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        table.append(byte)
    return str(table)


def _buckets(texts: str, name: str) -> str:
    """Features of (id, words) rows with their bucket and count."""
    return f"""
{name}_grams AS (
  SELECT id, unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) AS gram
  FROM {texts}),
{name}_counts AS MATERIALIZED (SELECT id, gram, count(*) AS n FROM {name}_grams GROUP BY id, gram),"""


ORACLES = {
    "op1_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS digest,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, 2.0::DOUBLE * source_size AS bound,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][turn % 3 + 1] AS weight FROM sources),
levels AS (
  SELECT *, bound / weight AS full_at,
         (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(bound) OVER rising, 0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER rising, 0)) AS level
  FROM ranked
  WINDOW rising AS (ORDER BY bound / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, turn,
         CASE WHEN full_at <= level THEN bound
              ELSE weight * max(CASE WHEN full_at > level THEN level END) OVER () END AS target
  FROM levels),
placed AS (
  SELECT s.*, t.source_size, t.turn, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
         CAST(coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY digest, size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS begun
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
shares AS (
  SELECT *, CAST(begun AS DOUBLE) / target AS demand,
         greatest(0, least(size, budget - begun)) AS once,
         greatest(0, least(size, budget - begun - source_size)) AS twice FROM placed),
timed AS (
  SELECT *, CASE turn % 3
    WHEN 0 THEN CASE WHEN demand > 0 THEN 2 * demand
      / (1.5::DOUBLE + sqrt(greatest(2.25::DOUBLE - 2.0::DOUBLE * demand, 0))) ELSE 0 END
    WHEN 1 THEN demand
    ELSE CASE WHEN demand >= 0.3125::DOUBLE
      THEN 0.5::DOUBLE + 2 * (demand - 0.3125::DOUBLE) / (0.75::DOUBLE
        + sqrt(greatest(0.5625::DOUBLE + 5.0::DOUBLE * (demand - 0.3125::DOUBLE), 0)))
      ELSE 2 * demand / (0.5::DOUBLE + sqrt(greatest(0.25::DOUBLE + 1.0::DOUBLE * demand, 0))) END
    END AS time FROM shares)
SELECT doc_id, size, source_size, target, CAST(once + twice AS BIGINT) AS taken,
       CASE WHEN once > 0 THEN round(time, 6) WHEN twice > 0 THEN NULL END AS first_time
FROM timed
""",
    "op9_exact_dedup": r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
""",
    "op7_warc": r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS newest FROM p)
SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> newest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> newest THEN newest END AS refers_to
FROM g
""",
    "op11_centroids": f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id,
         list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS xs
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
cells AS MATERIALIZED (SELECT row, unnest(range(64)) AS dim, unnest(xs) AS x FROM kept),
c0 AS MATERIALIZED (
  SELECT cluster, unnest(range(64)) AS dim, unnest(xs) AS x FROM (
    SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')), xs) - 1 AS cluster, xs
    FROM kept) WHERE cluster < 40),
{"".join(map(_round, range(6)))}
digests AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY dim)) AS digest FROM c5 GROUP BY cluster)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, digest AS centroid_sha256
FROM near5 JOIN kept USING (row) JOIN digests USING (cluster)
""",
    "op13_resampling": rf"""
WITH texts AS MATERIALIZED (
  SELECT row_number() OVER () AS id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
aims AS (
  SELECT row_number() OVER () AS id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
{_buckets("texts", "doc")}{_buckets("aims", "aim")}
grams AS (SELECT gram FROM doc_counts UNION SELECT gram FROM aim_counts),
hashed AS MATERIALIZED (
  SELECT gram, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
           list_transform(range(1, strlen(gram) + 1), lambda i: CAST('0x' || substr(hex(gram), 2 * i - 1, 2) AS BIGINT))),
           lambda c, b: xor(c >> 8, {_checksum_table()}[(xor(c, b) & 255) + 1]))) % 10000 AS bucket
  FROM grams),
corpus AS (SELECT bucket, sum(n) AS s FROM doc_counts JOIN hashed USING (gram) GROUP BY bucket),
goal AS (SELECT bucket, sum(n) AS t FROM aim_counts JOIN hashed USING (gram) GROUP BY bucket),
gains AS MATERIALIZED (
  SELECT bucket, CAST(floor(1000 * ln(
           CAST((coalesce(t, 0) + 1) * ((SELECT coalesce(sum(s), 0) FROM corpus) + 10000) AS DOUBLE)
           / CAST((coalesce(s, 0) + 1) * ((SELECT coalesce(sum(t), 0) FROM goal) + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM corpus FULL JOIN goal USING (bucket)),
sums AS (
  SELECT id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS total
  FROM doc_counts JOIN hashed USING (gram) JOIN gains USING (bucket) GROUP BY id),
scored AS (
  SELECT doc_id, len(words) >= 20 AS able, coalesce(n_features, 0) AS n_features,
         CASE WHEN n_features > 0 THEN (total - (total % n_features + n_features) % n_features) // n_features ELSE 0 END AS weight,
         CAST('0x' || sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS BIGINT) AS h
  FROM texts LEFT JOIN sums USING (id)),
noisy AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM scored),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY able DESC, score DESC, doc_id NULLS LAST, n_features, weight) AS place,
         (SELECT count(*) FILTER (able) FROM noisy) * 25 // 100 AS drawn FROM noisy)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= drawn THEN place END AS rank
FROM ranked
""",
}
