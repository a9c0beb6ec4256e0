"""The registered queries opN_<name> and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op5_rlz_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickline.llm.substring_dedup import dedup_substrings

    return dedup_substrings(_table(spark, sf_dir, "documents"), window=35).drop("kept_text")


def op10_bwt_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickline.llm.suffix_dedup import dedup_bytes

    return dedup_bytes(_table(spark, sf_dir, "documents"), length=50).drop("kept_bytes")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickline.llm.jaccard_join import jaccard_components

    return jaccard_components(_table(spark, sf_dir, "documents"), size=4, percent=85)


def op8_curriculum_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickline.llm.mixing import mix_sources

    return mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_rule_ensemble_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickline.llm.quality import score_quality

    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op1_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickline.llm.arc import archive_pages

    return archive_pages(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_redirect_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickline.llm.urls import filter_urls

    return filter_urls(_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op2_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickline.llm.ann import nearest

    vectors = _table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op3_patience_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickline.llm.licenses import scan_licenses

    return scan_licenses(_table(spark, sf_dir, "documents"))


def op6_seeded_alignment_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickline.llm.decontaminate import find_leaks

    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


SQL: dict[str, str] = {}

SQL["op1_arc_to_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM f
"""

# No page of the tables redirects or names a canonical address, so there the method allows what no rule decides.
SQL["op7_redirect_url_filter"] = """
WITH r AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1) AS path FROM r),
v AS (SELECT *, '.' || host AS h,
  CASE WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/en/1%' THEN 'example.org/en/1'
       WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/es/%' THEN 'example.org/es/'
       WHEN ('.' || host) LIKE '%.com' AND path LIKE '/fr/%' THEN 'com/fr/'
       WHEN ('.' || host) LIKE '%.com' AND path LIKE '/de/%' THEN 'com/de/'
       WHEN ('.' || host) LIKE '%.org' AND path LIKE '/%' THEN 'org/' END AS rule FROM u)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM v
"""

SQL["op8_curriculum_mixing"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
               CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS DOUBLE) AS weight FROM d GROUP BY source),
fill AS (
  SELECT 0 AS step, source, source_size, weight, false AS capped FROM src
  UNION ALL
  SELECT step + 1, source, source_size, weight,
         capped OR level * weight >= 3 * source_size
  FROM (SELECT *, ((sum(source_size) OVER ()) - coalesce(sum(CASE WHEN capped THEN 3 * source_size END) OVER (), 0))
                  / sum(CASE WHEN NOT capped THEN weight END) OVER () AS level FROM fill) WHERE step < 60),
goal AS (
  SELECT source, source_size, CASE WHEN capped THEN CAST(3 * source_size AS DOUBLE)
         ELSE ((sum(source_size) OVER ()) - coalesce(sum(CASE WHEN capped THEN 3 * source_size END) OVER (), 0))
              / sum(CASE WHEN NOT capped THEN weight END) OVER () * weight END AS target
  FROM fill WHERE step = 60),
walk AS (
  SELECT doc_id, size, source_size, target, CAST(round(target) AS BIGINT) AS w,
         CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before_it
  FROM d JOIN goal ON d.source IS NOT DISTINCT FROM goal.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE (w // source_size) * size + greatest(0, least(size, w % source_size - before_it)) END AS BIGINT) AS taken
FROM walk
"""

SQL["op5_rlz_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i+34], ' ') AS t
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
rep AS (SELECT t FROM win GROUP BY t HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM win JOIN rep USING (t), (SELECT unnest(range(0, 35)) AS k)),
item AS (SELECT doc_id, unnest(w) AS v, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT doc_id, string_agg(v, ' ' ORDER BY p) AS t, count(*) AS n
         FROM item ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

SQL["op4_jaccard_join"] = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (
  SELECT doc_id, unnest(list_transform(range(1, greatest(len(w) - 2, 2)), lambda i: array_to_string(w[i:i+3], ' '))) AS sh FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (sh) WHERE a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
links AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.c)
SELECT r.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.c) AS component_id FROM reach r LEFT JOIN n USING (doc_id) GROUP BY r.doc_id
"""

SQL["op10_bwt_suffix_dedup"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS t FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM d WHERE len(h) >= 100)),
least_id AS (SELECT t, min(doc_id) AS m FROM win GROUP BY t HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT doc_id, i FROM win JOIN least_id USING (t) WHERE doc_id > m),
runs AS (SELECT *, sum(CASE WHEN i <= coalesce(prev, -1000) + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (SELECT *, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS prev FROM hit)),
spans AS (SELECT doc_id, run, min(i) AS b, max(i) + 50 AS e FROM runs GROUP BY ALL),
gaps AS (SELECT doc_id, coalesce(lag(e) OVER w, 0) AS b, b AS e FROM spans WINDOW w AS (PARTITION BY doc_id ORDER BY run)),
pieces AS (SELECT doc_id, b, substr(h, 2 * b + 1, 2 * (e - b)) AS x FROM gaps JOIN d USING (doc_id)
           UNION ALL SELECT doc_id, z.e, substr(h, 2 * z.e + 1) FROM (SELECT doc_id, max(e) AS e FROM spans GROUP BY doc_id) z JOIN d USING (doc_id)),
kept AS (SELECT doc_id, string_agg(x, '' ORDER BY b) AS x FROM pieces GROUP BY doc_id),
total AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n_spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST((len(h) - len(coalesce(x, h))) // 2 AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(x, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN total USING (doc_id)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in sorted(globals().items()) if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
