"""The registered queries opN_<name>: each applies its operator with production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, centroids, codec, langid, lines, media, packing, pii, secrets, sharding, simhash, topk, toxicity
from .common import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return made.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    made = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return made.select("doc_id", (toxicity.bucket("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    made = langid.identify(docs, langid.fit(docs))
    return made.select("doc_id", (langid.bucket("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


OP7_SQL = """
WITH fit AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM fit q JOIN fit c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
"""


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec.digest(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.store_and_describe(table(spark, sf_dir, "documents"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.described(spark, *centroids.cluster(table(spark, sf_dir, "embeddings")))


def _round(n: int) -> str:
    """Assignment to the centroids of round n, and what they move to. ((s % n) + n) % n is what floor leaves over."""
    return f"""a{n} AS MATERIALIZED (
  SELECT row_id, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance FROM (
    SELECT row_id, cluster, list_sum(list_transform(range(1, 65), lambda i: (q.v[i] - c.v[i]) * (q.v[i] - c.v[i]))) AS d FROM fit q CROSS JOIN c{n} c) GROUP BY row_id
), m{n} AS MATERIALIZED (
  SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY dim) AS v FROM (
    SELECT cluster, dim, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (
      SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS dim FROM fit JOIN a{n} USING (row_id)) GROUP BY ALL) GROUP BY cluster
), c{n + 1} AS MATERIALIZED (SELECT cluster, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN m{n} m USING (cluster)), """


OP11_SQL = f"""
WITH fit AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS INTEGER) AS cluster, v FROM (SELECT sha256('3:' || vec_id) AS h, v FROM fit) ORDER BY cluster LIMIT 8
), {"".join(map(_round, range(11))).rsplit(", m10", 1)[0]}
SELECT vec_id, cluster, CAST(distance AS BIGINT) AS distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c10.v, ',')) AS centroid_sha256 FROM a10 JOIN fit USING (row_id) JOIN c10 USING (cluster)
"""


def op12_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_repeated(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP12_SQL = """
WITH l AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
), k AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), gone AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, coalesce(k.doc_id <> gone.last, false) AS dropped FROM k LEFT JOIN gone USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256 FROM m GROUP BY doc_id
"""


def op13_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = """
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first FROM documents
), f AS (
  SELECT part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic, [len(words) < 100, 100 * len(list_distinct(words)) < 80 * len(words),
    100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text), regexp_matches(text, '[#$%&*|]'), coalesce(first < doc_id, false)] AS fails FROM w LEFT JOIN labels USING (doc_id)
), cells AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM f GROUP BY part, fails),
x AS (SELECT unnest(range(1, 6)) AS i), orders AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), steps AS (
  SELECT part, o, s.i AS step, fails[o[s.i]] AS hit, len(list_filter(o[1 : s.i - 1], lambda k: fails[k])) > 0 AS earlier, len(list_filter(fails, lambda b: b)) = 1 AS alone, n, good, toxic FROM cells, orders, x s
), counted AS (
  SELECT part, o, step, CAST(sum(n) FILTER (WHERE NOT earlier AND NOT hit) AS BIGINT) AS kept, CAST(sum(n) FILTER (WHERE hit AND NOT earlier) AS BIGINT) AS removed, CAST(sum(n) FILTER (WHERE hit AND earlier) AS BIGINT) AS redundant,
    CAST(sum(n) FILTER (WHERE hit AND alone) AS BIGINT) AS unique_fails, CAST(sum(good) FILTER (WHERE hit AND NOT earlier) AS BIGINT) AS good_lost, CAST(sum(toxic) FILTER (WHERE hit AND NOT earlier) AS BIGINT) AS toxic_lost FROM steps GROUP BY ALL
)
SELECT part, array_to_string(list_transform(o, lambda k: substr('ABCDE', k, 1)), '') AS filter_order, CAST(step AS INTEGER) AS step, coalesce(kept, 0) AS kept, coalesce(removed, 0) AS removed, coalesce(redundant, 0) AS redundant,
  coalesce(unique_fails, 0) AS unique_fails, coalesce(good_lost, 0) AS good_lost, coalesce(toxic_lost, 0) AS toxic_lost, CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, o[step]) AS BIGINT) AS shapley FROM counted
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {"op7_topk": OP7_SQL, "op11_centroids": OP11_SQL, "op12_lines": OP12_SQL, "op13_audit": OP13_SQL}
