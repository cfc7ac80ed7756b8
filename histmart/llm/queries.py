"""Queries of the operators of this subpackage, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histmart.llm.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of 10 words in all documents."""
    from histmart.llm.decontam import decontaminate, digest

    return digest(decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10))


ORACLE["op8_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
bw AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT dw.doc_id, dw.i, dw.n, bw.item FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@query
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents on 2-word shingles."""
    from histmart.llm.minhash import minhash_dedup

    return minhash_dedup(table(spark, sf_dir, "documents"), shingle=2, percent=80)


ORACLE["op9_minhash_near_dedup"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 1], ' ') AS sh
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 0) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i
  FROM s a JOIN s b ON a.sh = b.sh JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  WHERE a.doc_id < b.doc_id AND least(na.n, nb.n) * 100 >= 80 * greatest(na.n, nb.n)
  GROUP BY a.doc_id, b.doc_id),
e AS (
  SELECT x, y FROM p JOIN n na ON na.doc_id = x JOIN n nb ON nb.doc_id = y WHERE 100 * i >= 80 * (na.n + nb.n - i)),
edge AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
reach(x, y) AS (SELECT x, y FROM edge UNION SELECT r.x, b.y FROM reach r JOIN edge b ON r.y = b.x),
c AS (SELECT x, min(y) AS c FROM reach GROUP BY x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(c.c, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(c.c, d.doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.x = d.doc_id
"""


@query
def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cube-method mix of all documents: 150% of all words, weights 3, 1, 2."""
    from histmart.llm.mixing import mix, word_count

    thin = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_key"), F.col("source").cast("string").alias("source"), word_count("text").alias("size"))
    out = mix(thin, share=1.5, weights=(3, 1, 2), most=2.0)
    return out.select(F.col("row_key").alias("doc_id"), "size", "source_size", "target", "taken", "source", "copies")


@query
def op2_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of near equal bytes by a k-d tree over all documents."""
    from histmart.llm.kdshard import kd_shards

    docs = table(spark, sf_dir, "documents").withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    out = kd_shards(docs, n_shards=8, columns=["doc_id", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
                      F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that aren't held out."""
    from histmart.llm.langid import identify

    return identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score", "family_pred")


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kneser-Ney perplexity of all documents, and which are kept."""
    from histmart.llm.quality import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("text_hash")


@query
def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings of one label at cosine 0.98."""
    from histmart.llm.vectors import vector_dedup

    return vector_dedup(table(spark, sf_dir, "embeddings"), threshold=0.98)


ORACLE["op6_embedding_near_dedup"] = r"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
edge AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(x, y) AS (SELECT x, y FROM edge UNION SELECT r.x, b.y FROM reach r JOIN edge b ON r.y = b.x),
c AS (SELECT x, min(y) AS c FROM reach GROUP BY x),
n AS (SELECT x, count(*) AS n FROM edge GROUP BY x)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(c, vec_id)) AS component_id, vec_id <= coalesce(c, vec_id) AS kept
FROM v LEFT JOIN n ON n.x = vec_id LEFT JOIN c ON c.x = vec_id
"""


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in all documents."""
    from histmart.llm.licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    from histmart.llm.pii import find_pii

    return find_pii(table(spark, sf_dir, "documents"))


@query
def op5_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tool calls of all conversations, linked, ordered, checked, as JSON."""
    from histmart.llm.toolcalls import TOOLS, calls_of_conversations, link_tool_calls

    calls, results = calls_of_conversations(table(spark, sf_dir, "conversations"))
    return link_tool_calls(calls, results, TOOLS)


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, grouped with the likely spelling they vary."""
    from histmart.llm.spelling import count_words, group_variants

    return group_variants(count_words(table(spark, sf_dir, "documents"), every=97, least=5, often=3), ratio=2)


ORACLE["op13_spelling_variants"] = r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run
  FROM documents),
r AS (SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h FROM d GROUP BY doc_id, run),
tab AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda a, k: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t
  FROM range(256) x(i)),
c AS (
  SELECT r.*, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(h) + 1, 2), lambda k: CAST('0x' || h[k:k + 1] AS BIGINT))),
                              lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) AS crc
  FROM r, tab),
w AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN crc % 97 = 0 THEN run[:crc % length(run)] || run[crc % length(run) + 2:] ELSE run END AS word FROM c)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
holes AS (
  SELECT word, i, word[:i - 1] AS x, word[i + 1:] AS y, word[:i - 1] || word[i + 1:] AS shorter FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
near AS (
  SELECT a.word AS a, b.word AS b FROM holes a JOIN holes b ON a.i = b.i AND a.x = b.x AND a.y = b.y WHERE a.word <> b.word
  UNION SELECT holes.word, w.word FROM holes JOIN w ON w.word = holes.shorter
  UNION SELECT w.word, holes.word FROM holes JOIN w ON w.word = holes.shorter),
best AS (
  SELECT a, count(*) AS n_near, first(b ORDER BY n DESC, encode(b)) AS form, max(n) AS form_n FROM near JOIN w ON w.word = b GROUP BY a),
f AS (
  SELECT word, n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, CASE WHEN form_n >= 2 * n THEN form END AS form, CASE WHEN form_n >= 2 * n THEN form_n END AS form_n
  FROM w LEFT JOIN best ON a = word),
chain AS (
  WITH RECURSIVE s(word, last, depth) AS (
    SELECT word, word, 0 FROM f UNION ALL SELECT s.word, f.form, depth + 1 FROM s JOIN f ON f.word = s.last WHERE f.form IS NOT NULL)
  SELECT word, arg_max(last, depth) AS root FROM s GROUP BY word)
SELECT f.word, f.form, chain.root, f.n, f.n_near, f.form_n FROM f JOIN chain USING (word)
"""


@query
def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents in passages of 35 words that repeat."""
    from histmart.llm.recompress import long_repeats

    return long_repeats(table(spark, sf_dir, "documents"), size=35).drop("spans")


ORACLE["op11_substring_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT r, i, array_to_string(w[i:i + 34], ' ') AS s
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
again AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM win JOIN again USING (s)),
k AS (
  SELECT r, count(*) AS n_removed, list(p) AS ps FROM gone GROUP BY r),
kept AS (
  SELECT r, string_agg(x, ' ' ORDER BY p) AS t
  FROM (SELECT d.r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r) LEFT JOIN kept USING (r)
"""


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every conversation after planted damage."""
    from histmart.llm.convrepair import repair_damaged

    return repair_damaged(table(spark, sf_dir, "conversations"))
