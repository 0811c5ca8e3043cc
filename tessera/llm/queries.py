"""One query per operator: it applies the operator to its whole table and derives
the digest columns from the operator's output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, exact_dedup, language, mixing, negatives, pages, passages, prefix_trie, repeats, set_join, token_counts, top_k, warc
from tessera.llm.registry import ORACLES, QUERIES, register, table

__all__ = ["ORACLES", "QUERIES"]


@register("op3_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(language.labelled(docs))
    found = docs.select("doc_id", language.held_out().alias("held_out"),
                        language.predict(spark, model, F.col("text")).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")


@register("op4_jaccard_join")
def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = set_join.components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


WHITE_SPACE_SQL = r"'[\x20\x09-\x0D]'"


@register("op6_exact_dedup", rf"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), {WHITE_SPACE_SQL}, '', 'g')) AS text_sha256
  FROM documents),
r AS (
  SELECT *, row_number() OVER w AS k, first_value(doc_id) OVER w AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, k = 1 AS kept, text_sha256 FROM r
""")
def dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents")).drop("text_hash")


@register("op7_bpe")
def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", bpe.round_trip(F.col("text")).alias("p"))
    return found.select("doc_id", F.size("p.ids").cast("long").alias("n_tokens"),
                        F.sha2(F.concat_ws(",", F.col("p.ids").cast("array<string>")), 256).alias("ids_sha256"),
                        F.sha2("p.decoded", 256).alias("decoded_sha256"))


@register("op10_mixing")
def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@register("op8_repeats")
def repeats_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    length = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", length.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


@register("op9_main_text")
def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


@register("op5_bm25_documents", r"""
WITH d AS (
  SELECT doc_id, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') AS terms
  FROM documents),
t AS (SELECT doc_id, unnest(terms) AS term FROM d),
tf AS (SELECT doc_id, term, count(*) AS n FROM t WHERE term <> '' GROUP BY ALL),
len AS (SELECT d.doc_id, coalesce(sum(n), 0) AS l FROM d LEFT JOIN tf USING (doc_id) GROUP BY ALL),
st AS (SELECT count(*) AS n_docs, avg(l) AS mean FROM len),
q AS (SELECT doc_id AS query_id, term, n AS times FROM tf WHERE doc_id % 20 = 0),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
s AS (
  SELECT q.query_id, tf.doc_id,
         round(sum(times * ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * l / mean))), 6) AS score
  FROM q JOIN tf USING (term) JOIN df USING (term) JOIN len USING (doc_id), st GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s)
SELECT query_id, doc_id, score, rank FROM r WHERE rank <= 10
""")
def bm25_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole text of every document whose id is divisible by 20 as a query against all documents."""
    docs = table(spark, sf_dir, "documents")
    found = top_k.search(spark, docs, docs.where("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), F.col("text").alias("query")))
    return found.select("query_id", "doc_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@register("op5_bm25_top_k", r"""
WITH d AS (
  SELECT doc_id, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') AS terms
  FROM documents),
t AS (SELECT doc_id, unnest(terms) AS term FROM d),
tf AS (SELECT doc_id, term, count(*) AS n FROM t WHERE term <> '' GROUP BY ALL),
len AS (SELECT d.doc_id, coalesce(sum(n), 0) AS l FROM d LEFT JOIN tf USING (doc_id) GROUP BY ALL),
st AS (SELECT count(*) AS n_docs, avg(l) AS mean FROM len),
q AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+')) AS term
    FROM benchmark WHERE item_id % 20 = 0) WHERE term <> '' GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
s AS (
  SELECT q.item_id, tf.doc_id,
         round(sum(times * ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * l / mean))), 6) AS score
  FROM q JOIN tf USING (term) JOIN df USING (term) JOIN len USING (doc_id), st GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s)
SELECT item_id, doc_id, score, rank FROM r WHERE rank <= 10
""")
def bm25_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages whose id is divisible by 20 as queries against all documents."""
    asked = table(spark, sf_dir, "benchmark").where("item_id % 20 = 0").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    found = top_k.search(spark, table(spark, sf_dir, "documents"), asked)
    return found.select(F.col("query_id").alias("item_id"), "doc_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@register("op1_token_counts")
def section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


@register("op1_window_tokens")
def window_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every window of 200 characters of a text: their borders fall into tokens, which are shared by bytes."""
    found = token_counts.count_tokens(table(spark, sf_dir, "documents"), fields=("text",), by_line=(), widths={"text": 200}, rule="share")
    return found.withColumn("n_tokens", F.round("n_tokens", 6))


@register("op2_warc_derivatives")
def warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = warc.derivatives(warc.page_responses(table(spark, sf_dir, "pages")), keep=("page_id",))
    return made.withColumn("block", F.decode("block", "utf-8")).drop("record")


@register("op11_prefix_trie", r"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT DISTINCT conv_id, conv_id - conv_id % 5 AS base, conv_id::VARCHAR AS name FROM t),
c AS (
  SELECT conv_id, base,
         xor(list_reduce([4294967295] || list_transform(range(1, length(name) + 1), lambda k: ord(name[k])::BIGINT),
             lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 9 AS h
  FROM s),
r AS (
  SELECT c.conv_id, 0 AS own, i, role, text FROM c JOIN t ON t.conv_id = c.base WHERE i <= h
  UNION ALL SELECT c.conv_id, 1, i, role, text FROM c JOIN t USING (conv_id) WHERE i > h),
q AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, i) AS d, role, text FROM r),
p AS (
  SELECT conv_id, d, strlen(text) AS b, string_agg(strlen(role) || ':' || role || md5(text), '/') OVER (PARTITION BY conv_id ORDER BY d) AS path FROM q
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
l AS (SELECT *, lag(path) OVER (PARTITION BY conv_id ORDER BY d) AS above, max(d) OVER (PARTITION BY conv_id) AS n FROM p),
v AS (
  SELECT path, d, min(conv_id) AS conv_id, any_value(above) AS above, any_value(b) AS b, count(*) AS n_convs,
         string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE d = n) AS ends
  FROM l GROUP BY path, d),
k AS (SELECT above AS path, count(*) AS n_children FROM v WHERE d > 0 GROUP BY above),
w AS (SELECT v.*, coalesce(n_children, 0) AS n_children FROM v LEFT JOIN k USING (path)),
u AS (
  SELECT a.path, sum((w.n_convs - 1) * w.b)::BIGINT AS saved_tokens, (count(*) FILTER (WHERE w.n_children = 0)) AS n_leaves
  FROM w JOIN p a ON a.conv_id = w.conv_id AND a.d <= w.d GROUP BY a.path)
SELECT w.conv_id, w.d AS depth, m.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens, sha256(coalesce(w.ends, '')) AS ends_sha256
FROM w JOIN u USING (path) LEFT JOIN v m ON w.d > 0 AND m.path = w.above
""")
def conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations that begin with the first turns of the one they stem from, as a trie."""
    base = F.col("conv_id") - F.col("conv_id") % 5
    shared = (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"), base, shared, most=8)


@register("op12_hard_negatives", r"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS k FROM s WHERE same QUALIFY k <= 5)
SELECT p.anchor_id, p.other_id AS positive_id, (row_number() OVER w)::INTEGER AS rank, s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.other_id ORDER BY s.score DESC, s.other_id) QUALIFY row_number() OVER w <= 5
""")
def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors, label=label)


@register("op13_passages", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents),
p AS (
  SELECT doc_id, unnest(range(1, len(w) - 18)) AS j, unnest(list_transform(range(1, len(w) - 18), lambda j: md5(array_to_string(w[j:j + 19], ' ')))) AS passage
  FROM d),
x AS (SELECT doc_id, j, row_number() OVER (PARTITION BY passage ORDER BY doc_id, j) AS k FROM p),
g AS (SELECT DISTINCT doc_id, unnest(range(j, j + 20)) AS i FROM x WHERE k > 1),
k AS (
  SELECT a.doc_id, string_agg(a.word, ' ' ORDER BY a.i) FILTER (WHERE g.i IS NULL) AS kept, count(g.i) AS n
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d) a LEFT JOIN g USING (doc_id, i) GROUP BY a.doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
""")
def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.remove_passages(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))
