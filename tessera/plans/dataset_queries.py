"""Dataset-construction queries (examples, split, report, chat text, chunks)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import dataset as D
from tessera.plans import sqlfrag as S
from tessera.plans.registry import register
from tessera.sources.tables import Tables

SYSTEM_PROMPT = "Turn the listed attributes into a short plain text about the item."

# documents play the catalog rows, part gives each row its structured spec
# (LEFT JOIN on doc_id = p_partkey), labels add side attributes.


def raw_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    d = t.spread("documents").select("doc_id", "text")
    p = t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    lab = t.labels.select("doc_id", "quality", "toxic")
    return (d.join(p, d.doc_id == p.p_partkey, "left").drop("p_partkey")
             .join(lab, "doc_id", "left"))


def examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_examples(spark, sf_dir)
    inp = D.input_struct(name=F.col("p_name"), brand=F.col("p_brand"), category=F.col("p_type"),
                         size=F.col("p_size").cast("string"), mrp=F.col("p_retailprice"))
    extras = F.map_from_arrays(F.array(F.lit("quality"), F.lit("toxic")),
                               F.array(F.col("quality").cast("string"), F.col("toxic").cast("string")))
    return D.build_examples(raw, "doc_id", "text", inp, extras=extras)


def split_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    ex = examples(spark, sf_dir)
    return D.split_examples(ex.where("kept"))


_EX_SQL = f"""
WITH raw AS (
  SELECT d.doc_id, d.text, p.p_name, p.p_brand, p.p_type, p.p_size, p.p_retailprice
  FROM documents d LEFT JOIN part p ON d.doc_id = p.p_partkey
  WHERE d.text IS NOT NULL AND length(d.text) BETWEEN 80 AND 1500
), ex AS (
  SELECT CAST(doc_id AS VARCHAR) AS id,
         coalesce({S.clean('p_name')}, '') AS name, {S.clean('p_brand')} AS brand,
         {S.clean('p_type')} AS category, {S.clean('CAST(p_size AS VARCHAR)')} AS size,
         CASE WHEN NOT isnan(p_retailprice) THEN p_retailprice END AS mrp,
         {S.clean('text')} AS output
  FROM raw
), kept AS (SELECT * FROM ex WHERE output IS NOT NULL
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY {S.md5_order('id')}, id) - 1 AS rk, count(*) OVER () AS n
  FROM kept)
"""


@register("examples_split", sql=_EX_SQL + f"""
SELECT id, name, brand, category, size, mrp, output,
       {S.spec_block(sku='NULL', material='NULL', finish='NULL', length='NULL', breadth='NULL',
                     height='NULL', weight='NULL', tagline='NULL')} AS prompt,
       {S.split_case('rk', 'n')} AS split
FROM ranked""")
def q_examples_split(spark, sf_dir):
    s = split_examples(spark, sf_dir)
    return s.select("id", F.col("input.name").alias("name"), F.col("input.brand").alias("brand"),
                    F.col("input.category").alias("category"), F.col("input.size").alias("size"),
                    F.col("input.mrp").alias("mrp"), "output",
                    D.render_spec_block(F.col("input")).alias("prompt"), "split")


@register("split_figures", sql=_EX_SQL + f"""
SELECT split, count(*) AS n, round(avg(length(output)), 6) AS mean_chars, min(length(output)) AS min_chars, max(length(output)) AS max_chars,
       round(avg(CASE WHEN brand IS NULL THEN 0.0 ELSE 1.0 END), 6) AS with_brand, round(avg(CASE WHEN mrp IS NULL THEN 0.0 ELSE 1.0 END), 6) AS with_price,
       count(DISTINCT brand) AS brands
FROM (SELECT *, {S.split_case('rk', 'n')} AS split FROM ranked) GROUP BY split""")
def q_split_figures(spark, sf_dir):
    """Derived columns of the examples, summed up per split."""
    f = D.split_figures(split_examples(spark, sf_dir))
    return f.select("split", "n", *[F.round(c, 6).alias(c) for c in ("mean_chars",)], F.col("min_chars").cast("long"), F.col("max_chars").cast("long"),
                    F.round("with_brand", 6).alias("with_brand"), F.round("with_price", 6).alias("with_price"), "brands")


@register("export_report", sql=f"""
WITH raw AS (
  SELECT d.text FROM documents d
  WHERE d.text IS NOT NULL AND length(d.text) BETWEEN 80 AND 1500
), kept AS (SELECT count(*) AS n FROM raw WHERE {S.clean('text')} IS NOT NULL)
SELECT (SELECT count(*) FROM raw) AS fetched, n AS kept, (SELECT count(*) FROM raw) - n AS skipped,
       CAST(floor(0.8::DOUBLE * n) AS BIGINT) AS train, CAST(floor(0.1::DOUBLE * n) AS BIGINT) AS val,
       CAST(n - floor(0.8::DOUBLE * n) - floor(0.1::DOUBLE * n) AS BIGINT) AS test
FROM kept""")
def q_export_report(spark, sf_dir):
    ex = examples(spark, sf_dir)
    return D.export_report(D.split_examples(ex.where("kept")), ex)


@register("examples_extras", sql=f"""
SELECT CAST(d.doc_id AS VARCHAR) AS id, CAST(l.quality AS VARCHAR) AS quality,
       CAST(l.toxic AS VARCHAR) AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE d.text IS NOT NULL AND length(d.text) BETWEEN 80 AND 1500 AND {S.clean('d.text')} IS NOT NULL""")
def q_examples_extras(spark, sf_dir):
    ex = examples(spark, sf_dir).where("kept")
    return ex.select("id", F.col("extras")["quality"].alias("quality"), F.col("extras")["toxic"].alias("toxic"))


@register("training_text", sql=_EX_SQL + f"""
SELECT id, '<|system|>' || chr(10) || {S.lit(SYSTEM_PROMPT)} || '<|end|>' || chr(10)
        || '<|user|>' || chr(10) || {S.spec_block(sku='NULL', material='NULL', finish='NULL', length='NULL',
                                                   breadth='NULL', height='NULL', weight='NULL',
                                                   tagline='NULL')} || '<|end|>' || chr(10)
        || '<|assistant|>' || chr(10) || output || '<|end|>' || chr(10) AS text
FROM kept""")
def q_training_text(spark, sf_dir):
    return D.training_text(examples(spark, sf_dir).where("kept"), SYSTEM_PROMPT)


@register("clean_pages", sql=f"""
SELECT page_id, {S.clean('html')} AS text, length({S.clean('html')}) AS n_chars
FROM pages""")
def q_clean_pages(spark, sf_dir):
    p = Tables(spark, sf_dir).spread("pages")
    c = T.clean_text(F.col("html"))
    return p.select("page_id", c.alias("text"), F.length(c).alias("n_chars"))


@register("conversation_text", sql="""
SELECT conv_id, count(*) AS n_turns,
       string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '' ORDER BY turn) AS text
FROM conversations GROUP BY conv_id""")
def q_conversation_text(spark, sf_dir):
    from tessera.operators.conversations import conversation_text
    return conversation_text(Tables(spark, sf_dir).spread("conversations"))


@register("sentences", sql=f"""
WITH s AS (
  SELECT doc_id, unnest(list_filter(string_split(
           regexp_replace(regexp_replace(regexp_replace(text, '^' || {S.WS_RUN}, ''), {S.WS_RUN} || '$', ''),
                          '([.!?])' || {S.WS_RUN}, '\\1' || chr(1), 'g'), chr(1)), lambda x: x <> '')) AS sentence
  FROM documents)
SELECT doc_id, count(*) AS n_sentences, CAST(sum(length(sentence)) AS BIGINT) AS n_chars FROM s GROUP BY doc_id""")
def q_sentences(spark, sf_dir):
    d = Tables(spark, sf_dir).spread("documents")
    s = d.select("doc_id", F.explode(T.split_sentences(F.col("text"))).alias("sentence"))
    return s.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_sentences"),
                                   F.sum(F.length("sentence")).alias("n_chars"))


@register("spec_block_full", sql=f"""
WITH s AS (SELECT p_partkey, p_name AS name, p_brand AS brand, p_type AS category,
       'SKU-' || CAST(p_partkey AS VARCHAR) AS sku, split_part(p_name, ' ', 1) AS material,
       CASE WHEN p_partkey % 4 = 0 THEN '' ELSE split_part(p_name, ' ', 2) END AS finish, CAST(p_size AS VARCHAR) AS size,
       CAST(p_size AS DOUBLE) AS length_cm, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_size / 2.0::DOUBLE END AS breadth_cm,
       CAST(p_partkey % 5 AS DOUBLE) AS height_cm, p_size * 12.5::DOUBLE AS weight_grams, p_retailprice AS mrp,
       CASE WHEN p_partkey % 2 = 0 THEN p_type || ' ' || p_brand END AS short_description FROM part)
SELECT p_partkey, {{S.spec_block()}} AS spec FROM s""".replace("{{S.spec_block()}}", S.spec_block()).replace("{S.spec_block()}", S.spec_block()))
def q_spec_block_full(spark, sf_dir):
    """Spec blocks of rows that have every field, and of rows where some are absent or zero."""
    p, key, size = Tables(spark, sf_dir).part, F.col("p_partkey"), F.col("p_size")
    inp = D.input_struct(
        name=F.col("p_name"), brand=F.col("p_brand"), category=F.col("p_type"), sku=F.concat(F.lit("SKU-"), key.cast("string")),
        material=F.split_part("p_name", F.lit(" "), F.lit(1)),
        finish=F.when(key % 4 == 0, "").otherwise(F.split_part("p_name", F.lit(" "), F.lit(2))), size=size.cast("string"),
        length_cm=size.cast("double"), breadth_cm=F.when(key % 3 != 0, size / F.lit(2.0)), height_cm=(key % 5).cast("double"),
        weight_grams=size * F.lit(12.5), mrp=F.col("p_retailprice"),
        short_description=F.when(key % 2 == 0, F.concat_ws(" ", "p_type", "p_brand")))
    return p.select("p_partkey", D.render_spec_block(inp).alias("spec"))


@register("chunks", sql=f"""
WITH s AS (
  SELECT doc_id, list_filter(string_split(
           regexp_replace(regexp_replace(regexp_replace(text, '^' || {S.WS_RUN}, ''), {S.WS_RUN} || '$', ''),
                          '([.!?])' || {S.WS_RUN}, '\\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS sents
  FROM documents),
f AS (SELECT doc_id, list_reduce(list_transform(sents, lambda s: [s]), lambda acc, s:
        CASE WHEN length(acc[len(acc)]) + 1 + length(s[1]) <= 180
             THEN list_concat(acc[1:len(acc) - 1], [acc[len(acc)] || ' ' || s[1]])
             ELSE list_concat(acc, s) END) AS chunks
      FROM s WHERE len(sents) > 0)
SELECT doc_id, CAST(i - 1 AS INTEGER) AS chunk_no, chunks[i] AS chunk, length(chunks[i]) AS n_chars
FROM (SELECT doc_id, chunks, unnest(range(1, len(chunks) + 1)) AS i FROM f)""")
def q_chunks(spark, sf_dir):
    """F11 packing: (doc_id, chunk_no, chunk, n_chars)."""
    d = Tables(spark, sf_dir).spread("documents")
    c = d.select("doc_id", F.posexplode(T.chunk_text(F.col("text"), 180)).alias("chunk_no", "chunk"))
    return c.withColumn("n_chars", F.length("chunk"))
