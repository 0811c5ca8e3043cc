"""Profiling, filter, join and ordering queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import joins as J
from tessera.operators import profile as P
from tessera.plans import sqlfrag as S
from tessera.plans.registry import register
from tessera.sources.tables import TABLES, Tables

AS_OF = "2001-08-01 00:00:00"
WINDOW_FROM, WINDOW_TO = "2024-01-15 00:00:00", "2024-01-20 00:00:00"


# ---------------------------------------------------------------- 2.B filters
@register("filter_text_length", sql="""
SELECT doc_id, length(text) AS n_chars FROM documents
WHERE text IS NOT NULL AND length(text) BETWEEN 80 AND 1500""")
def q_filter_text_length(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    return d.where(F.col("text").isNotNull() & F.length("text").between(80, 1500)) \
            .select("doc_id", F.length("text").alias("n_chars"))


@register("events_window", sql=f"""
SELECT event_id, user_id, event_type, value FROM events
WHERE ts >= TIMESTAMP '{WINDOW_FROM}' AND ts < TIMESTAMP '{WINDOW_TO}'""")
def q_events_window(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    return e.where((F.col("ts") >= F.lit(WINDOW_FROM).cast("timestamp_ntz"))
                   & (F.col("ts") < F.lit(WINDOW_TO).cast("timestamp_ntz"))) \
            .select("event_id", "user_id", "event_type", "value")


@register("exclude_like", sql=r"""
SELECT c_custkey, c_name FROM customer
WHERE c_name NOT LIKE 'Customer#00000001%' AND c_mktsegment NOT LIKE 'AUTO\_%' ESCAPE '\'""")
def q_exclude_like(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    return c.where(~F.col("c_name").like("Customer#00000001%") & ~F.col("c_mktsegment").like("AUTO\\_%")) \
            .select("c_custkey", "c_name")


@register("presence_flags", sql="""
SELECT d.doc_id, l.quality IS NOT NULL AS has_quality, l.toxic IS NOT NULL AS has_toxic,
       d.text IS NOT NULL AS has_text
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def q_presence_flags(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = t.documents.select("doc_id", "text").join(t.labels, "doc_id", "left")
    return j.select("doc_id", F.col("quality").isNotNull().alias("has_quality"),
                    F.col("toxic").isNotNull().alias("has_toxic"), F.col("text").isNotNull().alias("has_text"))


@register("text_sizes", sql=f"""
SELECT doc_id, length(text) AS n_chars, {S.word_count('text')} AS n_words FROM documents""")
def q_text_sizes(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    return d.select("doc_id", T.char_count(F.col("text")).alias("n_chars"),
                    T.word_count(F.col("text")).alias("n_words"))


@register("coerce_props", sql="""
SELECT event_id, CASE WHEN NOT isnan(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE))
                      THEN TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k
FROM events""")
def q_coerce_props(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    return e.select("event_id", T.coerce_double(F.get_json_object("props", "$.k")).alias("k"))


@register("order_casts", sql="""
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS order_date,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS total,
       CAST(round(o_totalprice) AS BIGINT) AS total_int, CAST(o_orderkey AS VARCHAR) AS order_id
FROM orders""")
def q_order_casts(spark, sf_dir):
    # the operator gives DATE and DECIMAL(12,2); shown as the types that both engines print alike
    return P.typed_orders(Tables(spark, sf_dir).orders).withColumns(
        {"order_date": F.col("order_date").cast("timestamp_ntz"), "total": F.col("total").cast("double")})


@register("take_first", sql="""
SELECT doc_id, length(text) AS n_chars FROM documents ORDER BY doc_id LIMIT 10""")
def q_take_first(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    return d.orderBy("doc_id").limit(10).select("doc_id", F.length("text").alias("n_chars"))


# ---------------------------------------------------------------- 2.C joins
@register("enrich_orders", sql="""
SELECT o.o_orderkey, c.c_name, n.n_name, o.o_totalprice
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
              LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def q_enrich_orders(spark, sf_dir):
    t = Tables(spark, sf_dir)
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    c = t.customer.select("c_custkey", "c_name", "c_nationkey")
    n = t.nation.select("n_nationkey", "n_name")
    j = J.enrich(o, c, o.o_custkey == c.c_custkey)
    j = J.enrich(j, n, j.c_nationkey == n.n_nationkey)
    return j.select("o_orderkey", "c_name", "n_name", "o_totalprice")


@register("inner_enrich", sql="""
SELECT l.l_orderkey, l.l_linenumber, p.p_brand, p.p_type
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""")
def q_inner_enrich(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    p = t.part.select("p_partkey", "p_brand", "p_type")
    return J.enrich(li, p, li.l_partkey == p.p_partkey, "inner") \
            .select("l_orderkey", "l_linenumber", "p_brand", "p_type")


_TOP_BRANDS = """
top AS (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 5)"""


@register("semi_topk_brands", sql=f"""
WITH {_TOP_BRANDS}
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey FROM lineitem l
WHERE l.l_partkey IN (SELECT p_partkey FROM part WHERE p_brand IN (SELECT p_brand FROM top))""")
def q_semi_topk_brands(spark, sf_dir):
    t = Tables(spark, sf_dir)
    top = P.top_k_groups(t.part, "p_brand", 5).select("p_brand")
    parts = J.semi(t.part.select("p_partkey", "p_brand"), F.broadcast(top), "p_brand")  # k rows
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return J.semi(li, parts, li.l_partkey == parts.p_partkey)


@register("unlabeled_docs", sql="""
SELECT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def q_unlabeled_docs(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return J.anti(t.documents.select("doc_id"), t.labels.select("doc_id"), "doc_id")


@register("align_hourly", sql="""
WITH a AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1),
     b AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events WHERE event_type = 'signup' GROUP BY 1)
SELECT coalesce(a.hour, b.hour) AS hour, CAST(a.n AS DOUBLE) AS n_purchase, CAST(b.n AS DOUBLE) AS n_signup
FROM a FULL OUTER JOIN b ON a.hour = b.hour""")
def q_align_hourly(spark, sf_dir):
    e = Tables(spark, sf_dir).events

    def hourly(kind, name):
        return e.where(F.col("event_type") == kind) \
                .groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(F.count(F.lit(1)).alias(name))
    j = J.align(hourly("purchase", "n_purchase"), hourly("signup", "n_signup"), "hour", ("", ""))
    # counts stay NULL where an hour is missing on one side; double keeps NULL portable
    return j.select("hour", F.col("n_purchase").cast("double").alias("n_purchase"),
                    F.col("n_signup").cast("double").alias("n_signup"))


@register("lookup_neighbor", sql="""
SELECT d.doc_id, length(coalesce(nullif(n.text, ''), '')) AS pred_chars
FROM documents d LEFT JOIN documents n ON n.doc_id = d.doc_id + 1""")
def q_lookup_neighbor(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    j = J.lookup_with_fallback(d.select("doc_id"), d.select("doc_id", "text"), F.col("doc_id") + 1,
                               "doc_id", "text", "pred", "")
    return j.select("doc_id", F.length("pred").alias("pred_chars"))


# ---------------------------------------------------------------- 2.D aggregates
@register("length_profile", sql="""
SELECT count(*) AS n_rows, count(text) AS n_present, CAST(round(avg(length(text))) AS BIGINT) AS avg_len,
       CAST(round_even(quantile_cont(length(text), 0.5), 0) AS BIGINT) AS p50_len,
       CAST(round_even(quantile_cont(length(text), 0.95), 0) AS BIGINT) AS p95_len,
       max(length(text)) AS max_len
FROM documents""")
def q_length_profile(spark, sf_dir):
    return P.length_profile(Tables(spark, sf_dir).documents, "text")


@register("monthly_revenue", sql=f"""
SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month, count(*) AS n_orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS revenue
FROM orders WHERE o_orderdate > TIMESTAMP '{AS_OF}' - INTERVAL 12 MONTH
GROUP BY 1""")
def q_monthly_revenue(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    lo = F.add_months(F.lit(AS_OF).cast("timestamp_ntz"), -12).cast("timestamp_ntz")
    r = o.where(F.col("o_orderdate") > lo)
    return P.monthly_totals(r, "o_orderdate", "o_totalprice").withColumns(
        {"month": F.col("month").cast("timestamp_ntz"), "revenue": F.col("revenue").cast("double")})


@register("value_counts_source", sql="""
SELECT coalesce(CAST(source AS VARCHAR), '(none)') AS value, count(*) AS n FROM documents
GROUP BY 1 ORDER BY n DESC, value LIMIT 15""")
def q_value_counts_source(spark, sf_dir):
    return P.value_counts(Tables(spark, sf_dir).documents, F.col("source"), 15)


@register("value_counts_quality", sql="""
SELECT coalesce(CAST(l.quality AS VARCHAR), '(none)') AS value, count(*) AS n
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
GROUP BY 1 ORDER BY n DESC, value LIMIT 15""")
def q_value_counts_quality(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return P.value_counts(j, F.col("quality"), 15)


_COV_FIELDS = ("p_name", "p_brand", "quality", "toxic", "text")


@register("coverage", sql="""
WITH j AS (SELECT d.text, p.p_name, p.p_brand, l.quality, l.toxic
           FROM documents d LEFT JOIN part p ON d.doc_id = p.p_partkey LEFT JOIN labels l ON d.doc_id = l.doc_id),
w AS (SELECT """ + ", ".join(f"round(avg(CASE WHEN {c} IS NOT NULL THEN 1.0 ELSE 0.0 END) * 100.0, 1) AS {c}"
                             for c in _COV_FIELDS) + """ FROM j)
""" + " UNION ALL ".join(f"SELECT '{c}' AS field, {c} AS pct_present FROM w" for c in _COV_FIELDS))
def q_coverage(spark, sf_dir):
    t = Tables(spark, sf_dir)
    d = t.documents.select("doc_id", "text")
    p = t.part.select("p_partkey", "p_name", "p_brand")
    j = d.join(p, d.doc_id == p.p_partkey, "left").join(t.labels, "doc_id", "left")
    return P.coverage(j, _COV_FIELDS)


@register("describe_chars", sql="""
SELECT count(n_chars) AS count, round(avg(n_chars), 6) AS mean, round(stddev_samp(n_chars), 6) AS std,
       min(n_chars) AS min, quantile_cont(n_chars, 0.25) AS p25, quantile_cont(n_chars, 0.5) AS p50,
       quantile_cont(n_chars, 0.75) AS p75, max(n_chars) AS max
FROM documents""")
def q_describe_chars(spark, sf_dir):
    r = P.describe_numeric(Tables(spark, sf_dir).documents, "n_chars")
    return r.withColumn("mean", F.round("mean", 6)).withColumn("std", F.round("std", 6))


@register("median_price_by_type", sql="""
SELECT p_type, count(*) AS n, round(median(p_retailprice), 1) AS p_retailprice_median, round(median(p_size), 1) AS p_size_median
FROM part GROUP BY p_type ORDER BY p_retailprice_median DESC, p_type LIMIT 12""")
def q_median_price_by_type(spark, sf_dir):
    return P.median_by_group(Tables(spark, sf_dir).part, "p_type", ["p_retailprice", "p_size"], top=12)


@register("lineitem_mean_std", sql="""
SELECT l_returnflag, count(*) AS n, round(avg(l_quantity), 4) AS l_quantity_mean,
       round(stddev_samp(l_quantity), 4) AS l_quantity_std, round(avg(l_discount), 4) AS l_discount_mean,
       round(stddev_samp(l_discount), 4) AS l_discount_std
FROM lineitem GROUP BY l_returnflag""")
def q_lineitem_mean_std(spark, sf_dir):
    return P.group_mean_std(Tables(spark, sf_dir).lineitem, "l_returnflag", ["l_quantity", "l_discount"],
                            order=["A", "N", "R"])


@register("price_fit", sql="""
SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept,
       round(corr(l_quantity, l_extendedprice), 6) AS r, count(*) AS n
FROM lineitem""")
def q_price_fit(spark, sf_dir):
    r = P.linear_fit(Tables(spark, sf_dir).lineitem, "l_quantity", "l_extendedprice")
    return r.select(*[F.round(c, 6).alias(c) for c in ("slope", "intercept", "r")], "n")


@register("char_buckets", sql="""
WITH q AS (SELECT quantile_cont(n_chars, 0.33) AS lo, quantile_cont(n_chars, 0.67) AS hi FROM documents),
b AS (SELECT d.n_chars, CASE WHEN d.n_chars <= q.lo THEN 'low' WHEN d.n_chars <= q.hi THEN 'mid' ELSE 'high' END AS bucket
      FROM documents d, q)
SELECT bucket, count(*) AS n, min(n_chars) AS min_chars, max(n_chars) AS max_chars FROM b GROUP BY bucket""")
def q_char_buckets(spark, sf_dir):
    b = P.quantile_buckets(Tables(spark, sf_dir).documents, "n_chars")
    return b.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("n_chars").alias("min_chars"),
                                   F.max("n_chars").alias("max_chars"))


@register("histogram_chars", sql="""
WITH x AS (SELECT CAST(length(text) AS DOUBLE) AS v FROM documents WHERE text IS NOT NULL),
mm AS (SELECT min(v) AS lo, max(v) AS hi FROM x),
b AS (SELECT CAST(least(CASE WHEN (hi - lo) / 40.0 > 0 THEN floor((v - lo) / ((hi - lo) / 40.0)) ELSE 0 END, 39)
              AS BIGINT) AS bin, lo, (hi - lo) / 40.0 AS width FROM x, mm)
SELECT bin, lo + bin * width AS lower, lo + (bin + 1) * width AS upper, count(*) AS n
FROM b GROUP BY bin, lo, width""")
def q_histogram_chars(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.select(F.length("text").alias("len"))
    return P.histogram(d, "len", 40)


@register("top_brands", sql="""
WITH top AS (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 5)
SELECT p_brand, n, row_number() OVER (ORDER BY n DESC, p_brand) - 1 AS label_idx FROM top""")
def q_top_brands(spark, sf_dir):
    return P.rank_labels(P.top_k_groups(Tables(spark, sf_dir).part, "p_brand", 5), "p_brand")


@register("class_balance", sql="""
WITH g AS (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1)
SELECT l_returnflag, n, round(n / sum(n) OVER (), 6) AS share, round(max(n) OVER () / sum(n) OVER (), 6) AS majority_share
FROM g""")
def q_class_balance(spark, sf_dir):
    b = P.class_balance(Tables(spark, sf_dir).lineitem, "l_returnflag")
    return b.select("l_returnflag", "n", F.round("share", 6).alias("share"),
                    F.round("majority_share", 6).alias("majority_share"))


@register("row_audit", sql=" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES)
    + " UNION ALL SELECT 'TOTAL' AS table_name, (" + " + ".join(f"(SELECT count(*) FROM {t})" for t in TABLES)
    + ") AS n_rows")
def q_row_audit(spark, sf_dir):
    from tessera.sources.catalog import row_audit
    return row_audit(spark, sf_dir, TABLES)


@register("latest_events", sql="""
SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts,
       arg_max(value, (ts, event_id)) AS value, arg_max(props, (ts, event_id)) AS props
FROM events GROUP BY user_id, event_type""")
def q_latest_events(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    return P.last_per_key(e, ["user_id", "event_type"], ["ts", "event_id"])


# ---------------------------------------------------------------- 2.E ordering
@register("top_bottom_docs", sql="""
(SELECT 'top' AS side, doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 5)
UNION ALL
(SELECT 'bottom' AS side, doc_id, n_chars FROM documents ORDER BY n_chars ASC, doc_id LIMIT 5)""")
def q_top_bottom_docs(spark, sf_dir):
    d = Tables(spark, sf_dir).documents.select("doc_id", "n_chars")
    top = P.top_n(d, "n_chars", 5, "doc_id", True).select(F.lit("top").alias("side"), "doc_id", "n_chars")
    bot = P.top_n(d, "n_chars", 5, "doc_id", False).select(F.lit("bottom").alias("side"), "doc_id", "n_chars")
    return top.unionByName(bot)


@register("latest_docs", sql="""
SELECT doc_id, length(text) AS n_chars FROM documents ORDER BY doc_id DESC LIMIT 10""")
def q_latest_docs(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    return d.orderBy(F.col("doc_id").desc()).limit(10).select("doc_id", F.length("text").alias("n_chars"))


@register("load_sources", sql="""
WITH u AS (
  SELECT 'documents' AS source, text AS text FROM documents WHERE text IS NOT NULL AND text <> ''
  UNION ALL SELECT 'part', p_name FROM part WHERE p_name IS NOT NULL AND p_name <> ''
  UNION ALL SELECT 'benchmark', text FROM benchmark WHERE text IS NOT NULL AND text <> '')
SELECT source, count(*) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM u GROUP BY source""")
def q_load_sources(spark, sf_dir):
    from tessera.sources.corpus import load_sources
    u = load_sources(spark, sf_dir)
    return u.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("text")).alias("n_chars"))


@register("clipped_lengths", sql="""
SELECT CAST(floor((greatest(100, least(1000, length(text))) - 100) / 50) AS BIGINT) AS bin, count(*) AS n
FROM documents WHERE text IS NOT NULL GROUP BY bin""")
def q_clipped_lengths(spark, sf_dir):
    """Text lengths between 100 and 1000 in bins of 50; shorter and longer ones are in the bins at the ends."""
    d = Tables(spark, sf_dir).documents.select(F.length("text").alias("chars"))
    return P.clipped_histogram(d, "chars", 100, 1000, 50)
