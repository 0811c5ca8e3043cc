"""Replication, document composition, embedding and vector queries."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import joins as J
from tessera.operators import sync as Y
from tessera.operators import vectors as V
from tessera.operators import sinks as K
from tessera.operators.udf import Model, embed
from tessera.plans.registry import ORACLES, register
from tessera.plans.stand_ins import hashing_embedder
from tessera.operators.versioned import Snapshot
from tessera.session import checkpoint_root, cut_lineage, scratch_path
from tessera.sources import files as FS
from tessera.sources.tables import Tables
from tessera.streaming.sync_stream import sync_stream

# events stand in for a tracked table: pk (user_id, event_type), tracking column ts.
PK = ("user_id", "event_type")
ORDER = ("ts", "event_id")
WATERMARK = "2024-01-15 00:00:00"
CEILING = "2024-01-20 00:00:00"
LOOKBACK_S = 300

_LATEST = """arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts, arg_max(value, (ts, event_id)) AS value,
       arg_max(props, (ts, event_id)) AS props"""
_SYNCED_SQL = f"""
WITH base AS (SELECT user_id, event_type, {_LATEST} FROM events
              WHERE ts < TIMESTAMP '{WATERMARK}' GROUP BY user_id, event_type),
ch AS (SELECT user_id, event_type, {_LATEST} FROM events
       WHERE ts >= TIMESTAMP '{WATERMARK}' - INTERVAL {LOOKBACK_S} SECOND AND ts < TIMESTAMP '{CEILING}'
       GROUP BY user_id, event_type)
SELECT b.user_id, b.event_type, b.event_id, b.ts, b.value, b.props FROM base b
WHERE NOT EXISTS (SELECT 1 FROM ch WHERE ch.user_id = b.user_id AND ch.event_type = b.event_type)
UNION ALL SELECT user_id, event_type, event_id, ts, value, props FROM ch"""


def _cols(df):
    return df.select("user_id", "event_type", "event_id", "ts", "value", "props")


@register("incremental_extract", sql=f"""
SELECT event_id, ts, user_id, event_type, value FROM events
WHERE ts >= TIMESTAMP '{WATERMARK}' - INTERVAL {LOOKBACK_S} SECOND AND ts < TIMESTAMP '{CEILING}'""")
def q_incremental_extract(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    return Y.incremental_extract(e, "ts", WATERMARK, CEILING, LOOKBACK_S) \
            .select("event_id", "ts", "user_id", "event_type", "value")


@register("dedupe_changes", sql=f"""
SELECT user_id, event_type, {_LATEST} FROM events
WHERE ts >= TIMESTAMP '{WATERMARK}' - INTERVAL {LOOKBACK_S} SECOND AND ts < TIMESTAMP '{CEILING}'
GROUP BY user_id, event_type""")
def q_dedupe_changes(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    ch = Y.incremental_extract(e, "ts", WATERMARK, CEILING, LOOKBACK_S)
    return _cols(Y.dedupe_changes(ch, PK, ORDER))


@register("upsert_events", sql=_SYNCED_SQL)
def q_upsert_events(spark, sf_dir):
    """Plan-only upsert: full copy up to the watermark, then the incremental window."""
    e = Tables(spark, sf_dir).events
    base = Y.dedupe_changes(Y.incremental_extract(e, "ts", None, WATERMARK), PK, ORDER)
    ch = Y.dedupe_changes(Y.incremental_extract(e, "ts", WATERMARK, CEILING, LOOKBACK_S), PK, ORDER)
    return _cols(Y.upsert(_cols(base), ch, PK))


@register("sync_batch_events", sql=_SYNCED_SQL)
def q_sync_batch_events(spark, sf_dir):
    """Two real sync runs into a versioned table with a committed watermark store."""
    root = scratch_path(spark, "sync")
    e = Tables(spark, sf_dir).events
    target = Y.VersionedTable(spark, f"{root}/events", PK)
    store = Y.WatermarkStore(spark, f"{root}/_watermarks")
    r1 = Y.sync_table(e, target, store, "events", "ts", WATERMARK, "run0001", ["event_id"], LOOKBACK_S)
    r2 = Y.sync_table(e, target, store, "events", "ts", CEILING, "run0002", ["event_id"], LOOKBACK_S)
    if Y.run_status([r1, r2]) != "ok":
        raise RuntimeError(f"sync failed: {r1} {r2}")
    return _cols(target.read())


_ALL_SYNCED_SQL = f"""
SELECT user_id, event_type, {_LATEST} FROM events GROUP BY user_id, event_type"""


@register("sync_catch_up", sql=_ALL_SYNCED_SQL)
def q_sync_catch_up(spark, sf_dir):
    """Runs up to two ceilings and one after the last row: the target is the whole table's last state."""
    root = scratch_path(spark, "sync")
    e = Tables(spark, sf_dir).events
    target = Y.VersionedTable(spark, f"{root}/events", PK)
    store = Y.WatermarkStore(spark, f"{root}/_watermarks")
    last = e.agg((F.max("ts") + F.expr("INTERVAL 1 SECOND")).alias("t")).first()["t"] or CEILING
    for i, ceiling in enumerate((WATERMARK, CEILING, last)):
        r = Y.sync_table(e, target, store, "events", "ts", ceiling, f"run{i}", ["event_id"], LOOKBACK_S)
        if r["status"] != "ok":
            raise RuntimeError(f"sync failed: {r}")
    return _cols(target.read())


@register("sync_stream_events", sql=_SYNCED_SQL)
def q_sync_stream_events(spark, sf_dir):
    """Structured Streaming catch-up (availableNow) over change files; equals the batch result."""
    root = scratch_path(spark, "stream")
    e = Tables(spark, sf_dir).events
    target = Y.VersionedTable(spark, f"{root}/events", PK)
    # initial full copy up to the watermark
    target.replace(_cols(Y.dedupe_changes(Y.incremental_extract(e, "ts", None, WATERMARK), PK, ORDER)))
    # the change feed lands as several files; the stream consumes one per trigger
    changes = Y.incremental_extract(e, "ts", WATERMARK, CEILING, LOOKBACK_S)
    changes.repartition(4).write.mode("overwrite").parquet(f"{root}/incoming")
    out = sync_stream(spark, f"{root}/incoming", changes.schema, target, ORDER, f"{root}/_checkpoint")
    return _cols(out)


def _specs(spark, sf_dir):
    """Three tracked tables, one of which cannot be read."""
    t = Tables(spark, sf_dir)
    return [Y.TableSpec("events", lambda: _cols(t.events), PK, "ts", ["event_id"]),
            Y.TableSpec("orders", lambda: t.orders.select("o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("timestamp_ntz").alias("o_at")),
                        ["o_orderkey"], "o_at", ["o_orderstatus"]),
            Y.TableSpec("missing", lambda: spark.read.parquet(f"{sf_dir}/no_such_table.parquet"), ["id"], "ts")]


_MANY_CEILING = "1998-01-01 00:00:00"


@register("sync_many_tables", sql=f"""
SELECT 'events' AS table_name, 'ok' AS status, count(DISTINCT (user_id, event_type)) AS n_rows FROM events WHERE ts < TIMESTAMP '{_MANY_CEILING}'
UNION ALL SELECT 'missing', 'failed', 0
UNION ALL SELECT 'orders', 'ok', count(DISTINCT o_orderkey) FROM orders WHERE CAST(o_orderdate AS TIMESTAMP) < TIMESTAMP '{_MANY_CEILING}'""")
def q_sync_many_tables(spark, sf_dir):
    """A run over three tables, one failing: the others are in, each with its status."""
    root = scratch_path(spark, "many")
    results = Y.run_sync(spark, _specs(spark, sf_dir), root, _MANY_CEILING, "run0001")
    parts = []
    for r in results:
        df = Y.VersionedTable(spark, f"{root}/{r['table']}").read() if r["status"] == "ok" else None
        n = df.agg(F.count(F.lit(1)).alias("n_rows")) if df is not None else spark.range(1).select(F.lit(0).cast("long").alias("n_rows"))
        parts.append(n.select(F.lit(r["table"]).alias("table_name"), F.lit(r["status"]).alias("status"), "n_rows"))
    return reduce(lambda a, b: a.unionByName(b), parts)


@register("run_log_replay", sql=f"""
SELECT run_id, 'sync' AS source, CASE run_id WHEN 'run0001' THEN 'partial' ELSE 'ok' END AS status,
       CASE run_id WHEN 'run0001' THEN 2 ELSE 1 END AS row_count, run_id = 'run0001' AS has_message,
       (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM events WHERE ts < TIMESTAMP '{CEILING}')) AS events_synced
FROM (VALUES ('run0001'), ('run0002')) v(run_id)""")
def q_run_log_replay(spark, sf_dir):
    """The run log after a partial run, an ok run and a replay of the latter: one row per run id."""
    root = scratch_path(spark, "runlog")
    log = Y.RunLog(spark, f"{root}/_runs")
    specs = _specs(spark, sf_dir)
    Y.run_sync(spark, specs, root, WATERMARK, "run0001", log)
    for _ in range(2):
        Y.run_sync(spark, specs[:1], root, CEILING, "run0002", log)
    n = Y.VersionedTable(spark, f"{root}/events").read().agg(F.count(F.lit(1)).alias("events_synced"))
    return log.read().select("run_id", "source", "status", "row_count", F.col("message").isNotNull().alias("has_message")) \
        .crossJoin(F.broadcast(n))  # one row


@register("snapshot_carry_over", sql="""
SELECT 'customer' AS table_name, count(*) AS n_rows, CAST(sum(c_custkey) AS BIGINT) AS key_sum FROM customer
UNION ALL SELECT 'part', count(*), CAST(sum(p_partkey) AS BIGINT) FROM part WHERE p_partkey % 2 = 0
UNION ALL SELECT 'derived', count(*), CAST(sum(p_partkey) AS BIGINT) FROM part""")
def q_snapshot_carry_over(spark, sf_dir):
    """Two full snapshots, each swapped in as one; the second keeps the table derived after the first."""
    t = Tables(spark, sf_dir)
    snap = Snapshot(spark, scratch_path(spark, "snap"))
    part = t.part.select("p_partkey", "p_name")
    snap.publish({"customer": t.customer.select("c_custkey"), "part": part, "derived": part.withColumn("n", F.length("p_name"))})
    snap.publish({"customer": t.customer.select("c_custkey"), "part": part.where("p_partkey % 2 = 0")}, carry=["derived"])
    keys = {"customer": "c_custkey", "part": "p_partkey", "derived": "p_partkey"}
    return reduce(lambda a, b: a.unionByName(b), [
        snap.read(n).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(k).alias("key_sum")).select(F.lit(n).alias("table_name"), "n_rows", "key_sum")
        for n, k in keys.items()])


# ---------------------------------------------------------------- document composition
# Labels and order of the parts of composed documents, what parts them, and the
# characters of a description that are taken.
PRODUCT_LABELS = ("Product: ", "Brand: ", "Category: ")
VARIANT_LABELS = ("Product: ", "Variant: ", "SKU: ")
CUSTOMER_LABELS = ("Customer: ", "Segment: ", "Nation: ")
PERSON_LABELS = ("Customer: ", "Email: ", "Phone: ")
PART_BREAK = ". "
DESCRIPTION_CHARS = 400


def labelled(label: str, value):
    """The value behind its label; null stays null."""
    return F.concat(F.lit(label), value)


def product_docs(spark, sf_dir):
    """(source_id, content, metadata): documents as products with their part spec."""
    t = Tables(spark, sf_dir)
    d = t.spread("documents").select("doc_id", "text")
    p = t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    j = d.join(p, d.doc_id == p.p_partkey, "left")
    short = T.first_line(F.col("text"))
    desc = F.col("text")
    # reference composition rule: the description is appended (its first 400 characters)
    # only when it is longer than the short text
    name, brand, category = PRODUCT_LABELS
    parts = [labelled(name, F.coalesce("p_name", F.lit(""))),
             F.when(F.col("p_brand") != "", labelled(brand, F.col("p_brand"))),
             F.when(F.col("p_type") != "", labelled(category, F.col("p_type"))),
             F.when(short != "", short),
             F.when(desc.isNotNull() & (F.length(desc) > F.length(F.coalesce(short, F.lit("")))),
                    F.substring(desc, 1, DESCRIPTION_CHARS))]
    parts = [F.when(x != "", x) for x in parts]
    meta = T.metadata_json({"brand": F.col("p_brand"), "price": F.col("p_retailprice").cast("string")})
    return j.select(F.lit("documents").alias("source_table"), F.col("doc_id").cast("string").alias("source_id"),
                    F.concat_ws(PART_BREAK, *parts).alias("content"), meta.alias("metadata"))


@register("compose_product_docs", sql="""
WITH j AS (SELECT d.doc_id, d.text, split_part(d.text, chr(10), 1) AS short, p.p_name, p.p_brand, p.p_type
           FROM documents d LEFT JOIN part p ON d.doc_id = p.p_partkey)
SELECT CAST(doc_id AS VARCHAR) AS source_id, concat_ws('. ',
  nullif('Product: ' || coalesce(p_name, ''), ''),
  nullif(CASE WHEN p_brand <> '' THEN 'Brand: ' || p_brand END, ''),
  nullif(CASE WHEN p_type <> '' THEN 'Category: ' || p_type END, ''),
  nullif(CASE WHEN short <> '' THEN short END, ''),
  nullif(CASE WHEN text IS NOT NULL AND length(text) > length(coalesce(short, '')) THEN substr(text, 1, 400) END, '')
) AS content FROM j""")
def q_compose_product_docs(spark, sf_dir):
    return product_docs(spark, sf_dir).select("source_id", "content")


@register("compose_variant_docs", sql="""
SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS source_id,
       concat_ws('. ', 'Product: ' || p.p_name, CASE WHEN p.p_type <> '' THEN 'Variant: ' || p.p_type END,
                 'SKU: ' || CAST(l.l_partkey AS VARCHAR) || '-' || CAST(l.l_suppkey AS VARCHAR)) AS content
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""")
def q_compose_variant_docs(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    p = t.part.select("p_partkey", "p_name", "p_type")
    j = li.join(p, li.l_partkey == p.p_partkey)
    name, variant, sku = VARIANT_LABELS
    content = F.concat_ws(PART_BREAK, labelled(name, F.col("p_name")), F.when(F.col("p_type") != "", labelled(variant, F.col("p_type"))),
                          labelled(sku, F.concat(F.col("l_partkey").cast("string"), F.lit("-"), F.col("l_suppkey").cast("string"))))
    sid = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    return j.select(sid.alias("source_id"), content.alias("content"))


@register("compose_customer_docs", sql=r"""
SELECT CAST(c.c_custkey AS VARCHAR) AS source_id,
       concat_ws('. ', 'Customer: ' || coalesce(nullif(c.c_name, ''), n.n_name), 'Segment: ' || c.c_mktsegment,
                 'Nation: ' || n.n_name) AS content
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE c.c_mktsegment NOT LIKE 'AUTO\_%' ESCAPE '\'""")
def q_compose_customer_docs(spark, sf_dir):
    t = Tables(spark, sf_dir)
    c = t.customer.where(~F.col("c_mktsegment").like("AUTO\\_%"))
    n = t.nation.select("n_nationkey", "n_name")
    j = J.enrich(c, n, c.c_nationkey == n.n_nationkey)
    name = F.coalesce(T.nullif_empty(F.col("c_name")), F.col("n_name"))
    customer, segment, nation = CUSTOMER_LABELS
    content = F.concat_ws(PART_BREAK, labelled(customer, name), labelled(segment, F.col("c_mktsegment")), labelled(nation, F.col("n_name")))
    return j.select(F.col("c_custkey").cast("string").alias("source_id"), content.alias("content"))


def customer_docs(spark, sf_dir):
    """(source_table, source_id, content, metadata) of customers."""
    c = q_compose_customer_docs(spark, sf_dir)
    return c.select(F.lit("customer").alias("source_table"), "source_id", "content",
                    T.metadata_json({"kind": F.lit("customer")}).alias("metadata"))


def _failing(model: Model, marker: str) -> Model:
    """The model, raising on texts that hold the marker (as a service rejects some inputs)."""
    def load():
        fn = model.load()

        def guarded(texts):
            if any(marker in t for t in texts):
                raise ValueError("rejected")
            return fn(texts)
        return guarded
    return Model(f"{model.name}-rejects-{marker}", model.version, load)


# texts with this word are rejected by the embedder of the refresh below
_REJECTED = "Segment: MACHINERY"
_DOCS_SQL = f"""
SELECT 'documents' AS source_table, source_id, content FROM ({ORACLES["compose_product_docs"]})
UNION ALL SELECT 'customer', source_id, content FROM ({ORACLES["compose_customer_docs"]})"""


def person_doc(first, last, email, phone):
    """Name of one or two parts, else the e-mail address; e-mail and phone where present."""
    name = F.coalesce(T.nullif_empty(F.concat_ws(" ", T.nullif_empty(first), T.nullif_empty(last))), email)
    parts = [F.concat(F.lit(label), T.nullif_empty(v)) for label, v in zip(PERSON_LABELS, (name, email, phone))]
    return F.concat_ws(PART_BREAK, *parts)


@register("compose_person_docs", sql="""
WITH p AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE split_part(c_name, '#', 1) END AS first,
       CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE split_part(c_name, '#', 2) END AS last,
       CASE WHEN c_custkey % 5 <> 0 THEN 'c' || CAST(c_custkey AS VARCHAR) || '@example.org' END AS email,
       CASE WHEN c_custkey % 7 = 0 THEN '' ELSE '+' || CAST(1000 + c_nationkey AS VARCHAR) END AS phone FROM customer),
n AS (SELECT *, coalesce(nullif(concat_ws(' ', nullif(first, ''), nullif(last, '')), ''), email) AS name FROM p)
SELECT CAST(c_custkey AS VARCHAR) AS source_id, concat_ws('. ', 'Customer: ' || nullif(name, ''), 'Email: ' || nullif(email, ''),
       'Phone: ' || nullif(phone, '')) AS content FROM n""")
def q_compose_person_docs(spark, sf_dir):
    """Person documents over customers whose name parts, address and phone are there or not."""
    key, part = F.col("c_custkey"), lambda i: F.split_part("c_name", F.lit("#"), F.lit(i))
    return Tables(spark, sf_dir).customer.select(key.cast("string").alias("source_id"), person_doc(
        F.when(key % 3 == 0, "").otherwise(part(1)), F.when(key % 2 != 0, part(2)),
        F.when(key % 5 != 0, F.concat(F.lit("c"), key.cast("string"), F.lit("@example.org"))),
        F.when(key % 7 == 0, "").otherwise(F.concat(F.lit("+"), (1000 + F.col("c_nationkey")).cast("string")))).alias("content"))


@register("embedding_refresh", sql=f"""
WITH docs AS ({_DOCS_SQL}),
fresh AS (SELECT *, CASE WHEN CAST(source_id AS BIGINT) % 3 = 0 THEN content || ' (new)' ELSE content END AS latest FROM docs)
SELECT source_table, source_id, CASE WHEN strpos(content, '{_REJECTED}') > 0 THEN 'failed' ELSE 'ok' END AS status,
       CASE WHEN strpos(content, '{_REJECTED}') > 0 THEN -1 ELSE length(latest) END AS content_chars,
       CASE WHEN strpos(content, '{_REJECTED}') > 0 THEN -1 ELSE 64 END AS dim,
       CASE WHEN strpos(content, '{_REJECTED}') > 0 THEN '' ELSE 'run1' END AS created_run,
       CASE WHEN CAST(source_id AS BIGINT) % 3 = 0 THEN 'run2' ELSE 'run1' END AS updated_run
FROM fresh""")
def q_embedding_refresh(spark, sf_dir):
    """Two refresh runs over two entities: all documents, then the changed ones. Content and vector
    follow the change, the creating run is kept, rejected documents are in an error table."""
    root = scratch_path(spark, "emb")
    key = ["source_table", "source_id"]
    target, errors = Y.VersionedTable(spark, f"{root}/embeddings", key), Y.VersionedTable(spark, f"{root}/errors", key)
    docs = product_docs(spark, sf_dir).unionByName(customer_docs(spark, sf_dir))
    changed = docs.where(F.col("source_id").cast("long") % 3 == 0).withColumn("content", F.concat("content", F.lit(" (new)")))
    model = _failing(hashing_embedder(64), _REJECTED)
    for run, rows in (("run1", docs), ("run2", changed)):
        made = cut_lineage(embed(rows, "content", model).withColumn("created_run", F.lit(run)).withColumn("updated_run", F.lit(run)))
        Y.upsert_versioned(target, made.where("error IS NULL").drop("error"), keep_from_target=["created_run"])
        Y.upsert_versioned(errors, made.where("error IS NOT NULL").select(*key, "error", "updated_run"))
    ok = target.read().select(*key, F.lit("ok").alias("status"), F.length("content").cast("long").alias("content_chars"),
                              F.size("embedding").cast("long").alias("dim"), "created_run", "updated_run")
    none = F.lit(-1).cast("long")
    return ok.unionByName(errors.read().select(*key, F.lit("failed").alias("status"), none.alias("content_chars"),
                                               none.alias("dim"), F.lit("").alias("created_run"), "updated_run"))


# ---------------------------------------------------------------- sinks and cache
def _text_results(docs, generator):
    return docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).select(F.lit(generator).alias("generator"), "n", "chars")


@register("results_replace_generator", sql="""
SELECT 'all' AS generator, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents
UNION ALL SELECT 'some', count(*), CAST(sum(length(text)) AS BIGINT) FROM documents WHERE doc_id % 5 = 0""")
def q_results_replace_generator(spark, sf_dir):
    """Results of two generators; those of one are written again and replace its rows only."""
    path = scratch_path(spark, "results")
    d = Tables(spark, sf_dir).documents
    K.replace_generator_results(_text_results(d, "all").unionByName(_text_results(d.where("doc_id % 2 = 0"), "some")), path)
    K.replace_generator_results(_text_results(d.where("doc_id % 5 = 0"), "some"), path)
    return spark.read.parquet(path).select("generator", "n", "chars")


@register("metrics_append_runs", sql="""
SELECT 'run1' AS run_id, event_type, count(*) AS n, round(avg(value), 6) AS mean_value FROM events GROUP BY event_type
UNION ALL SELECT 'run2', event_type, count(*), round(avg(value), 6) FROM events WHERE user_id % 2 = 0 GROUP BY event_type""")
def q_metrics_append_runs(spark, sf_dir):
    """Metrics of two runs in one table; the first run, written twice, is there once."""
    path = scratch_path(spark, "metrics")
    e = Tables(spark, sf_dir).events

    def metrics(df):
        return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("mean_value"))
    for run, df in (("run1", e.where("user_id % 3 = 0")), ("run2", e.where("user_id % 2 = 0")), ("run1", e)):
        K.append_run_metrics(metrics(df), path, run)
    return spark.read.parquet(path).select("run_id", "event_type", "n", "mean_value")


def _reversing_model() -> Model:
    """Turns a text round; rejects texts without a line feed."""
    def load():
        def fn(texts):
            if any("\n" not in t for t in texts):
                raise ValueError("one line only")
            return [t[::-1] for t in texts]
        return fn
    return Model("reversing", "1", load)


@register("prediction_cache", sql="""
SELECT doc_id AS id, CASE WHEN doc_id % 2 = 0 THEN 'run1' ELSE 'run2' END AS run_id, length(text) AS chars, '' AS error
FROM documents WHERE strpos(text, chr(10)) > 0
UNION ALL SELECT doc_id, 'run2', -1, 'one line only' FROM documents WHERE strpos(text, chr(10)) = 0""")
def q_prediction_cache(spark, sf_dir):
    """A run over half of the documents, then one over all: ids of the first are not computed again,
    failures are tried again and kept to the side."""
    cache = K.PredictionCache(spark, scratch_path(spark, "cache"), "reversing")
    d = Tables(spark, sf_dir).documents.select(F.col("doc_id").alias("id"), F.col("text").alias("input"))
    cache.predict(d.where("id % 2 = 0"), _reversing_model(), "run1")
    done = cache.predict(d, _reversing_model(), "run2")
    return done.select("id", "run_id", F.length("prediction").cast("long").alias("chars"), F.lit("").alias("error")).unionByName(
        cache.failed.read().select("id", "run_id", F.lit(-1).cast("long").alias("chars"), "error"))


# ---------------------------------------------------------------- vectors
@register("embedding_centroid_cosine", sql="""
WITH e AS (SELECT vec_id, label, embedding FROM embeddings),
x AS (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS v
      FROM (SELECT label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM e) GROUP BY label, i),
c AS (SELECT label, list(v ORDER BY i) AS centroid FROM x GROUP BY label)
SELECT e.vec_id, e.label, round(
  CASE WHEN sqrt(list_sum(list_transform(e.embedding, lambda a: CAST(a AS DOUBLE) * CAST(a AS DOUBLE))))
          * sqrt(list_sum(list_transform(c.centroid, lambda b: b * b))) > 0
       THEN list_sum(list_transform(range(1, len(e.embedding) + 1), lambda k: CAST(e.embedding[k] AS DOUBLE) * c.centroid[k]))
            / (sqrt(list_sum(list_transform(e.embedding, lambda a: CAST(a AS DOUBLE) * CAST(a AS DOUBLE))))
               * sqrt(list_sum(list_transform(c.centroid, lambda b: b * b))))
       ELSE 0.0 END, 6) AS cosine
FROM e JOIN c ON e.label = c.label""")
def q_embedding_centroid_cosine(spark, sf_dir):
    from tessera.operators.metrics import cosine
    e = Tables(spark, sf_dir).embeddings
    c = V.centroids(e, "label", "embedding")
    j = e.join(c, "label")
    vec = F.transform("embedding", lambda x: x.cast("double"))
    return j.select("vec_id", "label", F.round(cosine(vec, F.col("centroid")), 6).alias("cosine"))


@register("nearest_to_centroids", sql="""
WITH e AS (SELECT vec_id, label, embedding FROM embeddings),
x AS (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS v
      FROM (SELECT label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM e) GROUP BY label, i),
c AS (SELECT label, list(v ORDER BY i) AS centroid FROM x GROUP BY label),
s AS (SELECT c.label, e.vec_id,
        list_sum(list_transform(range(1, len(e.embedding) + 1), lambda k: CAST(e.embedding[k] AS DOUBLE) * c.centroid[k]))
        / (sqrt(list_sum(list_transform(e.embedding, lambda a: CAST(a AS DOUBLE) * CAST(a AS DOUBLE))))
           * sqrt(list_sum(list_transform(c.centroid, lambda b: b * b)))) AS score
      FROM c, e)
SELECT label, vec_id, round(score, 6) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""")
def q_nearest_to_centroids(spark, sf_dir):
    e = Tables(spark, sf_dir).embeddings
    c = V.centroids(e, "label", "embedding")
    nn = V.nearest(e, "vec_id", "embedding", c, "label", "centroid", 5)
    return nn.select("label", "vec_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


# ---------------------------------------------------------------- file round trips
@register("csv_roundtrip", sql="""
SELECT c_custkey, nullif(c_name, 'Customer#000000007') AS c_name, c_nationkey, c_acctbal,
       CASE WHEN c_custkey = 8 THEN '' ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def q_csv_roundtrip(spark, sf_dir):
    """CSV extract/load keeps NULL (unquoted empty) apart from '' (quoted empty)."""
    c = Tables(spark, sf_dir).customer
    c = c.withColumn("c_name", F.when(F.col("c_name") != "Customer#000000007", F.col("c_name"))) \
         .withColumn("c_mktsegment", F.when(F.col("c_custkey") == 8, F.lit("")).otherwise(F.col("c_mktsegment")))
    path = f"{checkpoint_root(spark)}/csv-{uuid.uuid4().hex[:10]}"
    FS.write_csv(c, path)
    return FS.read_csv(spark, path, c.schema)


def _roundtrip_sql():
    from tessera.plans import dataset_queries as DQ
    return DQ._EX_SQL + """
SELECT k.id, k.name, k.output, '' AS db_ai_description, coalesce(CAST(l.quality AS VARCHAR), '') AS quality
FROM kept k LEFT JOIN labels l ON k.id = CAST(l.doc_id AS VARCHAR)"""


@register("examples_jsonl_roundtrip", sql=_roundtrip_sql())
def q_examples_jsonl_roundtrip(spark, sf_dir):
    """Examples written as JSONL per split (explicit nulls) and read back with the fixed schema."""
    from tessera.operators.dataset import write_examples_jsonl
    from tessera.plans.dataset_queries import split_examples
    ex = split_examples(spark, sf_dir)
    path = f"{checkpoint_root(spark)}/jsonl-{uuid.uuid4().hex[:10]}"
    write_examples_jsonl(ex, path)
    back = FS.read_examples_jsonl(spark, path)
    return back.select("id", F.col("input.name").alias("name"), "output", F.coalesce("db_ai_description", F.lit("")).alias("db_ai_description"),
                       F.coalesce(F.col("extras")["quality"], F.lit("")).alias("quality"))


@register("read_lines", sql="""
SELECT p_name AS line, count(*) AS n FROM part GROUP BY p_name""")
def q_read_lines(spark, sf_dir):
    from tessera.sources.corpus import read_lines
    path = f"{checkpoint_root(spark)}/lines-{uuid.uuid4().hex[:10]}"
    Tables(spark, sf_dir).part.select("p_name").write.mode("overwrite").text(path)
    return read_lines(spark, path).groupBy("line").agg(F.count(F.lit(1)).alias("n"))
