"""Main text of web pages, with templates of a site removed.

Element subtrees are hashed page by page, counted per host in Spark, and deleted
where they recur across many pages of their host. Pages with equal article text
count once, so the copies of one article do not make it a template. What is left
is read from the article elements if they hold most of the text (else main, else
the whole page) without the elements that HTML, or common class names, mark as
menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles or
comments; a class never drops what holds the article (see ``page_tree.protect``).

The page is read twice by a row-wise reader, as hashes are a small part of it and
pages are never shuffled while the table of hits is small: it is written and read
back, so Spark knows its size and chooses a broadcast or a shuffle join by it.
Counting is a distinct and a count with partial sums; a host with a third of all
pages is spread by subtree hash.

Defined results: null or empty html gives an empty text; a null url is the host
of its own; broken markup is read as far as it goes; character references are
decoded once, white space inside a block becomes one blank, ``br`` is white
space; blocks are joined by one line feed. Rows that repeat id and html are
treated alike. Only the id, url and html columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.page_tree import Element, blocks, parse, subtree_hashes
from tessera.llm.rows import id_key
from tessera.session import scratch_path

#: Different articles of a host that a subtree must stand beside to be a template of the site, at any size of host.
MIN_PAGES = 5


def host_of(url: str):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def subtree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes, articles = [], []
        for page in batch.column("html").to_pylist():
            tree = parse(page or "")
            entered: list[Element] = []
            text = "\n".join(blocks(tree, entered=entered))
            found = subtree_hashes(tree)
            # only what is read otherwise can be deleted: menus and the like are out already
            hashes.append(sorted({found[e] for e in entered if e in found}))
            articles.append(int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True))
        yield pa.record_batch({"__id": batch.column("__id"), "__page": batch.column("__page"), "host": batch.column("host"),
                               "hashes": pa.array(hashes, pa.list_(pa.int64())), "article": pa.array(articles, pa.int64())})


def site_templates(subtrees: DataFrame, min_pages: int) -> DataFrame:
    """``host, hash`` of subtrees on many pages of a host, pages with equal articles counted once."""
    return (subtrees.select("host", "article", F.explode("hashes").alias("hash")).distinct()
            .groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages).select("host", "hash"))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html",
            min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per row of ``pages``: ``page_id, url, text, n_chars``."""
    spark = pages.sparkSession
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"),
                        id_key(page_id).alias("__id"), F.xxhash64(page).alias("__page"), host_of(url).alias("host"))
    kept = scratch_path(spark, "subtrees")
    (rows.select("__id", "__page", "host", "html")
     .mapInArrow(subtree_rows, "__id string, __page long, host string, hashes array<long>, article long").write.parquet(kept))
    subtrees = spark.read.parquet(kept)
    templates = site_templates(subtrees, min_pages)
    hits = (subtrees.select("__id", "__page", "host", F.explode("hashes").alias("hash")).join(templates, ["host", "hash"])
            .groupBy("__id", "__page", "host").agg(F.collect_set("hash").alias("templates")))
    written = scratch_path(spark, "templates")
    hits.select("__id", "__page", "host", "templates").write.parquet(written)
    joined = rows.join(spark.read.parquet(written), ["__id", "__page", "host"], "left").select("page_id", "url", "html", "templates")
    id_type = joined.schema["page_id"].dataType.simpleString()
    url_type = joined.schema["url"].dataType.simpleString()
    return joined.mapInArrow(main_texts, f"page_id {id_type}, url {url_type}, text string, n_chars long")


def main_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for page, templates in zip(batch.column("html").to_pylist(), batch.column("templates").to_pylist()):
            tree = parse(page or "")
            texts.append("\n".join(blocks(tree, frozenset(templates), subtree_hashes(tree)) if templates else blocks(tree)))
        yield pa.record_batch({"page_id": batch.column("page_id"), "url": batch.column("url"),
                               "text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64())})
