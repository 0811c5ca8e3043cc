"""Exact dedup by content-defined chunk recipes.

Each normalised text is cut where a rolling hash of its last bytes meets a
condition, so equal content is cut alike wherever it stands. A chunk is known by
a 64-bit fingerprint and its length; a fingerprint is a verified identifier when
every chunk that bears it has the same SHA-256, and otherwise the SHA-256 takes
its place. Two texts are equal exactly when their ordered lists of identifiers
are equal, so only recipes are shuffled; texts never leave the scan.

Every group is reduced by partial aggregation (one row per task and recipe) and
the answer joins back on the recipe; AQE splits a hot recipe's rows, as each
matches one row.

Defined results: null text counts as empty, all empty texts are one group; of
equal texts the one with the most code points in its original text stays, then
the smallest id, null ids last; rows that repeat both id and text are separate
members of their group and one of them stays. Only the id and text columns are
read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.hashing import PolynomialHash
from tessera.session import cut_lineage

WHITE_SPACE = bytes([0x20, *range(0x09, 0x0E)])
MIN_CHUNK, MEAN_CHUNK, MAX_CHUNK = 1024, 4096, 16384
WINDOW = 32

RECIPE = "struct<n_points:int,sha256:binary,chunks:array<struct<fp:long,size:int,sha256:binary>>>"


def chunk_ends(data: bytes, hasher: PolynomialHash) -> list[int]:
    """Ends of the chunks of ``data``: content-defined, between the size bounds.

    A cut needs no look beyond the last ``WINDOW`` bytes; blocks of 1 MB keep
    the memory flat for a text of any length.
    """
    n = len(data)
    if n <= MIN_CHUNK:
        return [n] if n else []
    raw = np.frombuffer(data, np.uint8)
    block = 1 << 20
    found = []
    for start in range(0, n, block):
        part = raw[max(0, start - WINDOW + 1):start + block]
        if len(part) >= WINDOW:
            h = hasher.windows(part, WINDOW)
            found.append(np.flatnonzero(h % np.uint64(MEAN_CHUNK - MIN_CHUNK) == 0) + max(0, start - WINDOW + 1) + WINDOW)
    candidates = np.concatenate(found) if found else np.empty(0, np.int64)
    ends, last = [], 0
    while n - last > MIN_CHUNK:
        k = int(np.searchsorted(candidates, last + MIN_CHUNK))
        end = int(candidates[k]) if k < len(candidates) else n
        last = min(end, last + MAX_CHUNK, n)
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


def recipe(text: Column) -> Column:
    """Code points of the original, SHA-256 of the normalised text, and its chunks."""
    @F.arrow_udf(RECIPE)
    def recipes(texts: pa.Array) -> pa.Array:
        hasher = PolynomialHash()
        points, shas, fps, sizes, chunk_shas, offsets = [], [], [], [], [], [0]
        for t in texts.to_pylist():
            t = t or ""
            data = t.encode().translate(None, WHITE_SPACE)
            points.append(len(t))
            shas.append(hashlib.sha256(data).digest())
            start = 0
            for end in chunk_ends(data, hasher):
                digest = hashlib.sha256(data[start:end]).digest() if end - start < len(data) else shas[-1]
                fps.append(int.from_bytes(hashlib.blake2b(data[start:end], digest_size=8).digest(), "big", signed=True))
                sizes.append(end - start)
                chunk_shas.append(digest)
                start = end
            offsets.append(len(fps))
        chunks = pa.StructArray.from_arrays(
            [pa.array(fps, pa.int64()), pa.array(sizes, pa.int32()), pa.array(chunk_shas, pa.binary())],
            ["fp", "size", "sha256"])
        return pa.StructArray.from_arrays(
            [pa.array(points, pa.int32()), pa.array(shas, pa.binary()),
             pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), chunks)], ["n_points", "sha256", "chunks"])
    return recipes(text)


def recipes_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    return (docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), recipe(F.col(text)).alias("r"))
            .select("doc_id", "text_hash", "r.n_points", "r.sha256", "r.chunks"))


def chunk_dictionary(recipes: DataFrame) -> DataFrame:
    """One row per fingerprint and length: how many chunks bear it, and whether
    their SHA-256 all agree (``verified``)."""
    return (recipes.select(F.explode("chunks").alias("c")).groupBy("c.fp", "c.size")
            .agg(F.count(F.lit(1)).alias("n"), (F.min("c.sha256") == F.max("c.sha256")).alias("verified")))


def with_identifiers(recipes: DataFrame) -> DataFrame:
    """Add ``ids``: the ordered list of verified chunk identifiers.

    Fingerprints that two different chunks share are not verified; the texts
    that hold one are listed by SHA-256 throughout. They form a table of their
    own, keyed by text digest, that is normally empty and is joined, not collected.
    """
    bad = chunk_dictionary(recipes).where("not verified").select("fp", "size")
    plain = F.transform("chunks", lambda c: F.struct(c["fp"].alias("fp"), c["size"].alias("size"), F.expr("X''").alias("sha256")))
    if bad.isEmpty():
        return recipes.withColumn("ids", plain)
    marked = (recipes.select("sha256", F.explode("chunks").alias("c")).select("sha256", "c.fp", "c.size")
              .join(bad, ["fp", "size"]).select("sha256").distinct().withColumn("unverified", F.lit(True)))
    return (recipes.join(marked, "sha256", "left")
            .withColumn("ids", F.when(F.col("unverified"), F.col("chunks")).otherwise(plain)).drop("unverified"))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``
    and ``text_hash``, which tells apart rows that share an id."""
    # recipes are some per cent of the texts; written once, as three later reads would chunk the texts again
    members = with_identifiers(cut_lineage(recipes_of(docs, doc_id, text)))
    # rows that repeat id and text collapse first, so that exactly one of them can stay
    members = members.groupBy("ids", "doc_id", "text_hash", "n_points", "sha256").agg(F.count(F.lit(1)).alias("copies"))
    order = F.struct(-F.col("n_points"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_hash"))
    groups = members.groupBy("ids").agg(F.min(order).alias("first"), F.sum("copies").alias("group_size"))
    return (members.alias("m").join(groups.alias("g"), F.col("m.ids") == F.col("g.ids"))
            .select("doc_id", "text_hash", F.col("first.doc_id").alias("keep_id"), "group_size",
                    (order == F.col("first")).alias("stays"), F.hex("sha256").alias("hex"), "copies")
            .select("doc_id", "keep_id", "group_size", F.explode(F.expr("sequence(1L, copies)")).alias("copy"),
                    "stays", F.lower("hex").alias("text_sha256"), "text_hash")
            .select("doc_id", "keep_id", "group_size", (F.col("stays") & (F.col("copy") == 1)).alias("kept"), "text_sha256", "text_hash"))
