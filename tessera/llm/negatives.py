"""Hard negatives by exact inner products in a residue number system.

Vectors become integers (``floor(scale * x)``). Inner products of a block of anchors with
a block of rows are matrix products modulo a few small primes: components are reduced to
residues around zero, so small that every sum of a product in float32 is an integer below
2**24 and thus exact. The signed scores are put together from the residues by Chinese
remaindering; as many primes are taken as the greatest possible score of the two blocks
(product of their greatest lengths) needs. Two passes over all rows follow, each with a
windowed selection: an anchor's best rows of its own label (its positives), then for every
positive its best rows of other labels whose score lies in a window below the positive's.

All rows are packed into blocks once and dealt to groups of about ``GROUP_BYTES``; every
anchor goes to every group, so what moves is the rows once and the anchors as often as
there are groups. A task holds one group and streams anchors past it; it sends at most the
wanted number of rows per anchor (and positive). Blocks, not keys, are dealt, so no label,
id or common vector makes a group large. Rows are numbered by the split and block they
come in, in a written table.

Defined results: rows with a null label, a null vector or a null or non-finite component
take no part; a null id comes last among ties and is no anchor. Vectors of different
lengths count as filled up with zeros. Every row is a row, also if it repeats another:
an anchor's copy is one of its positives, and an anchor row that occurs twice gives its
results twice. Scores are 64-bit: if two vectors could reach 2**55 that is an error, as
any overflow. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage

#: Rows of a packed block, at most.
BLOCK_ROWS = 2048
#: Bytes of packed components that one task holds.
GROUP_BYTES = 16 << 20
#: Anchors, and rows, whose scores are in memory at once.
ANCHORS, TILE = 128, 8192
#: Components of a vector that one float32 product covers.
SPAN = 256
EXACT = 1 << 24
NO_ID = (1 << 63) - 1
#: Scores stay below this, so that a score times the window's parts fits 64 bits.
LARGEST = 1 << 55


# --- arithmetic

def primes_below(limit: int) -> Iterator[int]:
    for n in range(limit - 1, 2, -1):
        if n % 2 and all(n % k for k in range(3, int(n ** 0.5) + 1, 2)):
            yield n


def moduli(width: int, bound: int) -> list[int]:
    """Odd primes whose products of residues around zero sum to less than 2**24 over ``width``
    components, enough of them to tell all scores of at most ``bound`` in size apart."""
    half = int(np.sqrt((EXACT - 1) / max(1, min(width, SPAN))))
    found, product = [], 1
    for p in primes_below(min(2 * half + 2, 1 << 12)):
        if product > 4 * bound + 2:
            break
        found.append(p)
        product *= p
    return found


def centred(x: np.ndarray, p: int) -> np.ndarray:
    """Residues modulo an odd ``p`` in ``-(p-1)/2 .. (p-1)/2``."""
    r = np.mod(x, p)
    return np.where(r > p // 2, r - p, r)


def residues(values: np.ndarray, p: int) -> np.ndarray:
    return centred(values, p).astype(np.float32)


def product_modulo(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """``a @ b.T`` modulo ``p``, exact: every float32 sum covers at most ``SPAN`` components."""
    total = None
    for s in range(0, a.shape[1], SPAN):
        part = (a[:, s:s + SPAN] @ b[:, s:s + SPAN].T).astype(np.int32)
        total = part if total is None else centred(total + part, p)
    return centred(total, p)


def remaindered(parts: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The signed numbers whose residues are ``parts``, digit by digit of a mixed radix around zero."""
    x, radix = parts[0].astype(np.int64), primes[0]
    for k in range(1, len(primes)):
        p = primes[k]
        digit = centred((parts[k] - centred(x, p)) * pow(radix, -1, p), p)
        x = x + digit * radix
        radix *= p
    return x


class Rows:
    """Packed integer vectors of one group, with their residues by prime."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.longest = float(np.square(values, dtype=np.float64).sum(1).max(initial=0)) ** 0.5
        self.cached: dict[int, np.ndarray] = {}

    def modulo(self, p: int) -> np.ndarray:
        if p not in self.cached:
            self.cached[p] = residues(self.values, p)
        return self.cached[p]


def scores(anchors: Rows, rows: Rows, tile: slice) -> np.ndarray:
    """Exact inner products of all anchors with the rows of a tile."""
    bound = int(anchors.longest * rows.longest * (1 + 1e-9)) + 1
    if bound >= LARGEST:
        raise OverflowError("inner products of these vectors may exceed 64 bits")
    primes = moduli(anchors.values.shape[1], bound)
    return remaindered([product_modulo(anchors.modulo(p), rows.modulo(p)[tile], p) for p in primes], primes)


# --- packing

def packed_blocks(batches: Iterator[pa.RecordBatch], scale: float, every: int) -> Iterator[pa.RecordBatch]:
    """Blocks of integer vectors; anchors also as rows of their own."""
    part, block = TaskContext.get().partitionId() << 40, 0
    schema = pa.schema({"block": pa.int64(), "anchor": pa.bool_(), "ids": pa.list_(pa.int64()), "labels": pa.list_(pa.int64()), "values": pa.binary(), "width": pa.int32()})
    for batch in batches:
        for s in range(0, batch.num_rows, BLOCK_ROWS):
            here = batch.slice(s, BLOCK_ROWS)
            vectors = here.column("vector")
            lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            width = max(int(lengths.max()), 1)
            owner = np.repeat(np.arange(len(lengths)), lengths)
            place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            values = np.zeros((len(lengths), width))
            values[owner, place] = np.floor(scale * flat)
            if np.abs(values).max(initial=0) >= 1 << 31:
                raise OverflowError("inner products of these vectors may exceed 64 bits")
            values = values.astype(np.int32)
            ids, labels = here.column("id"), here.column("label").to_numpy()
            known = ids.fill_null(NO_ID).to_numpy()
            number = part + block
            chosen = np.flatnonzero((known % every == 0) & ids.is_valid().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_pylist(
                [{"block": number, "anchor": False, "ids": ids.to_pylist(), "labels": labels.tolist(), "values": values.tobytes(), "width": width}]
                + [{"block": number + int(k), "anchor": True, "ids": [int(known[k])], "labels": [int(labels[k])],
                    "values": values[k].tobytes(), "width": width} for k in chosen], schema)
            block += BLOCK_ROWS


def group_of(rows: list[dict]) -> tuple[Rows, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a group by id (nulls last): vectors, ids, labels and row numbers."""
    width = max(r["width"] for r in rows)
    size = sum(len(r["ids"]) for r in rows)
    values = np.zeros((size, width), np.int64)
    ids, labels, numbers = np.empty(size, np.int64), np.empty(size, np.int64), np.empty(size, np.int64)
    at = 0
    for r in rows:
        n = len(r["ids"])
        values[at:at + n, :r["width"]] = np.frombuffer(r["values"], np.int32).reshape(n, r["width"])
        ids[at:at + n] = [NO_ID if x is None else x for x in r["ids"]]
        labels[at:at + n] = r["labels"]
        numbers[at:at + n] = r["block"] + np.arange(n)
        at += n
    order = np.lexsort((numbers, ids))
    return Rows(values[order]), ids[order], labels[order], numbers[order]


# --- selection

def best(anchor: np.ndarray, key: np.ndarray, score: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first ``k`` entries of every anchor and key, by score and place."""
    by = np.lexsort((place, -score, key, anchor))
    a, b = anchor[by], key[by]
    head = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(by) else np.empty(0, bool)
    starts = np.flatnonzero(head)
    rank = np.arange(len(by)) - np.repeat(starts, np.diff(starts, append=len(by)))
    return by[rank < k]


class Best:
    """The best entries so far, over tiles."""

    def __init__(self, k: int):
        self.k = k
        self.kept = [np.empty(0, np.int64)] * 4

    def add(self, *entry: np.ndarray) -> None:
        merged = [np.concatenate([a, b]) for a, b in zip(self.kept, entry)]
        chosen = best(*merged, self.k)
        self.kept = [x[chosen] for x in merged]


def at_least(score: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Entries of a tile that may be among the first ``k`` of their anchor."""
    if score.shape[1] <= k:
        return allowed
    low = np.where(allowed, score, np.iinfo(np.int64).min)
    least = np.partition(low, -k, axis=1)[:, -k]
    return allowed & (low >= least[:, None])


def select(batch: list[dict], rows: tuple, k: int, window: tuple[int, int] | None) -> Iterator[dict]:
    vectors, ids, labels, numbers = rows
    width = vectors.values.shape[1]
    values = np.zeros((len(batch), max(width, max(r["width"] for r in batch))), np.int64)
    for i, r in enumerate(batch):
        values[i, :r["width"]] = np.frombuffer(r["values"], np.int32)
    if values.shape[1] > width:
        vectors = Rows(np.pad(vectors.values, ((0, 0), (0, values.shape[1] - width))))
    anchors = Rows(values)
    label = np.array([r["labels"][0] for r in batch], np.int64)
    number = np.array([r["block"] for r in batch], np.int64)
    kept = Best(k)
    if window:
        positives = [[p["score"] for p in r["positives"]] for r in batch]
        most = max(map(len, positives))
        limit = np.full((len(batch), most), np.iinfo(np.int64).min)
        for i, p in enumerate(positives):
            limit[i, :len(p)] = p
        given = np.arange(most) < np.array([len(p) for p in positives])[:, None]
        floor = -(-limit * window[0] // window[1])  # least score in the window, as scores are whole
        floor = np.where(given, floor, np.iinfo(np.int64).max)
        lowest, highest = floor.min(1), np.where(given, limit, np.iinfo(np.int64).min).max(1)
    for s in range(0, len(ids), TILE):
        tile = slice(s, s + TILE)
        score = scores(anchors, vectors, tile)
        same = label[:, None] == labels[tile][None, :]
        if not window:
            a, c = np.nonzero(at_least(score, same & (number[:, None] != numbers[tile][None, :]), k))
            kept.add(a, np.zeros(len(a), np.int64), score[a, c], c + s)
            continue
        a, c = np.nonzero(~same & (score >= lowest[:, None]) & (score <= highest[:, None]))
        found = score[a, c]
        for j in range(most):
            fits = (found >= floor[a, j]) & (found <= limit[a, j])
            kept.add(a[fits], np.full(int(fits.sum()), j), found[fits], c[fits] + s)
    for i, j, value, place in zip(*(x.tolist() for x in kept.kept)):
        yield {"anchor": int(number[i]), "anchor_id": batch[i]["ids"][0], "of": j, "id": None if ids[place] == NO_ID else int(ids[place]),
               "score": value, "row": int(numbers[place])}


RESULT = "anchor long, anchor_id long, of int, id long, score long, row long"
RESULT_SCHEMA = pa.schema({"anchor": pa.int64(), "anchor_id": pa.int64(), "of": pa.int32(), "id": pa.int64(), "score": pa.int64(), "row": pa.int64()})


def meet(batches: Iterator[pa.RecordBatch], k: int, window: tuple[int, int] | None) -> Iterator[pa.RecordBatch]:
    """A group's blocks come first, then anchors, some at a time."""
    group: int | None = None
    blocks: list[dict] = []
    anchors: list[dict] = []
    rows = None

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal rows, blocks, anchors
        if anchors and (blocks or rows):
            if rows is None:
                rows, blocks = group_of(blocks), []
            found = list(select(anchors, rows, k, window))
            if found:
                yield pa.RecordBatch.from_pylist(found, RESULT_SCHEMA)
        anchors = []

    for batch in batches:
        for row in batch.to_pylist():
            if row["group"] != group:
                yield from flush()
                group, blocks, rows = row["group"], [], None
            if not row["anchor"]:
                blocks.append(row)
                continue
            anchors.append(row)
            if len(anchors) >= ANCHORS:
                yield from flush()
    yield from flush()


def against_all(blocks: DataFrame, anchors: DataFrame, groups: int, k: int, window: tuple[int, int] | None) -> DataFrame:
    """The ``k`` best rows of every anchor (and positive) in each group of rows."""
    dealt = (blocks.withColumn("positives", F.lit(None).cast("array<struct<score:long>>"))
             .withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int"))
             .unionByName(anchors.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))))
    return (dealt.repartition(groups, "group").sortWithinPartitions("group", "anchor").mapInArrow(lambda b: meet(b, k, window), RESULT))


def first_ranks(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, vec_id: str = "vec_id", vector: str | Column = "embedding", label: str | Column = "label", scale: float = 256.0,
         every: int = 100, positives: int = 5, negatives: int = 5, window: tuple[int, int] = (80, 100)) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for each anchor (id
    divisible by ``every``) and each of its first ``positives`` rows of the same label, the first ``negatives``
    rows of other labels whose score is at least ``window[0] / window[1]`` of the positive's and at most it."""
    def column(c):
        return F.col(c) if isinstance(c, str) else c
    vectors = column(vector).cast("array<double>")
    usable = F.coalesce(F.forall(vectors, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))
    chosen = rows.where(column(label).isNotNull() & usable).select(F.col(vec_id).cast("long").alias("id"), column(label).cast("long").alias("label"), vectors.alias("vector"))
    packed = cut_lineage(chosen.mapInArrow(lambda b: packed_blocks(b, scale, every),
                                           "block long, anchor boolean, ids array<long>, labels array<long>, values binary, width int"))
    blocks = packed.where("not anchor")
    size = blocks.agg(F.sum(F.octet_length("values").cast("long")), F.count(F.lit(1))).first()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    groups = max((size[0] or 0) // GROUP_BYTES + 1, min(2 * cores, size[1] or 1))
    anchors = packed.where("anchor")
    near = against_all(blocks, anchors.withColumn("positives", F.lit(None).cast("array<struct<score:long>>")), groups, positives, None)
    best_rows = cut_lineage(first_ranks(near, ["anchor"], positives))
    listed = best_rows.groupBy(F.col("anchor").alias("block")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda p: F.struct(p["score"].alias("score"))).alias("positives"))
    far = against_all(blocks, anchors.join(listed, "block"), groups, negatives, window)
    ranked = first_ranks(far, ["anchor", "of"], negatives)
    return (ranked.alias("n").join(best_rows.alias("p"), (F.col("n.anchor") == F.col("p.anchor")) & (F.col("n.of") + 1 == F.col("p.rank")))
            .select("n.anchor_id", F.col("p.id").alias("positive_id"), F.col("n.rank").cast("int").alias("rank"),
                    F.col("n.id").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("n.score").alias("negative_score")))
