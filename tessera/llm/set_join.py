"""Exact Jaccard self-join on word n-grams by set relations.

Sets of equal members are one class; classes are joined through an inverted
index on the prefix of every set (its first ``n - ceil(0.8 n) + 1`` members in a
global order that puts frequent ones last), which any two linked sets share.

* Block skipping: an index list is sorted by set size and the position of the
  member in the set, and cut into blocks of one size class. Blocks whose sizes
  cannot match are never met, and an entry is skipped when its position leaves
  too few members for any other entry of its blocks.
* Answers from a similar set's answers: the first set of a block is its pivot.
  All sets that meet in blocks of one pivot gather there once, as what they lack
  of the pivot and what they add to it; the overlap of any two follows from these
  differences: ``|S & T| = |R| - |R-S| - |R-T| + |(R-S) & (R-T)| + |(S-R) & (T-R)|``.
  Pairs are never rows: a pivot's group returns a spanning forest of its links.
* Before sets travel, the groups meet with bitmaps of about two bits a member: a
  bit that one set has and the other lacks is a member that it lacks, which bounds
  the overlap from above. Sets that can reach no other of their group stay behind.

A group of many sets is split into blocks, and every pair of blocks is a task of
its own with a bound on its bytes. Members are 64-bit hashes of shingles; the
order of members comes from counts in a bounded sample of documents and is only
an order: it does not decide what is found.

Defined results: lower-casing touches A-Z only; words are runs of characters
other than ASCII white space; fewer words than a shingle are one shingle of all;
text without words, or null, has an empty set and links with nothing, so its
component is its own id; repeated rows belong to one class; a null id joins
classes but is a component id only where the component has no other. Only the id
and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.graph import connected_components
from tessera.llm.hashing import BASE, PolynomialHash, mix
from tessera.llm.rows import id_key, row_key, sorted_runs
from tessera.session import cut_lineage

SHINGLE = 5
PERCENT = 80
SAMPLE_DOCS = 20_000
HOT_COUNT = 5
HOT_MEMBERS = 1 << 19
GROUP_ROWS = 4096
#: Lists longer than this are not thinned by position; their groups are split by rows.
LONG_LIST = 4096
GROUP_MEMBERS = 1 << 21

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Odd multipliers that give each word of a shingle its place.
PLACES = [np.uint64(pow(BASE, 2 * j + 3, 1 << 64)) for j in range(64)]


def shingle_set(text: str | None, hasher: PolynomialHash, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text."""
    raw = np.frombuffer((text or "").encode().lower(), np.uint8)
    if not len(raw):
        return np.empty(0, np.uint64)
    blank = SPACES[raw]
    edge = np.diff(blank.astype(np.int8), prepend=1, append=1)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.empty(0, np.uint64)
    words = hasher.spans(hasher.prefix(raw), starts, ends)
    take = min(width, len(words))
    n = len(words) - take + 1
    sums = np.full(n, take, np.uint64)
    for j in range(take):
        sums += words[j:n + j] * PLACES[j]
    return np.unique(mix(sums))


def prefix_length(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1


def needed_overlap(a, b):
    """Smallest overlap that links sets of these sizes: 100 i >= PERCENT (a + b - i)."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def bitmap(s: np.ndarray) -> bytes:
    """A bit for every member, at its hash modulo a power of two of at least twice the size."""
    bits = np.zeros(max(64, 1 << (2 * len(s) - 1).bit_length()) if len(s) else 64, bool)
    bits[(s & np.uint64(len(bits) - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def folded(bits: bytes, size: int) -> np.ndarray:
    """The bitmap at a smaller power of two, in bytes."""
    b = np.frombuffer(bits, np.uint64)
    while 8 * len(b) > size:
        b = b[:len(b) // 2] | b[len(b) // 2:]
    return b


def hot_members(docs: DataFrame, text: str, sample_docs: int = SAMPLE_DOCS) -> tuple[np.ndarray, np.ndarray]:
    """Shingles frequent in a bounded sample of documents, sorted, and their counts."""
    total = docs.count()
    span = 1 << 30
    sample = docs.select(F.col(text).alias("text")).where(
        F.pmod(F.xxhash64("text", F.lit(7)), F.lit(span)) < int(min(1.0, sample_docs / max(total, 1)) * span))

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = PolynomialHash()
        for batch in batches:
            sets = [shingle_set(t, hasher) for t in batch.column(0).to_pylist()]
            found, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *sets]), return_counts=True)
            yield pa.record_batch({"m": pa.array(found.view(np.int64)), "n": pa.array(counts)})

    hot = (sample.mapInArrow(members, "m long, n long").groupBy("m").agg(F.sum("n").alias("n"))
           .where(F.col("n") >= HOT_COUNT).orderBy(F.desc("n"), "m").limit(HOT_MEMBERS).toPandas())
    keys = hot["m"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], hot["n"].to_numpy(np.int64)[order]


def signatures(spark: SparkSession, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Per row: class key and size of its set, and the prefix of the set as bytes."""
    hot = spark.sparkContext.broadcast(hot_members(docs, text))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = PolynomialHash()
        keys, counts = hot.value
        for batch in batches:
            classes, sizes, prefixes, bitmaps = [], [], [], []
            for t in batch.column("text").to_pylist():
                s = shingle_set(t, hasher)
                n = len(s)
                bitmaps.append(bitmap(s))
                total = int(mix(s).sum()) + n if n else 0
                classes.append(mix(np.array([total & (1 << 64) - 1], np.uint64)).view(np.int64)[0])
                sizes.append(n)
                if n < 4:  # too small to link with any set but an equal one
                    prefixes.append(b"")
                    continue
                rank = np.zeros(n, np.int64)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
                    rank = np.where(keys[at] == s, counts[at], 0)
                prefixes.append(s[np.lexsort((s, rank))[:prefix_length(n)]].tobytes())
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"),
                                   "class": pa.array(classes, pa.int64()), "n": pa.array(sizes, pa.int32()),
                                   "prefix": pa.array(prefixes, pa.binary()), "bits": pa.array(bitmaps, pa.binary())})

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(sign, f"doc_id {kind}, text_hash long, class long, n int, prefix binary, bits binary")


def index_entries(signed: DataFrame) -> DataFrame:
    """``member, class, n, pos``: one row per prefix member; a task sends a class once."""
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            members, classes, sizes, positions = [], [], [], []
            for c, n, prefix in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if not prefix or c in seen:
                    continue
                seen.add(c)
                m = np.frombuffer(prefix, np.int64)
                members.append(m)
                classes.append(np.full(len(m), c))
                sizes.append(np.full(len(m), n, np.int32))
                positions.append(np.arange(len(m), dtype=np.int32))
            if members:
                yield pa.record_batch({"member": np.concatenate(members), "class": np.concatenate(classes),
                                       "n": np.concatenate(sizes), "pos": np.concatenate(positions)})
    return signed.select("class", "n", "prefix").mapInArrow(entries, "member long, class long, n int, pos int")


def size_class(n: np.ndarray) -> np.ndarray:
    """Linked sets are in one size class or in neighbouring ones."""
    ratio = 100 / PERCENT
    edges = [1]
    while edges[-1] < 1 << 40:
        edges.append(max(edges[-1] + 1, int(edges[-1] * ratio) + 1))
    return np.searchsorted(np.array(edges), n, side="right")


def may_link(n: np.ndarray, pos: np.ndarray, i: int, others: slice) -> np.ndarray:
    """Whether entry ``i`` of a list can reach the needed overlap with the others, by size and position."""
    a, b, p, q = n[i], n[others], pos[i], pos[others]
    most = np.minimum(p, q) + 1 + np.minimum(a - p, b - q) - 1
    return most >= needed_overlap(a, b)


def meetings(entries: DataFrame) -> DataFrame:
    """``pivot, class, n``: every class with the pivots of the index blocks that it can match in."""
    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in list_parts(batches):
            member, cls, n, pos = (part.column(c).to_numpy() for c in ("member", "class", "n", "pos"))
            fresh = np.ones(len(member), bool)  # the same class from two tasks
            fresh[1:] = (member[1:] != member[:-1]) | (cls[1:] != cls[:-1])
            member, cls, n, pos = member[fresh], cls[fresh], n[fresh].astype(np.int64), pos[fresh].astype(np.int64)
            head = np.flatnonzero(np.concatenate([[True], member[1:] != member[:-1]]))
            count = np.diff(head, append=len(member))
            inside = np.repeat(count > 1, count)
            if not inside.any():
                continue
            live = inside.copy()
            block = size_class(n)
            pair = head[count == 2]  # most lists are one pair: test all at once
            ok = (np.minimum(pos[pair], pos[pair + 1]) + np.minimum(n[pair] - pos[pair], n[pair + 1] - pos[pair + 1])
                  >= needed_overlap(n[pair], n[pair + 1]))
            live[pair], live[pair + 1] = ok, ok
            for h, c in zip(head[count > 2].tolist(), count[count > 2].tolist()):
                if c > LONG_LIST:
                    continue
                for i in range(h, h + c):
                    # entries of neighbouring size classes stand side by side
                    lo = h + int(np.searchsorted(n[h:h + c], n[i] * PERCENT // 100))
                    hi = h + int(np.searchsorted(n[h:h + c], -(-n[i] * 100 // PERCENT), side="right"))
                    ok = may_link(n, pos, i, slice(lo, hi))
                    live[i] = int(ok.sum()) - int(ok[i - lo]) > 0
            at = np.flatnonzero(live)
            if not len(at):
                continue
            lid = np.repeat(np.arange(len(head)), count)[at]
            key = lid * 1024 + block[at]
            first = np.concatenate([[True], key[1:] != key[:-1]])
            pivot = cls[at[first]][np.cumsum(first) - 1]
            # a block also gathers the block of the next size class, where its sets' larger partners are
            order = {int(k): i for i, k in enumerate(key[first].tolist())}
            firsts = cls[at[first]]
            below = np.array([order.get(int(k) - 1, -1) for k in key[first].tolist()])[np.cumsum(first) - 1]
            visit = below >= 0
            yield pa.record_batch({"pivot": np.concatenate([pivot, firsts[below[visit]]]),
                                   "class": np.concatenate([cls[at], cls[at[visit]]]),
                                   "n": np.concatenate([n[at], n[at[visit]]])})

    dealt = entries.repartition("member").sortWithinPartitions("member", "n", "pos", "class")
    return dealt.mapInArrow(lists, "pivot long, class long, n long").dropDuplicates(["pivot", "class"])


def list_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows batch by batch, moving an unfinished list to the next part."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        member = batch.column("member").to_numpy()
        cut = int(np.searchsorted(member, member[-1]))
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def group_links(pivot: np.ndarray, sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links among ``sets``, from their differences to ``pivot``."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    lacks = np.zeros((n, -(-len(pivot) // 64) * 64), bool)
    added = []
    for i, s in enumerate(sets):
        at = np.minimum(np.searchsorted(s, pivot), len(s) - 1)
        lacks[i, :len(pivot)] = s[at] != pivot
        at = np.minimum(np.searchsorted(pivot, s), len(pivot) - 1)
        added.append(s[pivot[at] != s])
    bits = np.packbits(lacks, axis=1).view(np.uint64)
    short = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    # members added by more than one set, as an inverted index
    owner = np.repeat(np.arange(n), [len(x) for x in added])
    every, which, times = np.unique(np.concatenate(added), return_inverse=True, return_counts=True)
    shared = times[which] > 1
    which, owner = which[shared], owner[shared]
    by_member = np.argsort(which, kind="stable")
    posting = owner[by_member]
    ends = np.cumsum(np.bincount(which, minlength=len(every)))
    own = [[] for _ in range(n)]
    for m, i in zip(which.tolist(), owner.tolist()):
        own[i].append(m)
    root = np.arange(n)
    for i in range(n - 1):
        overlap = len(pivot) - short[i] - short[i + 1:] + np.bitwise_count(bits[i] & bits[i + 1:]).sum(axis=1, dtype=np.int64)
        if own[i]:
            meet = np.concatenate([posting[(ends[m - 1] if m else 0):ends[m]] for m in own[i]])
            overlap += np.bincount(meet, minlength=n)[i + 1:]
        union = size[i] + size[i + 1:] - overlap
        for j in np.flatnonzero((100 * overlap >= PERCENT * union) & (root[i + 1:] != root[i])).tolist():
            j += i + 1
            if root[j] != root[i]:
                root[root == root[j]] = root[i]
                yield i, j


def possible_partners(n: np.ndarray, bitmaps: list[bytes]) -> np.ndarray:
    """Which sets of a group may link with another one, by sizes and bitmaps."""
    size = min(map(len, bitmaps))
    bits = np.array([folded(b, size) for b in bitmaps])
    found = np.zeros(len(n), bool)
    for i in range(len(n) - 1):
        rest = bits[i + 1:]
        only_i = np.bitwise_count(bits[i] & ~rest).sum(axis=1, dtype=np.int64)
        only_j = np.bitwise_count(rest & ~bits[i]).sum(axis=1, dtype=np.int64)
        may = np.minimum(n[i] - only_i, n[i + 1:] - only_j) >= needed_overlap(n[i], n[i + 1:])
        found[i] |= may.any()
        found[i + 1:] |= may
    return found


def deal(met: DataFrame) -> DataFrame:
    """``pivot, i, j, class``: groups in pairs of blocks of bounded rows and members, the pivot in each."""
    groups = (met.groupBy("pivot").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("members"))
              .select("pivot", F.greatest(F.ceil(F.col("rows") / GROUP_ROWS), F.ceil(F.col("members") / GROUP_MEMBERS)).alias("blocks")))
    block = F.pmod(F.xxhash64("class"), F.col("blocks"))
    dealt = (met.join(groups, "pivot").withColumn("block", block)
             .select("pivot", "class", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("other"), "block")
             .select("pivot", "class", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")))
    pivots = (groups.select("pivot", F.col("pivot").alias("class"), F.explode(F.expr("sequence(0L, blocks - 1)")).alias("i"), "blocks")
              .select("pivot", "class", "i", F.explode(F.expr("sequence(i, blocks - 1)")).alias("j")))
    return dealt.unionByName(pivots).distinct()


def in_groups(dealt: DataFrame, payload: DataFrame, answer, schema: str) -> DataFrame:
    """Every dealt group with the payload of its classes, through ``answer``."""
    columns = [c for c in payload.columns if c != "class"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sorted_runs(batches, ["pivot", "i", "j"]):
            found = answer(rows)
            if found is not None:
                yield found

    return (dealt.join(payload, "class").select("pivot", "i", "j", "class", *columns)
            .repartition("pivot", "i", "j").sortWithinPartitions("pivot", "i", "j", "class").mapInArrow(run, schema))


def keep_possible(rows: pa.Table) -> pa.RecordBatch | None:
    may = possible_partners(rows.column("n").to_numpy().astype(np.int64), rows.column("bits").to_pylist())
    if not may.any():
        return None
    kept = rows.filter(pa.array(may)).combine_chunks()
    return pa.record_batch({c: kept.column(c).combine_chunks() for c in ("pivot", "class", "n")})


def forest(rows: pa.Table) -> pa.RecordBatch | None:
    found = dict(zip(rows.column("class").to_pylist(), rows.column("members").to_pylist()))  # repeated rows once
    names = sorted(found)
    pivot = np.frombuffer(found[rows.column("pivot")[0].as_py()], np.uint64)
    edges = list(group_links(pivot, [np.frombuffer(found[c], np.uint64) for c in names]))
    if not edges:
        return None
    return pa.record_batch({"a": pa.array([names[x] for x, _ in edges], pa.int64()),
                            "b": pa.array([names[y] for _, y in edges], pa.int64())})


def links(docs: DataFrame, classes: DataFrame, met: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``a, b``: links between classes that connect all that any links connect."""
    near = cut_lineage(in_groups(deal(met), classes.select("class", "n", "bits"), keep_possible, "pivot long, class long, n int")
                       .dropDuplicates(["pivot", "class"]))
    # one document stands for each class that may link with another
    involved = near.select("class").union(near.select(F.col("pivot").alias("class"))).distinct()
    stand_in = (classes.join(involved, "class")
                .select("class", id_key("least.doc_id").alias("__id"), F.col("least.text_hash").alias("__text")))
    texts = docs.select(*row_key(doc_id, text), F.col(text).alias("text")).join(stand_in, ["__id", "__text"])

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = PolynomialHash()
        for batch in batches:
            sets = [shingle_set(t, hasher).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.record_batch({"class": batch.column("class"), "members": pa.array(sets, pa.binary())})

    sets = texts.select("class", "text").mapInArrow(to_sets, "class long, members binary")
    return in_groups(deal(near), sets, forest, "a long, b long")


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id``; also ``stays``, true
    for one class member per component, and ``text_hash``, which tells apart rows that share an id."""
    spark = docs.sparkSession
    signed = cut_lineage(signatures(spark, docs, doc_id, text))
    # smallest id first by class, then by component; null ids come last
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("least")
    classes = cut_lineage(signed.where("n > 0").groupBy("class").agg(least, F.first("n").alias("n"), F.first("bits").alias("bits")))
    met = cut_lineage(meetings(index_entries(signed)))
    found = connected_components(links(docs, classes, met, doc_id, text))
    of_class = (classes.select("class", "least").join(found.withColumnRenamed("node", "class"), "class", "left")
                .withColumn("component", F.coalesce("component", "class")))
    firsts = of_class.groupBy("component").agg(F.min("least").alias("first"))
    named = of_class.join(firsts, "component").select("class", "first")
    rows = signed.select("doc_id", "text_hash", "n", "class")
    linked = rows.where("n > 0").join(named, "class")
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    alone = rows.where("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"),
                                       F.col("doc_id").alias("component_id"), F.lit(True).alias("stays"), "text_hash")
    return linked.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("first.doc_id").alias("component_id"),
                         stays.alias("stays"), "text_hash").unionByName(alone)
