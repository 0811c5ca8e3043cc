"""Prefix trie of conversations by union-find over sorted neighbours.

Conversations are sequences of turns, a turn being the digest of its role and text. They
are dealt and sorted by sequence and id, so conversations with a common prefix stand next
to each other, and the longest common prefix (LCP) of neighbours says at which depth they
part. Every sorted piece builds its forest alone: the edges between neighbours are taken in
descending depth, and a union-find joins the components on both sides of an edge; every such
merge makes a branching node (or joins one of the same depth). Components carry what their
nodes need as sums: members, smallest member, leaves, bytes. The nodes between two branching
nodes have the same members and are written out from the ends of their chain.

Pieces are then merged across their borders. Only nodes on the first and the last path
of a piece, down to the depth shared with the neighbouring piece, can go on there. The forest
is contracted to these open nodes, which are united by the digest of their path and their sums
added up; all others are final. The sums are made so that they add up: each piece knows how
much of its first path was there before and whether its last path goes on.

Texts never move: sizes and digests (128 bits) do. A common prefix or a large group of equal
conversations is cut into pieces like anything else, because the id is part of the sort key.
The digest of many ids is a stream over strings of ids, one per piece, in order. A
conversation is one row of 24 bytes a turn, as it is the unit that is sorted.

Defined results: turns of a conversation are ordered by turn, null first, ties by digest; null
role or text is empty; rows without a conversation id take no part; an empty table has no
nodes, not even a root. Repeated rows are turns like others. Only the four named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage

#: Sequences, and turns, of one forest.
PIECE_ROWS, PIECE_TURNS = 1 << 13, 1 << 20
DIGEST = 16
NO_ENDS = hashlib.sha256(b"").hexdigest()


# --- sequences

def turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv_id, turns``: each conversation's ordered turns as digest and size of the text."""
    role_, text_ = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    digest = F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role_).cast("string"), F.lit(":"), role_, text_), 256)), 1, DIGEST)
    rows = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.struct(F.col(turn).isNotNull().alias("given"), F.col(turn).alias("turn"), digest.alias("digest"),
                 F.octet_length(text_).cast("long").alias("size")).alias("t"))
    return rows.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("turns"))


def rebuilt(sequences: DataFrame, base: Column, shared: Column, most: int) -> DataFrame:
    """Sequences whose first ``shared`` turns are those of the conversation ``base`` (at most ``most``,
    all if it has fewer, none if there is no such conversation)."""
    heads = sequences.select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    own = sequences.withColumn("base", base).withColumn("shared", shared)
    empty = F.slice("turns", 1, 0)
    return own.join(heads, "base", "left").select(
        "conv_id", F.concat(F.coalesce(F.slice("head", F.lit(1), F.col("shared")), empty),
                            F.slice("turns", F.col("shared") + 1, F.greatest(F.size("turns") - F.col("shared"), F.lit(0)))).alias("turns"))


# --- one piece

def common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common prefix of two sequences of digests (two words each)."""
    n = min(len(a), len(b))
    different = np.flatnonzero((a[:n] != b[:n]).any(1))
    return int(different[0]) if len(different) else n


def path_digests(path: np.ndarray, depth: int) -> list[bytes]:
    """Digest of every prefix of a path through ``depth``, the empty one first."""
    h = hashlib.blake2b(digest_size=DIGEST)
    out = [h.digest()]
    for d in range(depth):
        h.update(path[d].tobytes())
        out.append(h.copy().digest())
    return out


class Forest:
    """Nodes over sorted distinct sequences; node ``i`` below ``n`` is the end of sequence ``i``."""

    def __init__(self, lengths: np.ndarray, lcp: np.ndarray, count: np.ndarray, least: np.ndarray, leaf: np.ndarray, total: np.ndarray, part_bytes: np.ndarray):
        """``lcp`` and ``part_bytes`` belong to the edges between neighbours: depth and bytes through it."""
        n = len(lengths)
        self.depth, self.members, self.least = lengths.tolist(), count.tolist(), least.tolist()
        self.leaves, self.weight = leaf.tolist(), ((count - 1) * total).tolist()
        self.children, self.parent = [0] * n, [-1] * n
        self.first, self.last = list(range(n)), list(range(n))
        root, node = list(range(n)), list(range(n))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        at, part = lcp.tolist(), part_bytes.tolist()
        for e in np.argsort(-lcp, kind="stable").tolist():  # deepest first, from left to right
            a, b = find(e), find(e + 1)
            u, v, d = node[a], node[b], at[e]
            if self.depth[u] != d:
                u = self.branch(u, d)
            self.parent[v] = u
            self.children[u] += 1
            self.members[u] += self.members[v]
            self.least[u] = min(self.least[u], self.least[v])
            self.leaves[u] += self.leaves[v]
            self.weight[u] += self.weight[v] + part[e]
            self.last[u] = self.last[v]
            root[b] = a
            node[a] = u

    def branch(self, child: int, depth: int) -> int:
        """A new node above ``child``."""
        new = len(self.depth)
        for values, x in ((self.depth, depth), (self.members, self.members[child]), (self.least, self.least[child]), (self.leaves, self.leaves[child]),
                          (self.weight, self.weight[child]), (self.children, 1), (self.parent, -1), (self.first, self.first[child]),
                          (self.last, self.last[child])):
            values.append(x)
        self.parent[child] = new
        return new


CLOSED, OPEN, ENDS = 0, 1, 2
PIECE_SQL = ("kind int, piece long, slot long, parent_slot long, path binary, parent_path binary, depth long, conv_id long, parent_conv_id long, n_convs long, "
             "n_children long, n_leaves long, saved long, ends string")
PIECE_SCHEMA = pa.schema({"kind": pa.int32(), "piece": pa.int64(), "slot": pa.int64(), "parent_slot": pa.int64(), "path": pa.binary(), "parent_path": pa.binary(),
                          "depth": pa.int64(), "conv_id": pa.int64(), "parent_conv_id": pa.int64(), "n_convs": pa.int64(), "n_children": pa.int64(),
                          "n_leaves": pa.int64(), "saved": pa.int64(), "ends": pa.string()})


def piece_nodes(number: int, ids: np.ndarray, paths: list[np.ndarray], sizes: list[np.ndarray], before: int, after: int) -> pa.RecordBatch:
    """All nodes of one sorted piece.

    ``before`` and ``after`` are the common prefixes of its first and last sequence with the
    sequences next to it, -1 where there is none. Open nodes have a ``slot``, twice the depth, plus
    one where they lie on the last path only.
    """
    heads = [0]
    edges = []
    for i in range(1, len(paths)):
        shared = common(paths[i - 1], paths[i])
        if shared < len(paths[i]) or shared < len(paths[i - 1]):
            heads.append(i)
            edges.append(shared)
    tails = [*heads[1:], len(paths)]
    path, size = [paths[i] for i in heads], [sizes[i] for i in heads]
    n = len(path)
    through = [np.concatenate([[0], np.cumsum(s)]) for s in size]  # bytes through each depth
    lengths = np.array([len(p) for p in path])
    lcp = np.array(edges, np.int64)
    next_lcp = np.append(lcp, after)
    count = np.array(tails) - np.array(heads)
    forest = Forest(lengths, lcp, count, ids[heads], (next_lcp < lengths).astype(np.int64), np.array([t[-1] for t in through]),
                    np.array([through[i][d] for i, d in enumerate(edges)], np.int64))
    depth, parent = np.array(forest.depth), np.array(forest.parent)
    members, least, leaves, weight = (np.array(x, np.int64) for x in (forest.members, forest.least, forest.leaves, forest.weight))
    first, last, children = np.array(forest.first), np.array(forest.last), np.array(forest.children, np.int64)
    low = np.where(parent >= 0, depth[parent] + 1, 0)
    node = np.repeat(np.arange(len(depth)), depth - low + 1)
    start = np.cumsum(depth - low + 1) - (depth - low + 1)
    d = np.arange(len(node)) - start[node] + low[node]
    bottom = d == depth[node]
    flat = np.concatenate(through)
    base = np.cumsum([0, *map(len, through)])[:-1]
    above = np.where(d > 0, flat[base[first[node]] + np.maximum(d - 1, 0)], 0)  # bytes through the depth above
    left, right = (first[node] == 0) & (d <= before), (last[node] == n - 1) & (d <= after)
    is_open = left | right
    saved = weight[node] - (members[node] - 1) * above
    came = np.where(left, flat[base[0] + np.minimum(max(before, 0), lengths[0])] - above, 0)  # the first path was there before
    saved = saved + came
    below = np.where(bottom, children[node], 1)
    # a child on the first path that was there before is counted there
    goes_on = left & (d < before) & (lengths[0] > d)
    below = below - goes_on
    top = d == low[node]
    up = np.where(top, parent[node], node)
    parent_conv = np.where(up >= 0, least[np.maximum(up, 0)], 0)
    slot = np.where(is_open, 2 * d + ~left, -1)
    parent_left = (first[np.maximum(up, 0)] == 0) & (d - 1 <= before)
    parent_open = (d > 0) & (parent_left | ((last[np.maximum(up, 0)] == n - 1) & (d - 1 <= after)))
    parent_slot = np.where(parent_open, 2 * (d - 1) + ~parent_left, -1)
    has_end = bottom & (node < n)
    ends: list[str | None] = [NO_ENDS] * len(node)
    rows_of_ends = []
    for k in np.flatnonzero(has_end).tolist():
        i = int(node[k])
        text = ",".join(map(str, ids[heads[i]:tails[i]].tolist()))
        if is_open[k]:
            rows_of_ends.append((k, text))
        else:
            ends[k] = hashlib.sha256(text.encode()).hexdigest()
    spine = [path_digests(path[0], max(before, 0)), path_digests(path[-1], max(after, 0))]
    digest: list[bytes | None] = [None] * len(node)
    above_digest: list[bytes | None] = [None] * len(node)
    for k in np.flatnonzero(is_open).tolist():
        side, x = (0 if left[k] else 1), int(d[k])
        digest[k] = spine[side][x]
        above_digest[k] = spine[side][x - 1] if x else None
        ends[k] = None
    kind = np.where(is_open, OPEN, CLOSED)
    more = [k for k, _ in rows_of_ends]
    order = [*range(len(node)), *more]

    def column(values, kind):
        return pa.array(np.concatenate([values, values[more]]) if isinstance(values, np.ndarray) else [values[k] for k in order], kind)
    parent_known = np.concatenate([(d > 0) & ~parent_open, np.zeros(len(more), bool)])
    parents = pa.array(np.concatenate([parent_conv, parent_conv[more]]), pa.int64(), mask=~parent_known)
    return pa.record_batch({
        "kind": pa.array(np.concatenate([kind, np.full(len(more), ENDS)]), pa.int32()), "piece": pa.array(np.full(len(order), number), pa.int64()),
        "slot": column(slot, pa.int64()), "parent_slot": column(parent_slot, pa.int64()), "path": column(digest, pa.binary()), "parent_path": column(above_digest, pa.binary()),
        "depth": column(d, pa.int64()), "conv_id": column(least[node], pa.int64()), "parent_conv_id": parents, "n_convs": column(members[node], pa.int64()),
        "n_children": column(below, pa.int64()), "n_leaves": column(leaves[node], pa.int64()), "saved": column(saved, pa.int64()),
        "ends": pa.array([*ends, *[t for _, t in rows_of_ends]], pa.string())}, schema=PIECE_SCHEMA)


def pieces(batches: Iterator[pa.RecordBatch], borders: dict[int, tuple[int, int]], piece_rows: int) -> Iterator[pa.RecordBatch]:
    """Forests of consecutive pieces of one sorted part."""
    ids: list[int] = []
    paths: list[np.ndarray] = []
    sizes: list[np.ndarray] = []
    part, number, held, before = None, 0, 0, -1
    for batch in batches:
        if not batch.num_rows:
            continue
        if part is None:
            part = batch.column("part")[0].as_py()
            before = borders[part][0]
        lists, size_lists = batch.column("path"), batch.column("sizes")
        flat = np.frombuffer(b"".join(lists.flatten().to_pylist()), np.uint64).reshape(-1, 2)
        flat_sizes = size_lists.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
        for k, (i, b) in enumerate(zip(batch.column("conv_id").to_pylist(), ends.tolist())):
            a = int(ends[k - 1]) if k else 0
            if len(ids) >= piece_rows or held >= PIECE_TURNS:
                shared = common(paths[-1], flat[a:b])
                yield piece_nodes((part << 32) + number, np.array(ids), paths, sizes, before, shared)
                ids, paths, sizes, held, before = [], [], [], 0, shared
                number += 1
            ids.append(i)
            paths.append(flat[a:b])
            sizes.append(flat_sizes[a:b])
            held += b - a
    if ids:
        yield piece_nodes((part << 32) + number, np.array(ids), paths, sizes, before, borders[part][1])


# --- across pieces

def part_borders(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """Common prefix of each part's first path with the part before and of its last with the part after (-1: none)."""
    parts = rows.groupBy("part").agg(F.min("path").alias("low"), F.max("path").alias("high"))
    order = Window.orderBy("part")

    def shared(a: Column, b: Column) -> Column:
        same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
        at = F.array_position(same, F.lit(False))
        return F.when(a.isNull() | b.isNull(), F.lit(-1)).when(at > 0, at - 1).otherwise(F.size(a))
    known = parts.select("part", shared(F.lag("high").over(order), F.col("low")).cast("int").alias("before"),
                         shared(F.col("high"), F.lead("low").over(order)).cast("int").alias("after"))
    return {r.part: (r.before, r.after) for r in known.collect()}


def streamed_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined strings of every path, which come in order."""
    path, h = None, None
    for batch in batches:
        done = []
        for p, text in zip(batch.column("path").to_pylist(), batch.column("ends").to_pylist()):
            if p != path:
                if h is not None:
                    done.append({"path": path, "ends_sha256": h.hexdigest()})
                path, h = p, hashlib.sha256(text.encode())
            else:
                h.update(b"," + text.encode())
        if done:
            yield pa.RecordBatch.from_pylist(done, pa.schema({"path": pa.binary(), "ends_sha256": pa.string()}))
    if h is not None:
        yield pa.RecordBatch.from_pylist([{"path": path, "ends_sha256": h.hexdigest()}], pa.schema({"path": pa.binary(), "ends_sha256": pa.string()}))


def trie(sequences: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Nodes of the trie of ``sequences`` (``conv_id, turns``): ``conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256``."""
    rows = sequences.select("conv_id", F.col("turns.digest").alias("path"), F.col("turns.size").alias("sizes"))
    dealt = rows.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id").withColumn("part", F.spark_partition_id().cast("long"))
    dealt = cut_lineage(dealt)
    borders = part_borders(dealt)
    made = cut_lineage(dealt.mapInArrow(lambda b: pieces(b, borders, piece_rows), PIECE_SQL))
    partial = made.where(F.col("kind") == OPEN)
    ends = (made.where(F.col("kind") == ENDS).select("path", "piece", "ends").repartition("path").sortWithinPartitions("path", "piece")
            .mapInArrow(streamed_digests, "path binary, ends_sha256 string"))
    united = partial.groupBy("path").agg(
        F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.min("parent_path").alias("parent_path"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    united = cut_lineage(united.join(ends, "path", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))))
    of_parents = united.select(F.col("path").alias("parent_path"), F.col("conv_id").alias("parent_conv_id"))
    values = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256"]
    open_nodes = united.join(of_parents, "parent_path", "left").select(*values)
    closed = made.where(F.col("kind") == CLOSED).withColumn("ends_sha256", F.col("ends"))
    inner = closed.where("parent_slot < 0").select(*values)
    # looked up by piece and depth, so that a common parent is no common key
    spines = partial.select("piece", F.col("slot").alias("parent_slot"), "path").join(united.select("path", F.col("conv_id").alias("found")), "path")
    outer = (closed.where("parent_slot >= 0").join(spines.select("piece", "parent_slot", "found"), ["piece", "parent_slot"])
             .withColumn("parent_conv_id", F.col("found")).select(*values))
    return open_nodes.unionByName(inner).unionByName(outer)


def conversation_trie(conversations: DataFrame, base: Column, shared: Column, most: int, conv_id: str = "conv_id", turn: str = "turn",
                      role: str = "role", text: str = "text", piece_rows: int = PIECE_ROWS) -> DataFrame:
    """The trie of conversations rebuilt by ``base`` and ``shared`` (expressions over ``conv_id``)."""
    return trie(rebuilt(cut_lineage(turns(conversations, conv_id, turn, role, text)), base, shared, most), piece_rows)
