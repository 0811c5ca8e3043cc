"""Removal of passages of at least 20 words that also stand earlier.

Fixed-block anchors, in two exchanges of packed hashes:

1. Every document is cut into blocks of ten words, at words 0, 10, 20 and so on: the
   reference blocks. As twice ten less one is below twenty, every window of twenty words
   holds a whole block of its own document, so a window that repeats elsewhere is met
   there by a rolling window of ten words. Every rolling window is a probe. Probes are
   dealt by hash; a probe whose hash stands more than once is shared, and it is a hit if
   one of those places is a block.
2. Hits are extended: shared probes in a row are a run; a run with a hit and at least
   eleven probes (twenty words) may hold repeats. Each window of twenty words in a run is
   dealt by the 128-bit hash of all its words; of equal ones all but the first, by
   document and start, are repeats. Runs of repeats are the maximal exact repeats.

A task first merges its own: of equal hashes among its texts one is sent, so that a passage
in a third of all documents sends one entry per batch of texts. Entries travel packed, a
batch of texts and a range of hashes to a row, and are met range by range; the number of
ranges follows from the bytes of all texts, so a range has about ``RANGE`` entries at any size.
Texts are joined twice to what was found in them, behind a bitmap that lets texts
without finds pass by. Batches are numbered by the splits of the scan and their order in it;
numbers are only used within the one pass that gives them.

Defined results: words are what ASCII white space parts, unchanged; null text has none;
texts below 20 words are never touched and are no sources; null ids come last in order;
rows that repeat id and text are one document and both give its result; rows that share an
id but not the text are ordered by a 64-bit hash of the text, which also tells them apart.
Windows are equal if two 64-bit hashes of their words are. Only the id and text columns are
read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.hashing import PolynomialHash, mix
from tessera.llm.rows import id_key, split_by_bitmap
from tessera.llm.words import rolling, word_bounds, word_hashes
from tessera.session import cut_lineage

WINDOW = 20
BLOCK = 10
#: Words whose probes are merged and sent together.
SLICE_BITS = 20
SLICE = 1 << SLICE_BITS
#: Entries that meet in one range of hashes, about.
RANGE = 1 << 21
#: Windows that are merged and sent together.
WINDOWS = 1 << 18

SETTLED, DIRECTORY, ENTRIES = 0, 1, 2


def pack(ascending: np.ndarray) -> bytes:
    """Differences of ascending numbers, byte plane by byte plane: the upper planes compress to nothing."""
    return np.diff(ascending, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.int64)


def range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Range of each hash, by its upper 32 bits."""
    return ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def by_range(ranges: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Positions of every range that occurs, in their given order."""
    small = ranges.astype(np.uint16) if len(ranges) and ranges.max() < 1 << 16 else ranges
    order = np.argsort(small, kind="stable")
    heads = np.flatnonzero(np.diff(ranges[order], prepend=-1))
    for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(order)]):
        yield int(ranges[order[a]]), order[a:b]


def record(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


# --- exchange 1: blocks and probes

def probes(batches: Iterator[pa.RecordBatch], ranges: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Rolling windows of ten words of every text, packed by range; blocks are marked."""
    hasher = PolynomialHash()
    schema = pa.schema({"range": pa.int32(), "parcel": pa.int64(), "kind": pa.int32(), "places": pa.binary(), "hashes": pa.binary(),
                        "ids": pa.list_(id_type), "texts": pa.list_(pa.int64()), "bounds": pa.binary()})
    parcel = TaskContext.get().partitionId() << 32
    for batch in batches:
        words, counts = word_hashes(batch.column("text").to_pylist(), hasher)
        ends = np.cumsum(counts)
        starts = ends - counts
        for s in range(0, len(words), SLICE):
            here = words[s:s + SLICE + BLOCK - 1]
            docs = np.arange(np.searchsorted(ends, s, side="right"), np.searchsorted(starts, s + SLICE, side="left"))
            begin, end = np.maximum(starts[docs], s) - s, np.minimum(ends[docs], s + SLICE) - s
            grams = rolling(here, BLOCK, hasher)[:SLICE]
            if not len(grams):
                continue
            inside = np.ones(len(grams), bool)
            close = ((ends[docs] - s)[:, None] - np.arange(1, BLOCK)).ravel()
            inside[close[(close >= 0) & (close < len(grams))]] = False
            position = np.arange(len(grams)) - np.repeat(starts[docs] - s, end - begin)[:len(grams)]
            block = position % BLOCK == 0
            rows = [{"kind": DIRECTORY, "range": parcel % ranges, "ids": batch.column("doc_id").take(pa.array(docs)).to_pylist(),
                     "texts": batch.column("text_hash").take(pa.array(docs)).to_pylist(),
                     "bounds": np.stack([begin, end, s + begin - starts[docs]]).astype("<i8").tobytes()}]
            at = np.flatnonzero(inside)
            key = np.sort(grams[at] >> np.uint64(SLICE_BITS) << np.uint64(SLICE_BITS) | at.astype(np.uint64))
            if len(key):
                at = (key & np.uint64(SLICE - 1)).astype(np.int64)
                head = np.diff(key >> np.uint64(SLICE_BITS), prepend=~(key[:1] >> np.uint64(SLICE_BITS))) != 0
                heads = np.flatnonzero(head)
                code = at[heads] << 2 | np.maximum.reduceat(block[at], heads).astype(np.int64) << 1 | (np.diff(heads, append=len(at)) > 1)
                later = np.sort(at[~head])
                if len(later):
                    rows.append({"kind": SETTLED, "range": parcel % ranges, "places": pack(later << 1 | 1)})
                code = np.sort(code)
                sent = grams[code >> 2]
                for r, which in by_range(range_of(sent, ranges)):
                    rows.append({"kind": ENTRIES, "range": r, "places": pack(code[which]),
                                 "hashes": (sent[which] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()})
            yield record([{"parcel": parcel, **r} for r in rows], schema)
            parcel += 1


def of_one(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[dict]]:
    """Rows of one key after the other, across batches; rows come sorted by it."""
    held: list[dict] = []
    for batch in batches:
        for k in range(batch.num_rows):
            row = {name: batch.column(name)[k] for name in batch.schema.names}
            row[key] = row[key].as_py()
            if held and held[0][key] != row[key]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def shared_probes(batches: Iterator[pa.RecordBatch], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Of each range: the probes that stand more than once, and whether a block is among them."""
    schema = pa.schema({"parcel": pa.int64(), "kind": pa.int32(), "places": pa.binary(), "ids": pa.list_(id_type),
                        "texts": pa.list_(pa.int64()), "bounds": pa.binary()})
    for rows in of_one(batches, "range"):
        entries = [r for r in rows if r["kind"].as_py() == ENTRIES]
        others = [r for r in rows if r["kind"].as_py() != ENTRIES]
        if others:
            yield pa.record_batch({n: pa.array([r[n].as_py() for r in others], schema.field(n).type) for n in schema.names}, schema=schema)
        if not entries:
            continue
        codes = [unpack(r["places"].as_py()) for r in entries]
        hashes = np.concatenate([np.frombuffer(r["hashes"].as_py(), "<u4") for r in entries]).astype(np.uint64)
        code = np.concatenate(codes)
        key = np.sort(hashes << np.uint64(32) | np.arange(len(hashes), dtype=np.uint64))
        at = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
        heads = np.flatnonzero(np.concatenate([[True], key[1:] >> np.uint64(32) != key[:-1] >> np.uint64(32)]))
        count = np.diff(heads, append=len(at))
        flags = np.bitwise_or.reduceat(code[at] & 3, heads)
        state = np.where((count > 1) | (flags & 1 == 1), 1 + (flags >> 1), 0)  # 0 alone, 1 shared, 2 shared with a block
        found = np.empty(len(at), np.int8)
        found[at] = np.repeat(state, count)
        out, a = [], 0
        for r, c in zip(entries, codes):
            mine = found[a:a + len(c)]
            a += len(c)
            if mine.any():
                out.append({"parcel": r["parcel"].as_py(), "kind": SETTLED, "places": pack((c >> 2 << 1 | (mine == 2))[mine > 0])})
        if out:
            yield record(out, schema)


def runs(batches: Iterator[pa.RecordBatch], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Runs of shared probes of each document, as ``start, end, hit``; those that are too short
    or without a hit go, unless they touch the border of a slice."""
    schema = pa.schema({"doc_id": id_type, "text_hash": pa.int64(), "runs": pa.binary(), "n": pa.int64()})
    for rows in of_one(batches, "parcel"):
        directory = next(r for r in rows if r["kind"].as_py() == DIRECTORY)
        begin, end, offset = np.frombuffer(directory["bounds"].as_py(), "<i8").reshape(3, -1)
        state = np.zeros(int(end[-1]) + 1 if len(end) else 1, np.int8)
        for r in rows:
            if r["kind"].as_py() == SETTLED:
                code = unpack(r["places"].as_py())
                state[code >> 1] = 1 + (code & 1)
        ids, texts = directory["ids"].values, directory["texts"].values
        shared = state > 0
        shared[-1] = False
        change = np.diff(shared.astype(np.int8), prepend=0)
        first = np.flatnonzero(change == 1)  # no run crosses documents: the last nine words of one begin no probe
        if not len(first):
            continue
        last = np.searchsorted(np.flatnonzero(~shared), first)
        last = np.flatnonzero(~shared)[last]
        doc = np.searchsorted(end, first, side="right")
        hits = np.concatenate([[0], np.cumsum(state == 2)])
        hit = hits[last] > hits[first]
        edge = (last >= end[doc]) | ((first == begin[doc]) & (offset[doc] > 0))
        keep = edge | (hit & (last - first >= WINDOW - BLOCK + 1))
        first, last, doc, hit = first[keep], np.minimum(last, end[doc])[keep], doc[keep], hit[keep]
        if not len(first):
            continue
        shift = offset[doc] - begin[doc]
        triples = np.stack([first + shift, last + shift, hit], 1).astype("<i8")
        heads = np.flatnonzero(np.diff(doc, prepend=-1))
        tails = [*heads[1:].tolist(), len(doc)]
        which = pa.array(doc[heads])
        n = np.add.reduceat(np.maximum(last - first - (WINDOW - BLOCK), 0), heads)
        yield pa.record_batch({"doc_id": ids.take(which), "text_hash": texts.take(which),
                               "runs": pa.array([triples[a:b].tobytes() for a, b in zip(heads.tolist(), tails)], pa.binary()),
                               "n": pa.array(n)}, schema=schema)


# --- exchange 2: windows in runs

def window_starts(packed: list[bytes], n_words: int) -> np.ndarray:
    """Starts of the windows whose probes are all shared, in runs with a hit."""
    run = np.concatenate([np.frombuffer(b, "<i8").reshape(-1, 3) for b in packed])
    run = run[np.argsort(run[:, 0], kind="stable")]
    reach = np.maximum.accumulate(run[:, 1])
    head = np.concatenate([[True], run[1:, 0] > reach[:-1]])
    heads = np.flatnonzero(head)
    start, end = run[heads, 0], np.maximum.reduceat(run[:, 1], heads)
    hit = np.maximum.reduceat(run[:, 2], heads) > 0
    end = np.minimum(end - (WINDOW - BLOCK), n_words - WINDOW + 1)
    long = hit & (end > start)
    start, size = start[long], (end - start)[long]
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def order_of(ids: pa.Array) -> np.ndarray:
    """Numbers that sort as the ids do, equal for equal ids, nulls last."""
    if pa.types.is_integer(ids.type):
        values = ids.cast(pa.int64())
        known = np.unique(values.drop_null().to_numpy(zero_copy_only=False))
        rank = np.searchsorted(known, values.fill_null(0).to_numpy(zero_copy_only=False))
        return np.where(values.is_null().to_numpy(zero_copy_only=False), len(known), rank)
    names = ids.to_pylist()
    rank = {x: i for i, x in enumerate(sorted({x for x in names if x is not None}))}
    return np.array([rank.get(x, len(rank)) for x in names], np.int64)


def first_of_equal(high, low, order, text, place) -> tuple[np.ndarray, np.ndarray]:
    """Which entries are the first of their window, and which stand later than it."""
    by = np.lexsort((place, text, order, low, high))
    head = np.concatenate([[True], (high[by][1:] != high[by][:-1]) | (low[by][1:] != low[by][:-1])])
    first = by[np.flatnonzero(head)[np.cumsum(head) - 1]]
    later = np.zeros(len(by), bool)
    later[by] = (order[by] != order[first]) | (text[by] != text[first]) | (place[by] != place[first])
    firsts = np.zeros(len(by), bool)
    firsts[by[head]] = True
    return firsts, later


def windows(batches: Iterator[pa.RecordBatch], ranges: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Windows of twenty words in runs, packed by range of their hash; what a parcel of texts repeats itself is settled."""
    hasher = PolynomialHash()
    schema = pa.schema({"range": pa.int32(), "parcel": pa.int64(), "kind": pa.int32(), "ids": pa.list_(id_type), "texts": pa.list_(pa.int64()),
                        "owners": pa.binary(), "places": pa.binary(), "hashes": pa.binary()})
    parcel = TaskContext.get().partitionId() << 32

    def sent(group, ids, texts):
        owner, place, high, low = (np.concatenate([g[i] for g in group]) for i in range(4))
        first_doc = int(owner[0])
        ids, texts, owner = ids.slice(first_doc, int(owner[-1]) - first_doc + 1), texts[first_doc:int(owner[-1]) + 1], owner - first_doc
        firsts, later = first_of_equal(high, low, order_of(ids)[owner], texts[owner], place)
        rows = [{"kind": DIRECTORY, "range": parcel % ranges, "ids": ids.to_pylist(), "texts": texts.tolist()}]
        if later.any():
            rows.append({"kind": SETTLED, "range": parcel % ranges, "owners": owner[later].astype("<i4").tobytes(), "places": place[later].astype("<i4").tobytes()})
        chosen = np.flatnonzero(firsts)
        for r, which in by_range(range_of(high[chosen], ranges)):
            e = chosen[which]
            docs = np.unique(owner[e])
            rows.append({"kind": ENTRIES, "range": r, "ids": ids.take(pa.array(docs)).to_pylist(), "texts": texts[docs].tolist(),
                         "owners": owner[e].astype("<i4").tobytes(), "places": place[e].astype("<i4").tobytes(), "hashes": np.stack([high[e], low[e]]).tobytes()})
        return record([{"parcel": parcel, **r} for r in rows], schema)

    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text_hash").to_numpy()
        group, size = [], 0
        for k in range(batch.num_rows):
            w, _ = word_hashes([batch.column("text")[k].as_py()], hasher)
            starts = window_starts(batch.column("runs")[k].as_py(), len(w))
            if not len(starts):
                continue
            high = rolling(w, WINDOW, hasher)[starts]
            low = rolling(mix(w ^ np.uint64(0x5851F42D4C957F2D)), WINDOW, hasher)[starts]
            for s in range(0, len(starts), WINDOWS):
                part = slice(s, s + WINDOWS)
                group.append((np.full(len(starts[part]), k), starts[part], high[part], low[part]))
                size += len(starts[part])
                if size >= WINDOWS:
                    yield sent(group, ids, texts)
                    parcel += 1
                    group, size = [], 0
        if group:
            yield sent(group, ids, texts)
            parcel += 1


def numbers(row: dict, column: str) -> np.ndarray:
    return np.frombuffer(row[column].as_py(), "<i4")


def repeated_windows(batches: Iterator[pa.RecordBatch], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Of each range: the windows that an earlier equal one has, sent back to their parcels."""
    schema = pa.schema({"parcel": pa.int64(), "kind": pa.int32(), "ids": pa.list_(id_type), "texts": pa.list_(pa.int64()), "owners": pa.binary(), "places": pa.binary()})
    for rows in of_one(batches, "range"):
        entries = [r for r in rows if r["kind"].as_py() == ENTRIES]
        others = [r for r in rows if r["kind"].as_py() != ENTRIES]
        if others:
            yield pa.record_batch({n: pa.array([r[n].as_py() for r in others], schema.field(n).type) for n in schema.names}, schema=schema)
        if not entries:
            continue
        order = order_of(pa.concat_arrays([r["ids"].values for r in entries]))
        texts = np.concatenate([r["texts"].values.to_numpy() for r in entries])
        owners, begin, doc = [numbers(r, "owners") for r in entries], 0, []
        for o in owners:  # documents of a row are its distinct owners, in order
            docs, which = np.unique(o, return_inverse=True)
            doc.append(which + begin)
            begin += len(docs)
        doc, place = np.concatenate(doc), np.concatenate([numbers(r, "places") for r in entries])
        high, low = np.concatenate([np.frombuffer(r["hashes"].as_py(), np.uint64).reshape(2, -1) for r in entries], axis=1)
        _, later = first_of_equal(high, low, order[doc], texts[doc], place)
        out, a = [], 0
        for r, o in zip(entries, owners):
            mine = later[a:a + len(o)]
            if mine.any():
                out.append({"parcel": r["parcel"].as_py(), "kind": SETTLED, "owners": o[mine].tobytes(), "places": place[a:a + len(o)][mine].astype("<i4").tobytes()})
            a += len(o)
        if out:
            yield record(out, schema)


def repeats_of(batches: Iterator[pa.RecordBatch], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Starts of the repeated windows of each document of a parcel."""
    schema = pa.schema({"doc_id": id_type, "text_hash": pa.int64(), "starts": pa.binary()})
    for rows in of_one(batches, "parcel"):
        directory = next(r for r in rows if r["kind"].as_py() == DIRECTORY)
        found = [r for r in rows if r["kind"].as_py() == SETTLED]
        if not found:
            continue
        owner, place = (np.concatenate([numbers(r, c) for r in found]) for c in ("owners", "places"))
        by = np.lexsort((place, owner))
        owner, place = owner[by], place[by]
        heads = np.flatnonzero(np.diff(owner, prepend=-1))
        which = pa.array(owner[heads])
        yield pa.record_batch({"doc_id": directory["ids"].values.take(which), "text_hash": directory["texts"].values.take(which),
                               "starts": pa.array([place[a:b].tobytes() for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(owner)])], pa.binary())}, schema=schema)


# --- cutting

def cut_words(batches: Iterator[pa.RecordBatch], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Every text without its repeated words."""
    for batch in batches:
        sizes, first, last, offsets, kept = [], [], [], [0], []
        for text, starts in zip(batch.column("text").to_pylist(), batch.column("starts").to_pylist()):
            data = (text or "").encode()
            if starts:
                a, b = word_bounds(np.frombuffer(data, np.uint8))
                at = np.sort(np.frombuffer(b"".join(starts), "<i4").astype(np.int64))
                head = np.concatenate([[True], at[1:] > at[:-1] + WINDOW])
                start, end = at[head], at[np.append(np.flatnonzero(head)[1:], len(at)) - 1] + WINDOW
                first += start.tolist()
                last += end.tolist()
                gone = np.zeros(len(a) + 1, np.int64)
                gone[start] += 1
                gone[end] -= 1
                stay = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
                words = [data[i:j] for i, j in zip(a[stay].tolist(), b[stay].tolist())]
                sizes.append(len(a))
            else:
                words = data.split()  # bytes split at ASCII white space
                sizes.append(len(words))
            offsets.append(len(first))
            kept.append(b" ".join(words).decode())
        spans = pa.StructArray.from_arrays([pa.array(first, pa.int32()), pa.array(last, pa.int32())], ["start", "end"])
        yield pa.record_batch({"doc_id": batch.column("doc_id"), "n_words": pa.array(sizes, pa.int64()),
                               "removed": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans), "kept": pa.array(kept, pa.string())})


def joined(texts: DataFrame, found: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Texts joined to what was found in them, and the texts that certainly have none."""
    gathered = cut_lineage(found.groupBy(id_key("doc_id").alias("__id"), "text_hash").agg(F.collect_list(column).alias(column)))
    maybe, others = split_by_bitmap(texts, gathered)
    return (maybe.join(gathered, ["__id", "text_hash"], "left").drop("__id"),
            others.withColumn(column, F.lit(None).cast("array<binary>")).drop("__id"))


def remove_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words``, ``removed`` (maximal runs of removed words, by
    position) and ``kept`` (the remaining words, joined by one space)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    id_sql = rows.schema["doc_id"].dataType.simpleString()
    id_type = rows.select("doc_id").limit(0).toArrow().schema.field("doc_id").type
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    ranges = size // 6 // RANGE + 1
    packed = f"range int, parcel long, kind int, places binary, hashes binary, ids array<{id_sql}>, texts array<long>, bounds binary"
    answer = f"parcel long, kind int, places binary, ids array<{id_sql}>, texts array<long>, bounds binary"
    dealt = rows.mapInArrow(lambda b: probes(b, ranges, id_type), packed).repartition("range").sortWithinPartitions("range")
    shared = dealt.mapInArrow(lambda b: shared_probes(b, id_type), answer).repartition("parcel").sortWithinPartitions("parcel")
    in_runs = cut_lineage(shared.mapInArrow(lambda b: runs(b, id_type), f"doc_id {id_sql}, text_hash long, runs binary, n long"))
    total = in_runs.agg(F.sum("n")).first()[0] or 0
    keyed = rows.withColumn("__id", id_key("doc_id"))
    wide = total // (RANGE // 8) + 1
    with_runs = joined(keyed, in_runs, "runs")[0].where("runs is not null").select("doc_id", "text", "text_hash", "runs")
    sent = f"range int, parcel long, kind int, ids array<{id_sql}>, texts array<long>, owners binary, places binary, hashes binary"
    back = f"parcel long, kind int, ids array<{id_sql}>, texts array<long>, owners binary, places binary"
    met = (with_runs.mapInArrow(lambda b: windows(b, wide, id_type), sent).repartition("range").sortWithinPartitions("range")
           .mapInArrow(lambda b: repeated_windows(b, id_type), back).repartition("parcel").sortWithinPartitions("parcel")
           .mapInArrow(lambda b: repeats_of(b, id_type), f"doc_id {id_sql}, text_hash long, starts binary"))
    with_starts, without = joined(keyed, met, "starts")
    columns = ["doc_id", "text", "starts"]
    return (with_starts.select(*columns).unionByName(without.select(*columns))
            .mapInArrow(lambda b: cut_words(b, id_type), f"doc_id {id_sql}, n_words long, removed array<struct<start:int,end:int>>, kept string"))
