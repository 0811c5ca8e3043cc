"""Removal of passages of at least 100 bytes that also stand earlier.

Suffixes are ordered only through their first 100 bytes (their window), by
most-significant-digit passes that drop what stands alone after each digit:

1. The leading digit of a window is its anchor: the hash of the least of its
   ``GRAM``-byte grams, with its offset. Equal windows have equal anchors, and
   neighbouring windows mostly share one, so a run of windows with one anchor is
   one row. An anchor that occurs once leaves with all its windows.
2. The second digit is the hash of all bytes a run covers. Runs equal in it hold
   equal windows throughout: all but the first are repeats, as whole ranges. If
   an anchor has one kind of run only, its group is settled.
3. Where an anchor has several kinds of runs (at the ends of a shared passage),
   the first run of each kind joins its group again with the bytes it covers.
   There its windows are radix sorted by eight bytes a pass, singles leaving
   after every pass, through byte 100 and no further; equal groups are exactly
   the repeated windows.

Each exchange is on the leading digit, with rows sorted inside partitions and read
as a stream that keeps one row, or one bounded chunk, of state. A task first merges
equal rows of its own, so a passage in a third of all documents sends one row per
chunk to its group; the others are known to be repeats and go anywhere. A group
larger than a chunk is sorted chunk by chunk, and the first of its windows in every
chunk meet by window hash. Matches never cross documents.

Texts are joined to what was found in them twice, for their open runs and for
their spans. A bitmap of fixed size over hashed ids sends only texts that may have
some through the join; the others pass it by.

Defined results: null text counts as empty; texts below 100 bytes are never
touched but are not sources either, as they hold no window; null ids come last
in order; rows that repeat id and text are one document and both give its
result; rows that share an id but not the text are told apart by 16 bits of a
hash of the text. Only the id and text columns are read, so other columns cannot
clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.hashing import PolynomialHash, mix
from tessera.llm.rows import id_key, split_by_bitmap
from tessera.session import cut_lineage

WINDOW = 100
GRAM = 40
#: Bytes hashed at once; longer documents go in overlapping pieces.
PIECE = 1 << 18
#: Bytes of text within which a task merges equal rows before sending.
MERGE = 1 << 23
#: Runs that are sorted together in pass 3.
CHUNK = 1 << 14
#: Leading digits are cut to 48 bits: a clash only makes a group open, the later digits decide.
ANCHOR = np.uint64((1 << 48) - 1)

# place: 16 bits of the text's hash, 1 bit "known repeat", 7 + 7 bits of offsets, 32 bits of position
SETTLED = 1 << 46


def text_bits(text: str):
    return F.pmod(F.xxhash64(text), F.lit(1 << 16))


def runs_of_windows(raw: np.ndarray, ends: np.ndarray, hasher: PolynomialHash,
                    window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor in texts laid end to end.

    ``ends`` are the texts' ends. Returns per run: anchor hash, hash of the bytes
    covered, first and last window start, anchor position.
    """
    none = np.empty(0, np.uint64)
    n = len(raw)
    if n < window:
        return none, none, *[np.empty(0, np.int64)] * 3
    sums = hasher.prefix(raw)
    grams = mix((sums[gram:] - sums[:-gram]) * hasher.inverses[:n - gram + 1])
    low = np.uint64((1 << 24) - 1)
    least = grams & ~low | np.arange(len(grams), dtype=np.uint64)
    width, span = window - gram + 1, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[:len(least) - (width - span)], least[width - span:])
    anchor = (least & low).astype(np.int64)  # by window start
    inside = np.ones(len(anchor), bool)
    for e in ends.tolist():  # windows that would cross into the next text
        inside[max(e - window + 1, 0):e] = False
    starts = np.flatnonzero(inside)
    if not len(starts):
        return none, none, starts, starts, starts
    at = anchor[starts]
    head = np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)])
    first = starts[head]
    last = starts[np.append(np.flatnonzero(head)[1:], len(starts)) - 1]
    at = at[head]
    covered = hasher.spans(sums, first, last + window)
    covered = mix(covered + (at - first).astype(np.uint64) * np.uint64(128) + (at - last).astype(np.uint64))
    return grams[at], covered, first, last, at


def ordered(ids: pa.Array) -> np.ndarray:
    """Numbers that sort as the ids do, equal for equal ids, nulls last."""
    if pa.types.is_integer(ids.type):
        values = ids.cast(pa.int64())
        known = np.unique(values.drop_null().to_numpy(zero_copy_only=False))
        rank = np.searchsorted(known, values.fill_null(0).to_numpy(zero_copy_only=False))
        return np.where(values.is_null().to_numpy(zero_copy_only=False), len(known), rank)
    names = sorted({x for x in ids.to_pylist() if x is not None})
    rank = {x: i for i, x in enumerate(names)}
    return np.array([rank.get(x, len(names)) for x in ids.to_pylist()], np.int64)


def comparable(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids that can be compared across batches, and which of them are null."""
    null = ids.is_null().to_numpy(zero_copy_only=False)
    if pa.types.is_integer(ids.type):
        return ids.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False), null
    return np.array(ids.to_pylist(), object), null


def merged(key1, key2, doc, place) -> tuple[np.ndarray, np.ndarray]:
    """Order rows by keys, then id and position; which rows repeat an earlier row of their keys."""
    order = np.lexsort((place & (1 << 32) - 1, doc, key2, key1))
    k1, k2, d, p = key1[order], key2[order], doc[order], place[order]
    same = np.concatenate([[False], (k1[1:] == k1[:-1]) & (k2[1:] == k2[:-1])])
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    return order, same & ~((d == d[head]) & (p == p[head]))


def merged_rows(rows: list[tuple], ids: pa.Array) -> pa.RecordBatch:
    """One batch of ``key1, key2, doc_id, place`` with the repeats among its own rows settled."""
    key1, key2, owner, place = (np.concatenate([r[i] for r in rows]) for i in range(4))
    order, later = merged(key1, key2, ordered(ids)[owner], place)
    repeat = np.zeros(len(order), bool)
    repeat[order] = later  # rows stay in the order of the text, which compresses better
    spread = mix(place.astype(np.uint64) + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + key1)
    key1 = np.where(repeat, spread, key1) & ANCHOR
    place = np.where(repeat, place | SETTLED, place)
    return pa.record_batch({"key1": pa.array(key1.view(np.int64)), "key2": pa.array(key2.view(np.int64)),
                            "doc_id": ids.take(pa.array(owner)), "place": pa.array(place)})


def text_pieces(texts: list[str | None]) -> Iterator[tuple[int, int, bytes]]:
    """``row, offset, bytes`` of texts with a window, long ones in overlapping pieces."""
    for row, text in enumerate(texts):
        data = (text or "").encode()
        for offset in range(0, max(len(data) - WINDOW + 1, 0), PIECE):
            yield row, offset, data[offset:offset + PIECE + WINDOW - 1]


def run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pass 1: one row per run of windows."""
    hasher = PolynomialHash()
    for batch in batches:
        ids, bits = batch.column("doc_id"), batch.column("bits").to_numpy()
        rows, held = [], 0
        group: list[tuple[int, int, bytes]] = []
        size = 0

        def hashed(group):
            ends = np.cumsum([len(x[2]) for x in group])
            begin = ends - [len(x[2]) for x in group]
            key1, key2, first, last, at = runs_of_windows(np.frombuffer(b"".join(x[2] for x in group), np.uint8), ends, hasher)
            which = np.searchsorted(ends, first, side="right")
            owner = np.array([x[0] for x in group])[which]
            shift = np.array([x[1] for x in group])[which] - begin[which]
            place = bits[owner] << 47 | at - first << 39 | at - last << 32 | at + shift
            return key1, key2, owner, place

        for piece in text_pieces(batch.column("text").to_pylist()):
            group.append(piece)
            size += len(piece[2])
            if size >= PIECE:
                rows.append(hashed(group))
                held += size
                group, size = [], 0
                if held >= MERGE:
                    yield merged_rows(rows, ids)
                    rows, held = [], 0
        if group:
            rows.append(hashed(group))
        if rows:
            yield merged_rows(rows, ids)


def later_rows(batches: Iterator[pa.RecordBatch], kinds: bool) -> Iterator[pa.RecordBatch]:
    """Rows sorted by keys, id and place: those that repeat an earlier row of both keys.

    With ``kinds``, also the first row of each second key where a first key has several
    (``settled`` false). Between batches only the last first-row is kept, and the one row
    that waits to learn whether its first key has a second kind.
    """
    state = None  # key1, key2, doc, whether it is null, place of the first row of the current run
    waiting: pa.RecordBatch | None = None  # first row of a first key with one kind so far
    several = False
    for batch in batches:
        if not batch.num_rows:
            continue
        k1, k2, p = (batch.column(c).to_numpy() for c in ("key1", "key2", "place"))
        doc, null = comparable(batch.column("doc_id"))
        n = len(k1)
        same1 = np.concatenate([[state is not None and state[0] == k1[0]], k1[1:] == k1[:-1]])
        same = same1 & np.concatenate([[state is not None and state[1] == k2[0]], k2[1:] == k2[:-1]])
        head = np.maximum.accumulate(np.where(same, -1, np.arange(n)))
        h = np.maximum(head, 0)
        again = (doc == doc[h]) & (null == null[h]) & (p == p[h])
        if state is not None and (head < 0).any():
            again = np.where(head < 0, (doc == state[2]) & (null == state[3]) & (p == state[4]), again)
        known = (p & SETTLED) != 0
        out = [(np.flatnonzero((same & ~again) | known), True)]
        if kinds:
            firsts = np.flatnonzero(~same & ~known)
            run1 = np.cumsum(~same1)  # 0: the first key of the batch before
            counts = np.bincount(run1[firsts], minlength=run1[-1] + 1)
            held = 1 if waiting is not None or several else 0
            if counts[0] and held and waiting is not None:
                yield marks(waiting, False)
                waiting = None
            if counts[0] and held:
                several = True
            many = counts > 1
            many[0] = several and run1[0] == 0
            out.append((firsts[many[run1[firsts]]], False))
            if run1[-1] > 0 or state is None:
                end = firsts[run1[firsts] == run1[-1]]
                several = len(end) > 1
                waiting = batch.slice(int(end[0]), 1) if len(end) == 1 else None
        for rows, settled in out:
            if len(rows):
                yield marks(batch.take(pa.array(rows)), settled)
        state = (k1[-1], k2[-1], *((doc[h[-1]], null[h[-1]], p[h[-1]]) if head[-1] >= 0 else state[2:]))


def marks(rows: pa.RecordBatch, settled: bool) -> pa.RecordBatch:
    return pa.record_batch({"key1": rows.column("key1"), "doc_id": rows.column("doc_id"), "place": rows.column("place"),
                            "settled": pa.array(np.full(rows.num_rows, settled))})


def repeats_by_key(rows: DataFrame, id_type: str, kinds: bool) -> DataFrame:
    position = F.col("place").bitwiseAND(F.lit((1 << 32) - 1))
    dealt = rows.repartition("key1").sortWithinPartitions("key1", "key2", F.col("doc_id").asc_nulls_last(), position)
    return dealt.mapInArrow(lambda b: later_rows(b, kinds), f"key1 long, doc_id {id_type}, place long, settled boolean")


def run_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pass 3: open runs with the bytes that they cover."""
    for batch in batches:
        owner, keys, places, covered = [], [], [], []
        for row, (text, runs) in enumerate(zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist())):
            data = text.encode()
            for run in runs:
                place = run["place"]
                at = place & (1 << 32) - 1
                owner.append(row)
                keys.append(run["key1"])
                places.append(place)
                covered.append(data[at - (place >> 39 & 127):at - (place >> 32 & 127) + WINDOW])
        yield pa.record_batch({"key1": pa.array(keys, pa.int64()), "doc_id": batch.column("doc_id").take(pa.array(owner, pa.int64())),
                               "place": pa.array(places, pa.int64()), "covered": pa.array(covered, pa.binary())})


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, bool]]:
    """Whole groups of one leading digit, many to a chunk; a group too large for one comes in
    parts (true)."""
    held: list[pa.Table] = []
    size = 0
    split: int | None = None  # the group that has been given in parts so far

    def whole(rows: pa.Table) -> Iterator[tuple[pa.Table, bool]]:
        tail = int(np.searchsorted(rows.column("key1").to_numpy(), split, side="right")) if split is not None else 0
        if tail:
            yield rows.slice(0, tail), True
        if tail < rows.num_rows:
            yield rows.slice(tail), False

    for batch in batches:
        while batch.num_rows:
            held.append(pa.Table.from_batches([batch.slice(0, CHUNK)]))
            batch = batch.slice(CHUNK)
            size += held[-1].num_rows
            if size < CHUNK:
                continue
            rows = pa.concat_tables(held)
            key = rows.column("key1").to_numpy()
            cut = int(np.searchsorted(key, key[-1]))
            if cut:  # the last group may go on
                yield from whole(rows.slice(0, cut))
                rows, size = rows.slice(cut), len(key) - cut
            held = [rows]
            if size >= CHUNK:
                split = int(key[-1])
                yield rows, True
                held, size = [], 0
    if size:
        yield from whole(pa.concat_tables(held))


def equal_windows(group: np.ndarray, starts: np.ndarray, raw: bytes, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Radix sort of windows by their bytes, the most significant eight first, within ``group``.

    Windows that stand alone after a pass leave; sorting ends at the depth of the window.
    Returns the windows that are left, ordered so that equal ones follow each other in
    their given order, and the number of their equal group.
    """
    words = np.ndarray((len(raw) + 1,), ">u8", raw + bytes(8), strides=(1,))
    alive = np.arange(len(starts))
    for depth in range(0, window, 8):
        if not len(alive):
            break
        digit = words[starts[alive] + depth]
        if window - depth < 8:
            digit = digit >> np.uint64(8 * (8 - window + depth))
        order = np.lexsort((digit, group))
        alive, group, digit = alive[order], group[order], digit[order]
        head = np.concatenate([[True], (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])])
        number = np.cumsum(head) - 1
        several = np.bincount(number)[number] > 1
        alive, group = alive[several], number[several]
    return alive, group


def open_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted open runs with their bytes: ranges of repeated windows (``settled``), and, of groups in
    parts, the first window of each kind in the part, with its keys."""
    hasher = PolynomialHash()
    for rows, part in chunks(batches):
        key, place = rows.column("key1").to_numpy(), rows.column("place").to_numpy()
        ids = rows.column("doc_id").combine_chunks()
        ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
        covered = rows.column("covered").to_pylist()
        at, lo, hi = place & (1 << 32) - 1, place >> 32 & 127, place >> 39 & 127
        count = hi - lo + 1
        begin = np.cumsum([0, *map(len, covered)])[:-1]
        run = np.repeat(np.arange(len(key)), count)
        step = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
        starts, offset = begin[run] + step, hi[run] - step
        raw = b"".join(covered)
        number = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
        alive, equal = equal_windows(number[run] * 128 + offset, starts, raw)
        head = np.concatenate([[True], equal[1:] != equal[:-1]]) if len(equal) else np.empty(0, bool)
        first = alive[head][np.cumsum(head) - 1]
        # a row repeated as a whole is the same document
        doc = ordered(ids)
        same = (doc[run[alive]] == doc[run[first]]) & (place[run[alive]] == place[run[first]])
        later = np.sort(alive[~head & ~same])
        if len(later):
            new = np.concatenate([[True], (later[1:] != later[:-1] + 1) | (run[later[1:]] != run[later[:-1]])])
            a = later[new]
            b = later[np.append(np.flatnonzero(new)[1:], len(later)) - 1]
            owner = run[a]
            spot = place[owner] >> 47 << 47 | offset[a] << 39 | offset[b] << 32 | at[owner]
            yield found_rows(key[owner], np.zeros(len(a), np.int64), ids, owner, spot, True)
        if part:
            rest = np.ones(len(run), bool)
            rest[later] = False
            w = np.flatnonzero(rest)
            buffer = np.frombuffer(raw, np.uint8)
            hashed = hasher.spans(hasher.prefix(buffer), starts[w], starts[w] + WINDOW)
            spot = place[run[w]] >> 47 << 47 | (at[run[w]] - offset[w])
            yield found_rows(hashed.view(np.int64), key[run[w]] * 128 + offset[w], ids, run[w], spot, False)


def found_rows(key1, key2, ids: pa.Array, owner: np.ndarray, place: np.ndarray, settled: bool) -> pa.RecordBatch:
    return pa.record_batch({"key1": pa.array(key1, pa.int64()), "key2": pa.array(key2, pa.int64()), "doc_id": ids.take(pa.array(owner)),
                            "place": pa.array(place, pa.int64()), "settled": pa.array(np.full(len(place), settled))})


def join_where_found(texts: DataFrame, found: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Texts joined to what was found in them, and the texts that certainly have none."""
    maybe, others = split_by_bitmap(texts, found)
    return maybe.join(found, ["__id", "bits"], "left"), others.withColumn(column, F.lit(None).cast(found.schema[column].dataType))


def byte_spans(found: DataFrame) -> DataFrame:
    """``__id, bits, spans``: packed start and end of all repeated bytes of a document."""
    at = F.col("place").bitwiseAND(F.lit((1 << 32) - 1))
    hi = F.shiftright("place", 39).bitwiseAND(F.lit(127))
    lo = F.shiftright("place", 32).bitwiseAND(F.lit(127))
    span = F.shiftleft(at - hi, 32).bitwiseOR(at - lo + WINDOW)
    return by_document(found, F.collect_list(span).alias("spans"))


def by_document(found: DataFrame, gathered) -> DataFrame:
    return found.groupBy(id_key("doc_id").alias("__id"), F.shiftright("place", 47).alias("bits")).agg(gathered)


def merge_spans(packed: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the spans."""
    packed = np.sort(packed)
    start, end = packed >> 32, np.minimum(packed & (1 << 32) - 1, n)
    reach = np.maximum.accumulate(end)
    head = np.concatenate([[True], start[1:] > reach[:-1]])
    return start[head], reach[np.append(np.flatnonzero(head)[1:], len(start)) - 1]


def cut_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, packed = batch.column("text").to_pylist(), batch.column("spans").to_pylist()
        sizes, starts, ends, offsets, kept = [], [], [], [0], []
        for text, spans in zip(texts, packed):
            data = (text or "").encode()
            sizes.append(len(data))
            if spans:
                a, b = merge_spans(np.array(spans, np.int64), len(data))
                starts += a.tolist()
                ends += b.tolist()
                cuts = [0, *np.stack([a, b], 1).ravel().tolist(), len(data)]
                data = b"".join([data[i:j] for i, j in zip(cuts[::2], cuts[1::2])])
            offsets.append(len(starts))
            kept.append(data)
        spans = pa.StructArray.from_arrays([pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["start", "end"])
        yield pa.record_batch({"doc_id": batch.column("doc_id"), "n_bytes": pa.array(sizes, pa.int64()),
                               "removed": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans),
                               "kept": pa.array(kept, pa.binary())})


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes``, ``removed`` (maximal byte runs) and
    ``kept`` (the remaining bytes)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_bits(text).alias("bits"), F.col(text).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    keyed = f"key1 long, key2 long, doc_id {id_type}, place long"
    runs = rows.mapInArrow(run_rows, keyed)
    found = cut_lineage(repeats_by_key(runs, id_type, kinds=True))
    texts = rows.withColumn("__id", id_key("doc_id"))
    several = cut_lineage(by_document(found.where("not settled"), F.collect_list(F.struct("key1", "place")).alias("runs")))
    with_runs, _ = join_where_found(texts, several, "runs")
    covered = (with_runs.where("runs is not null").select("doc_id", "text", "runs")
               .mapInArrow(run_bytes, f"key1 long, doc_id {id_type}, place long, covered binary"))
    position = F.col("place").bitwiseAND(F.lit((1 << 32) - 1))
    late = cut_lineage(covered.repartition("key1").sortWithinPartitions("key1", F.col("doc_id").asc_nulls_last(), position)
                       .mapInArrow(open_runs, f"{keyed}, settled boolean"))
    across = repeats_by_key(late.where("not settled").drop("settled"), id_type, kinds=False)
    spans = cut_lineage(byte_spans(found.where("settled").select("doc_id", "place")
                                   .unionByName(late.where("settled").select("doc_id", "place"))
                                   .unionByName(across.select("doc_id", "place"))))
    with_spans, without = join_where_found(texts, spans, "spans")
    return (with_spans.select("doc_id", "text", "spans").unionByName(without.select("doc_id", "text", "spans"))
            .mapInArrow(cut_spans, f"doc_id {id_type}, n_bytes long, removed array<struct<start:int,end:int>>, kept binary"))
