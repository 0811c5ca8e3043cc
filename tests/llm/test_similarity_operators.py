import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import graph, repeats, rows, set_join, top_k

from odd_cases import DOC, odd_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def components_by_hand(docs):
    """Component number of every row, all pairs compared."""
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(docs))], sets


def near_copies(seed, n, words, edits, start=0):
    r = random.Random(seed)
    vocabulary = [f"v{seed}w{i}" for i in range(400)]
    base = [r.choice(vocabulary) for _ in range(words)]
    out = []
    for i in range(n):
        copy = list(base)
        for _ in range(r.randint(0, edits)):
            copy[r.randrange(len(copy))] = f"e{seed}x{r.randrange(50)}"
        if r.random() < 0.3:
            del copy[-r.randint(1, max(1, words // 8)):]
        out.append((start + i, " ".join(copy)))
    return out


def check_join(spark, docs):
    found = set_join.components(spark.createDataFrame([(d, t, None, None, 0) for d, t in docs], DOC))
    number, sets = components_by_hand(docs)
    least = {}
    for (d, _), c in zip(docs, number):
        least[c] = min(least.get(c, math.inf), d)
    by_id = {r.doc_id: r for r in found.collect()}
    assert len(by_id) == len(docs)
    for (d, _), c, s in zip(docs, number, sets):
        assert (by_id[d].n_shingles, by_id[d].component_id) == (len(s), least[c]), d
        assert by_id[d].stays == (d == least[c])


@pytest.fixture(params=[None, 7])
def small_groups(request, monkeypatch):
    """Also with groups split into blocks of a few rows (the driver's part of the plan)."""
    if request.param:
        monkeypatch.setattr(set_join, "GROUP_ROWS", request.param)


def test_join_equals_all_pairs(spark, small_groups):
    docs = []
    for seed, (n, words, edits) in enumerate([(40, 60, 3), (25, 12, 1), (30, 9, 1), (15, 200, 12), (6, 5, 1)]):
        docs += near_copies(seed, n, words, edits, start=len(docs))
    passage = " ".join(f"common{i}" for i in range(30))
    docs += [(len(docs) + i, " ".join(f"u{i}w{k}" for k in range(40)) + " " + passage) for i in range(20)]
    check_join(spark, docs)


def in_batches(table, size):
    return iter(table.combine_chunks().to_batches(max_chunksize=size))


def test_groups_give_a_spanning_forest_of_all_links():
    """In-process, with sets of one group compared all against all."""
    r = random.Random(11)
    for _ in range(30):
        base = r.sample(range(1000), r.randint(4, 60))
        sets = []
        for _ in range(r.randint(2, 25)):
            s = set(base)
            for _ in range(r.randint(0, 8)):
                s.discard(r.choice(base))
                s.add(r.randrange(1000))
            sets.append(np.array(sorted(s), np.uint64))
        root = list(range(len(sets)))

        def find(i, root):
            while root[i] != i:
                i = root[i]
            return i
        for i in range(len(sets)):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    root[find(i, root)] = find(j, root)
        forest = list(range(len(sets)))
        edges = list(set_join.group_links(sets[0], sets))
        for i, j in edges:
            assert find(i, forest) != find(j, forest)  # no link twice
            forest[find(i, forest)] = find(j, forest)
        assert [[find(i, root) == find(j, root) for j in range(len(sets))] for i in range(len(sets))] == \
            [[find(i, forest) == find(j, forest) for j in range(len(sets))] for i in range(len(sets))]
        may = set_join.possible_partners(np.array([len(s) for s in sets]), [set_join.bitmap(s) for s in sets])
        assert all(may[i] and may[j] for i, j in edges)


def test_list_parts_keep_lists_whole():
    keys = np.sort(np.random.default_rng(1).integers(0, 40, 300))
    table = pa.table({"member": keys, "v": np.arange(300)})
    for size in (1, 7, 1000):
        parts = list(set_join.list_parts(in_batches(table, size)))
        assert pa.concat_tables(parts).equals(table)
        seen = [set(p.column("member").to_pylist()) for p in parts]
        assert sum(map(len, seen)) == len(set(keys.tolist()))


def test_join_on_odd_rows(odd, empty):
    found = set_join.components(odd).collect()
    assert len(found) == len(odd_rows())
    number, sets = components_by_hand([(d, t) for d, t, *_ in odd_rows()])
    ids = {}
    for (d, *_), c in zip(odd_rows(), number):
        if d is not None:
            ids[c] = min(ids.get(c, d), d)
    want = Counter((d, len(s), ids.get(c) if s else d) for (d, *_), c, s in zip(odd_rows(), number, sets))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == want
    assert set_join.components(empty).count() == 0


def test_needed_overlap_and_prefix():
    for a in range(1, 60):
        for b in range(a, 80):
            least = min((i for i in range(a + 1) if 100 * i >= 80 * (a + b - i)), default=None)
            if least is not None:
                assert set_join.needed_overlap(a, b) == least and least >= max(a, b) - set_join.prefix_length(max(a, b)) + 1
                ca, cb = set_join.size_class(np.array([a, b]))
                assert cb - ca <= 1


def test_connected_components(spark):
    r = random.Random(7)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1060)]
    found = {x.node: x.component for x in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert found == {x: find(x) for x in root if any(x in e and e[0] != e[1] for e in edges)}


def test_sorted_runs_across_batches():
    keys = np.sort(np.random.default_rng(0).integers(0, 30, 200))
    batches = [pa.record_batch({"k": keys[a:a + 7], "v": np.arange(a, min(a + 7, 200))}) for a in range(0, 200, 7)]
    runs = list(rows.sorted_runs(iter(batches), ["k"]))
    assert [t.column("k")[0].as_py() for t in runs] == sorted(set(keys.tolist()))
    assert sum(t.num_rows for t in runs) == 200


def removed_by_hand(docs, window=100):
    """Per row of ``(id, text)`` sorted by id: the bytes covered by a window seen before."""
    seen, out = set(), []
    for _, text in docs:
        data = (text or "").encode()
        mark = bytearray(len(data))
        for i in range(len(data) - window + 1):
            w = data[i:i + window]
            if w in seen:
                mark[i:i + window] = b"\1" * window
            seen.add(w)
        out.append(mark)
    return out


def check_repeats(spark, docs):
    shuffled = list(docs)
    random.Random(0).shuffle(shuffled)
    df = spark.createDataFrame([(d, t, None, None, 0) for d, t in shuffled], DOC).repartition(3)
    found = {r.doc_id: r for r in repeats.remove_repeats(df).collect()}
    for (d, text), mark in zip(docs, removed_by_hand(docs)):
        data = (text or "").encode()
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(mark))]
        assert found[d].n_bytes == len(data)
        assert [(s.start, s.end) for s in found[d].removed] == spans, d
        assert bytes(found[d].kept) == bytes(b for b, m in zip(data, mark) if not m)


def repeat_cases(seed=5):
    r = random.Random(seed)

    def noise(n):
        return "".join(r.choice("abcdefgh é漢") for _ in range(n))
    passages = [noise(n) for n in (99, 100, 101, 140, 260, 900)]
    docs = []
    for i in range(90):
        text = noise(r.randint(0, 200))
        for _ in range(r.randint(0, 4)):
            p = r.choice(passages)
            a = r.randint(0, len(p) // 3)
            text += p[a:len(p) - r.randint(0, len(p) // 4)] + noise(r.randint(0, 60))
        docs.append((i, text))
    return docs + [(90, "-" * 700), (91, "ab" * 400), (92, "-" * 150), (93, docs[3][1]), (94, None), (95, ""), (96, "x" * 99)]


def test_repeats_equal_brute_force(spark):
    check_repeats(spark, repeat_cases())


@pytest.mark.parametrize("piece, merge, chunk, size", [(1 << 18, 1 << 23, 1 << 14, 10_000), (300, 900, 7, 5), (120, 400, 1, 1), (512, 1 << 20, 30, 11)])
def test_passes_in_process_with_small_pieces(monkeypatch, piece, merge, chunk, size):
    """The passes as the tasks run them, sorted as the exchanges do, with state across batches and chunks."""
    for name, value in (("PIECE", piece), ("MERGE", merge), ("CHUNK", chunk)):
        monkeypatch.setattr(repeats, name, value)
    docs = repeat_cases(9)
    texts = dict(docs)

    def ordered(table, keys):
        position = pa.array(table.column("place").to_numpy() & ((1 << 32) - 1))
        return table.append_column("at", position).sort_by([(k, "ascending") for k in (*keys, "doc_id", "at")]).drop(["at"])

    rows = pa.table({"doc_id": pa.array([d for d, _ in docs], pa.int64()), "bits": pa.array([0] * len(docs), pa.int64()),
                     "text": pa.array([t for _, t in docs], pa.string())}).slice(0)
    runs = pa.Table.from_batches(repeats.run_rows(in_batches(rows, 13)))
    found = pa.Table.from_batches(repeats.later_rows(in_batches(ordered(runs, ("key1", "key2")), size), True))
    several = {}
    for m in found.to_pylist():
        if not m["settled"]:
            several.setdefault(m["doc_id"], []).append({"key1": m["key1"], "place": m["place"]})
    batch = pa.record_batch({"doc_id": pa.array(list(several), pa.int64()), "text": pa.array([texts[d] for d in several], pa.string()),
                             "runs": pa.array(list(several.values()))})
    covered = pa.Table.from_batches(repeats.run_bytes(iter([batch])))
    late = pa.Table.from_batches(repeats.open_runs(in_batches(ordered(covered, ("key1",)), size)))
    spots = [m for m in [*found.to_pylist(), *late.to_pylist()] if m["settled"]]
    windows = late.filter(pa.array([not m["settled"] for m in late.to_pylist()], pa.bool_())).drop(["settled"])
    if windows.num_rows:
        spots += pa.Table.from_batches([*repeats.later_rows(in_batches(ordered(windows, ("key1", "key2")), size), False)],
                                       pa.schema([("key1", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int64()), ("settled", pa.bool_())])).to_pylist()
    marks = {d: bytearray(len((t or "").encode())) for d, t in docs}
    for m in spots:
        at, lo, hi = m["place"] & (1 << 32) - 1, m["place"] >> 32 & 127, m["place"] >> 39 & 127
        marks[m["doc_id"]][at - hi:at - lo + 100] = b"\1" * (hi - lo + 100)
    assert [bytes(marks[d]) for d, _ in docs] == [bytes(m) for m in removed_by_hand(docs)]


def test_repeats_with_small_batches(spark, monkeypatch):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        r = random.Random(6)
        passage = "".join(r.choice("abcdef ") for _ in range(300))
        check_repeats(spark, [(i, "".join(r.choice("xyz ") for _ in range(r.randint(0, 150))) + passage[r.randint(0, 60):]) for i in range(40)])
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_radix_sort_finds_exactly_the_equal_windows():
    r = np.random.default_rng(3)
    raw = bytes(r.integers(97, 99, 400)) + b"q" * 150
    starts = np.concatenate([np.arange(0, 440), np.arange(0, 300)])
    group = np.concatenate([np.zeros(440, int), np.ones(300, int)])
    raw += raw
    starts = np.concatenate([starts, starts[:100] + 550])
    group = np.concatenate([group, group[:100]])
    alive, equal = repeats.equal_windows(group, starts, raw)
    want = {}
    for i, (g, a) in enumerate(zip(group.tolist(), starts.tolist())):
        want.setdefault((g, raw[a:a + 100]), []).append(i)
    got = {}
    for i, e in zip(alive.tolist(), equal.tolist()):
        got.setdefault(e, []).append(i)
    assert sorted(got.values()) == sorted(x for x in want.values() if len(x) > 1)


def test_repeats_on_odd_rows(odd, empty):
    found = repeats.remove_repeats(odd).collect()
    assert Counter((r.doc_id, r.n_bytes) for r in found) == Counter((d, len((t or "").encode())) for d, t, *_ in odd_rows())
    by_id = {(r.doc_id, r.n_bytes): sum(s.end - s.start for s in r.removed) for r in found}
    longest = max(n for _, n in by_id)
    assert by_id[(8, longest)] >= longest - 10 and by_id[(7, longest - 4)] < longest - 4  # the later copy goes
    assert repeats.remove_repeats(empty).count() == 0


def bm25_by_hand(docs, query, k):
    terms = [top_k.terms_of(t) for _, t in docs]
    n, mean = len(docs), sum(map(len, terms)) / len(docs)
    df = Counter(t for x in terms for t in set(x))
    scores = []
    for (d, _), x in zip(docs, terms):
        tf, s = Counter(x), 0.0
        for t in top_k.terms_of(query):
            if tf[t]:
                idf = math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5))
                s += idf * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(x) / mean))
        if s:
            scores.append((-round(s, 9), d))
    return sorted(scores)[:k]


def search_case():
    r = random.Random(8)
    words = [f"t{int(r.paretovariate(0.7))}" for _ in range(4000)]
    docs = [(i, " ".join(r.choices(words, k=r.randint(0, 60)))) for i in range(400)]
    return docs, [(q, " ".join(r.choices(words, k=r.randint(1, 9)))) for q in range(25)]


def test_top_k_equals_scoring_everything(spark):
    docs, asked = search_case()
    asked += [(90, ""), (91, None), (92, "unknown")]
    df = spark.createDataFrame([(d, t, None, None, 0) for d, t in docs], DOC).repartition(3)
    found = top_k.search(spark, df, spark.createDataFrame(asked, "query_id long, query string"), k=7)
    got = {}
    for x in found.orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append((-x.score, x.doc_id))
    for q, text in asked:
        want = bm25_by_hand(docs, text, 7)
        assert [d for _, d in got.get(q, [])] == [d for _, d in want], q
        assert np.allclose([s for s, _ in got.get(q, [])], [s for s, _ in want], atol=1e-8)


@pytest.mark.parametrize("block, shard_docs", [(2, 400), (4, 90), (64, 1)])
def test_shards_with_small_blocks_merge_exactly(monkeypatch, block, shard_docs):
    monkeypatch.setattr(top_k, "BLOCK", block)
    docs, asked = search_case()
    terms = [top_k.terms_of(t) for _, t in docs]
    df = Counter(t for x in terms for t in set(x))
    mean = sum(map(len, terms)) / len(docs)
    order = {t: i for i, t in enumerate(sorted(df))}
    shards = []
    for a in range(0, len(docs), shard_docs):
        shard = top_k.Shard(len(docs), mean, dict(df))
        for d, t in docs[a:a + shard_docs]:
            shard.add(d, t)
        if shard.ids:
            shard.finish()
            shards.append(shard)
    for _, text in asked:
        plan = {t: (n, order[t]) for t, n in Counter(top_k.terms_of(text)).items() if t in order}
        found = sorted((-s, shard.ids[d]) for shard in shards for s, d in shard.search(plan, 5))[:5]
        want = bm25_by_hand(docs, text, 5)
        assert [d for _, d in found] == [d for _, d in want]


def test_top_k_on_odd_rows(spark, odd, empty):
    asked = spark.createDataFrame([(1, "ONE two quite"), (None, "one"), (3, None)], "query_id long, query string")
    found = top_k.search(spark, odd, asked).collect()
    assert {x.query_id for x in found} == {1, None} and all(x.score > 0 for x in found)
    assert top_k.search(spark, empty, asked).count() == 0
    assert top_k.search(spark, odd, asked.limit(0)).count() == 0


def test_blocks_are_bounded_by_terms_and_repeated_queries_stay_apart(spark, monkeypatch):
    asked = [{"q": 1, "t": f"a{i} b c"} for i in range(10)] + [{"q": 2, "t": None}, {"q": 3, "t": " ".join(f"x{i}" for i in range(20))}]
    monkeypatch.setattr(top_k, "TERM_BLOCK", 7)
    blocks = list(top_k.query_blocks(asked))
    assert [len(b) for b in blocks] == [2, 2, 2, 2, 2, 1] and [no for b in blocks for no, _, _ in b] == [*range(10), 11]
    docs, queries = search_case()
    df = spark.createDataFrame([(d, t, None, None, 0) for d, t in docs], DOC)
    same = [(5, t) for _, t in queries[:6]]  # one id, other texts, in blocks of their own
    found = top_k.search(spark, df, spark.createDataFrame(same, "query_id long, query string"), k=3)
    assert Counter((x.doc_id, x["rank"]) for x in found.collect()) == Counter(
        (d, i + 1) for _, t in same for i, (_, d) in enumerate(bm25_by_hand(docs, t, 3)))


def test_whole_documents_as_queries_equal_scoring_everything(spark):
    docs, _ = search_case()
    r = random.Random(3)
    docs += [(i, " ".join(r.choices([f"t{n}" for n in range(300)], k=200))) for i in range(400, 440)] + [(440, docs[3][1]), (441, docs[3][1])]
    df = spark.createDataFrame([(d, t, None, None, 0) for d, t in docs], DOC).repartition(3)
    asked = [(d, t) for d, t in docs if d % 20 == 0]
    assert any(len(set(top_k.terms_of(t))) > top_k.LONG_QUERY for _, t in asked)
    got = {}
    for x in top_k.search(spark, df, spark.createDataFrame(asked, "query_id long, query string"), k=7).orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append(x.doc_id)
    for q, text in asked:
        assert got.get(q, []) == [d for _, d in bm25_by_hand(docs, text, 7)], q


def test_long_queries_score_few_documents_exactly(monkeypatch):
    r = random.Random(4)
    docs = [(i, " ".join(r.choices([f"t{int(r.paretovariate(0.8))}" for _ in range(500)], k=r.randint(1, 300)))) for i in range(900)]
    docs += [(900 + i, docs[i][1]) for i in range(5)]
    terms = [top_k.terms_of(t) for _, t in docs]
    df = Counter(t for x in terms for t in set(x))
    shards = []
    for a in (0, 300, 600):  # equal texts in several shards
        shard = top_k.Shard(len(docs), sum(map(len, terms)) / len(docs), dict(df))
        for d, t in docs[a:a + 300] if a < 600 else docs[a:]:
            shard.add(d, t)
        shard.finish()
        shards.append(shard)
    scored = []
    near = top_k.Shard.near
    monkeypatch.setattr(top_k.Shard, "near", lambda *a: scored.append(near(*a)) or scored[-1])
    for no in range(0, 900, 20):
        query = Counter(terms[no])
        if len(query) <= top_k.LONG_QUERY:
            continue
        best, weights = [], np.array([n for n in query.values()]) * top_k.idf(len(docs), np.array([df[t] for t in query], float))
        for shard in shards:
            rows = shard.lists_of(top_k.term_hashes([b" ".join(query)])[0])
            least = -best[4][0] if len(best) == 5 else 0.0
            found = next(shard.add_up([(rows[rows >= 0], weights[rows >= 0], least)], 5))
            best = sorted(best + [(-s, shard.ids[d]) for s, d in found])[:5]
        assert [d for _, d in best] == [d for _, d in bm25_by_hand(docs, docs[no][1], 5)], no
    assert len(scored) > 60 and sum(map(len, scored)) < 8 * len(scored)


def two_kinds():
    r = random.Random(6)
    words = [[f"{kind}{int(r.paretovariate(0.7))}" for _ in range(3000)] for kind in "ab"]
    return [(i, " ".join(r.choices(words[i % 2], k=r.randint(1, 120)) + r.choices(words[1 - i % 2], k=r.randint(0, 2)))) for i in range(600)]


def test_shards_are_joined_by_kind_and_search_equals_scoring_everything(spark, monkeypatch):
    docs = two_kinds() + [(600, None), (601, " ")]
    df = spark.createDataFrame([(d, t, None, None, 0) for d, t in docs], DOC).repartition(4)
    index = top_k.index_rows(df.select(F.col("doc_id").alias("d"), F.col("text").alias("t")), "bigint").withColumn("shard", F.monotonically_increasing_id())
    seen = np.concatenate([np.frombuffer(x.seen, np.float32).reshape(-1, top_k.PLACES) for x in index.collect()])
    kinds = top_k.centres(seen, 2)
    held = [[i % 2 for i in x.ids] for x in top_k.joined_shards(index, kinds, np.array([0.5, 0.5]), 2, "bigint").collect()]
    assert sum(map(len, held)) == 600 and len(held) == 2
    assert all(min(sum(x), len(x) - sum(x)) < 0.1 * len(x) for x in held)  # a word of the other kind may decide for a document of one word
    monkeypatch.setattr(top_k, "JOINED", 4000)  # several kinds
    asked = [(d, t) for d, t in docs if d % 20 == 0] + [(1000, docs[0][1] + " " + docs[1][1])]
    got = {}
    for x in top_k.search(spark, df, spark.createDataFrame(asked, "query_id long, query string"), k=7).orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append(x.doc_id)
    for q, text in asked:
        assert got.get(q, []) == [d for _, d in bm25_by_hand(docs, text, 7)], q


def test_a_low_score_so_far_lets_few_documents_through():
    total = np.random.default_rng(1).random(6400).astype(np.float32) * 100 + 1
    near = top_k.Shard().near(total, 10, 0.5)
    assert len(near) <= 20 and set(np.argsort(-total)[:10]) <= set(near.tolist())


def test_sums_of_postings_are_off_by_no_more_than_said():
    docs = two_kinds()
    shard = top_k.Shard(len(docs), 50.0)
    for d, t in docs:
        shard.add(d, t)
    shard.finish()
    shard.lay_out()
    r = np.random.default_rng(2)
    unit = r.random(len(shard.terms)) * 9 + 0.1
    shard.weigh(np.arange(len(unit)), unit)
    for _ in range(20):
        rows = np.sort(r.choice(len(unit), 60, replace=False))
        weights = unit[rows] * r.choice([1, 1, 1, 2, 7], 60)
        total = np.zeros(shard.width)
        off = shard.add_postings(total, rows, weights)[-1]
        want = np.zeros(shard.width)
        for row, weight in zip(rows, weights):
            own = slice(shard.starts[row], shard.starts[row + 1])
            want[shard.docs[own]] += shard.scores[own] * weight
        assert want.any() and np.abs(total - want).max() <= off < 0.01 * want.max()


def test_jobs_of_a_search_do_not_grow_with_its_blocks(spark, monkeypatch):
    docs, asked = search_case()
    df = spark.createDataFrame([(d, t, None, None, 0) for d, t in docs], DOC).repartition(3)
    asked = spark.createDataFrame([(q, t) for q, t in asked], "query_id long, query string").withColumn("query_id", F.col("query_id").cast("decimal(20,2)"))
    want = sorted(map(tuple, top_k.search(spark, df, asked, k=4).collect()))  # query ids of any type
    assert want
    monkeypatch.setattr(top_k, "TERM_BLOCK", 3)
    spark.sparkContext.setJobGroup("blocks", "")
    found = top_k.search(spark, df, asked.repartition(20), k=4).collect()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("blocks")
    spark.sparkContext.setJobGroup("", "")
    assert sorted(map(tuple, found)) == want and len(jobs) < 40


def test_registered_search_asks_every_twentieth_document(spark):
    from tessera.llm.queries import QUERIES
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = QUERIES["op5_bm25_documents"](spark, "/root/testdata/sf0.001")
    want = {r.doc_id for r in docs.where("doc_id % 20 = 0").collect() if top_k.terms_of(r.text)}
    assert want and {r.query_id for r in found.collect()} == want


def test_keep_times_keeps_columns_and_repeats(odd):
    n = F.when(F.col("doc_id") == 2, 2).when(F.col("doc_id").isin(3, 5), 0).otherwise(1)
    verdict = odd.select("doc_id", F.xxhash64("text").alias("text_hash"), n.alias("copies"))
    kept = rows.keep_times(odd, verdict, "copies")
    assert kept.columns == odd.columns
    want = Counter(odd.select("doc_id", "text").collect())
    for key in list(want):
        want[key] *= 2 if key.doc_id == 2 else 0 if key.doc_id in (3, 5) else 1  # a repeated row: the sum of its times
    assert Counter(kept.select("doc_id", "text").collect()) == +want


def test_digests_of_queries_follow_the_operator(spark):
    from tessera.llm.queries import QUERIES
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in QUERIES["op8_repeats"](spark, "/root/testdata/sf0.001").where("n_removed = 0").collect():
        assert r.kept_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()
