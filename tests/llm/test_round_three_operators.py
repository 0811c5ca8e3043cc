import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import groupby

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import negatives, passages, prefix_trie
from tessera.llm.hashing import PolynomialHash
from tessera.llm.words import word_hashes

from odd_cases import CLASHES, DOC, odd_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TURN = "conv_id long, turn long, role string, text string"


# --- op11

def trie_by_hand(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v, key=lambda t: t[:2])] for c, v in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = tuple(own.get(c - int(np.fmod(c, 5)), [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    kids = Counter(p[:-1] for p in members if p)
    own_saved = {p: (len(m) - 1) * len(p[-1][1].encode()) if p else 0 for p, m in members.items()}
    leaves, saved = Counter(), Counter()
    for p in members:
        for d in range(len(p) + 1):
            saved[p[:d]] += own_saved[p]
            leaves[p[:d]] += not kids[p]
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(paths[c]) == len(p))))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def trie_of(spark, rows, **more):
    df = spark.createDataFrame(rows, TURN).select("*", *[F.lit("clash").alias(c) for c in CLASHES])
    base, shared = F.col("conv_id") - F.col("conv_id") % 5, (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")
    return Counter(tuple(r) for r in prefix_trie.conversation_trie(df, base, shared, 8, **more).collect())


def some_conversations(seed, n, words, most):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-20, 3 * n), n):
        for k in range(r.randint(0, most)):
            rows.append((c, k, r.choice(["user", "assistant"][:1 + k % 2]), r.choice(words)))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("piece_rows", [1, 3, 8192])
def test_trie_equals_counting_every_prefix(spark, piece_rows):
    rows = some_conversations(1, 60, ["a", "bb", "", "é"], 9)
    rows += some_conversations(2, 30, ["a"], 30)  # long common paths, prefixes of each other
    assert trie_of(spark, rows, piece_rows=piece_rows) == trie_by_hand(rows)


def test_trie_of_odd_rows(spark):
    rows = [(None, 0, "user", "x"), (1, None, None, None), (1, 0, "user", None), (1, 0, "user", None), (2, None, None, None), (5, 3, "user", "y" * 50_000),
            (6, 3, "user", "y" * 50_000), (7, 0, None, "z"), (-3, 1, "", ""), (10, 0, "a", "b:c"), (11, 0, "ab", ":c")]
    assert trie_of(spark, rows, piece_rows=2) == trie_by_hand(rows)
    assert trie_of(spark, [(None, None, None, None)]) == trie_of(spark, []) == Counter()


def test_equal_conversations_across_pieces(spark):
    rows = [(c, k, "user", f"t{k}") for c in range(0, 400, 5) for k in range(3)] + [(1001, 0, "user", "t0")]
    assert trie_of(spark, rows, piece_rows=7) == trie_by_hand(rows)


# --- op12

def mined_by_hand(rows, every=100):
    whole = []
    for i, vector, label in rows:
        if label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        whole.append((i, [int(np.floor(256 * float(x))) for x in vector], label))

    def order(x):
        return (-x[0], x[1] is None, x[1] or 0)
    out = []
    for a, (i, v, label) in enumerate(whole):
        if i is None or i % every:
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), j, other == label) for b, (j, w, other) in enumerate(whole) if b != a]
        for score, j, _ in sorted((s for s in scored if s[2]), key=order)[:5]:
            fits = sorted((s for s in scored if not s[2] and 80 * score <= 100 * s[0] <= 100 * score), key=order)[:5]
            out += [(i, j, rank, n, score, other) for rank, (other, n, _) in enumerate(fits, 1)]
    return Counter(out)


VECTOR = "vec_id long, embedding array<float>, label int"


def mined(spark, rows, **more):
    df = spark.createDataFrame(rows, VECTOR).select("*", *[F.lit("clash").alias(c) for c in (*CLASHES, "vector", "block", "anchor", "values", "group")])
    return Counter(tuple(r) for r in negatives.mine(df, **more).collect())


def test_negatives_equal_all_scores(spark):
    r = np.random.default_rng(3)
    rows = [(i, r.normal(0, 0.2, 6).round(2).tolist(), int(i % 3)) for i in range(300)]
    rows += [(1000 + i, rows[0][1], 1 + i % 2) for i in range(40)]  # one very common vector: ties
    assert mined(spark, rows, every=20) == mined_by_hand(rows, 20) != Counter()


def test_negatives_of_odd_rows(spark):
    v = [0.5, 0.25]
    rows = [(0, v, 1), (0, v, 1), (1, v, 1), (2, v, 2), (None, v, 2), (None, v, 1), (3, None, 1), (4, v, None), (5, [None, 0.5], 2), (6, [float("nan"), 1.0], 2),
            (7, [float("inf"), 1.0], 2), (8, [], 2), (100, [], 1), (9, [0.5], 2), (10, [0.5, 0.25, 3.0], 2), (200, [-0.5, -0.25], 1), (300, [0.0, 0.0], 3)]
    assert mined(spark, rows) == mined_by_hand(rows)
    assert mined(spark, []) == Counter()


@pytest.mark.parametrize("width,size", [(1, 3), (64, 200), (300, 2000), (700, 1 << 20)])
def test_residue_products_are_exact(width, size):
    r = np.random.default_rng(width)
    a, b = r.integers(-size, size + 1, (9, width)), r.integers(-size, size + 1, (50, width))
    a[0], b[0], b[1] = size, size, -size
    found = negatives.scores(negatives.Rows(a), negatives.Rows(b), slice(0, 50))
    assert (found == a @ b.T).all()
    assert len(negatives.moduli(64, 70_000)) == 2


# --- op13

def cut_by_hand(docs):
    """``n_words, n_removed, kept`` per row; rows with equal id and text are one document."""
    def order(d):
        return (d[0] is None, d[0] or 0)
    words = [WORD.findall(t or "") for _, t in docs]
    first = {}
    for k in sorted(range(len(docs)), key=lambda k: order(docs[k])):
        for j in range(len(words[k]) - 19):
            first.setdefault(tuple(words[k][j:j + 20]), (docs[k], j))
    out = []
    for (d, t), w in zip(docs, words):
        gone = set()
        for j in range(len(w) - 19):
            if first[tuple(w[j:j + 20])] != ((d, t), j):
                gone.update(range(j, j + 20))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return Counter(out)


def cut(df):
    return Counter((r.doc_id, r.n_words, sum(s.end - s.start for s in r.removed), r.kept) for r in passages.remove_passages(df).collect())


def some_documents(seed, n):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    shared = [[r.choice(words) for _ in range(r.randint(15, 70))] for _ in range(12)]
    docs = []
    for i in range(n):
        text = []
        for _ in range(r.randint(0, 5)):
            text += [r.choice(words) for _ in range(r.randint(0, 25))]
            passage = r.choice(shared)
            a = r.randint(0, 20)
            text += passage[a:a + r.randint(10, 60)]
        docs.append((i, r.choice([" ", "\n", " \t"]).join(text)))
    docs += [(n + k, docs[0][1]) for k in range(30)]
    docs += [(n + 40, "same " * 90), (n + 41, "a b " * 40)]
    return docs


def test_passages_equal_all_windows(spark):
    docs = some_documents(5, 120)
    df = spark.createDataFrame([(d, t, None, None, 0) for d, t in docs], DOC).select("*", *[F.lit("clash").alias(c) for c in (*CLASHES, "range", "runs", "starts")])
    found = cut(df)
    assert found == cut_by_hand(docs) and sum(x[2] * n for x, n in found.items()) > 2000


@pytest.mark.parametrize("kind", ["long", "int", "smallint", "string", "decimal(20,0)"])
def test_passages_of_odd_rows(spark, odd, kind):
    rows = [r for r in odd_rows() if r[:2] != (2, "the same id with another text, which is also a document of its own")]
    passage = " ".join(f"p{i}" for i in range(25))
    extra = [(20, "x " + passage, "en", "a", 1), (21, passage, "en", "a", 1), (None, passage + " y", "en", "a", 1)]
    df = spark.createDataFrame([*rows, *extra], DOC).withColumn("doc_id", F.col("doc_id").cast(kind))
    found = Counter()
    for (d, n, m, kept), times in cut(df).items():
        found[(None if d is None else int(d), n, m, kept)] += times
    assert found == cut_by_hand([(r[0], r[1]) for r in [*rows, *extra]])


def test_passages_of_nothing(spark, empty, odd):
    assert cut(empty) == Counter() and passages.remove_passages(odd).count() == len(odd_rows())


def in_process(docs, ranges, monkeypatch, slice_bits, windows):
    """The whole operator without Spark: exchanges are sorts."""
    monkeypatch.setattr(passages, "SLICE_BITS", slice_bits)
    monkeypatch.setattr(passages, "SLICE", 1 << slice_bits)
    monkeypatch.setattr(passages, "WINDOWS", windows)
    monkeypatch.setattr(passages, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("P", (), {"partitionId": lambda self: 1})())}))
    table = pa.table({"doc_id": pa.array([d for d, _ in docs], pa.int64()), "text": [t for _, t in docs], "text_hash": pa.array([hash(t) for _, t in docs], pa.int64())})

    def dealt(batches, *keys):
        t = pa.Table.from_batches(batches)
        return t.sort_by([(k, "ascending") for k in keys]).combine_chunks().to_batches(max_chunksize=3)
    probes = dealt(list(passages.probes(iter(table.to_batches(max_chunksize=40)), ranges, pa.int64())), "range")
    shared = dealt(list(passages.shared_probes(iter(probes), pa.int64())), "parcel")
    runs = defaultdict(list)
    for b in passages.runs(iter(shared), pa.int64()):
        for r in b.to_pylist():
            runs[r["doc_id"]].append(r["runs"])
    rows = [{**r, "runs": runs[r["doc_id"]]} for r in table.to_pylist() if r["doc_id"] in runs]
    kept = pa.Table.from_pylist(rows, pa.schema({**{f.name: f.type for f in table.schema}, "runs": pa.list_(pa.binary())}))
    sent = dealt(list(passages.windows(iter(kept.to_batches()), ranges, pa.int64())), "range")
    starts = defaultdict(list)
    back = dealt(list(passages.repeated_windows(iter(sent), pa.int64())), "parcel")
    for b in passages.repeats_of(iter(back), pa.int64()):
        for r in b.to_pylist():
            starts[r["doc_id"]].append(r["starts"])
    last = pa.table({"doc_id": table["doc_id"], "text": table["text"], "starts": pa.array([starts.get(d) for d, _ in docs], pa.list_(pa.binary()))})
    return Counter((r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["removed"]), r["kept"])
                   for b in passages.cut_words(iter(last.to_batches()), pa.int64()) for r in b.to_pylist())


@pytest.mark.parametrize("slice_bits,windows", [(6, 16), (9, 100), (20, 1 << 18)])
def test_passages_across_slices(monkeypatch, slice_bits, windows):
    docs = some_documents(7, 60)
    assert in_process(docs, 3, monkeypatch, slice_bits, windows) == cut_by_hand(docs)


def test_word_hashes_do_not_depend_on_place():
    texts = ["a bb ccc", None, "", "  bb\ta\x0bccc ", "é" * 10 + " a", "x y"]
    hashes, counts = word_hashes(texts, PolynomialHash())
    assert counts.tolist() == [3, 0, 0, 3, 2, 1]
    flat = [w for t in texts for w in WORD.findall(t or "")]
    assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))


# --- earlier operators: cases that failed once

@pytest.mark.parametrize("kind", ["int", "smallint", "long", "string", "decimal(20,0)"])
def test_repeats_with_any_type_of_id(spark, kind):
    from tessera.llm import repeats
    passage = "".join(f"p{i} " for i in range(60))
    rows = [(1, passage + "one"), (2, "two " + passage), (32767, passage), (None, "null " + passage), (3, "nothing")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("doc_id", F.col("doc_id").cast(kind))
    found = {None if r.doc_id is None else int(r.doc_id): sum(s.end - s.start for s in r.removed) for r in repeats.remove_repeats(df).collect()}
    whole = len(passage)
    assert found[1] == found[3] == 0 and found[2] >= whole - 1 and found[32767] == whole and found[None] >= whole - 1


def test_the_largest_id_is_not_null(spark):
    from tessera.llm import repeats
    text = "".join(f"t{i} " for i in range(60))
    df = spark.createDataFrame([((1 << 63) - 1, text), (None, text)], "doc_id long, text string")
    assert {r.doc_id is None: bool(r.removed) for r in repeats.remove_repeats(df).collect()} == {False: False, True: True}


def test_budgets_with_long_documents_are_met_within_one():
    from tessera.llm import mixing
    take = mixing.fit_budget(np.array([10, 200_000]), np.array([1, 50]), 1_000_000)
    assert take.tolist() == [0, 5]
    lengths, counts = np.arange(40_001, 40_011), np.ones(10, np.int64)
    assert mixing.fit_budget(lengths, counts, 39_000).sum() == 0
    for budget in (50_000, 55_000):
        assert (mixing.fit_budget(lengths, counts, budget) * lengths).sum() == 40_010
    assert (mixing.fit_budget(lengths, counts, 200_100) * lengths).sum() > 200_100 - 40_010


def test_budget_fitting_past_the_rest_against_brute_force():
    from itertools import product

    from tessera.llm import mixing
    r = random.Random(8)
    for _ in range(60):
        lengths = sorted(r.sample(range(1, 60), r.randint(1, 4)))
        counts = [r.randint(1, 4) for _ in lengths]
        total = sum(a * b for a, b in zip(lengths, counts))
        budget = r.randint(0, total - 1)
        take = mixing.fit_budget(np.array(lengths), np.array(counts), budget, rest=3)
        got = int((take * np.array(lengths)).sum())
        best = max(s for s in (sum(a * b for a, b in zip(lengths, pick)) for pick in product(*[range(c + 1) for c in counts])) if s <= budget)
        assert got <= budget and budget - got < max(1, budget - best + max(lengths)) and all(0 <= t <= c for t, c in zip(take, counts))
    # a large source of documents that occur once: which of them stay follows the seed, not the length
    lengths = np.arange(1000, 9000)
    take = mixing.fit_budget(lengths, np.ones(8000, np.int64), int(lengths.sum()) * 3 // 10)
    assert abs(int((take * lengths).sum()) - int(lengths.sum()) * 3 // 10) < 2
    assert 0.2 < take[:1000].mean() < 0.4 and 0.2 < take[-1000:].mean() < 0.4


def test_coarse_steps_stay_within_their_tables(monkeypatch):
    from tessera.llm import mixing
    monkeypatch.setattr(mixing, "TABLE_BYTES", 1 << 12)
    lengths = np.arange(100_000, 100_400)
    budget = 25_000_000
    take = mixing.fit_budget(lengths, np.ones(400, np.int64), budget)
    assert 0 <= budget - int((take * lengths).sum()) < 100_400


def test_a_language_of_a_few_long_texts_is_learnt(spark):
    from tessera.llm import language
    r = random.Random(3)
    short = [("aa", " ".join(r.choice(["kala", "mato", "riku", "sela"]) for _ in range(60))) for _ in range(300)]
    long = [("bb", " ".join(r.choice(["zug", "brunt", "oxly", "fenk"]) for _ in range(4000)) + f" q{i}") for i in range(5)]
    rows = spark.createDataFrame([*short, *long, *[long[0]] * 50], "lang string, text string")
    sample = language.training_sample(rows, "text", "lang", 20_000)
    chars = {x.lang: x.n for x in sample.groupBy("lang").agg(F.sum(F.length("text")).alias("n")).collect()}
    assert 10_000 < chars["bb"] < 40_000 and 10_000 < chars["aa"] < 40_000
    model = language.fit(rows, max_train_chars=20_000)
    assert model.predict("brunt zug fenk oxly zug")[0] == "bb" and model.predict("kala sela riku")[0] == "aa"


def test_unseen_words_are_remembered_within_bounds(spark, monkeypatch):
    from tessera.llm import language
    rows = spark.createDataFrame([("aa", "kala mato riku sela " * 20), ("bb", "zug brunt oxly fenk " * 20)], "lang string, text string")
    model = language.fit(rows)
    words = [f"kal{c}{d}" for c in "abcdefgh" for d in "xyzuvw"]
    want = sum(model.backed_off(w) for w in words)
    assert np.allclose(model.unseen(words), want)
    monkeypatch.setattr(language, "MEMO_WORDS", 5)
    model.scores, model.memo = None, {}
    assert np.allclose(model.unseen(words * 2), 2 * want) and len(model.memo) <= 5


def test_labels_beyond_the_bound_are_an_error(spark, monkeypatch):
    from tessera.llm import language
    monkeypatch.setattr(language, "MAX_LANGUAGES", 2)
    rows = spark.createDataFrame([(x, "some text") for x in "abc"], "lang string, text string")
    with pytest.raises(ValueError, match="more than 2 labels"):
        language.fit(rows)


@pytest.mark.parametrize("rule", ["largest", "first", "share"])
def test_window_counts_equal_library_offsets(spark, rule):
    """Every token by the library's offsets, character by character, over windows whose borders cut tokens."""
    from tokenizers import Tokenizer

    from tessera.llm import bpe, token_counts
    library = Tokenizer.from_file(bpe.tokenizer_file())
    r = random.Random(6)
    texts = [" ".join("".join(r.choices("abcdefghij", k=r.randint(1, 14))) for _ in range(r.randint(0, 60))) for _ in range(40)] + ["", "x" * 50]
    width, want, crossing = 7, {}, 0
    for d, text in enumerate(texts):
        for k in range(max(1, -(-len(text) // width))):
            want[d, k] = 0.0
        for a, b in library.encode(text, add_special_tokens=False).offsets:
            held = Counter(i // width for i in range(a, b))
            crossing += len(held) > 1
            if rule == "first":
                want[d, a // width] += 1
            elif rule == "largest":
                want[d, min(k for k in held if held[k] == max(held.values()))] += 1
            else:
                for k, n in held.items():
                    want[d, k] += n / (b - a)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = token_counts.count_tokens(df, fields=("text",), by_line=(), widths={"text": width}, rule=rule).collect()
    got = {(r.doc_id, r.section): r.n_tokens for r in found}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want) and crossing > 200
    assert sum(r.n_crossing for r in found) >= 2 * crossing
