import json
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import alias as A
from tessera.operators import runs as R
from tessera.operators import sketches as K
from tessera.sources import log_lines as G
from tessera.streaming import log_tail as S


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_one_large_file_is_numbered_by_several_tasks(spark, tmp_path, small_splits):
    r = random.Random(1)
    lines = [("x" * r.randint(0, 90)) for _ in range(3000)]
    (tmp_path / "big.log").write_text("\n".join(lines) + "\n")
    found = G.read_lines(spark, str(tmp_path / "big.log"))
    assert spark.read.text(str(tmp_path / "big.log")).rdd.getNumPartitions() > 8
    assert {x.line_no: x.line for x in found.collect()} == dict(enumerate(lines))


def test_numbers_run_on_over_segments(spark, tmp_path, small_splits):
    for name, text in (("a", "0\n\n2\n"), ("b", ""), ("c", "3\n4"), ("d", "5\n")):
        (tmp_path / f"{name}.log").write_text(text)
    assert sorted((x.line_no, x.line) for x in G.read_lines(spark, str(tmp_path)).collect()) == [(0, "0"), (1, ""), (2, "2"), (3, "3"), (4, "4"), (5, "5")]


def test_last_line_of_a_step_wins_across_splits(spark, tmp_path, small_splits):
    rows = [{"step": k % 50, "eval_loss": float(k)} for k in range(2000)] + [{"step": 50, "train_runtime": 3.0}, {"step": 1, "loss": 2.0}]
    (tmp_path / "run.jsonl").write_text("".join(json.dumps(x) + "\n" for x in rows))
    log = G.read_metrics(spark, str(tmp_path))
    assert {x.step: x.eval_loss for x in R.last_by_step(log, "eval", ["eval_loss"]).collect()} == {k: 1950.0 + k for k in range(50)}
    assert {x.kind: x["count"] for x in log.groupBy("kind").count().collect()} == {"eval": 2000, "summary": 1, "train": 1}


def test_any_cut_gives_the_same_lines():
    r = random.Random(4)
    text = "".join(f"line {k} é{'z' * r.randint(0, 30)}\n" for k in range(200)).encode()
    want = text.decode().split("\n")[:-1]
    for _ in range(40):
        cuts = sorted({0, len(text), *(r.randrange(len(text)) for _ in range(r.randint(0, 20)))})
        chunks = [(a, text[a:b]) for a, b in zip(cuts, cuts[1:])]
        chunks += [(a, text[a:a + r.randint(0, 400)]) for a in (r.randrange(len(text)) for _ in range(5))]
        r.shuffle(chunks)
        tail = S.Tail()
        found = [x for start, data in chunks for x in tail.add(start, data)]
        assert found == list(enumerate(want)) and tail.offset == len(text) and not tail.early


def test_tail_keeps_its_place_between_runs(spark, tmp_path):
    def send(*chunks):
        spark.createDataFrame([(f, s, bytearray(d)) for f, s, d in chunks], S.CHUNK).write.mode("append").parquet(f"{tmp_path}/chunks")
        out = S.tail_logs(spark, f"{tmp_path}/chunks", f"{tmp_path}/lines", f"{tmp_path}/ck")
        return sorted((x.file, x.line_no, x.line) for x in out.collect())
    assert send(("a", 0, b"one\ntw"), ("b", 4, b"later\n")) == [("a", 0, "one")]
    assert send(("a", 4, b"two"), ("a", 7, b"\n")) == [("a", 0, "one"), ("a", 1, "two")]
    assert send(("b", 0, b"b0 \n"), ("a", 0, b"one\n")) == [("a", 0, "one"), ("a", 1, "two"), ("b", 0, "b0 "), ("b", 1, "later")]


def test_alias_cells_have_the_given_shares():
    r = random.Random(2)
    for n in (1, 2, 7, 27):
        shares = [r.random() ** 3 + 1e-6 for _ in range(n)]
        symbols = [chr(97 + i) for i in range(n)]
        own, other = A.alias_cells(symbols, shares)
        mass = dict.fromkeys(symbols, 0.0)
        for s, o, x in zip(symbols, own, other):
            mass[s] += o / n
            mass[x] += (1 - o) / n
        assert all(abs(mass[s] - p / sum(shares)) < 1e-12 for s, p in zip(symbols, shares))


def test_sampled_words_follow_their_tables(spark):
    model = spark.createDataFrame([(".", "a", 1.0), ("a", "b", 0.25), ("a", ".", 0.75), ("b", "a", 1.0)], "x string, y string, p double")
    words = A.sampled_words(spark.range(4000).select(F.col("id").alias("sample_id"), F.lit(".").alias("seed_char")), A.alias_tables(model), max_len=6)
    rows = words.collect()
    assert {r.word for r in rows} <= {"a", "aba", "ababa", "ababab"} and all(r.ended == (len(r.word) < 6) for r in rows)
    assert abs(sum(r.word == "a" for r in rows) / 4000 - 0.75) < 0.03
    pairs = {(r.x, r.y): r.n for r in A.transitions(words).collect()}
    assert pairs[(".", "a")] == 4000 and pairs[("a", ".")] == sum(r.ended for r in rows)


def test_sketches_merge_to_the_ranks_of_all_values(spark, tmp_path):
    rows = spark.range(50_000).select((F.col("id") % 10).alias("d"), F.when(F.col("id") % 100 != 0, (F.col("id") * 7919 % 50_000).cast("double")).alias("v"))
    K.write_sketches(K.sketches_by(rows, F.col("d"), "v"), str(tmp_path))
    K.write_sketches(K.sketches_by(rows.where("d = 3"), F.col("d"), "v"), str(tmp_path))  # a day again
    stored = spark.read.parquet(str(tmp_path))
    values = sorted(r.v for r in rows.where("v is not null and d < 5").collect())
    found = K.merged_quantiles(stored.where("period < 5"), [0.05, 0.5, 0.95]).collect()
    assert {r.n for r in found} == {len(values)}
    import bisect
    assert all(abs(bisect.bisect(values, r.value) / len(values) - r.share) < 0.01 for r in found)


def test_tail_does_not_look_at_all_early_chunks():
    """Chunks before their turn: each is touched when it comes and when its turn is, and lines leave in large frames."""
    import pandas as pd

    class Watched(dict):
        seen = 0

        def __iter__(self):
            for x in super().__iter__():
                Watched.seen += 1
                yield x
    n = 2000
    tail = S.Tail(early=Watched({4 * n: b"abc\n"}))
    lines = [x for k in range(n - 1, -1, -1) for x in tail.add(4 * k, b"%03d\n" % (k % 1000))]
    assert [k for k, _ in lines] == list(range(n + 1)) and lines[-1][1] == "abc" and not tail.early
    assert Watched.seen < 3 * n

    class State:
        exists = False

        def update(self, value):
            self.value = value
    state = State()
    chunks = pd.DataFrame({"start": [4 * k for k in range(n)], "data": [b"%03d\n" % (k % 1000) for k in range(n)]})
    frames = list(S.follow(("f",), iter([chunks[::2], chunks[1::2]]), state))
    assert pd.concat(frames)["line_no"].tolist() == list(range(n)) and len(frames) == 1 and state.value[0] == 4 * n
