import hashlib

from pyspark.sql import functions as F

from tessera.operators.split import cut_keys, exact_hash_split, split_hash, stratified_split


def _brute(ids, fracs=(0.8, 0.1), names=("train", "val", "test"), seed=42):
    key = sorted((hashlib.md5(f"{i}:{seed}".encode()).hexdigest(), str(i)) for i in ids)
    n = len(key)
    cuts, c = [], 0
    for f in fracs:
        c += int(f * n)
        cuts.append(c)
    out = {}
    for r, (_, i) in enumerate(key):
        name = names[-1]
        for cut, nm in zip(cuts, names):
            if r < cut:
                name = nm
                break
        out[i] = name
    return out


def test_exact_split_equals_global_rank(spark):
    for n in (0, 1, 7, 10, 952, 3001):
        df = spark.range(n).select(F.col("id").cast("string").alias("id"))
        got = {r.id: r.split for r in exact_hash_split(df, "id").collect()}
        assert got == _brute([str(i) for i in range(n)])


def test_exact_split_sizes_952(spark):
    df = spark.range(952).select(F.col("id").cast("string").alias("id"))
    counts = {r.split: r["count"] for r in exact_hash_split(df, "id").groupBy("split").count().collect()}
    assert counts == {"train": 761, "val": 95, "test": 96}


def test_narrowing_over_many_prefixes_and_repeated_ids(spark):
    ids = [str(i % 700) for i in range(1500)]
    df = spark.createDataFrame([(i,) for i in ids], "id string").select(split_hash(F.col("id"), 42).alias("_h"), F.col("id").alias("_id"))
    keys = sorted((hashlib.md5(f"{i}:42".encode()).hexdigest(), i) for i in ids)
    ranks = [0, 1, 749, 1499, 1500]
    want = [keys[r] if r < len(keys) else None for r in ranks]
    for digits, listed in ((1, 3), (2, 1), (4, 4096)):
        assert cut_keys(df, lambda n: ranks, digits=digits, listed=listed)[()] == want


def test_split_independent_of_input_order(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("id"))
    a = {r.id: r.split for r in exact_hash_split(df, "id").collect()}
    b = {r.id: r.split for r in exact_hash_split(df.orderBy(F.rand(7)).repartition(5), "id").collect()}
    assert a == b


def test_stratified_split_exact_per_class(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"),
                                  (F.col("id") % 3).alias("cls"))
    s = stratified_split(df, "id", "cls", 0.2)
    got = {(r.cls, r.split): r["count"] for r in s.groupBy("cls", "split").count().collect()}
    for c, n in ((0, 334), (1, 333), (2, 333)):
        assert got[(c, "test")] == int(0.2 * n)
        assert got[(c, "train")] == n - int(0.2 * n)


def test_counts_of_a_split_in_one_pass(spark):
    """Rows per split without tagging them: equal to the tagged rows', repeated ids included."""
    from tessera.operators.split import split_counts
    ids = [f"r{i}" for i in range(3000)] + ["same"] * 40 + [f"r{i}" for i in range(25)]
    df = spark.createDataFrame([(i, "ab"[k % 2]) for k, i in enumerate(ids)], "id string, g string")
    tagged = exact_hash_split(df, "id", (0.9,), ("train", "val"))
    want = sorted(map(tuple, tagged.groupBy("g", "split").count().collect()))
    got = split_counts(df, "id", 0.9, ("train", "val"), ["g"], near=0.05)
    assert sorted(map(tuple, got.select("g", "split", "c").collect())) == want
    # all rows of one id: the cut is nowhere near its expected place, so they have to be tagged
    assert split_counts(df.where("id = 'same'"), "id", 0.9, ("train", "val"), ["g"]) is None
    assert split_counts(df.where("false"), "id", 0.9, ("train", "val"), ["g"]) is None


def test_tokens_are_hashed_once(spark, monkeypatch):
    """Word counts of the holdout come from one pass over the tokens."""
    from tessera.operators import ngram as N
    from tessera.operators import split as X
    words = ["alpha", "beta", "gamma", "delta"]
    corpus = spark.createDataFrame([("s", i, " ".join(words[(i * k) % 4] for k in range(40))) for i in range(200)], "source string, row_id long, text string")
    want = sorted(map(tuple, N.word_counts(N.holdout_split(N.occurrences(corpus)), ("source", "split")).collect()))
    monkeypatch.setattr(X.split_counts, "__defaults__", (*X.split_counts.__defaults__[:-1], 0.02))
    monkeypatch.setattr(N, "holdout_split", None)
    assert sorted(map(tuple, N.holdout_word_counts(N.occurrences(corpus), ("source", "split")).collect())) == want
