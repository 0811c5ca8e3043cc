import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.llm import bpe, exact_dedup, language, mixing, token_counts
from tessera.llm.exact_dedup import WHITE_SPACE

from odd_cases import DOC, odd_rows

PIECES = ["'s", "'t", "'re", "'ll", "'", " ", "  ", "\n", "\t", "\r\n", " ", " ", "　", "\x1c", "\x85", "\x0b",
          "é", "ñ", "漢", "🙂", "9", "²", "Ⅷ", "_", "-", "<|endoftext|>", "abc", "The", "S", "re", "́", "​", "﻿", "\0", "qz"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe.tokenizer_file())


def random_texts(n, seed=3):
    r = random.Random(seed)
    return ["".join(r.choice(PIECES) for _ in range(r.randint(0, 14))) for _ in range(n)]


def test_bpe_equals_the_library_and_round_trips(library):
    v = bpe.vocabulary(bpe.tokenizer_file())
    texts = random_texts(4000)
    flat, counts = v.encode_many(texts)
    at = 0
    for text, n in zip(texts, counts.tolist()):
        ids = flat[at:at + n].tolist()
        at += n
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)
        assert v.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_bpe_fragments_beyond_the_table_and_full_slots(library):
    v = bpe.Vocabulary(bpe.tokenizer_file())
    v.table.BITS = 3  # few slots: most fragments collide
    texts = [("x" * 40 + "=" * 50 + "word ") * 3, "a b c d e f g h i j k l m n o p q r s t u v w"]
    for text in texts * 2:
        assert v.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_certain_cuts_are_pairs_in_no_token():
    v = bpe.vocabulary(bpe.tokenizer_file())
    inside = {t[i:i + 2] for t in v.token_bytes for i in range(len(t) - 1)} - {b"<|", b"|e", b"t|", b"|>"}
    assert not any(v.certain_cut[p[0] << 8 | p[1]] for p in inside)
    assert v.certain_cut.sum() > 10_000


def test_bpe_columns_on_odd_rows(odd, empty, library):
    encoded = odd.select("text", bpe.encode(F.col("text")).alias("x"))
    for r in encoded.select("text", "x", bpe.decode(F.col("x")).alias("y")).collect():
        assert r.x == library.encode(r.text or "", add_special_tokens=False).ids and r.y == (r.text or "")
    assert empty.select(bpe.encode(F.col("text"))).count() == 0
    assert odd.limit(1).select(bpe.decode(F.lit(None).cast("array<int>")).alias("y")).first().y == ""


def normal(text):
    return (text or "").encode().translate(None, WHITE_SPACE)


def test_exact_dedup_equals_brute_force(odd):
    rows = [(d, t) for d, t, *_ in odd_rows()]
    groups = {}
    for d, t in rows:
        groups.setdefault(normal(t), []).append((-len(t or ""), d is None, d or 0))
    found = exact_dedup.dedup(odd).collect()
    assert Counter(r.doc_id for r in found) == Counter(d for d, _ in rows)
    by_sha = {hashlib.sha256(k).hexdigest(): v for k, v in groups.items()}
    kept = Counter()
    for r in found:
        group = by_sha[r.text_sha256]
        first = min(group)
        assert (r.group_size, r.keep_id) == (len(group), None if first[1] else first[2])
        kept[r.text_sha256] += r.kept
    assert set(kept) == set(by_sha) and set(kept.values()) == {1}


def test_exact_dedup_of_an_empty_table(empty):
    assert exact_dedup.dedup(empty).count() == 0


def test_chunks_follow_content_and_bounds():
    from tessera.llm.hashing import PolynomialHash
    r = random.Random(1)
    body = bytes(r.randrange(256) for _ in range(300_000))
    h = PolynomialHash()
    ends = exact_dedup.chunk_ends(body, h)
    sizes = [b - a for a, b in zip([0, *ends], ends)]
    assert ends[-1] == len(body) and max(sizes) <= exact_dedup.MAX_CHUNK and min(sizes[:-1]) >= exact_dedup.MIN_CHUNK
    chunks = {body[a:b] for a, b in zip([0, *ends], ends)}
    moved = b"some bytes before" + body
    ends2 = exact_dedup.chunk_ends(moved, h)
    again = {moved[a:b] for a, b in zip([0, *ends2], ends2)}
    assert len(chunks & again) > 0.9 * len(chunks)
    assert exact_dedup.chunk_ends(b"", h) == []


def test_unverified_fingerprints_fall_back_to_digests(spark):
    rows = [(1, 5, 1, b"A", [(7, 5, b"A")]), (2, 6, 1, b"B", [(7, 5, b"B")]), (3, 7, 1, b"C", [(8, 5, b"C")])]
    df = spark.createDataFrame(rows, "doc_id long, text_hash long, n_points int, sha256 binary, chunks array<struct<fp:long,size:int,sha256:binary>>")
    ids = {r.doc_id: tuple(tuple(x) for x in r.ids) for r in exact_dedup.with_identifiers(df).collect()}
    assert ids[1] != ids[2] and ids[3] == ((8, 5, bytearray()),)


def test_language_words_first_then_ngrams(spark):
    rows = [(i, t, lang, None, 0) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 30)]
    docs = spark.createDataFrame(rows, DOC)
    model = language.fit(docs)
    assert model.languages == ["de", "en"]
    assert model.predict("the dog")[0] == "en" and model.predict("DER HUND")[0] == "de"
    assert model.predict("hundekatze")[0] == "de"  # unseen word: n-grams decide
    assert model.predict("12 34 !!") == ("und", 0.0) and model.predict(None) == ("und", 0.0) and model.predict("") == ("und", 0.0)
    assert 0 < model.predict("zzz")[1] <= 1


def test_language_on_odd_rows_and_without_training(spark, odd, empty):
    model = language.fit(language.labelled(odd))
    found = odd.select("text", language.predict(spark, model, F.col("text")).alias("z")).collect()
    for r in found:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.z.lang_pred == "und") == (not letters) and 0 <= r.z.score <= 1
    nothing = language.fit(empty)
    assert odd.select(language.predict(spark, nothing, F.col("text")).alias("z")).where("z.lang_pred <> 'und'").count() == 0


def test_language_held_out_accuracy(spark):
    from tessera.llm.queries import QUERIES
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = QUERIES["op3_language_id"](spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert found.where("lang = lang_pred").count() >= 0.97 * found.count() > 0


def test_held_out_is_a_checksum_of_the_id(spark):
    import zlib
    df = spark.range(200).select(F.col("id").alias("doc_id")).withColumn("h", language.held_out())
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in df.collect())


def test_fit_budget_against_brute_force():
    import itertools

    import numpy as np
    r = random.Random(2)
    for _ in range(200):
        lengths = sorted(r.sample(range(1, 30), r.randint(1, 4)))
        counts = [r.randint(1, 3) for _ in lengths]
        total = sum(a * b for a, b in zip(lengths, counts))
        budget = r.randint(0, total + 5)
        take = mixing.fit_budget(np.array(lengths), np.array(counts), budget)
        assert all(0 <= t <= c for t, c in zip(take, counts))
        got = int((take * np.array(lengths)).sum())
        sums = {sum(a * b for a, b in zip(lengths, pick)) for pick in itertools.product(*[range(c + 1) for c in counts])}
        assert got <= budget and got in sums
        shared = [c * min(budget, total) // total for c in counts]  # the proportional part is fixed first
        rest = {sum(a * b for a, b in zip(lengths, pick)) for pick in itertools.product(*[range(s, c + 1) for s, c in zip(shared, counts)])}
        assert got == max(s for s in rest if s <= budget)


def targets_by_hand(sizes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] >= 3 * sizes[s]]
        if not above:
            return {**capped, **share}
        capped |= {s: 3.0 * sizes[s] for s in above}


def test_mixing_on_odd_rows(odd, empty):
    mixed = mixing.mix(odd).collect()
    assert len(mixed) == len(odd_rows())
    sizes = {}
    for _, text, _, source, _ in odd_rows():
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = targets_by_hand(sizes)
    for r in mixed:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r["size"]
    again = mixing.mix(odd).collect()
    assert Counter((r.doc_id, r.text_hash, r.taken) for r in mixed) == Counter((r.doc_id, r.text_hash, r.taken) for r in again)
    assert mixing.mix(empty).count() == 0


def test_mixing_meets_targets(spark):
    r = random.Random(4)
    rows = [(i, " ".join("w" for _ in range(r.randint(1, 40))), None, r.choice("aaaaab") + r.choice("xyz"), 0) for i in range(1500)]
    mixed = mixing.mix(spark.createDataFrame(rows, DOC))
    for s in mixed.groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("n")).collect():
        assert abs(s.t - s.n) <= 1


def test_token_counts_sum_and_rules(odd, empty, library):
    for rule in token_counts.RULES:
        found = token_counts.count_tokens(odd, fields=("source", "text"), rule=rule)
        total = sum(len(library.encode(f"{s or ''}\n{t or ''}", add_special_tokens=False).ids) for _, t, _, s, _ in odd_rows())
        assert abs(found.agg(F.sum("n_tokens")).first()[0] - total) < 1e-6
    assert token_counts.count_tokens(empty).count() == 0
    with pytest.raises(ValueError):
        token_counts.count_tokens(odd, rule="other")


def test_boundary_tokens_follow_the_rule():
    import numpy as np
    ends, borders = np.array([3, 8, 10]), np.array([4, 4, 7, 10])  # token 3..8 has 1, 0, 3 and 1 bytes in the sections
    assert token_counts.allocate(ends, borders, "first")[0].tolist() == [2, 0, 0, 1]
    assert token_counts.allocate(ends, borders, "largest")[0].tolist() == [1, 0, 1, 1]
    counts, crossing = token_counts.allocate(ends, borders, "share")
    assert np.allclose(counts, [1.2, 0, 0.6, 1.2]) and crossing.tolist() == [1, 0, 1, 1]
    assert token_counts.allocate(np.array([], int), borders, "share")[0].tolist() == [0, 0, 0, 0]


def test_sections_against_library_offsets(library):
    fields = [("title", "A réal títle"), ("text", "first line 漢字\n\nsecond 🙂 line")]
    joined, sections = token_counts.sections_of(fields, {"text"})
    assert joined == "A réal títle\nfirst line 漢字\n\nsecond 🙂 line"
    assert [s[0] for s in sections] == ["title", "text", "text", "text"] and sections[-1][2] == len(joined)
    v = bpe.vocabulary(bpe.tokenizer_file())
    assert [len(v.token_bytes[i]) for i in v.encode(joined)] and v.encode(joined) == library.encode(joined, add_special_tokens=False).ids
