import hashlib
import random

from kontor.llm import fingerprints as FP


def test_edited_texts_and_their_likeness(corpus):
    key = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)
    rows = sorted(corpus.filter("doc_id <> 500 or doc_id is null").collect(), key=key, reverse=True)
    got = {r["doc_id"]: r for r in FP.edited_fingerprints(corpus.filter("doc_id <> 500 or doc_id is null")).collect()}
    assert len(got) == len(rows)
    for i, r in enumerate(rows):
        text, after = r["text"] or "", rows[(i + 1) % len(rows)]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + (after["text"] or "")[:cut]
        x, y = got[r["doc_id"]], got[after["doc_id"]]
        assert x["n_chars"] == len(text)
        assert x["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        same = [1 - bin(int(x["fingerprint"], 16) ^ int(z, 16)).count("1") / (4 * len(z))
                for z in (x["edited_fingerprint"], y["fingerprint"])]
        assert abs(x["near_edited"] - same[0]) < 1e-12 and abs(x["near_next"] - same[1]) < 1e-12
    texts = {}
    for r in rows:
        texts.setdefault(r["text"] or "", set()).add(got[r["doc_id"]]["fingerprint"])
    assert all(len(f) == 1 for f in texts.values())


def test_repeated_rows_keep_their_number_and_follow_each_other(corpus):
    out = FP.edited_fingerprints(corpus)
    assert out.count() == corpus.count()
    twice = out.filter("doc_id = 500").collect()
    assert len(twice) == 2 and max(r["near_next"] for r in twice) == 1.0


def test_small_and_empty_tables(spark, empty):
    assert FP.edited_fingerprints(empty).count() == 0
    one = spark.createDataFrame([(1, "abc def")], "doc_id long, text string")
    r = FP.edited_fingerprints(one).first()
    assert r["near_next"] == 1.0 and r["edited_sha256"] == hashlib.sha256(b"abc dab").hexdigest()


def test_block_tables_find_every_pair_within_the_radius(spark):
    rng = random.Random(4)
    bits = FP.BITS
    base = [rng.getrandbits(bits) for _ in range(40)]
    near = [b ^ sum(1 << p for p in rng.sample(range(bits), rng.randint(0, 5))) for b in base for _ in range(4)]
    numbers = sorted(set(base + near))
    df = FP.from_numbers(spark, numbers)
    got = {(FP.to_number(r["query"]), FP.to_number(r["fp"]), r["distance"])
           for r in FP.within_radius(df, df, radius=3).collect()}
    want = {(a, b, bin(a ^ b).count("1")) for a in numbers for b in numbers if bin(a ^ b).count("1") <= 3}
    assert got == want


def test_native_plan(corpus):
    plan = FP.edited_fingerprints(corpus)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
