import itertools
import random

from pyspark.sql import functions as F

from contactmill.llm import packing, queries


def padding(histogram, cuts):
    return sum((min(c for c in cuts if c >= n) - n) * k for n, k in histogram.items())


def test_optimal():
    rng = random.Random(3)
    for _ in range(150):
        histogram = {n: rng.randint(1, 9) for n in rng.sample(range(1, 40), rng.randint(1, 9))}
        k = rng.randint(1, 5)
        cuts, cost = packing.optimal_boundaries(histogram, k)
        top = max(histogram)
        best = min(
            padding(histogram, (*c, top))
            for size in range(min(k, len(histogram)))
            for c in itertools.combinations(sorted(histogram), size)
        )
        assert cost == best == padding(histogram, cuts) and len(cuts) <= k and cuts[-1] == top


def check(rows, budget):
    batches = {}
    for r in rows:
        assert r["n_tokens"] <= r["boundary"]
        batches.setdefault(r["batch"], []).append(r)
    for rs in batches.values():
        assert len({(r["bucket"], r["boundary"]) for r in rs}) == 1
        assert sorted(r["slot"] for r in rs) == list(range(len(rs)))
        assert len(rs) * rs[0]["boundary"] <= budget or len(rs) == 1
    by_bucket = {}
    for b, rs in batches.items():
        by_bucket.setdefault(rs[0]["bucket"], []).append(len(rs))
    for sizes in by_bucket.values():
        assert sum(1 for s in sizes if s < max(sizes)) <= 1  # one batch of a bucket is not full
    assert sorted(batches) == list(range(len(batches)))


def test_query(spark, tiny):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    rows = queries.op7_packing(spark, tiny).collect()
    from tokenizers import Tokenizer

    # another library's reading of the same vocabulary
    encode = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json").encode
    want = {d: len(encode(t or "", add_special_tokens=False).ids) + 1 for d, t in texts.items()}
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == want
    check(rows, packing.BUDGET)


def words(text):
    return (F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\S+")) + 1).cast("int")


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(packing, "NUMBERED", 7)
    rng = random.Random(1)
    data = [(rng.choice([None, 1, 2, i]), None if i % 11 == 0 else "w " * rng.randint(0, 60), "b") for i in range(200)]
    df = spark.createDataFrame(data + [(5, "same", "b")] * 60, "doc_id long, text string, bucket string")
    rows = packing.pack(df, tokens=words, budget=50, buckets=4).collect()
    assert len(rows) == 260 and any(r["n_tokens"] > 50 for r in rows)
    check(rows, 50)
    assert packing.pack(df.limit(0)).count() == 0


def test_tokens(spark):
    texts = [None, "", "hello world", "東京は日本の首都です" * 20, "a" * 5000, "<|endoftext|>"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r["doc_id"]: r["n_tokens"] for r in packing.with_lengths(df).collect()}
    assert found[0] == found[1] == 1 and found[2] == 3 and found[3] > 200 and found[4] < 5001 and found[5] > 2
