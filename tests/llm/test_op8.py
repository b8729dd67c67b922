import struct
import zlib

import numpy as np
import xxhash

from contactmill.llm import queries, shards


def jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


def test_query(spark, tiny):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    rows = queries.op8_sharding(spark, tiny).collect()
    assert len(rows) == len(texts)
    slots = {}
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 16, zlib.crc32(raw), "key")
        assert r["grown_shard"] in (r["shard"], 40)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_edges_and_whole_rows(spark):
    data = [(i % 50 if i else None, f"t{i}" if i % 3 else None, i, "s") for i in range(300)]
    df = spark.createDataFrame(data, "doc_id long, text string, extra long, shard string")
    out = shards.external_shuffle(df, shards=3, bucket_bytes=300).collect()
    assert sorted(r["extra"] for r in out) == list(range(300))
    home = {}
    for r in out:
        assert home.setdefault(r["doc_id"], r["shard"]) == r["shard"]
    for s in range(3):
        mine = sorted(r["slot"] for r in out if r["shard"] == s)
        assert mine == list(range(len(mine)))
    assert shards.external_shuffle(df.limit(0)).count() == 0


def chained(seed, *values):
    """Spark's hash of several values: each one's hash seeds the next."""
    h = 42 if seed is None else seed
    for v in values:
        if v is not None:
            raw = v.encode() if isinstance(v, str) else struct.pack("<i" if isinstance(v, np.int32) else "<q", v)
            h = xxhash.xxh64(raw, seed=h % 2**64).intdigest()
    return h - 2**64 if h >= 2**63 else h


def mixed(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 % 2**64
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB % 2**64
    return x ^ (x >> 31)


def test_against_brute_force(spark):
    """Shard, bucket and slot of every row, by a plain version of both passes."""
    texts = [(i * 37 - 500, None if i % 9 == 0 else "t" * (i % 40)) for i in range(400)]
    size, seed, n = 150, 11, 3
    total = sum(len(t or "") + 16 for _, t in texts)
    buckets = -(-total // (n * size))
    dealt = {}
    for i, t in texts:
        ident = mixed(mixed((i + 0x9E3779B97F4A7C15) % 2**64) ^ mixed(seed))
        key = chained(None, np.int32(seed), i, t)
        bucket = chained(None, np.int32(seed), key, 0) % buckets
        dealt.setdefault((jump(ident, n), bucket), []).append((key, i, jump(ident, n + 1)))
    want, filled = {}, {}
    for (shard, bucket), rows in sorted(dealt.items()):
        order = np.arange(len(rows))
        np.random.default_rng([seed, shard, bucket]).shuffle(order)
        for place, k in enumerate(order.tolist()):
            _, i, grown = sorted(rows)[k]
            want[i] = (shard, grown, filled.get(shard, 0) + place)
        filled[shard] = filled.get(shard, 0) + len(rows)
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(7)
    got = shards.external_shuffle(df, shards=n, seed=seed, bucket_bytes=size).collect()
    assert {r["doc_id"]: (r["shard"], r["grown_shard"], r["slot"]) for r in got} == want


def test_repeated_rows(spark, monkeypatch):
    """One row many times, and null ids with many texts, beside columns with internal names."""
    monkeypatch.setattr(shards, "TOGETHER", 20)
    data = [(None, f"t{i}", "k", i) for i in range(300)] + [(7, "same", "k", 1)] * 300 + [(7, "same", "k", 2)] * 300
    df = spark.createDataFrame(data, "doc_id long, text string, key string, begin int")
    out = shards.external_shuffle(df, shards=2, bucket_bytes=400)
    rows = out.collect()
    assert sorted(map(str, ((r["doc_id"], r["text"], r["key"], r["begin"]) for r in rows))) == sorted(map(str, data))
    for s in (0, 1):
        mine = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert mine == list(range(len(mine)))


def test_deterministic_order(spark):
    df = spark.range(500).selectExpr("id as doc_id", "concat('x', id) as text")
    a = {r["doc_id"]: (r["shard"], r["slot"]) for r in shards.external_shuffle(df).collect()}
    b = {r["doc_id"]: (r["shard"], r["slot"]) for r in shards.external_shuffle(df.repartition(5)).collect()}
    assert a == b


def test_jump_hash():
    keys = np.random.default_rng(1).integers(0, 2**64, 1000, dtype=np.uint64)
    assert shards.jump_hash(keys, 40).tolist() == [jump(int(k), 40) for k in keys]


def test_write(spark, tmp_path):
    df = spark.range(100).selectExpr("id as doc_id", "concat('x', id) as text")
    out = shards.external_shuffle(df, shards=4)
    shards.write_shards(out, str(tmp_path / "o"))
    back = spark.read.parquet(str(tmp_path / "o"))
    columns = ["doc_id", "text", "shard", "grown_shard", "slot"]
    assert sorted(map(tuple, back.select(columns).collect())) == sorted(map(tuple, out.select(columns).collect()))
