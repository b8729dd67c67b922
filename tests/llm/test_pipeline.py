import re

from tokenizers import Tokenizer

import corpus_pipeline
from contactmill.llm import packing, pii, toxicity

TOKENS = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json").encode
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text.translate(AZ))
    return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(AZ))


def windows(text):
    ws = plain_words(text)
    return {tuple(ws[i : i + 10]) for i in range(max(1, len(ws) - 9))} if ws else set()


def test_against_brute_force(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    labels = spark.read.parquet(f"{tiny}/labels.parquet")
    chain = toxicity.train(docs, labels)
    toxic = {r["doc_id"] for r in toxicity.predict(docs, chain).where("is_toxic").collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] not in toxic}
    assert toxic

    sets = {d: shingles(t) for d, t in texts.items()}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    order = sorted(sets)
    for i, a in enumerate(order):
        for b in order[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    texts = {d: t for d, t in texts.items() if find(d) == d}

    items = [r["text"] for r in spark.read.parquet(f"{tiny}/benchmark.parquet").collect()]
    patterns = set().union(*map(windows, items))
    sizes = {len(p) for p in patterns}

    def leaks(text):
        ws = plain_words(text)
        return any(tuple(ws[i : i + n]) in patterns for n in sizes for i in range(len(ws) - n + 1))

    texts = {d: t for d, t in texts.items() if not leaks(t)}
    want = {d: pii.replace(t, {})[0] for d, t in texts.items()}

    rows = corpus_pipeline.run(spark, tiny).collect()
    assert {r["doc_id"]: r["text"] for r in rows} == want
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    batches = {}
    for r in rows:
        assert r["n_tokens"] == packing_tokens(r["text"]) <= r["boundary"]
        batches.setdefault(r["batch"], []).append(r["boundary"])
    assert all(sum(b) <= packing.BUDGET or len(b) == 1 for b in batches.values())


def packing_tokens(text):
    return len(TOKENS(text, add_special_tokens=False).ids) + 1


def test_stages(spark, tiny):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "ngram_jaccard_join", "benchmark_decontamination", "pii", "packing",
    ]
    docs = spark.read.parquet(f"{tiny}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tiny)
        assert docs.count() == 0
        if "batch" not in docs.columns:
            assert docs.columns == corpus_pipeline.COLUMNS


def test_copies_and_repeated_rows(spark):
    from contactmill.llm.ngram_join import one_of_each_group

    data = [(4, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (None, "A b c d e f"), (7, None), (7, None), (8, "")]
    kept = one_of_each_group(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept if r["doc_id"]) == [(2, "a b c d e f"), (7, None), (8, "")]
    assert len(kept) == 3
