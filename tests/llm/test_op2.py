import hashlib

import numpy as np

from contactmill.llm import fingerprints as fp
from contactmill.llm import queries


def words(text):
    return text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split()


def shingles(text):
    ws = words(text)
    return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def test_against_brute_force(spark, tiny):
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in queries.op2_document_fingerprints(spark, tiny).collect()}
    order = sorted(rows, reverse=True)
    assert sorted(got) == sorted(rows)
    errors = []
    for i, d in enumerate(order):
        after = rows[order[(i + 1) % len(order)]]
        cut = len(rows[d]) // 3
        changed = rows[d][: len(rows[d]) - cut] + after[:cut]
        r = got[d]
        assert r["n_chars"] == len(rows[d])
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        errors += [r["near_edited"] - jaccard(rows[d], changed), r["near_next"] - jaccard(rows[d], after)]
    assert np.abs(errors).max() < 0.15 and np.sqrt(np.mean(np.square(errors))) < 0.03
    by_text = {}
    for d, t in rows.items():
        assert by_text.setdefault(t, got[d]["fingerprint"]) == got[d]["fingerprint"]


def test_edges(spark):
    data = [(3, None, "x"), (3, "b", "x"), (None, "a b c d e f", "x"), (1, "", "x"), (1, "", "x"), (7, "ä" * 9, "x")]
    df = spark.createDataFrame(data, "doc_id long, text string, part string")
    rows = fp.compare_neighbours(df).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_chars"]) for r in rows) == [
        (False, 1, 0), (False, 1, 0), (False, 3, 0), (False, 3, 1), (False, 7, 9), (True, 0, 11),
    ]
    seven = next(r for r in rows if r["doc_id"] == 7)
    assert seven["edited_sha256"] == hashlib.sha256(("ä" * 6).encode()).hexdigest()  # the next text is null
    last = next(r for r in rows if r["doc_id"] is None)
    assert last["edited_sha256"] == hashlib.sha256("a b c d ääää"[:8].encode() + "äää".encode()).hexdigest()
    assert fp.compare_neighbours(df.limit(0)).count() == 0
    one = fp.compare_neighbours(df.where("doc_id = 7")).first()
    assert one["near_next"] == 1.0
    assert fp.fingerprint(df).where("fingerprint = '256:'").count() == 3


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(5)
    a, b = (np.unique(rng.integers(0, 2**64, 5000, dtype=np.uint64)) for _ in range(2))
    both = np.union1d(a, rng.permutation(b)[:2500])
    k = 512
    sa, sb, su = a[:k], both[:k], np.union1d(a, both)[:k]
    assert (fp.merge(sa, sb, k) == su).all()
    assert abs(fp.distinct_estimate(sb, k) / len(both) - 1) < 0.15
    assert abs(fp.resemblance(sa, sb, k) - len(a) / len(both)) < 0.08
    assert fp.containment(sa, sb, k) > 0.9
    values, size = fp.decode(fp.encode(sa, k))
    assert size == k and (values == sa).all()


def test_parts_merge_to_the_whole(spark):
    """Sketches of the parts of shingle sets, merged in any dealing, are those of the whole sets."""
    rng = np.random.default_rng(9)
    rows, want = [], {}
    for key in (None, 1, 2, 3):
        whole = np.unique(rng.integers(0, 2**64, 3000 if key == 1 else 40, dtype=np.uint64))
        want[key] = fp.encode(whole[:64], 64)
        for _ in range(200 if key == 1 else 3):
            rows.append((key, fp.encode(np.sort(rng.choice(whole, 30, False))[:64], 64), "x"))
        rows += [(key, fp.encode(part[:64], 64), "y") for part in np.array_split(whole, 5)]
    rows += [(2, None, "z"), (3, "64:", "z")]
    df = spark.createDataFrame(rows, "doc_id long, fingerprint string, salt string").repartition(5)
    got = {r["doc_id"]: r["fingerprint"] for r in fp.merge_fingerprints(df).collect()}
    assert got == want and fp.merge_fingerprints(df.limit(0)).count() == 0


def test_a_long_text_in_pieces():
    """Words of a text of several pieces, one of them longer than a piece."""
    import pyarrow as pa

    text = " ".join(["ab" * 700_000, *(f"w{i}" for i in range(300_000))])
    (sketch,) = fp.sketches(pa.array([text]))
    tail = fp.sketches(pa.array([" ".join(text.split()[1:])]))[0]
    assert len(sketch) == 256 and fp.resemblance(sketch, tail, 256) > 0.99
