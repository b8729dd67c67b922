"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch holds the k least 64-bit hashes of a text's distinct shingles. Sketches of parts merge to
the sketch of the whole; two sketches estimate resemblance, containment and, each alone, the number
of distinct shingles. The string form is "<k>:" and the base64 of the ascending hashes, big-endian;
equal texts have equal strings, and a text without words has an empty sketch.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contactmill.llm import textkernel as K
from contactmill.session import bounded_batches, broadcast_if_small, shuffle_partitions

U64 = np.uint64
SIZE = 256
SHINGLE = 5
#: Text that one range of ids is meant to hold; with more than MOST_RANGES of them ranges get
#: larger instead. A range is sorted by Spark, which spills, and read in slices.
RANGE_BYTES = 64 << 20
MOST_RANGES = 20_000
#: Places where the parts of a key meet before they are one.
SALTS = 32
_LOWEST = -(2**63)


def encode(values: np.ndarray, k: int) -> str:
    return f"{k}:" + base64.b64encode(values.astype(">u8").tobytes()).decode()


def decode(text: str) -> tuple[np.ndarray, int]:
    """(ascending hashes, k) of a fingerprint string."""
    k, _, body = text.partition(":")
    return np.frombuffer(base64.b64decode(body), ">u8").astype(U64), int(k)


def merge(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    """The sketch of the union of what a and b are sketches of."""
    return np.union1d(a, b)[:k]


def distinct_estimate(a: np.ndarray, k: int) -> float:
    """Distinct shingles: exact below k, else (k - 1) over the k-th hash as a share of 2**64."""
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[k - 1]) + 1) / 2.0**64)


def resemblance(a: np.ndarray, b: np.ndarray, k: int) -> float:
    """Estimated Jaccard similarity; two empty sketches are alike, an empty and another are not."""
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    both = np.concatenate([a, b])
    both.sort()
    new = np.ones(len(both), bool)
    new[1:] = both[1:] != both[:-1]
    cut = both[new][:k][-1]
    union = min(int(new.sum()), k)
    return int(np.count_nonzero(~new & (both <= cut))) / union


def containment(a: np.ndarray, b: np.ndarray, k: int) -> float:
    """Estimated share of a's shingles that b has too; an empty a is contained in anything."""
    if not len(a):
        return 1.0
    union = distinct_estimate(merge(a, b, k), k)
    return min(1.0, resemblance(a, b, k) * union / distinct_estimate(a, k))


def sketches(texts, k: int = SIZE, size: int = SHINGLE) -> list[np.ndarray]:
    """The sketch of every text of an Arrow column; null counts as empty."""
    out = []
    for _, _, sets, offsets in K.shingle_sets(texts, size):
        bounds = offsets.tolist()
        out += [sets[a : min(b, a + k)].copy() for a, b in zip(bounds, bounds[1:])]
    return out


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SIZE) -> DataFrame:
    """(id, fingerprint) for every row of docs.

    Null and empty texts and those without words get the empty sketch. Repeated rows are sketched
    each for itself, with equal results. A null id stays null. Extra columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            prints = [encode(s, k) for s in sketches(batch.column(1), k)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], ["id", "fingerprint"])

    return source.mapInArrow(run, f"id {kind}, fingerprint string").withColumnRenamed("id", id_col)


def _merged(batches):
    """Rows (key, fingerprint), those of a key one behind the other -> one row for each run."""
    now, held = None, None
    for batch in batches:
        keys, prints = [], []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            values, k = decode(text)
            if held is None or key != now:
                if held is not None:
                    keys.append(now)
                    prints.append(encode(*held))
                now, held = key, (values, k)
            else:
                k = min(k, held[1])
                held = merge(held[0], values, k), k
        yield pa.RecordBatch.from_arrays([pa.array(keys, batch.schema[0].type), pa.array(prints, pa.string())], ["key", "print"])
        last = batch.schema[0].type
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], last), pa.array([encode(*held)], pa.string())], ["key", "print"])


def merge_fingerprints(
    prints: DataFrame, key_col: str = "doc_id", fingerprint_col: str = "fingerprint", salts: int = SALTS
) -> DataFrame:
    """(key, fingerprint): for each key the fingerprint of all its parts together.

    Parts are merged where they are, then in `salts` places for each key, then per key, so that a key
    with very many parts is never in one task; tasks hold one sketch at a time. Parts of unlike sizes
    k merge to the least of them. A null fingerprint is passed over, a null key is a key like others.
    Repeated rows change nothing; extra columns are ignored; an empty table gives an empty result.
    """
    bounded_batches(prints.sparkSession)
    rows = prints.select(F.col(key_col).alias("key"), F.col(fingerprint_col).alias("print")).where("print is not null")
    schema = f"key {rows.schema['key'].dataType.simpleString()}, print string"
    rows = rows.sortWithinPartitions("key").mapInArrow(_merged, schema)
    salt = F.pmod(F.xxhash64("print"), F.lit(salts)).alias("salt")
    rows = rows.select("key", "print", salt)
    rows = rows.repartition("key", "salt").sortWithinPartitions("key").select("key", "print").mapInArrow(_merged, schema)
    rows = rows.repartition("key").sortWithinPartitions("key").mapInArrow(_merged, schema)
    return rows.select(F.col("key").alias(key_col), F.col("print").alias(fingerprint_col))


def edited(text: str, following: str) -> str:
    """text with its last floor(n / 3) code points replaced by the first as many of the following."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def _compare(k: int):
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        """rows: (id, text, sketch), one more than are returned; the last is only a next one."""
        texts = [edited(a[1], b[1]) for a, b in zip(rows, rows[1:])]
        changed = sketches(pa.array(texts, pa.large_string()), k)
        columns = [
            pa.array([r[0] for r in rows[:-1]], pa.int64()),
            pa.array([len(r[1]) for r in rows[:-1]], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts]),
            pa.array([encode(r[2], k) for r in rows[:-1]]),
            pa.array([encode(s, k) for s in changed]),
            pa.array([resemblance(r[2], s, k) for r, s in zip(rows, changed)], pa.float64()),
            pa.array([resemblance(a[2], b[2], k) for a, b in zip(rows, rows[1:])], pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches):
        pending, now = [], None
        for batch in batches:
            step = max(1, min(batch.num_rows, batch.num_rows * (8 << 20) // max(1, batch.nbytes)))
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                parts, halo, ids = (part.column(i).to_pylist() for i in (0, 1, 2))
                texts = ["" if t is None else t for t in part.column(3).to_pylist()]
                for p, h, i, t, s in zip(parts, halo, ids, texts, sketches(part.column(3), k)):
                    if p != now:
                        pending, now = [], p
                    pending.append((i, t, s))
                    if h:  # the last row of this part is the first of the next one
                        if len(pending) > 1:
                            yield out(pending)
                        pending = []
                if len(pending) > 1:
                    yield out(pending)
                    pending = pending[-1:]

    return run


def compare_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SIZE) -> DataFrame:
    """Each text's fingerprint beside that of its edited text and of the next document.

    Rows are in descending order of id, nulls last, then of text; the row after the last is the
    first. The order is cut into ranges of ids; each range gets one row more, the first of the next
    range, so that no task holds more than its range and nothing but the cuts reaches the driver.

    Null texts count as empty. Equal ids follow each other in order of text, null first. A single
    row is its own next one. Extra columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ranked = source.withColumn("rank", F.coalesce("id", F.lit(_LOWEST)))
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = min(MOST_RANGES, max(shuffle_partitions(spark), -(-total // RANGE_BYTES)))
    cuts = ranked.approxQuantile("rank", [i / parts for i in range(1, parts)], 0.2 / parts) if parts > 1 else []
    cuts = np.unique(np.array(cuts, float).astype(np.int64))

    @F.pandas_udf("int")
    def range_of(rank: pd.Series) -> pd.Series:
        return pd.Series(len(cuts) - np.searchsorted(cuts, rank.to_numpy(), side="right")).astype("int32")

    ranked = ranked.withColumn("part", range_of("rank"))

    first = ranked.groupBy("part").agg(F.max("rank").alias("rank"))
    around = Window.orderBy("part")  # one row for each range
    before = F.lag("part").over(around)
    first = first.select("part", "rank", before.alias("before"), F.max("part").over(Window.partitionBy()).alias("last"))
    first = first.select("rank", F.coalesce("before", "last").alias("to"))
    heads = ranked.join(broadcast_if_small(first, len(cuts) + 1, 32), "rank")
    # of equal ids the first text in order
    heads = heads.groupBy("to", "rank").agg(
        F.min_by(F.struct("id", "text"), F.struct(F.col("text").isNotNull(), F.coalesce("text", F.lit("")))).alias("r")
    )
    rows = ranked.select("part", F.lit(0).alias("halo"), "id", "text", "rank").union(
        heads.select(F.col("to").alias("part"), F.lit(1), "r.id", "r.text", "rank")
    )
    dealt = rows.repartition(parts, "part").sortWithinPartitions(
        "part", "halo", F.col("rank").desc(), F.col("text").asc_nulls_first()
    )
    out = dealt.select("part", "halo", "id", "text").mapInArrow(
        _compare(k),
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
    return out.withColumnRenamed("doc_id", id_col)
