"""Sharding by a two-pass external shuffle.

Pass one scatters the rows uniformly by seeded hashes: an id's hash, by jump consistent hashing,
tells its shard, and a hash of id and text its memory-sized bucket within the shard. Pass two
shuffles each bucket by Fisher-Yates with a generator seeded by the bucket, and writes it. The shard
depends on the id and the number of shards alone (law "key"): one more shard takes rows only into
itself. Where a bucket begins in its shard comes as a row of its own, before the bucket's rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from contactmill.llm.textkernel import mix
from contactmill.session import bounded_batches, broadcast_if_small, materialise

U64 = np.uint64
SHARDS = 40
SEED = 20_240_229
#: Bytes of a bucket, so that one fits in a task's memory many times over.
BUCKET_BYTES = 8 << 20
#: Added to a text's bytes for what a row takes besides.
ROW_BYTES = 16
LAW = "key"
#: Rows with one id and text that are dealt to a bucket together; where there are more, they are
#: dealt to several.
TOGETHER = 500
_NULL_ID = -(2**63)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Jump consistent hashing (Lamping and Veach) of uint64 keys to 0..shards-1."""
    keys = keys.copy()
    shard = np.full(len(keys), -1, np.int64)
    jump = np.zeros(len(keys), np.int64)
    live = np.arange(len(keys))
    while len(live):
        shard[live] = jump[live]
        keys[live] = keys[live] * U64(2862933555777941757) + U64(1)
        jump[live] = ((shard[live] + 1) * (2.0**31 / ((keys[live] >> U64(33)) + U64(1)))).astype(np.int64)
        live = live[jump[live] < shards]
    return shard


def _hashes(ids: pa.Array, seed: int) -> np.ndarray:
    values = ids.to_numpy().view(U64)
    return mix(mix(values + U64(0x9E3779B97F4A7C15)) ^ mix(np.array([seed], U64)))


def scatter(rows: DataFrame, shards: int, seed: int, buckets: int) -> DataFrame:
    """Pass one: rows (id, key, salt and others) with shard, grown_shard and bucket. Only ids go to Python."""

    @F.pandas_udf("shard int, grown_shard int")
    def place(ids: pd.Series) -> pd.DataFrame:
        keys = _hashes(pa.array(ids, pa.int64(), from_pandas=True), seed)
        return pd.DataFrame({"shard": jump_hash(keys, shards), "grown_shard": jump_hash(keys, shards + 1)}).astype("int32")

    rows = rows.withColumn("place", place("id"))
    bucket = F.pmod(F.xxhash64(F.lit(seed), "key", "salt"), F.lit(buckets)).cast("int")
    return rows.withColumns({"shard": F.col("place.shard"), "grown_shard": F.col("place.grown_shard"), "bucket": bucket})


def _fisher_yates(seed: int):
    """Rows (row, shard, grown_shard, bucket, begin) sorted by bucket, each bucket led by a row that
    has its begin -> (row, shard, grown_shard, slot), each bucket shuffled."""

    def flush(parts: list[pa.RecordBatch], now: tuple[int, int], begin: int):
        table = pa.Table.from_batches(parts)
        order = np.arange(table.num_rows)
        np.random.default_rng([seed, *now]).shuffle(order)  # Fisher-Yates
        table = table.select([0, 1, 2]).take(pa.array(order))
        table = table.append_column("slot", pa.array(begin + np.arange(table.num_rows), pa.int64()))
        return table.combine_chunks().to_batches()

    def run(batches):
        held, now, begin = [], None, 0
        for batch in batches:
            begins = batch.column(4)
            leads = np.flatnonzero(begins.is_valid().to_numpy(zero_copy_only=False)).tolist()
            for a, b in zip([None, *leads], [*leads, batch.num_rows]):
                if a is not None:
                    if held:
                        yield from flush(held, now, begin)
                    held, now = [], (batch.column(1)[a].as_py(), batch.column(3)[a].as_py())
                    begin = begins[a].as_py()
                first = 0 if a is None else a + 1
                if first < b:
                    held.append(batch.slice(first, b - first))
        if held:
            yield from flush(held, now, begin)

    return run


def external_shuffle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """All columns of docs, and shard, grown_shard (with one more shard) and slot.

    slot counts gaplessly from 0 within a shard: a bucket's offset and the place in the shuffled
    bucket. Equal ids go to the same shard, but to its buckets by their texts; rows that repeat an
    id and a text more than TOGETHER times are dealt to many buckets, so that no bucket grows with
    the repeats of one row. A null id is one more id. Null texts are kept. Rows that are repeated
    keep their number. Columns of docs called shard, grown_shard or slot are replaced, others may
    have any name. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    own = [c for c in docs.columns if c.lower() not in ("shard", "grown_shard", "slot")]
    sized = docs.agg(F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)) + ROW_BYTES).alias("b")).first()["b"] or 0
    buckets = max(1, -(-sized // (shards * bucket_bytes)))
    # a null id is dealt out as the least number there is, which is an id like any other
    number = F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID))
    key = F.xxhash64(F.lit(seed), number, F.col(text_col))
    # columns of docs stay in a struct, so that their names meet no other
    rows = docs.select(F.struct(*own).alias("row"), number.alias("id"), key.alias("key"), F.lit(0).cast("long").alias("salt"))

    often = rows.groupBy("key").count().where(F.col("count") > TOGETHER).select("key")
    often, _ = materialise(often, "often")
    n = often.count()
    if n:
        # equal rows are counted, and their copies made again, each with its own salt: however a task
        # is repeated, the same copies go to the same buckets
        often = broadcast_if_small(often, n, 32)
        copies = rows.join(often, "key", "left_semi").groupBy("row", "id", "key").count()
        copies = copies.select("row", "id", "key", F.explode(F.sequence(F.lit(1), F.col("count"))).alias("copy"))
        copies = copies.select("row", "id", "key", F.floor(F.col("copy") / TOGETHER).alias("salt"))
        rows = rows.join(often, "key", "left_anti").select("row", "id", "key", "salt").unionByName(copies)

    dealt = scatter(rows, shards, seed, buckets)
    # where each bucket begins in its shard: one row for each bucket
    counts = scatter(rows.select("id", "key", "salt"), shards, seed, buckets).groupBy("shard", "bucket").count()
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("shard", "bucket", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("begin"))
    kind = dealt.schema["row"].dataType
    dealt = dealt.select("row", "shard", "grown_shard", "bucket", F.lit(None).cast("long").alias("begin"), "key").union(
        begins.select(F.lit(None).cast(kind), "shard", F.lit(None).cast("int"), "bucket", "begin", F.lit(None).cast("long"))
    )
    tasks = min(shards * buckets, 100_000)
    dealt = dealt.repartition(tasks, "shard", "bucket").sortWithinPartitions(
        "shard", "bucket", F.col("begin").isNull(), "key"
    )
    fields = [("row", kind), ("shard", IntegerType()), ("grown_shard", IntegerType()), ("slot", LongType())]
    shuffled = dealt.select("row", "shard", "grown_shard", "bucket", "begin").mapInArrow(
        _fisher_yates(seed), StructType([StructField(*f) for f in fields])
    )
    return shuffled.select(*[F.col("row")[c].alias(c) for c in own], "shard", "grown_shard", "slot")


def write_shards(shuffled: DataFrame, path: str) -> None:
    """Write the rows to folders shard=<n> of Parquet files: each task writes the buckets it shuffled,
    in order of slot, so that no shard is ever gathered in one task."""
    shuffled.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
