"""Sharding by extendible hashing.

A row's hash is a string of bits.  The directory starts as one bucket; a bucket whose rows exceed the byte limit
splits on its next bit, and only such buckets do, until every bucket fits or has a single row.  The bits are 64 of
the hash of key and text, then 64 of the hash of the row's number, so that even repeated rows can be told apart.

Sizes are counted ``BITS`` levels at a time: one grouped sum of a narrow table gives all buckets of the next
levels, and only rows of buckets that are still too large go on.  The directory is a table with a row per shard.

A row larger than the limit has a shard of its own.  Null keys and texts hash as nulls; a null text has no bytes.
An empty table has no shards.  Other columns are written along; a column named like an output is replaced.
Rows are numbered once and stored with their bits; the directory and the shards are made from that table, so
the input may come in another order when it is read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflight.llm.common import stored

SHARD_BYTES, BITS, ALL_BITS = 8 << 20, 10, 128
OUTPUTS = ("shard", "n_bytes", "shard_bytes", "shard_rows")


def bits(key: str, text: str) -> Column:
    """The bit string of a row."""
    def of(number: Column) -> Column:
        return F.lpad(F.bin(number), 64, "0")

    return F.concat(of(F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`"))),
                    of(F.xxhash64(F.monotonically_increasing_id())))


def directory(sized: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """Shards of a table of ``bits, n_bytes``: ``prefix, shard_bytes, shard_rows``, no prefix beginning another."""
    sums = (F.sum("n_bytes").alias("n_bytes"), F.sum("n_rows").alias("n_rows"))
    fits = (F.col("n_bytes") <= limit) | (F.col("n_rows") == 1)
    rows = sized.withColumn("n_rows", F.lit(1).cast("bigint"))
    top = rows.groupBy().agg(*sums).where("n_rows > 0").withColumn("prefix", F.lit(""))
    leaves = [top.where(fits).select("prefix", "n_bytes", "n_rows")]
    if not top.where(~fits).isEmpty():
        for base in range(0, ALL_BITS, BITS):
            end = min(base + BITS, ALL_BITS)
            lowest = rows.groupBy(F.substring("bits", 1, end).alias("low")).agg(*sums)
            levels = stored(lowest.select(F.explode(F.sequence(F.lit(base + 1), F.lit(end))).alias("depth"), "low", "n_bytes", "n_rows")
                            .groupBy("depth", F.expr("substring(low, 1, depth)").alias("prefix")).agg(*sums), "levels")
            full = levels.where(~fits)
            # A bucket is a shard if it fits and the bucket that it was split from does not; those of the
            # first level here were all split from buckets that do not.
            parents = full.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
            split = levels.withColumn("parent", F.expr("substring(prefix, 1, depth - 1)"))
            leaves.append(split.where(fits & (F.col("depth") == base + 1)).select("prefix", "n_bytes", "n_rows"))
            leaves.append(split.where(fits).join(parents, ["depth", "parent"], "left_semi").select("prefix", "n_bytes", "n_rows"))
            still = full.where(F.col("depth") == end).select(F.col("prefix").alias("still"))
            if end == ALL_BITS:
                leaves.append(full.where(F.col("depth") == end).select("prefix", "n_bytes", "n_rows"))
            if still.isEmpty():
                break
            rows = rows.join(still, F.substring("bits", 1, end) == still.still, "left_semi")
    found = leaves[0]
    for more in leaves[1:]:
        found = found.unionByName(more)
    return found.select("prefix", F.col("n_bytes").alias("shard_bytes"), F.col("n_rows").alias("shard_rows"))


def assign(rows: DataFrame, shards: DataFrame) -> DataFrame:
    """``rows`` (with ``bits``) with ``shard, shard_bytes, shard_rows``; ``shards`` is a stored directory.

    The directory is looked up by as many leading bits as about number its shards: shorter prefixes stand
    there under each of their continuations, longer ones under their beginning and are told apart after.
    """
    n = shards.count()
    slot = min(max(n, 1).bit_length() + 1, ALL_BITS)
    listed = shards.select("prefix", "shard_bytes", "shard_rows", F.explode(F.expr(
        f"""CASE WHEN length(prefix) >= {slot} THEN array(substring(prefix, 1, {slot}))
                 ELSE transform(sequence(0L, shiftleft(1L, {slot} - length(prefix)) - 1),
                                i -> concat(prefix, lpad(bin(i), {slot} - length(prefix), '0'))) END""")).alias("slot"))
    met = rows.withColumn("slot", F.substring("bits", 1, slot)).join(listed, "slot").where("startswith(bits, prefix)")
    return met.withColumn("shard", F.concat(F.lit("s"), "prefix")).drop("slot", "prefix")


def write_shards(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", limit: int = SHARD_BYTES) -> DataFrame:
    """Write ``docs`` below ``folder``, one directory per shard, and return the directory table."""
    kept = docs.drop(*OUTPUTS, "bits", "slot", "prefix")
    rows = stored(kept.withColumns({"bits": bits(key, text), "n_bytes": F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("bigint")}), "rows")
    shards = stored(directory(rows.select("bits", "n_bytes"), limit), "directory")
    placed = assign(rows, shards).drop("bits")
    # A shard fits its limit, so one task may write it whole; Spark deals the shards to tasks.
    placed.repartition("shard").write.option("compression", "zstd").partitionBy("shard").parquet(folder)
    return shards


def read_shards(docs: DataFrame, folder: str) -> DataFrame:
    """The rows of a folder that ``write_shards`` wrote for ``docs``."""
    fields = [f for f in docs.drop(*OUTPUTS, "bits", "slot", "prefix").schema.fields]
    fields += [T.StructField(c, T.LongType()) for c in ("n_bytes", "shard_bytes", "shard_rows")]
    fields.append(T.StructField("shard", T.StringType()))
    return docs.sparkSession.read.schema(T.StructType(fields)).parquet(folder)
