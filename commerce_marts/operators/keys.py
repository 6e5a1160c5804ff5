"""Dense surrogate keys and natural-key → surrogate-key lookups.

``ROW_NUMBER() OVER (ORDER BY natural_key)`` over a whole table is a global
window: Spark plans it as ``Exchange SinglePartition`` and numbers every row
in one task.  ``surrogate_key`` produces the identical numbering distributed:

1. range-partition the rows on the key into ``n`` buckets and sort inside
   each bucket;
2. tag every row with ``monotonically_increasing_id`` — by contract the
   partition index sits in the upper 31 bits and the row's position inside
   its partition in the lower 33 bits;
3. write that tagged frame once as a parquet table in the shared folder
   named by ``spark.checkpoint.dir`` and read it back, so the sampled range
   boundaries are fixed once (a re-evaluation could cut elsewhere) and a
   lost executor re-reads files instead of re-sampling;
4. count rows per bucket (``n`` rows), turn them into prefix offsets on that
   bounded frame and broadcast it back: key = offset + position + 1.

``n`` is ``num_buckets`` when given, else the shuffle partition count as
coalesced by AQE.  Only the ``n``-row offsets table is broadcast; its size is
the bucket count, not the data size.  The natural key must be unique (checked by the callers'
quality tests).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commerce_marts.session import scratch_path

_POS_BITS = 33


def surrogate_key(df: DataFrame, by: str | Sequence[str], key_name: str,
                  num_buckets: int | None = None) -> DataFrame:
    """Add ``key_name`` = dense 1-based rank of the unique key ``by``."""
    spark = df.sparkSession
    by = [by] if isinstance(by, str) else list(by)
    order = [F.col(c).asc_nulls_last() for c in by]
    path = scratch_path(spark, f"surrogate-{key_name}")
    # Without an explicit count AQE may coalesce *adjacent* range partitions to
    # its target size; partition indexes stay monotone in the key, so the
    # prefix offsets remain exact and the bucket count follows the data size.
    ranged = (df.repartitionByRange(num_buckets, *order) if num_buckets
              else df.repartitionByRange(*order))
    (ranged
     .sortWithinPartitions(*order)
     .withColumn("_sk_tag", F.monotonically_increasing_id())
     .write.parquet(path))
    tagged = spark.read.parquet(path)
    bucket = F.shiftright("_sk_tag", _POS_BITS)
    position = F.col("_sk_tag").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    sizes = tagged.groupBy(bucket.alias("_sk_bucket")).agg(F.count(F.lit(1)).alias("_sk_n"))
    before = Window.orderBy("_sk_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_sk_bucket", F.coalesce(F.sum("_sk_n").over(before), F.lit(0)).alias("_sk_offset"))
    out = (tagged.withColumn("_sk_bucket", bucket).withColumn("_sk_pos", position)
           .join(F.broadcast(offsets), "_sk_bucket")
           .withColumn(key_name, (F.col("_sk_offset") + F.col("_sk_pos") + 1).cast("long")))
    return out.select(key_name, *df.columns)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` for a join whose sides both grow with the data: it is shuffled, not broadcast.

    Spark goes by the size of compressed files where a side is a scan.  Sorted keys take a byte
    or two a row there and about a hundred as a relation, which the driver collects and builds."""
    return df.hint("merge")


def lookup_key(df: DataFrame, dim: DataFrame, natural: str | Sequence[str],
               key_name: str, how: str = "inner") -> DataFrame:
    """Replace-by-join: attach ``dim.key_name`` to ``df`` by the natural key."""
    natural = [natural] if isinstance(natural, str) else list(natural)
    return df.join(dim.select(*natural, key_name), natural, how)
