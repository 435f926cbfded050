"""Chunked backfill as a stream: reads wait until the window of their chunk closes.

One log carries snapshot reads, live changes and the markers that open and close the window of a chunk.  Its
rows may arrive in any order, as they do from several partitions or files.  All rows are staged by chunk, in a fixed number of
folders, so that files do not multiply with the chunks.  A batch settles
every chunk it brings rows of, as soon as both edges of the window are known; when rows of a settled chunk arrive
later, the chunk is settled again from all its rows, and readers use its last settlement.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import hot_key_join

# Staging folders of a batch, and neighbouring chunks that share one: settling a chunk reads only its folder.
BUCKETS = 64
CHUNKS_PER_BUCKET = 64
KINDS = ("read", "live", "open", "close")


def settle_batch(
    batch: DataFrame,
    batch_id: int,
    staging: str,
    target: str,
    pk: Sequence[str],
    position: str = "lsn",
) -> None:
    """Stage one micro-batch, then write its live changes and the chunks it settles.

    All directories are per batch and replaced on a retry.  The windows to settle are written first: a table of one row per
    chunk, whose size Spark then knows, that meets reads and live changes without another pass over them.
    """
    spark = batch.sparkSession
    group = F.floor(F.col("chunk_id") / F.lit(CHUNKS_PER_BUCKET))
    placed = batch.withColumn("bucket", F.pmod(group, F.lit(BUCKETS)).cast("long"))
    placed.write.mode("overwrite").partitionBy("bucket").parquet(f"{staging}/batch_id={batch_id}")

    # From here on the staged files are read, so the source is read once per batch.
    staged = _staged(spark, staging, placed, batch_id)
    current = staged.where(F.col("batch_id") == batch_id)
    chunk = ["bucket", "chunk_id"]
    touched = current.select(*chunk).distinct()
    path = f"{target}/windows/batch_id={batch_id}"
    found = _closed(staged, position).join(touched, chunk, "left_semi")
    found.write.mode("overwrite").parquet(path)
    windows = spark.read.schema(found.schema).parquet(path)
    reads = staged.where(F.col("kind") == "read").join(windows, chunk)
    # A live change names the chunk of its key, so its chunk's window says whether it makes a read stale.
    live = staged.where(F.col("kind") == "live").select(*chunk, *pk, position).join(windows, chunk)
    stale = live.where(F.col(position).between(F.col("open_pos"), F.col("close_pos"))).select(*chunk, *pk).distinct()
    kept = reads.join(stale, [*chunk, *pk], "left_anti")
    settled = kept.withColumn(position, F.col("close_pos")).select(*batch.columns).drop("kind")
    settled.write.mode("overwrite").parquet(f"{target}/settled/batch_id={batch_id}")
    changes = current.where(F.col("kind") == "live").select(*batch.columns).drop("kind", "chunk_id")
    changes.write.mode("overwrite").parquet(f"{target}/live/batch_id={batch_id}")
    # Last, so that a chunk counts as settled by this batch once its reads are there.
    windows.select("chunk_id").write.mode("overwrite").parquet(f"{target}/versions/batch_id={batch_id}")


def _closed(staged: DataFrame, position: str) -> DataFrame:
    """Chunks of which both edges are known, with their positions."""

    def edge(kind, pick):
        return pick(F.when(F.col("kind") == kind, F.col(position)))

    edges = staged.where(F.col("kind").isin("open", "close")).groupBy("bucket", "chunk_id").agg(
        edge("open", F.min).alias("open_pos"), edge("close", F.max).alias("close_pos")
    )
    return edges.where("open_pos IS NOT NULL AND close_pos IS NOT NULL")


def backfilled(spark: SparkSession, target: str) -> DataFrame:
    """All live changes, and the reads of each chunk as its last batch settled them."""
    versions = spark.read.parquet(f"{target}/versions").groupBy("chunk_id").agg(F.max("batch_id").alias("batch_id"))
    settled = spark.read.parquet(f"{target}/settled")
    reads = hot_key_join(settled, versions, ["chunk_id", "batch_id"], "left_semi")
    live = spark.read.parquet(f"{target}/live").drop("batch_id")
    return live.unionByName(reads.select(*live.columns))


def _folders(spark: SparkSession, staging: str) -> tuple[int, list[int]]:
    """The last batch that has been trimmed (-1 if none) and the numbers of all folders to read."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{staging}/batch_id=*/_SUCCESS")
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getParent().getName() for f in system.globStatus(path) or []]
    numbers = [int(n.removeprefix("batch_id=")) for n in names]
    trimmed = max((-2 - n for n in numbers if n < 0), default=-1)
    return trimmed, [n for n in numbers if n > trimmed or n == -2 - trimmed and trimmed >= 0]


def _staged(spark: SparkSession, staging: str, placed: DataFrame, upto: int) -> DataFrame:
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema)
    _, numbers = _folders(spark, staging)
    paths = [f"{staging}/batch_id={n}" for n in numbers if n <= upto]
    return spark.read.schema(f"{fields}, batch_id bigint").option("basePath", staging).parquet(*paths)


def trim_staging(spark: SparkSession, staging: str, position: str = "lsn", upto: int | None = None) -> int:
    """Forget staged rows of chunks whose window is closed, and merge the rest of the batches up to ``upto``.

    Call it when no more rows of these chunks can arrive, that is, when all partitions of the log are past
    their windows.  Without it, staging grows by every batch.  Returns the last batch merged; folders of merged batches are no
    longer read and may be removed.
    """
    trimmed, numbers = _folders(spark, staging)
    last = max([n for n in numbers if n >= 0 and (upto is None or n <= upto)], default=trimmed)
    if last <= trimmed:
        return trimmed
    paths = [f"{staging}/batch_id={n}" for n in numbers if n <= last]
    staged = spark.read.option("basePath", staging).parquet(*paths).drop("batch_id")
    rest = hot_key_join(staged, _closed(staged, position), ["bucket", "chunk_id"], "left_anti")
    rest.write.mode("overwrite").partitionBy("bucket").parquet(f"{staging}/batch_id={-2 - last}")
    return last


def backfill_stream(
    log: DataFrame,
    staging: str,
    target: str,
    pk: Sequence[str],
    checkpoint: str,
    position: str = "lsn",
):
    """Run :func:`settle_batch` over a stream; returns the query.  :func:`backfilled` reads the result.

    ``log`` has kind (read, live, open, close), chunk_id, the key, the position and
    the row.  Live changes carry the chunk their key belongs to.
    """
    return (
        log.writeStream.foreachBatch(
            lambda batch, batch_id: settle_batch(batch, batch_id, staging, target, pk, position)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
