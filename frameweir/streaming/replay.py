"""Playing a table of records back as a stream with fixed micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from frameweir.schema import RECORD_SCHEMA
from frameweir.session import file_system, new_folder
from frameweir.sources.topics import read_topic_table


def replay(
    records: DataFrame,
    start: Callable[[DataFrame, str], DataStreamWriter],
    restarts: int = 1,
    after: Callable[[], object] | None = None,
) -> None:
    """Run a stream over `records`, one micro-batch per `batch_id`, in order.

    `start` makes the writer from the stream and its checkpoint folder. The
    records are landed once, a folder per batch, in as many files as the batch
    asks for. A folder comes into the stream's sight by being renamed, all files
    at once, so a batch may be of any size; that asks for a file system that
    renames folders in one step. One query runs over all batches, but for
    `restarts` from its checkpoint at even distances; `after` runs whenever it has
    been stopped.
    """
    spark = records.sparkSession
    waiting, seen = new_folder(spark, "records"), new_folder(spark, "landing")
    checkpoint = new_folder(spark, "checkpoint")
    names = RECORD_SCHEMA.fieldNames()
    # Dealt by the offset too: a file has one row group, and so one task that parses it.
    tasks = max(1, spark.sparkContext.defaultParallelism)
    sized = records.select("batch_id", *names, F.pmod("offset", F.lit(tasks)).alias("_slice"))
    sized = sized.hint("rebalance", "batch_id", "_slice").drop("_slice")
    sized.write.partitionBy("batch_id").parquet(waiting)
    system, place = file_system(spark, waiting)
    system.mkdirs(file_system(spark, f"{seen}/none")[1])
    folders = {int(x.getPath().getName()[9:]): x.getPath() for x in system.listStatus(place) if x.isDirectory()}
    order = sorted(folders)  # one name per micro-batch; a stream, too, handles them one after the other
    breaks = {len(order) * (k + 1) // (restarts + 1) for k in range(restarts)}
    query = None
    try:
        for done, batch in enumerate(order):
            if query is not None and done in breaks:
                query.stop()
                query = None
                if after:
                    after()
            if query is None:
                query = start(read_topic_table(spark, f"{seen}/*"), checkpoint).start()
            if not system.rename(folders[batch], file_system(spark, f"{seen}/batch-{batch}")[1]):
                raise RuntimeError(f"batch {batch} could not be moved into place")
            query.processAllAvailable()
    finally:
        if query is not None:
            query.stop()
    if after:
        after()
