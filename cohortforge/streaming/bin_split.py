"""Incremental hash-bin split as a Structured Streaming job.

The batch form reads a large event file in chunks and appends each chunk's
rows to one file per hash bin. As a stream, new input files are picked up
as they arrive (``maxFilesPerTrigger`` bounds a micro-batch, like a chunk),
every row gets its md5 bin, and the file sink appends to one folder per bin.
The sink's commit log plus the checkpoint make each input file land exactly
once, also after a failure and restart; headers never enter the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cohortforge.sources.io import lower_headers, with_hash_bin
from cohortforge.session import scratch_path


def stream_hash_bins(stream: DataFrame, key: str, bin_col: str = "bin_id", digits: int = 2) -> DataFrame:
    """Lower-case the headers and add the bin column (stateless, per row)."""
    return with_hash_bin(lower_headers(stream), key.lower(), bin_col, digits)


def batch_writer(out_path: str, key: str) -> Callable[[DataFrame, int], None]:
    """Writer of one micro-batch for ``foreachBatch``, idempotent by batch id.

    Rows go to ``bin_id=../batch_id=..``, and only the folders of this batch are
    overwritten: a batch that runs again after a failure replaces what it had
    written. They are rebalanced by bin first, which joins small bins into one task
    and cuts a large one (also of a single hot key) over several by size."""
    def write(batch: DataFrame, batch_id: int) -> None:
        binned = stream_hash_bins(batch, key).withColumn("batch_id", F.lit(batch_id).cast("long"))
        (binned.hint("rebalance", "bin_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bin_id", "batch_id").parquet(out_path))
    return write


def start_bin_split(spark: SparkSession, source: str, schema: StructType, out_path: str, key: str,
                    fmt: str = "csv", checkpoint: str | None = None, max_files_per_trigger: int = 1,
                    available_now: bool = True, transform: Callable[[DataFrame], DataFrame] | None = None,
                    options: dict | None = None, per_batch: bool = False) -> StreamingQuery:
    """Start the split: ``source`` folder (or glob) of ``fmt`` files with the
    given schema -> ``out_path`` partitioned by bin. ``available_now``
    processes what is there and stops (a bounded run); otherwise it keeps
    running. ``transform`` may derive columns before binning. The checkpoint
    defaults to a folder under the shared checkpoint directory.

    ``per_batch`` writes with :func:`batch_writer` instead of the file sink: the rows
    of a micro-batch are spread by the size of their bins, so one hot bin fills many
    tasks; ``read_bins`` reads the result as well (with ``batch_id``)."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        reader = reader.option("header", True).option("encoding", "ISO-8859-1")
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    stream = reader.format(fmt).load(source)
    if transform is not None:
        stream = transform(stream)
    place = checkpoint or scratch_path(spark, "stream-ckpt-" + out_path.strip("/").replace("/", "_").replace(":", "_"))
    if per_batch:
        writer = stream.writeStream.foreachBatch(batch_writer(out_path, key))
    else:
        binned = stream_hash_bins(stream, key).repartition("bin_id")  # one file per bin and micro-batch
        writer = binned.writeStream.format("parquet").outputMode("append").partitionBy("bin_id").option("path", out_path)
    writer = writer.option("checkpointLocation", place)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
