"""Running a stream over what is available now, with Parquet sinks.

Output and progress go below the shared folder, so a lost executor costs a retry and
nothing else.
"""

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from callsift.sources.shared_dir import new_folder

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


_EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


@contextmanager
def _draining(spark: SparkSession):
    """Settings for streams that are started meanwhile and end with their input.

    State lives outside the JVM heap. Timers alone start no micro-batch, else a stream
    with timers never ends. A stream keeps the settings of its start; those of the
    session are put back.
    """
    wanted = {_STORE: _ROCKSDB, _EMPTY_BATCHES: "false"}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _drained(spark: SparkSession, writer: DataStreamWriter) -> StreamingQuery:
    with _draining(spark):
        query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def drain_to_parquet(stream: DataFrame, name: str) -> str:
    """Process all available input; returns the folder holding the output."""
    output = new_folder(stream.sparkSession, name)
    writer = (
        stream.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", f"{output}-progress")
        .outputMode("append")
    )
    _drained(stream.sparkSession, writer)
    return output


def drain_with_late(
    stream: DataFrame, name: str, output: str | None = None
) -> tuple[str, StreamingQuery]:
    """Process all available input, late rows to a folder of their own.

    Every micro-batch is one write to its own folder, which a repeated batch overwrites;
    the rows' ``late`` column deals them to ``late=true`` and ``late=false``. Given an
    ``output`` of an earlier call, the stream goes on from there.
    """
    output = output or new_folder(stream.sparkSession, name)

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").partitionBy("late").parquet(f"{output}/batch={number}")

    writer = stream.writeStream.foreachBatch(save).option(
        "checkpointLocation", f"{output}-progress"
    )
    query = _drained(stream.sparkSession, writer)
    return output, query


def metered(spark: SparkSession, output: str, late: bool) -> DataFrame:
    """Rows of ``drain_with_late``: the counted ones, or the late ones."""
    from callsift.streaming.meter import OUTPUT

    rows = spark.read.schema(f"batch long, {OUTPUT}").parquet(output)
    return rows.where(F.col("late") == late).drop("batch")
