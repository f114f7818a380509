"""Starting the trip stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tripmill.session import pin_utc
from tripmill.sources.files import stream_trip_json
from tripmill.streaming.watermark import drop_copies_within

ADAPTIVE = "spark.sql.adaptive.enabled"
# State on local disks, with memory that does not grow with it; rows are not counted for metrics.
STATE = "spark.sql.streaming.stateStore"
STATE_ON_DISK = {
    f"{STATE}.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    f"{STATE}.rocksdb.boundedMemoryUsage": "true",
    f"{STATE}.rocksdb.trackTotalNumberOfRows": "false",
}


@contextmanager
def stateful(spark: SparkSession, partitions: int | None) -> Iterator[None]:
    """Settings for a stream with state that starts within; it keeps them when they are taken back.

    A session that names a state store keeps all of its settings of it, and a checkpoint has its store
    and the number of its partitions for good.
    """
    chosen = {} if spark.conf.get(f"{STATE}.providerClass", None) else {**STATE_ON_DISK}
    if partitions is not None:
        chosen["spark.sql.shuffle.partitions"] = str(partitions)
    before = {key: spark.conf.get(key, None) for key in chosen}
    for key, value in chosen.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def adaptive(sink: Callable[[DataFrame, int], None], wanted: str) -> Callable:
    """The sink under a setting of adaptive execution, for what it does with a batch alone.

    Spark turns adaptive execution off in streams that keep state, and without it writes are not
    rebalanced: every task writes a file of each date. The batch itself is planned before the sink
    gets it.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        conf = batch.sparkSession.conf
        own = conf.get(ADAPTIVE)
        conf.set(ADAPTIVE, wanted)
        try:
            sink(batch, batch_id)
        finally:
            conf.set(ADAPTIVE, own)

    return load


def start_trip_stream(
    spark: SparkSession,
    input_path: str,
    checkpoint_path: str,
    sink: Callable[[DataFrame, int], None],
    processing_time: str | None = "30 seconds",
    watermark_delay: str | None = None,
    state_partitions: int | None = None,
    **source_options,
) -> StreamingQuery:
    """Landed trip files through the sink.

    With a `processing_time` the stream runs until stopped; with None it takes everything that
    has landed, in batches bounded by the source options, and ends. Progress is kept in the
    checkpoint, so the next start goes on where this one ended. With a `watermark_delay` the stream
    keeps state, on local disks unless the session names a state store: in `state_partitions` parts
    of which each batch loads and stores every one, or as many as the session shuffles into.
    """
    spark = pin_utc(spark)
    raw = stream_trip_json(spark, input_path, **source_options)
    if watermark_delay is not None:
        raw = drop_copies_within(raw, watermark_delay)
    trigger = {"availableNow": True} if processing_time is None else {
        "processingTime": processing_time
    }
    writer = (
        raw.writeStream.foreachBatch(adaptive(sink, spark.conf.get(ADAPTIVE)))
        .option("checkpointLocation", checkpoint_path)
        .outputMode("append")
        .trigger(**trigger)
    )
    if watermark_delay is None:
        return writer.start()
    with stateful(spark, state_partitions):
        return writer.start()


def drain_trip_stream(
    spark: SparkSession,
    input_path: str,
    checkpoint_path: str,
    sink: Callable[[DataFrame, int], None],
    **options,
) -> None:
    """Load everything that has landed and return when it is in the tables."""
    query = start_trip_stream(
        spark, input_path, checkpoint_path, sink, processing_time=None, **options
    )
    query.awaitTermination()
