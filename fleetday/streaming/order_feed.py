"""The row-wise order feeds as an incremental stream over landed files.

The stream's checkpoint plays the part of the download window: each run takes the files that have
landed since the last one. An upsert repeated after a failure changes nothing, nor does an older file
that lands late: the newest export wins, whenever it comes. The delays rebuilt from trips are not here:
they need all rows of a file at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fleetday import schema as S
from fleetday.config import Config
from fleetday.plans.publish import merge_feed
from fleetday.sources.publication import Publication, read_published

_FEEDS = {S.ORDER_EVENTS: "cancels", S.ORDER_DELAYS: "late report", S.ORDER_KM: "kilometres"}


def run_feed(
    spark: SparkSession,
    table: str,
    landed: str,
    schema: T.StructType,
    root: str,
    checkpoint: str,
    cfg: Config,
) -> DataFrame | None:
    """Upsert what has landed in the Parquet folder `landed` into `table` and stop; returns the table."""
    feed = _FEEDS[table]

    def upsert(batch: DataFrame, _: int) -> None:
        publication = Publication(batch.sparkSession, root)
        merge_feed(publication, feed, batch, cfg)
        publication.commit()

    query = (
        spark.readStream.schema(schema)
        .parquet(landed)
        .writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return read_published(spark, root, table)
