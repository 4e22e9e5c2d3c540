"""Silver kept up by Structured Streaming: new bronze files name the hours to be rebuilt.

Exact deduplication is by hour, and a later file may replace an hour that is there already. So a micro-batch doesn't append its rows:
it replaces the hours that its files belong to, by the same function as the batch job. A micro-batch that is run again after a failure
does the same again, so files are seen at least once and their effect is exactly once.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..config import Config
from ..operators.silver import transform_hours


def start(spark: SparkSession, cfg: Config, checkpoint: str, available_now: bool = True, files_at_once: int = 64) -> StreamingQuery:
    """Follows bronze; with available_now the query ends when it has caught up. The stream itself reads file names only."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option("maxFilesPerTrigger", files_at_once).option("pathGlobFilter", "events.json.gz").load(f"{cfg.bronze}/date=*/hour=*")
    named = files.select(F.regexp_extract("path", r"date=(\d{4}-\d{2}-\d{2})/hour=(\d{2})/", 1).alias("date"), F.regexp_extract("path", r"hour=(\d{2})/", 1).alias("hour"))

    def rebuild(batch: DataFrame, _: int) -> None:
        hours = sorted(datetime.strptime(f"{r['date']} {r['hour']}", "%Y-%m-%d %H") for r in batch.distinct().collect() if r["date"])  # files_at_once rows at most
        if hours:
            transform_hours(spark, cfg, hours)

    writer = named.writeStream.foreachBatch(rebuild).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
