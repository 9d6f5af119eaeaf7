"""T5 (second half): per-micro-batch progress and error counts.

``start_counted`` runs a message stream in ``foreachBatch``: every batch's
parsed messages are written to its own folder, and one row of counts beside
them, to a folder of its own as well; a batch that is run again replaces both.
The counts are observed while the messages are written (``observe``), so each
message is read, parsed and counted in one pass.  The counts of the whole
stream are a sum over the rows, however many batches there were (the query's
own progress keeps only the last hundred).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.transforms import tag_malformed

COUNTS = "messages long, malformed long, abnormal long"


def counted_writer(path: str):
    """foreachBatch function: ``path/messages/batch_id=<n>`` and ``path/progress/batch_id=<n>``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        abnormal = ~F.col("malformed") & (F.col("data.is_abnormal") == F.lit(True))
        seen = Observation()
        tagged = tag_malformed(batch).observe(seen, F.count(F.lit(1)).alias("messages"), F.count_if("malformed").alias("malformed"),
                                              F.count_if(abnormal).alias("abnormal"))
        tagged.write.mode("overwrite").parquet(os.path.join(path, "messages", f"batch_id={batch_id}"))
        counts = seen.get
        (batch.sparkSession.createDataFrame([(counts["messages"], counts["malformed"], counts["abnormal"])], COUNTS).coalesce(1)
         .write.mode("overwrite").parquet(os.path.join(path, "progress", f"batch_id={batch_id}")))
    return write


def start_counted(messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    return (messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(counted_writer(path))
            .trigger(**(trigger or {"availableNow": True})).start())


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row of counts a batch, with its ``batch_id``."""
    return spark.read.schema(COUNTS + ", batch_id long").parquet(os.path.join(path, "progress"))
