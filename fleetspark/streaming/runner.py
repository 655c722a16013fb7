"""Run a streaming query to completion over the files available now.

State and progress go to a checkpoint folder under the session's
``spark.checkpoint.dir`` (a shared folder on a cluster), so a restarted or
re-scheduled job resumes from its last committed batch after executor loss.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh folder name under the session's checkpoint folder (never reused)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "fleetspark", *parts, uuid.uuid4().hex)


def run_available_now(stream: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet",
                      output_mode: str = "append") -> None:
    """Process every file available at start, write ``stream`` to ``sink_path`` and stop."""
    q = (stream.writeStream.format(fmt).outputMode(output_mode)
         .option("path", sink_path).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
