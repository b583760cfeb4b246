"""Load payload files as they land, each file once.

The rows are those of the batch load. One call processes everything that has
arrived and stops; progress is kept in a folder all executors share, so a
restarted run continues where the last one ended. Every batch has a folder of its own in
the table (column ``batch``), which a batch repeated after a failure replaces, so each file counts once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..session import staged
from ..sources.payloads import CORRUPT, payload_schema, split_corrupt
from ..sources.tables import STAMP, run_stamp


def land_new_payloads(
    spark: SparkSession,
    path: str,
    schema: StructType,
    flatten: Callable[[DataFrame], DataFrame],
    table: str,
    quarantine: str,
    progress: str,
    run_time: datetime,
    parameters: Sequence[str] = ("brand_id",),
    endpoint: str = "",
) -> None:
    """Add the rows of payload files not seen before to ``table``, files that cannot be used to ``quarantine``.

    Naming the ``endpoint`` also sets incomplete documents aside, as the batch load does.
    """
    landed = (
        spark.readStream.schema(payload_schema(schema, parameters))
        .option("multiLine", True).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )

    def store(batch: DataFrame, number: int) -> None:
        good, bad = split_corrupt(staged(batch, "landed"), endpoint)
        for rows, path in ((flatten(good), table), (bad.select(*parameters, CORRUPT), quarantine)):
            rows.withColumn(STAMP, run_stamp(run_time)).write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = (
        landed.writeStream.foreachBatch(store).option("checkpointLocation", progress)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
