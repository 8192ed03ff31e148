"""Incremental matching: new S1 records against a static source (IO22, IO23)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from samefold.operators import blocking


def match_stream(spark, folder: str, schema: StructType, source: DataFrame, out: str, checkpoint: str, k=20, rules=blocking.V8, files_per_batch: int | None = None):
    """Candidates of each arriving file, appended once; restarts resume."""

    def each(batch: DataFrame, number: int) -> None:
        found = blocking.candidates(batch, source, rules, k)
        found.write.mode("overwrite").parquet(f"{out}/batch={number}")

    reader = spark.readStream.schema(schema)
    reader = reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader
    return reader.parquet(folder).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
