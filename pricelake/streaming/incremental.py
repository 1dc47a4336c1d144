"""The daily loads as an incremental run.

The landing zone is read as a file stream that handles what is new and stops. A new file may
belong to a date that was landed before, so each batch only names the dates it touched; those
dates are then loaded from the whole landing zone, which makes a replayed batch harmless.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.operators.lookup import lookup_join
from pricelake.sources.landing import read_documents


def touched(docs: DataFrame, batch: DataFrame) -> DataFrame:
    """All documents of the dates in ``batch``; the dates prune the folders that are read."""
    return lookup_join(docs, batch.select("dt").distinct(), ["dt"], "left_semi", stored=False)


def load_new(
    spark: SparkSession,
    root: str,
    keys: Sequence[str],
    checkpoint: str,
    load: Callable[[DataFrame], None],
) -> None:
    """Run ``load`` on the documents of every date with files not seen by earlier runs."""
    schema = ", ".join(f"{name} string" for name in ("value", *keys))
    stream = spark.readStream.schema(schema).text(root).select("dt")

    def run(batch: DataFrame, _batch_id: int) -> None:
        dates = batch.groupBy("dt").agg(F.count("*").alias("documents"))
        load(touched(read_documents(spark, root, keys), dates))

    query = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
