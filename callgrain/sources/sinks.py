"""Writing results, and tables that later steps of the same job read again."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from callgrain.sources.cdr import with_reasons


def save(df: DataFrame, path: str) -> None:
    """Replace the Parquet directory at `path`."""
    df.write.mode("overwrite").parquet(path)


def save_all(tables: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """Write each table to its own directory under `folder`; returns the paths."""
    paths = {name: f"{folder.rstrip('/')}/{name}" for name in tables}
    for name, df in tables.items():
        save(df, paths[name])
    return paths


def land_cdr(cdr: DataFrame, path: str) -> None:
    """Store cleaned records as Parquet by day, so that `filter_dates` and the jobs read only the days they need.

    The rebalance hint lets Spark split large days and merge small ones into files of even size.
    """
    cdr.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(path)


def land_with_quarantine(raw: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Land raw records and keep apart those that cannot be used, in one pass: returns the landed records and the others.

    Landed records lie by day, as `land_cdr` puts them. The others are in `path`/status=rejected with their fields as they were and the
    reasons, so that they can be mended and landed later. Every row is in one of the two.
    """
    status = F.when(F.size("reasons") > 0, "rejected").otherwise("landed")
    judged = with_reasons(raw).withColumn("status", status)
    rejected = F.col("status") == "rejected"
    # Fields as they were only where they are needed, so that landed records do not hold everything twice.
    rows = judged.withColumns({"raw": F.when(rejected, F.col("raw")), "reasons": F.when(rejected, F.col("reasons"))})
    rows.hint("rebalance", "status", "day").write.mode("overwrite").partitionBy("status", "day").parquet(path)
    everything = rows.sparkSession.read.schema(rows.schema).parquet(path)
    landed = everything.where("status = 'landed'").drop("status", "raw", "reasons")
    return landed, everything.where("status = 'rejected'").select("event_id", "raw.*", "reasons")


def staging_folder(spark: SparkSession) -> str:
    """The shared folder the session names in `spark.checkpoint.dir`.

    Only a local session may go without: it gets a fresh folder on its own machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="callgrain-"))
    return spark.sparkContext.getCheckpointDir()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several results read, and read it back.

    It survives lost executors, and its readers scan only the columns they need.
    """
    spark = df.sparkSession
    path = f"{staging_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
