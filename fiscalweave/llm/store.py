"""Written intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from fiscalweave.sources.sinks import shared_dir


class Scratch:
    """The intermediate tables of one operator call: written once, read by several jobs.

    A table cuts the lineage: an executor lost later costs no recomputation of what led to it.
    ``drop`` removes tables that no pending result reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.n = 0

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n:03d}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def release(self) -> None:
        """Let the driver collect its garbage: Spark deletes the shuffle files of steps that are
        done only when the plans behind them are collected, which may otherwise be much later."""
        gc.collect()
        self.spark._jvm.System.gc()

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(table.scratch_path)
            conf = self.spark.sparkContext._jsc.hadoopConfiguration()
            path.getFileSystem(conf).delete(path, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of the frame has it (case is ignored)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
