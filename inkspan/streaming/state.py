"""Messages as a stream, and the state table that their results are merged into."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.operators.files import envelope_files, upsert
from inkspan.schemas import PARSE_STATE, checked


def requests(messages: DataFrame, value: str = "value") -> DataFrame:
    """File requests of a batch or stream of messages: the same plan for both."""
    return messages.select(F.explode(envelope_files(F.col(value))).alias("f")).select("f.*")


class StateTable:
    """The newest state of each file, as numbered Parquet versions under a folder: a version is whole
    before the next is read, and a repeated micro-batch writes the same version again."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _versions(self) -> list[int]:
        jvm, conf = self.spark.sparkContext._jvm, self.spark._jsparkSession.sessionState().newHadoopConf()
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = p.getFileSystem(conf)
        if not fs.exists(p):
            return []
        names = [s.getPath() for s in fs.listStatus(p)]
        return sorted(int(n.getName()[2:]) for n in names if n.getName().startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(n, "_SUCCESS")))

    def read(self, before: int | None = None) -> DataFrame:
        found = [v for v in self._versions() if before is None or v < before]
        if not found:
            return self.spark.createDataFrame([], PARSE_STATE)
        return self.spark.read.schema(PARSE_STATE).parquet(f"{self.path}/v={found[-1]}")

    def merge(self, changes: DataFrame, version: int) -> None:
        upsert(self.read(version), checked(changes, PARSE_STATE), keep_finished=True).select(*PARSE_STATE.names).write.mode("overwrite").parquet(f"{self.path}/v={version}")

    def sink(self, changes: DataFrame, checkpoint: str):
        """Starts a stream that merges each micro-batch."""
        return changes.writeStream.foreachBatch(lambda df, i: self.merge(df, i)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
