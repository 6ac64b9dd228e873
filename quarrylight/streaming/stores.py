"""What streams keep between batches: the state provider, runs to the end of the input, and ledgers that a batch changes once."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, as arbitrary state of several variables needs."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def run_through(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> list[dict]:
    """Runs a stream batch by batch until nothing is left to read; gives the progress of its batches."""
    query = stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return [p if isinstance(p, dict) else p.__dict__ for p in query.recentProgress]


def last_rows(stream: DataFrame, path: str, keys: list[str], mode: str = "update") -> DataFrame:
    """Runs a stream through and gives the last row of each of keys; path keeps the rows of each batch and the checkpoint."""
    def save(batch: DataFrame, i: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/rows/batch={i}")

    run_through(stream, save, f"{path}/state", mode)
    rows = stream.sparkSession.read.schema(StructType([*stream.schema.fields, StructField("batch", LongType())])).parquet(f"{path}/rows")
    values = [c for c in stream.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("v")).select(*keys, "v.*")


class Ledger:
    """Keyed tables that change together, once per batch.

    The tables of batch i are written to a folder of their own from those of the batch before; then the pointer, one small file, is
    replaced by a rename that either happens or doesn't. The pointer is the ledger of batches: one that it already counts isn't applied again, and what a
    failed attempt left is written over. The version before stays for its readers, older ones go.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _context(self):
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm, jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def batch(self) -> int:
        """The last batch that counts; -1: none."""
        jvm, files, name = self._context()
        if not files.util().exists(name(f"{self.path}/_current")):
            return -1
        stream = files.open(name(f"{self.path}/_current"))
        try:
            return int(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/v={self.batch()}/{name}")

    def apply(self, batch: int, made: Mapping[str, DataFrame], merge: Mapping[str, Callable[[DataFrame], DataFrame]]) -> bool:
        """Folds what a batch made into the tables: merge gives a table from the union of its old rows and the new. False: the batch counted already."""
        last = self.batch()
        if batch <= last:
            return False
        for name, rows in made.items():
            old = self.spark.read.schema(rows.schema).parquet(f"{self.path}/v={last}/{name}") if last >= 0 else None
            merge[name](rows if old is None else old.unionByName(rows)).write.mode("overwrite").parquet(f"{self.path}/v={batch}/{name}")
        jvm, files, name = self._context()
        temporary = name(f"{self.path}/_current.{batch}")
        flags = jvm.java.util.EnumSet.of(jvm.org.apache.hadoop.fs.CreateFlag.CREATE, jvm.org.apache.hadoop.fs.CreateFlag.OVERWRITE)
        out = files.create(temporary, flags, self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.CreateOpts, 0))
        out.write(str(batch).encode())
        out.close()
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        files.rename(temporary, name(f"{self.path}/_current"), options)
        for old in range(max(0, last - 2), last):
            if files.util().exists(name(f"{self.path}/v={old}")):
                files.delete(name(f"{self.path}/v={old}"), True)
        return True
