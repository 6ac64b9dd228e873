"""Helpers shared by the training-data operators: tables in the shared folder and bounded samples."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that end a word or are stripped from a line: space, tab, newline, VT, FF, CR.
BLANKS = " \t\n\x0b\x0c\r"

#: Frequent short words of four languages.
STOP_WORDS = (
    "the of and to in is was for that it with as on be at by this from or are an have not",
    "de la le les et des en un une du que qui dans pour sur par est au avec ne",
    "der die und das den von zu mit sich des auf für ist im nicht ein eine als auch",
    "el los las y del se por con para su una al lo como es no más",
)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, read from the session.

    Only where it is unset is it a folder of the warehouse, which they share too.
    """
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared").rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df once as a table in the shared folder and read it again.

    This cuts the lineage: what is read later doesn't depend on any executor that may be lost meanwhile, and
    the plan above isn't computed twice. The table goes when the driver's session ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    written = spark._jvm.org.apache.hadoop.fs.Path(path)
    written.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(written)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """From now on record batches to and from Python workers hold at most so many rows (fewer where the session says so): whole texts make batches of the usual 10,000 rows large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > rows:
        spark.conf.set(name, rows)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n: a fold that any engine can compute."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(n)


def bounded_sample(df: DataFrame, id_col: str, limit: int, seed: int) -> DataFrame:
    """The limit distinct rows of df with the least hash of their id: the same rows in any run and partitioning.

    df should hold narrow columns only; a threshold on the hash thins it first, so that the top-k sees about
    twice as many rows as it keeps, however large df is. Where rows repeat, it may keep fewer.
    """
    h = F.xxhash64(F.lit(seed), F.col(id_col))
    total = df.count()
    if total > 4 * limit:
        df = df.filter(F.pmod(h, F.lit(1 << 30)) < int((1 << 30) * 2.0 * limit / total) + 1)
    return df.distinct().orderBy(h, F.col(id_col)).limit(limit)


class Remembered(dict):
    """What make gave for a key. The half used last survives when the limit is reached; keys over so many characters are made anew."""

    def __init__(self, make, limit: int = 0, longest: int | None = None):
        super().__init__()
        self.make, self.limit, self.longest, self.old = make, limit, longest, {}

    def __missing__(self, key):
        made = self.old.get(key)
        if made is None:
            made = self.make(key)
            if self.longest is not None and len(key) > self.longest:
                return made
        self[key] = made
        return made

    def trim(self):
        if len(self) > self.limit // 2:
            self.old = dict(self)
            self.clear()
