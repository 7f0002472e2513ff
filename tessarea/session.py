"""Session factory and the folders that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "tessarea", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that the library relies on: UTC, adaptive execution."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    return builder.config(map=settings).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only where it is unset (a local test session), a new local one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tessarea-")
        atexit.register(shutil.rmtree, found.removeprefix("file://"), ignore_errors=True)
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


class Scratch:
    """Tables written once to the shared folder, which cut lineage and outlive lost executors.

    ``keep`` writes a frame and returns it as read back; ``bucketed`` also lays it out by a key, so that joins on the key
    leave it where it is; ``drop`` removes a table that is no longer needed. What remains is removed by ``close``, at the
    latest when the driver's Python ends; as a context manager it is closed at the block's end.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.base, self.n = spark, f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}", 0
        self.tables: list[str] = []
        atexit.register(self.close)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def folder(self, label: str) -> str:
        self.n += 1
        return f"{self.base}/{self.n:02d}-{label}"

    def keep(self, df: DataFrame, label: str = "table") -> DataFrame:
        path = self.folder(label)
        df.write.parquet(path)
        return self._back(self.spark.read.schema(df.schema).parquet(path), path)

    def bucketed(self, df: DataFrame, key: str, buckets: int, label: str = "table", **options) -> DataFrame:
        path, name = self.folder(label), f"scratch_{uuid.uuid4().hex}"
        self.tables.append(name)
        df.write.bucketBy(buckets, key).options(path=path, **options).format("parquet").saveAsTable(name)
        return self._back(self.spark.table(name), path)

    @staticmethod
    def _back(df: DataFrame, path: str) -> DataFrame:
        df._scratch = path
        return df

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            self._remove(df._scratch)

    def _remove(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

    def close(self) -> None:
        atexit.unregister(self.close)
        try:
            for name in self.tables:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self._remove(self.base)
        except Exception:  # the session has ended: nothing can be removed through it
            pass
