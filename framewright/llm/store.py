"""Shared folder handling: written tables that cut lineage, and archive files.

Everything that must outlive one job goes below ``spark.checkpoint.dir``, the one
folder that the driver and all executors see.  Only where that setting is absent
(single-machine tests) a local folder is used instead.
"""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """URI of the shared folder; sets a local one only where none is named."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        folder = "file://" + os.path.join(tempfile.gettempdir(), "framewright-shared")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished jobs.

    Shuffle files go when the driver's JVM collects the plans that own them, which
    may be never in a short job; asking for it keeps the disk peak at one step's.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def settle(spark: SparkSession, rounds: int = 3) -> None:
    """Wait until the shuffle files of the last large table are gone.

    What owns them hangs together, and one collection frees only what nothing else holds;
    the cleaner then works in the background.  In a single JVM there is no need to wait.
    """
    if spark.sparkContext.master.startswith("local["):
        return
    for _ in range(rounds):
        release(spark)
        time.sleep(0.5)


def cut(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a recoverable lineage cut.

    Shuffle files are released before the next table is written: until this call returns
    its caller still holds the plan that owns them.
    """
    spark = df.sparkSession
    release(spark)
    path = new_path(spark, label)
    schema = df.schema
    df.write.parquet(path, compression=compression)
    return spark.read.schema(schema).parquet(path)


def drop(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files behind a table made by :func:`cut`."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    base = shared_dir(spark)
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/" in folder and base.split(":", 1)[-1].lstrip("/") in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def arrow_limits(spark: SparkSession) -> None:
    """Small Arrow batches: texts are long, so rows are a poor measure of memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def trimmed(run):
    """A function for mapInArrow that gives a worker's freed memory back when its task ends.

    Workers stay for the next stage, and what they hold counts while others work.
    """

    def whole(batches):
        import ctypes

        import pyarrow as pa

        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim:
                trim(0)

    return whole


def filesystem(uri: str):
    """(pyarrow file system, path) of a URI; works for every store that pyarrow knows."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def read_part(folder: str, part: str, columns: list[str]):
    """The rows of one partition folder of a written table, in file order, as an Arrow table."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyarrow import fs as pafs

    fs, root = filesystem(folder)
    place, tables = f"{root}/{part}", []
    if fs.get_file_info(place).type == pafs.FileType.Directory:
        files = sorted(x.path for x in fs.get_file_info(pafs.FileSelector(place)) if x.path.endswith(".parquet"))
        for name in files:
            with fs.open_input_file(name) as f:
                tables.append(pq.ParquetFile(f).read(columns))
    return pa.concat_tables(tables) if tables else pa.table({c: pa.array([], pa.int64()) for c in columns})


def task_suffix() -> str:
    """A name that no other attempt of any task uses, so that retries never clash."""
    from pyspark import TaskContext

    ctx = TaskContext.get()
    part = ctx.partitionId() if ctx else 0
    return f"{part:06d}-{uuid.uuid4().hex[:12]}"
