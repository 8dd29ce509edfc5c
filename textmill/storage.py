"""Intermediate tables in the folder the cluster shares."""

from __future__ import annotations

import re
import tempfile
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster the
    executors would each write to their own disk and lose it with the machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="textmill-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, below the shared folder."""
    return f"{shared_dir(spark)}/textmill/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage (a lost executor costs nothing that was written), fixes
    the rows for plans that read them more than once, keeps column pruning for
    the readers, and gives Catalyst a real size to plan joins with.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_partitions(path: str, column: str, values: DataFrame) -> None:
    """Delete the folders ``path/column=value`` for every value in ``values``.

    A dynamic overwrite leaves the partitions that get no row, so a rerun clears its own first.
    The folder names are listed on the driver, as for any partitioned table.
    """
    spark = values.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path
    root = folder(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return
    names = [s.getPath().getName() for s in files.listStatus(root)]
    held = [(unquote(n.partition("=")[2]), n) for n in names if n.startswith(f"{column}=")]
    if not held:
        return
    wanted = values.select(F.col(column).cast("string").alias("value")).distinct()
    for row in spark.createDataFrame(held, "value string, name string").join(wanted, "value", "left_semi").toLocalIterator():
        files.delete(folder(f"{root.toString()}/{row['name']}"), True)


def remove_stale(path: str, jobs: DataFrame, written: DataFrame) -> None:
    """Delete the partition folders of the jobs in hand that a run has not written.

    ``jobs(job_id)`` are the jobs in hand; ``written`` names the partitions that hold new rows, ``job_id`` first and then the
    other partition columns in order.  Called after the write, so no job is without output in between.
    """
    spark, columns = jobs.sparkSession, written.columns
    folder = spark._jvm.org.apache.hadoop.fs.Path
    root = folder(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return

    def below(at: str, column: str) -> list[tuple[str, str]]:
        names = [s.getPath().getName() for s in files.listStatus(folder(at))]
        return [(unquote(n.partition("=")[2]), f"{at}/{n}") for n in names if n.startswith(f"{column}=")]

    held = below(root.toString(), columns[0])
    if not held:
        return
    mine = jobs.select(F.col("job_id").cast("string").alias("v0")).distinct()
    found = spark.createDataFrame(held, "v0 string, at string").join(mine, "v0", "left_semi")
    rows = [((r["v0"],), r["at"]) for r in found.toLocalIterator()]
    for column in columns[1:]:
        rows = [((*values, value), at) for values, start in rows for value, at in below(start, column)]
    if not rows:
        return
    names = [f"v{i}" for i in range(len(columns))]
    listed = spark.createDataFrame([(*v, at) for v, at in rows], ", ".join(f"{n} string" for n in (*names, "at")))
    new = written.select(*[F.col(c).cast("string").alias(n) for c, n in zip(columns, names)]).distinct()
    for row in listed.join(new, names, "left_anti").toLocalIterator():
        files.delete(folder(row["at"]), True)
