"""Tables in the shared folder: written once and read back, or published in versions behind one small pointer."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: The file below a published table that names its current version.
POINTER = "_current"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see (spark.checkpoint.dir); a local session without one gets a folder of its machine, a cluster must name one."""
    got = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not got:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is unset: executors need a shared folder")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-"))
        got = spark.sparkContext.getCheckpointDir()
    return f"{got.rstrip('/')}/tessera-{spark.sparkContext.applicationId}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """The rows of df from a Parquet table in the shared folder: worked out once, whoever reads them."""
    path = f"{shared_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    """(path, file system) of Hadoop for a path of any scheme."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that readers see its old or its new content: a new file is moved over it in one step."""
    own, fs = hadoop_path(spark, f"{path}.new-{uuid.uuid4().hex[:8]}")
    out = fs.create(own, True)
    out.write(bytearray(text.encode()))
    out.close()
    jvm = spark._jvm
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    files.rename(own, hadoop_path(spark, path)[0], options)


def get_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, None where there is none."""
    p, fs = hadoop_path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def publish(df: DataFrame, root: str, keep: int = 2) -> str:
    """Write df as a new version of the table at root, then point to it; returns the version's name.

    Readers see the old version until the pointer is moved, in one step, and the new one after it; a failure before that
    leaves the old version in place, so a table can be rewritten from itself. The last `keep` versions stay, for readers
    that have begun; older ones and those of failed runs that are older than the kept ones are deleted.
    """
    spark = df.sparkSession
    before = (get_text(spark, f"{root}/{POINTER}") or "").split()
    version = f"v{len(before) and int(before[0][1:].split('-')[0]) + 1:08d}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(f"{root}/{version}")
    put_text(spark, f"{root}/{POINTER}", " ".join([version, *before[: keep - 1]]))
    kept = {version, *before[: keep - 1]}
    top, fs = hadoop_path(spark, root)
    for s in fs.listStatus(top):
        name = s.getPath().getName()
        if re.fullmatch(r"v[0-9]{8}-[0-9a-f]{8}", name) and name not in kept and name < min(kept):
            fs.delete(s.getPath(), True)
    return version


def published(spark: SparkSession, root: str) -> DataFrame | None:
    """The current version of a published table, None before the first."""
    now = get_text(spark, f"{root}/{POINTER}")
    return spark.read.parquet(f"{root}/{now.split()[0]}") if now else None
