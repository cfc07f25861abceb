"""Small files on whatever file system Spark uses, names that only one writer gets, and the shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Where a rename to a name that is taken fails in one step. On local disks a hard link does the same.
EXCLUSIVE_RENAME = ("hdfs", "viewfs", "abfs", "abfss")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where that is unset, a local master gets a folder of its own and keeps it in the setting; on a cluster the
    warehouse serves if it is in a store that executors can reach, and otherwise this raises: tables in a folder of one
    machine would come back without the rows of the others, and without an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", "")
    if not configured:
        master = spark.sparkContext.master
        warehouse = spark.conf.get("spark.sql.warehouse.dir", "")
        if master.startswith("local") and not master.startswith("local-cluster"):
            configured = "file://" + tempfile.mkdtemp(prefix="candlewright-")
            spark.conf.set("spark.checkpoint.dir", configured)
        elif "://" in warehouse and not warehouse.startswith("file:"):
            configured = warehouse
        else:
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all machines of {master} share; intermediate tables cannot go to {warehouse or 'a local folder'}")
    return configured.rstrip("/")


def app_folder(spark: SparkSession) -> str:
    """The application's own folder in the shared one."""
    return f"{shared_folder(spark)}/candlewright/{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write a table to the application's folder and read it again: ends the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{app_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def clear_tables(spark: SparkSession) -> None:
    """Delete the tables that this application wrote to cut lineages; results that are still to be read need them."""
    drop_path(spark, app_folder(spark))


def fs_of(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as its class."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def drop_path(spark: SparkSession, path: str) -> bool:
    fs, where = fs_of(spark, path)
    return fs.delete(where, True)


def names_in(spark: SparkSession, folder: str) -> dict[str, int]:
    """Names in a folder with the time of their last change in ms; none where there is no folder."""
    fs, where = fs_of(spark, folder)
    if not fs.exists(where):
        return {}
    return {f.getPath().getName(): f.getModificationTime() for f in fs.listStatus(where)}


def numbers_in(spark: SparkSession, folder: str) -> list[int]:
    """Names in a folder that are whole numbers."""
    return sorted(int(n) for n in names_in(spark, folder) if n.isdigit())


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = fs_of(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file under a free name, whole or not at all; False where the name is taken.

    Of several writers one gets the name. File systems on which check and rename are two steps raise.
    """
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    fs, final = fs_of(spark, path)
    scheme = fs.getUri().getScheme()
    if scheme != "file" and scheme not in EXCLUSIVE_RENAME:
        raise ValueError(f"{path}: {scheme} has no exclusive rename, so two writers could both win; use one of file, {', '.join(EXCLUSIVE_RENAME)}")
    aside = jvm.org.apache.hadoop.fs.Path(final.getParent(), f".{uuid.uuid4().hex}")
    fs.mkdirs(final.getParent())
    stream = fs.create(aside, False)
    stream.write(text.encode())
    stream.close()
    try:
        if scheme == "file":
            os.link(fs.makeQualified(aside).toUri().getPath(), fs.makeQualified(final).toUri().getPath())
            fs.delete(aside, False)
        else:
            files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
            files.rename(fs.makeQualified(aside), fs.makeQualified(final), gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
    except FileExistsError:
        fs.delete(aside, False)
        return False
    except Exception as e:
        fs.delete(aside, False)
        if "FileAlreadyExists" not in str(e):
            raise
        return False
    return True
