"""Session settings the operators rely on, and where durable working files go."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def prepare_session(spark: SparkSession) -> SparkSession:
    """Event times are naive local times, so every conversion to epoch is pinned to UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def working_root(spark: SparkSession) -> str:
    """Shared folder of the cluster (spark.checkpoint.dir); where that is unset, one beside the warehouse's tables.

    The warehouse is shared too, so no executor ever writes to its own disk. The substitute is removed when the
    session's process ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared is None:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_working-{uuid.uuid4().hex}"
        spark.sparkContext.setCheckpointDir(shared)
        folder = spark._jvm.org.apache.hadoop.fs.Path(shared)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return shared


def new_working_path(spark: SparkSession, name: str) -> str:
    return f"{working_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows read back from a table in the working folder.

    Used where a result is needed several times: it is computed once, survives the loss of executors, and
    later reads still prune columns.
    """
    path = new_working_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(location)


def delete_path(spark: SparkSession, path: str) -> None:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(location, True)


def create_once(spark: SparkSession, path: str, content: str) -> bool:
    """Create a small file with its content, whole or not at all; False where another writer has created it.

    The content goes to a hidden file first. On a local disk a hard link gives it its name, elsewhere a rename that
    replaces nothing, which is atomic on HDFS-like stores.
    """
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(conf)
    target = system.makeQualified(target)
    system.mkdirs(target.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_draft-{uuid.uuid4().hex}")
    out = system.create(draft, False)
    out.write(content.encode())
    out.close()
    try:
        if target.toUri().getScheme() == "file":
            link, held = (jvm.java.nio.file.Paths.get(p.toUri()) for p in (target, draft))
            jvm.java.nio.file.Files.createLink(link, held)
        else:
            none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(draft, target, none)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    finally:
        system.delete(draft, False)
    return True


def read_small_files(spark: SparkSession, folder: str) -> dict[str, str]:
    """Names and contents of the files that `create_once` made in a folder."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(conf)
    if not system.exists(place):
        return {}
    found = {}
    for status in system.listStatus(place):
        name = status.getPath().getName()
        if not name.startswith(("_", ".")):
            stream = system.open(status.getPath())
            found[name] = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
    return found
