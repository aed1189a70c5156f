"""Session helpers shared by the operators: the shared folder, staging and small tables."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def session_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a machine-local
    folder would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    active = spark.sparkContext.getCheckpointDir()
    if active:
        return active.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    folder = tempfile.mkdtemp(prefix="tabular-lifecycle-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody else uses inside the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    place, files = _file_system(spark, path)
    return files.exists(place)


def delete_path(spark: SparkSession, path: str) -> None:
    place, files = _file_system(spark, path)
    files.delete(place, True)


def move_path(spark: SparkSession, path: str, to: str) -> None:
    place, files = _file_system(spark, path)
    if not files.rename(place, _file_system(spark, to)[0]):
        raise OSError(f"cannot move {path} to {to}")


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage before several passes over the same rows. The files survive the loss of an
    executor, and later passes still read only the columns they name.
    """
    spark = session_of(df)
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stage(df: DataFrame) -> None:
    """Delete the files behind a staged frame that nothing reads any more."""
    spark = session_of(df)
    root = shared_folder(spark).split(":", 1)[-1].rstrip("/") + "/"
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if folder.split(":", 1)[-1].replace("//", "/").startswith(root.replace("//", "/")):
            delete_path(spark, folder)


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of finished work now.

    It does so when the driver collects their handles, which a driver with a large heap may put off for long.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def over_one_shuffle(df: DataFrame) -> DataFrame:
    """``df`` over the shuffle that its plan ends in, which is run now and written once.

    Every query over a frame shuffles anew otherwise, and a fit makes several. Partitions and their order stay; files
    of a lost executor are made again, and go when nothing holds the frame.
    """
    spark = session_of(df)
    rows = df._jdf.queryExecution().toRdd()
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(rows, df._jdf.schema(), False), spark)


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """Compute ``df`` now, so that joins against it are planned from the true size of its files."""
    return stage(df, name)


def literal_table(spark: SparkSession, rows: Iterable[tuple], ddl: str) -> DataFrame:
    """A local relation, whose size the optimizer knows, from a few driver-side tuples."""
    schema = T.StructType.fromDDL(ddl)
    records = [dict(zip(schema.fieldNames(), row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=to_arrow_schema(schema)), schema=schema)


def rounded(value: Column, digits: int = 6) -> Column:
    """Round and turn a negative zero into zero."""
    return F.round(value, digits) + F.lit(0.0)
