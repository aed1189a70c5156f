"""Writes to paths and tables, and the life cycle of databases and tables.

``format`` is a parameter everywhere: Parquet needs no extra jar, a table format that is on the
class path works the same way.

A replacement is written in full beside what it replaces and takes its place at the end, so a write that fails leaves
the old rows as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import delete_path, move_path, path_exists, session_of, stage

# Table property that names the folder of the version before, which readers may still be in.
_BEFORE = "tabular.lifecycle.version.before"


def overwrite_path(df: DataFrame, path: str, format: str = "parquet") -> str:
    """Replace the files at ``path``: a new folder is written beside it, and the two change places by renaming."""
    spark, path = session_of(df), path.rstrip("/")
    new, old = f"{path}__new-{uuid.uuid4().hex}", f"{path}__old-{uuid.uuid4().hex}"
    try:
        df.write.format(format).save(new)
        if path_exists(spark, path):
            move_path(spark, path, old)
        move_path(spark, new, path)
    except Exception:
        if not path_exists(spark, path) and path_exists(spark, old):
            move_path(spark, old, path)
        delete_path(spark, new)
        raise
    delete_path(spark, old)
    return path


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(*name.split('.'))}").where("col_name = 'Location'")
    return rows.first().data_type


def _same_columns(a, b) -> bool:
    """Whether both schemas have the same names and types in the same order; NULLs are allowed in any table."""
    return [(f.name, f.dataType.simpleString()) for f in a] == [(f.name, f.dataType.simpleString()) for f in b]


def overwrite_table(
    df: DataFrame, name: str, format: str = "parquet", path: str | None = None
) -> None:
    """Replace the rows and the schema of ``name``.

    The new rows are written whole to a folder of their own. Where the columns stay the same, the table is then pointed at
    it, one change of the catalog. Where they differ, the new rows become a table under another name, which takes the
    name over: between its two steps a reader may find no table, but never a part of its rows. Either way a
    failed write leaves the old table. The folder of the version before stays for those who are reading it until the
    next replacement.
    """
    spark = session_of(df)
    if not spark.catalog.tableExists(name):
        _create(df, name, format, path)
        return
    old, before = _location(spark, name), _properties(spark, name).get(_BEFORE)
    new = f"{path.rstrip('/') if path else old.split('__v-')[0]}__v-{uuid.uuid4().hex}"
    table = quoted(*name.split("."))
    try:
        df.write.format(format).save(new)
        if not partitions_of(spark, name) and _same_columns(spark.table(name).schema, df.schema):
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{new}'")
        else:
            *database, last = name.split(".")
            other = quoted(*database, f"{last}__{uuid.uuid4().hex}")
            spark.sql(f"CREATE TABLE {other} USING {format} LOCATION '{new}'")
            spark.sql(f"DROP TABLE {table}")
            spark.sql(f"ALTER TABLE {other} RENAME TO {table}")
    except Exception:
        if not spark.catalog.tableExists(name) or _location(spark, name) != new:
            delete_path(spark, new)
        raise
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_BEFORE}' = '{old}')")
    spark.catalog.refreshTable(name)
    if before:
        delete_path(spark, before)


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {quoted(*name.split('.'))}").collect()}


def _create(df: DataFrame, name: str, format: str, path: str | None, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.format(format).mode("errorifexists")
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    (writer.option("path", path) if path else writer).saveAsTable(name)


def partitions_of(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def replace_batches(df: DataFrame, name: str, keys: Sequence[str], format: str = "parquet", others: str = "keep") -> None:
    """Append batches that a rerun replaces: rows of ``df`` take the place of those with the same ``keys``.

    The table is partitioned by ``keys``; only the partitions that ``df`` holds are written, and a failed write leaves them as
    they were. ``others="drop"`` then drops all other partitions. Columns match by name, as in ``append_table``.
    """
    spark = session_of(df)
    if others not in ("keep", "drop"):
        raise ValueError("others is 'keep' or 'drop'")
    if not spark.catalog.tableExists(name):
        _create(df, name, format, None, keys)
        return
    if partitions_of(spark, name) != list(keys):
        raise ValueError(f"{name} is not partitioned by {list(keys)}")
    known = _known(df, name)
    df = stage(df, "batch") if others == "drop" else df
    mode = "spark.sql.sources.partitionOverwriteMode"
    usual = spark.conf.get(mode, "static")
    spark.conf.set(mode, "dynamic")
    try:
        df.select(*[F.col(quoted(c)) for c in known]).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, usual)
    if others == "drop":
        # One row for each partition of the table.
        mine = {tuple(map(str, r)) for r in df.select(*keys).distinct().collect()}
        for row in spark.table(name).select(*keys).distinct().collect():
            if tuple(map(str, row)) not in mine:
                spec = ", ".join(f"{quoted(k)} = " + ("null" if v is None else "'" + str(v).replace("'", "\\'") + "'") for k, v in zip(keys, row))
                spark.sql(f"ALTER TABLE {quoted(*name.split('.'))} DROP IF EXISTS PARTITION ({spec})")


def _known(df: DataFrame, name: str) -> list[str]:
    """Columns of the table, which must be those of ``df``."""
    known = session_of(df).table(name).columns
    extra = sorted(set(df.columns) - set(known))
    missing = sorted(set(known) - set(df.columns))
    if extra or missing:
        raise ValueError(f"append to {name}: unknown columns {extra}, missing columns {missing}")
    return known


def append_table(df: DataFrame, name: str, format: str = "parquet") -> None:
    """Add rows; columns match by name, and a column unknown to the table is an error."""
    writer = df.write.format(format).mode("append")
    if session_of(df).catalog.tableExists(name):
        _known(df, name)
        keys = partitions_of(session_of(df), name)
        writer = writer.partitionBy(*keys) if keys else writer
    writer.saveAsTable(name)


def merge_append_table(df: DataFrame, name: str, format: str = "parquet") -> None:
    """Append rows whose columns may be new or absent; the missing side is filled with NULL.

    New columns are added to the table's schema, where older rows read as NULL, and only the new rows are written.
    """
    spark = session_of(df)
    if not spark.catalog.tableExists(name):
        overwrite_table(df, name, format)
        return
    known = {f.name.lower(): f for f in spark.table(name).schema}
    new = [f for f in df.schema if f.name.lower() not in known]
    if new:
        added = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {quoted(*name.split('.'))} ADD COLUMNS ({added})")
    own = {c.lower() for c in df.columns}
    filled = df.select(*[
        F.col(quoted(f.name)) if f.name.lower() in own else F.lit(None).cast(f.dataType).alias(f.name)
        for f in spark.table(name).schema
    ])
    filled.write.format(format).mode("append").saveAsTable(name)


def quoted(*parts: str) -> str:
    return ".".join("`" + part.strip("`").replace("`", "``") + "`" for part in parts)


def create_external_table(
    spark: SparkSession, name: str, path: str, format: str = "parquet"
) -> DataFrame:
    """Register files that already exist under a name."""
    return spark.catalog.createTable(name, path=path, source=format)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop the table, and the files of versions that ``overwrite_table`` wrote for it."""
    written = []
    if spark.catalog.tableExists(name):
        place, before = _location(spark, name), _properties(spark, name).get(_BEFORE)
        written = [p for p in (place, before) if p and (p == before or "__v-" in p.rsplit("/", 1)[-1])]
    spark.sql(f"DROP TABLE IF EXISTS {quoted(*name.split('.'))}")
    for folder in written:
        delete_path(spark, folder)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}{where}")


def use_database(spark: SparkSession, name: str) -> None:
    spark.catalog.setCurrentDatabase(name)


def drop_database(spark: SparkSession, name: str) -> None:
    """Remove the database with all its tables, if it is there."""
    if spark.catalog.databaseExists(name):
        for table in spark.catalog.listTables(name):
            if table.tableType != "VIEW":
                drop_table(spark, f"{name}.{table.name}")
    spark.sql(f"DROP DATABASE IF EXISTS {quoted(name)} CASCADE")
