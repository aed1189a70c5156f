import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from tabular_lifecycle import sinks, sources
from tabular_lifecycle.runtime import fresh_path, settle, shared_folder, stage


@pytest.fixture()
def database(spark):
    name = f"db_{uuid.uuid4().hex[:10]}"
    sinks.create_database(spark, name, fresh_path(spark, name))
    yield name
    sinks.drop_database(spark, name)


def write(tmp_path, text):
    path = tmp_path / "rows.csv"
    path.write_text(text)
    return str(path)


LINE = "39, State-gov, 77516, Bachelors, 13, Never-married, Adm-clerical, Not-in-family, White, Male, 2174, 0, 40, United-States, <=50K"


def test_csv_keeps_blanks_and_bad_rows(spark, tmp_path):
    short = "50, Private"
    bad = LINE.replace("39", "old", 1)
    quoted = LINE.replace(" State-gov", '"State, gov"')
    df = sources.read_csv(spark, write(tmp_path, "\n".join([LINE, short, bad, quoted])))
    rows = df.collect()
    assert len(rows) == 4 and df.schema == sources.CENSUS_SCHEMA
    assert rows[0]["workclass"] == " State-gov" and rows[0]["fnlwgt"] == 77516.0
    assert rows[1]["age"] == 50 and rows[1]["income"] is None
    assert rows[2]["age"] is None and rows[2]["income"] == " <=50K"
    assert rows[3]["workclass"] == "State, gov"


def test_csv_options(spark, tmp_path):
    path = write(tmp_path, "\n".join([LINE.replace(" State-gov", " ?"), LINE.replace("39", "old", 1)]))
    df = sources.read_csv(spark, path, trim=True, null_tokens=["?"], corrupt_column="raw_text").collect()
    assert df[0]["workclass"] is None and df[1]["workclass"] == "State-gov"
    assert df[0]["raw_text"] is None and df[1]["raw_text"].startswith("old")
    with pytest.raises(Exception, match="(?i)malformed"):
        sources.read_csv(spark, path, mode="FAILFAST").collect()


def test_local_rows(spark):
    inferred = sources.local_rows(spark, [{"dataset": "a", "f1": 0.5}])
    assert dict(inferred.dtypes) == {"dataset": "string", "f1": "double"}
    typed = sources.local_rows(spark, [(dt.date(2000, 1, 1), 1)], "date date, passed int")
    assert typed.first() == (dt.date(2000, 1, 1), 1)


def test_run_log_filter_reaches_the_scan(spark, tmp_path):
    log = spark.createDataFrame(
        [("r1", "e1", {"a": 1.0}, {"p": "x"}, None, None), ("r2", "e2", None, None, None, None)],
        sources.RUN_LOG_SCHEMA)
    path = sinks.overwrite_path(log, str(tmp_path / "log"))
    chosen = sources.read_run_log(spark, path, "e2")
    assert [r["run_id"] for r in chosen.collect()] == ["r2"]
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(experiment_id,e2)" in plan
    assert sources.read_run_log(spark, path).count() == 2


def test_overwrite_append_and_columns(spark, database):
    name = f"{database}.t"
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    sinks.overwrite_table(df.withColumn("z", F.lit(1)), name)
    sinks.overwrite_table(df, name)
    sinks.append_table(df.select("y", "x"), name)
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, "a"), (1, "a")]
    with pytest.raises(ValueError, match="unknown columns \\['z'\\]"):
        sinks.append_table(df.withColumn("z", F.lit(1)), name)


def test_append_to_a_new_table(spark, database):
    sinks.append_table(spark.range(2), f"{database}.fresh")
    assert spark.table(f"{database}.fresh").count() == 2


def test_merge_append(spark, database):
    name = f"{database}.m"
    sinks.merge_append_table(spark.createDataFrame([(1, 2.0)], "x int, a double"), name)
    sinks.merge_append_table(spark.createDataFrame([(2, 3.0)], "x int, b double"), name)
    sinks.merge_append_table(spark.createDataFrame([(3, 4.0)], "x int, a double"), name)
    rows = sorted(map(tuple, spark.table(name).select("x", "a", "b").collect()))
    assert rows == [(1, 2.0, None), (2, None, 3.0), (3, 4.0, None)]


def test_external_table_and_lifecycle(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex[:10]}"
    path = sinks.overwrite_path(spark.range(3), str(tmp_path / "files"))
    sinks.create_database(spark, name, str(tmp_path / "db"))
    before = spark.catalog.currentDatabase()
    try:
        sinks.use_database(spark, name)
        sinks.create_external_table(spark, "outside", path)
        assert sources.read_table(spark, "outside").count() == 3
        sinks.drop_table(spark, "outside")
        sinks.drop_table(spark, "outside")
        assert spark.read.parquet(path).count() == 3
    finally:
        sinks.use_database(spark, before)
        sinks.drop_database(spark, name)
    assert not spark.catalog.databaseExists(name)


def test_settle_and_stage(spark):
    small, large = settle(spark.range(5)), settle(spark.range(50))
    assert small.count() == 5 and large.count() == 50
    assert all(shared_folder(spark) in df.inputFiles()[0] for df in (small, large))
    assert stage(spark.range(7).toDF("n")).columns == ["n"]


def failing(spark, n=200):
    """Rows of which a late one raises."""
    return spark.range(n, numPartitions=4).select(F.when(F.col("id") < n - 1, F.col("id")).otherwise(F.raise_error(F.lit("half-way"))).cast("int").alias("x"))


def test_a_failed_overwrite_leaves_the_table(spark, database):
    name = f"{database}.kept"
    sinks.overwrite_table(spark.createDataFrame([(1,), (2,)], "x int"), name)
    for df in (failing(spark), failing(spark).withColumn("y", F.lit(1))):
        with pytest.raises(Exception, match="half-way"):
            sinks.overwrite_table(df, name)
        assert sorted(r.x for r in spark.table(name).collect()) == [1, 2] and spark.table(name).columns == ["x"]


def test_a_table_is_replaced_from_itself_and_grows_on(spark, database):
    name = f"{database}.own"
    sinks.overwrite_table(spark.range(5), name)
    for n in (4, 3):
        sinks.overwrite_table(spark.table(name).where(f"id < {n}"), name)
        assert spark.table(name).count() == n
    sinks.append_table(spark.range(2), name)
    assert spark.table(name).count() == 5
    sinks.overwrite_table(spark.table(name).withColumn("more", F.lit("x")), name)
    assert spark.table(name).columns == ["id", "more"] and spark.table(name).count() == 5
    sinks.merge_append_table(spark.createDataFrame([(9, 1.5)], "id long, late double"), name)
    assert spark.table(name).where("late = 1.5 AND more IS NULL").count() == 1


def test_old_versions_go_with_the_table(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex[:10]}"
    sinks.create_database(spark, name, str(tmp_path / name))
    for i in range(4):
        sinks.overwrite_table(spark.range(i), f"{name}.t")
    assert len(list((tmp_path / name).iterdir())) == 2  # the version in use and the one before
    sinks.drop_table(spark, f"{name}.t")
    assert not list((tmp_path / name).iterdir())
    sinks.drop_database(spark, name)


def test_a_failed_overwrite_leaves_the_path(spark, tmp_path):
    path = sinks.overwrite_path(spark.range(3), str(tmp_path / "files"))
    with pytest.raises(Exception, match="half-way"):
        sinks.overwrite_path(failing(spark), path)
    assert spark.read.parquet(path).count() == 3
    sinks.overwrite_path(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2 and [p.name for p in tmp_path.iterdir()] == ["files"]


def test_batches_are_replaced_by_a_rerun(spark, database):
    name, rows = f"{database}.history", "day date, of string, n int"
    day = [dt.date(2000, 1, d) for d in (1, 2, 3)]
    batch = lambda *r: spark.createDataFrame(list(r), rows)
    sinks.replace_batches(batch((day[0], "a", 1), (day[0], "a", 2)), name, ("day", "of"))
    sinks.replace_batches(batch((day[1], "a", 3), (day[1], "it's", 4)).select("n", "of", "day"), name, ("day", "of"))
    for _ in range(2):
        sinks.replace_batches(batch((day[0], "a", 9)), name, ("day", "of"))
        assert sorted(r.n for r in spark.table(name).collect()) == [3, 4, 9]
    with pytest.raises(Exception, match="half-way"):
        sinks.replace_batches(failing(spark).select(F.lit(day[0]).alias("day"), F.lit("a").alias("of"), F.col("x").alias("n")), name, ("day", "of"))
    assert sorted(r.n for r in spark.table(name).collect()) == [3, 4, 9]
    plan = spark.table(name).where(F.col("day") == F.lit(day[1]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    sinks.replace_batches(batch((day[2], None, 7)), name, ("day", "of"), others="drop")
    assert [tuple(r) for r in spark.table(name).select("n", "of").collect()] == [(7, None)]
    sinks.replace_batches(batch((day[1], "it's", 5)), name, ("day", "of"), others="drop")
    assert [tuple(r) for r in spark.table(name).select("n", "of").collect()] == [(5, "it's")]
    with pytest.raises(ValueError):
        sinks.replace_batches(batch((day[0], "a", 9)), name, ("day",))
    with pytest.raises(ValueError, match="unknown columns"):
        sinks.replace_batches(batch((day[0], "a", 9)).withColumn("z", F.lit(1)), name, ("day", "of"))
