import random
import uuid

import pytest
from pyspark.ml.classification import DecisionTreeClassifier

from tabular_lifecycle.operators import drift
from tabular_lifecycle.plans import lifecycle
from tabular_lifecycle.plans.prepare import SUPPORTED


MODELS = {}


def census_lines(n, seed, label_dot):
    draw = random.Random(seed)
    for _ in range(n):
        age, hours, gain = draw.randint(17, 90), draw.randint(1, 99), draw.choice([0, 0, 0, 5178, 15024])
        high = hours + age / 2 + gain / 300 + draw.gauss(0, 8) > 85
        yield ", ".join(map(str, [
            age, draw.choice(["Private", "State-gov", "?"]), draw.randint(20000, 400000), draw.choice(["Bachelors", "HS-grad"]),
            draw.randint(1, 16), "Never-married", draw.choice(["Sales", "Adm-clerical", "Tech-support"]),
            draw.choice(["Husband", "Own-child"]), "White", draw.choice(["Male", "Female"]), gain,
            draw.choice([0, 0, 1902]), hours, draw.choice(["United-States", "Mexico"]),
            (">50K" if high else "<=50K") + label_dot]))


@pytest.fixture(scope="module")
def work(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("census")
    (folder / "train.csv").write_text("\n".join([*census_lines(900, 1, ""), "44, Private"]))
    (folder / "test.csv").write_text("\n".join(census_lines(500, 2, ".")))
    name = f"census_{uuid.uuid4().hex[:8]}"
    work = lifecycle.Workspace(spark, name)
    work.reset(str(tmp_path_factory.mktemp("warehouse") / name))
    lifecycle.ingest(work, str(folder / "train.csv"), str(folder / "test.csv"))
    tree = DecisionTreeClassifier(featuresCol="features", labelCol="target", maxDepth=4, seed=1)
    model = lifecycle.train(work, tree, str(tmp_path_factory.mktemp("models")))
    lifecycle.search(work, "exp", candidates=[("tree", tree, {"maxDepth": "4"})])
    lifecycle.watch(work, model)
    MODELS[work.database] = model
    return work


def test_tables(work):
    assert work.table(lifecycle.RAW).count() == 901
    clean = work.table(lifecycle.CLEAN)
    assert clean.count() == 900 and set(SUPPORTED) < set(clean.columns) and len(clean.columns) == 15
    assert {r["income"] for r in clean.select("income").distinct().collect()} == {"<=50k", ">50k"}
    assert {r["income"] for r in work.table(lifecycle.INFERENCE).select("income").distinct().collect()} == {"<=50k", ">50k"}
    train, validation = lifecycle.split_clean(work)
    assert train.count() + validation.count() == 900 and abs(train.count() - 720) <= 1


def test_metrics_and_drift(work):
    metrics = {r["dataset"]: r for r in work.table(lifecycle.METRICS).collect()}
    assert set(metrics) == {work.name(t) for t in ("clean_income", "inference_income", "modified_inference_income")}
    assert metrics[work.name("inference_income")]["roc_auc_score"] > 0.75
    rows = {(str(r["date"]), r["column"]): r for r in work.table(lifecycle.DRIFT).collect()}
    assert len(rows) == 8
    assert rows[("2000-01-01", "hours_per_week")]["passed"] == 1
    assert rows[("2010-01-01", "log_capital_gain")]["passed"] == 0


def test_watch_again_replaces_its_own_batches(work):
    history = lambda: sorted(map(tuple, work.table(lifecycle.DRIFT).select("date", "dataset", "column", "statistic", "pvalue", "passed").collect()))
    before = history()
    lifecycle.watch(work, MODELS[work.database])
    assert history() == before and len(before) == 8
    assert work.table(lifecycle.METRICS).count() == 3
    drifted = lifecycle.dashboard(work)["numerical_drift"]
    assert "PartitionFilters: [isnotnull(date" in drifted._jdf.queryExecution().executedPlan().toString()


def test_stored_distributions_give_the_drift_of_the_rows(work):
    clean, new = work.table(lifecycle.CLEAN), work.table(lifecycle.INFERENCE)
    plain = drift.drift_report(clean, new, work.name(lifecycle.INFERENCE), "2000-01-01")
    stored = work.table(lifecycle.DRIFT).where("date = DATE '2000-01-01'").select(*plain.columns)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, plain.collect()))


def test_dashboard(work):
    boards = lifecycle.dashboard(work)
    assert boards["run_statistics"].count() == 1 and boards["numerical_drift"].count() == 4
    assert {r["year"] for r in boards["metric_drift"].collect()} == {"2000", "2010"}
    assert boards["total_failures"].first()[0] >= 1
    means = {r["year"]: r["avg_hours_per_week"] for r in boards["data_drift"].collect()}
    assert 8 < means["2010"] - means["2000"] < 12


def test_later_reports_are_appended(work, spark):
    first = lifecycle.drift.drift_report(work.table(lifecycle.CLEAN), work.table(lifecycle.INFERENCE), "x", "2020-01-01")
    lifecycle.sinks.append_table(first, work.name(lifecycle.DRIFT))
    assert work.table(lifecycle.DRIFT).count() == 12


def test_balancing_draws_rows_not_groups(work):
    rows = work.table(lifecycle.CLEAN)
    inputs = lifecycle._inputs(work, rows)
    assert set(inputs.keys) == set(rows.columns)
    cells = lifecycle.models.undersample(rows, inputs.label, inputs.keys, 42).groupBy("income", "sex", "occupation").count()
    before = {tuple(r)[:3]: r["count"] for r in rows.groupBy("income", "sex", "occupation").count().collect()}
    after = {tuple(r)[:3]: r["count"] for r in cells.collect()}
    sizes = {r["income"]: r["count"] for r in rows.groupBy("income").count().collect()}
    large = [c for c, n in before.items() if n > 60 and c[0] == max(sizes, key=sizes.get)]
    assert large and all(0 < after.get(c, 0) < before[c] for c in large)


def test_tables_last_when_scratch_files_go(work, spark):
    home = spark.catalog.getDatabase(work.database).locationUri.removeprefix("file:")
    for name in (lifecycle.RAW, lifecycle.CLEAN, lifecycle.INFERENCE, lifecycle.METRICS, lifecycle.DRIFT):
        files = [f.removeprefix("file://") for f in work.table(name).inputFiles()]
        assert files and all(f.startswith(home) for f in files)


def test_training_run_is_logged(work):
    run = work.table(lifecycle.EXPERIMENT_RUNS).first()
    score = work.table(lifecycle.METRICS).where(f"dataset = '{work.name('clean_income')}'").first()
    assert run["experiment_id"] == "training" and run["maxDepth"] == 4.0
    assert run["val_roc_auc_score"] == pytest.approx(score["roc_auc_score"], abs=1e-6)


def test_profile_and_attribution(work):
    tables = lifecycle.describe(work)
    assert tables["overview"].count() == 15 and tables["summary"].count() > 60
    assert set(tables["advice"].columns) == {"feature", "reason"}
    values = lifecycle.explain(work, MODELS[work.database], background_rows=40).collect()
    assert {r["feature"] for r in values} == set(SUPPORTED)
    assert any(abs(r["value"]) > 1e-6 for r in values)
