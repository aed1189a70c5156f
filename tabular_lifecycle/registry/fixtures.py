"""The census shape, run log and scored rows derived from the given tables, for Spark and for SQL.

The census files themselves are not at hand; line items with their order, customer, nation, region
and part give rows of the same shape: text with stray blanks and dots, missing numbers, skewed
amounts and an uneven label.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.drift import perturb
from ..operators.relational import complete
from ..plans.prepare import prepare, prepare_training
from ..runtime import stage
from ..sources import CENSUS_COLUMNS

KEYS = ["row_key"]
SPLIT_SEED = 149849802
UNDERSAMPLE_SEED = 42
SAMPLE_SEED = 500
NOISE_SEED = 2010
TRAINING = "clean_income"
INFERENCE = "inference_income"
MODIFIED = "modified_inference_income"
CUTOFF = "1998-04-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_items(spark: SparkSession, sf_dir: str, columns: Sequence[str]) -> DataFrame:
    """Some columns of the line items, written once for operators that read them several times."""
    return stage(table(spark, sf_dir, "lineitem").select(*columns))


def census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw census rows with ``row_key`` and ``o_orderdate``.

    Line items and orders both grow with the data, so that join is always a sort-merge join, whose
    skewed keys Spark splits at run time. The other tables are broadcast only if Spark finds them
    small enough. Orders meet them first, so line items are shuffled only for orders and for parts.
    """
    orders = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    rows = (
        table(spark, sf_dir, "lineitem")
        .join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    line = F.col("l_linenumber")
    return rows.select(
        F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row_key"),
        (F.col("p_size") + 16).cast("int").alias("age"),
        F.concat(F.lit(" "), "c_mktsegment", F.lit(".")).alias("workclass"),
        F.col("l_extendedprice").alias("fnlwgt"),
        F.col("o_orderpriority").alias("education"),
        F.when(line != 7, line.cast("double")).alias("education_num"),
        F.col("o_orderstatus").alias("marital_status"),
        F.col("p_type").alias("occupation"),
        F.col("l_returnflag").alias("relationship"),
        F.col("r_name").alias("race"),
        F.col("l_linestatus").alias("sex"),
        F.when(F.col("l_discount") >= 0.08, F.col("o_totalprice")).otherwise(0.0).alias("capital_gain"),
        F.when(F.col("l_tax") >= 0.07, F.col("l_extendedprice")).otherwise(0.0).alias("capital_loss"),
        F.col("l_quantity").alias("hours_per_week"),
        F.col("n_name").alias("native_country"),
        F.when(F.col("o_totalprice") > 375000, " >50K.").otherwise(" <=50K").alias("income"),
        F.col("o_orderdate"),
    )


def _before_cutoff():
    return F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp_ntz")


def raw_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return census(spark, sf_dir).filter(_before_cutoff())


def raw_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return census(spark, sf_dir).filter(~_before_cutoff())


def training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_training(raw_training(spark, sf_dir))


def inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(raw_inference(spark, sf_dir))


def both_sides(spark: SparkSession, sf_dir: str, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Some columns of the training and the inference rows, from one join written once."""
    raw = census(spark, sf_dir)
    marked = raw.withColumns({"early": _before_cutoff(), "complete": complete(raw)})
    rows = stage(prepare(marked).select(*columns, "early", "complete"), "both-sides")
    return rows.filter(F.col("early") & F.col("complete")).select(*columns), rows.filter(~F.col("early")).select(*columns)


def modified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perturb(inference(spark, sf_dir), KEYS, seed=NOISE_SEED)


def rule_score(df: DataFrame) -> DataFrame:
    """A fixed logistic rule in place of a trained model, so that results can be checked exactly.

    Probabilities are rounded: equal odds reached by different sums are then ties everywhere.
    """
    odds = (
        F.lit(-2.2) + F.lit(0.03) * F.col("hours_per_week") + F.lit(0.1) * F.col("log_capital_gain")
        + F.when(F.col("age_by_decade").isin("40s", "50s"), 0.5).otherwise(0.0)
    )
    probability = F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-odds)), 6)
    return df.withColumn("probability", probability).withColumn("predicted", F.col("probability") >= 0.5)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training, inference and modified rows under the rule, with their data-set label."""
    columns = ["row_key", "hours_per_week", "log_capital_gain", "age_by_decade", "income"]
    parts = [
        part.select(*columns, F.lit(name).alias("dataset"))
        for name, part in ((TRAINING, training(spark, sf_dir)), (INFERENCE, inference(spark, sf_dir)),
                           (MODIFIED, modified(spark, sf_dir)))
    ]
    return rule_score(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per nation, one experiment per region; the scores are shares of its orders."""
    rows = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )

    def share(condition):
        return F.round(F.avg(F.when(condition, 1.0).otherwise(0.0)), 4)

    grouped = rows.groupBy("n_name", "r_name").agg(
        share(F.col("o_orderstatus") == "F").alias("accuracy"),
        share(F.col("o_orderstatus") != "O").alias("f1"),
        F.round(F.avg(F.col("o_totalprice") / 500000), 4).alias("loss"),
        share(F.col("o_totalprice") > 250000).alias("precision"),
        share(F.col("o_orderpriority") < "3").alias("recall"),
        share(F.col("c_acctbal") > 0).alias("auc"),
        F.count("*").alias("n"),
        F.max("c_mktsegment").alias("segment"),
        F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"),
    )
    metrics = F.create_map(
        F.lit("val_accuracy_score"), F.col("accuracy"), F.lit("val_f1_score"), F.col("f1"),
        F.lit("val_log_loss"), F.col("loss"), F.lit("val_precision_score"), F.col("precision"),
        F.lit("val_recall_score"), F.col("recall"), F.lit("val_roc_auc_score"), F.col("auc"),
    )
    params = F.create_map(
        F.lit("model"), F.concat(F.lit("trees-"), F.lower("segment")),
        F.lit("max_depth"), (F.col("n") % 10).cast("string"), F.lit("booster"), F.col("segment"),
    )
    return grouped.select(
        F.col("n_name").alias("run_id"), F.col("r_name").alias("experiment_id"),
        metrics.alias("metrics"), params.alias("params"),
        F.col("first_order").cast("timestamp").alias("start_time"),
        F.col("last_order").cast("timestamp").alias("end_time"),
    )


# --- the same, as SQL ---------------------------------------------------------------------------

_CENSUS = """
census AS (
  SELECT concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_key,
         CAST(p_size + 16 AS INTEGER) AS age,
         ' ' || c_mktsegment || '.' AS workclass,
         l_extendedprice AS fnlwgt,
         o_orderpriority AS education,
         CAST(NULLIF(l_linenumber, 7) AS DOUBLE) AS education_num,
         o_orderstatus AS marital_status,
         p_type AS occupation,
         l_returnflag AS relationship,
         r_name AS race,
         l_linestatus AS sex,
         CASE WHEN l_discount >= 0.08 THEN o_totalprice ELSE 0.0::DOUBLE END AS capital_gain,
         CASE WHEN l_tax >= 0.07 THEN l_extendedprice ELSE 0.0::DOUBLE END AS capital_loss,
         l_quantity AS hours_per_week,
         n_name AS native_country,
         CASE WHEN o_totalprice > 375000 THEN ' >50K.' ELSE ' <=50K' END AS income,
         o_orderdate
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
)"""


def _cleaned(column: str) -> str:
    edge = r"^\s+|\s+$"
    return f"translate(lower(regexp_replace({column}, '{edge}', '', 'g')), ' .,', '-')"


def _prepared(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT row_key, o_orderdate,
         {_cleaned('workclass')} AS workclass, fnlwgt, {_cleaned('education')} AS education, education_num,
         {_cleaned('marital_status')} AS marital_status, {_cleaned('occupation')} AS occupation,
         {_cleaned('relationship')} AS relationship, {_cleaned('race')} AS race, {_cleaned('sex')} AS sex,
         hours_per_week, {_cleaned('native_country')} AS native_country, {_cleaned('income')} AS income,
         CASE WHEN age <= 19 THEN 'teens' WHEN age BETWEEN 20 AND 29 THEN '20s'
              WHEN age BETWEEN 30 AND 39 THEN '30s' WHEN age BETWEEN 40 AND 49 THEN '40s'
              WHEN age BETWEEN 50 AND 59 THEN '50s' WHEN age BETWEEN 60 AND 99 THEN '60+'
              ELSE 'other' END AS age_by_decade,
         ln(capital_gain + 1) AS log_capital_gain, ln(capital_loss + 1) AS log_capital_loss
  FROM {source}
)"""


_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in CENSUS_COLUMNS)
_NOISE = f"CAST('0x' || substr(md5('{NOISE_SEED}|' || row_key), 1, 8) AS BIGINT) % 21"

CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "census": (_CENSUS, ()),
    "prepared": (_prepared("prepared", "census"), ("census",)),
    "training_raw": (
        f"training_raw AS (SELECT * FROM census WHERE o_orderdate < TIMESTAMP '{CUTOFF}' AND {_COMPLETE})",
        ("census",)),
    "inference_raw": (
        f"inference_raw AS (SELECT * FROM census WHERE o_orderdate >= TIMESTAMP '{CUTOFF}')", ("census",)),
    "training": (_prepared("training", "training_raw"), ("training_raw",)),
    "inference": (_prepared("inference", "inference_raw"), ("inference_raw",)),
    "modified": (f"""
modified AS (
  SELECT * EXCLUDE (noise) REPLACE (
           fnlwgt + noise AS fnlwgt, hours_per_week + noise AS hours_per_week,
           log_capital_gain + noise AS log_capital_gain, log_capital_loss + noise AS log_capital_loss)
  FROM (SELECT *, {_NOISE} AS noise FROM inference)
)""", ("inference",)),
    "scored": (f"""
scored AS (
  SELECT *, round(1.0::DOUBLE / (1.0::DOUBLE + exp(-odds)), 6) AS probability,
         round(1.0::DOUBLE / (1.0::DOUBLE + exp(-odds)), 6) >= 0.5 AS predicted
  FROM (SELECT *, (-2.2)::DOUBLE + 0.03::DOUBLE * hours_per_week + 0.1::DOUBLE * log_capital_gain
                  + CASE WHEN age_by_decade IN ('40s', '50s') THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS odds
        FROM (SELECT row_key, hours_per_week, log_capital_gain, age_by_decade, income, '{TRAINING}' AS dataset FROM training
              UNION ALL
              SELECT row_key, hours_per_week, log_capital_gain, age_by_decade, income, '{INFERENCE}' FROM inference
              UNION ALL
              SELECT row_key, hours_per_week, log_capital_gain, age_by_decade, income, '{MODIFIED}' FROM modified))
)""", ("training", "inference", "modified")),
    "runs": ("""
runs AS (
  SELECT n_name AS run_id, r_name AS experiment_id,
         round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0 END), 4) AS val_accuracy_score,
         round(avg(CASE WHEN o_orderstatus <> 'O' THEN 1.0::DOUBLE ELSE 0 END), 4) AS val_f1_score,
         round(avg(o_totalprice / 500000), 4) AS val_log_loss,
         round(avg(CASE WHEN o_totalprice > 250000 THEN 1.0::DOUBLE ELSE 0 END), 4) AS val_precision_score,
         round(avg(CASE WHEN o_orderpriority < '3' THEN 1.0::DOUBLE ELSE 0 END), 4) AS val_recall_score,
         round(avg(CASE WHEN c_acctbal > 0 THEN 1.0::DOUBLE ELSE 0 END), 4) AS val_roc_auc_score,
         'trees-' || lower(max(c_mktsegment)) AS model,
         CAST(count(*) % 10 AS VARCHAR) AS max_depth, max(c_mktsegment) AS booster,
         CAST(epoch(min(o_orderdate)) AS BIGINT) AS start_s, CAST(epoch(max(o_orderdate)) AS BIGINT) AS end_s
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  GROUP BY n_name, r_name
)""", ()),
    "entries": ("""
entries AS (
  SELECT run_id, experiment_id, start_s, end_s, "key", "value"
  FROM (SELECT run_id, experiment_id, start_s, end_s,
               CAST(val_accuracy_score AS VARCHAR) AS val_accuracy_score, CAST(val_f1_score AS VARCHAR) AS val_f1_score,
               CAST(val_log_loss AS VARCHAR) AS val_log_loss, CAST(val_precision_score AS VARCHAR) AS val_precision_score,
               CAST(val_recall_score AS VARCHAR) AS val_recall_score, CAST(val_roc_auc_score AS VARCHAR) AS val_roc_auc_score,
               model, max_depth, booster FROM runs)
  UNPIVOT ("value" FOR "key" IN (val_accuracy_score, val_f1_score, val_log_loss, val_precision_score,
                                 val_recall_score, val_roc_auc_score, model, max_depth, booster))
)""", ("runs",)),
    "refined": ("""
refined AS (
  SELECT run_id, experiment_id, start_s, end_s,
         CAST(CAST(val_accuracy_score AS FLOAT) AS DOUBLE) AS val_accuracy_score,
         CAST(CAST(val_f1_score AS FLOAT) AS DOUBLE) AS val_f1_score,
         CAST(CAST(val_log_loss AS FLOAT) AS DOUBLE) AS val_log_loss,
         CAST(CAST(val_precision_score AS FLOAT) AS DOUBLE) AS val_precision_score,
         CAST(CAST(val_recall_score AS FLOAT) AS DOUBLE) AS val_recall_score,
         CAST(CAST(val_roc_auc_score AS FLOAT) AS DOUBLE) AS val_roc_auc_score,
         CAST(max_depth AS DOUBLE) AS max_depth, CAST(NULL AS DOUBLE) AS booster,
         CAST(end_s - start_s AS INTEGER) AS "trainingDuration"
  FROM runs
)""", ("runs",)),
}


def gap_ctes(name: str, training_name: str, comparison_name: str) -> str:
    """CTE ``name``: (column, n, m, statistic, pvalue) of the four drift columns."""
    columns = ("fnlwgt", "hours_per_week", "log_capital_gain", "log_capital_loss")
    union = " UNION ALL ".join(
        f"SELECT '{c}' AS col, {c} AS v, {flag} AS compared FROM {source}"
        for c in columns for source, flag in ((training_name, 0), (comparison_name, 1))
    )
    return f"""
{name}_values AS (
  SELECT col, v, CAST(sum(1 - compared) AS DOUBLE) AS a, CAST(sum(compared) AS DOUBLE) AS b
  FROM ({union}) WHERE v IS NOT NULL GROUP BY col, v
),
{name}_gap AS (
  SELECT col, max(n) AS n, max(m) AS m, max(abs(ra / n - rb / m)) AS d
  FROM (SELECT col, sum(a) OVER w AS ra, sum(b) OVER w AS rb,
               sum(a) OVER (PARTITION BY col) AS n, sum(b) OVER (PARTITION BY col) AS m
        FROM {name}_values WINDOW w AS (PARTITION BY col ORDER BY v))
  GROUP BY col
),
{name}_z AS (SELECT *, round(n * m / (n + m)) AS e, sqrt(round(n * m / (n + m))) * d AS z FROM {name}_gap),
{name}_terms AS (
  SELECT *, pi() * pi() * (i - 0.5) * (i - 0.5) AS h, pi() * pi() * i * i AS g
  FROM (SELECT *, unnest(range(1, 101))::DOUBLE AS i FROM {name}_z WHERE z >= 0.2)
),
{name}_series AS (
  SELECT col,
    sum(exp(-h / (2*z*z))) * 2 AS s0,
    sum((h - z*z) * exp(-h / (2*z*z))) * 2 AS s1,
    sum((6*pow(z,6) + 2*pow(z,4) + h*(2*pow(z,4) - 5*z*z) + h*h*(1 - 2*z*z)) * exp(-h / (2*z*z))) * 2 AS s2,
    sum(g * exp(-g / (2*z*z))) * 2 AS t2,
    sum((h*h*h*(5 - 30*z*z) + h*h*(-60*z*z + 212*pow(z,4)) + h*(135*pow(z,4) - 96*pow(z,6))
         - 30*pow(z,6) - 90*pow(z,8)) * exp(-h / (2*z*z))) * 2 AS s3,
    sum((3*g*z*z - g*g) * exp(-g / (2*z*z))) * 2 AS t3
  FROM {name}_terms GROUP BY col
),
{name} AS (
  SELECT q.col AS "column", CAST(n AS BIGINT) AS n, CAST(m AS BIGINT) AS m, d AS statistic,
    least(greatest(CASE
      WHEN z < 0.2 THEN 1.0
      WHEN z * z >= 4 THEN 2 * exp(-pow(6 * e * d + 1, 2) / (18 * e))
      ELSE 1 - (sqrt(pi()/2)/z * s0 + sqrt(pi()/2)/(6*pow(z,4))*s1/sqrt(e)
                + (sqrt(pi()/2)/(72*pow(z,7))*s2 - sqrt(pi()/2)/(36*pow(z,3))*t2)/e
                + (sqrt(pi()/2)/(6480*pow(z,10))*s3 + sqrt(pi()/2)/(108*pow(z,6))*t3)/(e*sqrt(e)))
    END, 0), 1) AS pvalue
  FROM {name}_z q LEFT JOIN {name}_series s ON q.col = s.col
)"""


CTES["baseline_gap"] = (gap_ctes("baseline_gap", "training", "inference"), ("training", "inference"))
CTES["modified_gap"] = (gap_ctes("modified_gap", "training", "modified"), ("training", "modified"))


def drift_rows(gap: str, date: str, dataset: str) -> str:
    return f"""SELECT '{date}' AS "date", '{dataset}' AS dataset, "column",
  CAST(statistic AS FLOAT) AS statistic, CAST(pvalue AS FLOAT) AS pvalue,
  CASE WHEN pvalue < 0.05 THEN 0 ELSE 1 END AS passed FROM {gap}"""


CTES["history"] = (
    f"""history AS ({drift_rows('baseline_gap', '2000-01-01', INFERENCE)} UNION ALL
{drift_rows('modified_gap', '2010-01-01', MODIFIED)})""", ("baseline_gap", "modified_gap"))

CTES["metrics"] = ("""
metric_values AS (
  SELECT dataset, probability AS p, count(*) FILTER (income = '>50k')::DOUBLE AS pos,
         count(*) FILTER (income <> '>50k')::DOUBLE AS neg FROM scored GROUP BY dataset, probability
),
curve AS (
  SELECT dataset, sum(pos * (coalesce(below, 0) + neg / 2)) / (sum(pos) * sum(neg)) AS auc
  FROM (SELECT *, sum(neg) OVER (PARTITION BY dataset ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS below
        FROM metric_values) GROUP BY dataset
),
counts AS (
  SELECT dataset,
    count(*) FILTER (income = '>50k' AND predicted)::DOUBLE AS tp,
    count(*) FILTER (income <> '>50k' AND predicted)::DOUBLE AS fp,
    count(*) FILTER (income <> '>50k' AND NOT predicted)::DOUBLE AS tn,
    count(*) FILTER (income = '>50k' AND NOT predicted)::DOUBLE AS fn,
    avg(-ln(CASE WHEN income = '>50k' THEN probability ELSE 1 - probability END)) AS log_loss
  FROM scored GROUP BY dataset
),
rates AS (
  SELECT *, tp + fn AS pos, tn + fp AS neg,
    coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tn / nullif(tn + fn, 0), 0) AS p0,
    coalesce(tp / nullif(tp + fn, 0), 0) AS r1, coalesce(tn / nullif(tn + fp, 0), 0) AS r0 FROM counts
),
metrics AS (
  SELECT dataset, (tp + tn) / (pos + neg) AS accuracy_score,
    (coalesce(2*p1*r1 / nullif(p1 + r1, 0), 0) * pos + coalesce(2*p0*r0 / nullif(p0 + r0, 0), 0) * neg) / (pos + neg) AS f1_score,
    log_loss, (p1 * pos + p0 * neg) / (pos + neg) AS precision_score,
    (r1 * pos + r0 * neg) / (pos + neg) AS recall_score, auc AS roc_auc_score
  FROM rates JOIN curve USING (dataset)
)""", ("scored",))


def with_ctes(body: str, *names: str) -> str:
    """``body`` after the named CTEs and what they rest on."""
    ordered: list[str] = []

    def add(name: str) -> None:
        text, needs = CTES[name]
        for need in needs:
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(CTES[n][0].strip() for n in ordered) + "\n" + body if ordered else body
