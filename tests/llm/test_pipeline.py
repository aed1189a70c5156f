import importlib
import random
from collections import Counter

import brute
import pytest

from tabular_lifecycle.llm import bpe, quality_rules

pipeline = importlib.import_module("corpus_pipeline")


@pytest.fixture(scope="module")
def sf_dir(spark, rows, tmp_path_factory):
    """Prose with exact and near copies, lines that many documents share, rejected texts and the edge rows."""
    draw, made = random.Random(11), []
    pool = [f"w{i}" for i in range(400)]
    for i in range(120):
        lines = [" ".join(draw.choices(pool, k=draw.randint(15, 30))) for _ in range(draw.randint(4, 8))]
        if i % 4 == 0:
            lines.insert(2, "A line that many documents of this corpus share")
        made.append((1000 + i, "\n".join(lines), "en", f"s{i % 4}" if i % 3 else "s0", 0))
    for i in range(20):
        text = made[i][1]
        made.append((2000 + i, text if i % 2 else text.replace(" w1", " x1", 2), "en", "s2", 0))
    made += [(3000 + i, "junk # $ % " * 30, "en", "s1", 0) for i in range(3)]
    folder = tmp_path_factory.mktemp("corpus")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(made + rows, schema).repartition(3).write.parquet(str(folder / "documents.parquet"))
    return str(folder)


def test_pipeline_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, start = docs.columns, [tuple(r) for r in docs.collect()]
    outputs = {}
    for name, function in pipeline.STAGES:
        out = function(spark, docs, sf_dir)
        outputs[name] = [tuple(r) for r in out.collect()]
        if name != pipeline.STAGES[-1][0]:
            assert out.columns == columns
            docs = pipeline.stage(out)

    def kept(text):
        c = brute.counts(text)
        return not (c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"] or 4 * c["n_symbols"] > c["n_words"]
                    or not 2 * c["n_words"] <= c["word_chars"] <= 20 * c["n_words"] or 2 * c["n_dup_lines"] > c["n_lines"])

    good = [r for r in start if kept(r[1])]
    assert Counter(outputs["quality rules"]) == Counter(good) and len(good) < len(start) - 15
    texts = brute.line_dedup(good)
    want = [(d, t if n else r[1], *r[2:4], len(t) if n else r[4]) for r, (d, _, n, t) in zip(good, texts)]
    assert Counter(outputs["line dedup"]) == Counter(want) and any(n for _, _, n, _ in texts)
    linked = brute.link_components(want, 5, 80, 100)
    alone = [r for r, (d, n, c) in zip(want, linked) if d is None or n == 0 or d == c]
    assert Counter(outputs["near duplicates"]) == Counter(alone) and len(alone) < len(want) - 15

    sizes, taken = Counter(), Counter()
    for r in alone:
        sizes[r[3]] += len(brute.WORD.findall(r[1] or ""))
    copies = Counter(outputs["source mix"])
    assert set(copies) <= set(alone) and max(copies.values()) <= 3 * max(Counter(alone).values())
    for r, n in copies.items():
        taken[r[3]] += n * len(brute.WORD.findall(r[1] or ""))
    for source, target in brute.targets(sizes).items():
        assert abs(taken[source] - target) <= 300

    tokens = pipeline.tokens(spark, docs, sf_dir)
    back = bpe.decode(tokens, bpe.read_vocabulary(bpe.vocabulary_path()))
    assert Counter((r.doc_id, r.text, r.n_tokens == len(r.ids)) for r in back.collect()) == Counter(
        (r[0], r[1] or "", True) for r in outputs["source mix"])
    run = Counter((r.doc_id, tuple(r.ids)) for r in pipeline.run(spark, sf_dir).select("doc_id", "ids").collect())
    assert run == Counter((r.doc_id, tuple(r.ids)) for r in tokens.collect())


def test_pipeline_of_nothing(spark, no_docs, tmp_path):
    no_docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0
    assert quality_rules.cascade(no_docs).count() == 0


def test_extra_columns_with_clashing_names_pass_through(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    from pyspark.sql import functions as F

    names = ["kept", "failed_rule", "n_lines", "n_dropped", "size", "target", "passes", "source_size", "d", "_extra_1", "_lost"]
    wide = docs.withColumns({n: F.lit(i) for i, n in enumerate(names)})
    plain = docs
    for name, function in pipeline.STAGES[:-1]:
        wide, plain = pipeline.stage(function(spark, wide, sf_dir)), pipeline.stage(function(spark, plain, sf_dir))
        assert wide.columns == [*docs.columns, *names], name
        assert Counter(map(tuple, wide.select(*docs.columns).collect())) == Counter(map(tuple, plain.collect())), name
        assert wide.where(" AND ".join(f"{n} = {i}" for i, n in enumerate(names))).count() == wide.count()
