"""Quality rules as a short-circuit cascade: cheap rules that reject much are asked first."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import stage
from .common import SPACE_CLASS, fresh, let, words

SYMBOLS = r"[#*$%&|<>]"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


@dataclass(frozen=True)
class Rule:
    """A document is rejected where ``fails(counts)`` is true; ``base`` rules are those of the contract."""

    name: str
    fails: Callable[[dict[str, Column]], Column]
    base: bool = False


def _repeat_words(w: Column) -> Column:
    """Words in 3-word windows found twice or more: windows are hashed, equal hashes are neighbours once sorted."""
    def window_hash(i):
        return F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))

    def places(hashes):
        return F.array_sort(F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    def twins(s):
        again = F.filter(s, lambda x, j: ((j > 0) & (F.get(s, j - 1)["h"] == x["h"])) | (F.get(s, j + 1)["h"] == x["h"]))
        return F.sort_array(F.transform(again, lambda x: x["i"]))

    def covered(starts):
        return F.aggregate(
            starts, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
            lambda a, x: F.struct((a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"), x.alias("last")))["n"]

    hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), window_hash)
    count = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(
        let(places(h), lambda s: covered(twins(s)))))
    return F.when(F.size(w) < 4, 0).otherwise(count)


def _counts(text: Column, w: Column) -> dict[str, Column]:
    """Expressions of all counts from a text that is not null and its words."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{SPACE_CLASS}]"))
    parts = {
        "n_words": F.size(w),
        "word_chars": F.length(F.array_join(w, "")),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_repeat_words": _repeat_words(w),
        "n_lines": F.size(lines),
    }
    return {name: parts[name].cast("long") for name in COUNTS}


def default_rules() -> list[Rule]:
    """Base rules of the contract, and milder ones for text that is not prose; their bounds lie far outside of prose."""
    return [
        Rule("too_short", lambda c: c["n_words"] < 50, base=True),
        Rule("repeats_itself", lambda c: 100 * c["n_repeat_words"] > 50 * c["n_words"], base=True),
        Rule("word_length", lambda c: (c["word_chars"] < 2 * c["n_words"]) | (c["word_chars"] > 20 * c["n_words"])),
        Rule("symbols", lambda c: 4 * c["n_symbols"] > c["n_words"]),
        Rule("repeated_lines", lambda c: 2 * c["n_dup_lines"] > c["n_lines"]),
    ]


def _judge(text: str, body: Callable[[dict[str, Column]], Column]) -> Column:
    """``body`` of the counts of a text. Its words are split once, bound inside the one expression: as a column of
    their own they would be split again wherever Spark moves a filter below that column."""
    value = F.coalesce(F.col(text), F.lit(""))
    return let(words(value), lambda w: body(_counts(value, w)))


def order_rules(docs: DataFrame, rules: list[Rule], text: str = "text", sample_rows: int = 2000,
                rounds: int = 2) -> list[Rule]:
    """Rules by rejection per cost, both measured on a random sample of about ``sample_rows`` rows.

    A rule's cost is the least time of some runs that ask it alone. The order decides the work only, never the
    verdict, so clocks and draws that differ between runs do not change results. Each task draws from its own rows.
    """
    share = min(1.0, sample_rows / max(1, docs.count()))
    sample = stage(docs.select(F.col(text)).sample(share, seed=1), "sample")

    def rejection_per_second(rule: Rule) -> float:
        frame, best, hits = sample.agg(F.count_if(_judge(text, rule.fails)).alias("n")), float("inf"), 0
        for _ in range(rounds):
            start = time.perf_counter()
            hits = frame.first().n
            best = min(best, time.perf_counter() - start)
        return hits / max(best, 1e-3)

    return sorted(rules, key=rejection_per_second, reverse=True)


def cascade(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text", sample_rows: int = 2000,
            keep_counts: bool = False) -> DataFrame:
    """``docs`` with ``failed_rule`` (the first rule of the cascade that rejects, null if none) and ``kept``.

    The rules are one conditional expression in the order of ``order_rules``: of a document that a rule rejects,
    later rules are not asked, and counts only they need are not made. A map over the rows; nothing is shuffled.
    ``keep_counts`` also returns the counts of every document and ``base_failed``, and so makes them all.

    Null or empty text has no words and fails ``too_short``; a rule that is null does not reject. Repeated rows are
    judged alike, an empty table gives an empty result, existing columns of the names added are replaced.
    """
    rules = default_rules() if rules is None else rules
    added = ("failed_rule", "kept") + ((*COUNTS, "base_failed") if keep_counts else ())
    plain = docs.drop(*added)
    ordered = order_rules(docs, rules, text, sample_rows)

    def verdict(counts: dict[str, Column]) -> Column:
        failed = F.lit(None).cast("string")
        for rule in reversed(ordered):
            failed = F.when(rule.fails(counts), F.lit(rule.name)).otherwise(failed)
        return failed

    if not keep_counts:
        judged = plain.withColumn("failed_rule", _judge(text, verdict))
        return judged.withColumn("kept", F.col("failed_rule").isNull())
    held = fresh(plain, "_counts")
    judged = plain.withColumn(held, _judge(text, lambda counts: F.struct(*[c.alias(name) for name, c in counts.items()])))
    counts = {name: F.col(held)[name] for name in COUNTS}
    base = F.lit(False)
    for rule in rules:
        base = base | F.coalesce(rule.fails(counts), F.lit(False)) if rule.base else base
    judged = judged.withColumns({"failed_rule": verdict(counts), "base_failed": base, **counts})
    return judged.withColumn("kept", F.col("failed_rule").isNull()).select(*plain.columns, *added)
