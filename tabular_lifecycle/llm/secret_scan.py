"""Secret scan: spans by pattern, told apart by how many owners in the corpus hold the same value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

# Fixed patterns of the contract, with the group that must be long enough and its least length.
ASSIGN = r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex")
# Candidates beyond the base kinds: long runs of key characters that mix letters with digits.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{20,}"


def spans(text: Column, pattern: str) -> Column:
    """All leftmost matches of ``pattern`` as structs (s, e, v): code points from s to e, and the matched text.

    The texts between the matches are what ``split`` leaves, so places are running sums of lengths.
    """
    def placed(found, gaps):
        ends = F.aggregate(
            F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.struct(F.length(g).alias("g"), m.alias("m"))),
            F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int,v:string>>").alias("all")),
            lambda a, x: let(a["at"] + x["g"], lambda s: F.struct(
                (s + F.length(x["m"])).alias("at"),
                F.concat(a["all"], F.array(F.struct(s.alias("s"), (s + F.length(x["m"])).alias("e"), x["m"].alias("v")))).alias("all"))))
        return ends["all"]

    empty = F.array().cast("array<struct<s:int,e:int,v:string>>")
    return F.when(text.rlike(pattern), let(F.regexp_extract_all(text, F.lit(pattern), 0),
                                           lambda f: let(F.split(text, pattern, -1), lambda g: placed(f, g)))).otherwise(empty)


def _line(found: Column) -> Column:
    """Spans (s, k, name, e) joined as kind:start:end, by start and then kind."""
    return F.array_join(F.transform(F.array_sort(found), lambda x: F.concat_ws(":", x["name"], x["s"], x["e"])), ",")


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", owner: str = "source",
         repository: str = "doc_id", max_owners: int = 1, max_repositories: int = 3) -> DataFrame:
    """Base spans of every text and, beside them, the candidates whose ownership looks live.

    A candidate is a long run of key characters outside of the base spans, or a base value. Its hash is counted over
    the corpus by distinct repositories and distinct owners. One owner, in however many repositories (copies of a document
    by its owner spread nothing), or at most ``max_owners`` owners with at most ``max_repositories`` repositories for each of
    them: an owner's own, live-looking credential, whose candidate span is added as kind ``live``. Wider spread: a
    copied example; its span is not added, base spans stay whatever their spread.

    Spans are found inside each row; only candidates are shuffled (hash, owner, place), pre-aggregated per hash, and
    the texts never. Returns doc_id, base (list of spans), found (with ``live`` ones), n_assign, n_access, n_hex,
    n_live, n_copied (candidates and base values that are copied widely).

    Null or empty text: no spans. A null owner or repository counts as one owner or repository. Repeated rows: each
    is returned; they add no owner. Empty table: empty result. Other columns are left out, so none can clash.
    """
    base_of = [F.filter(spans(F.col("t"), ASSIGN), lambda x: F.length(F.regexp_extract(x["v"], ASSIGN, 1)) >= 8),
               spans(F.col("t"), ACCESS), spans(F.col("t"), HEX)]
    kind = "struct<s:int,k:int,name:string,e:int>"

    def span(x, number, name):
        return F.struct(x["s"].alias("s"), F.lit(number).alias("k"), F.lit(name).alias("name"), x["e"].alias("e"))

    def based(number):
        return F.transform(f"b{number}", lambda x: span(x, number, KINDS[number]))

    def held_by(number, value):
        return F.transform(f"b{number}", lambda x: F.struct(value(x).alias("v"), F.lit(None).cast(kind).alias("span")))

    def apart(x):
        return ~F.exists("base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))

    base = F.concat(*[based(i) for i in range(3)])
    values = F.concat(
        held_by(0, lambda x: F.regexp_extract(x["v"], ASSIGN, 1)), held_by(1, lambda x: x["v"]), held_by(2, lambda x: x["v"]),
        F.transform(F.filter(spans(F.col("t"), CANDIDATE), apart),
                    lambda x: F.struct(x["v"].alias("v"), span(x, 3, "live").alias("span"))))
    rows = (docs.select(F.col(doc_id).alias("d"), F.col(owner).alias("o"), F.col(repository).alias("r"),
                        F.coalesce(F.col(text), F.lit("")).alias("t"))
            .withColumns({f"b{i}": c for i, c in enumerate(base_of)}).withColumn("base", base)
            .select("d", "o", "r", F.xxhash64("t").alias("p"), "base", values.alias("c"),
                    *[F.size(f"b{i}").cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]))
    held = rows.where(F.size("c") > 0).select("d", "p", "o", "r", F.explode("c").alias("c")).select(
        "d", "p", "o", "r", F.sha2("c.v", 256).alias("h"), "c.span")
    spread = (held.groupBy("h", "o", "r").agg(F.lit(1).alias("one")).groupBy("h", "o").agg(F.count("*").alias("rs"))
              .groupBy("h").agg(F.count("*").alias("owners"), F.sum("rs").alias("places")))
    live = (F.col("owners") <= max_owners) & ((F.col("owners") == 1) | (F.col("places") <= max_repositories * F.col("owners")))
    judged = (held.join(spread, "h").groupBy("d", "p").agg(
        F.collect_set(F.when(live, F.col("span"))).alias("live"),
        F.count_distinct(F.when(~live, F.col("h"))).alias("n_copied")))
    joined = rows.drop("c", "o", "r").join(
        judged.withColumnsRenamed({"d": "_d", "p": "_p"}), F.col("d").eqNullSafe(F.col("_d")) & (F.col("p") == F.col("_p")), "left")
    extra = F.coalesce("live", F.array().cast(f"array<{kind}>"))
    return joined.select(
        F.col("d").alias(doc_id), "base", F.concat("base", extra).alias("found"), "n_assign", "n_access", "n_hex",
        F.size(extra).cast("long").alias("n_live"), F.coalesce("n_copied", F.lit(0)).cast("long").alias("n_copied"))


def span_text(found: Column) -> Column:
    return _line(found)
