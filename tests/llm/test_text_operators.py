import hashlib
import re
from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

from tabular_lifecycle.llm import bpe, line_dedup, lm_score, ngram_join, pii, quality_rules, secret_scan


def tuples(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def close(got, want):
    key = lambda r: tuple((x is not None, x if not isinstance(x, float) else 0) for x in r[:5])
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_line_dedup(docs, rows, no_docs):
    out = line_dedup.dedup_lines(docs)
    assert set(docs.columns) | {"n_dropped"} == set(out.columns)
    got = tuples(out, "doc_id", "n_lines", "n_dropped", F.coalesce("text", F.lit("")))
    assert got == Counter(brute.line_dedup(rows))
    assert sum(c for (_, _, n, _), c in got.items() if n) >= 5
    assert line_dedup.dedup_lines(no_docs).count() == 0


def test_quality_cascade(docs, rows, no_docs):
    names = list(quality_rules.COUNTS)
    out = quality_rules.cascade(docs, keep_counts=True)
    got = tuples(out, "doc_id", *names)
    assert got == Counter((d, *brute.counts(t).values()) for d, t, *_ in rows)
    plain = quality_rules.cascade(docs)
    assert tuples(plain, "doc_id", "kept") == tuples(out, "doc_id", "kept")
    for r in out.collect():
        c = {n: r[n] for n in names}
        bad = {"too_short": c["n_words"] < 50, "repeats_itself": 100 * c["n_repeat_words"] > 50 * c["n_words"]}
        assert r.base_failed == any(bad.values())
        assert r.kept == (r.failed_rule is None) and (r.kept is False or not r.base_failed)
    assert quality_rules.cascade(no_docs).count() == 0


def test_rule_order_is_rejection_per_cost_and_never_the_verdict(docs):
    rare = quality_rules.Rule("rare", lambda c: c["n_repeat_words"] < 0)
    common = quality_rules.Rule("common", lambda c: c["n_words"] < 50)
    assert [r.name for r in quality_rules.order_rules(docs, [rare, common])] == ["common", "rare"]
    one = quality_rules.cascade(docs, [rare, common]).where("kept").count()
    assert one == quality_rules.cascade(docs, [common, rare]).where("kept").count()


@pytest.mark.parametrize("width, above", [(3, 90), (5, 80), (1, 50)])
def test_ngram_join(docs, rows, width, above):
    out = ngram_join.link_classes(docs, width, above, 100)
    assert tuples(out, "d", "n_shingles", "component_id") == Counter(brute.link_components(rows, width, above, 100))


def test_ngram_join_of_empty_and_of_many_near_copies(spark, no_docs):
    assert ngram_join.link_classes(no_docs).count() == 0
    rows = [(i, " ".join(f"w{j}" if j != i % 150 else f"x{i}" for j in range(150)), None, None, None) for i in range(400)]
    near = spark.createDataFrame(rows, no_docs.schema)
    out = ngram_join.link_classes(near, 3, 90, 100, block_sets=64)
    assert tuples(out, "d", "n_shingles", "component_id") == Counter(brute.link_components(rows, 3, 90, 100))


def test_linked_sets_share_a_fragment():
    import numpy as np

    random = np.random.default_rng(5)
    for above in (80, 90):
        fragments = ngram_join.Fragments(above, 100)
        for size in [1, 2, 3, 5, 9, 10, 11, 19, 20, 21, 40, 100, 301, 1000] * 4:
            a = np.unique(random.integers(0, 2**64, size, dtype=np.uint64))
            for lost in range(len(a)):
                for added in {0, lost}:
                    b = np.unique(np.concatenate([a[lost:], random.integers(0, 2**64, added, dtype=np.uint64)]))
                    if 100 * (len(a) - lost) >= above * (len(a) + added):
                        assert np.intersect1d(fragments.signatures(a), fragments.signatures(b)).size


def test_keep_one(docs):
    kept = ngram_join.keep_one(docs, width=3, above=90)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.select("doc_id").collect())
    assert ids[0] == 2 and 1 not in ids and 2 in ids or 2 not in ids
    assert ids[None] == 2 and ids[4] == ids[5] == 1


def test_of_one_id_with_two_texts_only_the_copy_goes(spark, no_docs):
    prose = " ".join(f"w{i}" for i in range(80))
    rows = [(1, prose, "en", "s", 0), (2, prose + " more", "en", "s", 0), (2, "quite another text " + prose[::-1], "en", "s", 0), (2, prose + " more", "en", "s", 0)]
    kept = ngram_join.keep_one(spark.createDataFrame(rows, no_docs.schema), width=3, above=90)
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([rows[0][:2], rows[2][:2]])


def test_bits_rule_out_no_linked_pair():
    import numpy as np

    random = np.random.default_rng(4)
    for size in (1, 5, 40, 300, 9000):
        a = np.unique(random.integers(0, 2**64, size, dtype=np.uint64))
        for lost in {0, size // 20, size // 10, size // 6}:
            b = np.unique(np.concatenate([a[lost:], random.integers(0, 2**64, lost, dtype=np.uint64)]))
            held = len(np.intersect1d(a, b))
            may = ngram_join.may_link([ngram_join.bits_of(a)], np.array([len(a)]), [ngram_join.bits_of(b)], np.array([len(b)]), 80, 100)[0, 0]
            assert may or 100 * held < 80 * (len(a) + len(b) - held)
        other = np.unique(random.integers(0, 2**64, size, dtype=np.uint64))
        if 5 <= size <= 300:
            assert not ngram_join.may_link([ngram_join.bits_of(a)], np.array([len(a)]), [ngram_join.bits_of(other)], np.array([len(other)]), 80, 100)[0, 0]


def test_a_chain_of_shared_passages_is_no_cluster(spark, no_docs):
    """Neighbours share a passage and none are linked: hardly any pair is compared exactly."""
    passage = lambda i: [f"p{i}x{j}" for j in range(40)]
    rows = [(i, " ".join(passage(i) + [f"own{i}x{j}" for j in range(60)] + passage(i + 1)), None, None, None) for i in range(300)]
    chain = spark.createDataFrame(rows, no_docs.schema)
    pairs, sets = ngram_join.shared_fragments(chain, 5, 80, 100, 2)
    assert pairs.count() >= 250 and ngram_join.near_pairs(pairs, sets, 80, 100, 64).count() == 0
    assert ngram_join.link_classes(chain).where("component_id <> d").count() == 0


@pytest.mark.parametrize("hot_in_block, hot", [(0, 0), (1, 2), (10**6, 10**6)])
def test_hot_and_cold_fragments_give_the_same_links(docs, rows, monkeypatch, hot_in_block, hot):
    monkeypatch.setattr(ngram_join, "_HOT_IN_BLOCK", hot_in_block)
    monkeypatch.setattr(ngram_join, "_HOT", hot)
    out = ngram_join.link_classes(docs, 3, 90, 100, block_sets=2)
    assert tuples(out, "d", "n_shingles", "component_id") == Counter(brute.link_components(rows, 3, 90, 100))


@pytest.mark.parametrize("hot_in_block, hot", [(8, 32), (100, 4), (1, 1)])
def test_a_passage_that_many_texts_quote_joins_none_of_them(spark, no_docs, monkeypatch, hot_in_block, hot):
    monkeypatch.setattr(ngram_join, "_HOT_IN_BLOCK", hot_in_block)
    monkeypatch.setattr(ngram_join, "_HOT", hot)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [" ".join(f"w{d}x{i}" for i in range(240)) + " " + passage for d in range(80)]
    texts += [t + f" more{i}" for i, t in enumerate(texts[:3])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], no_docs.schema)
    pairs, _ = ngram_join.shared_fragments(docs, 5, 80, 100, 3)
    assert pairs.where("hot").count() <= (0 if hot > 1 else 10_000)
    out = ngram_join.link_classes(docs)
    assert {(r.d, r.component_id) for r in out.where("d <> component_id").collect()} == {(80, 0), (81, 1), (82, 2)}


def test_linked_sets_share_as_many_fragments_of_a_list_as_it_says():
    import numpy as np

    random, fragments = np.random.default_rng(6), ngram_join.Fragments(80, 100)
    for size in [1, 4, 9, 10, 11, 20, 40, 64, 65, 100, 301, 1000] * 4:
        a = np.unique(random.integers(0, 2**64, size, dtype=np.uint64))
        for lost, added in ((size // 5, 0), (size // 9, size // 9), (0, size // 4)):
            b = np.unique(np.concatenate([a[lost:], random.integers(0, 2**64, added, dtype=np.uint64)]))
            assert 100 * (len(a) - lost) >= 80 * (len(a) + added)
            for x, y in ((a, b), (b, a)):
                others = fragments.signatures(y)
                # Of the lists that both name, the last one has the promise; others are named in addition.
                assert any(len(np.intersect1d(names, others)) >= max(1, least) for names, least in fragments.lists(x))


def test_sorted_hashes_pack():
    import numpy as np

    numbers = np.unique(np.random.default_rng(1).integers(0, 2**56, 5000, dtype=np.uint64))
    packed = ngram_join.pack_sorted(numbers)
    assert (ngram_join.unpack_sorted(packed) == numbers).all() and len(packed) < 6.5 * len(numbers)
    assert not len(ngram_join.unpack_sorted(ngram_join.pack_sorted(numbers[:0])))


def test_secret_scan(docs, rows, no_docs):
    out = secret_scan.scan(docs)
    got = tuples(out, "doc_id", secret_scan.span_text(F.col("base")))
    assert got == Counter((d, ",".join(brute.base_spans(t))) for d, t, *_ in rows)
    assert secret_scan.scan(no_docs).count() == 0


def test_secret_ownership(spark, no_docs):
    copied, own = "Zx9" * 9, "Qw7" * 9
    rows = [(i, f"key {copied} end", "en", f"o{i}", 0) for i in range(5)] + [(9, f"key {own} end", "en", "o1", 0)]
    out = {r.doc_id: r for r in secret_scan.scan(spark.createDataFrame(rows, no_docs.schema)).select(
        "doc_id", "n_live", "n_copied", secret_scan.span_text(F.col("found")).alias("s")).collect()}
    assert (out[9].n_live, out[9].n_copied, out[9].s) == (1, 0, "live:4:31")
    assert all((out[i].n_live, out[i].n_copied, out[i].s) == (0, 1, "") for i in range(5))


def test_copies_by_one_owner_keep_its_secret(spark, no_docs):
    """Six copies of a document and four other files of one owner hold its key; another key has a second owner."""
    own, copied = "Qw7" * 9, "Zx9" * 9
    rows = [(i, f"key {own} end", "en", "o1", 0) for i in range(6)] + [(i, f"key {own} in {i}", "en", "o1", 0) for i in range(6, 10)]
    rows += [(i, f"key {copied} end", "en", f"o{i % 2}", 0) for i in range(10, 16)]
    docs = spark.createDataFrame(rows, no_docs.schema)
    out = {r.doc_id: (r.n_live, r.n_copied, r.s) for r in secret_scan.scan(docs).select(
        "doc_id", "n_live", "n_copied", secret_scan.span_text(F.col("found")).alias("s")).collect()}
    assert out == {i: (1, 0, "live:4:31") if i < 10 else (0, 1, "") for i in range(16)}
    wider = {r.doc_id: r.n_live for r in secret_scan.scan(docs, max_owners=2, max_repositories=2).collect()}
    assert wider == {i: int(i < 10) for i in range(16)}


def test_pii(docs, rows, no_docs):
    out = pii.replace_pii(docs, key="k")
    assert pii.replace_pii(no_docs, key="k").count() == 0
    by_id = {r.doc_id: r for r in out.collect() if r.doc_id is not None}
    texts = {d: t for d, t, *_ in rows}
    text = by_id[19].text
    assert by_id[19].n_entities == 6
    for private in ("Ann.Bee", "ann.bee", "555-9887", "4539 1488", "10.20.30.40"):
        assert private not in text
    mails = [w for w in text.replace(",", "").split() if "@" in w]
    assert mails[0].lower() == mails[1] and mails[0][0].isupper() and mails[0].endswith(".org")
    phones = text.split("call ")[1].split(", ")[0].split(" or ")
    assert phones[0] == "+1 " + phones[1] and len(phones[0]) == len("+1 (464) 555-9887")
    card = "".join(c for c in text.split(", ")[2] if c.isdigit())
    digits = [int(c) for c in card[::-1]]
    assert card[0] == "4" and (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0
    names = by_id[20].text
    assert names.startswith("Herr ") and "Mrs. " in names and "Frau " in names and "Beispiel" not in names and "Roe" not in names
    assert by_id[20].n_entities == 3
    untouched = [d for d, r in by_id.items() if r.n_entities == 0]
    assert len(untouched) > 15 and all(by_id[d].text == texts[d] for d in untouched)
    again = {r.doc_id: r.text for r in pii.replace_pii(docs, key="k").collect()}
    assert again[19] == text != {r.doc_id: r.text for r in pii.replace_pii(docs, key="other").collect()}[19]


def replaced(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {texts[r.doc_id]: r.text for r in pii.replace_pii(frame, key="k").collect()}


def test_families_are_distinct_and_keep_their_surrogate(spark):
    families = [f"Mr {a}{b}{c}" for a in "BCDFGKLMNP" for b in "aeiou" for c in ("n", "rt", "ssel", "mm", "lk", "nd", "st", "tz")]
    first = ["Mr John Ban", "Mr Robert Ban", "Mrs John Ban", "Mr Παπαδόπουλος"]
    out = replaced(spark, families + first)
    assert len({out[t] for t in families}) == len(families)
    assert not {out[t] for t in families} & set(families)
    john, robert, mrs = (out[t].split(" ") for t in first[:3])
    assert john[2] == robert[2] == mrs[2] == out["Mr Ban"].split(" ")[1] and len({john[1], robert[1], mrs[1]}) == 3
    assert all("Ͱ" <= c <= "Ͽ" for c in out["Mr Παπαδόπουλος"][3:])


def test_given_names_after_titles_of_either_gender(spark):
    out = replaced(spark, ["Mrs Jane Roe", "Frau Dr. Jane Roe", "Dr Jane Roe", "Dr Jim Roe"])
    jane = out["Mrs Jane Roe"][4:]
    assert out["Frau Dr. Jane Roe"] == "Frau Dr. " + jane and out["Dr Jane Roe"] == "Dr " + jane
    assert out["Dr Jim Roe"].split()[1] != jane.split()[0] and out["Dr Jim Roe"].split()[2] == jane.split()[1]


@pytest.mark.parametrize("kind, mention, rest", [
    ("email", "ann@site.com", "-thanks"), ("email", "ann@site.com", "--"), ("email", "ann@site.com", ".2024"),
    ("email", "jörg.o'neill@bücher.example.org", ". Next"), ("email", "ann@site.co.uk", ""),
    ("phone", "(743)555-3824", " x"), ("phone", "7435553824", "."), ("phone", "+17435553824", ","), ("phone", "+44 20 7946 0958", ". 2"),
    ("phone", "+442079460958", ""), ("phone", "0044 20 7946 0958", ""), ("phone", "+44 (0)20 7946 0958", ""), ("phone", "01 23 45 67 89", ""),
    ("phone", "020 7946 0958", ""), ("phone", "1-743-555-3824", ""), ("name", "Mrs Mary Ann Roe", " left"), ("name", "Mr McDonald", ""),
    ("name", "Mr J. Smith", ". He"), ("name", "Mr O'Brien", "'s car"), ("name", "Mr O’Brien", "’s car"), ("name", "Dr Roe", ", who"), ("name", "Mr.\u00a0Jane\u00a0Roe", ""),
    ("name", "Mr J.R.R. Tolkien", ""), ("name", "Herr Prof. Dr. von der Leyen", " und"), ("name", "Mme Anne-Marie de la Cruz", " et"),
    ("name", "MR. SMITH", " "), ("name", "Mr Smith", " Mr Roe"), ("name", "Mr John Smith", " Jr."), ("name", "Г-жа Анна Иванова", " и")])
def test_whole_entities_are_found(spark, kind, mention, rest):
    row = spark.range(1).select(F.regexp_extract_all(F.lit(f"by {mention}{rest}"), F.lit(pii.ANY), 0).alias("m"))
    first = row.select("m", pii.kind_of(F.col("m")[0]).alias("k")).first()
    assert first.m[0] == mention and first.k == kind


def test_numbers_that_are_no_phones_stay(spark):
    texts = ["at 1700000000", "0.7435553824 of 743555.3824", "on 01-02-2024 10:30", "v 123.4567890", "Miss the bus, Mr. and so on"]
    assert replaced(spark, texts) == {t: t for t in texts}


def test_written_in_the_format_of_the_mention(spark):
    texts = ["+44 20 7946 0958", "+44 (0)20 7946 0958", "0044 2079460958", "+1 207-946-0958", "(207)946-0958", "2079460958",
             "Mr J. R. O'Brien's", "MR O’BRIEN", "Mme de la Cruz"]
    out = replaced(spark, texts)
    digits = lambda t: "".join(c for c in out[t] if c.isdigit())
    assert out[texts[1]] == out[texts[0]].replace("+44 ", "+44 (0)") and digits(texts[2]) == "00" + digits(texts[0])
    assert digits(texts[0])[:2] == "44" and digits(texts[0]) != "442079460958" and digits(texts[0])[2:] != digits(texts[5])
    assert digits(texts[3]) == "1" + digits(texts[4]) == "1" + digits(texts[5]) and out[texts[4]][4] == ")"
    j, r, family = out[texts[6]].split(" ")[1:]
    assert len(j) == len(r) == 2 and j[0] != "J" and r[0] != "R" and j != r and family.endswith("'s")
    assert out[texts[7]] == "MR " + family[:-2].upper() and out[texts[8]].startswith("Mme de la ") and "Cruz" not in out[texts[8]]


def test_surrogates_stay_distinct(spark):
    """Three-digit cards leave few surrogates, so draws meet and are drawn again."""
    entities = spark.range(400).selectExpr("'ssn' AS kind", "lpad(id, 3, '0') AS canon")
    out = pii.surrogates(entities.where("canon < '300'"), "k", max_rounds=60).collect()
    assert len(out) == 300 == len({r.surrogate for r in out})
    assert not {r.surrogate for r in out} & {r.canon for r in out}


def test_surrogates_of_a_crowded_shape(spark):
    """500 of the 676 addresses a@b.com are real, so not all surrogates can keep the shape."""
    entities = spark.range(500).selectExpr("'email' AS kind", "concat(char(97 + id div 26), '@', char(97 + id % 26), '.com') AS canon")
    out = pii.surrogates(entities, "k").collect()
    assert len(out) == 500 == len({r.surrogate for r in out})
    assert not {r.surrogate for r in out} & {r.canon for r in out}
    assert all(re.fullmatch(r"[a-z]+@[a-z]\.com", r.surrogate) for r in out)
    assert sum(len(r.surrogate) == 7 for r in out) > 100
    with pytest.raises(ValueError):
        pii.surrogates(spark.range(10).selectExpr("'ssn' AS kind", "string(id) AS canon"), "k", max_rounds=3)


def test_bpe_equals_the_library(docs, rows, no_docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.vocabulary_path())
    vocabulary = bpe.read_vocabulary(bpe.vocabulary_path())
    out = bpe.decode(bpe.encode(docs, vocabulary), vocabulary, digest="ids_sha256")
    want = Counter()
    for d, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        digest = hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        want[d, tuple(ids), digest, library.decode(ids, skip_special_tokens=False)] += 1
    got = Counter((r.doc_id, tuple(r.ids), r.ids_sha256, r.text) for r in out.collect())
    assert got == want
    assert bpe.encode(no_docs, vocabulary).count() == 0


def test_bpe_units_on_random_white_space(spark):
    import random

    from tokenizers import Tokenizer

    library, draw = Tokenizer.from_file(bpe.vocabulary_path()), random.Random(3)
    special = bpe._special_pattern(bpe.read_vocabulary(bpe.vocabulary_path()))
    parts = [" ", "  ", "\n", "\t", "\r\n", " ", " ", "\u001c", "a", "Été", "12", "'s", "!?", "<|endoftext|>", "字", "\u0085", "it's"]
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 12)))
        ids = [i for u in bpe.units(text, special) for i in library.encode(u, add_special_tokens=False).ids]
        assert "".join(bpe.units(text, special)) == text
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_lm_scores(docs, rows, no_docs):
    held_out = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "utf-8")) % 7 == 2
    out = lm_score.score(docs, held_out)
    close([tuple(r) for r in out.collect()], brute.lm_scores(rows, 200.0))
    assert lm_score.score(no_docs, held_out).count() == 0


def test_lm_learns_what_repeats(spark, no_docs):
    """On text held out, pairs that the training rows repeat are worth more than single words."""
    rows = [(i, " ".join(["the quick brown fox jumps over the lazy dog"] * 5), None, None, None) for i in range(200)]
    frame = spark.createDataFrame(rows, no_docs.schema).coalesce(1)
    held = lm_score.score(frame, F.col("doc_id") >= 150).where("held_out").agg(F.sum("base_score").alias("b"), F.sum("score").alias("s")).first()
    assert held.s > 0.5 * held.b


def test_numbering_words_holds_less_than_their_objects():
    """The same numbers as text by text, at less memory than all texts, words and coded words as Python's objects."""
    import random
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from tabular_lifecycle.llm.blocks import Vocabulary, pack, unpack

    draw = random.Random(5)
    texts = [" ".join(f"w{draw.randrange(10**7)}" for _ in range(100)) for _ in range(1500)] + [None, "", "a\n\nb  c"]
    column = pa.chunked_array([texts[:700], texts[700:]], pa.string())

    def by_text():
        vocabulary = Vocabulary()
        places = [pack(vocabulary.numbers(bpe.units(x, None))) if x else b"" for x in column.to_pylist()]
        words = vocabulary.words()
        "\0".join(words).encode()
        return places, words, [w.encode() for w in words]

    def peak(function):
        tracemalloc.start()
        out = function()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return out, most

    (places, words, _), old = peak(by_text)
    (packed, kinds, print_), new = peak(lambda: bpe.number_words(column, None))
    assert kinds.to_pylist() == words and packed == places and print_ == bpe.number_words(column, None, places=False)[2]
    assert "".join(words[i] for i in unpack(packed[-1])) == "a\n\nb  c" and np.unique(unpack(packed[0])).size <= 100
    assert new < 0.8 * old
    assert len(bpe.number_words(pa.chunked_array([[None, ""]], pa.string()), None)[1]) == 0
