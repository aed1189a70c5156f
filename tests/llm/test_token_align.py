import tracemalloc
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabular_lifecycle.llm import token_align

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
TEXTS = ["Hello world, a plain line of text.", "two  spaces and   three", " leads with a space", "ends with one ", "   ", " ", "tab\tand\nlines\n\n end",
         "<|endoftext|> and <s> </s> <unk> <0x41>", "日本語の文章 と 言葉", "emoji 👩‍👩‍👧 🎉🎉 é e\u0301", "mark ▁ inside", "x" * 3000, "don't we'll 123456 $%^&*()", "\u001c\u3000\u00a0 odd spaces",
         "ααβ γδ Здравствуй мир", "\U00010348\U0001F600" * 200, "the the the the"]


def ends(tokens):
    return np.cumsum([len(t) for t in tokens], dtype=np.int64)


def brute(rows, models):
    """Whole texts, both tokenizers, sets of ends and all pairs by plain loops."""
    pair = token_align.Pair(*models)
    made = []
    for doc_id, text, *_ in rows:
        groups = []
        if text:
            a = pair.a.encode(" " + text, add_special_tokens=False).ids
            b = pair.b.encode(text)
            if b"".join(pair.a_bytes[i] for i in a) == b"".join(pair.b_bytes[i] for i in b) == (" " + text).encode():
                ea, eb = ends([pair.a_bytes[i] for i in a]).tolist(), ends([pair.b_bytes[i] for i in b]).tolist()
                i = j = 0
                for e in sorted(set(ea) & set(eb)):
                    i2, j2 = ea.index(e) + 1, eb.index(e) + 1
                    groups.append((a[i:i2], b[j:j2]))
                    i, j = i2, j2
        made.append((doc_id, groups))
    count = Counter()
    for _, groups in made:
        count.update({(x, y) for a, b in groups for x in a for y in b})
    most = {}
    for (x, _), n in count.items():
        most[x] = max(n, most.get(x, 0))
    out = Counter()
    for doc_id, groups in made:
        links = [(x, y) for a, b in groups for x in a for y in b]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out[doc_id, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
            sum(count[x] == most[x[0]] for x in links), sum(count[x] for x in links), sha256(text.encode()).hexdigest() if groups else ""] += 1
    return out


@pytest.fixture(scope="module")
def models():
    return token_align.read_models()


@pytest.mark.parametrize("block_bytes", [token_align.BLOCK_BYTES, 500])
def test_align_equals_brute_force(docs, rows, no_docs, models, block_bytes):
    out = token_align.align(docs, *models, block_bytes=block_bytes)
    got = Counter(tuple(r) for r in out.select(*COLUMNS).collect())
    assert got == brute(rows, models)
    if block_bytes == 500:
        assert token_align.align(no_docs, *models).count() == 0


def test_odd_texts(spark, models, monkeypatch):
    rows = [(i, t) for i, t in enumerate(TEXTS + TEXTS[:3] + [None, ""])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter(tuple(r) for r in token_align.align(df, *models).select(*COLUMNS).collect())
    want = brute(rows, models)
    assert got == want
    zeros = {r[0] for r in want if r[1] == 0}
    assert zeros == {10, len(rows) - 1, len(rows) - 2}  # the mark itself is spelled as a space


def test_wide_groups_count_distinct_pairs(models, monkeypatch):
    monkeypatch.setattr(token_align, "_WIDE_GROUP", 0)
    pair = token_align.Pair.of(*models)
    units = [" " + "naïveté", " \U0001F600\U0001F600", " word"]
    wide = token_align.Units(units, pair)
    monkeypatch.undo()
    plain = token_align.Units(units, pair)
    for name in ("pairs", "link_pair", "link_times", "n_pairs", "n_links"):
        assert getattr(wide, name).tolist() == getattr(plain, name).tolist()


def test_a_clashing_result_name_is_refused(docs, models):
    with pytest.raises(ValueError):
        token_align.align(docs.withColumnRenamed("lang", "n_a"), *models, keep=("doc_id", "n_a"))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 60), unique=True, min_size=1), st.lists(st.integers(1, 60), unique=True, min_size=1), st.integers(1, 9))
def test_merge_path_equals_common_ends(a, b, work):
    last = 61
    a, b = np.array(sorted(a) + [last]), np.array(sorted(b) + [last])
    to_a, to_b = token_align.merge_groups(a, b, work)
    common = sorted(set(a.tolist()) & set(b.tolist()))
    assert to_a.tolist() == [int(np.searchsorted(a, e)) + 1 for e in common]
    assert to_b.tolist() == [int(np.searchsorted(b, e)) + 1 for e in common]
    i, j = token_align.diagonal_cuts(a, b, work)
    assert np.diff(i + j).max() <= work and (i + j)[-1] == len(a) + len(b)


def test_overlaps_of_a_piece():
    of_a, of_b, closes = token_align.merge_piece(np.array([2, 5, 9]), np.array([3, 5, 9]), 10, 20)
    assert list(zip(of_a, of_b, closes)) == [(10, 20, False), (11, 20, False), (11, 21, True), (12, 22, True)]


def test_numbers_beyond_32_bits_pack():
    numbers = np.array([0, 5, 2**32 + 7, 2**40])
    assert token_align.unpack(token_align.pack(numbers)).tolist() == numbers.tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\tab\u3000é", min_size=1, max_size=30))
def test_units_join_to_the_text_and_tokenize_alike(text):
    pair = token_align.Pair.of(*token_align.read_models())
    parts = token_align.units(text)
    assert "".join(parts) == " " + text
    a, _, b, _, good = pair.encode(parts)
    assert a.tolist() == pair.a.encode(" " + text, add_special_tokens=False).ids and good.all()
    assert b.tolist() == pair.b.encode(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=" \n\tab'1.\u3000é\u0301\x1c▁", min_size=1, max_size=12), min_size=1, max_size=12))
def test_units_of_a_line_tokenize_as_they_do_alone(texts):
    pair = token_align.Pair.of(*token_align.read_models())
    parts = list(dict.fromkeys(u for text in texts for u in token_align.units(text)))
    a, n_a, b, n_b, good = pair.encode(parts)
    mine = [pair.a.encode(u, add_special_tokens=False).ids for u in parts]
    theirs = [pair.b.encode(u[1:]) for u in parts]
    assert [x.tolist() for x in np.split(a, np.cumsum(n_a)[:-1])] == mine and [x.tolist() for x in np.split(b, np.cumsum(n_b)[:-1])] == theirs
    plain = [u.encode() for u in parts]
    assert good.tolist() == [b"".join(pair.a_bytes[i] for i in x) == b"".join(pair.b_bytes[i] for i in y) == u for u, x, y in zip(plain, mine, theirs)]


@pytest.mark.parametrize("lines", [token_align.lines, lambda units: [*range(0, len(units), 300), len(units)]])
def test_a_line_that_is_not_spelled_costs_its_own_units_only(models, monkeypatch, lines):
    """Also where nothing sets odd units apart."""
    monkeypatch.setattr(token_align, "lines", lines)
    pair = token_align.Pair.of(*models)
    parts = [f" word{i}" for i in range(3000)] + [" ▁mark"] + [f" next{i}" for i in range(3000)]
    seen = []
    tokens = token_align.Pair._tokens
    monkeypatch.setattr(token_align.Pair, "_tokens", lambda self, x: seen.append(len(x)) or tokens(self, x))
    a, n_a, b, n_b, good = pair.encode(parts)
    assert np.flatnonzero(~good).tolist() == [3000] and len(n_a) == len(n_b) == len(parts)
    assert a.tolist() == [i for u in parts for i in pair.a.encode(u, add_special_tokens=False).ids]
    assert b.tolist() == [i for u in parts for i in pair.b.encode(u[1:])]
    assert len(seen) == 2 and seen[1] <= 300


def test_portions_give_what_one_gives(models, monkeypatch):
    pair = token_align.Pair.of(*models)
    parts = [u for t in TEXTS if t for u in token_align.units(t)]
    parts = list(dict.fromkeys(parts + [f" {i * 7919}word{i % 97}" for i in range(500)]))
    whole = token_align.Units(parts, pair)
    monkeypatch.setattr(token_align, "_CHARS_AT_ONCE", 40)
    cut = token_align.Units(parts, pair)
    assert whole.texts == cut.texts
    for name in ("good", "n_a", "n_b", "n_groups", "n_links", "pairs", "link_pair", "link_times", "n_pairs"):
        assert getattr(whole, name).tolist() == getattr(cut, name).tolist()
    assert len(token_align.Units([], pair).texts) == 0


def test_alignment_holds_a_portion_besides_its_results(models, monkeypatch):
    """Block-long lists of ends, names and links took nearly six times the results."""
    monkeypatch.setattr(token_align, "_CHARS_AT_ONCE", 1 << 16, raising=False)
    pair = token_align.Pair.of(*models)
    parts = [f" {'abcdefghij'[i % 10]}{i * 7919 % 99991}nd{i}" for i in range(60_000)]
    pair.encode(parts[:100])
    tracemalloc.start()
    try:
        found = token_align.Units(parts, pair)
        held, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert len(found.texts) == len(parts)
    assert peak < 2 * held
