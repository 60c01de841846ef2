"""Fill-in-the-middle texts against plain slicing, exact round trips and odd input."""

import hashlib
import re

import pytest
from compare import both, duck
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerq.llm import fill_middle
from ledgerq.llm.fill_middle import PieceTable, parsed
from ledgerq.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


def plain(key, text):
    """The definition with string slices."""
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXTS = ["", None, " ", "a", "\n\r ", "it's <P> here", "<P", "P><S", "é ß × ÷ 漢字 \U0001f600 x", "ab" * 50_000 + " é", "x\x00y", "<<S<M>", "a b c"]


@settings(max_examples=200, deadline=None)
@given(st.integers(-9, 10**12), st.text(st.sampled_from("aZ é<PSM>\n漢\U0001f600"), max_size=40))
def test_pieces_are_those_of_slices(key, text):
    digest = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    *counts, output = fill_middle._arrange(text.encode(), digest)
    assert (*counts, output.decode()) == plain(key, text)
    if counts[1] != "plain":
        assert parsed(output, counts[1]).inverse(counts[1]).bytes().decode() == text


def test_descriptors_are_split_not_copied():
    text = b"one two three"
    table = PieceTable(text).cut(0, 4, 13)
    assert table.descriptors == [(0, 0, 0), (0, 0, 4), (0, 4, 13), (0, 13, 13)]
    assert all(part.obj is text for part in table.stream())
    three = PieceTable(text).cut(4, 8)
    for form in fill_middle.ARRANGEMENTS:
        moved = three.arranged(form)
        assert {b for b, _, _ in moved.descriptors} == {0, 1}
        assert moved.inverse(form).descriptors == three.descriptors
        assert moved.sha256() == hashlib.sha256(moved.bytes()).hexdigest()
        assert parsed(moved.bytes(), form).inverse(form).bytes() == text


def test_odd_rows_and_clashing_names(spark):
    rows = [(i % 40 if i % 41 else None, t, i, f"o{i}") for i, t in enumerate(TEXTS * 12)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, n int, _text string").repartition(3)
    made = fill_middle.restore(fill_middle.transform(docs))
    got = made.collect()
    assert made.columns == ["doc_id", "text", "_text", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    assert len(got) == len(rows)
    by_mark = {r["_text"]: r for r in got}
    for key, text, i, mark in rows:
        r = by_mark[mark]
        want = plain(key, text)
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == want, i
        assert (r["doc_id"], r["text"], r["restored"]) == (key, text, text or "")
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_another_epoch_draws_other_cuts(spark):
    docs = spark.range(50).selectExpr("id as doc_id", "repeat('word ', 30) as text")
    one, two = (fill_middle.transform(docs, epoch=e).select("output").collect() for e in (1, 2))
    assert sum(a != b for a, b in zip(one, two, strict=True)) > 40


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fill_middle.digests(fill_middle.transform(empty)).count() == 0


@pytest.mark.parametrize("name", ["op13_fill_in_middle"])
def test_query_is_its_sql(spark, name):
    got, want = both(spark, duck(SMALL), QUERIES[name], ORACLES[name], SMALL)
    assert got == want
    rows = QUERIES[name](spark, SMALL)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
