"""Classifiers, language identification, scoring and rules against brute force, held-out accuracy and odd input."""

import math
import time
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerq.llm import html_extract, language_id, lattice_lm, quality_model, quality_rules
from ledgerq.llm.common import table
from ledgerq.llm.queries import QUERIES

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, _id string, _text string"
ODD = [
    (1, None, None, None, None, "x", "y"),
    (2, "", "en", "s", 0, "x", "y"),
    (3, "  \n\t ", "en", "s", 5, None, None),
    (4, "12 34 %%", None, "s", 8, "x", "y"),
    (5, "The cat sat on the mat.", "en", "s", 23, "x", "y"),
    (5, "The cat sat on the mat.", "en", "s", 23, "x", "y"),
    (None, "Der Hund liegt auf dem Sofa.", "de", None, 28, "x", "y"),
    (7, "word " * 60_000, "en", "s", 300_000, "x", "y"),
    (8, "x" * 50_000, "en", "s", 50_000, "x", "y"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_quality_is_learned_from_labels(spark):
    got = QUERIES["op2_quality_classifier"](spark, MIDDLE).join(table(spark, MIDDLE, "labels"), "doc_id")
    rows = got.where("held_out").select("predicted", "quality").collect()
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.93


def test_quality_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(5, 1), (7, 0), (8, None), (9, 1), (None, 1)], "doc_id long, quality int")
    weights = quality_model.learn(odd, labels)
    rows = quality_model.scores(odd, weights).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert set(quality_model.keep_good(odd, weights).columns) == set(odd.columns)
    flat = quality_model.learn(none, labels)
    assert not flat.any() and quality_model.scores(none, flat).count() == 0


def test_sparse_margin_is_the_dense_dot_product():
    rng = np.random.default_rng(3)
    weights = rng.normal(size=(1 << quality_model.BITS) + 1)
    found = quality_model.features("one two two two three!! one")
    dense = np.bincount(found, minlength=len(weights) - 1) / math.sqrt(len(found))
    assert math.isclose(quality_model.margin(found, weights), dense @ weights[:-1] + weights[-1])


def test_languages_are_told_apart(spark):
    got = QUERIES["op3_language_id"](spark, MIDDLE).join(table(spark, MIDDLE, "documents").select("doc_id", "lang"), "doc_id")
    assert got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95


def test_languages_of_odd_rows(spark, odd, none):
    trees = language_id.learn(odd)
    rows = language_id.predict(odd, trees).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert (r.lang_pred == "und") == (r.doc_id in (1, 2, 3, 4)) and 0 <= r.score <= 1
    assert language_id.keep_identified(odd, trees).count() == 5
    assert language_id.learn(none) is None
    assert {r.lang_pred for r in language_id.predict(odd, None).collect()} == {"und"}


def plain_code_length(texts, data):
    """Bits by the definition, one byte at a time."""
    follow = {}
    for t in texts:
        for i in range(len(t)):
            for k in range(min(i, language_id.DEPTH) + 1):
                follow.setdefault(t[i - k : i], Counter())[t[i]] += 1
    bits = 0.0
    for i in range(len(data)):
        for k in range(min(i, language_id.DEPTH), -1, -1):
            seen = follow.get(data[i - k : i])
            if seen is None:
                continue
            n, d = sum(seen.values()), len(seen)
            if data[i] in seen:
                bits += math.log2((n + d) / seen[data[i]])
                break
            bits += math.log2((n + d) / d)
        else:
            bits += 8
    return bits


def test_code_lengths_are_exact():
    texts = {"a": [b"abracadabra abra", b"cadabra"], "b": [b"hocus pocus", b"abc abc"]}
    rows = {}
    for k in range(1, language_id.DEPTH + 2):
        found = [(i, int.from_bytes(t[j : j + k], "big")) for i, n in enumerate(sorted(texts)) for t in texts[n] for j in range(len(t) - k + 1)]
        counts = Counter(found)
        rows[k] = (np.array([x[0] for x in counts]), np.array([x[1] for x in counts]), np.array(list(counts.values())))
    trees = language_id.ContextTrees(sorted(texts), rows)
    for data in (b"abra pocus", b"a", b"zzz", b"abc\xffabc hocus", b"", b"cadabra" * 9):
        want = [plain_code_length(texts[n], data) for n in sorted(texts)]
        assert np.allclose(trees.code_length(data), want, rtol=1e-5)


def test_document_scores_by_definition(spark):
    rows = table(spark, SMALL, "documents").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op6_lm_scoring"](spark, SMALL).collect()}
    train, ends = Counter(), 0
    for r in rows:
        if zlib.crc32(str(r.doc_id).encode()) % 7 != 2:
            train.update(lattice_lm.words(r.text))
            ends += 1
    total, distinct = sum(train.values()) + ends, len(train) + 1
    assert len(got) == len(rows)
    for r in rows:
        found = lattice_lm.words(r.text)
        g = got[r.doc_id]
        assert g.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        assert (g.n_tokens, g.n_known, g.train_tokens) == (len(found) + 1, sum(w in train for w in found) + 1, total)
        want = sum(math.log10((train[w] + 1) / (total + distinct + 1)) for w in found) + math.log10((ends + 1) / (total + distinct + 1))
        assert math.isclose(g.base_score, want, rel_tol=1e-9)
        assert math.isfinite(g.score) and g.score < 0


def test_rare_words_are_joined_and_score_the_same(spark, monkeypatch):
    docs = table(spark, SMALL, "documents")
    before = {r.doc_id: r for r in lattice_lm.document_scores(docs).collect()}
    monkeypatch.setattr(lattice_lm, "FREQUENT", 3)
    for r in lattice_lm.document_scores(docs).collect():
        b = before[r.doc_id]
        assert r.n_known == b.n_known and math.isclose(r.score, b.score, rel_tol=1e-9) and math.isclose(r.base_score, b.base_score, rel_tol=1e-9)


def test_repeated_words_by_single_draws():
    shares, text, prior = {"a": 0.2, "b": 0.01, "c": 1e-7}, "abaacbac", 50.0
    score, seen = 0.0, {}
    for i, w in enumerate(text):
        score += math.log10((prior * shares[w] + seen.get(w, 0)) / (prior + i))
        seen[w] = seen.get(w, 0) + 1
    got = sum(lattice_lm.repeated(math.log10(shares[w]), n, prior) for w, n in seen.items()) - lattice_lm.drawn(len(text), prior)
    assert math.isclose(got, score, rel_tol=1e-12)
    assert math.isfinite(lattice_lm.repeated(-5000.0, 3))


def test_lattice_sums_all_segmentations():
    root = [-1, {}]
    pieces = [b" ", b"a", b"b", b" a", b"ab", b"aba", b"ba"]
    scores = [math.log(p) for p in (0.2, 0.1, 0.1, 0.2, 0.15, 0.05, 0.2)]
    for i, piece in enumerate(pieces):
        node = root
        for byte in piece:
            node = node[1].setdefault(byte, [-1, {}])
        node[0] = i
    text = b" ababa"
    total, expected = 0.0, [0.0] * len(pieces)
    for n in range(len(text)):
        for cuts in combinations(range(1, len(text)), n):
            parts = [text[i:j] for i, j in zip((0, *cuts), (*cuts, len(text)), strict=True)]
            if all(p in pieces for p in parts):
                w = math.exp(sum(scores[pieces.index(p)] for p in parts))
                total += w
                for p in parts:
                    expected[pieces.index(p)] += w
    assert math.isclose(lattice_lm.forward(root, scores, text)[-1], math.log(total))
    counts = [0.0] * len(pieces)
    lattice_lm.expect(root, scores, text, counts)
    assert np.allclose(counts, np.array(expected) / total)


def test_words_are_estimated_together_as_one_by_one():
    path = public_tokenizers.path(lattice_lm.VOCABULARY)
    root, names = lattice_lm.tree(path), lattice_lm.pieces(path)
    rng = np.random.default_rng(3)
    words = [b" " + bytes(rng.choice(list(b"abehinrst\xc3\xa9#"), rng.integers(1, 32)).tolist()) for _ in range(400)] + [b" \x00" + b"\xff" * 30, b" a"]
    scores = rng.normal(-12, 5, len(names)).clip(-25, -1)
    want = [0.0] * len(names)
    for word in words:
        lattice_lm.expect(root, scores.tolist(), word, want)
    found = [lattice_lm.arcs(root, w) for w in words]
    got = lattice_lm.expect_together(
        np.array([c for f in found for c in f], np.int32),
        np.repeat(np.arange(len(words)), [len(f) for f in found]),
        np.array([len(w) for w in words]),
        np.exp(scores + np.array([min(len(n), 40) for n in names]) * math.log(lattice_lm.BYTE_SCALE)),
    )
    assert np.allclose(got, want, rtol=1e-9, atol=1e-12)


def test_every_round_sees_all_training_words(spark):
    # More than 20,000 distinct words, dealt out to texts of 500.
    parts = ["ba", "ke", "lo", "mi", "nu", "ra", "se", "ti", "vo", "zu", "qx", "jy", "wh"]
    vocabulary = [a + b + c + d for a in parts for b in parts for c in parts for d in parts][:28_500]
    rows = [(i, " ".join(vocabulary[500 * i : 500 * i + 500])) for i in range(57)]
    root = lattice_lm.tree(public_tokenizers.path(lattice_lm.VOCABULARY))
    size = len(lattice_lm.pieces(public_tokenizers.path(lattice_lm.VOCABULARY)))
    train = [w for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2 for w in lattice_lm.words(t)]
    assert len(train) > 20_000
    scores, stop = lattice_lm.normal(1.0 / np.arange(1, size + 1) * len(train), len(train) / 4)
    for _ in range(lattice_lm.ROUNDS + 1):
        counts = [0.0] * size
        plain = scores.tolist()
        for word in train:
            lattice_lm.expect(root, plain, b" " + word, counts)
        scores, stop = lattice_lm.normal(np.array(counts), len(train))
    ends = sum(zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows)
    escape = math.log((lattice_lm.DISCOUNT * len(train) + 1) / (len(train) + ends + 2))
    unknown = next((i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 7 == 2)
    want = lattice_lm.repeated(math.log10((ends + 1) / (len(train) + ends + 2)), 1) - lattice_lm.drawn(501)
    plain = scores.tolist()
    for word in lattice_lm.words(unknown[1]):
        share = lattice_lm.forward(root, plain, b" " + word)[-1] + stop + escape
        want += lattice_lm.repeated(share / math.log(10), 1)
    got = {r.doc_id: r.score for r in lattice_lm.document_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert math.isclose(got[unknown[0]], want, rel_tol=1e-9)


def test_document_scores_of_odd_rows(spark, odd, none):
    rows = lattice_lm.document_scores(odd).collect()
    assert len(rows) == len(ODD)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert lattice_lm.document_scores(none).count() == 0
    assert len(lattice_lm.pieces(public_tokenizers.path(lattice_lm.VOCABULARY))) == 50_256


def plain_measures(text):
    words = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in text).split(" ") if w]
    seen = {}
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    marked = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            dup += line in lines
            lines.add(line)
    return [len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(marked)]


def test_rule_measures_by_definition(spark):
    texts = {r.doc_id: r.text for r in table(spark, SMALL, "documents").collect()}
    for r in QUERIES["op7_quality_rules"](spark, SMALL).collect():
        want = plain_measures(texts[r.doc_id] or "")
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == want
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    for text in ("a b a b a b", "a b c", " x y z\u0085", "\n\n x \n x \n", "a\x1cb c\x1cd"):
        assert quality_rules.measures(text)[0] == plain_measures(text)


def test_rules_find_what_labels_mark(spark):
    got = QUERIES["op7_quality_rules"](spark, MIDDLE).join(table(spark, MIDDLE, "labels"), "doc_id").where("not base_failed")
    rows = got.select("kept", "quality").collect()
    assert sum(r.kept == (r.quality == 1) for r in rows) / len(rows) > 0.97


def planted_votes():
    rng = np.random.default_rng(1)
    wanted = np.array([[0.97, 0.8], [0.95, 0.7], [0.98, 0.6], [0.9, 0.75], [0.96, 0.5], [0.93, 0.65], [0.99, 0.4], [0.95, 0.7], [0.9, 0.6]])
    is_good = rng.random(40_000) < 0.9
    code = np.zeros(len(is_good), int)
    for sure_good, sure_bad in wanted[::-1]:
        right = rng.random(len(code)) < np.where(is_good, sure_good, sure_bad)
        code = code * 3 + np.where(rng.random(len(code)) < 0.3, 0, np.where(right == is_good, 1, 2))
    return wanted, is_good, code


def test_accuracies_of_planted_votes_are_found():
    wanted, is_good, code = planted_votes()
    patterns, counts = np.unique(code, return_counts=True)
    post, accuracy = quality_rules.estimate(patterns, counts.astype(float))
    assert np.abs(accuracy - wanted).max() < 0.05
    kept, bad = post[np.searchsorted(patterns, code)] >= 0.5, (quality_rules.digits(code) == 2).sum(axis=1)
    assert (kept == is_good).mean() > 0.97 > 0.8 > ((bad == 0) == is_good).mean()
    assert (kept & (bad == 1)).any() and not kept[bad > 4].any()


def test_estimate_is_plain_expectation_maximisation():
    code = planted_votes()[2][:300]
    patterns, counts = np.unique(code, return_counts=True)
    got, accuracy = quality_rules.estimate(patterns, counts.astype(float), rounds=5)
    votes = [[int(c) // 3**r % 3 for r in range(len(quality_rules.RULES))] for c in code]
    post = [0.3 ** v.count(2) if 2 in v else 0.95 for v in votes]
    for _ in range(5):
        right = []
        for r in range(len(quality_rules.RULES)):
            said = [(p, v[r]) for p, v in zip(post, votes, strict=True) if v[r]]
            a = (sum(p for p, x in said if x == 1) + 1.8) / (sum(p for p, _ in said) + 2)
            b = (sum(1 - p for p, x in said if x == 2) + 1.0) / (sum(1 - p for p, _ in said) + 2)
            right.append((a, b))
        share = (sum(post) + 1.8) / (len(post) + 2)
        for i, v in enumerate(votes):
            yes, no = share, 1 - share
            for x, (a, b) in zip(v, right, strict=True):
                if x:
                    yes *= a if x == 1 else 1 - a
                    no *= b if x == 2 else 1 - b
            post[i] = yes / (yes + no)
    assert np.allclose(accuracy, right) and np.allclose(got[np.searchsorted(patterns, code)], post)


def test_rules_on_odd_rows(spark, odd, none):
    rows = quality_rules.judge(odd).collect()
    assert len(rows) == len(ODD) and all(r.base_failed for r in rows if r.doc_id in (1, 2, 3, 5))
    assert quality_rules.judge(none).count() == 0


def test_main_text_of_unseen_templates(spark):
    weights = html_extract.learn(html_extract.built_in(spark))
    page = """<html><body><header><ul><li><a href=1>Home</a></li><li><a href=2>News</a></li></ul></header>
    <div class="cookie-banner"><p>We use cookies. Please accept.</p></div><main><article><h1>Salt &amp; stone</h1>
    <p>The first   wall fell\nin spring.<br>Nobody wept.</p><p>It was &eacute;asy.</p></article></main>
    <form><p>Search</p><input></form><section class="comments"><p>Nice story, I liked it a lot.</p></section>
    <aside class=sidebar><h3>Popular</h3><a href=3>Ten things</a></aside><footer>&copy; 2024</footer></body></html>"""
    assert html_extract.extract(page, weights) == "Salt & stone\nThe first wall fell in spring. Nobody wept.\nIt was éasy."


def test_tree_marginals_are_exact():
    nodes, _ = html_extract.parse("<body><div><p>One.</p><ul><li>two</li></ul></div><nav>x</nav></body>")
    rng = np.random.default_rng(5)
    weights = {name: tuple(rng.normal(size=2)) for node in nodes for name in html_extract.seen(node)}
    weights |= {f"pair:{y}:{a}": tuple(rng.normal(size=2)) for y in (0, 1) for a in ("apart", "open")}
    mass = np.zeros((len(nodes), 2))
    for code in range(2 ** len(nodes)):
        states = [code >> i & 1 for i in range(len(nodes))]
        w = sum(html_extract.weight(name) * weights[name][y] for node, y in zip(nodes, states, strict=True) for name in html_extract.seen(node))
        w += sum(weights[f"pair:{states[node.parent]}:{html_extract.around(nodes[node.parent])}"][y] for node, y in zip(nodes[1:], states[1:], strict=True))
        for i, y in enumerate(states):
            mass[i, y] += math.exp(w)
    assert np.allclose(html_extract.marginals(nodes, weights), mass[:, 1] / mass.sum(axis=1))


def test_pages_of_all_kinds(spark):
    odd = [(1, None, None), (2, "u", ""), (3, "u", "<p>cut <b>off</b> te<a hre"), (4, "u", "<div>" * 3000 + "deep."), (5, "u", "no tags & no end &am")]
    weights = html_extract.learn(html_extract.built_in(spark))
    rows = html_extract.main_texts(spark.createDataFrame(odd, "page_id long, url string, html string"), weights).collect()
    assert [(r.page_id, r.n_chars == len(r.text)) for r in rows] == [(i, True) for i in range(1, 6)]
    assert rows[0].text == rows[1].text == ""
    got = QUERIES["op1_html_extraction"](spark, SMALL)
    assert got.count() == 50 and got.where("text = ''").isEmpty()
    assert got.where("text like '%&copy;%' or text like '%track(%' or text like '%©%'").isEmpty()


def test_open_heads_and_self_closed_elements_hide_no_text(spark):
    story = "<article><h1>Salt</h1><p>The first wall fell in spring, and nobody wept.</p></article>"
    want = "Salt\nThe first wall fell in spring, and nobody wept."
    weights = html_extract.learn(html_extract.built_in(spark))
    for start in (
        "<html><head><title>x</title><body>",
        "<html><head><title>x</title><noscript><img src=t></noscript><script>var a</script>",
        "<head><meta charset=utf-8><body>",
        "<html><head></head><body>",
    ):
        assert html_extract.extract(start + story, weights) == want
    assert html_extract.parse("<head><title>x</title> Plain text")[1] == [(0, " Plain text")]
    # Text in a head's own elements stays hidden.
    assert html_extract.parse("<head><title>x</title><noscript>y</noscript><style>z</style></head>")[1] == []
    for mark in ('<svg width="1"/>', "<svg/>", "<svg hidden />", "<math />", "<svg a='b=c'/>", "<svg><title/><path d='x'/></svg>", "<svg><g/></svg>"):
        assert html_extract.parse(f"<p>{mark}Seen.</p>")[1] == [(1, "Seen.")]
    # Here the slash belongs to the value, as in browsers, and on other elements it means nothing.
    assert html_extract.parse("<p><svg width=1/>hidden</svg>Seen.</p>")[1] == [(1, "Seen.")]
    assert html_extract.parse("<div/>Seen.")[1] == [(1, "Seen.")]


def test_quotes_outside_of_values_hide_no_text():
    def lines(page):
        return [raw for _, raw in html_extract.parse(page)[1]]

    assert lines("<p it's>One.</p><p>Two isn't lost.</p>") == ["One.", "Two isn't lost."]
    assert lines('<p class="x>One.</p><p>Two.</p>') == ["One.", "Two."]
    assert lines("<p title='a > b' class=c>One.</p>") == ["One."]
    assert lines('<p title = "a > b"x=y>One.</p><br/><p a=>Two.') == ["One.", "Two."]
    assert lines("<!--><p>One.</p><!-- <p>no</p> --><?x y?>Two 1 < 2 </ z>") == ["One.", "Two 1 < 2 "]
    assert lines("<p>One.</p><p class='a' b") == ["One."]
    assert lines("<p>A<a href=1>b<a href=2>c</a>d</a>e</p>") == ["Abcde"]
    assert lines("<p><i>a<div>b</i>c</div>") == ["a", "bc"]
    # A slash at the end of an unquoted value belongs to the value.
    assert lines("<p><svg class=a/>no</svg>x<svg class='a'/>y<svg a = b/><b/>no</svg>z") == ["xyz"]


def test_broken_pages_take_time_in_proportion():
    n = 60_000
    start = time.perf_counter()
    for page in (
        "<a " * n,
        "<b x='" * n,
        "<b x=\"'" * n,
        "<div>" * n + "</p></i>" * n,
        "<i><div>" + "<b>" * n + "</i>" * n,
        "<a href=1>" * n,
        "<li><p>" * n,
        "<!--" * n,
        "<p " + "a=" * n + "/>",
        "<svg>" + "<g/>" * n,
    ):
        html_extract.parse(page)
    assert time.perf_counter() - start < 20
