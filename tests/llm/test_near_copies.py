"""Near duplicates, packing, archives, pieces and the pipeline against brute force, round trips and odd input."""

import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from compare import both, duck
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerq.llm import embedding_dedup, order_minhash, packing, sentencepiece_codec, warc
from ledgerq.llm.common import cut, table
from ledgerq.llm.graph import components
from ledgerq.llm.queries import ORACLES, QUERIES

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, _node string"


def roots(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {n: find(n) for n in nodes}


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def plain_labels(text):
    words = "".join(c.lower() if c.isascii() else c for c in text).encode().split()
    words = [words] if 0 < len(words) < 5 else [words[i : i + 5] for i in range(len(words) - 4)]
    seen, out = Counter(), []
    for w in map(tuple, words):
        seen[w] += 1
        out.append((w, seen[w]))
    return out


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(1, 200)] + [(500, i) for i in range(501, 700)] + [(800, 801), (801, 800), (900, 900), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    real = [p for p in pairs if None not in p and p[0] != p[1]]
    want = roots(real, {x for p in real for x in p})
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_alignment_is_the_longest_common_subsequence():
    rng = np.random.default_rng(1)
    for _ in range(150):
        a = [f"w{i}" for i in rng.integers(0, 30, rng.integers(1, 80))]
        b = list(a)
        for _ in range(rng.integers(0, 4)):
            at = int(rng.integers(0, len(b) + 1))
            b[at : at + int(rng.integers(0, 2))] = [f"w{i}" for i in rng.integers(0, 30, rng.integers(0, 3))]
        x, y = plain_labels(" ".join(a)), plain_labels(" ".join(b))
        m = longest_common(x, y)
        made = [order_minhash.Shingled.of(order_minhash.labelled(order_minhash.shingles(" ".join(t)))) for t in (a, b)]
        assert (made[0].n, made[1].n) == (len(x), len(y))
        assert order_minhash.compare(*made)[0] == (m > 0 and m / (len(x) + len(y) - m) >= 0.8 - 1e-12)


def near_copy_corpus():
    """Families of edited copies, copies of copies, texts that share a passage, and texts of their own."""
    rng = np.random.default_rng(7)
    words = [f"{a}{b}{c}" for a in "bdgkmr" for b in ("a", "ei", "o") for c in ("n", "st", "l", "")]
    fresh = lambda n: [words[i] for i in rng.integers(0, len(words), n)]
    passage = fresh(60)
    texts = []
    for family in range(6):
        base = fresh(int(rng.integers(60, 400)))
        texts.append(base)
        for _ in range(8):
            copy = list(base)
            for _ in range(int(rng.integers(0, max(2, len(base) // 25)))):
                copy[int(rng.integers(0, len(copy)))] = words[int(rng.integers(0, len(words)))]
            texts.append(copy)
            if family % 2:
                base = copy
    texts += [passage + fresh(150) for _ in range(40)] + [fresh(n) for n in (1, 2, 3, 4, 5, 6, 30)]
    return [" ".join(t) for t in texts] + [" ".join(texts[0]), " ".join(texts[0]).upper(), "", None, "", "a b c", "A  b c"]


def test_near_texts_against_all_pairs(spark, monkeypatch):
    texts = near_copy_corpus()
    ids = [3 * i + 1 for i in range(len(texts))]
    labels = {i: plain_labels(t or "") for i, t in zip(ids, texts, strict=True)}
    pairs = []
    for a in ids:
        for b in ids:
            if a < b:
                x, y = labels[a], labels[b]
                most = len(set(x) & set(y))
                if not x and not y:
                    pairs.append((a, b))
                elif most and most / (len(x) + len(y) - most) >= 0.8:
                    m = longest_common(x, y)
                    if m / (len(x) + len(y) - m) >= 0.8:
                        pairs.append((a, b))
    want = roots(pairs, ids)
    docs = spark.createDataFrame([(i, t, None, None, None, "z") for i, t in zip(ids, texts, strict=True)], DOCS)
    for block in (1024, 4):
        monkeypatch.setattr(order_minhash, "BLOCK", block)
        got = order_minhash.classes(docs).collect()
        assert {r.doc_id: r.class_id for r in got} == want and len(got) == len(ids)
        assert all(r.kept == (r.doc_id == r.class_id) for r in got)
    kept = order_minhash.distinct_documents(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values())) and kept.columns == docs.columns


def test_no_pair_of_short_texts_is_missed(spark):
    rng = np.random.default_rng(11)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    texts = []
    for _ in range(1500):
        base = [word() for _ in range(int(rng.integers(8, 12)))]
        texts += [" ".join(base), " ".join([*base, word()]) if rng.random() < 0.5 else " ".join([word(), *base])]
    got = {r.doc_id: r.class_id for r in order_minhash.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {i: i - i % 2 for i in range(len(texts))}


def test_strays_that_share_one_entry_are_compared():
    rng = np.random.default_rng(5)
    x, y = rng.integers(1, 1 << 62, 20).tolist(), rng.integers(1, 1 << 62, 20).tolist()
    texts = [x, [*x[:19], y[0]], y, x[:5]]
    entries = [[7, *range(1, order_minhash.ENTRIES)], *([7, *range(100 * k, 100 * k + order_minhash.ENTRIES - 1)] for k in (1, 2, 3))]
    group = pa.table(
        {
            "_node": pa.array([b"a", b"b", b"c", b"d"]),
            "_kind": [1] * 4,
            "_part": [0] * 4,
            "_s": pa.array(entries, pa.list_(pa.int64())),
            "_x": pa.array(texts, pa.list_(pa.int64())),
        }
    )
    links = order_minhash._strays(tuple(map(pa.scalar, (0, 7, 0, 0))), group)
    assert links.to_pylist() == [{"a": b"a", "b": b"b"}]
    # Equal upper halves of hashes are no agreement.
    near = [v ^ 1 for v in x]
    group = group.set_column(4, "_x", pa.array([x, near, y, x[:5]], pa.list_(pa.int64())))
    assert order_minhash._strays(tuple(map(pa.scalar, (0, 7, 0, 0))), group).num_rows == 0


def test_near_texts_of_odd_rows(spark):
    docs = spark.createDataFrame(
        [(5, "a b c d e f g", *[None] * 4), (5, "a b c d e f g", *[None] * 4), (None, "a b c d e f g", *[None] * 4), (None, None, *[None] * 4)], DOCS
    )
    assert sorted((r.doc_id or 0, r.class_id or 0) for r in order_minhash.classes(docs).collect()) == [(0, 0), (0, 5), (5, 5), (5, 5)]
    assert sorted(r.doc_id or 0 for r in order_minhash.distinct_documents(docs).collect()) == [0, 5]
    empty = docs.limit(0)
    assert order_minhash.classes(empty).count() == 0 == order_minhash.distinct_documents(empty).count()
    alone = spark.createDataFrame([(1, "word " * 50_000, *[None] * 4)], DOCS)
    assert order_minhash.classes(alone).first().kept


def test_texts_without_a_word_are_one_group(spark):
    texts = ["", None, " ", "\n", "\t\x0b\f\r", "a", "\u00a0"]
    docs = spark.createDataFrame([(i, t, *[None] * 4) for i, t in enumerate(texts)], DOCS)
    assert {r.doc_id: r.class_id for r in order_minhash.classes(docs).collect()} == dict(enumerate([0, 0, 0, 0, 0, 5, 6]))
    assert sorted(r.doc_id for r in order_minhash.distinct_documents(docs).collect()) == [0, 5, 6]


def vectors(spark, seed=2, dim=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(60, dim))
    rows = [x / np.linalg.norm(x) + rng.normal(size=dim) * s / np.sqrt(dim) for x in base for s in (0, 0.1, 0.2, 0.3, 0.35)]
    rows = [(i, [float(v) for v in x * 3]) for i, x in enumerate(rows)]
    return [*rows, *[(1000 + i, rows[0][1]) for i in range(5)]]


def test_near_vectors_against_all_pairs(spark, monkeypatch):
    rows = vectors(spark)
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    links = x @ x.T >= 0.95
    np.fill_diagonal(links, False)
    ids = [r[0] for r in rows]
    want = roots([(ids[i], ids[j]) for i, j in zip(*np.nonzero(links), strict=True)], ids)
    odd = [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] * 16), (2004, [None, 1.0]), (2005, [1.0, 2.0]), (2006, [2.0, 4.0]), (None, [5.0])]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("_unit", F.lit("clash"))
    for block in (1024, 3):
        monkeypatch.setattr(embedding_dedup, "BLOCK", block)
        got = {r.vec_id: r for r in embedding_dedup.near_vectors(frame, reach=None).collect()}
        assert {i: got[i].component_id for i in ids} == want
        assert [got[i].n_links for i in ids] == links.sum(axis=1).tolist()
        assert [got[i].n_links for i in range(2000, 2005)] == [0] * 5
        assert got[2006].component_id == 2005 and got[2005].n_links == 1 and got[None].n_links == 0 and len(got) == len(ids) + 8
    near = embedding_dedup.near_vectors(frame).agg(F.sum("n_links")).first()[0] - 2
    assert near >= 0.9 * links.sum()
    assert embedding_dedup.near_vectors(frame.limit(0)).count() == 0


def test_near_vectors_that_differ_across_a_border(spark):
    # Copies along a curve in 64 dimensions: all of a pair's difference can point across a border.
    rng = np.random.default_rng(4)
    at = np.sort(rng.uniform(0, 2 * np.pi, 1500))
    x = np.concatenate([np.cos(at)[:, None], np.sin(at)[:, None], 0.01 * rng.normal(size=(1500, 62))], axis=1)
    lone = rng.normal(size=(1500, 64))
    x = np.concatenate([x, lone, lone + 1.2 * np.eye(64)[rng.integers(0, 64, 1500)]])
    x /= np.linalg.norm(x, axis=1)[:, None]
    links = x @ x.T >= 0.95
    np.fill_diagonal(links, False)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(frame).collect()}
    assert [got[i].n_links for i in range(len(x))] == links.sum(axis=1).tolist()
    want = roots(zip(*np.nonzero(np.triu(links)), strict=True), range(len(x)))
    assert {i: r.component_id for i, r in got.items()} == want


def plain_best(codec, scores, chunk):
    """The largest sum of scores over all segmentations, by definition."""
    best = [0.0] + [float("-inf")] * len(chunk)
    for end in range(1, len(chunk) + 1):
        for start in range(max(0, end - 20), end):
            piece = chunk[start:end]
            score = scores.get(piece, codec.unknown if len(piece) == 1 else None)
            if score is not None:
                best[end] = max(best[end], best[start] + score)
    return best[-1]


def test_segmentations_have_the_largest_score(spark):
    path = public_tokenizers.path(sentencepiece_codec.VOCABULARY)
    codec, library = sentencepiece_codec.Codec(path), sentencepiece.SentencePieceProcessor(model_file=path)
    scores = {library.id_to_piece(i): library.get_score(i) for i in range(259, library.get_piece_size())}
    words = {w for r in table(spark, SMALL, "documents").collect() for w in r.text.split()}
    for word in [*sorted(words)[:4000], " ", "  two", "日本x", "ab\u0085c"]:
        chunk = "▁" + word.replace(" ", "▁")
        ids = codec.segment(chunk)
        found = sum(scores[library.id_to_piece(i)] for i in ids if i not in codec.byte_of)
        unknown = [c for c in chunk if c not in scores]
        assert found + codec.unknown * len(unknown) == plain_best(codec, scores, chunk)
        assert codec.decode(np.array(ids)) == chunk.replace("▁", " ")[1:]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_pieces_round_trip(text):
    codec = sentencepiece_codec.codec(public_tokenizers.path(sentencepiece_codec.VOCABULARY))
    assert codec.decode(np.frombuffer(codec.encode(text), "<u4")) == text.replace("▁", " ")


def test_pieces_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "日本 \U0001f600"), (3, "x" * 30_000)], "doc_id long, text string")
    rows = sentencepiece_codec.digests(docs).collect()
    assert [r.n_ids > 0 for r in rows] == [False, False, True, True] and all(r.round_trip for r in rows)
    back = {r.doc_id: r.text for r in sentencepiece_codec.decode(sentencepiece_codec.encode(docs)).collect()}
    assert back == {1: "", 2: "", None: "日本 \U0001f600", 3: "x" * 30_000}
    assert QUERIES["op5_sentencepiece"](spark, SMALL).where("not round_trip").isEmpty()
    assert sentencepiece_codec.digests(docs.limit(0)).count() == 0


ODD_SPACES = st.text(alphabet=st.sampled_from(list("ab1 .'\n\t  \x1cé") + [" ", " "]), max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(ODD_SPACES | st.text(max_size=20), min_size=1, max_size=3))
def test_chunks_give_the_tokenizers_ids(texts):
    ids = packing.chunk_ids(public_tokenizers.path(packing.TOKENIZER))
    for text, got in zip(texts, ids.of(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == ids.tokenizer.encode(text, add_special_tokens=False).ids


def check_packed(rows, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    tokenizer.encode_special_tokens = True
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for key, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for n, r in enumerate(sorted(by_doc[key], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (n, at) and (r.length == 1024 or n == 0)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 1024
    return len(places), -(-sum(r.length for r in rows) // 1024)


def test_packing_is_gapless_and_tight(spark):
    texts = {r.doc_id: r.text for r in table(spark, MIDDLE, "documents").collect()}
    used, least = check_packed(QUERIES["op9_packing"](spark, MIDDLE).collect(), texts)
    assert used <= 1.02 * least


def test_packing_of_odd_rows(spark):
    texts = {1: None, 2: "", 3: "a" * 9000, 4: "word " * 5000, 5: "x <|endoftext|> y"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("length", F.lit("clash"))
    check_packed(packing.pack(docs).collect(), texts)
    assert packing.pack(docs.limit(0)).count() == 0
    assert packing.pack(spark.createDataFrame([(None, "a"), (None, "a")], "doc_id long, text string")).count() == 2


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 9), max_size=40))
def test_plans_use_every_piece_once(counts):
    packed = packing.plan(counts, 64)
    used = Counter()
    for n, lengths in packed:
        assert n > 0 and sum(lengths) <= 64
        for length in lengths:
            used[length] += n
    assert used == Counter(counts)


def test_archives_as_sql(spark):
    got, want = both(spark, duck(MIDDLE), QUERIES["op8_warc"], ORACLES["op8_warc"], MIDDLE)
    assert got == want


def test_archives_of_odd_rows(spark, tmp_path):
    trap = "x" * 200 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    pages = [(4, "u\r\nv", trap), (2, None, trap), (9, "w", trap), (1, "w", "short"), (3, "w", "short"), (5, "w", None), (6, "w", ""), (None, "w", trap), (2, "u", trap)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("payload", F.lit("clash"))
    path = str(tmp_path / "archive")
    warc.write(warc.resolve(frame), path)
    records = warc.read(spark, path)
    rows = warc.sizes(records).collect()
    assert len(rows) == len(pages)
    assert Counter((r.page_id, r.record_type, r.refers_to) for r in rows) == Counter(
        {(4, "revisit", 2): 1, (2, "response", None): 2, (9, "revisit", 2): 1, (None, "revisit", 2): 1}
        | {(i, "response", None): 1 for i in (1, 3, 5, 6)}
    )
    assert {r.payload_bytes for r in rows if r.page_id in (2, 4, 9, None)} == {len(trap)}
    assert {bytes(r.payload).decode() for r in records.where("page_id = 2").collect()} == {trap}
    empty = str(tmp_path / "empty")
    warc.write(warc.resolve(frame.limit(0)), empty)
    assert warc.sizes(warc.read(spark, empty)).count() == 0


@pytest.mark.parametrize("bits", [8, warc.BITS])
def test_archives_with_more_repeats_than_room(spark, bits):
    pages = table(spark, SMALL, "pages")
    pages = pages.unionByName(pages.where("page_id % 3 = 0").withColumn("page_id", F.col("page_id") + 100_000))
    columns = ["page_id", "record_type", "refers_to", "payload_digest", "payload"]
    plain = Counter(map(tuple, warc.resolve(pages).select(*columns).collect()))
    assert any(r[1] == "revisit" for r in plain)
    assert Counter(map(tuple, warc.resolve(pages, room=0, bits=bits).select(*columns).collect())) == plain


def test_only_headers_are_shuffled(spark):
    plan = warc.resolve(table(spark, SMALL, "pages"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_long_payloads_have_files_of_their_own(spark, tmp_path):
    texts = {1: "a" * (5 << 20), 2: "b" * (5 << 20), 3: "c" * (200 << 10), 4: "d" * 500, 5: "a" * (5 << 20)}
    path = str(tmp_path / "archive")
    warc.write(warc.resolve(spark.createDataFrame(list(texts.items()), "page_id long, html string").withColumn("url", F.lit("u")).coalesce(1)), path)
    assert {f.name: len(list(f.glob("part-*"))) for f in (tmp_path / "archive").iterdir()} == {"size-0": 1, "size-1": 1, "size-2": 3}
    records = warc.read(spark, path).collect()
    assert {r.page_id: bytes(r.payload).decode() for r in records} == texts | {5: ""}
    assert {r.page_id: r.payload_bytes for r in warc.sizes(warc.read(spark, path)).collect()} == {i: len(t) for i, t in texts.items()}


def test_cut_off_archives_are_found_out():
    record = b"WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    assert [body for _, body in warc.parse(record * 2)] == [b"hello"] * 2
    for broken in (record[:-6], b"x" + record):
        with pytest.raises(ValueError):
            list(warc.parse(broken))


def test_pipeline_stages(spark):
    docs = table(spark, SMALL, "documents").withColumn("extra", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = cut(stage(spark, docs, SMALL), name)
        assert kept.columns == docs.columns and 0 < kept.count() <= docs.count()
        assert kept.exceptAll(docs).isEmpty()
        docs = kept
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    check_packed(rows, {r.doc_id: r.text for r in docs.collect()})


def test_texts_that_languages_share_stay_in_the_pipeline(spark):
    docs = spark.createDataFrame([(i, "taxi radio hotel", lang, None, None, None) for i, lang in enumerate(["de", "en", "es"] * 10)], DOCS)
    assert corpus_pipeline.STAGES[0][1](spark, docs, SMALL).count() == 30


def test_texts_in_no_learned_language_leave_the_pipeline(spark):
    rng = np.random.default_rng(5)
    words = {
        "de": "der Zug fährt über die Brücke und hält nicht am alten Bahnhof weil dort schon lange niemand wartet".split(),
        "en": "the train goes over this bridge without stopping at any of those old stations where nobody waits".split(),
    }
    texts = {i: " ".join(rng.choice(words[("de", "en")[i % 2]], 30)) for i in range(60)}
    foreign = {
        100: "поезд идёт по мосту и не останавливается на старой станции",
        101: "поезд",
        102: " ".join("".join(rng.choice(list("adeghinorstuw"), 9)) for _ in range(30)),
        103: "tr" * 200,
    }
    rows = [(i, t, ("de", "en")[i % 2] if i < 100 else None, None, None, None) for i, t in (texts | foreign).items()]
    docs = spark.createDataFrame([*rows, (200, "over this bridge", None, None, None, None), (201, "am Bahnhof", None, None, None, None)], DOCS)
    kept = corpus_pipeline.STAGES[0][1](spark, docs, SMALL)
    assert {r.doc_id for r in kept.collect()} == {*texts, 200, 201}


def test_pipeline_stages_on_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, None, None, None, "z"), (2, "", "en", "s", 0, "z"), (3, "12", "en", "s", 2, "z")], DOCS)
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, frame, SMALL).count() <= 3
    assert corpus_pipeline.STAGES[0][1](spark, docs, SMALL).count() == 0
    assert corpus_pipeline.run(spark, SMALL).count() > 0
