"""Int keys and clashing names, for every operator on documents."""

import pytest

from ledgerq.llm import language_id, lattice_lm, order_minhash, packing, quality_model, quality_rules, sentencepiece_codec

WORDS = "the quick brown fox jumps over the lazy dog and runs away from all of them".split()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, " ".join(WORDS[i % 7 :] * (1 + i % 3)), "en" if i % 2 else "xx", "s", 9, f"mark{i}") for i in range(40)]
    return spark.createDataFrame(rows, "doc_id int, text string, lang string, source string, _row_number_ long, _id string")


def test_int_keys(spark, docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id int, quality int, toxic int")
    results = (
        quality_model.scores(docs, quality_model.learn(docs, labels)),
        language_id.predict(docs, language_id.learn(docs)),
        sentencepiece_codec.digests(docs),
        lattice_lm.document_scores(docs),
        quality_rules.judge(docs),
        order_minhash.classes(docs),
        packing.pack(docs),
    )
    for found in results:
        assert {r["doc_id"] for r in found.collect()} == set(range(40))


def test_a_users_columns_stay_as_they_are(docs):
    kept = order_minhash.distinct_documents(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert 0 < len(got) < 40
    assert all((r["_row_number_"], r["_id"]) == (9, f"mark{r['doc_id']}") for r in got)
