"""One query per operator over its whole table, and the same rows as plain SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerq.llm import (
    embedding_dedup,
    fill_middle,
    html_extract,
    language_id,
    lattice_lm,
    order_minhash,
    packing,
    quality_model,
    quality_rules,
    sentencepiece_codec,
    spelling_groups,
    vector_graph,
    warc,
)
from ledgerq.llm.common import prepare, table
from ledgerq.sources.workspace import fresh_path


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.main_texts(pages, html_extract.learn(html_extract.built_in(spark)))


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_model.scores(docs, quality_model.learn(docs, table(spark, sf_dir, "labels")))


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.learn(docs))


def near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digests(table(spark, sf_dir, "documents"))


def document_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.document_scores(table(spark, sf_dir, "documents"))


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(prepare(spark), "warc")
    warc.write(warc.resolve(table(spark, sf_dir, "pages")), path)
    return warc.sizes(warc.read(spark, path))


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def near_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.classes(table(spark, sf_dir, "documents"))


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups.groups(table(spark, sf_dir, "documents"))


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vector_graph.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    return fill_middle.digests(made).drop("output")


QUERIES = {
    "op1_html_extraction": html_extraction,
    "op2_quality_classifier": quality_classifier,
    "op3_language_id": languages,
    "op4_embedding_dedup": near_vectors,
    "op5_sentencepiece": sentencepiece,
    "op6_lm_scoring": document_scores,
    "op7_quality_rules": rules,
    "op8_warc": archives,
    "op9_packing": packed,
    "op10_minhash_dedup": near_texts,
    "op11_spelling_groups": spelling_variants,
    "op12_nearest_vectors": nearest_vectors,
    "op13_fill_in_middle": fill_in_middle,
}

ORACLES = {
    "op8_warc": """
        select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, d as payload_digest,
            case when first < page_id then 'revisit' else 'response' end as record_type,
            case when first < page_id then first end as refers_to
        from (
            select *, case when octet_length(encode(coalesce(html, ''))) >= 100
                then min(page_id) over (partition by d) end as first
            from (select *, sha256(coalesce(html, '')) as d from pages)
        )
    """,
    "op11_spelling_groups": """
        with recursive crc as (
            select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                lambda c, z: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end) order by i) as t
            from (select unnest(range(256)) as i)
        ), runs as (
            select doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as r
            from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) as r from documents)
        ), counted as (select doc_id, r, count(*) as n from runs where length(r) >= 7 group by doc_id, r), hashed as (
            select r, n, xor(4294967295, list_reduce([4294967295] || flatten(list_transform(string_split(doc_id || ':' || r, ''),
                lambda a: case when ord(a) < 128 then [ord(a)::bigint] else [195, ord(a)::bigint - 64] end)),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) as h
            from counted, crc
        ), words as (
            select w as word, sum(n)::bigint as n
            from (select case when h % 31 = 0 then left(r, h % length(r)) || substr(r, h % length(r) + 2) else r end as w, n
                from hashed)
            where length(w) >= 7 group by w having sum(n) >= 2
        ), less as (
            select word, n, i, left(word, i - 1) || substr(word, i + 1) as v
            from (select word, n, unnest(range(1, length(word) + 1)) as i from words)
        ), near as (
            select a.word, b.word as other, b.n as m from less a join less b on a.v = b.v and a.i = b.i and a.word <> b.word
            union select a.word, b.word, b.n from words a join less b on a.word = b.v
            union select b.word, a.word, a.n from words a join less b on a.word = b.v
        ), best as (
            select word, count(*) as n_near, first(other order by m desc, other) as best, max(m) as best_n from near group by word
        ), forms as (
            select w.word, n, coalesce(n_near, 0) as n_near, case when best_n >= 10 * n then best end as form,
                case when best_n >= 10 * n then best_n end as form_n
            from words w left join best using (word)
        ), chain as (
            select word, word as root, 0 as steps from forms
            union all select c.word, f.form, steps + 1 from chain c join forms f on c.root = f.word where f.form is not null
        ), ends as (select word, arg_max(root, steps) as root from chain group by word)
        select word, form, root, n, n_near, form_n from forms join ends using (word)
    """,
    "op13_fill_in_middle": """
        with hashed as (
            select doc_id, coalesce(text, '') as t, sha256('1:' || doc_id) as d,
                regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u
            from documents
        ), drawn as (
            select *, len(u) as n, ('0x' || d[1:8])::ubigint % (len(u) + 1) as c1, ('0x' || d[9:16])::ubigint % (len(u) + 1) as c2,
                case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>')
                        or ('0x' || d[17:24])::ubigint % 100 >= 90 then 'plain'
                    when ('0x' || d[25:32])::ubigint % 100 < 20 then 'spm' else 'psm' end as form
            from hashed
        ), parts as (
            select *, array_to_string(list_slice(u, 1, least(c1, c2)), '') as p,
                array_to_string(list_slice(u, least(c1, c2) + 1, greatest(c1, c2)), '') as m,
                array_to_string(list_slice(u, greatest(c1, c2) + 1, n), '') as s
            from drawn
        )
        select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars,
            case when form <> 'plain' then length(m) end as middle_chars,
            sha256(case form when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
                when 'spm' then '<S>' || s || '<P>' || p || '<M>' || m else t end) as output_sha256,
            sha256(t) as restored_sha256
        from parts
    """,
}
