"""The registered queries and the pipeline over the driver's tables, against plain answers."""

import os
from collections import Counter

import brute
import public_tokenizers
import pytest

import corpus_pipeline
from starmart.llm import queries, toxicity

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]


def test_columns_and_rows(spark, documents):
    """Every query of documents has a row for each."""
    for name in ("op2_license_scan", "op5_pitman_yor", "op6_toxicity", "op8_quality_rules", "op9_simhash"):
        rows = queries.QUERIES[name](spark, SF).collect()
        assert sorted(r.doc_id for r in rows) == sorted(d[0] for d in documents), name


def test_license_query(spark, documents):
    text = {i: t for i, t, _ in documents}
    for r in queries.op2_license_scan(spark, SF).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.license_base(text[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_url_query(spark):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.op7_url_filter(spark, SF).collect():
        host, path, rule, verdict = brute.url_rule(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ({verdict} if verdict else {"allow", "block"})


def test_toxicity_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op6_toxicity(spark, sf).collect()
    found = Counter((labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels)
    right = (found[0, 0] + found[1, 1]) / sum(found.values())
    assert right > 0.97 and found[0, 1] < 0.01 * found[0, 0], found
    assert all(r.predicted == (r.score >= toxicity.CUT) for r in rows)


def test_pipeline_stages(spark, documents, tmp_path):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        result = spark.read.parquet(str(tmp_path / name))
        if name != "token_binary":
            assert sorted(result.columns) == sorted(docs.columns)
            found[name] = result.select("doc_id", "text", "source").collect()
        else:
            found[name] = result.orderBy("start").collect()
        docs = result
    text = {i: t for i, t, _ in documents}
    kept = {r.doc_id for r in found["quality_rules"]}
    assert kept and not any(brute.quality(text[i])[5] for i in kept)
    clean = [i for i in text if not brute.quality(text[i])[5] and not brute.quality(text[i])[2] and "!!" not in text[i]]
    assert kept.issuperset(clean)
    near = brute.components({i: brute.fingerprint(text[i]) for i in kept})
    first = {r.doc_id for r in found["simhash_near_dedup"]}
    assert first == {i for i, c in near.items() if i == c}
    judged = brute.decontaminate([(i, text[i]) for i in first], items)
    left = {r.doc_id for r in found["benchmark_decontamination"]}
    assert left == {i for i, row in judged.items() if not row[4]}
    sizes = {i: len(brute.WORD.findall(text[i])) for i in left}
    copies = Counter(r.doc_id for r in found["mixing"])
    assert set(copies) <= left and max(copies.values()) <= 3
    assert 0.9 * sum(sizes.values()) <= sum(sizes[i] * n for i, n in copies.items()) <= sum(sizes.values())
    ids = [(i, text[i]) for i, n in copies.items() for _ in range(n)]
    assert [tuple(r) for r in found["token_binary"]] == brute.tokens(ids, public_tokenizers.path("byte_bpe_50k.json"))
