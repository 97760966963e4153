"""Rows that share an id, columns with the operators' own names, ties, and growing contexts."""

import random
from collections import Counter

import brute
import numpy as np
import pytest
from llm_cases import corpus, docs, no_docs, odd_docs  # noqa: F401
from pyspark.sql import functions as F

from starmart.llm import decontaminate, line_dedup, mixing, pitman_yor, quality_rules, simhash

KINDS = "doc_id long, text string, source string"


@pytest.mark.parametrize("from_files", [False, True])
def test_line_dedup_of_rows_that_share_an_id(spark, from_files, tmp_path):
    """Each row loses its own lines only."""
    rows = [(1, "shared line here\nfirst one", "s"), (2, "shared line here\nunique in second row", "s"),
            (2, "another text entirely\nshared line here", "s"), (2, None, None), (None, "shared line here", None)]
    table = spark.createDataFrame(rows, KINDS).repartition(3)
    if from_files:
        table.write.parquet(str(tmp_path / "t"))
        table = spark.read.parquet(str(tmp_path / "t"))
    found = sorted((r.doc_id or 0, r.n_lines, r.n_dropped, r.kept) for r in line_dedup.dedup_lines(table).collect())
    assert found == [(0, 1, 0, "shared line here"), (1, 2, 0, "shared line here\nfirst one"), (2, 1, 0, ""),
                     (2, 2, 1, "another text entirely"), (2, 2, 1, "unique in second row")]


ITEM = " ".join(f"w{k}" for k in range(20))


def test_spans_are_cut_from_each_row(spark):
    long = " ".join(f"plain{k}" for k in range(30_000))
    texts = [f"Before, {ITEM}; after.", ITEM, long + " " + ITEM + " " + long, "clean text", None, "",
             "one short item here " + "and many other words of a clean text " * 10, "short item", f"é {ITEM} ü {ITEM} ö"]
    rows = [(i % 3 or None, t, "s") for i, t in enumerate(texts)] * 2
    items = spark.createDataFrame([("a", ITEM), ("b", "short item")], "item_id string, text string")
    found = decontaminate.cut_spans(spark.createDataFrame(rows, KINDS).repartition(4), items)
    assert found.columns == ["doc_id", "text", "source"]
    wanted = ["Before, ; after.", "", long + "  " + long, "clean text", None, "", texts[6], "", "é  ü  ö"]
    assert Counter(tuple(r)[:2] for r in found.collect()) == Counter([(i % 3 or None, t) for i, t in enumerate(wanted)] * 2)
    assert decontaminate.cut_spans(spark.createDataFrame(rows, KINDS), items.limit(0)).count() == len(rows)


def test_what_is_left_after_cutting_has_no_hit(spark, docs, corpus):
    items = spark.createDataFrame([("p", "this very passage of words stands in a number of documents of the corpus")],
                                  "item_id string, text string")
    left = decontaminate.cut_spans(docs, items)
    assert left.count() == len(corpus) and set(left.columns) == set(docs.columns)
    assert decontaminate.contamination(left, items).where("n_hit > 0").count() == 0


OWN = ["__row", "__of", "__copies", "__copy", "__signals", "__spans", "input__row"]


def test_stages_take_columns_with_their_own_names(spark):
    text = " ".join(f"word{k} of a long enough document" for k in range(20))
    rows = [(i, f"{text} {i % 4} " + " ".join(random.Random(i).choices("abcdefghij", k=60)), "s", *(f"{c}{i}" for c in OWN))
            for i in range(12)]
    table = spark.createDataFrame(rows, KINDS + "".join(f", {c} string" for c in OWN))
    items = spark.createDataFrame([("b", "no such item")], "item_id string, text string")
    for stage in (quality_rules.keep_good, simhash.keep_first, mixing.take,
                  lambda d: decontaminate.keep_clean(d, items), lambda d: decontaminate.cut_spans(d, items)):
        found = stage(table)
        assert found.columns == table.columns
        for r in found.collect():
            assert [r[c] for c in OWN] == [f"{c}{r.doc_id}" for c in OWN]


def test_mixing_spreads_rows_without_ids(spark):
    """Ties of id, source and size are cut by the row key; every row has its own copies."""
    table = spark.createDataFrame([(None, "two words", "a")] * 200 + [(i, "one", "b") for i in range(40)], KINDS).repartition(4)
    found = mixing.mix(table).collect()
    assert len(found) == 240
    by_source = {s: sum(r.taken for r in found if r.source == s) for s in "ab"}
    target = {r.source: r.target for r in found}
    assert all(abs(by_source[s] - target[s]) <= 2 for s in "ab")
    plan = mixing.mix(table)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan


def test_contexts_grow_with_the_text():
    sizes = [pitman_yor.contexts_for(n) for n in (0, 1 << 20, 16 << 20, 128 << 20, 16 << 30, 16 << 40)]
    assert sizes == sorted(sizes) and sizes[0] == sizes[2] == 64 and sizes[3] == 128 and sizes[-1] > 6_000


@pytest.mark.parametrize("contexts", [64, 300, 70_000])
def test_scores_of_many_contexts(spark, docs, corpus, monkeypatch, contexts):
    """Base columns stay, and the model's probabilities beat the base on held-out texts."""
    monkeypatch.setattr(pitman_yor, "contexts_for", lambda held: contexts)
    held = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2).alias("held_out")
    found = {r.doc_id: r for r in pitman_yor.score_documents(docs, held, chunk_bytes=3000).collect()}
    expected = brute.base_scores(corpus)
    for i, row in found.items():
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == expected[i][:4]
        assert row.base_score == pytest.approx(expected[i][4], rel=1e-9)
    out = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_many_contexts_are_a_distribution():
    words, contexts = [b"a", b"b", b"c"], 1000
    types = np.array([0 * contexts + 0, 0 * contexts + 999, 1 * contexts + 500, 2 * contexts + 9])
    bucket = pitman_yor.Bucket(words, types, np.array([5, 1, 400, 2]), np.ones(4, int), np.ones(3, int), [], contexts)
    totals, kept = pitman_yor.Totals(bucket.totals()), []
    for number in range(4):
        bucket = pitman_yor.sweep(bucket, totals, True, [1, number])
        totals = pitman_yor.Totals(bucket.totals())
        kept.append(totals)
    scorer = pitman_yor.Scorer(bucket, kept)
    for context in (0, 9, 500, 777, 999):
        assert scorer.chances(np.arange(4), np.full(4, context)).sum() == pytest.approx(1)

def test_deep_urls_of_one_host(spark):
    """Tokens that only come together are one item: no combination of them is mined apart."""
    from starmart.llm import url_filter

    deep = "/".join(f"part{k}" for k in range(12))
    rows = [(f"http://a.spam.example/{deep}/{k}", "block") for k in range(60)] + [
        (f"http://site{k % 7}.example/{'en' if k % 2 else 'es'}/{k}", "allow") for k in range(140)]
    table = spark.createDataFrame(rows, "url string, verdict string")
    host, path = url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))
    sets = table.select(url_filter.tokens_of(host, path, F.col("url")).alias("tokens"), "verdict")
    model, classes = url_filter.mine(sets)
    assert model.freqItemsets.count() < 100
    rules = url_filter.mined_rules(sets)
    blocking = {tuple(r.tokens) for r in rules.where("verdict = 'block'").collect()}
    assert blocking == {(t,) for t in ["host:a", "host:spam", "word:a", "word:spam"] + [f"path:part{k}" for k in range(12)]}
    pages = spark.createDataFrame([(1, f"http://b.other/part3/x", None), (2, "http://site1.example/en/5", "x"),
                                   (None, f"https://a.spam.example/{deep}", ""), (None, "http://b.other/" + "y/" * 5000, "")],
                                  "page_id long, url string, html string")
    found = [(r.page_id, r.verdict) for r in url_filter.judge(pages.unionByName(pages), table).collect()]
    assert sorted(found, key=str) == sorted([(1, "block"), (2, "allow"), (None, "block"), (None, "allow")] * 2, key=str)
