"""Each operator against a plain answer on edge rows, and on tables of nothing, nulls and repeats."""

import brute
import numpy as np
import public_tokenizers
import pytest
from llm_cases import corpus, docs, no_docs, odd_docs  # noqa: F401
from pyspark.sql import functions as F

from starmart.llm import (decontaminate, license_scan, line_dedup, mixing, pitman_yor, quality_rules, simhash,
                          token_binary, toxicity, url_filter)
from starmart.llm.common import fold_crc

PATH = public_tokenizers.path("byte_bpe_50k.json")


def by_id(df):
    rows = df.collect()
    found = {r["doc_id"]: r for r in rows}
    assert len(found) == len(rows)
    return found


# --- line dedup --------------------------------------------------------------------------------

def test_line_dedup(docs, corpus):
    found = by_id(line_dedup.dedup_lines(docs))
    assert {i: (r.n_lines, r.n_dropped, brute.sha(r.kept)) for i, r in found.items()} == brute.line_dedup(corpus)


def test_line_dedup_threshold(spark):
    rows = [(i, "a line in three documents\nline of two documents" if i < 2 else "a line in three documents") for i in range(3)]
    found = by_id(line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_documents=3))
    assert [found[i].kept for i in range(3)] == [rows[0][1], "line of two documents", ""]


def test_line_dedup_odd_rows(odd_docs, no_docs):
    found = line_dedup.dedup_lines(odd_docs).collect()
    assert len(found) == 8 and line_dedup.dedup_lines(no_docs).count() == 0
    assert all(r.n_dropped == 0 for r in found if r.doc_id in (None, 1, 2, 3))
    assert [r.kept for r in found if r.doc_id == 4] == ["", ""]


def test_line_dedup_is_native(docs):
    plan = line_dedup.dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


# --- licence scan ------------------------------------------------------------------------------

def test_license_base(docs, corpus):
    found = by_id(license_scan.scan(docs))
    for i, text in corpus:
        base = [p for p in found[i].places if p.fixed]
        starts = [p.start for p in base]
        assert (found[i].n_words, len(base), min(starts, default=None), max(starts, default=None),
                ",".join(sorted({p.label for p in base}))) == brute.license_base(text), text


@pytest.mark.parametrize("text, label", [
    ("foo. Licensed under the Apache License, Version 2.0.", "apache-2.0"),
    ("Released under the MIT license. bar", "mit"), ("released in 2020 under the MIT license", "mit"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl-3.0"),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc-4.0"), ("a license of the works under version 2 0", None),
    ("the apache tribe", None)])
def test_license_notices(spark, text, label):
    rows = [(0, text), *((i, "other words of no licence") for i in range(1, 9))]
    found = by_id(license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")))
    labels = {p.label for p in found[0].places if not p.fixed}
    assert labels == ({label} if label else set())
    assert all(0 <= p.score <= 1 for p in found[0].places) and not found[1].places


def test_license_odd_rows(odd_docs, no_docs):
    assert license_scan.scan(odd_docs).count() == 8 and license_scan.scan(no_docs).count() == 0


# --- token files -------------------------------------------------------------------------------

@pytest.mark.parametrize("bits", [1, 7, 16, 17, 31, 32])
def test_pack_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000).astype("<u4")
    assert (token_binary.unpack(token_binary.pack(ids, bits), bits, 1000) == ids).all()
    assert len(token_binary.pack(ids, bits)) == 16 * 8 * bits


def test_segment_random_access():
    parts = [np.arange(n, dtype="<u4") for n in (5000, 0, 1, 3191)]
    segment = token_binary.Segment(token_binary.write_segment([4, None, 6, 7], parts, 13, block=128))
    whole = np.concatenate(parts)
    assert segment.documents["ids"].tolist() == [5000, 0, 1, 3191] and segment.documents["known"].tolist() == [1, 0, 1, 1]
    for start, stop in ((0, 8192), (127, 129), (4096, 4096), (8000, 9999), (5000, 5001)):
        assert (segment.ids(start, stop) == whole[start:stop]).all()


@pytest.mark.parametrize("text", ["", " ", "a  b", "a \n\n b\t", "x\u00a0 y\u2003z \u00a0 w", "it's <|endoftext|> 's  \n",
                                  "\x0b a\x1c b", "naïve  café\r\n\r\nend ", "   lead", "1 2  345 !!? ..."])
def test_pieces_give_the_whole_text(text):
    made = token_binary.encoder(PATH)
    assert made.encode(text) == made.whole(text)


def test_pieces_of_random_texts():
    import random

    rng, made = random.Random(9), token_binary.encoder(PATH)
    signs = ["a", "B", "é", "ß", "1", "٣", "²", "'", "s", "ll", "'re", " ", "  ", "\n", "\t", "\r", "_", "-", ".", "!", "\u00a0",
             "\x0b", "\u0301", "中", "😀", "|", "<|", "Ⅷ", "’", "\u200b", "\x1c", "\x85", "\u3000"]
    for _ in range(4000):
        text = "".join(rng.choices(signs, k=rng.randint(0, 14)))
        assert made.encode(text) == made.whole(text), repr(text)


def test_tokens(spark, docs, corpus, tmp_path):
    token_binary.write_tokens(docs, PATH, str(tmp_path / "t"))
    found = token_binary.read_documents(spark, str(tmp_path / "t")).orderBy("doc_id").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found] == brute.tokens(corpus, PATH)


def test_tokens_odd_rows(spark, odd_docs, no_docs, tmp_path):
    token_binary.write_tokens(odd_docs, PATH, str(tmp_path / "t"))
    found = token_binary.read_documents(spark, str(tmp_path / "t")).orderBy("start").collect()
    assert [r.doc_id for r in found] == [1, 1, 2, 3, 4, 4, None, None] and found[3].n_tokens == 1
    assert [r.start for r in found[1:]] == list(np.cumsum([r.n_tokens for r in found])[:-1])
    token_binary.write_tokens(no_docs, PATH, str(tmp_path / "n"))
    assert token_binary.read_documents(spark, str(tmp_path / "n")).count() == 0


# --- decontamination ---------------------------------------------------------------------------

ITEMS = [(1, "this very passage of words stands in a number of documents of the corpus"), (2, "ein der que"), (3, None),
         (4, ""), (10, " ".join(f"w{k}" for k in range(100, 130))), (5, "ein der que"), (6, "a b a b a b a b a b a b a b a b"),
         (7, " ".join(f"w{k}" for k in range(110, 140))), (None, "les por idiot")]


def items(spark, rows=ITEMS):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, doc_id string")


@pytest.mark.parametrize("block_words", [200_000, 20])
def test_decontaminate(spark, docs, corpus, block_words, monkeypatch):
    monkeypatch.setattr(decontaminate.automata, "__defaults__", (13, block_words))
    found = by_id(decontaminate.contamination(docs, items(spark)))
    expected = brute.decontaminate(corpus, [(i, t) for i, t in ITEMS if i is not None])
    with_null = brute.decontaminate(corpus, ITEMS)
    for i, row in found.items():
        assert (row.n_words, row.n_hit, row.contaminated) == (*with_null[i][:2], with_null[i][4]), i
        assert (len(row["items"]), brute.sha(",".join(row["items"]))) == expected[i][2:4], i


@pytest.mark.parametrize("from_files", [False, True])
@pytest.mark.parametrize("block_words", [200_000, 20])
def test_decontaminate_rows_that_share_an_id(spark, block_words, from_files, tmp_path, monkeypatch):
    monkeypatch.setattr(decontaminate.automata, "__defaults__", (13, block_words))
    texts = [ITEMS[0][1], "clean words only", ITEMS[4][1] + " tail", None, "ein der que " + ITEMS[7][1]]
    rows = [(i, t) for i in (None, 7) for t in texts]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    if from_files:
        table.write.parquet(str(tmp_path / "t"))
        table = spark.read.parquet(str(tmp_path / "t"))
    judged = brute.decontaminate(list(enumerate(t for _, t in rows)), ITEMS)
    want = [(rows[i][0], *row[:2], row[4]) for i, row in judged.items()]
    found = [(r.doc_id, r.n_words, r.n_hit, r.contaminated) for r in decontaminate.contamination(table, items(spark)).collect()]
    assert sorted(map(str, found)) == sorted(map(str, want))


def test_automaton_is_exact():
    import random

    rng = random.Random(3)
    for _ in range(60):
        some = [(str(k), [rng.choice("ab").encode() for _ in range(rng.randint(0, 12))]) for k in range(4)]
        words = [rng.choice("abc").encode() for _ in range(60)]
        spans, found = decontaminate.Automaton(some, 4).scan(words)
        joined = " ".join(w.decode() for w in words)
        want = brute.decontaminate([(0, joined)], [(n, " ".join(w.decode() for w in x)) for n, x in some], 4)[0]
        assert (sum(b - a for a, b in spans), len(found)) == want[1:3]


def test_decontaminate_odd_rows(spark, odd_docs, no_docs):
    assert decontaminate.contamination(odd_docs, items(spark)).count() == 8
    assert decontaminate.contamination(no_docs, items(spark)).count() == 0
    clean = decontaminate.contamination(odd_docs, items(spark, [])).collect()
    assert len(clean) == 8 and not any(r.contaminated or r.n_hit for r in clean)
    assert decontaminate.keep_clean(odd_docs, items(spark, [])).count() == 8


def test_spans_are_cut():
    assert decontaminate.without_spans("One, two-three FOUR. five", [(1, 3), (4, 5)]) == "One,  FOUR. "


# --- Pitman-Yor --------------------------------------------------------------------------------

def held():
    return (fold_crc("doc_id", 7) == 2).alias("held_out")


def test_pitman_yor_base(docs, corpus):
    found = by_id(pitman_yor.score_documents(docs, held(), chunk_bytes=3000))
    expected = brute.base_scores(corpus)
    for i, row in found.items():
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == expected[i][:4]
        assert row.base_score == pytest.approx(expected[i][4], rel=1e-9) and row.score < 0
    per_token = lambda name: sum(r[name] for r in found.values() if r.held_out) / sum(r.n_tokens for r in found.values() if r.held_out)
    assert per_token("score") > per_token("base_score")


def test_pitman_yor_is_a_distribution():
    """Probabilities of all tokens and the unknown add up to one in every context."""
    counts = [(b"a", 0, 5), (b"a", 3, 1), (b"b", 3, 400), (b"c", 9, 2)]
    types = np.array([[b"a", b"b", b"c"].index(w) * pitman_yor.CONTEXTS + k for w, k, _ in counts])
    bucket = pitman_yor.Bucket([b"a", b"b", b"c"], types, np.array([n for *_, n in counts]), np.ones(4, int), np.ones(3, int))
    totals, kept = pitman_yor.Totals(bucket.totals()), []
    for number in range(4):
        bucket = pitman_yor.sweep(bucket, totals, True, [1, number])
        totals = pitman_yor.Totals(bucket.totals())
        kept.append(totals)
    scorer = pitman_yor.Scorer(bucket, kept)
    for context in (0, 3, 9, 20):
        assert scorer.chances(np.arange(4), np.full(4, context)).sum() == pytest.approx(1)
    assert all((t <= bucket.counts).all() and (t >= 1).all() for t, _ in bucket.samples)


def test_seats_follow_the_process():
    """Mean tables of the block sampler against customers seated one by one."""
    rng, n, weight, discount = np.random.default_rng(0), 30, 2.5, 0.4
    fast = pitman_yor.seat(np.full(20_000, n), np.full(20_000, weight), discount, rng)
    tables = np.ones(20_000)
    for seated in range(1, n):
        tables += rng.random(20_000) * (weight + seated - discount * tables) < weight
    assert fast.mean() == pytest.approx(tables.mean(), rel=0.01) and fast.std() == pytest.approx(tables.std(), rel=0.05)


def test_pitman_yor_odd_rows(odd_docs, no_docs):
    found = pitman_yor.score_documents(odd_docs, F.lit(False).alias("held_out")).collect()
    assert len(found) == 8 and all(r.n_known == r.n_tokens for r in found)
    untrained = pitman_yor.score_documents(odd_docs, F.lit(True).alias("held_out")).collect()
    assert all(r.n_known == 0 and r.score == 0 and r.base_score == 0 for r in untrained)
    assert pitman_yor.score_documents(no_docs, held()).count() == 0


# --- toxicity ----------------------------------------------------------------------------------

def toxic_table(spark, n=1200):
    import random

    rng, rows = random.Random(1), []
    bad = ["vile", "nasty", "awful"]
    for i in range(n):
        words = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(20, 120))]
        toxic = i % 8 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((i, " ".join(words), int(toxic)))
    return rows, spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), \
        spark.createDataFrame([(i, None if i % 5 == 0 and not t else t, "x") for i, _, t in rows], "doc_id long, toxic int, text string")


def test_toxicity_held_out(spark):
    rows, docs, labels = toxic_table(spark)
    learn = F.col("doc_id") % 3 != 1
    found = by_id(toxicity.scores(docs, toxicity.fit(docs, labels, learn)))
    assert all((found[i].score >= toxicity.CUT) == bool(t) for i, _, t in rows)


def test_toxicity_sample_is_the_same_for_any_partitioning(spark):
    _, docs, labels = toxic_table(spark, 300)
    copies = docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 1000)).unionByName(  # repeated ids too
        docs.where("doc_id < 50").withColumn("text", F.concat("text", F.lit(" tail"))))
    rows = [sorted(map(tuple, toxicity._samples(df, labels, F.lit(True), 20, 100).collect()), key=str)
            for df in (copies, copies.repartition(7), copies.orderBy(F.desc("doc_id")).coalesce(1))]
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) > 20
    assert len({(text, positive) for _, text, positive in rows[0]}) == len(rows[0])


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    _, docs, labels = toxic_table(spark, 300)
    model = toxicity.fit(docs, labels, F.lit(True))
    found = toxicity.scores(odd_docs, model).collect()
    assert len(found) == 8 and all(0 <= r.score < toxicity.CUT for r in found)
    assert toxicity.scores(no_docs, model).count() == 0
    none = toxicity.fit(docs, labels.where("false"), F.lit(True))
    assert toxicity.scores(docs, none).where("score >= 0.01").count() == 0


def test_risk_stays_non_negative():
    """Without the correction positives among the unlabelled would count as negatives."""
    rows = [np.array([0])] * 50 + [np.array([0])] * 30 + [np.array([], int)] * 170
    weights = toxicity.fit_classifier(rows, np.arange(250) < 50, 0.15, 1)
    assert 1 / (1 + np.exp(-weights.sum())) > 0.9 and 1 / (1 + np.exp(-weights[-1])) < 0.1


# --- URL filter --------------------------------------------------------------------------------

URLS = [None, "", "no scheme", "http://", "http://NET", "http://a.net/", "http://net/x", "https://xnet/x", "http://Example.net/en/1?q=a://b.net/",
        "http://w.example.net/EN/", "http://a.example.com/de/5#top", "http://a.example.com/de", "http://sub.a.org/fr/x",
        "http://a.org/en/", "x://y://z.net/a", "http://a.net?x", "http://a.net#/", "ftp://B.Org/fr/?page=2&ref=x", "http://é.net/\n/x"]


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(URLS)], "page_id long, url string, host string, verdict string")
    none = spark.createDataFrame([], "url string, verdict string")
    found = {r.page_id: r for r in url_filter.judge(pages, none).collect()}
    for i, url in enumerate(URLS):
        host, path, rule, verdict = brute.url_rule(url)
        assert (found[i].host, found[i].path, found[i].rule, found[i].verdict) == (host, path, rule, verdict or "allow"), url


def test_url_mining_matches_counting(spark):
    """Mined rules against a count of every combination, and their matches against all rules."""
    from itertools import combinations

    rows = []
    for k in range(400):
        spam = k % 4 == 0
        host = ("cheap-pills" if k % 8 == 0 else "casino") if spam else f"site{k % 5}"
        rows.append((f"http://{host}.example.{'org' if k % 3 else 'com'}/{'en' if k % 2 else 'es'}/{k}", "block" if spam else "allow"))
    table = spark.createDataFrame(rows, "url string, verdict string")
    host, path = url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))
    sets = table.select(url_filter.tokens_of(host, path, F.col("url")).alias("tokens"), "verdict")
    listed = [(frozenset(r.tokens), r.verdict) for r in sets.collect()]
    count, label, total = {}, {}, len(listed)
    for tokens, verdict in listed:
        label[verdict] = label.get(verdict, 0) + 1
        for size in range(1, len(tokens) + 1):
            for part in combinations(sorted(tokens), size):
                count[part] = count.get(part, 0) + 1
                count[part, verdict] = count.get((part, verdict), 0) + 1
    least = max(url_filter.MIN_SUPPORT * total, url_filter.MIN_COUNT)
    rules = {}
    for (part, verdict), n in ((k, n) for k, n in count.items() if isinstance(k[0], tuple)):
        sure = n / count[part]
        if n >= least and sure >= url_filter.MIN_CONFIDENCE and sure * total / label[verdict] >= url_filter.MIN_LIFT:
            rules[part, verdict] = sure
    rules = {(p, v): c for (p, v), c in rules.items() if not any(
        set(q) < set(p) and w == v and d >= c for (q, w), d in rules.items())}
    mined = url_filter.mined_rules(sets)
    assert {(tuple(r.tokens), r.verdict) for r in mined.collect()} == set(rules)
    matched = {tuple(r.tokens): r.mined for r in url_filter.matches(sets.select("tokens").distinct(), mined).collect()}
    for tokens, verdict in listed:
        met = [(c, v) for (p, v), c in rules.items() if set(p) <= tokens]
        assert (matched.get(tuple(sorted(tokens))) is None) == (not met)
        if verdict == "block":
            assert matched[tuple(sorted(tokens))] == "block"


def test_url_labels(spark):
    pages = spark.createDataFrame([("http://a/en/5.html",), ("http://a/x/6/",), ("http://a/7?p",), ("http://a/b8",), (None,)], "url string")
    labels = spark.createDataFrame([(5, 1, 1), (6, 1, 0), (7, 0, None), (8, 1, 1), (6, None, None)], "doc_id long, quality int, toxic int")
    assert sorted((r.url, r.verdict) for r in url_filter.labels_of(pages, labels).collect()) == [
        ("http://a/7?p", "block"), ("http://a/en/5.html", "block"), ("http://a/x/6/", "allow")]


def test_url_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(pages, spark.createDataFrame([], "url string, verdict string")).count() == 0


# --- quality rules -----------------------------------------------------------------------------

def test_quality_signals(docs, corpus):
    found = by_id(quality_rules.judge(docs))
    for i, text in corpus:
        s = found[i].found
        assert (s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words, found[i].base_failed) == brute.quality(text), text
        assert not (found[i].kept and found[i].base_failed)


def test_quality_model_finds_kinds():
    """Patterns of three kinds of bad documents, that each fail other rules, against their counts."""
    patterns = np.array([[1, 1, 1], [-1, 1, 1], [1, -1, -1], [1, 0, 1]])
    model = quality_rules.LabelModel(patterns, np.array([900, 60, 30, 10]))
    log = np.log(model.shares)[:, None] + sum(np.log(model.votes[:, k, patterns[:, k] + 1]) for k in range(3))
    good = np.exp(log[0]) / np.exp(log).sum(0)
    assert good[0] > 0.9 and good[3] > 0.5 and good[1] < 0.5 and good[2] < 0.1
    assert (model.accuracies() > 0.5).all()
    again = quality_rules.LabelModel(patterns[::-1], np.array([900, 60, 30, 10])[::-1])
    assert np.array_equal(model.votes, again.votes)


def test_quality_odd_rows(odd_docs, no_docs, docs):
    assert quality_rules.judge(odd_docs).count() == 8 and quality_rules.judge(no_docs).count() == 0
    assert quality_rules.keep_good(no_docs).count() == 0
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in quality_rules.judge(docs).where("kept").collect()}


# --- SimHash -----------------------------------------------------------------------------------

def test_covering_masks():
    """Every set of at most three bits is left out by some mask; four bits need not be."""
    from itertools import combinations

    masks = simhash.covering_masks()
    assert len(masks) == 15
    for bits in combinations(range(64), 3):
        assert any(not m & (1 << bits[0] | 1 << bits[1] | 1 << bits[2]) for m in masks)


@pytest.mark.parametrize("bucket", [4096, 16])
def test_links_of_clusters(spark, bucket):
    import random

    rng, prints = random.Random(bucket), set()
    for _ in range(12):
        at = rng.getrandbits(64)
        for _ in range(25):
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                at ^= 1 << bit
            prints.add(at)
    prints |= {0, (1 << 64) - 1, 1, 1 << 63}
    table = spark.createDataFrame([(simhash._signed(p),) for p in prints], "print long")
    found = {r["print"] % (1 << 64): r.root % (1 << 64) for r in simhash.components(simhash.links(table, bucket=bucket)).collect()}
    want = brute.components({p: p for p in prints})
    groups = lambda of: {frozenset(p for p in prints if of.get(p, p) == r) for r in {of.get(p, p) for p in prints}}
    assert groups(found) == groups(want)


def test_long_chains(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(0, 400)] + [(1000, 900), (900, 950)], "a long, b long")
    found = {r["print"]: r.root for r in simhash.components(edges).collect()}
    assert all(found[k] == 0 for k in range(401)) and found[1000] == found[950] == found[900] == 900


def test_near_duplicates(docs, corpus):
    found = by_id(simhash.near_duplicates(docs))
    prints = {i: brute.fingerprint(t) for i, t in corpus}
    assert {i: r["print"] % (1 << 64) for i, r in found.items()} == prints
    assert {i: r.component_id for i, r in found.items()} == brute.components(prints)


def test_near_duplicates_odd_rows(odd_docs, no_docs):
    found = simhash.near_duplicates(odd_docs).collect()
    assert len(found) == 8 and {r.component_id for r in found if r.doc_id == 4} == {2}
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = [r.doc_id for r in simhash.keep_first(odd_docs).collect()]
    assert sorted(kept, key=lambda x: (x is None, x)) == [1, 2, 3, None, None]


@pytest.mark.parametrize("from_files", [False, True])
def test_stages_decide_by_row(spark, from_files, tmp_path):
    """Rows without doc_id, or with the same one, each get their own decision."""
    long = " ".join(f"alpha{k} beta" for k in range(60))
    rows = [(None, long, "s"), (None, long, "s"), (5, long, "s"), (None, ITEMS[0][1], "s"), (6, ITEMS[0][1] + " x", "s"),
            (6, "gamma delta", "s"), (None, None, "s"), (None, "", "s")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    if from_files:
        table.write.parquet(str(tmp_path / "t"))
        table = spark.read.parquet(str(tmp_path / "t"))
    first = [(r.doc_id, r.text or "") for r in simhash.keep_first(table, keep_unnamed=False).collect()]
    prints = {k: brute.fingerprint(t) for k, (_, t, _) in enumerate(rows)}
    assert len(first) == len(set(brute.components(prints).values()))
    assert (5, long) in first and (None, long) not in first and {(6, rows[4][1]), (6, rows[5][1])} <= set(first)
    clean = [(r.doc_id, r.text) for r in decontaminate.keep_clean(table, items(spark)).collect()]
    assert sorted(map(str, clean)) == sorted(map(str, [r[:2] for r in rows if not (r[1] or "").startswith("this very")]))


def test_each_row_has_its_own_copies(spark):
    rows = [(None, "a b c", "s")] * 30 + [(None, "a b c", "t")] * 30 + [(1, "a b c", "t")] * 30
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = sum(r.copies for r in mixing.mix(table).collect())
    taken = mixing.take(table).count()
    assert taken == want and taken <= 90


# --- mixing ------------------------------------------------------------------------------------

@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 100, "c": 1000, None: 50}, {"z": 0, "b": 5},
                                   {f"s{k}": 1 + k * k for k in range(20)}, {"only": 7}, {"a": 0}])
def test_targets(spark, sizes):
    rows = [(s, n) for s, n in sizes.items()]
    found = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    assert found == pytest.approx(brute.targets(sizes) if sum(sizes.values()) else {s: 0.0 for s in sizes})


def test_mix(docs, corpus):
    rows = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    text = dict(corpus)
    assert all(r.size == len(brute.WORD.findall(text[r.doc_id] or "")) and r.taken <= 3 * r.size for r in rows)
    sums, most, target = {}, {}, {}
    for r in rows:
        sums[r.source] = sums.get(r.source, 0) + r.taken
        most[r.source], target[r.source] = max(most.get(r.source, 0), r.size), r.target
    assert sum(sums.values()) <= sum(target.values()) + 1e-6
    largest = max(most.values())
    assert all(abs(sums[s] - target[s]) <= most[s] + largest for s in sums)


def test_mix_odd_rows(odd_docs, no_docs):
    rows = mixing.mix(odd_docs).collect()
    assert len(rows) == 8 and mixing.mix(no_docs).count() == 0
    assert mixing.take(no_docs).count() == 0
    taken = mixing.take(odd_docs)
    assert taken.columns == odd_docs.columns
