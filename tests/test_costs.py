"""Results that stay the same while rows are parsed, hashed and numbered at less cost, and the plans that show it."""

import datetime as dt
import hashlib
import random
import re

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from catalogue.adapters import Tables
from conftest import values
from starmart.functions import rules
from starmart.operators import facts, ids, quality, staging
from starmart.session import stored

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def logical(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def regex(pattern, text):
    return None if text is None else re.search(pattern, text, re.A | re.S)


def test_trims_find_what_the_patterns_found(rows):
    rng, letters = random.Random(5), " \t\n\x0b\f\r aZ019-+é"
    texts = [None, "", *("".join(rng.choice(letters) for _ in range(rng.randint(1, 13))) for _ in range(3000)),
             "2019-02-28", "2019-02-30", " 2019-02-28 10:00", "2019-2-28", "2019-02-2 ", "+2019-1-01", "-0001-01-01", "9712A", "00"]
    c = F.col("c")
    found = rows("c string", *[(t,) for t in texts]).select(
        "c", rules.stripped_or_null(c), rules.has_text(c), rules.not_blank(c), rules.digits_only(c),
        rules.establishment_id(c), rules.text_date(c), rules.has_length(c, 10), rules.strip(c)).collect()

    def day(t):
        match = regex(r"^\s*([0-9]{4}-[0-9]{2}-[0-9]{2})", t)
        try:
            return match and dt.date.fromisoformat(match[1])
        except ValueError:
            return None

    for t, stripped, text, not_blank, digits, establishment, date, ten, strip in map(tuple, found):
        match = regex(r"\S(?:.*\S)?", t)
        assert stripped == (match and match[0]) and text == bool(match)
        assert not_blank == (None if t is None else bool(regex("[^ ]", t)))
        assert digits == (None if t is None else re.sub("[^0-9]", "", t))
        assert establishment == ((t or "").strip(" ").lstrip("0") or "0")
        assert date == day(t) and ten == (None if t is None else bool(regex(r"^\s*\S.{8,}\S", t)))
        assert strip == (None if t is None else t.strip(" \t\n\x0b\f\r"))


def test_a_counted_load_parses_each_value_once(spark, rows, tmp_path):
    raw = rows("id_consultation string, id_patient string, date_consultation string, diagnostic string, "
               "id_etablissement string, montant string, sexe string, age string",
               ("1", "p", "2020-01-02", "d", "7", "1.5", "F", "30"), ("2", "p", "2020-13-02", "d", "7", " ", "F", " "),
               ("3", "p", " 2020-01-03x", None, "7", None, None, "x"))
    raw.write.parquet(str(tmp_path / "raw"))
    loaded, watch = staging.load_consultations(spark.read.parquet(str(tmp_path / "raw"))), Observation("costs")
    accepted = loaded.counted(watch).accepted
    parsing = [line for line in logical(accepted).splitlines() if "regexp_extract" in line]
    assert len(parsing) == 1 and "Project [" in parsing[0]
    assert values(accepted) == values(loaded.accepted) and [r[0] for r in values(accepted)] == ["1"]
    assert watch.get == {"rows": 3, "rejected": 2}
    assert sorted(r.reason for r in loaded.rejected.collect()) == ["age", "date_consultation"]


def test_deaths_are_conformed_after_they_are_counted(rows):
    bronze = rows("date_deces string, code_region string, nb_deces long", ("2020-01-01", "84", 2), (" 2020-01-01 10:00", " 84", None),
                  ("2020-01-01", " ", 5), ("2020-01", "84", 1), (None, "84", 1), ("2020-01-02", "11", 4), ("2020-01-02", "11", 4))
    counted = facts.deaths_by_day_and_region(bronze)
    assert values(counted) == [("2020-01-01", "84", 3), ("2020-01-02", "11", 8)]
    assert values(facts.deaths_by_day_and_region(bronze.drop("nb_deces")))[0] == ("2020-01-01", "84", 2)
    below = plan(counted)
    assert below.rindex("HashAggregate") > below.rindex("btrim") if "btrim" in below else "rlike" not in below


@pytest.mark.parametrize("few", [False, True])
def test_checks_count_values_by_grouping_sets(spark, rows, few):
    dimension = rows("k string", ("1",), ("1",), ("2",), (None,))
    days = rows("d int", (20200101,), (20200102,))
    table = rows("id long, k string, d int, v double", (1, "1", 20200101, 0.5), (1, "1", 20200103, None), (None, None, None, None),
                 (2, "9", 20200102, 1.0), (None, "9", 20200102, None))
    table = table.limit(0) if few else table
    checked = quality.soundness(table, "t", quality.Rules(
        minimum=2, unique=("id",), not_null=("k", "v", "id"), foreign={"k": (dimension, "k"), "d": (days, "d")}))
    found = {(r.check_name, r.metric_name): (int(r.metric_value), r.passed) for r in checked.collect()}
    wanted = {("min_rows", "row_count"): 5, ("unique_key", "id"): 2, ("null_columns", "k"): 1, ("null_columns", "v"): 3,
              ("null_columns", "id"): 2, ("foreign_key", "k"): 2, ("foreign_key", "d"): 1}
    if few:
        wanted = dict.fromkeys(wanted, 0)
    assert found == {rule: (n, n >= 2 if rule[0] == "min_rows" else n == 0) for rule, n in wanted.items()}
    assert few or ("Expand" in plan(checked) and "array_compact" not in logical(checked) and "filter(array" not in logical(checked))
    plain = quality.soundness(table, "t", quality.Rules(not_null=("k",)))
    assert [int(r.metric_value) for r in plain.collect()] == [0 if few else 1]


def test_fingerprints_hash_each_value_once(rows):
    data = [(i % 3 or None, "é|", i / 4) for i in range(40)]
    table = rows("a int, b string, c double", *data)
    told = [("\\N" if a is None else str(a), b, f"{c:.6f}") for a, b, c in data]
    hashed = lambda text: int(hashlib.md5(text.encode()).hexdigest()[:15], 16)
    wanted = {}
    for name, texts in zip("abc*", [*zip(*told), ["|".join(t) for t in told]]):
        exclusive = 0
        for text in texts:
            exclusive ^= hashed(text)
        wanted[name] = (40, str(sum(map(hashed, texts))), exclusive)
    found = quality.fingerprint(table, "t")
    assert {r.column_name: (r.nb_lignes, r.hash_sum, r.hash_xor) for r in found.collect()} == wanted
    assert "Expand" in plan(found)


def test_ids_by_day_need_no_copy_of_the_rows(spark, rows, monkeypatch):
    labels = []
    monkeypatch.setattr(ids, "stored", lambda df, label="stored": labels.append(label) or stored(df, label))
    rng = random.Random(2)
    data = [(rng.choice([None, *range(20200101, 20200121)]), rng.choice("ab"), i % 2) for i in range(400)]
    table = stored(rows("day int, who string, x int", *data))
    last = lambda row: [(v is None, v) for v in row[:2]]
    for scattered in (table, table.where("day > 20200105"), table.limit(0)):
        numbered = ids.dense_ids(scattered, ["day", "who"], "id", start=5, partitions=6, is_plain_scan=True, by_day=True).collect()
        numbered.sort(key=lambda r: r.id)
        assert [r.id for r in numbered] == list(range(5, 5 + scattered.count()))
        assert [last(r[1:]) for r in numbered] == sorted(last(r[1:]) for r in numbered)
        assert sorted(map(repr, (tuple(r[1:]) for r in numbered))) == sorted(map(repr, map(tuple, scattered.collect())))
    assert set(labels) == {"days"}
    hot = stored(rows("day int, who string, x int", *[(20200101, "a", 0)] * 300, *data[:30]))
    numbered = ids.dense_ids(hot, ["day", "who"], "id", partitions=6, is_plain_scan=True, by_day=True)
    assert sorted(r.id for r in numbered.collect()) == list(range(1, 331)) and labels[-1] == "placed"


def test_settled_feeds_are_parsed_once(spark):
    t = Tables(spark, SF)
    fresh = values(Tables(spark, SF).dim_calendar())
    assert "events.parquet" in plan(t.dim_calendar())
    t.settle()
    assert values(t.dim_calendar()) == fresh
    for table in (t.dim_calendar(), t.fact_satisfaction(), t.fact_deaths(), t.fact_stays()):
        assert "events.parquet" not in plan(table) and "lineitem.parquet" not in plan(table)
