import hashlib
import hmac
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.functions import rules
from starmart.functions.numbers import half_up_tenth, score_units
from starmart.operators.lookups import add_region_code, add_region_of_place


def apply(spark, inputs, rule):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(rule(F.col("v"))).collect()]


def test_establishment_id_sql_rule(spark):
    assert apply(spark, ["00012", " 12 ", "000", "", "  ", None, "0A0", "A00"],
                 rules.establishment_id) == ["12", "12", "0", "0", "0", "0", "A0", "A00"]


def test_establishment_id_keeps_inner_tab(spark):
    assert apply(spark, ["\t012"], rules.establishment_id) == ["\t012"]


def test_establishment_id_file_rule(spark):
    inputs = ["FR0012", "000", "abc", " ", None, "2A004"]
    assert apply(spark, inputs, rules.establishment_id_from_file) == [
        "12", "0", None, None, None, "2004"]
    assert apply(spark, inputs, lambda c: rules.establishment_id_from_file(c, True)) == [
        "12", "0", "0", None, None, "2004"]


def test_regions_of_places(spark):
    df = spark.createDataFrame([(v,) for v in ["69001", "97411", "2A004", "99999", "1", "", None,
                                               " 75 001"]], "place string")
    found = {r.place: r.code_region for r in add_region_of_place(df, "place").collect()}
    assert found == {"69001": "84", "97411": "04", "2A004": None, "99999": None, "1": None,
                     "": None, None: None, " 75 001": "11"}


def test_region_code_priority(spark):
    df = spark.createDataFrame(
        [("84", "Bretagne"), ("Rhône-Alpes", None), (None, "ILE DE FRANCE"), (" ", "Côte"),
         ("Atlantide", "Bretagne"), (None, None), (" 32 ", None)],
        "code_region string, name string")
    found = [(r.name, r.code_region) for r in add_region_code(df, "code_region", "name").collect()]
    assert sorted(found, key=str) == sorted(
        [("Bretagne", "84"), (None, "84"), ("ILE DE FRANCE", "11"), ("Côte", None),
         ("Bretagne", None), (None, None), (None, "32")], key=str)


def test_two_digit_code(spark):
    assert apply(spark, ["84", "R-93x", "7", "75001", None], rules.two_digit_code) == [
        "84", "93", None, "75", None]


def test_decimal_comma(spark):
    assert apply(spark, ["73,5", " 12.25 ", "abs", "", None], rules.decimal_comma) == [
        Decimal("73.5000"), Decimal("12.2500"), None, None, None]


def test_dates(spark):
    assert apply(spark, ["2019-01-31T10:00", " 2020-02-29 ", "2019-00-00", "2019-02-30", "2019",
                         "31/01/2019", "", None], rules.text_date) == [
        date(2019, 1, 31), date(2020, 2, 29), None, None, None, None, None, None]
    assert apply(spark, [" 31-01-2019 ", "31-02-2020", " ", None], rules.day_first_date) == [
        date(2019, 1, 31), None, None, None]


def test_calendar_year_and_iso_week(spark):
    df = spark.createDataFrame([(date(2021, 1, 1),)], "d date")
    assert tuple(df.select(*rules.calendar_columns(F.col("d"))).head()) == (
        20210101, date(2021, 1, 1), 2021, 1, 1, 53)


def test_age_bands(spark):
    df = spark.createDataFrame([(a,) for a in [None, 0, 17, 18, 29, 30, 49, 50, 69, 70]], "a int")
    labels = [r[0] for r in df.select(rules.age_band(F.col("a"))).collect()]
    assert labels == ["Non renseigné", "< 18 ans", "< 18 ans", "18 – 29 ans", "18 – 29 ans",
                      "30 – 49 ans", "30 – 49 ans", "50 – 69 ans", "50 – 69 ans", "70 ans et +"]


def test_sex_and_integers(spark):
    assert apply(spark, [" Masculin", "f", "X", "", None], rules.sex_code) == [
        "M", "F", None, None, None]
    assert apply(spark, [" 45 ", "", "x", None], rules.blank_safe_int) == [45, None, None, None]


def test_full_name(spark):
    df = spark.createDataFrame([("A", "B"), ("A", None), (None, "B"), (None, None)],
                               "nom string, prenom string")
    assert [r[0] for r in df.select(rules.full_name(F.col("nom"), F.col("prenom"))).collect()] == [
        "A B", "A", "B", ""]


@pytest.mark.parametrize("key", [b"k", b"x" * 64, b"long key " * 20])
def test_pseudonym_is_hmac_sha256(spark, key):
    texts = ["12", "é", ""]
    expected = [hmac.new(key, t.encode(), hashlib.sha256).hexdigest() for t in texts]
    assert apply(spark, texts, lambda c: rules.keyed_pseudonym(c, key)) == expected


def test_rounding_never_rounds_twice(spark):
    # 2.44996 rounds to 2.4; a mean kept to four decimals would give 2.5
    df = spark.range(100000).select(F.when(F.col("id") < 44996, 3).otherwise(2).alias("x"))
    assert df.agg(half_up_tenth(F.sum("x"), F.count("x"))).head()[0] == 2.4
    signs = spark.createDataFrame([(-25, 100), (25, 100), (0, 0)], "s bigint, n bigint")
    assert [r[0] for r in signs.select(half_up_tenth(F.col("s"), F.col("n"))).collect()] == [
        -0.3, 0.3, None]


def test_score_units(spark):
    df = spark.createDataFrame([(73.1234,), (0.29,)], "s double")
    assert [r[0] for r in df.select(score_units(F.col("s"))).collect()] == [731234, 2900]
