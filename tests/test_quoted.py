"""Quoted line breaks in files of many splits, and headers that differ from file to file."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import values
from starmart.sources import delimited, feeds, quoted


@pytest.fixture
def split_at(spark):
    """Files are cut into splits of so many bytes."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    yield lambda size: spark.conf.set(name, str(size))
    spark.conf.set(name, before)


def field(rng):
    kind = rng.random()
    if kind < 0.4:
        return rng.choice(["", "a", "12", "é", "x y", "5\" pipe", " \"b\""])
    inner = "".join(rng.choices(["\n", "\r\n", ";", "\"\"", "word", "ü", " ", "\n\n"], k=rng.randint(0, 12)))
    return f'"{inner}"'


def records(rng, n, columns=3, end="\n"):
    return "a;b;c" + end + "".join(";".join(field(rng) for _ in range(columns)) + end for _ in range(n))


def as_one_task(spark, path, encoding="UTF-8"):
    return (spark.read.schema("a string, b string, c string").option("header", True).option("sep", ";")
            .option("escape", '"').option("multiLine", True).option("encoding", encoding).csv(str(path)))


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("size", [40, 300, 10_000])
def test_equal_to_one_task(spark, split_at, tmp_path, seed, size):
    path = tmp_path / "a.csv"
    path.write_bytes(records(random.Random(seed), 80).encode())
    split_at(size)
    lines = spark.read.text(str(path))
    assert lines.rdd.getNumPartitions() >= min(4, path.stat().st_size // size)
    assert values(delimited.read_delimited(spark, str(path), delimiter=";", multi_line=True)) == values(
        as_one_task(spark, path))


def test_several_files_and_file_names(spark, split_at, tmp_path):
    texts = [records(random.Random(k), 20) for k in range(3)]
    for k, text in enumerate(texts):
        (tmp_path / f"{k}.csv").write_bytes(text.encode("latin-1"))
    split_at(100)
    found = delimited.read_layouts(spark, [str(tmp_path)], {c: [c] for c in "abc"}, "ISO-8859-1", delimiter=";",
                                   keep_file_name=True, multi_line=True)
    for k in range(3):
        assert values(found.where(F.col("file_name").endswith(f"/{k}.csv")).select("a", "b", "c")) == values(
            as_one_task(spark, tmp_path / f"{k}.csv", "ISO-8859-1"))


def test_quoted_header_with_a_line_break(spark, split_at, tmp_path):
    (tmp_path / "a.csv").write_text('"first\nname";b\r\n1;"x\r\ny"\r\n\r\n;2\r\n', newline="")
    for size in (5, 1000):
        split_at(size)
        df = delimited.read_delimited(spark, str(tmp_path / "a.csv"), multi_line=True)
        assert df.columns == ["first\nname", "b"] and values(df) == [("1", "x\r\ny"), (None, "2")]


def test_lost_closing_quote_is_an_error(spark, split_at, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text('a;b\n1;"2\n' + "3;4\n" * 500)
    monkeypatch.setattr(quoted, "MOST_BYTES", 300)
    split_at(100)
    with pytest.raises(Exception, match="closing quote is missing"):
        delimited.read_delimited(spark, str(tmp_path / "a.csv"), multi_line=True).collect()


def test_empty_and_header_only_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a;b\n")
    (tmp_path / "b.csv").write_text("")
    (tmp_path / "c.csv").write_text('b;a\n"1\n";2\n')
    df = delimited.read_delimited(spark, f"{tmp_path}/*.csv", multi_line=True)
    assert df.columns == ["a", "b"] and values(df) == [("2", "1\n")]
    with pytest.raises(ValueError, match="no header"):
        delimited.read_delimited(spark, str(tmp_path / "b.csv"))


def test_states_of_lines():
    quotes = quoted.Quotes(";")
    for line, outside, inside in [(b"", False, True), (b"a;b", False, True), (b'"a', True, False), (b'a;"b;c', True, False),
                                  (b'a"b', False, False), (b'"a""', True, False), (b'x";"y', True, True),
                                  (b'x""y";"z', True, True), (b'"a";"b"', False, False), (b'"', True, False)]:
        assert quotes.after(line, False) == outside, line
        assert quotes.after(line, True) == inside, line


def test_each_file_has_its_own_header(spark, tmp_path, monkeypatch):
    """A glob and a folder; read by the driver and by a job."""
    (tmp_path / "a.csv").write_text("finess;nom\n1;Un\n")
    (tmp_path / "b b.csv").write_text("nom;finess\nDeux;2\n")
    (tmp_path / "c.csv").write_text("NOM,Finess,z\nTrois,3,z\n")
    aliases = {"id": ["finess"], "name": ["nom"]}
    for few in (64, 0):
        monkeypatch.setattr(delimited, "FEW_FILES", few)
        for path in (f"{tmp_path}/*.csv", str(tmp_path)):
            for multi_line in (False, True):
                found = delimited.read_layouts(spark, [path], aliases, multi_line=multi_line)
                assert values(found.select("id", "name")) == [("1", "Un"), ("2", "Deux"), ("3", "Trois")]


def test_job_reads_only_the_beginning_of_files(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.csv").write_text(f"h{k};x\n" + "1;2\n" * 200_000)
    found = delimited.file_headers(spark, [str(tmp_path)])
    assert [(file.rsplit("/", 1)[-1], header) for file, header in found] == [(f"{k}.csv", b"h%d;x" % k) for k in range(3)]


def test_headers_that_differ_in_case_only(spark, tmp_path):
    (tmp_path / "a.csv").write_text("finess;FINESS;nom\n1;2;x\n")
    assert values(delimited.read_delimited(spark, str(tmp_path / "a.csv"))) == [("1", "2", "x")]
    found = delimited.read_layouts(spark, [str(tmp_path / "a.csv")], {"id": ["finess"], "name": ["nom"]})
    assert values(found) == [("1", "x")]


def test_required_column_in_every_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("date,lieu\n2019-01-01,75\n")
    (tmp_path / "b.csv").write_text("lieu\n75\n")
    with pytest.raises(ValueError, match="no date column"):
        feeds.read_deaths(spark, [str(tmp_path)])
