"""Records of files that are read in pieces, against the csv module on whole files."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from occrisk import jobs
from occrisk.config import LoadConfig
from occrisk.sources import catalogue, landing, notices, records
from test_landing import LAYOUT_C, text_of, zip_to

PIECES = ["a", ";", ";", '"', '"', '""', "\n", "\n", "\r", "\r\n", " ", "é", 'x"y', ';"', '";', "123"]


def plain(text: str) -> list[list[str]]:
    return [r for r in csv.reader(io.StringIO(text, newline=""), delimiter=";") if r]


def cut(spark, texts: dict[str, str], every: int):
    """Lines in blocks of so many line feeds; places of blocks and of lines in one file ascend together."""
    data = [(path, n // every * 1000, 7 * n, part) for path, text in texts.items() for n, part in enumerate(text.split("\n"))]
    return records.cut_lines(spark.createDataFrame(data, "path string, block bigint, at bigint, text string").repartition(3))


def read(lines) -> dict[str, list[list[str]]]:
    found = records.records(lines, records.block_states(lines)).collect()
    out: dict[str, list] = {}
    for r in sorted(found, key=lambda r: (r["path"], r["block"], r["at"], r["pos"])):
        out.setdefault(r["path"], []).append(r["cells"])
    return out


@pytest.mark.parametrize("every", [1, 2, 5, 1000])
def test_records_of_any_text(spark, every):
    pick = random.Random(every)
    texts = {f"f{n}": "".join(pick.choices(PIECES, k=pick.randrange(1, 80))) + "\n" for n in range(150)}
    # a text that ends inside quotes keeps the line feed that cutting takes away
    texts = {p: t if plain(t + "\x00")[-1] == ["\x00"] else t + '"\n' for p, t in texts.items()}
    texts = {p: t for p, t in texts.items() if plain(t + "\x00")[-1] == ["\x00"]}
    assert len(texts) > 100
    got = read(cut(spark, texts, every))
    for path, text in texts.items():
        assert got.get(path, []) == plain(text), repr(text)


def test_an_open_quote_runs_to_the_end(spark):
    got = read(cut(spark, {"f": 'a;b\nc;"open\nto;the\nend'}, 1))
    assert got == {"f": [["a", "b"], ["c", "open\nto;the\nend"]]}


def test_long_lines_do_not_exhaust_the_pattern(spark):
    cells = ['"' + 'q""' * 20_000 + '"', *['"x"'] * 20_000, "plain" * 20_000]
    got = read(cut(spark, {"f": ";".join(cells) + "\nlast;\n"}, 1))
    assert got["f"] == plain(";".join(cells) + "\nlast;\n")


@pytest.fixture()
def small_pieces(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "16k")
    yield
    spark.conf.set(name, before)


def test_quoted_breaks_in_a_file_of_many_pieces(spark, tmp_path, small_pieces):
    """Several tasks read one file with breaks inside cells; its archived twin has the same rows."""
    lines = [f'{100000 + i};"Linha\n{i};\n""fim""";S00;x;8630;Saúde;Não;05/06/2023' for i in range(4000)]
    content = text_of((LAYOUT_C[0], lines))
    (tmp_path / "cat-2023.csv").write_bytes(content)
    zip_to(tmp_path / "D.SDA.PDA.005.CAT.202306.ZIP", "CAT.CSV", content)
    found = records.text_lines(spark, str(tmp_path), landing.chosen(2023, 2023), "ISO-8859-1")
    assert found.rdd.getNumPartitions() > 5
    flagged, _ = notices.read_notices(spark, str(tmp_path), 2023, 2023, str(tmp_path / "work"))
    columns = [c for c in flagged.columns if c != "_source_file"]
    one = rows(flagged.filter("_source_file like '%.csv'").select(columns))
    assert len(one) == 4000 and one == rows(flagged.filter("_source_file like '%.ZIP'").select(columns))


def _files_read(df) -> int:
    """Files that the scans of a plan opened, after it ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def test_files_of_other_years_are_not_opened(spark, tmp_path):
    for year in range(2015, 2023):
        (tmp_path / f"cat-{year}.csv").write_bytes(text_of(LAYOUT_C))
        zip_to(tmp_path / f"D.SDA.PDA.005.CAT.{year}05.ZIP", "CAT.CSV", text_of(LAYOUT_C))
    inside = landing.chosen(2020, 2021)
    assert _files_read(landing.listing(spark, str(tmp_path), inside)) == 4
    assert _files_read(landing.binary_files(spark, str(tmp_path), "*.ZIP").filter(inside).select("path", "content")) == 2
    named = landing.chosen(2015, 2022, ["cat-2020.csv", "cat-2010.csv"])
    assert _files_read(records.text_lines(spark, str(tmp_path), named, "ISO-8859-1").select("line")) == 1


def _resource(url, kind, name="n"):
    return {"url": url, "format": kind, "name": name}


def test_catalogues_decide_what_is_opened(spark, tmp_path):
    folder, listed = tmp_path / "CAT", tmp_path / "catalogues"
    folder.mkdir()
    listed.mkdir()
    for name in ("cat-2020.csv", "cat-2021.csv", "cat-2022.csv", "cat-2023.csv", "cat-2012.csv"):
        (folder / name).write_bytes(text_of(LAYOUT_C))
    first = [_resource("http://a/cat-2020.csv", "csv", "kept"), _resource("http://a/cat-2021.csv", "PDF"), _resource("http://a/cat-2012.csv", "CSV"), _resource(None, "CSV")]
    second = [_resource("http://a/cat-2020.csv", "XLSX"), _resource("http://a/cat-2021.csv", "CSV"), _resource("http://a/cat-2023.csv", "zip")]
    for n, entries in enumerate((first, second)):
        (listed / f"{n}.json").write_text(json.dumps({"result": {"resources": entries}}, indent=1))
    entries = catalogue.read_catalogues(spark, str(listed))
    # the first catalogue's entry counts, also where its format is not wanted
    assert rows(catalogue.wanted(entries, 2018, 2025).select("url", "nome", "ano")) == [("http://a/cat-2020.csv", "kept", 2020), ("http://a/cat-2023.csv", "n", 2023)]
    names = catalogue.file_names(spark, str(listed), 2018, 2025)
    assert sorted(names) == ["cat-2020.csv", "cat-2023.csv"]
    _, status = notices.read_notices(spark, str(folder), 2018, 2025, str(tmp_path / "work"), names)
    assert sorted(r["_source_file"] for r in status.collect()) == ["cat-2020.csv", "cat-2023.csv"]
    with pytest.raises(ValueError, match="no wanted files"):
        catalogue.file_names(spark, str(listed), 1990, 1991)
    tables = jobs.raw_tables(spark, "s", str(tmp_path), str(tmp_path / "root"), LoadConfig(), str(listed))
    assert tables["cat_microdados"][1]().count() == 2 * len(LAYOUT_C[1])


def test_header_over_several_lines(spark, tmp_path):
    header = '"Observação\nlivre";' + LAYOUT_C[0]
    (tmp_path / "cat-2023.csv").write_bytes(text_of((header, ["o;" + line for line in LAYOUT_C[1]])))
    flagged, status = notices.read_notices(spark, str(tmp_path), 2023, 2023, str(tmp_path / "work"))
    assert [r["status"] for r in status.collect()] == ["ok"]
    assert flagged.filter(~F.col("em_quarentena")).count() == 2
