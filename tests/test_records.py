"""CSV records across split borders, and plans of the splittable reader."""

import collections
import csv
import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

from evenkeel.catalogue import QUERIES
from evenkeel.sources import readers, records


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def exported(rows, sep, newline):
    out = io.StringIO()
    writer = csv.writer(out, delimiter=sep, lineterminator=newline)
    writer.writerows(rows)
    return out.getvalue()


def test_quoted_line_breaks_across_splits(spark, small_splits, tmp_path):
    draw = random.Random(6)
    words = ["pump", "a,b", 'say "hi"', "x;y", "line\nbreak", "\n\n", "é", '"', "Tampere – “€”", "word " * 40, "\n" * 500, "q\n" * 300]
    cell = lambda: "".join(draw.choice(words) for _ in range(draw.randrange(3))) or "v"
    want = collections.Counter()
    for n, (sep, encoding, header, newline) in enumerate([
            (",", "utf-8-sig", ["K", "T", "U"], "\n"), (";", "cp1252", ["U", "K", "Extra", "T"], "\n"), (",", "utf-8", ["T", "K"], "\r\n")]):
        rows = [[f"{n}-{i}" if h == "K" else cell().strip(" ") for h in header] for i in range(300)]
        (tmp_path / f"f{n}.csv").write_bytes(exported([header, *rows], sep, newline).encode(encoding))
        for row in rows:
            named = dict(zip(header, row))
            want[tuple(named.get(h) for h in ("K", "T", "U", "Extra"))] += 1
    df = readers.read_erp_csv(spark, str(tmp_path))
    assert sorted(df.columns) == ["Extra", "K", "T", "U", "source_file"]
    assert collections.Counter((r.K, r["T"], r.U, r.Extra) for r in df.collect()) == want
    lines = readers._lines(spark, str(tmp_path), "*.csv")
    assert lines.select("_at.file_block_start").distinct().count() > 50 and lines.rdd.getNumPartitions() > 50
    chosen = readers.read_erp_csv(spark, str(tmp_path), columns=["T", "Nowhere"])
    assert chosen.columns == ["T", "Nowhere", "source_file"] and chosen.where("Nowhere IS NOT NULL").count() == 0
    assert chosen.count() == 900


def test_one_plan_for_any_number_of_headers(spark, tmp_path):
    for n in range(6):
        (tmp_path / f"f{n}.csv").write_text(f"K,H{n}\n1,2\n")
    df = readers.read_erp_csv(spark, str(tmp_path), columns=["K", "H1", "H5"])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation [value" in plan and plan.count("Union") <= 1 and df.count() == 6
    assert df.where("H5 = '2'").count() == 1


def test_cells(spark):
    cases = {'a,b': ["a", "b"], '"a,b",c': ["a,b", "c"], ',,': [None, None, None], '"",x': ["", "x"], '"say ""hi""",y': ['say "hi"', "y"],
             '"a\nb","c"': ["a\nb", "c"], '""""': ['"'], "": [None]}
    df = spark.createDataFrame([(k,) for k in cases], "r string").select("r", records.cells_of(F.col("r"), F.lit(",")).alias("c"))
    assert {r.r: r.c for r in df.collect()} == cases


def test_empty_files_and_folders(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "only_header.csv").write_text("K,T\n")
    assert readers.read_erp_csv(spark, str(tmp_path)).count() == 0
    (tmp_path / "none").mkdir()
    with pytest.raises(Exception):
        readers.read_erp_csv(spark, str(tmp_path / "none")).count()


ODD = ["plain", "caf\xe9", '"', '""', 'x"', '"\n"', '","', "l1\n\nl2\n", "\n", "a\rb", "a\r\nb", "a\r", "caf\xe9\r", "\r", "\ufeffbom", "l\n\ufeffbom",
       "caf\xe9\x85", "caf\xe9\x93", "caf\xe9\u2028", "caf\xe9\u2029", "\xc3\xa9", "a\x01b", "caf\xe9\x01\x02", "\x02a\x01\x02b,", "\x00", " lead", "trail ",
       "#c", "null", "NULL", "None", "", None, "\\", 'a\\"b', "x" * 1500 + '"\r\n' + "y" * 1500]


@pytest.mark.parametrize("langs", [("de", "fr", "en"), ("de",), ("", None)])
def test_exports_keep_any_text(spark, small_splits, tmp_path, langs):
    rows = [(i, text, lang, f"s{i}") for i, (text, lang) in enumerate((t, l) for l in langs for t in ODD)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    one_byte = lambda t, l: l in ("de", "fr") and t is not None and any("\xa0" <= c <= "\xff" for c in t) and all(c <= "\xff" for c in t)
    want = {(str(i), l, s if one_byte(t, l) else None, t if t is None else hashlib.sha256(t.encode()).hexdigest()) for i, t, l, s in rows}
    got = [tuple(r) for r in QUERIES["csv_exports"](spark, str(tmp_path)).collect()]
    assert len(got) == len(rows) and set(got) == want
