"""Records of CSV files whose quoted fields hold line ends, over split borders."""

import csv
import io
import random

import pytest

from ledgerlink.sources import files as FS


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda size: [spark.conf.set("spark.sql.files.maxPartitionBytes", str(size)), spark.conf.set("spark.sql.files.openCostInBytes", "0")]
    for k, v in old.items():
        spark.conf.set(k, v)


def write(path, rows, preamble=(), end="\n"):
    path.mkdir(exist_ok=True)
    out = io.StringIO(newline="")
    out.write("".join(x + "\n" for x in preamble))
    csv.writer(out, lineterminator=end).writerows([("id", "text", "more")] + rows)
    name = path / f"f{len(list(path.iterdir()))}.csv"
    name.write_bytes(out.getvalue().encode())
    return out.getvalue()


def read(spark, path, skip):
    df = FS.read_csv_skip_preamble(spark, str(path), skip)
    assert df.columns == ["id", "text", "more"]
    return sorted(tuple(r) for r in df.collect())


def random_rows(rng, n, first=0):
    words = ["a", 'say "x"', "line\nbreak", '"', "\n", "\n\n", "b,c", "x" * 60, '","', '"\n"', "tail\n", "é"]
    return [(str(first + i), "".join(rng.choice(words) for _ in range(rng.randint(1, 6))), rng.choice(words)) for i in range(n)]


@pytest.mark.parametrize("size", [40, 333, 1 << 20])
def test_quoted_line_ends_over_split_borders(spark, tmp_path, small_splits, size):
    rng = random.Random(1)
    rows = []
    for k in range(3):
        some = random_rows(rng, 40, 100 * k)
        write(tmp_path / "t", some, ["Export", 'of a "catalogue', ""])
        rows += some
    small_splits(size)
    assert read(spark, tmp_path / "t", 3) == sorted(rows)


def test_a_field_longer_than_several_splits(spark, tmp_path, small_splits):
    rows = [("1", "x\n" * 400, "a"), ("2", "short", "b"), ("3", "y" * 900 + "\n" + "z", "c\nd")]
    write(tmp_path / "t", rows)
    small_splits(100)
    assert read(spark, tmp_path / "t", 0) == rows


def test_quotes_inside_plain_fields_do_not_open(spark, tmp_path, small_splits):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "f.csv").write_text('id,text,more\n1,5" pipe,x\n2,"a\nb",y\n\n3,6" pipe,z\n')
    for size in (12, 1 << 20):
        small_splits(size)
        assert read(spark, tmp_path / "t", 0) == [("1", '5" pipe', "x"), ("2", "a\nb", "y"), ("3", '6" pipe', "z")]


def test_windows_line_ends(spark, tmp_path, small_splits):
    rows = [("1", "a", "b"), ("2", "c", "d")]
    write(tmp_path / "t", rows, end="\r\n")
    small_splits(10)
    assert read(spark, tmp_path / "t", 0) == rows


def test_written_tables_come_back(spark, tmp_path, small_splits):
    rows = random_rows(random.Random(2), 60)
    df = spark.createDataFrame(rows, "id string, text string, more string").repartition(3)
    FS.write_csv_with_preamble(df, str(tmp_path / "t"), ["one", "two"])
    small_splits(64)
    assert read(spark, tmp_path / "t", 2) == sorted(rows)


def test_no_records(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "f.csv").write_text("only\n")
    assert FS.read_csv_skip_preamble(spark, str(tmp_path / "t"), 1).columns == []
    write(tmp_path / "h", [])
    assert FS.read_csv_skip_preamble(spark, str(tmp_path / "h"), 0).count() == 0


@pytest.mark.parametrize("line,before,after", [("a,b", 0, 0), ("a,b", 1, 1), ('"a', 0, 1), ('"a', 1, 0), ('x"', 1, 0), ('x""', 1, 1), ('x"""', 1, 0),
                                               ('","', 0, 0), ('","', 1, 1), ('a"b', 0, 0), ('x",y"z', 1, 0), ('"a"",', 0, 1), ("", 1, 1), ("", 0, 0)])
def test_state_after_a_line(line, before, after):
    assert FS._after_line(line, bool(before), ",") == bool(after)
