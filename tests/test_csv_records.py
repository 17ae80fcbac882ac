"""Records of quoted CSV cut into many blocks, against Python's own reader."""

import csv
import io
import random

import pytest

from churnlens.schemas import RAW_USERS
from churnlens.sources import files as FS
from churnlens.sources.csv_records import csv_records, ends_inside, read_quoted_csv

CELLS = ["plain", "", "with, comma", 'say "hi"', "two\nlines", 'a "q\n", end', "\n\n", '"', '""', 'x\n"y"\n,z', " padded ", "é漢",
         "many\n" * 40, ',\n",",\n"']


def table(seed, n, width=4):
    r = random.Random(seed)
    return [[str(i), *(r.choice(CELLS) for _ in range(width - 1))] for i in range(n)]


def write(path, rows, header=("id", "a", "b", "c")):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator="\n")
        w.writerow(header)
        w.writerows(rows)


@pytest.fixture
def small_blocks(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def got(spark, path, columns=("id", "a", "b", "c")):
    return sorted([list(r) for r in read_quoted_csv(spark, str(path), list(columns)).collect()], key=lambda r: int(r[0]))


@pytest.mark.parametrize("seed", [1, 2])
def test_one_large_file_by_many_tasks(spark, tmp_path, small_blocks, seed):
    rows = table(seed, 300)
    write(tmp_path / "t.csv", rows)
    assert spark.read.option("lineSep", "\n").text(str(tmp_path / "t.csv")).rdd.getNumPartitions() > 30
    assert got(spark, tmp_path / "t.csv") == [[c or None for c in r] for r in rows]


def test_several_files_and_the_whole_reader(spark, tmp_path, small_blocks):
    folder = tmp_path / "folder"
    folder.mkdir()
    rows = table(3, 240)
    for k in range(3):
        write(folder / f"{k}.csv", rows[k * 80:k * 80 + 80])
    assert got(spark, folder) == [[c or None for c in r] for r in rows]
    users = [[f"u{i}", 1, 0, 2, 3, "2020-01-01T00:00:00Z", "2023-12-01T00:00:00Z", r[1], r[2], None, None, True, 31, None, 0]
             for i, r in enumerate(rows)]
    write(tmp_path / "raw.csv", users, [f.name for f in RAW_USERS.fields])
    raw = {r["username"]: r for r in FS.read_raw_users(spark, str(tmp_path / "raw.csv")).collect()}
    assert len(raw) == 240 and all(raw[f"u{i}"]["bio"] == (r[1] or None) and raw[f"u{i}"]["churn"] == 0 for i, r in enumerate(rows))


def test_stray_quotes_short_rows_and_line_ends(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes(b'id,a,b,c\r\n1,5" disk,x,y\r\n\r\n2,"in ""q""",z\r\n3,"two\r\nlines",b,c,surplus\n4,,"",end')
    assert got(spark, tmp_path / "t.csv") == [["1", '5" disk', "x", "y"], ["2", 'in "q"', "z", None],
                                              ["3", "two\r\nlines", "b", "c"], ["4", None, None, "end"]]


def test_header_only_and_empty(spark, tmp_path):
    write(tmp_path / "h.csv", [])
    assert read_quoted_csv(spark, str(tmp_path / "h.csv"), ["id"]).count() == 0
    (tmp_path / "e.csv").write_text("")
    assert csv_records(spark, str(tmp_path / "e.csv")).count() == 0


def test_unclosed_quote_is_named(spark, tmp_path, small_blocks, monkeypatch):
    from churnlens.sources import csv_records as R
    monkeypatch.setattr(R, "MOST_RECORD_BYTES", 2000)
    (tmp_path / "t.csv").write_text("id,a\n1,\"open\n" + "line\n" * 2000)
    with pytest.raises(Exception, match="not closed"):
        csv_records(spark, str(tmp_path / "t.csv")).count()


def test_line_steps_follow_the_csv_reader():
    r = random.Random(5)
    for _ in range(3000):
        line = "".join(r.choice('",ab') for _ in range(r.randrange(9)))
        for inside in (False, True):
            text = ('"' if inside else "") + line
            cells = next(csv.reader(io.StringIO(text + '\n","\n'), strict=False), [])
            # an open cell swallows the line break
            assert ends_inside(line, inside) == any("\n" in c for c in cells), (line, inside)
