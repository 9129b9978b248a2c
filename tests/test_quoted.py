import csv
import random

import pytest

from simalign.sources import files, quoted

SCHEMA = "id long, text string, tail string"


@pytest.fixture
def small_splits(spark):
    """Splits of 64 bytes at least and no more than a few hundred."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def _rows(spark, how, path):
    return sorted((tuple(r) for r in how(spark, path, SCHEMA).collect()), key=repr)


def _plain(path):
    with open(path, newline="", encoding="utf-8") as lines:
        rows = list(csv.reader(lines))
    return [(int(i), text or None, tail or None) for i, text, tail in rows[1:]]


def _text(rng):
    bits = ['""', "\n", "\r\n", ",", "word", "é", " ", "\\", "\n\n", "a long run of plain words"]
    return "".join(rng.choices(bits, k=rng.randint(0, 12)))


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_rows_equal_plain_readers(small_splits, tmp_path, seed, newline):
    rng = random.Random(seed)
    for part in range(2):
        rows = ["id,text,tail"] + [f'{i},"{_text(rng)}",{rng.choice(["", "x", chr(34) * 2])}' for i in range(60)]
        # one record longer than many splits, of blank lines and quotes
        rows.append('99,"' + "\n" * 300 + '""' * 200 + '",end')
        (tmp_path / f"{part}.csv").write_bytes((newline.join(rows) + newline * rng.randint(0, 1)).encode())
    got = _rows(small_splits, files.read_csv, str(tmp_path))
    assert got == sorted((row for part in range(2) for row in _plain(tmp_path / f"{part}.csv")), key=repr)
    if newline == "\n":  # in files of \r\n that reader takes the \r of line breaks inside fields away
        assert got == _rows(small_splits, files.read_whole_csv, str(tmp_path))
    assert len(got) == 122


def test_one_file_is_many_tasks(small_splits, tmp_path):
    (tmp_path / "a.csv").write_text("id,text,tail\n" + "".join(f'{i},"a\nb",c\n' for i in range(400)))
    assert files.read_whole_csv(small_splits, str(tmp_path), SCHEMA).rdd.getNumPartitions() == 1
    assert quoted._lines(small_splits, str(tmp_path)).rdd.getNumPartitions() > 20
    assert _rows(small_splits, files.read_csv, str(tmp_path)) == sorted(((i, "a\nb", "c") for i in range(400)), key=repr)


def test_lines_are_not_shuffled(small_splits, tmp_path):
    (tmp_path / "a.csv").write_text('id,text,tail\n1,"a\nb",c\n')
    whole = quoted.records(small_splits, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert whole.count("rightHint=(strategy=broadcast)") == 2


@pytest.mark.parametrize("content", ["", "id,text,tail\n", "\n\nid,text,tail\n\n7,a,b\n\n", "id,text,tail\n7,a,b", 'id,text,tail\n7,"open\nto the end'])
def test_edges(small_splits, tmp_path, content):
    (tmp_path / "a.csv").write_text(content)
    want = _rows(small_splits, files.read_whole_csv, str(tmp_path))
    assert _rows(small_splits, files.read_csv, str(tmp_path)) == want
