"""CSV files with line breaks in quoted cells, read by several tasks."""

import csv
import io
import random

import pandas as pd
import pytest

from gridloom.errors import DataLoadError
from gridloom.sources import records
from gridloom.sources.readers import load_table, read_csv

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def tiny_splits(spark):
    spark.conf.set(SPLIT, "400")
    yield spark
    spark.conf.unset(SPLIT)


def _file(seed, ending="\n", rows=60):
    """Cells with quotes, commas and line breaks, some longer than several splits."""
    rng = random.Random(seed)
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=ending)
    writer.writerow(["id", "first\nname", "note"])
    bits = ["a", "b c", '"', '""', ",", "\n", "\n\n", ',"', '",\n"', "é", "1"]
    for i in range(rows):
        note = "".join(rng.choices(bits, k=rng.choice([0, 1, 3, 9, 400 if i % 20 == 7 else 5])))
        writer.writerow([i, "x" + "".join(rng.choices(bits, k=3)), "n" + note])
    return out.getvalue()


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed,ending", [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_records_over_many_splits(tiny_splits, tmp_path, seed, ending):
    text = _file(seed, ending)
    path = tmp_path / "t.csv"
    path.write_bytes(text.encode())
    df = load_table(tiny_splits, str(path))
    want = [tuple(r) for r in csv.reader(io.StringIO(text, newline=""))][1:]
    assert df.columns == ["id", "first\nname", "note"]
    assert _rows(df) == sorted((int(i), a, b) for i, a, b in want)
    frame = pd.read_csv(io.BytesIO(text.encode()), keep_default_na=False)
    assert frame.iloc[:, 2].tolist() == [b for _, _, b in want]
    # Many tasks make the records, not one.
    out, _ = records.quoted_records(tiny_splits, str(path), "UTF-8")
    assert out.rdd.glom().map(len).filter(bool).count() > 5


def test_the_way_for_very_many_splits(tiny_splits, tmp_path, monkeypatch):
    path = tmp_path / "t.csv"
    path.write_bytes(_file(4).encode())
    plain = _rows(load_table(tiny_splits, str(path)))
    monkeypatch.setattr(records, "BROADCAST_SPLITS", 0)
    assert _rows(load_table(tiny_splits, str(path))) == plain


def test_folders_latin_blank_lines_and_headers(tiny_splits, tmp_path):
    for kind in ("a", "b"):
        (tmp_path / "t" / f"kind={kind}").mkdir(parents=True)
        (tmp_path / "t" / f"kind={kind}" / "f.csv").write_bytes(
            f'\nid,note\n1,"caf\xe9\n{kind}"\n\n2,"{"long " * 200}\n"\n'.encode("latin-1")
        )
    df = read_csv(tiny_splits, str(tmp_path / "t"))
    long = "long " * 200 + "\n"
    assert sorted(map(tuple, df.select("id", "note", "kind").collect())) == sorted(
        (i, n, k) for k in "ab" for i, n in ((1, f"café\n{k}"), (2, long))
    )


def test_carriage_returns_alone_end_records(tiny_splits, tmp_path):
    path = tmp_path / "m.csv"
    path.write_bytes(b'id,note\r1,"two\rlines"\r2,plain\r')
    assert _rows(read_csv(tiny_splits, str(path), multi_line=True)) == [(1, "two\rlines"), (2, "plain")]


def test_bad_records(tiny_splits, tmp_path):
    path = tmp_path / "b.csv"
    path.write_text('id,note\n1,"a\nb"\n' + "2,c\n" * 300 + '3,"never\n' + "4,d\n" * 300)
    with pytest.raises(DataLoadError, match="never closed"):
        load_table(tiny_splits, str(path))
    path.write_text('id,note\n1,"a\nb"\n' + "2,c\n" * 300 + "3,d,e\n")
    with pytest.raises(DataLoadError, match="more cells"):
        load_table(tiny_splits, str(path))
