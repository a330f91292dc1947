"""Line breaks in quoted CSV fields, in one split and in many, against the csv
module reading the file from its top."""

import csv
import random

import pytest

from salesmart.operators.dedup import dedup
from salesmart.sources import read_source, read_sources
from salesmart.sources.readers import POSITION
from salesmart.sources.specs import SourceSpec

SPEC = SourceSpec("notes", "notes.csv", ("note_id",), {"note_id": "string", "note": "string"})
PIECES = ["plain", "two\nlines", "a \"quoted\" word", "\n\nfour\n\n", "comma, and\r\nreturn", "\"", "\"\n\"", "é\nü", " x "]


@pytest.fixture
def splits(spark):
    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield cut
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def write_notes(path, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as fh:
        out = csv.writer(fh, lineterminator=end)
        out.writerow(["note", "extra", "note_id"])
        out.writerows(rows)


@pytest.mark.parametrize("size", [1 << 20, 2048, 257])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_are_those_of_the_whole_file(spark, tmp_path, splits, size, end):
    draw = random.Random(size)
    rows = [["".join(draw.choices(PIECES, k=draw.randint(1, 3))), draw.choice(PIECES), f"n{i}"] for i in range(400)]
    rows[200][0] = "one long field\n" * 300  # over many splits
    write_notes(tmp_path / "notes.csv", rows, end)
    splits(size)
    df = read_source(spark, SPEC, str(tmp_path / "notes.csv"), positions=True, line_breaks=True)
    assert df.columns == ["note_id", "note", POSITION, "extra"]
    with open(tmp_path / "notes.csv", newline="", encoding="utf-8") as fh:
        expected = [(r[2], r[0], r[1]) for r in list(csv.reader(fh))[1:]]
    assert [(r.note_id, r.note, r.extra) for r in df.orderBy(POSITION).collect()] == expected
    if size < 4096:
        blocks = {r[0] for r in df.select(f"{POSITION}.block").distinct().collect()}
        assert len(blocks) > 5


def test_the_first_of_repeated_records_stays(spark, tmp_path, splits):
    write_notes(tmp_path / "notes.csv", [[f"{9 - i // 50}\nth", "", f"n{i % 50}"] for i in range(300)])
    splits(400)
    df = read_sources(spark, str(tmp_path), specs={"notes": SPEC}, line_breaks=["notes"])["notes"]
    got = dedup(df, ["note_id"])
    assert {r.note for r in got.collect()} == {"9\nth"} and got.count() == 50


def test_several_files_blank_lines_and_null_tokens(spark, tmp_path):
    folder = tmp_path / "notes.csv"
    folder.mkdir()
    (folder / "a.csv").write_text('note,note_id\n"x\ny",1\n\n   \nNA,2\n')
    (folder / "b.csv").write_text('\nnote,note_id\n"z\n",3')
    df = read_source(spark, SPEC, str(folder), line_breaks=True)
    assert sorted((r.note_id, r.note) for r in df.collect()) == [("1", "x\ny"), ("2", None), ("3", "z\n")]
    (folder / "c.csv").write_text("note_id,note\n4,v\n")
    with pytest.raises(ValueError, match="header"):
        read_source(spark, SPEC, str(folder), line_breaks=True)


def test_broken_files_fail(spark, tmp_path):
    def read(text, **kw):
        (tmp_path / "notes.csv").write_text(text)
        return read_source(spark, SPEC, str(tmp_path / "notes.csv"), **{"line_breaks": True, **kw})
    with pytest.raises(ValueError, match="not closed"):
        read('note,note_id\n"x\ny,1\n')
    with pytest.raises(ValueError, match="empty"):
        read("")
    with pytest.raises(ValueError, match="missing columns"):
        read("note,other\nx,1\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read('note,note_id\n"x\ny",1,2\n').collect()
    with pytest.raises(Exception, match="(?i)malformed"):
        read('note,note_id\n"x\ny",1\n', line_breaks=False).collect()
    assert read("note,note_id\n").isEmpty()
    with pytest.raises(FileNotFoundError):
        read_source(spark, SPEC, str(tmp_path / "none.csv"), line_breaks=True)
    with pytest.raises(ValueError, match="no such source"):
        read_sources(spark, str(tmp_path), specs={"notes": SPEC}, line_breaks=["other"])
