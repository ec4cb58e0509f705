"""The listing and the reader that keep every file and read only the lines asked for."""

import io
import os
import random

import pytest

from termloom.functions import content
from termloom.sources import walk
from pyspark.sql import functions as F


@pytest.fixture
def tree(tmp_path):
    names = {
        "a.txt": b"one\ntwo\r\nthree\rfour",
        "empty.txt": b"",
        ".hidden": b"dot\n",
        "_under.txt": b"under",
        "sub/b%41+c d.txt": b"odd name\n\n",
        "sub/deep/er/\xc3\xa9\xe4\xb8\xad.c".encode().decode("unicode_escape").encode("latin1").decode(): "é".encode(),
        "sub/.git/config.tar.gz": b"x\xffy",
        "sub/#?&=.txt": b"signs",
    }
    for name, data in names.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    (tmp_path / "nothing").mkdir()
    return tmp_path, names


@pytest.mark.parametrize("prefix", ["", "file:", "file://"])
def test_every_file_is_listed_and_read(spark, tree, prefix):
    root, names = tree
    rows = walk.scan_all(spark, [f"{prefix}{root}"]).collect()
    found = {r.path.split(f"{root}/")[1]: r for r in rows}
    assert set(found) == set(names) and len(rows) == len(names)
    for name, data in names.items():
        text = data.decode("utf-8", "replace").replace("\r\n", "\n").replace("\r", "\n")
        assert found[name].contents == (text if not text or text.endswith("\n") else text + "\n")
        assert found[name].sizeKb == len(data)
        assert found[name].lastModifiedTime.endswith("Z") and len(found[name].lastModifiedTimeLucene) == 12


def test_roots_extensions_and_numbers(spark, tree):
    root, names = tree
    one = walk.scan_all(spark, [f"{root}/.hidden", f"{root}/sub/deep", f"{root}/absent"]).collect()
    assert sorted(os.path.basename(r.path) for r in one) == [".hidden", next(os.path.basename(n) for n in names if "deep" in n)]
    txt = walk.scan_all(spark, [str(root)], extensions=[".txt"], first_id=7).orderBy("path").collect()
    expected = sorted(n for n in names if os.path.basename(n).partition(".")[1:] == (".", "txt"))
    assert [r.path.removeprefix(f"{root}/") for r in txt] == expected
    assert [r.doc_id for r in txt] == list(range(7, 7 + len(expected)))
    assert walk.scan_all(spark, [f"{root}/nothing"]).collect() == []


def test_unreadable_files_are_left_out(spark, tree):
    root, names = tree
    listing = walk.materialize(walk.walk(spark, [str(root)]), "listing")
    (root / "a.txt").unlink()
    rows = walk.read_files(listing).collect()
    assert {r.path.removeprefix(f"{root}/") for r in rows} == set(names) - {"a.txt"}


class Counted(io.BytesIO):
    def __init__(self, data):
        super().__init__(data)
        self.bytes_read = 0

    def read(self, *n):
        out = super().read(*n)
        self.bytes_read += len(out)
        return out


def plain(data, top, bottom):
    lines = data.replace(b"\r\n", b"\n").replace(b"\r", b"\n").split(b"\n")
    lines = lines[:-1] if lines[-1] == b"" else lines
    return lines[:top], lines[max(top, 0) :][::-1][:bottom]


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1 << 16])
def test_lines_from_both_ends(block):
    rnd = random.Random(block)
    for _ in range(300):
        data = b"".join(rnd.choice([b"\n", b"\r", b"\r\n", b"a", b"bc", b""]) for _ in range(rnd.randint(0, 14)))
        top, bottom = rnd.randint(0, 4), rnd.randint(0, 4)
        head = walk.head_lines(io.BytesIO(data), len(data), top, block) if top else b""
        tail = walk.tail_lines(io.BytesIO(data), len(head), len(data), bottom, block)
        first, last = plain(data, top, bottom)
        assert plain(head, 99, 0)[0] == first and plain(tail, 0, 99)[1] == last, (data, top, bottom)


def test_only_the_ends_of_a_large_file_are_read(spark, tmp_path):
    data = b"".join(b"line %d\r\n" % k for k in range(900_000))
    source = Counted(data)
    head = walk.head_lines(source, len(data), 3)
    tail = walk.tail_lines(source, len(head), len(data), 2)
    assert head == b"line 0\r\nline 1\r\nline 2\r\n" and tail == b"line 899998\r\nline 899999\r\n"
    assert source.bytes_read <= 2 * walk.BLOCK < len(data) / 50
    (tmp_path / "big.txt").write_bytes(data)
    for top, bottom in ((3, 2), (5, 0), (0, 4), (-1, 2), (2, -1), (0, 0)):
        row = walk.scan_all(spark, [str(tmp_path)], top=top, bottom=bottom).select("contents")
        text = spark.createDataFrame([(data.decode(),)], "t string")
        assert row.first()[0] == text.select(content.select_content(F.col("t"), top, bottom)).first()[0]


def test_files_written_by_tasks(spark, tmp_path):
    rows = spark.createDataFrame([(f"/x/{k % 3}/{k}.txt", "t" * k) for k in range(20)] + [("/x/null", None)], "path string, text string")
    assert walk.write_files(rows, f"file:{tmp_path}/out") == 21
    found = walk.scan_all(spark, [f"{tmp_path}/out"]).collect()
    assert sorted(r.sizeKb for r in found) == sorted([float(k) for k in range(20)] + [0.0])
