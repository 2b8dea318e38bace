"""Layouts of dropped files by their first lines."""

import io
import json
import os

import pytest

from chainyard.sources import heads
from chainyard.sources.files import read_batch

RECORD = {"id": 1, "name": "a\u2028b\u0085c", "deep": {"x": [1, {"y": None}]}}
LINE = json.dumps(RECORD, ensure_ascii=False)


@pytest.mark.parametrize("text,layout", [
    (LINE + "\n" + LINE, "lines"), (LINE, "lines"), ("", "lines"), ("\n \n", "lines"),
    ("\ufeff" + LINE + "\n" + LINE + "\n", "lines"), ("junk\n" + LINE + "\n" + LINE, "lines"),
    ('{"id": 1, "name": "cut\n' + LINE, "lines"), ('{"id": 1, "na\n' + LINE, "lines"),
    ('{"id": 1,\n' + LINE + "\n", "lines"), ('{"id": 1}}\n' + LINE, "lines"), ("[1, 2]\n[3]\n", "lines"),
    ("\r\n" + LINE + "\r\n" + LINE, "lines"), ("]\n" + LINE, "lines"), ('"text\n' + LINE, "lines"),
    (json.dumps(RECORD, indent=1), "multiline"), (json.dumps([RECORD, RECORD], indent=2), "multiline"),
    ("[\n" + LINE + ",\n" + LINE + "\n]", "multiline"), ("[" + LINE + ",\n" + LINE + "]", "multiline"),
    ('{"a":\n{"b": 1}}', "multiline"), ('{"a": [\n{"b": 1}]}', "multiline"), ("{\n\n}", "multiline"),
    ("[" + LINE + "\n," + LINE + "]", "multiline")])
@pytest.mark.parametrize("chunk", [1, 7, 1 << 16])
def test_json_layouts(monkeypatch, text, layout, chunk):
    monkeypatch.setattr(heads, "CHUNK", chunk)
    assert heads.judge("json", io.BytesIO(text.encode())) == (layout, None)


def test_lines_too_long_to_parse(monkeypatch):
    monkeypatch.setattr(heads, "LONG_LINE", 500)
    monkeypatch.setattr(heads, "CHUNK", 64)
    long = json.dumps({"id": 1, "text": "x" * 3000})
    for text, layout in ((long + "\n" + LINE, "lines"), ("[" + long + ",\n" + LINE + "]", "multiline"),
                         ("[" + long + "]\n[" + LINE + "]", "lines"), ("z" * 3000 + "\n" + LINE, "lines"),
                         ('{"a": ' + long + ",\n" + '"b": 1}', "multiline"),
                         (long[:-1] + "\n" + LINE, "lines")):
        assert heads.judge("json", io.BytesIO(text.encode()))[0] == layout, text[:20]


def test_headers():
    wide = [f"c{i}" for i in range(30_000)]
    for text, header in (("a, b,c\r\n1,2,3", ["a", "b", "c"]), ("\ufeffx\n", ["x"]), ("", []),
                         ('"a,b",c\n', ["a,b", "c"]), (",".join(wide) + "\n1", wide)):
        assert heads.judge("csv", io.BytesIO(text.encode())) == (None, header)


def test_every_sound_record_lands(spark, localdir):
    files = {"a.json": LINE + "\n" + LINE + "\n", "b.json": "junk\n" + LINE + "\n" * 3 + LINE,
             "c.json": json.dumps({**RECORD, "note": "x" * 100_000}) + "\n" + LINE,
             "d.json": json.dumps([RECORD] * 3, indent=1), "e.json": '{"id": 1, "na\n' + LINE}
    for name, text in files.items():
        with open(os.path.join(localdir, name), "w", newline="") as f:
            f.write(text)
    schema = spark.createDataFrame([], "id int, name string").schema
    b = read_batch(spark, localdir, schema, corrupt_col="_bad")
    got = sorted((os.path.basename(r._source_key), r.id, r.name) for r in b.data.collect())
    assert got == sorted((n, 1, RECORD["name"]) for n in
                         [f"{c}.json" for c in "aabbccddde"])
    assert sorted(os.path.basename(r._source_key) for r in b.corrupt.collect()) == ["b.json", "e.json"]
    assert not b.rejected


def test_files_that_only_spark_opens(spark, localdir, monkeypatch):
    with open(os.path.join(localdir, "a.json"), "w") as f:
        f.write(LINE + "\n" + LINE)
    path = "file:" + os.path.join(localdir, "a.json")
    monkeypatch.setattr(heads, "opened", None)  # whatever opens files fails in the task
    assert heads.file_layouts(spark, [(path, "json")])[path][0] == "lines"
    assert heads.file_layouts(spark, []) == {}
