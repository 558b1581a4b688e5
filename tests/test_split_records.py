"""Records across lines and splits, against readers that take a whole file."""

import csv
import io
import json
import random

import pytest
from test_sources import split_bytes, write

from millrace.operators.dedup import deduplicate
from millrace.sources import read_csv, read_json, read_source
from millrace.sources.files import _csv_files
from millrace.sources.records import csv_records, json_elements

TRICKY = [
    "plain", "", "a,b", 'say "hi"', "two\nlines", "three\n\nlines\n", '"', '""', ',"', '",\n"', "\n", ' " ',
    "ends with quote\"", "x" * 150, "y\n" * 40, "é世界\n", "tab\t", 'a""b', "it's",
]


def _file(tmp_path, name, rows, **kind):
    text = io.StringIO(newline="")
    csv.writer(text, lineterminator="\n", **kind).writerows(rows)
    path = tmp_path / name
    path.write_bytes(text.getvalue().encode())
    return str(path)


def _rows(seed, n=120):
    draw = random.Random(seed)
    return [[str(i), draw.choice(TRICKY), draw.choice(TRICKY), "end"] for i in range(n)]


@pytest.mark.parametrize(("seed", "size"), [(1, 64), (2, 64), (2, 333), (1, 10**9)])
def test_quoted_line_breaks_are_read_by_many_tasks(spark, tmp_path, size, seed):
    rows = _rows(seed)
    kind = {"quoting": csv.QUOTE_ALL} if seed == 2 else {}
    path = _file(tmp_path, "t.csv", [["id", "a", "b", "c"], *rows], **kind)
    whole = read_csv(spark, path, multiline=True)
    with split_bytes(spark, size):
        df = read_csv(spark, path)
        tasks = csv_records(spark, path).select("start").distinct().count()
        got = sorted(map(tuple, df.collect()), key=lambda r: int(r[0]))
    assert df.columns == whole.columns
    assert got == sorted(map(tuple, whole.collect()), key=lambda r: int(r[0]))
    assert [r[0] for r in got] == [r[0] for r in rows]
    assert [r[1] or "" for r in got] == [r[1] for r in rows]
    if size == 64:
        assert tasks > 10


def test_a_quotation_mark_within_a_field_opens_nothing(spark, tmp_path):
    path = write(tmp_path, "t.csv", 'id,size\n1,5" disk\n2,"6"" disk\nround"\n3,7" disk\n')
    rows = sorted(map(tuple, read_csv(spark, path).collect()))
    assert rows == [("1", '5" disk'), ("2", '6" disk\nround'), ("3", '7" disk')]


def test_files_with_and_without_breaks_in_one_source(spark, tmp_path):
    folder = tmp_path / "people.csv"
    folder.mkdir()
    write(folder, "a.csv", 'id,name\n1,A\n')
    write(folder, "b.csv", 'name,id\n"B\nB",2\r\n')
    write(folder, "c.csv", '"id","first\nname"\n3,"C\nC"\n\n4,D,E\n')
    write(folder, "d.csv", "id,name\n5,F\n")
    df = read_csv(spark, str(folder), malformed="_line", position="_place")
    assert df.columns[-2:] == ["_line", "_place"]
    got = sorted(map(tuple, df.select("id", "name", "first\nname", "_line").collect()))
    assert got == [
        ("1", "A", None, None), ("2", "B\nB", None, None), ("3", None, "C\nC", None),
        ("4", None, "D", "4,D,E"), ("5", "F", None, None),
    ]
    looked = {r.path[-5]: (r.header, r.broken) for r in _csv_files(spark, str(folder)).collect()}
    assert looked["a"] == ("id,name", False) and looked["c"] == ('"id","first', True)


def test_files_with_other_line_ends(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes(b'a,b\r1,"x"\r2,y\r')
    assert [r.header for r in _csv_files(spark, str(path)).collect()] == ["a,b"]
    assert sorted(map(tuple, read_csv(spark, str(path)).collect())) == [("1", "x"), ("2", "y")]
    path.write_bytes(b'a,b\r\n1,"x\r\ny"\r\n2,z\r\n')
    assert sorted(map(tuple, read_csv(spark, str(path)).collect())) == [("1", "x\ny"), ("2", "z")]


def test_repeated_and_empty_column_names(spark, tmp_path):
    path = write(tmp_path, "t.csv", 'a,,A\n"1\n",2,3\n')
    assert read_csv(spark, path).columns == read_csv(spark, path, multiline=True).columns


@pytest.mark.parametrize(("size", "quoted"), [(200, False), (200, True), (10**9, True)])
def test_first_and_last_mean_the_order_of_the_input(spark, tmp_path, size, quoted):
    draw = random.Random(4)
    folder = tmp_path / "in.csv"
    folder.mkdir()
    rows = [[str(draw.randrange(20)), f"v{i}" + ("\nx" if quoted and i % 3 else "")] for i in range(150)]
    for part in range(3):
        _file(folder, f"part-{part}.csv", [["id", "v"], *rows[part * 50 : part * 50 + 50]])
    first, last = {}, {}
    for key, value in rows:
        first.setdefault(key, value)
        last[key] = value
    with split_bytes(spark, size):
        df = read_csv(spark, str(folder), position="_place")
        for keep, want in (("first", first), ("last", last)):
            got = deduplicate(df, ["id"], ["_place"], keep).collect()
            assert {r.id: r.v for r in got} == want


OBJECTS = [
    {"a": 1}, {"a": '} {"', "b": {"c": [{"d": "]"}, {}]}}, {"a": "\\", "e": '\\"}'}, {}, {"a": "x" * 300},
    {"b": {"c": {"d": {"e": "}}}"}}}}, {"a": "[{,}]", "f": None}, {"g": [[], [{"h": 1}]]}, {"a": 'quote " end'},
]


@pytest.mark.parametrize(("size", "indent"), [(40, None), (40, 1), (10**9, 1)])
def test_objects_of_an_array_are_cut_by_many_tasks(spark, tmp_path, size, indent):
    draw = random.Random(size)
    docs = [{"n": i, **draw.choice(OBJECTS)} for i in range(80)]
    path = write(tmp_path, "t.json", json.dumps(docs, indent=indent) + "\n")
    single = write(tmp_path, "s.json", json.dumps(OBJECTS[1], indent=indent))
    with split_bytes(spark, size):
        got = json_elements(spark, [path, single]).collect()
    found = {name: [json.loads(r.value) for r in got if r.path.endswith(name)] for name in ("t.json", "s.json")}
    assert sorted(found["t.json"], key=lambda d: d["n"]) == docs
    assert found["s.json"] == [OBJECTS[1]]
    assert all(r.apart for r in got)


def test_a_large_document_equals_the_document_reader(spark, tmp_path):
    docs = [{"id": i, "name": f'n "{i}" }}', "tags": [{"t": i}]} for i in range(300)]
    path = write(tmp_path, "t.json", json.dumps(docs, indent=2))
    whole = read_json(spark, path)
    with split_bytes(spark, 1000):
        parts = read_source(spark, path)
        assert parts.schema == whole.schema
        assert sorted(parts.collect()) == sorted(whole.collect())
        lines = write(tmp_path, "l.json", "".join(json.dumps(d) + "\n" for d in docs))
        with pytest.raises(ValueError, match="one object per line"):
            read_json(spark, lines)
