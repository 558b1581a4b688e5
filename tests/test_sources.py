import hashlib
import json
from contextlib import contextmanager
from datetime import datetime

import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources import manifest, read_csv, read_json, read_source, require_columns
from millrace.sources.database import Split, jdbc_options, read_query
from millrace.sources.pages import read_pages, unwrap_pages
from millrace.sources.schemas import RAW_TABLES, spark_type, struct_type

AT, LATER = datetime(2024, 1, 1), datetime(2024, 1, 2)


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_csv_is_all_text(spark, tmp_path):
    df = read_csv(spark, write(tmp_path, "t.csv", 'id,name\n1,Alice\n2,"Bo ""B"", Jr"\n3,\n'))
    assert {f.dataType for f in df.schema.fields} == {T.StringType()}
    assert [tuple(r) for r in df.collect()] == [("1", "Alice"), ("2", 'Bo "B", Jr'), ("3", None)]


def test_csv_marks_short_and_long_rows(spark, tmp_path):
    path = write(tmp_path, "t.csv", "a,b\n1,2\n3\n4,5,6\n")
    df = read_csv(spark, path, malformed="_line")
    assert [tuple(r) for r in df.collect()] == [
        ("1", "2", None), ("3", None, "3"), ("4", "5", "4,5,6"),
    ]


def test_csv_line_breaks_inside_quotes(spark, tmp_path):
    path = write(tmp_path, "t.csv", 'a,b\n1,"x\ny"\n')
    assert [tuple(r) for r in read_csv(spark, path, multiline=True).collect()] == [("1", "x\ny")]


def test_json_arrays_objects_and_lines(spark, tmp_path):
    array = write(tmp_path, "a.json", json.dumps([{"a": 1}, {"a": 2, "b": "x"}], indent=1))
    single = write(tmp_path, "b.json", json.dumps({"a": 5}))
    lines = write(tmp_path, "c.json", '{"a": 1}\n{"a": 2}\n')
    assert sorted((r.a, r.b) for r in read_json(spark, array).collect()) == [(1, None), (2, "x")]
    assert [r.a for r in read_source(spark, single).collect()] == [5]
    assert read_json(spark, lines, lines=True).count() == 2


def test_format_by_suffix(spark, tmp_path):
    path = str(tmp_path / "x.PARQUET")
    spark.range(3).write.parquet(path)
    assert read_source(spark, path).count() == 3
    with pytest.raises(ValueError, match="Unsupported file format: .xlsx"):
        read_source(spark, "x.xlsx")


def test_contract(spark, tmp_path):
    ok = "id,user_id,order_date,status\n1,1,2018-01-01,placed\n2,3,2018-01-02,completed\n"
    assert require_columns(read_csv(spark, write(tmp_path, "o.csv", ok)), "orders").count() == 2
    extra = "id,user_id,order_date,status,extra_col\n1,1,2018-01-01,placed,foo\n"
    df = require_columns(read_csv(spark, write(tmp_path, "e.csv", extra)), "orders")
    assert "extra_col" in df.columns
    with pytest.raises(ValueError, match="missing columns"):
        require_columns(read_csv(spark, write(tmp_path, "m.csv", "id,user_id\n1,1\n")), "orders")
    with pytest.raises(ValueError, match="No data rows"):
        header = write(tmp_path, "h.csv", "id,user_id,order_date,status\n")
        require_columns(read_csv(spark, header), "orders")
    assert require_columns(read_csv(spark, write(tmp_path, "u.csv", "a,b\n1,2\n")), "other").count() == 1


def test_declared_types():
    assert spark_type("integer") == T.LongType()
    assert spark_type("GEOMETRY") == T.StringType()
    schema = struct_type(RAW_TABLES["orders"])
    assert schema.names == ["id", "user_id", "order_date", "status", "_loaded_at"]
    assert schema["order_date"].dataType == T.DateType()


def test_file_checksums_and_changes(spark, tmp_path):
    a, b = write(tmp_path, "a.csv", "hello"), write(tmp_path, "b.csv", "world!")
    first = {r.path.rsplit("/", 1)[1]: r for r in manifest.file_checksums(spark, [a, b]).collect()}
    assert first["a.csv"].checksum == hashlib.sha256(b"hello").hexdigest()[:16]
    assert (first["a.csv"].length, first["b.csv"].length) == (5, 6)
    seen = spark.createDataFrame(list(first.values()))
    write(tmp_path, "b.csv", "world?")
    changed = manifest.changed_files(manifest.file_checksums(spark, [a, b]), seen)
    assert [r.path.rsplit("/", 1)[1] for r in changed.collect()] == ["b.csv"]


def _checksum(content: bytes) -> str:
    """The rule over again, over the whole content."""
    lines = content.split(b"\n")
    lines = lines[:-1] if lines[-1] == b"" else lines
    total = sum(int(hashlib.sha256(x).hexdigest()[:16], 16) for x in lines)
    orders = []
    for prime, base in ((2**31 - 1, 16807), (2**31 - 19, 48271)):
        c = [xxhash.xxh64_intdigest(x, 42) for x in lines]
        c = [(v - 2**64 if v >= 2**63 else v) % prime for v in c]
        orders.append(sum(v * (pow(base, i, prime) - 1) for i, v in enumerate(c)) % prime)
    return f"{(total + orders[0] * 2**31 + orders[1]) % 2**64:016x}"


@contextmanager
def split_bytes(spark, n):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def _sums(spark, paths):
    rows = manifest.file_checksums(spark, paths).collect()
    return {r.path.rsplit("/", 1)[1]: r.checksum for r in rows}


@pytest.mark.parametrize("size", [64, 100, 1000, 10**9])
def test_checksums_follow_one_rule(spark, tmp_path, size):
    texts = {
        "many.txt": "\n".join(f"line {i}" for i in range(300)),
        "ended.txt": "".join(f"line {i}\n" for i in range(300)),
        "blank.txt": "\n\na\n\n\r\nb\r",
        "long.txt": "x" * 500 + "\n" + "y" * 500,
        "same.txt": "again\n" * 200,
    }
    paths = [write(tmp_path, name, text) for name, text in texts.items()]
    with split_bytes(spark, size):
        assert _sums(spark, paths) == {n: _checksum(t.encode()) for n, t in texts.items()}


def test_checksums_see_order_and_line_ends(spark, tmp_path):
    lines = [f"row {i}" for i in range(200)]
    swapped = lines[:]
    swapped[3], swapped[150] = swapped[150], swapped[3]
    texts = ["\n".join(x) for x in (lines, swapped, lines[::-1], lines[1:] + lines[:1])]
    texts += [texts[0].replace("\n", "\r"), texts[0].replace("row 7\n", "row 7\r")]
    paths = [write(tmp_path, f"{i}.txt", t) for i, t in enumerate(texts)]
    with split_bytes(spark, 256):
        assert len(set(_sums(spark, paths).values())) == len(texts)


def test_parquet_with_bytes_of_line_ends_has_changed(spark, tmp_path):
    rows = {}
    for name, number in (("ten", 10), ("thirteen", 13)):
        path = str(tmp_path / f"{name}.parquet")
        spark.createDataFrame([(number, number)] * 5, "a int, b int").coalesce(1).write.option(
            "compression", "none"
        ).parquet(path)
        rows[name] = path
    first = manifest.extract_source(spark, "t", rows["ten"], str(tmp_path / "land"), AT)
    again = manifest.extract_source(spark, "t", rows["ten"], str(tmp_path / "land"), AT, first)
    other = manifest.extract_source(spark, "t", rows["thirteen"], str(tmp_path / "land"), AT, first)
    assert (first.skipped, again.skipped, other.skipped) == (False, True, False)
    assert {r.a for r in manifest.landed(spark, other).collect()} == {13}


def test_csv_columns_go_by_name(spark, tmp_path):
    folder = tmp_path / "people.csv"
    folder.mkdir()
    write(folder, "a.csv", "id,first,last\n1,A,B\n")
    write(folder, "b.csv", "last,id,first\nD,2,C\n")
    write(folder, "c.csv", "id,last\n3,E\n")
    rows = read_source(spark, str(folder)).select("id", "first", "last").collect()
    assert sorted(map(tuple, rows)) == [("1", "A", "B"), ("2", "C", "D"), ("3", None, "E")]
    marked = read_csv(spark, str(folder), malformed="_line")
    assert marked.columns[-1] == "_line" and marked.count() == 3


def test_lines_are_no_document(spark, tmp_path):
    lines = write(tmp_path, "l.json", '{"a": 1}\n{"a": 2}\n')
    with pytest.raises(ValueError, match="one object per line"):
        read_source(spark, lines)
    assert read_source(spark, lines, json_layout="lines").count() == 2
    spread = write(tmp_path, "s.json", '[\n{"a": 1},\n{"a": 2}\n]\n')
    assert read_source(spark, spread).count() == 2


def test_extract_all_and_again(spark, tmp_path):
    rows = "id,user_id,order_date,status\n1,1,2018-01-01,placed\n"
    sources = {
        "orders": write(tmp_path, "orders.csv", rows),
        "customers": write(tmp_path, "customers.csv", "id,first_name\n1,A\n"),
        "events": str(tmp_path / "absent.csv"),
        "sheet": write(tmp_path, "sheet.xlsx", "x"),
    }
    landing = str(tmp_path / "landing")
    found = manifest.extract_all(spark, sources, landing, AT)
    by_name = {r.source_name: r for r in found.collect()}
    good = by_name["orders"]
    assert (good.success, good.row_count, good.skipped) == (True, 1, False)
    assert good.byte_count == len(rows)
    assert good.checksum == _checksum(rows.encode())
    assert manifest.landed(spark, good).count() == 1
    assert "missing columns" in by_name["customers"].error
    assert "PATH_NOT_FOUND" in by_name["events"].error
    assert "Unsupported file format" in by_name["sheet"].error
    summary = manifest.extraction_summary(found).first()
    assert (summary.succeeded, summary.failed, summary.total_rows) == (1, 3, 1)

    again = manifest.extract_source(spark, "orders", sources["orders"], landing, LATER, good)
    assert (again.success, again.skipped, again.row_count) == (True, True, 1)
    write(tmp_path, "orders.csv", rows + "2,2,2018-01-02,placed\n")
    changed = manifest.extract_source(spark, "orders", sources["orders"], landing, LATER, good)
    assert (changed.skipped, changed.row_count) == (False, 2)


def test_page_shapes(spark, tmp_path):
    bodies = [
        [{"id": 1}, {"id": 2}],
        {"data": [{"id": 3}]},
        {"total": 9, "results": [{"id": 4}]},
        {"data": "none", "items": [{"id": 5}]},
        {"records": [{"id": 6}]},
        {"id": 7},
        [],
        "text",
    ]
    for i, body in enumerate(bodies):
        (tmp_path / f"page_{i}.json").write_text(json.dumps(body))
    (tmp_path / "page_8.json").write_text("{broken")
    pages = read_pages(spark, str(tmp_path))
    assert sorted(r.page_no for r in pages.collect()) == list(range(9))
    ids = unwrap_pages(pages).select(F.try_variant_get("record", "$.id", "int").alias("id"))
    assert sorted(r.id for r in ids.collect()) == [1, 2, 3, 4, 5, 6, 7]


@pytest.mark.parametrize("endpoints", [None, ["a", "b"]])
def test_pages_end_at_the_first_short_one(spark, endpoints):
    def page(*ids):
        return json.dumps({"data": [{"id": i} for i in ids]})

    pages = spark.createDataFrame(
        [("a", 0, page(1, 2)), ("a", 1, page(3)), ("a", 2, page(4, 5)),
         ("b", 0, page(6, 7)), ("b", 1, page()), ("b", 2, page(8, 9))],
        "endpoint string, page_no int, page string",
    )
    got = unwrap_pages(pages, "endpoint", "page_no", page_size=2, endpoints=endpoints)
    ids = got.select("endpoint", F.try_variant_get("record", "$.id", "int").alias("id"))
    assert sorted(tuple(r) for r in ids.collect()) == [("a", 1), ("a", 2), ("a", 3), ("b", 6), ("b", 7)]


def test_jdbc_options():
    base = {"url": "jdbc:x", "driver": "d"}
    assert jdbc_options(base, "select 1") == {**base, "fetchsize": "10000", "query": "select 1"}
    split = jdbc_options(base, "select 1", 50, Split("id", "0", "9", 4))
    assert split["dbtable"] == "(select 1) q" and "query" not in split
    assert (split["partitionColumn"], split["numPartitions"], split["fetchsize"]) == ("id", "4", "50")


def test_unknown_query_is_refused(spark):
    with pytest.raises(ValueError, match="No query configured"):
        read_query(spark, {}, {}, "orders")
