import json
import re
from datetime import date
from decimal import Decimal

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql.types import DecimalType, StructType

from strata.functions.rescue import NESTED, with_rescue
from strata.sources import json_feed
from strata.sources.csv_feed import read_any_header, widest_row
from strata.sources.json_feed import parse_json_lines
from strata.streaming.ingest import FeedSpec, ingest

JSON_SCHEMA = (
    StructType()
    .add("id", "long")
    .add("day", "date")
    .add("tag", "string")
    .add("at", StructType().add("x", "integer"))
)


def parse(spark, *lines):
    df = spark.createDataFrame([(line, "file:/f.json") for line in lines], "value string, source_file string")
    rows = parse_json_lines(df, JSON_SCHEMA).collect()
    return [(r.id, r.day, r.tag, r.at, r._rescued_data and json.loads(r._rescued_data)) for r in rows]


PATH = {"_file_path": "file:/f.json"}


@pytest.mark.parametrize(
    "line, expected",
    [
        ('{"id":1,"day":"2024-01-02","tag":"t"}', (1, date(2024, 1, 2), "t", None, None)),
        ('{"id":1,"tag":null}', (1, None, None, None, None)),
        ('{"id":1}', (1, None, None, None, None)),
        ('{}', (None, None, None, None, None)),
        ('{"id":1,"more":{"q":[1,2]}}', (1, None, None, None, {"more": '{"q":[1,2]}', **PATH})),
        ('{"id":"one","day":"soon"}', (None, None, None, None, {"id": "one", "day": "soon", **PATH})),
        ('{"id":2.0}', (None, None, None, None, {"id": "2.0", **PATH})),
        ('{"ID":3}', (None, None, None, None, {"ID": "3", **PATH})),
        ('{"tag":007}', (None, None, None, None, {"_corrupt_record": '{"tag":007}', **PATH})),
        ('{"tag":1e3}', (None, None, "1e3", None, None)),
        ('{"tag":12.50}', (None, None, "12.50", None, None)),
        ('{"tag":true}', (None, None, "true", None, None)),
        (
            '{"id":1,"far":12345678901234567890.123456789,"e":1e3,"deep":[1.50,{"x":1E-9}]}',
            (1, None, None, None, {"far": "12345678901234567890.123456789", "e": "1e3", "deep": '[1.50,{"x":1E-9}]', **PATH}),
        ),
        ('{"far":12345678901234567890123456789012345678}', (None, None, None, None, {"far": "12345678901234567890123456789012345678", **PATH})),
        ('{"day":"2015-01-01 junk"}', (None, None, None, None, {"day": "2015-01-01 junk", **PATH})),
        ('{"day":"2015-01-01T10:11:12"}', (None, None, None, None, {"day": "2015-01-01T10:11:12", **PATH})),
        ('{"day":"2015-01"}', (None, None, None, None, {"day": "2015-01", **PATH})),
        ('{"day":"2015-1-2"}', (None, date(2015, 1, 2), None, None, None)),
        ('{"id":1,"id":2}', (None, None, None, None, {"_corrupt_record": '{"id":1,"id":2}', **PATH})),
        ('{"tag":"x","z":1,"z":2}', (None, None, None, None, {"_corrupt_record": '{"tag":"x","z":1,"z":2}', **PATH})),
        ('{"z":{"a":1,"a":2}}', (None, None, None, None, {"z": '{"a":1,"a":2}', **PATH})),
        ('{"at":{"x":4,"new":2}}', (None, None, None, None, {"at": '{"x":4,"new":2}', **PATH})),
        ('{"at":{"x":"y"}}', (None, None, None, None, {"at": '{"x":"y"}', **PATH})),
        ('{"at":{"x":3000000000}}', (None, None, None, None, {"at": '{"x":3000000000}', **PATH})),
        ('{"at":{"x":1.0}}', (None, None, None, None, {"at": '{"x":1.0}', **PATH})),
        ('{"at":"txt"}', (None, None, None, None, {"at": "txt", **PATH})),
        ('{"at":[1]}', (None, None, None, None, {"at": "[1]", **PATH})),
        ('[1]', (None, None, None, None, {"_corrupt_record": "[1]", **PATH})),
        ('{"tag":NaN}', (None, None, None, None, {"_corrupt_record": '{"tag":NaN}', **PATH})),
        ('{"tag":"\\ud800"}', (None, None, None, None, {"_corrupt_record": '{"tag":"\\ud800"}', **PATH})),
        ("[" * 5000, (None, None, None, None, {"_corrupt_record": "[" * 5000, **PATH})),
        ('{"id":1', (None, None, None, None, {"_corrupt_record": '{"id":1', **PATH})),
        ('{"id":1,"_file_path":"mine"}', (1, None, None, None, {"_file_path": "mine"})),
        ('{"id":1,"gone":null}', (1, None, None, None, None)),
    ],
)
def test_json_line(spark, line, expected):
    assert parse(spark, line) == [expected]


def test_json_nested_column(spark):
    [(_, _, _, at, rescued)] = parse(spark, '{"at":{"x":4}}')
    assert at.x == 4 and rescued is None


def test_json_decimals_are_exact(spark):
    schema = StructType().add("id", "integer").add("d", DecimalType(38, 21)).add("p", DecimalType(4, 2))
    lines = [
        '{"id":1,"d":0.123456789012345678901,"p":"9.5"}',
        '[{"id":2,"d":2},{"id":3,"p":100}]',
        '{"id":4,"p":"x"}',
        '{"id":5,"d":1',
    ]
    df = spark.createDataFrame([(line, "f") for line in lines], "value string, source_file string")
    rows = {r.id: (r.d, r.p, r._rescued_data) for r in parse_json_lines(df, schema).collect()}
    assert rows[1] == (Decimal("0.123456789012345678901"), Decimal("9.50"), None)
    assert rows[2] == (Decimal(2), None, None)
    assert rows[3][:2] == (None, None) and json.loads(rows[3][2])["p"] == "100"
    assert rows[4][:2] == (None, None) and json.loads(rows[4][2])["p"] == "x"
    assert json.loads(rows[None][2])["_corrupt_record"] == '{"id":5,"d":1'


def test_json_arrays_and_blank_lines(spark):
    rows = parse(spark, '[{"id":1},{"id":2}]', "", "   ", "[]", '[{"id":1}')
    assert sorted(r[0] or 0 for r in rows) == [0, 1, 2]
    assert rows[-1][4]["_corrupt_record"] == '[{"id":1}'


CSV_SCHEMA = StructType().add("id", "integer").add("name", "string").add("price", "double")


@pytest.fixture
def folder(tmp_path):
    def write(**files):
        paths = []
        for name, text in files.items():
            path = tmp_path / f"{name}.csv"
            path.write_text(text)
            paths.append(str(path))
        return paths

    return write


def csv_rows(spark, paths, reader=read_any_header):
    rows = reader(spark, paths, CSV_SCHEMA).collect()
    out = []
    for r in rows:
        rescued = json.loads(r._rescued_data) if r._rescued_data else {}
        rescued.pop("_file_path", None)
        out.append((r.id, r.name, r.price, rescued))
    return sorted(out, key=str)


def test_csv_by_name(spark, folder):
    paths = folder(
        plain='id,name,price\n007,"a, b",1.5\n8,,\n',
        moved="price,extra,id,name\n2,e1,9,n\n3,,10,m\n",
        short="id\n11\n",
        header_only="id,name,price\n",
        nothing="",
    )
    assert csv_rows(spark, paths) == sorted(
        [
            (7, "a, b", 1.5, {}),
            (8, None, None, {}),
            (9, "n", 2.0, {"extra": "e1"}),
            (10, "m", 3.0, {}),
            (11, None, None, {}),
        ],
        key=str,
    )


def test_csv_misfits_and_ragged_rows(spark, folder):
    paths = folder(f="id,name,price\nx,007,1e3\n1,a,2,surplus\n2,b\n")
    assert csv_rows(spark, paths) == sorted(
        [
            (None, "007", 1000.0, {"id": "x"}),
            (1, "a", 2.0, {"_corrupt_record": "1,a,2,surplus"}),
            (2, "b", None, {"_corrupt_record": "2,b"}),
        ],
        key=str,
    )


def test_csv_case_differs(spark, folder):
    with_case = spark.newSession()
    with_case.conf.set("spark.sql.caseSensitive", "true")
    paths = folder(f="ID,id,name\n1,2,n\n")
    assert csv_rows(with_case, paths) == [(2, "n", None, {"ID": "1"})]


def test_csv_with_many_columns(spark, folder):
    names = [f"c{i}" for i in range(600)]
    paths = folder(wide=",".join(names) + "\n" + ",".join(str(i) for i in range(600)) + "\n")
    schema = StructType()
    for name in names[:-1]:
        schema = schema.add(name, "integer")
    [row] = read_any_header(spark, paths, schema).collect()
    assert row.c598 == 598 and json.loads(row._rescued_data)["c599"] == "599"


def test_csv_odd_headers(spark, folder):
    """Empty, blank and repeated names, a blank first line, a name that looks like a helper's."""
    paths = folder(
        empty="id,,price\n1,x,1.5\n",
        blank=" ,id\ny,2\n",
        last="id,price,\n3,1,z\n",
        repeated="id,price,price\n4,1,2\n",
        gap="\n\nid,price\n5,1\n",
        helper="id,_c1,\n6,v,w\n",
        quoted='"id","na""me","a, b"\n7,q,r\n',
        bom="\ufeffid,name\n8,b\n",
    )
    found = {row[0]: row[1:] for row in csv_rows(spark, paths)}
    assert found == {
        1: (None, 1.5, {"_c1": "x"}),
        2: (None, None, {"_c0": "y"}),
        3: (None, 1.0, {"_c2": "z"}),
        4: (None, 1.0, {"price_2": "2"}),
        5: (None, 1.0, {}),
        6: (None, None, {"_c1": "v", "_c2": "w"}),
        7: (None, None, {'na"me': "q", "a, b": "r"}),
        8: ("b", None, {}),
    }


def test_csv_odd_file_names(spark, tmp_path):
    path = tmp_path / "a b{1}[x]*%20.csv"
    path.write_text("id,name,price\n1,a,1\n")
    [row] = read_any_header(spark, [str(path)], CSV_SCHEMA).collect()
    assert row.id == 1 and row.source_file.startswith("file:")


@pytest.mark.parametrize(
    "kind, fits, left",
    [
        ("double", ["1.5", "-0.1", "1e3", "0", "0.10", "9007199254740992", "123456789012345"], ["9007199254740993", "1e400", "x", "0.12345678901234567891", "1e-400"]),
        ("float", ["1.5", "16777216"], ["16777217", "0.1234567"]),
        ("decimal(4,2)", ["9.5", "99.99", "1.500", "1e1", " 2 "], ["12.3456", "100", "1e-3", "x"]),
        ("decimal(38,21)", ["0.123456789012345678901"], ["0.1234567890123456789012"]),
        ("integer", ["7", "007", "-1"], ["1.0", "3000000000", "1e2", ""]),
        ("date", ["2015-01-01", "2015-1-2"], ["2015-01-01 10:00", "2015", "2015-02-30"]),
        ("timestamp", ["2015-01-01", "2015-01-01 10:11:12.123456", "2015-01-01T10:11:12Z"], ["10:11", "2015-01-01 10:11:12.1234567", "soon"]),
        ("timestamp_ntz", ["2015-01-01 10:11:12"], ["2015-01-01 10:11:12+02:00", "2015-01-01T10:11:12Z"]),
        ("boolean", ["true", "False"], ["1", "yes", "t"]),
        ("string", ["anything"], []),
        ("array<int>", ["[1,2]"], ["[1, x]", "[1,2.5]", "1"]),
    ],
)
def test_values_that_fit_and_values_that_are_rescued(spark, kind, fits, left):
    schema = StructType.fromDDL(f"v {kind}")
    rows = [(v,) for v in fits + left]
    df = spark.createDataFrame(rows, "raw string").selectExpr("raw", "'f' AS source_file")
    out = with_rescue(df, schema, lambda name: "raw", "CAST(map() AS MAP<STRING,STRING>)", "NULL").collect()
    kept = [json.loads(r._rescued_data)["v"] if r._rescued_data else None for r in out]
    assert kept == [None] * len(fits) + left
    assert [r.v is None for r in out] == [False] * len(fits) + [True] * len(left)


def test_json_lines_that_are_not_utf8(spark, tmp_path):
    (tmp_path / "x.json").write_bytes(b'{"id":1,"tag":"\xff"}\n{"id":2}\n')
    lines = spark.read.text(str(tmp_path / "x.json")).selectExpr("value", "'f' AS source_file")
    assert sorted(r.id or 0 for r in parse_json_lines(lines, JSON_SCHEMA).collect())[-1] == 2


WIDE = "a BIGINT, b STRING, c STRUCT<x: BIGINT, y: DOUBLE>, d DECIMAL(10,2), e ARRAY<BIGINT>, f STRUCT<m: DECIMAL(38,18), r: FLOAT>"
PLAIN = [
    '{"a":1,"b":"x"}',
    ' { "a" : 12.50 ,\t"b":null,"z":1e3 }\r',
    '{"c":{"x":5}}',
    '{}',
    '{"b":":5","q":"x"}',
    '{"b":"null","a":-0}',
    '{"":3,"é":"𝒳"}',
    '{"b":true,"a":"7"}',
    '{"d":' + "9" * 5000 + "}",
    '{"b":{"k":1,"k":[-15,true]}}',
    '{"a":-12345678901234567890123,"b":1E400,"k": -0.0 ,"l":0.1,"m":[],"n":":7.5","o":null,"p":{"q":":1.5,"}}',
    '{"e":[1,2,3],"q":[]}',
    "{" + ",".join(f'"k{i}":"{i}"' for i in range(20_000)) + "}",
    '{"b":"' + "x" * 200_000 + '"}',
]
HARD = [
    '{"a":1,"a":2}', '{"c":{"x":5,"y":1.5}}', '{"q":{"x":1.50}}', '{"q":[-0]}', '{"q":[12345678901234567890]}', '{"c":{"x":5, "y":1.5}}', '{"b":"\\u00e9"}', '[{"a":1},{"a":2}]', '{"a":01}',
    '{"e":[1,2.0]}', '{"a":1}x', "nope", '{"c":{"x":' + "9" * 5000 + "}}", '{"c":{"y":1e1000000}}', '{"c":{"x":1,"x":1}}',
    '{"c":{"x":null}}', '{"c":"x"}', '{"b":{"k":[{"l":1}]}}', '{"f":{"r":0.5}}', "[" * 3000, "\ufeff{}", '{"a":+1}', '{"a":NaN}', "{'a':1}", '{"a":1,}',
]


def test_plain_lines_do_not_reach_the_decoder(spark):
    schema = StructType.fromDDL(WIDE)
    nested = {f.name: f.dataType for f in schema if isinstance(f.dataType, NESTED)}
    lines = spark.createDataFrame([(k, line, "f") for k, line in enumerate(PLAIN + HARD)], "k int, value string, source_file string")
    plain = {r.k: r.plain for r in json_feed.with_plain_fields(lines, nested).collect()}
    assert {k for k, fields in plain.items() if fields is not None} == set(range(len(PLAIN)))
    # What the patterns take apart is what the decoder would have given.
    for k, line in enumerate(PLAIN):
        (record,) = json_feed.records(line)
        assert plain[k] == {name: json_feed.text_of(v) for name, v in record if v is not None}
        assert all(json_feed.fits(nested[name], v) for name, v in record if name in nested)


FLAT = [
    '{"a":1,"b":"x"}', '{"b":"x, y}","a":-15}', '{"b":""}', '{"b":true}', '{"b":"null","a":"7"}', '{"d":12,"é \U0001d4b3":"z"}', '{"b":"' + "x" * 200_000 + '"}',
]
NOT_FLAT = [
    '{}', '{"a":1,"a":1}', '{"a":1,"q":2}', '{"a":1.5}', '{"a": 1}', '{"a":1,}', '{"a":1', '{"a":1}}', '{"a":1{"b":2}', '{"a":1"b":"x"}', '{"a":01}',
    '{"b":null}', '{"b":":5"}', '{"c":"x"}', '{"b":"\\u00e9"}', '\u0001"x"\u0001\u0001', '[{"a":1}]', '{"b":{"k":1}}', '{"b":"x"}\u0001',
]


def test_flat_lines_are_taken_apart_by_one_pattern(spark):
    """What is flat has the values that the decoder would have given, and nothing else is flat."""
    names = ["a", "b", "d", "é \U0001d4b3"]
    schema = StructType.fromDDL(f"a BIGINT, b STRING, c STRUCT<x: BIGINT>, d DECIMAL(10,2), `{names[3]}` STRING, `q\"` STRING")
    assert json_feed.flat_names(schema) == names
    lines = spark.createDataFrame([(k, line, f"{k}") for k, line in enumerate(FLAT + NOT_FLAT)], "k int, value string, source_file string")
    flat = {r.k: r.flat for r in json_feed.with_flat_values(lines, names).collect()}
    assert {k for k, values in flat.items() if values is not None} == set(range(len(FLAT)))
    for k, line in enumerate(FLAT):
        (record,) = json_feed.records(line)
        assert {n: v.strip('"') for n, v in zip(names, flat[k], strict=True) if v} == {n: json_feed.text_of(v) for n, v in record}
    rows = {int(r.source_file): r for r in parse_json_lines(lines, schema).collect() if r.source_file != "26"}
    assert (rows[0].a, rows[1].a, rows[2].b, rows[3].b, rows[4].a, rows[5].d) == (1, -15, "", "true", 7, 12)
    assert all(rows[k]._rescued_data is None for k in range(len(FLAT)))
    # A scalar that its column does not hold is rescued from a flat line as well.
    odd = spark.createDataFrame([('{"a":"soon","b":"x"}', "f")], "value string, source_file string")
    row = parse_json_lines(odd, schema).first()
    assert (row.a, row.b, json.loads(row._rescued_data)) == (None, "x", {"a": "soon", "_file_path": "f"})


@given(
    st.recursive(
        st.one_of(st.none(), st.booleans(), st.integers(), st.floats(allow_nan=False, allow_infinity=False), st.text(max_size=5)),
        lambda inner: st.one_of(st.lists(inner, max_size=3), st.dictionaries(st.text(max_size=3), inner, max_size=3)),
        max_leaves=6,
    ),
    st.booleans(),
)
def test_patterns_accept_json_only(value, compact):
    """What the pattern of plain records accepts, the decoder reads as one record."""
    line = json.dumps({"k": value}, ensure_ascii=False, separators=(",", ":") if compact else None)
    pattern = re.compile(json_feed.PLAIN_RECORD.replace(r"\z", r"\Z"))
    for odd in (line, line.replace(":", "::", 1), line[:-1], line + "}", line.replace("1", "01"), line.replace('"', "", 1)):
        if pattern.match(odd):
            assert len(json_feed.records(odd) or [1]) == 1 and (json_feed.records(odd) is not None or odd.count('"k"') > 1)


@pytest.mark.parametrize(
    ("kind", "value", "held"),
    [
        ("decimal(38,18)", "1234567890.12345678901234567890123", False),
        ("decimal(38,18)", "12345678901234567890.123456789012345678", True),
        ("decimal(38,18)", "1e-18", True),
        ("decimal(38,18)", "1e-19", False),
        ("decimal(38,18)", "0.000", True),
        ("decimal(38,18)", "0e9999999999", False),
        ("decimal(38,18)", "1e1000000", False),
        ("decimal(38,18)", "1" + "0" * 400, False),
        ("decimal(4,2)", "99.990", True),
        ("decimal(4,2)", "100", False),
        ("decimal(4,2)", "1e1", True),
        ("bigint", "9" * 5000, False),
        ("bigint", "9223372036854775807", True),
        ("bigint", "9223372036854775808", False),
        ("bigint", "1.0", False),
        ("float", "1e1000000", False),
        ("float", "1e-1000000", False),
        ("float", "123456e3", True),
        ("double", "1e1000000", False),
        ("double", "1e-400", False),
        ("double", "0.1", True),
        ("double", "0.1000000000000000055511151231257827", False),
        ("string", "9" * 5000, False),
    ],
)
def test_nested_numbers_are_held_exactly_or_rescued(spark, kind, value, held):
    line = '{"n":{"v":%s}}' % value
    schema = StructType.fromDDL(f"n STRUCT<v: {kind}>")
    row = json_feed.parse_json_lines(spark.createDataFrame([(line, "f")], "value string, source_file string"), schema).first()
    if held:
        assert row._rescued_data is None
        assert kind == "string" or Decimal(str(row.n.v)) == Decimal(value)
    else:
        assert row.n is None and json.loads(row._rescued_data)["n"] == line[5:-1]


def test_csv_rows_of_any_width(spark, tmp_path):
    path = tmp_path / "wide.csv"
    path.write_text("id,name\n1,x\n" + ",".join(["7"] * 30_000) + "\n2,y\n")
    rows = sorted(read_any_header(spark, [str(path)], StructType.fromDDL("id BIGINT, name STRING")).collect(), key=lambda r: r.id)
    assert [(r.id, r.name) for r in rows] == [(1, "x"), (2, "y"), (7, "7")]
    assert json.loads(rows[2]._rescued_data)["_corrupt_record"] == ",".join(["7"] * 30_000)
    assert widest_row(spark, [str(path)]) == 30_000


def test_a_row_beyond_the_readers_room_is_read_again(spark, tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    (folder / "a.csv").write_text("id,name\n1,x\n")
    feed = FeedSpec("csv", str(folder), "default.any_width", str(tmp_path / "progress"), "any width")
    ingest(spark, feed)
    (folder / "b.csv").write_text("id,name\n2,y\n" + "," * 150_000 + "\n")
    ingest(spark, feed)
    ingest(spark, feed)
    rows = spark.table(feed.table).collect()
    assert sorted(r.id for r in rows if r.id) == [1, 2]
    assert [json.loads(r._rescued_data)["_corrupt_record"] for r in rows if r._rescued_data] == ["," * 150_000]
