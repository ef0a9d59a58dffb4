import os

import pytest
from pyspark.sql.types import StructType

from strata.session import session_conf
from strata.sources.schema import (
    Files,
    by_header,
    field_names,
    frozen_schema,
    headers,
    infer_csv,
    infer_json,
    sample_files,
    stored_schema,
    with_hints,
)


def ids(sequence):
    return [sequence.apply(i) for i in range(sequence.size())]


def ddl(schema):
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)


def put(folder, name, text, age):
    path = folder / name
    path.write_text(text)
    os.utime(path, (1_700_000_000 - age, 1_700_000_000 - age))
    return str(path)


def test_sample_takes_the_oldest_files(spark, tmp_path):
    for i in range(14):
        put(tmp_path, f"f{i:02d}.json", "{}" if i else "", age=100 - i)
    names = [path.rsplit("/", 1)[1] for path in sample_files(spark, str(tmp_path), 10)]
    assert names == [f"f{i:02d}.json" for i in range(1, 11)]


def test_samples_take_as_many_files_as_asked(spark, tmp_path):
    for i in range(1200):
        (tmp_path / f"f{i}.json").write_text("{}")
    assert len(sample_files(spark, str(tmp_path), 2000)) == 1200
    assert len(sample_files(spark, str(tmp_path), 1100)) == 1100
    with pytest.raises(ValueError, match="0 files"):
        sample_files(spark, str(tmp_path), 0)


def test_headers(spark, tmp_path):
    names = ["a b.csv", "p%20q+r.csv", "x{1}[y]*.csv", "long.csv"]
    for name in names:
        put(tmp_path, name, f"id,{name[0]}\n" + "1,2\n" * (500 if name == "long.csv" else 1), 0)
    put(tmp_path, "blank.csv", "\n \nid,z\n1,2\n", 0)
    put(tmp_path, "empty.csv", "", 0)
    put(tmp_path, "spaces.csv", " \n\n", 0)
    paths = sample_files(spark, str(tmp_path), 100)
    found = {path.rsplit("/", 1)[1]: names for path, names in headers(spark, paths).items()}
    assert found == {**{name: ("id", name[0]) for name in names}, "blank.csv": ("id", "z")}
    groups = by_header(spark, [*paths, str(tmp_path / "empty.csv")])
    assert {header: len(group) for header, group in groups.items()} == {
        ("id", "a"): 1, ("id", "p"): 1, ("id", "x"): 1, ("id", "l"): 1, ("id", "z"): 1
    }


def test_headers_read_the_first_buffers_only(spark, tmp_path):
    """Files of 24 MB: the look-up reads a small part of each."""
    for i in range(4):
        put(tmp_path, f"{i}.csv", "id,name\n" + "1234567,abcdefgh\n" * 1_400_000, 0)
    paths = sample_files(spark, str(tmp_path), 100)
    size = sum(os.path.getsize(tmp_path / f"{i}.csv") for i in range(4))
    assert set(headers(spark, paths).values()) == {("id", "name")}
    store = spark.sparkContext._jsc.sc().statusStore()
    last = max(store.jobsList(None).apply(i).jobId() for i in range(store.jobsList(None).size()))
    stages = [stage for job in range(last - 3, last + 1) for stage in ids(store.job(job).stageIds())]
    read = sum(store.lastStageAttempt(stage).inputBytes() for stage in stages)
    assert len(stages) == 4 and 0 < read < size / 20


def test_a_header_of_any_length(spark, tmp_path):
    names = [f"{'x' * 40}{k}" for k in range(30_000)]
    path = put(tmp_path, "x.csv", ",".join(names) + "\n", 0)
    assert headers(spark, [path]) == {path: tuple(names)}
    assert field_names(tuple(names)) == names


def test_fields_have_names_of_their_own():
    assert field_names(("a", "", "a", "b", " ", "a")) == ["a", "_c1", "a_2", "b", "_c4", "a_5"]
    assert field_names(("_c1", "", "a", "a", "a_3")) == ["_c1", "_c1_1", "a", "a_3_3", "a_3"]


def test_infer_json(spark, tmp_path):
    path = put(tmp_path, "a.json", '{"id":1,"d":"2024-01-01","v":1.5}\n{"id":2,"n":{"q":1}}\n{oops\n', 0)
    assert ddl(infer_json(spark, Files([path]))) == "d string, id bigint, n struct<q:bigint>, v double"


def test_infer_csv_widens_and_unites(spark, tmp_path):
    a = put(tmp_path, "a.csv", "id,price,day,code\n1,$1,2024-01-01,1\n", 2)
    b = put(tmp_path, "b.csv", "code,id,more\nx,12345678901,1.5\n", 1)
    assert ddl(infer_csv(spark, Files([a, b]))) == "id bigint, price string, day date, code string, more double"


#: A column each: texts of one kind, and of kinds that meet.
COLUMNS = [
    ["1", "-2", "+3", "007"], ["2147483647", "2147483648"], ["-2147483648", "-2147483649"], ["9223372036854775807"],
    ["9223372036854775808"], ["1", "12345678901234567890123"], ["1" * 38], ["1" * 39], ["1.5", "2"], ["1e3"], [".5", "-7."],
    ["NaN"], ["Infinity", "1"], ["1 "], ["2024-01-01"], ["2024-01-01", "2024-01-01 10:11:12"], ["2024-01-01T10:11:12"],
    ["2024-01-01 10:11:12.123"], ["2024-13-01"], ["true", "FALSE"], ["true", "1"], ["x", "1"], ["2024-01-01", "5"], ["", ""], ["$1"],
    ["1", ""], ["99999999999", "1.5"], ["0x1F"], ["-"], ["+"], ["1-2"], ["yes"], ["NULL"], ["2024-1-1"],
]


def test_types_are_those_of_sparks_inference(spark, tmp_path):
    rows = max(map(len, COLUMNS))
    lines = [",".join(f"c{k:02}" for k in range(len(COLUMNS)))]
    lines += [",".join(c[r] if r < len(c) else "" for c in COLUMNS) for r in range(rows)]
    path = put(tmp_path, "a.csv", "\n".join(lines) + "\n", 0)
    theirs = spark.read.csv(path, header=True, inferSchema=True).schema
    assert [(f.name, f.dataType) for f in infer_csv(spark, Files([path]))] == [(f.name, f.dataType) for f in theirs]


def test_one_pass_however_many_headers(spark, tmp_path):
    """Forty headers of one column in common cost as many jobs as two."""

    def jobs(n):
        folder = tmp_path / str(n)
        folder.mkdir()
        for k in range(n):
            put(folder, f"{k:02}.csv", f"own{k},id\n{k},{k}\n", 100 - k)
        spark.sparkContext.setJobGroup(f"infer {n}", "")
        schema = infer_csv(spark, Files([str(folder)], folder=True))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert schema.names == ["own0", "id", *[f"own{k}" for k in range(1, n)]]
        assert {f.dataType.simpleString() for f in schema} == {"int"}
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"infer {n}"))

    assert jobs(2) == jobs(40) <= 12


def test_a_folder_of_subfolders_and_empty_files(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    put(tmp_path / "a", "x.csv", "\n \nid,,id,ID,v\n1,2,3,4,\"a,\"\"b\"\n\n2,2,2,2\n", 5)
    put(tmp_path / "a" / "b", "y.csv", "v,id\n,99999999999\n", 4)
    put(tmp_path, "empty.csv", "", 9)
    assert ddl(infer_csv(spark, Files([str(tmp_path)], folder=True))) == "id bigint, v string"
    put(tmp_path / "a" / "b", "z.csv", "\n\n", 4)
    blank = tmp_path / "blank"
    blank.mkdir()
    put(blank, "z.csv", "\n\n", 4)
    assert infer_csv(spark, Files([str(blank)], folder=True)) == StructType()


def test_hints_override_and_add(spark):
    seen = StructType.fromDDL("order_id string, time string")
    assert ddl(with_hints(seen, "order_id BIGINT, date DATE")) == "order_id bigint, time string, date date"
    assert with_hints(seen, None) == seen


def test_schema_is_inferred_once(spark, tmp_path):
    feed, kept = tmp_path / "feed", str(tmp_path / "schema")
    feed.mkdir()
    with pytest.raises(ValueError, match="no files"):
        frozen_schema(spark, "json", str(feed), kept)
    assert stored_schema(spark, kept) is None
    put(feed, "a.json", '{"id":1}', 0)
    first = frozen_schema(spark, "json", str(feed), kept, hints="day DATE")
    put(feed, "b.json", '{"id":"x","new":1}', 0)
    assert frozen_schema(spark, "json", str(feed), kept) == first == stored_schema(spark, kept)
    assert ddl(first) == "id bigint, day date"
