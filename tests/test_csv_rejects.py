"""CSV files in many ranges, and records set aside."""

import csv
import io
import json
import os
import random

import pytest
from pyspark.sql import types as T

from revcast.sources import csv_records
from revcast.sources.readers import load_directory, read_crm_export
from revcast.sources.rejects import Quarantine


def written(rows, terminator="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=terminator).writerows(rows)
    return out.getvalue()


def put(folder, name, text, encoding="iso-8859-1"):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "wb") as fh:
        fh.write(text.encode(encoding))


@pytest.fixture
def ranges_of(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}

    def use(size):
        for n in names:
            spark.conf.set(n, str(size))

    yield use
    for n, v in old.items():
        spark.conf.set(n, v)


def table(df):
    return sorted(tuple(None if v is None else str(v) for v in r) for r in df.collect())


def wanted(rows):
    return sorted(tuple(v or None for v in r) for r in rows)


@pytest.mark.parametrize("size", [7, 16, 41, 100, 1000, 100_000])
@pytest.mark.parametrize("terminator", ["\n", "\r\n"])
def test_records_of_any_range_size(spark, ranges_of, tmp_path, size, terminator):
    """Line breaks, quotes and separators in fields at all places of a range."""
    rng = random.Random(size)
    parts = ["a", "é", ",", '"', "\n", '""', "x\ny", " ", "long " * 9, "\n\n"]
    rows = [[f"k{i}", "".join(rng.choices(parts, k=rng.randrange(6))) + "z", "".join(rng.choices(parts, k=2)) + "e"]
            for i in range(60)]
    put(tmp_path, "t.csv", written([["key", "two\nlines", "c"], *rows], terminator))
    ranges_of(size)
    got = load_directory(spark, str(tmp_path), fmt="csv")["t"]
    assert got.columns == ["key", "two\nlines", "c"]
    assert table(got) == wanted(rows)


def test_a_field_longer_than_several_ranges_and_other_edges(spark, ranges_of, tmp_path):
    long = "\n".join(f"line {i}, \"q\"" for i in range(100))
    files = {"long": [["a", "b"], ["1", long], ["2", "x"]], "head": [["a", "b"]], "one": [["a"], ["x\ny"]],
             "lone": [["a", "b"], ["x\ry", "2"], ["3", "4"]], "blank": [["a", "b"], [], ["1", "u\nv"], [], ["2", "w"], []]}
    for name, rows in files.items():
        put(tmp_path, f"{name}.csv", written(rows))
    put(tmp_path, "tail.csv", 'a,b\n1,"no\nend of line"')
    ranges_of(64)
    got = load_directory(spark, str(tmp_path), fmt="csv")
    for name, rows in files.items():
        assert table(got[name]) == wanted([r for r in rows[1:] if r]), name
    assert table(got["tail"]) == [("1", "no\nend of line")]


def test_files_with_and_without_line_breaks_in_one_folder(spark, ranges_of, tmp_path):
    plain = [[f"p{i}", f"say \"{i}\""] for i in range(50)]
    broken = [[f"b{i}", f"two\nlines {i}"] for i in range(50)]
    put(tmp_path / "t", "part 1.csv", written([["k", "v"], *plain]))
    put(tmp_path / "t", "part 2.csv", written([["k", "v"], *broken]))
    ranges_of(200)
    got = load_directory(spark, str(tmp_path), fmt="csv")["t"]
    assert table(got) == wanted(plain + broken)
    assert got.rdd.getNumPartitions() > 4
    # Plain files are left to the reader of Spark, in ranges, and nothing is shuffled.
    os.remove(tmp_path / "t" / "part 2.csv")
    got = load_directory(spark, str(tmp_path), fmt="csv")["t"]
    assert got.rdd.getNumPartitions() > 4 and "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert table(got) == wanted(plain)


def test_one_file_is_joined_by_many_tasks(spark, ranges_of, tmp_path):
    rows = [[str(i), f"first\nsecond {i}"] for i in range(3000)]
    put(tmp_path, "t.csv", written([["k", "v"], *rows]))
    ranges_of(4000)
    lines = csv_records._lines(spark, [str(tmp_path / "t.csv")], "ISO-8859-1")
    assert lines.select("block").distinct().count() > 10 and lines.rdd.getNumPartitions() > 10
    assert table(load_directory(spark, str(tmp_path), fmt="csv")["t"]) == wanted(rows)


def test_ranges_hold_few_lines_in_large_files_too(spark, monkeypatch, tmp_path):
    """A task's lines do not grow with the file: one split of it is many ranges."""
    monkeypatch.setattr(csv_records, "RANGE_BITS", 3)
    files = {f"part {k}.csv": [[f"{k}-{i}", "x\n" * (i % 13) + f"end {i}"] for i in range(k * 40)] for k in range(5)}
    for name, rows in files.items():
        put(tmp_path / "t", name, written([["k", "v"], *rows]))
    records = csv_records.joined_records(spark, [str(tmp_path / "t" / n) for n in files], "ISO-8859-1")
    assert records.count() == sum(map(len, files.values()))
    got = load_directory(spark, str(tmp_path), fmt="csv")["t"]
    assert table(got) == wanted([r for rows in files.values() for r in rows])


SCHEMA = T.StructType([T.StructField("n", T.LongType()), T.StructField("d", T.DateType())])


def bad_csv(folder):
    put(folder, "t.csv", 'k,n,d,note\n1,5,2020-01-01,"two\nlines"\n2,x,2020-01-01,a\n3,,,\n4,7.0,nope,b\n5,1\n6,1,2020-02-02,c,more\n7,1.5e0,2020-02-03,e\n')


def test_csv_rejects_are_kept_apart_and_counted(spark, tmp_path):
    bad_csv(tmp_path / "in")
    q = Quarantine(spark, str(tmp_path / "q"))
    got = load_directory(spark, str(tmp_path / "in"), {"t": SCHEMA}, fmt="csv", on_reject="quarantine", quarantine=q)["t"]
    assert sorted(r.k for r in got.collect()) == ["1", "3", "7"]
    assert got.schema["n"].dataType == T.LongType()
    reasons = {r.reason: r.record for r in q.rows().collect()}
    assert set(reasons) == {"n: not bigint", "d: not date", "unreadable record"}
    assert json.loads(reasons["n: not bigint"])["n"] == "x"
    assert q.rows().where("reason = 'unreadable record'").count() == 2
    assert q.reconcile() == [("t", 7, 3, 4)]


def test_broken_records_end_the_job_unless_told_otherwise(spark, tmp_path):
    bad_csv(tmp_path / "in")
    where = str(tmp_path / "in")
    with pytest.raises(Exception, match="broken record: 5,1|cannot be cast|CAST_INVALID_INPUT"):
        load_directory(spark, where, {"t": SCHEMA}, fmt="csv")["t"].collect()
    kept = load_directory(spark, where, {"t": SCHEMA}, fmt="csv", on_reject="null")["t"]
    assert kept.count() == 7 and kept.where("n is null").count() == 2
    with pytest.raises(ValueError, match="t: rejected records in .*n: not bigint"):
        load_directory(spark, where, {"t": SCHEMA}, fmt="csv", on_reject="quarantine",
                       quarantine=Quarantine(spark, str(tmp_path / "q"), fail=True))
    with pytest.raises(ValueError, match="goes with a quarantine"):
        load_directory(spark, where, fmt="csv", on_reject="quarantine")
    with pytest.raises(ValueError, match="is none of"):
        load_directory(spark, where, fmt="csv", on_reject="skip")


def test_json_rejects(spark, tmp_path):
    lines = ['{"Id": "a", "N": 1, "attributes": {"type": "x"}}', '{"Id": "b", "N": "no"}', '{"Id": "c", "N":', "", '{"N": 3}', "[]"]
    put(tmp_path / "in", "t.json", "\n".join(lines) + "\n")
    schema = T.StructType([T.StructField("Id", T.StringType()), T.StructField("N", T.LongType()),
                           T.StructField("attributes", T.StructType([T.StructField("type", T.StringType())]))])
    q = Quarantine(spark, str(tmp_path / "q"))
    got = read_crm_export(spark, str(tmp_path / "in"), schema, prefix="P_", on_reject="quarantine", quarantine=q, source="acct")
    assert got.columns == ["P_Id", "P_N"]
    kept = sorted(map(str, got.collect()))
    assert {r.record for r in q.rows().collect()} >= {lines[1], lines[2]}
    ((name, n_read, n_kept, n_rejected),) = q.reconcile()
    assert (name, n_kept, n_read) == ("acct", len(kept), n_kept + n_rejected) and n_rejected >= 2
    with pytest.raises(Exception, match="broken record"):
        read_crm_export(spark, str(tmp_path / "in"), schema).collect()
    assert read_crm_export(spark, str(tmp_path / "in"), schema, on_reject="null").count() == n_read


def test_reconcile_sees_lost_records(spark, tmp_path):
    q = Quarantine(spark, str(tmp_path))
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    q.add("t", df, df.limit(1), spark.createDataFrame([], "record string, reason string"))
    with pytest.raises(ValueError, match="lost or doubled"):
        q.reconcile()
    assert Quarantine(spark, str(tmp_path)).report().count() == 0 == Quarantine(spark, str(tmp_path)).rows().count()
