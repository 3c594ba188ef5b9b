from __future__ import annotations

import pytest
from pyspark.sql import types as T

from lodestar.sources.extract_files import latest_run, read_extract, reference_file, rejected_lines, write_extract
from lodestar.sources.run_store import RunStore, compact, register_and_analyze

SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("amount", T.DecimalType(20, 4)),
        T.StructField("at", T.TimestampNTZType()),
    ]
)


@pytest.fixture
def data(spark):
    return spark.sql(
        """select 1L as id, 'say "hi", there' as name, cast(1.5 as decimal(20,4)) as amount, timestamp_ntz'2024-01-02 03:04:05' as at
        union all select 2L, '', null, null union all select 3L, null, cast(0 as decimal(20,4)), null
        union all select 4L, ' back\\\\slash ', null, null"""
    )


def test_extract_round_trip(spark, data, tmp_path, rows):
    path = str(tmp_path / "x")
    write_extract(data, path, 7)
    back = read_extract(spark, path, 7, SCHEMA)
    assert rows(back, *data.columns) == rows(data)
    assert {r["runid"] for r in back.collect()} == {7}
    assert rejected_lines(back.cache()).isEmpty()
    write_extract(data.filter("id = 1"), path, 7)
    assert read_extract(spark, path, 7, SCHEMA).count() == 1


def test_lines_that_do_not_fit_are_kept(spark, tmp_path, rows):
    folder = tmp_path / "y" / "runid=1"
    folder.mkdir(parents=True)
    (folder / "part.csv").write_text('runid,id,name,amount,at\n1,5,ok,2.5,2024-01-02 03:04:05\n1,oops,bad,1,\n')
    back = read_extract(spark, str(tmp_path / "y"), 1, SCHEMA).cache()
    assert rows(back, "id", "name") == [(None, "bad"), (5, "ok")]
    assert rows(rejected_lines(back), "name") == [("bad",)]


def test_reference_file(spark, tmp_path, rows):
    (tmp_path / "r.csv").write_text('code,label\nA,"one ""1"""\nB,two\n')
    out = reference_file(spark, str(tmp_path / "r.csv"), 3)
    assert out.columns == ["runid", "code", "label"]
    assert rows(out) == [(3, "A", 'one "1"'), (3, "B", "two")]


def test_latest_run(spark, tmp_path, rows):
    path = str(tmp_path / "z")
    spark.createDataFrame([(1, "a"), (10, "b"), (9, "c")], "runid int, v string").write.partitionBy("runid").parquet(path)
    assert rows(latest_run(spark.read.parquet(path)), "v") == [("b",)]


def test_readers_see_published_runs_only(spark, tmp_path, rows):
    store = RunStore(spark, str(tmp_path / "store"))
    assert store.read("t") is None
    frame = lambda *v: spark.createDataFrame([(x,) for x in v], "v int")
    store.write(frame(1), "t", 1)
    assert store.read("t") is None
    store.publish(1, ["t"])
    store.write(frame(2), "t", 2)
    assert rows(store.read("t")) == [(1,)]
    store.publish(2, ["t"])
    assert rows(store.read("t")) == [(2,)]
    assert rows(store.read("t", before=2)) == [(1,)]
    store.write(frame(3), "u", 3)
    store.publish(3, ["u"])
    assert rows(store.read("t")) == [(2,)]


def test_compaction_and_statistics_need_a_clean_run(spark, tmp_path, rows):
    store = RunStore(spark, str(tmp_path / "store"))
    store.write(spark.range(100).repartition(8), "t", 1)
    store.publish(1, ["t"])
    assert not compact(store, "t", 1, 1, failed=1)
    assert register_and_analyze(store, {"t": "t_stats"}, failed=1) == []
    before = rows(store.read("t"))
    assert compact(store, "t", 1, 1, failed=0)
    assert rows(store.read("t")) == before
    assert len(store.read("t").inputFiles()) == 1
