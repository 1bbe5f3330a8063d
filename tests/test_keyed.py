"""The bounded flush as a stream."""

from helpers import rows

from tidemark.streaming import keyed


def test_rows_added_meanwhile_wait_and_a_restart_reads_the_same(spark, tmp_path):
    table, ck, got = str(tmp_path / "t"), str(tmp_path / "ck"), {}
    add = lambda a, b: spark.range(a, b).selectExpr("id as n", "id * 2 as v", "'x' as other").repartition(2).write.mode("append").parquet(table)
    stream = lambda: keyed.source(spark, table, "n", spark.read.parquet(table).select("v", "n").schema)
    meanwhile = [(10, 30)]

    def apply(batch, number):
        if meanwhile:
            add(*meanwhile.pop())
        got[number] = rows(batch, "n", "v")

    add(0, 10)
    keyed.flush(stream(), ck, apply).start().awaitTermination()
    assert got == {0: sorted(((k, 2 * k) for k in range(10)), key=repr)}
    (tmp_path / "ck/commits/0").unlink()  # died before the commit
    (tmp_path / "ck/commits/.0.crc").unlink(missing_ok=True)
    again, got = got, {}
    keyed.flush(stream(), ck, apply).start().awaitTermination()
    assert got[0] == again[0]
    keyed.flush(stream(), ck, apply).start().awaitTermination()
    assert got[1] == sorted(((k, 2 * k) for k in range(10, 30)), key=repr)
    add(30, 31)
    keyed.flush(stream(), ck, apply).start().awaitTermination()
    assert got[2] == [(30, 60)] and len(got) == 3
    keyed.flush(stream(), ck, apply).start().awaitTermination()  # nothing new
    assert len(got) == 3


def test_only_files_in_the_range_are_read(spark, tmp_path):
    for k in range(3):
        spark.range(k * 10, k * 10 + 10).selectExpr("id as n").coalesce(1).write.mode("append").parquet(str(tmp_path / "t"))
    r = keyed.KeyedReader(str(tmp_path / "t"), "n", ["n"])
    assert r.latestOffset() == {"key": 29} and [(p.after, p.to) for p in r.partitions({"key": 9}, {"key": 15})] == [(9, 15)]
    assert sorted(x for p in r.partitions({"key": 9}, {"key": 21}) for b in r.read(p) for x in b.column(0).to_pylist()) == list(range(10, 22))
    assert len(r.partitions({"key": None}, {"key": 29})) == 3 and r.partitions({"key": None}, {"key": None}) == []
