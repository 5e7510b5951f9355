from strandline.streaming.segments import append_bounded, incoming

SCHEMA = "FileName string, StartTime timestamp_ntz, SegStart double, SegDur double"


def test_each_file_is_taken_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put = lambda n: (tmp_path / "in" / f"{n}.csv").write_text(f"FileName,StartTime,SegStart,SegDur\nf{n},2024-01-01 00:00:0{n},1,2.5\n")
    put(1)
    for more in (2, 3):
        q = append_bounded(incoming(spark, f"{tmp_path}/in", SCHEMA), f"{tmp_path}/out", f"{tmp_path}/ck")
        assert q.awaitTermination(60)
        put(more)
    rows = spark.read.parquet(f"{tmp_path}/out").orderBy("FileName").collect()
    assert [r.FileName for r in rows] == ["f1", "f2"]
    assert rows[0].true_end_us - rows[0].true_start_us == 2_500_000
