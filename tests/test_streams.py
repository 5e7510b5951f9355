"""Files moved by executors, tar members read by ranges, gzipped lines read by many tasks."""

import gzip
import io
import os
import random
import tarfile

import pytest
from pyspark.sql import functions as F

from strandline.sources import files, order, streams


def tar(path, members, mode="w"):
    with tarfile.open(path, mode) as t:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
        folder = tarfile.TarInfo("folder")
        folder.type = tarfile.DIRTYPE
        t.addfile(folder)


def test_members_of_a_plain_archive_are_read_by_many_tasks(spark, tmp_path):
    rng = random.Random(1)
    members = [(f"d{i % 7}/f{i:04d}.bin", rng.randbytes(rng.randrange(0, 3000))) for i in range(1000)]
    tar(tmp_path / "a.tar", members)
    tar(tmp_path / "b.tgz", members[:20], "w:gz")
    paths = spark.read.format("binaryFile").load(f"file://{tmp_path}").select("path")
    index = streams.tar_index(paths.where("path like '%.tar'")).collect()
    assert [(r.member, r["size"]) for r in index] == [(n.split("/")[1], len(d)) for n, d in members]
    raw = (tmp_path / "a.tar").read_bytes()
    assert all(raw[r.offset : r.offset + r["size"]] == d for r, (_, d) in zip(index, members, strict=True))
    got = streams.tar_members(paths, share=50_000)
    assert got.where("path like '%.tar'").select(F.spark_partition_id()).distinct().count() > 10
    rows = {(r.path.rsplit("/", 1)[1], r.member): bytes(r.content) for r in got.collect()}
    assert rows == {("a.tar", n.split("/")[1]): d for n, d in members} | {("b.tgz", n.split("/")[1]): d for n, d in members[:20]}
    tar(tmp_path / "c.tar", [])
    assert streams.tar_members(spark.createDataFrame([(f"file://{tmp_path}/c.tar",)], "path string")).count() == 0


def packed(pieces):
    return b"".join(gzip.compress(p) for p in pieces)


def lines(spark, path, share):
    rows = streams.gzip_lines(spark, [f"file://{path}"], share).collect()
    return [x for r in sorted(rows, key=lambda r: (r["at"], r.n)) for x in r.lines], rows


@pytest.mark.parametrize("share", [64, 1 << 25])
def test_lines_of_gzipped_files_of_any_members(spark, tmp_path, share):
    rng = random.Random(3)
    text = "".join(f"{i},{'é' * rng.randrange(0, 9)}{rng.random()}\n" for i in range(2000)).encode()
    cuts = sorted(rng.sample(range(len(text)), 40))
    whole = text.rstrip(b"\n")
    for name, pieces in {
        "many": [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)], "one": [text], "at_line_ends": [x + b"\n" for x in whole.split(b"\n")[:100]], "no_last_line_end": [text[:500], whole[500:]],
        "tiny": [text[i : i + 3] for i in range(0, 300, 3)], "with_empty_members": [b"", text[:100], b"", b"", text[100:999], b""], "packed_inside": [text[:50] + b"\n", gzip.compress(b"inner\nlines\n", 0) + b"\n", b"last\n"],
    }.items():
        (tmp_path / f"{name}.gz").write_bytes(packed(pieces))
        got, rows = lines(spark, tmp_path / f"{name}.gz", share)
        want = b"".join(pieces).decode("utf-8", "replace").split("\n")
        assert got == (want[:-1] if want[-1] == "" else want), name
        if name == "at_line_ends" and share == 64:
            assert len({r["at"] for r in rows}) > 50
    (tmp_path / "stored.gz").write_bytes(packed([b"a\n"]) + gzip.compress(packed([b"x\n", b"y\n"]) + b"\nb\n", 0))
    assert lines(spark, tmp_path / "stored.gz", share)[0][0] == "a" and lines(spark, tmp_path / "stored.gz", share)[0][-1] == "b"
    (tmp_path / "empty.gz").write_bytes(gzip.compress(b""))
    assert lines(spark, tmp_path / "empty.gz", share)[0] == []


def test_a_table_in_one_gzipped_file_and_back(spark, tmp_path, monkeypatch):
    df = spark.range(0, 3000).select("id", F.concat(F.lit('a "q", '), F.col("id")).alias("s"), (F.col("id") / 7).alias("x")).repartition(6, "id").orderBy(F.desc("id"))
    path = f"file://{tmp_path}/one.csv.gz"
    files.write_single_csv(df, path)
    assert sorted(os.listdir(tmp_path)) == [".one.csv.gz.crc", "one.csv.gz"] or os.listdir(tmp_path) == ["one.csv.gz"]
    schema = "id long, s string, x double"
    plain = [tuple(r) for r in spark.read.csv(path, schema, header=True).collect()]
    assert [r[0] for r in plain] == list(range(2999, -1, -1))  # in order, whole
    monkeypatch.setattr(streams, "SHARE", 1000)
    many = files.read_csv(spark, path, schema, positions=True)
    assert [tuple(r) for r in order.in_order(many).collect()] == plain
    assert streams.gzip_lines(spark, [path], 1000).select("at").distinct().count() > 1


def test_a_copy_that_fails_leaves_nothing(spark, tmp_path):
    (tmp_path / "ok.bin").write_bytes(b"x" * 3_000_000)
    good = gzip.compress(os.urandom(200_000))
    (tmp_path / "broken.gz").write_bytes(good[:-5])
    out = f"file://{tmp_path}/out"
    rows = {r.source.rsplit("/", 1)[1]: (r.bytes, r.error) for r in streams.move(spark, [(f"file://{tmp_path}/ok.bin", f"{out}/ok.bin", "copy"), (f"file://{tmp_path}/broken.gz", f"{out}/broken", "gunzip"), (f"file://{tmp_path}/none", f"{out}/none", "copy")], strict=False).collect()}
    assert rows["ok.bin"] == (3_000_000, None) and rows["broken.gz"][1] and rows["none"][1]
    assert os.listdir(tmp_path / "out") == ["ok.bin"]
    with pytest.raises(Exception, match="none"):
        streams.move(spark, [(f"file://{tmp_path}/none", f"{out}/none", "copy")])
    # a file that is there already is replaced as a whole
    streams.move(spark, [(f"file://{tmp_path}/ok.bin", f"{out}/ok.bin", "copy")])
    assert os.path.getsize(tmp_path / "out" / "ok.bin") == 3_000_000
