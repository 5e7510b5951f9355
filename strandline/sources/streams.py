"""Bytes of files, moved by executors as streams: copies, unpacking, tar members, and lines of gzipped files.

What is listed or named is a row a file; each row is a task's work, and no payload passes through the driver.  Files appear under their names only when they are
whole: a task writes beside the target and renames, so one that fails leaves nothing.  Executors open files with pyarrow (local, HDFS, object
stores).
"""

from __future__ import annotations

import gzip
import tarfile
import uuid
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions.shared import written
from strandline.sources.order import POSITION, digits

CHUNK = 1 << 20
#: Bytes of tar members, or of a gzipped file, that a task reads at least.
SHARE = 32 << 20
MAGIC = b"\x1f\x8b\x08"


def file_system(uri: str):
    """(pyarrow file system, path)"""
    from pyarrow import fs

    if uri.startswith(("file:", "/")):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def _put(target: str, chunks: Iterator[bytes]) -> int:
    """A file from chunks; it has its name once it is whole."""
    from pyarrow import fs

    where, path = file_system(target)
    where.create_dir(path.rsplit("/", 1)[0], recursive=True)
    beside, n = f"{path}.{uuid.uuid4().hex}.part", 0
    try:
        with where.open_output_stream(beside) as out:
            for c in chunks:
                out.write(c)
                n += len(c)
        if where.get_file_info(path).type != fs.FileType.NotFound and not isinstance(where, fs.LocalFileSystem):
            where.delete_file(path)
        where.move(beside, path)
    except BaseException:
        if where.get_file_info(beside).type == fs.FileType.File:
            where.delete_file(beside)
        raise
    return n


def _chunks(f) -> Iterator[bytes]:
    while c := f.read(CHUNK):
        yield c


def _members(f) -> Iterator[tuple[str, object]]:
    """(name without folders, file) of the files of a tar stream, one after the other; no list of them is kept."""
    with tarfile.open(fileobj=f, mode="r|*") as tar:
        for m in tar:
            tar.members = []
            if m.isfile():
                yield m.name.replace("\\", "/").rsplit("/", 1)[-1], tar.extractfile(m)


def _move(source: str, target: str, how: str) -> Iterator[tuple[str, int]]:
    where, path = file_system(source)
    with where.open_input_stream(path, compression=None) as f:
        if how == "untar":
            for name, member in _members(f):
                yield f"{target.rstrip('/')}/{name}", _put(f"{target.rstrip('/')}/{name}", _chunks(member))
        elif how == "gunzip":
            yield target, _put(target, _chunks(gzip.GzipFile(fileobj=f)))
        else:
            yield target, _put(target, _chunks(f))


def move(spark: SparkSession, files: Sequence[tuple[str, str, str]], strict: bool = True) -> DataFrame:
    """(source, target, bytes, error) of files (source, target, how): copy, gunzip, or untar into the folder target (a row a member).

    strict: a file that cannot be moved fails the job; otherwise its row says why.  The rows are written when this returns.
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            for r in rb.to_pylist():
                try:
                    for target, n in _move(r["source"], r["target"], r["how"]):
                        yield pa.RecordBatch.from_pylist([{"source": r["source"], "target": target, "bytes": n, "error": None}], schema=schema)
                except Exception as e:
                    if strict:
                        raise
                    yield pa.RecordBatch.from_pylist([{"source": r["source"], "target": r["target"], "bytes": None, "error": (str(e).splitlines() or [type(e).__name__])[0][:200]}], schema=schema)

    schema = pa.schema([("source", pa.string()), ("target", pa.string()), ("bytes", pa.int64()), ("error", pa.string())])
    todo = spark.createDataFrame([(i, *x) for i, x in enumerate(files)], "i int, source string, target string, how string")
    dealt = todo.repartitionById(max(1, min(len(files), 4096)), F.col("i") % 4096).drop("i")
    return written(dealt.mapInArrow(run, "source string, target string, bytes long, error string"), "moved")


def join_files(spark: SparkSession, parts: Sequence[str], target: str) -> None:
    """One file of the bytes of others, in their order; a task streams them."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            for r in rb.to_pylist():

                def through(names: list[str]) -> Iterator[bytes]:
                    for name in names:
                        where, path = file_system(name)
                        with where.open_input_stream(path, compression=None) as f:
                            yield from _chunks(f)

                yield pa.RecordBatch.from_arrays([pa.array([_put(r["target"], through(r["parts"]))])], names=["bytes"])

    spark.createDataFrame([(list(parts), target)], "parts array<string>, target string").mapInArrow(run, "bytes long").collect()  # a number


# ---------------------------------------------------------------- archives


def tar_index(paths: DataFrame) -> DataFrame:
    """(path, member, offset, size) of the files in archives (path): headers alone are read, as members are skipped over.  A compressed archive,
    which can only be read through, is one row without member."""

    def index(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            for path in rb.column("path").to_pylist():
                where, p = file_system(path)
                with where.open_input_file(p) as f:
                    size = f.size()
                    if f.read(3) == MAGIC or p.endswith((".bz2", ".xz")):
                        yield pa.RecordBatch.from_pylist([{"path": path, "member": None, "offset": None, "size": size}], schema=schema)
                        continue
                    f.seek(0)
                    rows = []
                    with tarfile.open(fileobj=f, mode="r:") as tar:
                        while m := tar.next():
                            tar.members = []
                            if m.isfile():
                                rows.append({"path": path, "member": m.name.replace("\\", "/").rsplit("/", 1)[-1], "offset": m.offset_data, "size": m.size})
                            if len(rows) >= 4096:
                                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                                rows = []
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema([("path", pa.string()), ("member", pa.string()), ("offset", pa.int64()), ("size", pa.int64())])
    return paths.select("path").mapInArrow(index, "path string, member string, offset long, size long")


def tar_members(paths: DataFrame, share: int = SHARE) -> DataFrame:
    """(path, member, content) of the files in archives (path), whose members are read by as many tasks as there are shares of bytes."""
    spark = paths.sparkSession
    index = written(tar_index(paths), "tar-index")
    n, total, through = index.agg(F.count("offset"), F.coalesce(F.sum(F.when(F.col("offset").isNotNull(), F.col("size"))), F.lit(0)), F.sum(F.col("offset").isNull().cast("int"))).first()
    tasks = max(1, min(n, -(-total // share)))

    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, f = None, None
        try:
            for rb in it:
                for r in rb.to_pylist():
                    if r["path"] != now:
                        if f is not None:
                            f.close()
                        where, p = file_system(r["path"])
                        now, f = r["path"], where.open_input_file(p)
                    yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([r["member"]]), pa.array([f.read_at(r["size"], r["offset"])], pa.binary())], names=["path", "member", "content"])
        finally:
            if f is not None:
                f.close()

    def through_(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            for path in rb.column("path").to_pylist():
                where, p = file_system(path)
                with where.open_input_stream(p, compression=None) as f:
                    for name, member in _members(f):
                        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([name]), pa.array([member.read()], pa.binary())], names=["path", "member", "content"])

    kind = "path string, member string, content binary"
    out = index.where("offset is not null").repartitionByRange(tasks, "path", "offset").sortWithinPartitions("path", "offset").mapInArrow(read, kind)
    if not through:
        return out
    packed = index.where("offset is null").repartition(min(through, 4096), "path").mapInArrow(through_, kind)
    return packed if not n else out.unionByName(packed)


# ---------------------------------------------------------------- gzipped lines


def _inflated(f, start: int) -> Iterator[tuple[bytes, int | None]]:
    """(bytes, None) of the gzip member at `start`, chunk by chunk, then (b"", place after it); zlib holds them against their checksum."""
    f.seek(start)
    d, at = zlib.decompressobj(31), start
    while not d.eof:
        raw = f.read(CHUNK)
        if not raw:
            raise EOFError("a gzip member does not end")
        at += len(raw)
        while raw and not d.eof:
            yield d.decompress(raw, CHUNK), None
            raw = d.unconsumed_tail
    yield b"", at - len(d.unused_data)


def gzip_members(paths: DataFrame, share: int = SHARE) -> DataFrame:
    """(path, first, last): where the members of gzipped files begin and end, found by many tasks.

    A task looks for beginnings in its share of the bytes and inflates from each; what does not end as its checksum says is none, and neither is what
    stands inside another member.
    """

    def starts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            for r in rb.to_pylist():
                where, p = file_system(r["path"])
                rows = []
                with where.open_input_file(p) as f:
                    f.seek(r["lo"])
                    raw = f.read(r["hi"] - r["lo"] + 2)
                    at = raw.find(MAGIC)
                    while at >= 0:
                        try:
                            end = [e for _, e in _inflated(f, r["lo"] + at)][-1]
                            rows.append({"path": r["path"], "first": r["lo"] + at, "last": end})
                        except (zlib.error, EOFError):
                            pass
                        at = raw.find(MAGIC, at + 1)
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema([("path", pa.string()), ("first", pa.int64()), ("last", pa.int64())])
    cuts = paths.select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(share).cast("long"))).alias("lo"), "length")
    cuts = cuts.select("path", "lo", F.least(F.col("lo") + share, "length").alias("hi")).repartition(4 * int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path", "lo")
    found = written(cuts.mapInArrow(starts, "path string, first long, last long"), "gzip-members")
    before = F.max("last").over(Window.partitionBy("path").orderBy("first").rowsBetween(Window.unboundedPreceding, -1))
    return found.withColumn("__end", F.coalesce(before, F.lit(0))).where(F.col("first") >= F.col("__end")).drop("__end")


def gzip_lines(spark: SparkSession, files: Sequence[str], share: int = SHARE) -> DataFrame:
    """(path, at, lines array): the lines of gzipped files, at being the place of the member they begin in.

    A file of many members is inflated by as many tasks; lines that go on in the next member are finished by the task that began them.  A file of one
    member can only be inflated by one; its lines are dealt out at once, a row each megabyte.
    """
    paths = spark.read.format("binaryFile").load(list(files)).select("path", "length")
    members = gzip_members(paths, share)

    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            for r in rb.to_pylist():
                where, p = file_system(r["path"])
                n = 0
                with where.open_input_file(p) as f:
                    left, skip = b"", r["first"] > 0
                    for data, end in _inflated(f, r["first"]):
                        left += data
                        if skip and b"\n" in left:
                            left, skip = left.split(b"\n", 1)[1], False
                        if not skip and (cut := left.rfind(b"\n") + 1) and len(left) >= CHUNK:
                            yield row(r, n, left[:cut])
                            left, n = left[cut:], n + 1
                    if not skip:  # and on to the first line end of what follows
                        at, size, more = end, f.size(), b""
                        while at < size and b"\n" not in more:
                            for data, nxt in _inflated(f, at):
                                more += data
                                if b"\n" in more:
                                    break
                            else:
                                at = nxt
                        body = left + (more[: more.index(b"\n") + 1] if b"\n" in more else more)
                        if body:
                            yield row(r, n, body)

    def row(r: dict, n: int, body: bytes) -> pa.RecordBatch:
        lines = body.decode("utf-8", "replace").split("\n")
        lines = [x.removesuffix("\r") for x in (lines[:-1] if lines[-1] == "" else lines)]
        return pa.RecordBatch.from_pylist([{"path": r["path"], "at": r["first"], "n": n, "lines": lines}], schema=schema)

    schema = pa.schema([("path", pa.string()), ("at", pa.int64()), ("n", pa.int64()), ("lines", pa.list_(pa.string()))])
    parts = max(1, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    blocks = written(members.repartition(parts, "path", "first").mapInArrow(read, "path string, at long, n long, lines array<string>"), "gzip-lines")
    return blocks


def read_gzip_csv(spark: SparkSession, files: Sequence[str], schema: T.StructType | str, sep: str = ",", positions: bool = False, share: int = SHARE) -> DataFrame:
    """Gzipped delimited files with a header (a row a line) as a table, inflated and parsed by many tasks; see gzip_lines()."""
    kind = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    blocks = gzip_lines(spark, files, share)
    lines = blocks.select("path", "at", "n", F.posexplode("lines").alias("i", "line")).where("not (at = 0 and n = 0 and i = 0) and line <> ''")
    row = F.from_csv("line", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind), {"sep": sep})
    out = lines.select("path", "at", "n", "i", row.alias("r"))
    place = [F.array(F.regexp_replace("path", "[^/]*$", ""), F.lit("0" * 12), F.regexp_extract("path", "[^/]*$", 0), digits(F.col("at")), digits(F.col("n")), digits(F.col("i"))).alias(POSITION)] if positions else []
    return out.select("r.*", *place)
