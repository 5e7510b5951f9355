"""Files of any Hadoop file system: bytes, copies, listings, and the tables read from and written to them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.sources import streams
from strandline.sources.order import from_files, in_order, plain

#: The file-group table: required columns and their types; any other column is metadata.
FILE_GROUP = {"FileName": "string", "StartTime": "timestamp_ntz", "Duration": "double", "SegStart": "double", "SegDur": "double"}
TYPED = FILE_GROUP | {"FullPath": "string", "DiffTime": "bigint"}


def join_path(*parts: str) -> str:
    return "/".join([parts[0].rstrip("/"), *(p.strip("/") for p in parts[1:])])


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path)"""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def create_if_absent(spark: SparkSession, path: str) -> bool:
    """An empty file; False if it is there already.  Of several drivers that ask at once, the file system lets one have it."""
    fs, p = file_system(spark, path)
    if fs.getScheme() == "file":  # Hadoop's local file system looks first and creates then
        return bool(spark._jvm.java.io.File(p.toUri().getPath()).createNewFile())
    try:
        fs.create(p, False).close()
    except Exception as e:  # noqa: BLE001  file systems differ in the kind
        # it may be gone again by now
        if "AlreadyExists" in str(e) or fs.exists(p):
            return False
        raise
    return True


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, p = file_system(spark, source)
    q = file_system(spark, target)[1]
    fs.delete(q, False)
    if not fs.rename(p, q):
        raise OSError(f"cannot rename {source} to {target}")


def folder_states(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(name, time of the last change in milliseconds) of the folders in a folder."""
    fs, p = file_system(spark, folder)
    return sorted((x.getPath().getName(), x.getModificationTime()) for x in fs.listStatus(p) if x.isDirectory()) if fs.exists(p) else []


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def size_of(spark: SparkSession, path: str) -> int:
    fs, p = file_system(spark, path)
    return fs.getFileStatus(p).getLen()


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.delete(p, True)


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """One small file (parameters, archives of pictures); tables are read by Spark."""
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    fs, p = file_system(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()


def copy_file(spark: SparkSession, source: str, target: str) -> None:
    """A file or a whole folder."""
    a, p = file_system(spark, source)
    b, q = file_system(spark, target)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(a, p, b, q, False, True, spark._jsc.hadoopConfiguration())


def list_files(spark: SparkSession, folder: str) -> Iterator[str]:
    """Every file below a folder."""
    fs, p = file_system(spark, folder)
    found = fs.listFiles(p, True)
    while found.hasNext():
        yield found.next().getPath().toString()


def file_states(spark: SparkSession, folder: str) -> list[tuple[str, int, int]]:
    """(name, length, time of the last change) of each file in a folder; hidden ones are left out."""
    fs, p = file_system(spark, folder)
    found = [(x.getPath().getName(), x.getLen(), x.getModificationTime()) for x in fs.listStatus(p) if x.isFile()]
    return sorted(x for x in found if not x[0].startswith(("_", ".")))


# ---------------------------------------------------------------- sources


def peek_schema(spark: SparkSession, path: str, sep: str = ",") -> T.StructType:
    """A schema from a file's header: file-group columns have their types, any other column is a string.

    Raises ValueError where a required column is missing.
    """
    names = spark.read.csv(path, header=True, sep=sep).columns
    if missing := [c for c in FILE_GROUP if c not in names]:
        raise ValueError(f"{path} lacks {', '.join(missing)}")
    return T.StructType([T.StructField(c, T._parse_datatype_string(TYPED.get(c, "string"))) for c in names])


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None, sep: str = ",", positions: bool = False) -> DataFrame:
    """A delimited table (one path or several) with a header, plain or gzipped; types are inferred only without a schema.  positions: each row keeps
    where it stands, as the column order.POSITION.

    A gzipped file is read by one task and its rows are dealt out again at once; one of more than streams.SHARE bytes, if a schema is given, is read as
    streams.read_gzip_csv() does, by many.
    """
    if isinstance(path, str) and path.endswith(".gz") and schema is not None and exists(spark, path) and size_of(spark, path) > streams.SHARE:
        return streams.read_gzip_csv(spark, [path], schema, sep, positions)
    df = spark.read.csv(path if isinstance(path, str) else list(path), header=True, sep=sep, schema=schema, inferSchema=schema is None)
    df = from_files(df) if positions else df
    return df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))) if (path if isinstance(path, str) else "".join(path[:1])).endswith(".gz") else df


def read_file_group(spark: SparkSession, path: str) -> DataFrame:
    """A file group with its rows' positions."""
    return read_csv(spark, path, peek_schema(spark, path), positions=True)


def read_file_groups(spark: SparkSession, folder: str, names: Sequence[str] | str, order: Sequence[str] | None = ("StartTime", "FileName", "SegStart"), tolerance_us: int = 1_000_000) -> DataFrame:
    """The listed file groups of a folder (a list, or its names joined by commas, as a list parameter without a scan gives
    them) as one table, in the order of the list and of the columns of `order` in each file (None: of the rows as they stand), with the
    island numbers of consecutive files; a file's own metadata columns are null for the others.
    """
    from strandline.operators.combine import combine_file_groups

    listed = [x for x in (names.split(",") if isinstance(names, str) else names)]
    return combine_file_groups([read_file_group(spark, join_path(folder, x)) for x in listed], order, tolerance_us)


def read_selections(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A selection table with its rows' positions."""
    return read_csv(spark, path, schema, sep="\t", positions=True)


def fetch_missing(spark: SparkSession, uris: Sequence[str], folder: str) -> DataFrame:
    """Copies each file into the folder unless it is there, a task a file; (uri, status) with copied, present or the error."""
    there = [(u, "present") for u in uris if exists(spark, join_path(folder, u.rsplit("/", 1)[-1]))]
    rest = [(u, join_path(folder, u.rsplit("/", 1)[-1]), "copy") for u in uris if u not in {x for x, _ in there}]
    done = spark.createDataFrame(there, "uri string, status string")
    if not rest:
        return done
    return done.unionByName(streams.move(spark, rest, strict=False).select(F.col("source").alias("uri"), F.coalesce(F.concat(F.lit("error: "), "error"), F.lit("copied")).alias("status")))


def archive_members(spark: SparkSession, path: str) -> DataFrame:
    """(path, member, content) of the files in tar archives; members of plain ones are read by many tasks, packed ones are streamed through by one."""
    return streams.tar_members(spark.read.format("binaryFile").load(path).select("path"))


# ---------------------------------------------------------------- sinks


def write_csv(df: DataFrame, path: str, sep: str = ",", gzip: bool = False) -> None:
    """A folder of delimited files with headers; rows that have positions are written in their order."""
    in_order(df).write.mode("overwrite").csv(path, header=True, sep=sep, compression="gzip" if gzip else "none")


def write_single_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """One named file (gzipped if the name says so), for tools that want one: its parts are written, and packed, by as many tasks as df has
    partitions, then joined in their order by one that streams their bytes; the file has its name once it is whole."""
    spark, pack = df.sparkSession, "gzip" if path.endswith(".gz") else "none"
    temp = f"{path}.parts"
    in_order(df).write.mode("overwrite").csv(join_path(temp, "rows"), header=False, sep=sep, compression=pack)
    plain(df).limit(0).coalesce(1).write.mode("overwrite").csv(join_path(temp, "head"), header=True, sep=sep, compression=pack)
    parts = [f for k in ("head", "rows") for f in sorted(list_files(spark, join_path(temp, k))) if "/part-" in f]
    streams.join_files(spark, parts, path)
    delete(spark, temp)


def export(spark: SparkSession, source: str, folder: str) -> list[str]:
    """An output as the user gets it: archives unpacked, gzip taken off, folders and other files copied; executors do it."""
    name = source.rstrip("/").rsplit("/", 1)[-1]
    if is_folder(spark, source):
        return upload(spark, source, join_path(folder, name)) and [join_path(folder, name)]
    how = "untar" if name.endswith((".tgz", ".tar.gz")) else "gunzip" if name.endswith(".gz") else "copy"
    target = folder if how == "untar" else join_path(folder, name[:-3] if how == "gunzip" else name)
    return [r.target for r in streams.move(spark, [(source, target, how)]).collect()]  # names


def upload(spark: SparkSession, folder: str, target: str) -> list[str]:
    """Every file below a folder, at the same place below the target, a task a file."""
    base = file_system(spark, folder)[1].toUri().getPath().rstrip("/")
    todo = [(f, join_path(target, f.split(base + "/", 1)[1]), "copy") for f in list_files(spark, folder)]
    return [r.target for r in streams.move(spark, todo).collect()] if todo else []  # names


def manifest(spark: SparkSession, rows: Sequence[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rows), "pipe string, path string").orderBy(F.col("pipe"))
