"""Bringing tables of one kind together: union by name, renumbering, artifact folders, scatter and gather."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators.segments import islands, row_numbers
from strandline.sources import streams
from strandline.sources.files import is_folder, join_path, upload
from strandline.sources.order import POINT, POSITION, behind, numbered, positioned


def union_by_name(tables: Sequence[DataFrame], port: str | None = "__port") -> DataFrame:
    """All rows of all tables; columns are matched by name and missing ones are null.  port numbers the inputs."""
    if not tables:
        raise ValueError("nothing to combine")
    marked = [t.withColumn(port, F.lit(i)) if port else t for i, t in enumerate(tables)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)


def union_in_order(tables: Sequence[DataFrame]) -> DataFrame:
    """union_by_name() with positions: all rows of an input behind those of the inputs before it, each input in its own order."""
    return union_by_name([behind(t, i) for i, t in enumerate(tables)], None)


def combine_selections(tables: Sequence[DataFrame], order: Sequence[str] | None = None) -> DataFrame:
    """Selection tables in one, numbered anew from 1: input after input, the rows of each as they stand in it (its positions) or,
    with `order`, by those columns.  Without `order` the rows keep positions, which are the new numbers."""
    if order is not None:
        return row_numbers(union_by_name([t.drop("Selection") for t in tables]), ["__port", *order]).drop("__port")
    rows = union_by_name([positioned(t).drop("Selection") for t in tables])
    return numbered(row_numbers(rows, ["__port", POSITION]).drop("__port"), "Selection")


def combine_file_groups(tables: Sequence[DataFrame], order: Sequence[str] | None = None, tolerance_us: int = 1_000_000) -> DataFrame:
    """File-group tables in one, with DiffTime recomputed (without cap) over the rows in the order of combine_selections()."""
    own = [t.drop("DiffTime") for t in tables]
    rows = union_by_name(own if order is not None else [positioned(t) for t in own]).withColumn("StartTime", F.col("StartTime").cast("timestamp_ntz"))
    out = islands(rows, ["__port", *(order if order is not None else [POSITION])], tolerance_us).drop("true_start_us", "true_end_us")
    if order is None:
        out = out.withColumn(POSITION, F.concat(F.array(F.format_string("%08d", "__port")), POSITION))
    return out.drop("__port")


def combine_points(rows: DataFrame, kind: str) -> DataFrame:
    """What combining a table for each point would give, from the rows of all points in one (told apart by order.POINT)."""
    rows = positioned(rows)
    if kind in ("selections", "file_group"):
        ported = rows.withColumnRenamed(POINT, "__port")
        if kind == "selections":
            return numbered(row_numbers(ported.drop("Selection"), ["__port", POSITION]).drop("__port"), "Selection")
        ported = ported.drop("DiffTime").withColumn("StartTime", F.col("StartTime").cast("timestamp_ntz"))
        out = islands(ported, ["__port", POSITION]).drop("true_start_us", "true_end_us").withColumnRenamed("__port", POINT)
    else:
        out = rows
    return out.withColumn(POSITION, F.concat(F.array(F.format_string("%08d", POINT)), POSITION)).drop(POINT)


def combine_kind(outfile: str, no_combine: bool, first: str = "") -> str:
    """How outputs of this name are brought together: selections, untar, copy, file_group or table."""
    if ".txt" in outfile:
        return "selections"
    if no_combine:
        return "untar" if first.endswith((".tgz", ".tar.gz")) else "copy"
    return "file_group" if "FileGroupFormat.csv.gz" in outfile else "table"


def never_combined(outfile: str) -> bool:
    """Pictures, archives, test outputs and fitted models are collected as files."""
    return any(x in outfile for x in (".png", "test", ".tgz", ".model"))


def collect_artifacts(spark, paths: Sequence[str], folder: str, outfile: str) -> list[str]:
    """Files of several branches in one folder: copies named <number>_<outfile>, or archives unpacked each in its own
    folder <number>_<name of the archive up to its first dot>; numbers begin with 1."""
    if not paths:
        return []
    archives = combine_kind(outfile, True, paths[0]) == "untar"
    stem = lambda p: p.rstrip("/").rsplit("/", 1)[-1].split(".", 1)[0]
    todo = [(p, join_path(folder, f"{k}_{stem(p)}"), "untar") if archives else (p, join_path(folder, f"{k}_{outfile}"), "copy") for k, p in enumerate(paths, 1)]
    if whole := [x for x in todo if is_folder(spark, x[0])]:
        for source, to, _ in whole:
            upload(spark, source, to)
        files = [x for x in todo if x not in whole]
        rest = [r.target for r in streams.move(spark, files).collect()] if files else []  # names
        return sorted([x[1] for x in whole] + rest)
    target = {t: i for i, (_, t, _) in enumerate(todo)}
    rows = [r.target for r in streams.move(spark, todo).collect()]  # names
    return sorted(rows, key=lambda t: (target.get(t, target.get(t.rsplit("/", 1)[0], 0)), t))


def distinct_branches(branches: Sequence, key=lambda b: b.fingerprint) -> list:
    """The first of each fingerprint, in order."""
    seen: dict = {}
    for b in branches:
        seen.setdefault(key(b), b)
    return list(seen.values())


def split_numbers(df: DataFrame, splits: int, key: str | None = None) -> DataFrame:
    """df with split_ID 1..splits, by the key's remainder (null: the first) or, without key, by a hash of the whole row; nothing moves."""
    whole = F.xxhash64(*[c for c in df.columns if c != POSITION])
    number = F.pmod(F.col(key) if key else whole, F.lit(splits)) + 1
    return df.withColumn("split_ID", F.coalesce(number, F.lit(1)).cast("int"))


def scatter(df: DataFrame, splits: int, key: str | None = None) -> DataFrame:
    """split_numbers(), each split a partition of its own."""
    return split_numbers(df, splits, key).repartitionById(splits, F.col("split_ID") - 1)


def gather(split: DataFrame) -> DataFrame:
    return split.drop("split_ID")


