"""Methods outside the engine: what command a process runs, and running it over a DataFrame's partitions."""

from __future__ import annotations

import re
import subprocess
import tempfile
import threading
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.resource import ResourceProfile, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.plans.params import Bound

#: Program and file ending of each language that a descriptor can name.
LANGUAGES = {"R": (["Rscript"], ".R"), "Python": (["python"], ".py"), "MATLAB": (["matlab", "-batch"], ".m"), "batch": ([], ".bat")}
#: How a field stands on a line: a missing value, and characters that would end the field or the line.
NULL = r"\N"
ESCAPES = {"\\": "\\\\", "\n": r"\n", "\r": r"\r", "\t": r"\t"}
ROWS = 10_000


class MethodError(ValueError):
    pass


def separator(setting: str | None) -> str:
    """The argument separator: one blank, or what stands between single quotes."""
    if setting is None:
        return " "
    if len(setting) < 2 or setting[0] != "'" or setting[-1] != "'":
        raise MethodError("a custom argument separator stands between single quotes")
    return setting[1:-1]


def method_path(root: str, bound: Bound) -> str:
    """methods/<process>/<method>/<method>-<version><ending>; binaries have neither dash nor ending."""
    d, m = bound.descriptors, bound.method
    if d.get("runtype") == "bin":
        return f"{root}/methods/{bound.section}/{m.id}/{m.id}{m.version}"
    language = d.get("language", "Python")
    if language not in LANGUAGES:
        raise MethodError(f"unknown language {language}")
    return f"{root}/methods/{bound.section}/{m.id}/{m.id}-{m.version}{LANGUAGES[language][1]}"


def command(root: str, bound: Bound, arguments: Sequence[str], sep: str = " ") -> list[str]:
    """The argument list of a method call; no shell is involved.

    wrapper: the process's wrapper is run, with the project root first among its arguments.  venv 'conda' runs the program
    in the environment venv_name; pass_sub_to_wrapper appends the direct call for the wrapper to make.
    """
    d = bound.descriptors
    program, ending = LANGUAGES.get(d.get("language", "Python"), ([], "")) if d.get("runtype") != "bin" else ([], "")
    args = list(arguments) if sep == " " else [sep.join(arguments)]
    direct = [*program, method_path(root, bound), *args]
    out = direct
    if d.get("wrapper") == "True":
        out = [*program, f"{root}/methods/{bound.section}/{bound.section}Wrapper{ending}", root, *args]
    if d.get("venv") == "conda":
        env = ["conda", "run", "-n", d.get("venv_name", "base")]
        out = [*env, *out]
        if d.get("pass_sub_to_wrapper") == "True":
            out += direct
    return out


def to_line(fields: Sequence[str | None], sep: str = "\t") -> str:
    escapes = str.maketrans(ESCAPES | ({sep: r"\s"} if sep != "\t" else {}))
    return sep.join(NULL if x is None else x.translate(escapes) for x in fields)


def from_line(line: str, sep: str = "\t") -> list[str | None]:
    plain = {v[1]: k for k, v in ESCAPES.items()} | {"s": sep}
    return [None if x == NULL else re.sub(r"\\(.)", lambda m: plain.get(m[1], m[0]), x) for x in line.split(sep)]


def profile_of(spark: SparkSession, cpus: int | None) -> ResourceProfile | None:
    """A stage's demand of cores a task; None where there is none or where cores are not dealt out by profile (a local master)."""
    if not cpus or spark.sparkContext.master.startswith("local"):
        return None
    return ResourceProfileBuilder().require(TaskResourceRequests().cpus(cpus)).build


def run_lines(df: DataFrame, argv: Sequence[str], schema: str, sep: str = "\t", env: Mapping[str, str] | None = None, cpus: int | None = None, limit_s: float | None = None) -> DataFrame:
    r"""Each partition's rows as separated lines to a program's standard input, its output lines as rows of `schema`.

    One program runs per partition that has rows; lines stream through it both ways.  Values are Spark's own texts of
    them; \ before \, n, r, t (and s for another separator) stands for the character, \N alone for a missing value, in both
    directions.  A program that fails, or a line with another number of fields, makes the task fail, with the end of what
    the program wrote to standard error.  cpus: cores that a task of this stage has (on a cluster; a local one has its own).  A program that takes
    more than limit_s seconds is ended and its task fails; Spark starts a failed task, and with it the program, again as often as it is set to.
    """
    if len(sep) != 1 or sep.isalnum() or sep in "\\\n\r":
        raise MethodError("a separator is one character, and no letter, digit, backslash or line end")
    fields = T._parse_datatype_string(schema).fields
    texts = pa.schema([(f.name, pa.string()) for f in fields])

    def rows(lines: list[str]) -> pa.RecordBatch:
        split = [from_line(x, sep) for x in lines]
        if bad := next((x for x in split if len(x) != len(fields)), None):
            raise RuntimeError(f"{argv[0]} gave a line of {len(bad)} fields instead of {len(fields)}")
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*split, strict=True)], schema=texts)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((rb for rb in it if rb.num_rows), None)
        if first is None:
            return
        trouble: list[BaseException] = []
        with tempfile.TemporaryFile() as said:
            program = subprocess.Popen(list(argv), stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=said, env=dict(env) if env else None)

            def feed() -> None:
                try:
                    with program.stdin as to:
                        rb: pa.RecordBatch | None = first
                        while rb is not None:
                            to.writelines((to_line(x, sep) + "\n").encode() for x in zip(*(c.to_pylist() for c in rb.columns), strict=True))
                            rb = next(it, None)
                except BrokenPipeError:
                    pass  # a program may stop reading; its return code decides
                except BaseException as e:  # noqa: BLE001  raised again by the task
                    trouble.append(e)

            feeder = threading.Thread(target=feed, daemon=True)
            feeder.start()
            late = threading.Event()
            clock = threading.Timer(limit_s, lambda: (late.set(), program.kill())) if limit_s else None
            if clock:
                clock.daemon = True
                clock.start()
            try:
                held: list[str] = []
                for line in program.stdout:
                    held.append(line.removesuffix(b"\n").decode())
                    if len(held) == ROWS:
                        yield rows(held)
                        held = []
                if held:
                    yield rows(held)
                feeder.join()
                if trouble:
                    raise trouble[0]
                code = program.wait()
                if late.is_set():
                    raise RuntimeError(f"{argv[0]} took more than {limit_s:g} seconds and was ended")
                if code:
                    said.seek(max(0, said.seek(0, 2) - 500))
                    raise RuntimeError(f"{argv[0]} ended with {code}: {said.read().decode(errors='replace')}")
            except Exception:
                if late.is_set():
                    raise RuntimeError(f"{argv[0]} took more than {limit_s:g} seconds and was ended") from None
                raise
            finally:
                if clock:
                    clock.cancel()
                if program.poll() is None:
                    program.kill()
                program.stdout.close()
                program.wait()

    strings = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    out = strings.mapInArrow(run, ", ".join(f"`{f.name}` string" for f in fields), profile=profile_of(df.sparkSession, cpus))
    return out.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields])
