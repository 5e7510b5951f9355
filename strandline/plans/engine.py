"""Incremental execution: nodes are made once, kept by fingerprint, reused, invalidated and exported."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strandline.functions.shared import scratch, shared_dir
from strandline.operators.combine import collect_artifacts, combine_file_groups, combine_kind, combine_points, combine_selections, gather, never_combined, split_numbers, union_by_name, union_in_order
from strandline.operators.model import all_at_once
from strandline.operators.review import merge_edits
from strandline.plans.fingerprint import fingerprint
from strandline.plans.graph import Node, PlanError, Process, Registry
from strandline.plans.loaders import Context
from strandline.plans.methods import command, run_lines
from strandline.plans.params import Bound, dump
from strandline.sources.files import create_if_absent, delete, exists, export, file_states, folder_states, join_path, read_bytes, rename, upload, write_bytes, write_csv
from strandline.sources.order import PART, POINT, POSITION, from_files, in_order, plain


class Store:
    """Tables by fingerprint below one folder: cache/<fingerprint>/data-*, and manifest.json which says what is complete.

    Rows keep the order in which they were written: a table that has positions keeps them as a column, one that has none is read
    back with the place of each row in its files.

    A table counts as made once its manifest stands; that is written last, so half-made tables are never read.
    """

    def __init__(self, spark: SparkSession, root: str, patience: float = 60.0) -> None:
        """patience: seconds to wait for another driver that is about to publish."""
        self.spark, self.root, self.patience = spark, root, patience

    def folder(self, fp: str) -> str:
        return join_path(self.root, "cache", fp)

    def entry(self, fp: str) -> dict[str, Any] | None:
        path = join_path(self.folder(fp), "manifest.json")
        return json.loads(read_bytes(self.spark, path)) if exists(self.spark, path) else None

    def has(self, fp: str) -> bool:
        return exists(self.spark, join_path(self.folder(fp), "manifest.json"))

    def put(self, node: Node, df: DataFrame, state: str | None = None) -> DataFrame:
        path = join_path(self.folder(node.fingerprint), f"data-{uuid.uuid4().hex[:8]}")
        df.write.parquet(path)
        out = from_files(self.spark.read.schema(df.schema).parquet(path), row_index=True)
        self._seal({"fingerprint": node.fingerprint, "op": node.name, "children": [c.fingerprint for c in node.children], "path": path, "rows": out.count(), "state": state})
        return self.get(node.fingerprint)

    def _seal(self, entry: dict[str, Any]) -> None:
        """Publishes what was made.  Of several drivers that make the same at once one publishes; the others drop theirs and take that."""
        folder = self.folder(entry["fingerprint"])
        place, claim, own = (join_path(folder, x) for x in ("manifest.json", "claim", f"manifest-{uuid.uuid4().hex}"))
        write_bytes(self.spark, own, json.dumps(entry).encode())
        waited = 0.0
        while not create_if_absent(self.spark, claim):
            time.sleep(0.1)
            waited += 0.1
            if waited > self.patience:  # whoever held it is gone
                delete(self.spark, claim)
        try:
            there = self.entry(entry["fingerprint"])
            if there is not None and there.get("state") == entry["state"] and there.get("parts") is None and entry.get("parts") is None:
                delete(self.spark, own)
                delete(self.spark, entry["path"])
            else:
                rename(self.spark, own, place)
        finally:
            delete(self.spark, claim)

    def sweep(self, roots: Iterable[Node], grace_s: float = 3600.0) -> list[str]:
        """Deletes what none of the plans `roots` can use: tables of other fingerprints, and data that no manifest names (of runs that failed).  Folders
        changed less than grace_s ago stay, as a run may be at work in them.  The paths that went."""
        keep = {n.fingerprint for r in roots for n in r.walk()}
        now, gone = time.time() * 1000, []
        for fp, changed in folder_states(self.spark, join_path(self.root, "cache")):
            entry = self.entry(fp)
            if fp not in keep:
                old = max([changed, *[t for _, t in folder_states(self.spark, self.folder(fp))]])
                if now - old >= grace_s * 1000:
                    gone.append(self.folder(fp))
                continue
            named = [entry["path"], *[x["path"] for x in (entry.get("parts") or {}).values()]] if entry else []
            for name, t in folder_states(self.spark, self.folder(fp)):
                path = join_path(self.folder(fp), name)
                used = any(x and (x == path or x.startswith(path + "/")) for x in named) or name.startswith("files-")
                if not used and now - t >= grace_s * 1000:
                    gone.append(path)
        for path in gone:
            delete(self.spark, path)
        return gone

    def put_parts(self, node: Node, df: DataFrame | None, made: Mapping[str, str], parts: Mapping[str, str], state: str) -> DataFrame:
        """Replaces the parts `made` (name: identity) by the rows of df, which order.PART tells apart, and keeps the others that `parts` still
        names.  The new parts are one job and one folder each; the manifest that names them is written last, then the old ones go."""
        old = self.entry(node.fingerprint) or {}
        paths, schema = {p: x for p, x in old.get("parts", {}).items() if p in parts and p not in made}, old.get("schema")
        if made:
            path = join_path(self.folder(node.fingerprint), f"data-{uuid.uuid4().hex[:8]}")
            df.withColumn("__dir", F.sha2(PART, 256)).write.partitionBy("__dir").parquet(path)
            schema = df.schema.json()
            for p, identity in made.items():
                place = join_path(path, f"__dir={hashlib.sha256(p.encode()).hexdigest()}")
                paths[p] = {"id": identity, "path": place if exists(self.spark, place) else None}
        self._seal({"fingerprint": node.fingerprint, "op": node.name, "children": [c.fingerprint for c in node.children], "path": None, "parts": paths, "schema": schema, "state": state})
        for p, x in old.get("parts", {}).items():
            if x["path"] and paths.get(p) != x:
                delete(self.spark, x["path"])
        return self.get(node.fingerprint)

    def get(self, fp: str) -> DataFrame:
        entry = self.entry(fp)
        if entry.get("parts") is None:
            return from_files(self.spark.read.parquet(entry["path"]), row_index=True)
        schema = StructType.fromJson(json.loads(entry["schema"]))
        paths = [x["path"] for _, x in sorted(entry["parts"].items()) if x["path"]]
        return from_files(self.spark.read.schema(schema).parquet(*paths), row_index=True) if paths else self.spark.createDataFrame([], schema)

    def drop(self, fps: Iterable[str]) -> None:
        for fp in fps:
            delete(self.spark, self.folder(fp))


@dataclass(frozen=True)
class PendingReview:
    """A table that waits for a person: where it lies, and where the edited one is expected."""

    fingerprint: str
    path: str
    replacement: str
    #: Where rows stand that were edited before and are now proposed otherwise, if there are any.
    conflicts: str | None = None
    slot: str | None = None


class ReviewPending(RuntimeError):
    def __init__(self, pending: PendingReview) -> None:
        super().__init__(f"review {pending.path} and accept a replacement for {pending.fingerprint[:12]}")
        self.pending = pending


@dataclass
class Run:
    made: list[str] = field(default_factory=list)
    reused: list[str] = field(default_factory=list)
    outputs: dict[str, str] = field(default_factory=dict)
    #: Of each process whose table is kept part by part: which parts were made, kept and dropped.
    parts: dict[str, dict[str, list[str]]] = field(default_factory=dict)


def ancestors(node: Node) -> set[str]:
    """Fingerprints of everything a node is made from."""
    return {n.fingerprint for n in node.walk()} - {node.fingerprint}


def descendants(root: Node, fp: str) -> set[str]:
    """Fingerprints below root that are made, directly or not, from fp."""
    out: set[str] = set()
    for n in root.walk():  # inputs first
        if any(c.fingerprint == fp or c.fingerprint in out for c in n.children):
            out.add(n.fingerprint)
    return out


class Engine:
    """methods_root: the folder of external methods, as the executors see it.

    Process functions get their inputs with positions where those are known (order.POSITION); what they return keeps its order as long as
    that column stays, and else has the order in which Spark delivers its rows.
    """

    def __init__(self, spark: SparkSession, registry: Registry, root: str, methods_root: str | None = None, context: Context | None = None) -> None:
        self.spark, self.registry, self.store = spark, registry, Store(spark, root)
        self.methods_root, self.context = methods_root, context or Context()
        self._shares: dict[tuple, tuple[str, DataFrame]] = {}
        self._ids: dict[str, dict[str, str]] = {}

    def explain(self, root: Node) -> str:
        """The graph with what is already there."""
        self._ids.clear()
        mark = {n.fingerprint[:12]: "kept" if self._kept(n) else "to make" for n in root.walk()}
        return "\n".join(f"{line} {mark[line.rsplit(' ', 1)[1]]}" for line in root.show().splitlines())

    def invalidate(self, root: Node) -> None:
        """hard_rerun drops a node and what depends on it, trim_tree a node and what it is made from."""
        for n in root.walk():
            if n.hard_rerun:
                self.store.drop({n.fingerprint} | descendants(root, n.fingerprint))
            if n.trim_tree:
                self.store.drop({n.fingerprint} | ancestors(n))

    def run(self, root: Node, export: bool = False, definition: Mapping[str, Any] | None = None) -> Run:
        """_run(), after which the operators' intermediate tables are deleted: all that was asked for stands in the store by then."""
        with scratch():
            return self._run(root, export, definition)

    def _run(self, root: Node, export: bool, definition: Mapping[str, Any] | None) -> Run:
        """Makes what is missing, inputs first.  export also writes the job's tables and files and a manifest to
        outputs/<job>/<fingerprint>, and from there to the context's upload folder if it has one."""
        self.invalidate(root)
        self._ids.clear()
        run = Run()
        used: dict[str, int] = {}
        for n in root.walk():
            for c in n.children:
                used[c.fingerprint] = used.get(c.fingerprint, 0) + 1
        lazy: dict[str, DataFrame] = {}
        need = self._needed(root)
        ends = {c.fingerprint for c in root.children} if root.kind == "job" else {root.fingerprint}
        # an external method reads its further inputs where they lie
        ends |= {c.fingerprint for n in root.walk() if self._external(n) for c in n.children[1:]}
        order, ready = list(root.walk()), {}
        for n in order:
            if n.kind == "job" or n.fingerprint not in need:
                continue
            if self._kept(n):
                lazy[n.fingerprint] = self.store.get(n.fingerprint)
                run.reused.append(n.fingerprint)
                continue
            if self._part_wise(n):
                lazy[n.fingerprint] = self._remake(n, lazy, run)
                run.made.append(n.fingerprint)
                continue
            df = ready.pop(n.fingerprint, None)
            if df is None and self._makes_files(n):
                # files are made at once; those of other points of a scan on the same inputs are made together with these
                alike = [m for m in order if m.fingerprint in need and self._makes_files(m) and m.name == n.name and m.children == n.children and not self._kept(m)]
                inputs = [lazy[c.fingerprint] for c in n.children]
                ready |= dict(zip([m.fingerprint for m in alike], all_at_once([partial(self._build, m, inputs) for m in alike]), strict=True))
                df = ready.pop(n.fingerprint)
            if df is None:
                df = self._build(n, [lazy[c.fingerprint] for c in n.children])
            # cheap chains stay one Spark plan; tables are written where they end, fan out or wait for someone
            lazy[n.fingerprint] = self.store.put(n, df, self._state(n)) if n.fingerprint in ends or used.get(n.fingerprint, 0) > 1 or self._is_review(n) or never_combined(n.outfile) else df
            run.made.append(n.fingerprint)
        # the gathered table is written by now, nothing reads the shares any more
        while self._shares:
            delete(self.spark, self._shares.popitem()[1][0])
        for n in root.children if root.kind == "job" else (root,):
            run.outputs[n.name] = self.store.entry(n.fingerprint)["path"] or self.store.folder(n.fingerprint)
        if export:
            self._export(root, run, definition)
        return run

    def result(self, node: Node) -> DataFrame:
        """A node's table, without positions."""
        return plain(self.store.get(node.fingerprint))

    def _needed(self, root: Node) -> set[str]:
        """Nodes that must be read or made: nothing below a table that is kept."""
        out: set[str] = set()
        todo = [root]
        while todo:
            n = todo.pop()
            if n.fingerprint not in out:
                out.add(n.fingerprint)
                if not self._kept(n):
                    todo += n.children
        return out

    # ------------------------------------------------ tables that are kept part by part

    def _part_wise(self, n: Node) -> bool:
        if n.kind != "process" or n.bound is None:
            return False
        p = self.registry.get(n.name)
        return p.part_folder is not None or (p.by_part and bool(n.children) and self._part_wise(n.children[0]))

    def _part_ids(self, n: Node) -> dict[str, str]:
        """name: identity of each part as it is now: of a file its length and time, of what is made from one its identity and all else that goes in."""
        if n.fingerprint not in self._ids:
            p = self.registry.get(n.name)
            if p.part_folder is not None:
                folder = p.part_folder(n.bound.params)
                self._ids[n.fingerprint] = {name: f"{size}-{time}" for name, size, time in file_states(self.spark, folder)}
            else:
                others = [self._state(c) for c in n.children[1:]]
                self._ids[n.fingerprint] = {name: fingerprint(n.fingerprint, [x, *map(str, others)]) for name, x in self._part_ids(n.children[0]).items()}
        return self._ids[n.fingerprint]

    def _state(self, n: Node) -> str | None:
        """What n would be made from now, where parts are among it; None where the fingerprint says it all."""
        if self._part_wise(n):
            return fingerprint("parts", [f"{k}={v}" for k, v in sorted(self._part_ids(n).items())])
        below = [self._state(c) for c in n.children]
        return fingerprint("state", [str(x) for x in below]) if any(below) else None

    def _kept(self, n: Node) -> bool:
        entry = self.store.entry(n.fingerprint)
        return entry is not None and entry.get("state") == self._state(n)

    def _remake(self, n: Node, lazy: dict[str, DataFrame], run: Run) -> DataFrame:
        """The parts of n that are new or changed, in one job; those that are gone go."""
        process, now = self.registry.get(n.name), self._part_ids(n)
        old = (self.store.entry(n.fingerprint) or {}).get("parts") or {}
        made = {p: x for p, x in now.items() if p not in old or old[p]["id"] != x}
        run.parts[n.name] = {"made": sorted(made), "kept": sorted(set(now) - set(made)), "gone": sorted(set(old) - set(now))}
        df = None
        if made and process.part_folder is not None:
            folder = process.part_folder(n.bound.params)
            df = process.fn([join_path(folder, p) for p in sorted(made)], dict(n.bound.params))
            df = df if PART in df.columns else from_files(df).withColumn(PART, F.element_at(POSITION, 3))
        elif made:
            mine = [c.fingerprint for c in n.children]
            some = lazy[mine[0]] if set(made) == set(now) else lazy[mine[0]].where(F.col(PART).isin(*made))
            df = self._build(n, [some, *[lazy[f] for f in mine[1:]]])
            if PART not in df.columns:
                raise PlanError(f"{n.name} works by part, but its rows do not say of which")
        return self.store.put_parts(n, df, made, now, self._state(n))

    def _makes_files(self, n: Node) -> bool:
        return n.kind == "process" and never_combined(n.outfile) and not self._is_review(n)

    def _is_review(self, n: Node) -> bool:
        return n.kind == "process" and self.registry.get(n.name).review

    def _build(self, n: Node, inputs: list[DataFrame]) -> DataFrame:
        if n.kind == "combine":
            if never_combined(n.outfile):
                paths = [r.path for x in inputs for r in x.collect()]  # a row a file
                return self._files(collect_artifacts(self.spark, paths, join_path(self.store.folder(n.fingerprint), f"files-{uuid.uuid4().hex[:8]}"), n.outfile))
            kind = combine_kind(n.outfile, False)
            if kind == "selections":
                return combine_selections(inputs)
            if kind == "file_group":
                return combine_file_groups(inputs)
            return union_in_order(inputs)
        process = self.registry.get(n.name)
        if n.kind == "scan":
            return combine_points(process.fn(inputs, self._points(n.points)), combine_kind(n.outfile, False))
        if process.points and n.kind == "process":
            return process.fn(inputs, self._points((n.bound,))).drop(POINT)
        if n.kind == "gather":
            return union_by_name(inputs, None)
        if n.kind == "split":
            inputs = [gather(self._dealt(n, inputs[0], process.split_key).where(F.col("split_ID") == n.part)), *inputs[1:]]
        if process.review:
            return self._review(n, inputs)
        fn = process.fn
        if n.bound.method.id:
            fn = self.registry.methods.get((n.bound.section, n.bound.method.id, n.bound.method.version), fn)
        if fn is None:
            return self._call(n, process, inputs)
        if process.artifact:
            folder = join_path(self.store.folder(n.fingerprint), f"files-{uuid.uuid4().hex[:8]}")
            made = fn(inputs, dict(n.bound.params), folder)
            return self._files([made] if isinstance(made, str) else list(made))
        return fn(inputs, dict(n.bound.params))

    def _points(self, bounds: Sequence[Bound]) -> DataFrame:
        """The points of a scan as a process takes them: a row each, with its number and its parameters as texts."""
        names = sorted({k for b in bounds for k in b.params})
        rows = [(i, *[None if b.params.get(k) is None else str(b.params[k]) for k in names]) for i, b in enumerate(bounds)]
        return self.spark.createDataFrame(rows, ", ".join([f"{POINT} int", *(f"`{k}` string" for k in names)]))

    def _dealt(self, n: Node, df: DataFrame, key: str | None) -> DataFrame:
        """The input of all splits of a process, read and dealt out once: written by split, so that each reads its own files alone, as
        many tasks as these have."""
        name = (n.children[0].fingerprint, n.parts, key)
        if name not in self._shares:
            path = f"{shared_dir(self.spark)}/shares-{uuid.uuid4().hex}"
            split = split_numbers(df, n.parts, key)
            split.write.partitionBy("split_ID").parquet(path)
            self._shares[name] = (path, self.spark.read.schema(split.schema).parquet(path))
        return self._shares[name][1]

    def _files(self, paths: list[str]) -> DataFrame:
        """An artifact as others take it: a row a file."""
        return self.spark.createDataFrame([(p,) for p in paths], "path string")

    def _external(self, n: Node) -> bool:
        if n.kind not in ("process", "split") or n.bound is None or not n.bound.method.id:
            return False
        process = self.registry.get(n.name)
        return process.fn is None and process.lines is not None and (n.bound.section, n.bound.method.id, n.bound.method.version) not in self.registry.methods

    def _call(self, n: Node, process: Process, inputs: list[DataFrame]) -> DataFrame:
        """The program of the process's method on the rows of its first input.  Its arguments are the tables of the further
        inputs and then the parameters' values in the order of their names."""
        if not self._external(n) or not inputs:
            raise PlanError(f"{n.name} has no function and no external method to run")
        if self.methods_root is None:
            raise PlanError(f"{n.name} runs an external method, the engine has no methods_root")
        tables = [self.store.entry(c.fingerprint)["path"] for c in n.children[1:]]
        values = [str(v) for _, v in sorted(n.bound.params.items())]
        return run_lines(plain(inputs[0]), command(self.methods_root, n.bound, [*tables, *values], self.context.argument_separator), process.lines, cpus=int(n.bound.arguments.get("cpu") or 0) or None, limit_s=float(n.bound.arguments.get("time_limit") or 0) or None)

    def _review(self, n: Node, inputs: list[DataFrame]) -> DataFrame:
        """The accepted replacement of the input; without one the run stops here with what is to be reviewed."""
        place = join_path(self.store.root, "review", n.fingerprint)
        replacement = join_path(place, "accepted")
        if exists(self.spark, join_path(replacement, "_SUCCESS")):
            return from_files(self.spark.read.parquet(replacement), row_index=True)
        shown, plainly = join_path(place, "proposed"), plain(inputs[0])
        in_order(inputs[0]).write.mode("overwrite").parquet(shown)
        keys = self.registry.get(n.name).review_key
        slot = join_path(self.store.root, "review", "slots", fingerprint(n.name, [], n.bound.params, (n.bound.method.id, n.bound.method.version)))
        if not keys or not exists(self.spark, join_path(slot, "last.json")):
            raise ReviewPending(PendingReview(n.fingerprint, shown, replacement, None, slot if keys else None))
        last = json.loads(read_bytes(self.spark, join_path(slot, "last.json")))
        merged, conflicts = merge_edits(*(self.spark.read.parquet(last[k]) for k in ("proposed", "accepted")), plainly, keys)
        paths = [join_path(place, x) for x in ("merged", "conflicts")]
        for df, path in zip((merged, conflicts), paths, strict=True):
            df.write.mode("overwrite").parquet(path)
        found = paths[1] if self.spark.read.schema(conflicts.schema).parquet(paths[1]).limit(1).count() else None
        raise ReviewPending(PendingReview(n.fingerprint, paths[0], replacement, found, slot))

    def accept(self, pending: PendingReview, edited: DataFrame | None = None) -> None:
        """The reviewed table; without one, what was shown.  It is what edits are carried on from when the input changes."""
        (self.spark.read.parquet(pending.path) if edited is None else edited).write.mode("overwrite").parquet(pending.replacement)
        if pending.slot:
            proposed = join_path(pending.replacement.rsplit("/", 1)[0], "proposed")
            write_bytes(self.spark, join_path(pending.slot, "last.json"), json.dumps({"proposed": proposed, "accepted": pending.replacement}).encode())

    def _export(self, root: Node, run: Run, definition: Mapping[str, Any] | None) -> None:
        folder = join_path(self.store.root, "outputs", root.name, root.fingerprint)
        lines = {}
        artifacts = {n.name for n in (root.children if root.kind == "job" else (root,)) if never_combined(n.outfile)}
        by_name = {n.name: n.fingerprint for n in (root.children if root.kind == "job" else (root,))}
        for name, path in run.outputs.items():
            target = join_path(folder, name)
            if name in artifacts:
                for r in self.spark.read.parquet(path).collect():  # a row a file
                    export(self.spark, r.path, target)
            else:
                write_csv(self.store.get(by_name[name]).drop(PART), target)
            lines[name] = path
        write_bytes(self.spark, join_path(folder, "manifest.json"), json.dumps([{"pipe": k, "path": v} for k, v in sorted(lines.items())]).encode())
        if definition:
            write_bytes(self.spark, join_path(folder, "parameters_archive.nt"), dump(definition).encode())
        if self.context.upload_to:
            upload(self.spark, folder, self.context.upload_to)
