"""Compiling pipeline definitions to a graph of nodes: includes, shorthand, shapes, scopes, scans, jobs."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from graphlib import TopologicalSorter
from typing import Any

from strandline.operators.combine import distinct_branches, never_combined
from strandline.plans.fingerprint import fingerprint
from strandline.plans.params import Bound, ParameterError, bind, has_level, list_length, overlay, find_section


class PlanError(ValueError):
    """A pipeline definition that cannot be compiled."""


# ---------------------------------------------------------------- shapes


@dataclass(frozen=True)
class Shape:
    """Components in order, which components each one takes as inputs, and the ports of the final process."""

    components: tuple[str, ...] = ()
    inputs: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def final(self) -> tuple[str, ...]:
        """The last component is port 0."""
        return self.components[::-1]


def _shape(n: int, **inputs: tuple[str, ...]) -> Shape:
    return Shape(tuple(f"c{i}" for i in range(n)), inputs)


#: The edge templates; c0, c1, ... are replaced by the component names that a process declares.
SHAPES: dict[str, Shape] = {
    "NoUpstream": _shape(0),
    "OneUpstream": _shape(1),
    "TwoUpstream": _shape(2, c1=("c0",)),
    "TwoUpstream_noCon": _shape(2),
    "ThreeUpstream": _shape(3, c1=("c0",)),
    "ThreeUpstream_noCon": _shape(3),
    "ThreeUpstream_bothUpTo1": _shape(3, c1=("c0",), c2=("c0",)),
    "FourUpstream_noCon": _shape(4),
    "FiveUpstream_noCon": _shape(5),
}


@dataclass(frozen=True)
class Process:
    """A registered process: fn(inputs, params) -> DataFrame, its usual shape and component names, and its output name."""

    name: str
    fn: Callable[..., Any] | None = None
    shape: str = "NoUpstream"
    upstream: tuple[str, ...] = ()
    outfile: str = "out.csv.gz"
    review: bool = False
    #: Schema of the lines that an external method gives back; its first input's rows are its standard input.
    lines: str | None = None
    #: The column whose remainder deals the first input out where a process runs in splits; without one, a hash of the whole row does.
    split_key: str | None = None
    #: A source of parts: the folder, from the parameters, each of whose files is a part; fn(files, params) reads those given.
    part_folder: Callable[[Mapping[str, Any]], str] | None = None
    #: A process that treats each part of its first input by itself (they differ in the column order.PART), so that changed parts can be made alone.
    by_part: bool = False
    #: A process that takes all points of a scan at once: fn(inputs, points), with a row a point (order.POINT and its parameters as texts),
    #: returns their rows together, told apart by that column.
    points: bool = False
    #: The columns that name a row of a reviewed table; with them, edits are carried on when the input changes.
    review_key: tuple[str, ...] = ()

    @property
    def artifact(self) -> bool:
        """Whether it makes files: fn(inputs, params, folder) writes them and returns a path or several."""
        return never_combined(self.outfile)


class Registry:
    def __init__(self) -> None:
        self.processes: dict[str, Process] = {}
        self.shapes = dict(SHAPES)
        self.methods: dict[tuple[str, str, str], Any] = {}

    def process(self, name: str, shape: str = "NoUpstream", upstream: Sequence[str] = (), outfile: str = "out.csv.gz", review: bool = False, lines: str | None = None, split_key: str | None = None, **traits: Any) -> Callable:
        """traits: further fields of Process."""

        def add(fn: Callable | None) -> Callable | None:
            self.processes[name] = Process(name, fn, shape, tuple(upstream), outfile, review, lines, split_key, **traits)
            return fn

        return add

    def method(self, process: str, method_id: str, version: str = "") -> Callable:
        def add(fn: Any) -> Any:
            self.methods[process, method_id, version] = fn
            return fn

        return add

    def get(self, name: str) -> Process:
        if name not in self.processes:
            raise PlanError(f"no process {name} is registered")
        return self.processes[name]


# ---------------------------------------------------------------- nodes


@dataclass(frozen=True)
class Node:
    """One table or artifact to make.  kind: process, combine, scan, split, gather or job.

    A scan is a process on several points at once; it has the fingerprint of the combine node over a branch for each of them.

    A split is its process on the part-th of `parts` shares of the first input; the gather over all of them has the
    fingerprint of the undivided process, since in how many splits it runs is no part of what it is.
    """

    kind: str
    name: str
    children: tuple[Node, ...]
    fingerprint: str
    bound: Bound | None = None
    outfile: str = ""
    hard_rerun: bool = False
    trim_tree: bool = False
    part: int = 0
    parts: int = 1
    points: tuple[Bound, ...] = ()

    def walk(self) -> Iterator[Node]:
        """This node and all below it, each fingerprint once, inputs first."""
        graph: dict[str, list[str]] = {}
        by: dict[str, Node] = {}
        todo = [self]
        while todo:
            n = todo.pop()
            if n.fingerprint not in by:
                by[n.fingerprint] = n
                graph[n.fingerprint] = [c.fingerprint for c in n.children]
                todo += n.children
        return (by[f] for f in TopologicalSorter(graph).static_order())

    def show(self, depth: int = 0) -> str:
        head = f"{'  ' * depth}{self.name} [{self.kind}] {self.fingerprint[:12]}"
        return "\n".join([head, *(c.show(depth + 1) for c in self.children)])


def process_node(process: Process, bound: Bound, children: Sequence[Node]) -> Node:
    args = bound.arguments
    fp = fingerprint(process.name, [c.fingerprint for c in children], bound.params, (bound.method.id, bound.method.version), args.get("rerun_key"))
    marks = (args.get("hard_rerun") == "y", args.get("trim_tree") == "y")
    parts = int(args.get("splits", "1"))
    if parts < 1:
        raise PlanError(f"{process.name}: splits must be at least 1")
    if parts == 1:
        return Node("process", process.name, tuple(children), fp, bound, process.outfile, *marks)
    if not children:
        raise PlanError(f"{process.name} has no input to split")
    splits = [Node("split", process.name, tuple(children), fingerprint(process.name, [fp], {"split_ID": k, "splits": parts}), bound, process.outfile, *marks, k, parts) for k in range(1, parts + 1)]
    return Node("gather", process.name, tuple(splits), fp, bound, process.outfile, *marks)


def combine_node(branches: Sequence[Node]) -> Node:
    """Distinct branches under one node; a single one is itself the result."""
    own = distinct_branches(branches)
    if len(own) == 1:
        return own[0]
    outfile = own[0].outfile
    return Node("combine", "combine", tuple(own), fingerprint("combine", [b.fingerprint for b in own], {"outfile": outfile, "no_combine": str(never_combined(outfile))}), None, outfile)


# ---------------------------------------------------------------- definitions


def expand_includes(node: Mapping[str, Any], load: Callable[[str], Mapping[str, Any]], seen: tuple[str, ...] = ()) -> dict[str, Any]:
    """pipe_link replaced by the keys of the file it names (the node's own keys win); cycles are refused."""
    out = dict(node)
    while "pipe_link" in out:
        link = out.pop("pipe_link")
        name = link["name"] if isinstance(link, Mapping) else link
        if name in seen:
            raise PlanError(f"pipe_link leads back to {name}")
        seen = (*seen, name)
        out = {**load(name), **out}
    return {k: expand_includes(v, load, seen) if isinstance(v, Mapping) else v for k, v in out.items()}


def desugar(node: Mapping[str, Any], registry: Registry) -> tuple[str, tuple[str, ...], Mapping[str, Any]]:
    """(shape name, component names, body) of a node; 'P.pipe' stands for the shape and components P declares."""
    pipe = node.get("pipe")
    if not isinstance(pipe, str):
        raise PlanError("a pipeline needs 'pipe'")
    body = node.get(pipe, {})
    if pipe.endswith(".pipe"):
        p = registry.get(pipe.removesuffix(".pipe"))
        body = {"process": p.name, **body}
        return p.shape, p.upstream, body
    if pipe not in registry.shapes:
        raise PlanError(f"no shape {pipe}")
    names = registry.processes[body["process"]].upstream if body.get("process") in registry.processes else ()
    need = registry.shapes[pipe].components
    if len(names) != len(need):
        names = tuple(k for k in body if k not in ("process", "drop"))
    return pipe, names, body


@dataclass(frozen=True)
class Scope:
    """Parameters in force, globals, the scan index of each looped process, and those chosen from outside."""

    tree: Mapping[str, Any]
    names: Mapping[str, Any] = field(default_factory=dict)
    index: Mapping[str, int] = field(default_factory=dict)
    no_over: int | None = None


class Compiler:
    """Definitions and parameters to nodes.  Nothing is run and no argument is changed."""

    def __init__(self, registry: Registry, pipelines: Mapping[str, Any] | None = None, jobs: Mapping[str, Sequence[str]] | None = None, load: Callable[[str], Mapping[str, Any]] | None = None) -> None:
        self.registry, self.pipelines, self.jobs = registry, pipelines or {}, jobs or {}
        self.load = load

    # ------------------------------------------------ jobs

    def job_pipelines(self, job: str, path: tuple[str, ...] = ()) -> list[str]:
        """Names of the pipelines of a job, with the jobs in it resolved; sorted, each once."""
        if job in path:
            raise PlanError(f"job {job} contains itself")
        if job not in self.jobs:
            self.pipeline(job)
            return [job]
        return sorted({p for x in self.jobs[job] for p in self.job_pipelines(x, (*path, job))})

    def pipeline(self, name: str) -> Mapping[str, Any]:
        if name in self.pipelines:
            return self.pipelines[name]
        if self.load is not None:
            try:
                return self.load(f"{name}.nt")
            except FileNotFoundError:
                pass
        raise PlanError(f"no pipeline {name}")

    def job(self, job: str, scope: Scope) -> Node:
        roots = [(p, self.compile(self.pipeline(p), scope, p)) for p in self.job_pipelines(job)]
        return Node("job", job, tuple(n for _, n in roots), fingerprint("job", [n.fingerprint for _, n in roots], {"pipes": ",".join(p for p, _ in roots)}))

    # ------------------------------------------------ pipelines

    def compile(self, node: Mapping[str, Any], scope: Scope, name: str = "") -> Node:
        node = expand_includes(node, self.load or _no_files)
        if "pipe" not in node and "process" in node:
            return self._process(node, scope, [])
        if "params_drop" in node:
            scope = replace(scope, tree=overlay(scope.tree, node["params_drop"]))
        elif name and has_level(scope.tree, name) and not find_section({name: scope.tree[name]}, name)[1].get("parameters"):
            scope = replace(scope, tree=overlay(scope.tree, name))
        if "loop_on" in node:
            return self._loop(node, scope)
        return self._shape(node, scope)

    def _shape(self, node: Mapping[str, Any], scope: Scope) -> Node:
        shape_name, names, body = desugar(node, self.registry)
        shape = self.registry.shapes[shape_name]
        if len(names) != len(shape.components):
            raise PlanError(f"{shape_name} has {len(shape.components)} components, {len(names)} are named")
        by = dict(zip(shape.components, names, strict=True))
        made: dict[str, Node | None] = {}
        for c in shape.components:
            inputs = [n for i in shape.inputs.get(c, ()) if (n := made[i]) is not None]
            part = body.get(by[c])
            if part is None and by[c] in self.registry.processes:
                part = {"process": by[c]}
            made[c] = None if part is None else self._component(part, scope, inputs)
        return self._process(body, scope, [n for c in shape.final if (n := made[c]) is not None])

    def _component(self, part: Mapping[str, Any], scope: Scope, inputs: list[Node]) -> Node:
        if "pipe" in part or "pipe_link" in part:
            return self.compile(part, scope)
        return self._process(part, scope, inputs)

    def _process(self, body: Mapping[str, Any], scope: Scope, inputs: Sequence[Node]) -> Node:
        if "process" not in body:
            raise PlanError("a body needs 'process'")
        process = self.registry.get(body["process"])
        tree = overlay(scope.tree, body["drop"]) if "drop" in body else scope.tree
        return process_node(process, bind(tree, process.name, scope.index.get(process.name), scope.names), inputs)

    # ------------------------------------------------ scans

    def _loop(self, node: Mapping[str, Any], scope: Scope) -> Node:
        """One branch per scan point, brought together; indices from outside stay unless a process loops again here."""
        looped = node["loop_on"]
        looped = [looped] if isinstance(looped, str) else list(looped)
        inherited = {} if node.get("reset_loop") == "y" else dict(scope.index)
        inner = {k: v for k, v in node.items() if k not in ("loop_on", "reset_loop", "params_drop")}
        points = [{**inherited, **p} for p in scan_points(scope.tree, looped, scope.no_over)]
        branches = distinct_branches([self._shape(inner, replace(scope, index=p)) for p in points])
        node, first = combine_node(branches), branches[0]
        alike = all(b.kind == "process" and b.name == first.name and b.children == first.children for b in branches)
        marked = any(b.hard_rerun or b.trim_tree for b in branches)
        if len(branches) > 1 and alike and not marked and not never_combined(first.outfile) and self.registry.get(first.name).points:
            return replace(node, kind="scan", name=first.name, children=first.children, points=tuple(b.bound for b in branches))
        return node


def _no_files(name: str) -> Mapping[str, Any]:
    raise FileNotFoundError(name)


def scan_points(tree: Mapping[str, Any], looped: Sequence[str], only: int | None = None) -> list[dict[str, int]]:
    """The product of the index ranges of the looped processes, the last one fastest; `only` restricts each to one index."""
    ranges = []
    for p in looped:
        found = find_section(tree, p)
        n = list_length((found[1].get("parameters") or {}) if found else {})
        if not n:
            raise ParameterError(f"{p} has no list parameter to loop on")
        ranges.append([only] if only is not None else range(n))
    return [dict(zip(looped, x, strict=True)) for x in itertools.product(*ranges)]
