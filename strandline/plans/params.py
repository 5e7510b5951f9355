"""Parameters: the NestedText subset that they are written in, scopes, lookup by process, injection of globals.

Everything here is pure: no function changes its arguments.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any


class ParameterError(ValueError):
    """A parameter text or tree that does not follow the rules."""


# ---------------------------------------------------------------- text


def parse(text: str) -> Any:
    """A NestedText document of dictionaries, lists, strings and multi-line strings (> lines); # begins a comment line.

    Values are strings, lists and dictionaries only.  An empty document is an empty dictionary.
    """
    lines = []
    for n, raw in enumerate(text.splitlines(), 1):
        body = raw.lstrip(" ")
        if not body.strip() or body.startswith("#"):
            continue
        if body.startswith("\t"):
            raise ParameterError(f"line {n}: tabs cannot indent")
        lines.append((n, len(raw) - len(body), body.rstrip("\r")))
    if not lines:
        return {}
    value, rest = _block(lines, 0, lines[0][1])
    if rest != len(lines):
        raise ParameterError(f"line {lines[rest][0]}: indentation does not match")
    return value


def _tagged(body: str, tag: str) -> str | None:
    return body[2:] if body.startswith(tag + " ") else "" if body == tag else None


def _block(lines: list[tuple[int, int, str]], i: int, depth: int) -> tuple[Any, int]:
    """The value of the lines from i at this depth, and where it ends."""
    if _tagged(lines[i][2], ">") is not None:
        out = []
        while i < len(lines) and lines[i][1] == depth and (t := _tagged(lines[i][2], ">")) is not None:
            out.append(t)
            i += 1
        return "\n".join(out), i
    is_list = _tagged(lines[i][2], "-") is not None
    items: list[Any] = []
    table: dict[str, Any] = {}
    while i < len(lines) and lines[i][1] >= depth:
        n, d, body = lines[i]
        if d > depth:
            raise ParameterError(f"line {n}: unexpected indentation")
        if is_list:
            key, value = "", _tagged(body, "-")
            if value is None:
                raise ParameterError(f"line {n}: a list item was expected")
        else:
            key, colon, value = body.partition(": ")
            if not colon:
                if not body.endswith(":"):
                    raise ParameterError(f"line {n}: 'key: value' was expected")
                key, value = body[:-1], ""
            key = key.strip()
            if key in table:
                raise ParameterError(f"line {n}: {key} stands twice")
        i += 1
        if value == "" and i < len(lines) and lines[i][1] > depth:
            value, i = _block(lines, i, lines[i][1])
        if is_list:
            items.append(value)
        else:
            table[key] = value
    return (items if is_list else table), i


def dump(value: Any, indent: int = 0) -> str:
    """A tree as NestedText that parse() reads back."""
    pad = " " * indent
    if isinstance(value, str):
        return "\n".join(f"{pad}> {x}" if x else f"{pad}>" for x in value.split("\n"))
    pairs = [("-", v) for v in value] if isinstance(value, (list, tuple)) else [(f"{k}:", v) for k, v in value.items()]
    out = []
    for tag, v in pairs:
        if isinstance(v, str) and "\n" not in v:
            out.append(f"{pad}{tag} {v}".rstrip() if not v else f"{pad}{tag} {v}")
        elif not v and not isinstance(v, str):
            raise ParameterError("empty dictionaries and lists cannot be written")
        else:
            out += [f"{pad}{tag}", dump(v, indent + 4)]
    return "\n".join(out)


# ---------------------------------------------------------------- scopes


def overlay(tree: Mapping[str, Any], levels: str) -> dict[str, Any]:
    """The tree with one or several nested levels ('a' or 'a-b', from the outside in) laid over it.

    A level stays reachable by its name.  Keys that hold a dash cannot be told from a chain and are refused.
    """
    out = dict(tree)
    for level in levels.split("-"):
        if bad := [k for k in out if "-" in k]:
            raise ParameterError(f"keys cannot hold '-': {', '.join(bad)}")
        inner = out.get(level)
        if not isinstance(inner, Mapping):
            raise ParameterError(f"there is no level {level}")
        out |= inner
    return out


def has_level(tree: Mapping[str, Any], level: str) -> bool:
    return isinstance(tree.get(level), Mapping)


# ---------------------------------------------------------------- binding a process


@dataclass(frozen=True)
class Method:
    id: str = ""
    version: str = ""


@dataclass(frozen=True)
class Bound:
    """What a process runs with.  params and method make its identity; arguments do not."""

    process: str
    section: str
    params: Mapping[str, Any] = field(default_factory=dict)
    arguments: Mapping[str, str] = field(default_factory=dict)
    descriptors: Mapping[str, str] = field(default_factory=dict)
    method: Method = Method()


def find_section(tree: Mapping[str, Any], process: str) -> tuple[str, Mapping[str, Any]] | None:
    """(name, section) for a process: its own name, else the first key with * whose text before the * occurs in the name."""
    if isinstance(tree.get(process), Mapping):
        return process, tree[process]
    stems = [k for k in tree if "*" in k and k.split("*", 1)[0] in process and isinstance(tree[k], Mapping)]
    if len(stems) > 1:
        warnings.warn(f"{process} matches {', '.join(stems)}; {stems[0]} is taken", stacklevel=2)
    return (stems[0].split("*", 1)[0], tree[stems[0]]) if stems else None


def inject(value: Any, names: Mapping[str, Any]) -> Any:
    """[name] replaced by the global of that name, again and again; a cycle is an error, an unknown name too."""
    seen: list[str] = []
    while isinstance(value, str) and len(value) > 2 and value.startswith("[") and value.endswith("]"):
        name = value[1:-1]
        if name in seen:
            raise ParameterError(f"globals refer to each other: {' -> '.join([*seen, name])}")
        if name not in names:
            raise ParameterError(f"there is no global {name}")
        seen.append(name)
        value = names[name]
    return value


def list_length(params: Mapping[str, Any]) -> int:
    """How many points a scan over these parameters has: the length of the last list among them; 0 without one."""
    return next((len(v) for v in reversed(list(params.values())) if isinstance(v, (list, tuple))), 0)


def at_index(value: Any, index: int | None) -> Any:
    """A list parameter at a scan point: the index-th of its sorted values; all of them, joined by commas, without one."""
    if not isinstance(value, (list, tuple)):
        return value
    ranked = sorted(map(str, value))
    if index is None:
        return ",".join(ranked)
    if not 0 <= index < len(ranked):
        raise ParameterError(f"no value number {index} among {len(ranked)}")
    return ranked[index]


def bind(tree: Mapping[str, Any], process: str, index: int | None = None, names: Mapping[str, Any] | None = None) -> Bound:
    """Parameters, arguments and method of a process in a scope."""
    found = find_section(tree, process)
    if found is None:
        return Bound(process, process)
    section, body = found
    names = names or {}
    text = lambda v: v.replace("\r", "").replace("\n", "") if isinstance(v, str) else v
    params = {k: text(inject(at_index(v, index), names)) for k, v in sorted((body.get("parameters") or {}).items())}
    arguments = {k: text(inject(v, names)) for k, v in sorted((body.get("arguments") or {}).items())}
    descriptors = dict(body.get("descriptors") or {})
    method = Method()
    if "no_method" not in (descriptors.get("runtype", ""), *params) and "methodID" in params:
        method = Method(params.pop("methodID"), params.pop("methodvers", ""))
    params.pop("no_method", None)
    arguments.setdefault("splits", "1")
    return Bound(process, section, params, arguments, descriptors, method)


def parameter_names(bound: Bound) -> str:
    """The sorted names of the parameters (method keys left out), joined by blanks."""
    return " ".join(sorted(bound.params))
