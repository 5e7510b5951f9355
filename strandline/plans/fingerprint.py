"""Content fingerprints of plan nodes: the same inputs, parameters and method give the same name."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from typing import Any


def canonical(value: Any) -> Any:
    """A JSON tree with string leaves; dictionaries are sorted when written."""
    if isinstance(value, Mapping):
        return {str(k): canonical(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [canonical(v) for v in value]
    return None if value is None else str(value)


def fingerprint(op: str, children: Sequence[str] = (), params: Mapping[str, Any] | None = None, method: tuple[str, str] = ("", ""), rerun_key: str | None = None) -> str:
    """sha256 of the canonical description.  Names and values are both part of it; execution arguments are not."""
    tree = {"op": op, "children": list(children), "params": canonical(params or {}), "method": list(method), "rerun_key": canonical(rerun_key)}
    return hashlib.sha256(json.dumps(tree, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()
