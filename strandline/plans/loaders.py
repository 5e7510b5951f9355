"""Parameters, pipelines and settings from files on any Hadoop file system, and the settings that depend on them."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import SparkSession

from strandline.plans.methods import separator
from strandline.plans.params import parse
from strandline.sources.files import exists, join_path, read_bytes


def load_tree(spark: SparkSession, uri: str) -> Any:
    """The parameter tree of a NestedText file; the uri may lead to any file system or object store that Spark knows."""
    return parse(read_bytes(spark, uri).decode("utf-8-sig"))


def pipelines_from(spark: SparkSession, folder: str) -> Callable[[str], Mapping[str, Any]]:
    """A loader for Compiler(load=...): the definition in a file of the folder; FileNotFoundError without one."""

    def load(name: str) -> Mapping[str, Any]:
        path = join_path(folder, name)
        if "/" in name or not exists(spark, path):
            raise FileNotFoundError(path)
        return load_tree(spark, path)

    return load


def read_settings(text: str) -> dict[str, str]:
    """KEY=VALUE lines; empty lines and lines that begin with # are skipped, a value may hold further = signs."""
    out = {}
    for n, line in enumerate(text.splitlines(), 1):
        if not line or line.startswith("#"):
            continue
        key, equals, value = line.partition("=")
        if not equals or not key.strip():
            raise ValueError(f"line {n}: KEY=VALUE was expected")
        out[key.strip()] = value
    return out


@dataclass(frozen=True)
class Context:
    """What depends on launcher settings and global parameters; made once and passed on, nothing is read from the environment."""

    argument_separator: str = " "
    fingerprint_length: int = 12
    upload_to: str | None = None
    settings: Mapping[str, str] = None  # type: ignore[assignment]

    @classmethod
    def of(cls, settings: Mapping[str, str] | None = None, names: Mapping[str, Any] | None = None) -> Context:
        """names: the globals of a parameter tree.  Results go to GCS_path if GCS_output is set and not empty."""
        settings, names = dict(settings or {}), names or {}
        target = names.get("GCS_path") if names.get("GCS_output") else None
        if names.get("GCS_output") and not target:
            raise ValueError("GCS_output is set, GCS_path is not")
        return cls(separator(names.get("custom_argument_seperator")), int(settings.get("HASHLEN") or 12), target, settings)
