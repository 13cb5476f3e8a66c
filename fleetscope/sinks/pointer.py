"""Which folder holds a table's files: the pointer of versioned tables."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from fleetscope.sinks import storage

POINTER, VERSIONS = "_current", "_versions"


def versions(spark: SparkSession, path: str) -> list[dict]:
    """number, folder and rows of the versions that can be read, latest last.
    A table without versions has none."""
    text = storage.read_file(spark, f"{path.rstrip('/')}/{POINTER}")
    return [] if text is None else json.loads(text)["versions"]


def resolve(spark: SparkSession, path: str, version: int | None = None) -> str:
    """The folder that holds the table's files now, or held a given version.

    A table that isn't versioned is its own folder; while its replacement is cut
    short between two renames, that is the old one."""
    path = path.rstrip("/")
    known = versions(spark, path)
    if version is not None:
        known = [v for v in known if v["number"] == version]
        if not known:
            raise ValueError(f"{path}: there is no version {version}")
    if known:
        return f"{path}/{VERSIONS}/{known[-1]['folder']}"
    return storage.aside(spark, path) or path
