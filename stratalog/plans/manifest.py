"""Versioned manifests: which files make up a stored structure, committed by a rename after the files are written.

A writer that dies before the rename leaves the last version in force, and readers of an older version keep theirs.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def versions(spark: SparkSession, root: str) -> list[int]:
    """The committed versions below `root`, oldest first; none where the folder does not exist."""
    fs, path = _fs(spark, root)
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n[9:-5]) for n in names if n.startswith("manifest-") and n.endswith(".json"))


def load(spark: SparkSession, root: str) -> tuple[int, dict | None]:
    """(version, contents) of the newest manifest; (0, None) where there is none."""
    have = versions(spark, root)
    if not have:
        return 0, None
    fs, _ = _fs(spark, root)
    stream = fs.open(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/manifest-{have[-1]}.json"))
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return have[-1], json.loads(text)


def commit(spark: SparkSession, root: str, version: int, contents: dict) -> None:
    """Makes `contents` the given version; fails if another writer has committed that version."""
    fs, path = _fs(spark, root)
    fs.mkdirs(path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/.draft-{version}")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(contents).encode()))
    out.close()
    final = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/manifest-{version}.json")
    if fs.exists(final) or not fs.rename(draft, final):
        raise RuntimeError(f"version {version} of {root} exists")
