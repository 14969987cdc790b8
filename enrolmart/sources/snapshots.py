"""Releases as immutable data folders behind one small manifest file.

A root holds ``data-<id>`` folders, each written once, and
``_manifest/v<number>.json`` files that name the folder of every release.
The highest manifest that reads whole is the current one.  Publishing writes
the data, then creates the next manifest, which must not exist yet: nothing is
renamed or overwritten, so a crash at any point leaves the old or the new
state, running readers keep their files, and two writers cannot undo each
other.  ``vacuum`` removes the folders that no kept manifest names.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from enrolmart.schemas import RAW
from enrolmart.session import create_text, list_dirs, list_files, path_exists, read_text, remove
from enrolmart.sources.readers import scan_release
from enrolmart.sources.writers import observed_write

_DIR = "_manifest"
_NAME = re.compile(r"v([0-9]{12})\.json")
# The part of a path from which a lake key mirrors it.
LAKE_PART = "enrollment"


@dataclass(frozen=True)
class Manifest:
    version: int
    releases: dict[str, str]  # label -> data folder


def _versions(spark: SparkSession, root: str) -> list[int]:
    found = (_NAME.fullmatch(n) for n in list_files(spark, f"{root}/{_DIR}"))
    return sorted((int(m[1]) for m in found if m), reverse=True)


def _read(spark: SparkSession, root: str, version: int) -> Manifest | None:
    """A manifest, or None if it was not written to its end."""
    try:
        told = json.loads(read_text(spark, f"{root}/{_DIR}/v{version:012d}.json"))
        return Manifest(told["version"], told["releases"])
    except (ValueError, KeyError, TypeError):
        return None


def manifest(spark: SparkSession, root: str) -> Manifest:
    """The current state of a root; empty if nothing was published."""
    root = root.rstrip("/")
    for version in _versions(spark, root):
        told = _read(spark, root, version)
        if told is not None:
            return told
    return Manifest(0, {})


def _point(spark: SparkSession, root: str, label: str, folder: str, tries: int = 20) -> Manifest:
    """Create the next manifest with ``label`` at ``folder``; again from the newest one if another writer was first."""
    for _ in range(tries):
        now = manifest(spark, root)
        version = max([now.version, *_versions(spark, root)[:1]]) + 1
        new = Manifest(version, {**now.releases, label: folder})
        text = json.dumps({"version": version, "releases": new.releases}, sort_keys=True)
        if create_text(spark, f"{root}/{_DIR}/v{version:012d}.json", text):
            return new
    raise OSError(f"{root}: {tries} other writers were first")


def publish(df: DataFrame, root: str, label: str, force: bool = False) -> int | None:
    """Publish a release; None if it is there already (unless ``force``), else its rows, counted while writing."""
    spark, root = df.sparkSession, root.rstrip("/")
    if label in manifest(spark, root).releases and not force:
        return None
    folder = f"data-{uuid.uuid4().hex[:12]}"
    try:
        rows = observed_write(df, f"{root}/{folder}")
    except PySparkException:
        remove(spark, f"{root}/{folder}")
        raise
    _point(spark, root, label, folder)
    return rows


def resolve(spark: SparkSession, root: str, label: str | None = None) -> str:
    """The data folder of a release, of the highest label if none is given."""
    root = root.rstrip("/")
    releases = manifest(spark, root).releases
    if not releases or (label is not None and label not in releases):
        raise FileNotFoundError(f"no release {label or ''} under {root}")
    return f"{root}/{releases[label or max(releases)]}"


def read(
    spark: SparkSession, root: str, label: str | None = None, schema: T.StructType = RAW
) -> DataFrame:
    """Rows of a release (the latest); later publishing does not change what this DataFrame reads."""
    return scan_release(spark, resolve(spark, root, label), schema)


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove data folders that none of the last ``keep`` manifests names; returns them.

    A folder that a running writer has yet to name is removed too: vacuum
    when no one publishes.
    """
    root = root.rstrip("/")
    whole = [m for v in _versions(spark, root) if (m := _read(spark, root, v)) is not None]
    named = {folder for m in whole[: max(keep, 1)] for folder in m.releases.values()}
    gone = [d for d in list_dirs(spark, root) if d.startswith("data-") and d not in named]
    for d in gone:
        remove(spark, f"{root}/{d}")
    for m in whole[max(keep, 1) :]:
        remove(spark, f"{root}/{_DIR}/v{m.version:012d}.json")
    return sorted(gone)


def lake_key(path: str) -> str:
    """The key that mirrors a path: from its part ``enrollment`` on, else ``enrollment/<file>``."""
    parts = [p for p in path.split("/") if p]
    if LAKE_PART in parts:
        return "/".join(parts[parts.index(LAKE_PART) :])
    return f"{LAKE_PART}/{parts[-1]}"


def lake_copy(
    spark: SparkSession, source: str, lake: str, key: str | None = None, force: bool = False, schema: T.StructType = RAW
) -> str:
    """Copy a release file or folder to its key in the lake; returns where it is.

    A key that is there already stays (unless ``force``); a missing source is an error.
    """
    if not path_exists(spark, source):
        raise FileNotFoundError(source)
    target = f"{lake.rstrip('/')}/{key or lake_key(source)}"
    publish(scan_release(spark, source, schema), target, "copy", force)
    return target
