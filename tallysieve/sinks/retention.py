"""Retention: published versions that nobody needs any more go, and nothing else.

Marking comes from the version log: the newest versions stay, and so does every version that a reader has pinned. Folders of
versions that never came into the log belong to runs that failed or still write; they go only once they are older than a
grace period. Sweeping is done by tasks, a folder each. The log keeps its entries, so numbers are never used twice.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from ..sources import stores
from . import publish

PINS = "pins"
KEPT, PINNED, SUPERSEDED, UNFINISHED, ABANDONED = "kept", "pinned", "superseded", "unfinished", "abandoned"
MARKED = "version string, path string, state string"


@contextmanager
def pinned(root: str, version: str) -> Iterator[str]:
    """While the block runs, no sweep takes the version. A pin that a lost reader left behind has to be removed by hand."""
    mark = f"{root}/{PINS}/{version}.{uuid.uuid4().hex}"
    stores.create_new(mark, b"")
    try:
        if stores.kind_of(f"{root}/version={version}")[0] != stores.FOLDER:
            raise FileNotFoundError(f"version {version} is gone")
        yield version
    finally:
        store, place = stores.store_of(mark)
        store.delete_file(place)


def marked(spark: SparkSession, root: str, keep: int = 2, grace_seconds: float = 7 * 86_400) -> DataFrame:
    """What becomes of each version's folder; one name a version is held."""
    if keep < 1:
        raise ValueError("the current version always stays")
    committed = [r["version"] for r in publish.versions(spark, root).select("version").collect()]
    newest = set(committed[:keep])
    pins = f"{root}/{PINS}"
    held = {name.rsplit(".", 1)[0] for name in stores.children(pins)} if stores.kind_of(pins)[0] else set()
    rows = []
    for name in stores.children(root):
        if not name.startswith("version="):
            continue
        version, path = name.removeprefix("version="), f"{root}/{name}"
        if version in newest:
            state = KEPT
        elif version in held:
            state = PINNED
        elif version in committed:
            state = SUPERSEDED
        else:
            age = time.time() - stores.kind_of(path)[2] / 1e9
            state = ABANDONED if age > grace_seconds else UNFINISHED
        rows.append((version, path, state))
    return spark.createDataFrame(rows, MARKED)


def _delete(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for path in frame["path"]:
            store, place = stores.store_of(path)
            if stores.kind_of(path)[0] == stores.FOLDER:  # a task that runs twice finds nothing left
                store.delete_dir(place)
        yield frame


def sweep(spark: SparkSession, root: str, keep: int = 2, grace_seconds: float = 7 * 86_400) -> DataFrame:
    """Delete what is superseded or abandoned; gives what became of every folder.

    Pins are read before each sweep, and a reader that pins a version being swept is told that it is gone.
    """
    plan = marked(spark, root, keep, grace_seconds)
    rows = plan.collect()  # one row a version
    gone = [(r["version"], r["path"], r["state"]) for r in rows if r["state"] in (SUPERSEDED, ABANDONED)]
    if gone:
        tasks = spark.createDataFrame(gone, MARKED).repartition(min(len(gone), 200))
        tasks.mapInPandas(_delete, MARKED).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([tuple(r) for r in rows], MARKED)
