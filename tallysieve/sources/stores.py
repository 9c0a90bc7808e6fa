"""Files as tasks see them: opened, read in part and listed where they lie, hidden names and empty folders included.

Spark's own file index leaves out names that start with `_` or `.`, folders without files and empty files, and holds all
names on the driver. Here folders are listed by tasks, one level after another: each level is a staged table, whose
folders are the input of the next. The driver sees the root only.
"""

from __future__ import annotations

import os
import stat
import uuid
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import InputError
from ..plans.evaluate import Stage

LISTED = "path string, source_file string, kind string, length bigint, modified_ns bigint"
FILE, FOLDER, LINK, OTHER = "file", "folder", "link", "other"
#: Schemes that Spark and the file system library name differently.
SAME_STORE = {"s3a": "s3", "s3n": "s3"}


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system a path lies in, and the path there. Names are taken as they are, never URL-decoded."""
    scheme, found, rest = path.partition("://")
    if not found:
        return fs.LocalFileSystem(), path.removeprefix("file:") if path.startswith("file:/") else path
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    authority, _, below = rest.partition("/")
    store, base = fs.FileSystem.from_uri(f"{SAME_STORE.get(scheme, scheme)}://{authority}/")
    return store, f"{base.rstrip('/')}/{below}"


def opens(path: str) -> bool:
    """Whether tasks can open files there; other stores are read through Spark's own file source."""
    try:
        store_of(path)
    except (ValueError, OSError, NotImplementedError):
        return False
    return True


def kind_of(path: str) -> tuple[str | None, int, int]:
    """(kind, bytes, modification time in ns) of one path; the kind is NULL where nothing is."""
    store, place = store_of(path)
    if isinstance(store, fs.LocalFileSystem):
        try:
            found = os.lstat(place)
        except (FileNotFoundError, NotADirectoryError):
            return None, 0, 0
        kinds = {stat.S_IFREG: FILE, stat.S_IFDIR: FOLDER, stat.S_IFLNK: LINK}
        return kinds.get(stat.S_IFMT(found.st_mode), OTHER), found.st_size, found.st_mtime_ns
    info = store.get_file_info(place.rstrip("/"))
    kinds = {fs.FileType.NotFound: None, fs.FileType.File: FILE, fs.FileType.Directory: FOLDER}
    return kinds.get(info.type, OTHER), info.size or 0, info.mtime_ns or 0


def children(path: str) -> Iterator[str]:
    """Names in a folder."""
    store, place = store_of(path)
    if isinstance(store, fs.LocalFileSystem):
        with os.scandir(place) as found:
            yield from (entry.name for entry in found)
    else:
        yield from (info.base_name for info in store.get_file_info(fs.FileSelector(place)))


def read_all(path: str) -> bytes:
    """A small file."""
    store, place = store_of(path)
    with store.open_input_stream(place) as source:
        return source.read()


def create_new(path: str, content: bytes) -> bool:
    """Create a small file, whole, unless something has its name already; says whether it did.

    Needs a store in which a name is taken once: local ones link, a distributed file system refuses to rename onto a file.
    Object stores replace, so they are refused.
    """
    store, place = store_of(path)
    folder, _, name = place.rpartition("/")
    store.create_dir(folder, recursive=True)
    unfinished = f"{folder}/.{name}.{uuid.uuid4().hex}"
    if not isinstance(store, fs.LocalFileSystem) and store.type_name not in ("hdfs", "viewfs"):
        raise NotImplementedError(f"{store.type_name} cannot create a file only where none is")
    with store.open_output_stream(unfinished) as out:
        out.write(content)
    try:
        if isinstance(store, fs.LocalFileSystem):
            os.link(unfinished, place)
        else:
            store.move(unfinished, place)
            return True
    except OSError:
        if store.get_file_info(place).type == fs.FileType.NotFound:
            raise
        return False
    finally:
        if store.get_file_info(unfinished).type != fs.FileType.NotFound:
            store.delete_file(unfinished)
    return True


def _list(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [c.split()[0] for c in LISTED.split(", ")]
    for frame in frames:
        for folder in frame.itertuples(index=False):
            rows = []
            for name in children(folder.path):
                kind, size, modified = kind_of(f"{folder.path}/{name}")
                shown = name.encode("utf-8", "surrogateescape").decode("utf-8", "replace")
                if shown != name:  # no text can name it, so nothing can read it by its name
                    kind = OTHER
                if kind is not None:
                    rows.append((f"{folder.path}/{shown}", f"{folder.source_file}{shown}", kind, size, modified))
                if len(rows) >= 10_000:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            yield pd.DataFrame(rows, columns=columns)


def walk(spark: SparkSession, root: str, stage: Stage) -> DataFrame:
    """One row for everything below `root`, or for the one file that `root` is.

    `source_file` is the path below the root. Links are listed and never followed.
    """
    root = root.rstrip("/") or "/"
    kind, size, modified = kind_of(root)
    if kind is None:
        raise InputError(f"no such input: {root}")
    if kind != FOLDER:
        return spark.createDataFrame([(root, root.rsplit("/", 1)[-1], kind, size, modified)], LISTED)
    level, found = spark.createDataFrame([(root, "")], "path string, source_file string"), None
    depth, tasks = 0, spark.sparkContext.defaultParallelism
    while depth == 0 or not level.isEmpty():
        listed = stage(f"level_{depth}", level.repartition(tasks, "path").mapInPandas(_list, LISTED))
        found = listed if found is None else found.unionByName(listed)
        level = listed.where(F.col("kind") == FOLDER).select("path", F.concat("source_file", F.lit("/")).alias("source_file"))
        depth += 1
    return found
