"""Landing raw files: bytes under given names, written by tasks.

Spark's writers choose file names themselves and leave marker and checksum files behind; deliveries that others read, such
as archives or files of a contract, need their own names and nothing beside them.
"""

from __future__ import annotations

import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame

from ..sources.ranges import spread
from ..sources.stores import store_of

LANDED = "name string, length bigint"
#: Bytes of a file that a task holds while it copies.
BLOCK = 1 << 20


def _blocks(path: str, header: bool = True) -> Iterator[bytes]:
    """The bytes of a file in blocks; without `header`, those behind its first line feed."""
    store, place = store_of(path)
    with store.open_input_stream(place) as source:
        while block := source.read(BLOCK):
            if not header:
                _, found, block = block.partition(b"\n")
                header = bool(found)
            if block:
                yield block


def _counter(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield pd.DataFrame({"path": frame["path"], "lines": [sum(b.count(b"\n") for b in _blocks(p)) for p in frame["path"]]})


def line_feeds(files: DataFrame) -> DataFrame:
    """(path, lines): how many line feeds each file of (path) has, a block of it in memory at a time."""
    return spread(files.select("path"), "path").mapInPandas(_counter, "path string, lines bigint")


def _copier(folder: str):
    def land(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, place = store_of(folder)
        for frame in frames:
            lengths = []
            for name, head, path in zip(frame["name"], frame["head"], frame["path"], strict=True):
                target, unfinished = f"{place}/{name}", f"{place}.landing/{uuid.uuid4().hex}"
                store.create_dir(target.rsplit("/", 1)[0], recursive=True)
                store.create_dir(unfinished.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(unfinished) as out:
                    out.write(head)
                    lengths.append(len(head))
                    for block in _blocks(path):
                        out.write(block)
                        lengths[-1] += len(block)
                store.move(unfinished, target)
            yield pd.DataFrame({"name": frame["name"], "length": lengths})

    return land


def land_copies(files: DataFrame, folder: str) -> DataFrame:
    """Write files of (name, head, path) as `head` and the bytes at `path`, whatever their size: blocks go through, not files."""
    return spread(files.select("name", "head", "path"), "name").mapInPandas(_copier(folder.rstrip("/")), LANDED)


def _mover(folder: str):
    def land(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, place = store_of(folder)
        for frame in frames:
            lengths = []
            for name, path in zip(frame["name"], frame["path"], strict=True):
                written, target = store_of(path)[1], f"{place}/{name}"
                store.create_dir(target.rsplit("/", 1)[0], recursive=True)
                if store.get_file_info(written).type != fs.FileType.NotFound:  # a task that runs twice finds it moved
                    store.move(written, target)
                found = store.get_file_info(target)
                if found.type != fs.FileType.File:
                    raise FileNotFoundError(path)
                lengths.append(found.size)
            yield pd.DataFrame({"name": frame["name"], "length": lengths})

    return land


def land_moves(files: DataFrame, folder: str) -> DataFrame:
    """Give files of (name, path) names of their own in `folder`, in the same store; no byte is written again."""
    return spread(files.select("name", "path"), "name").mapInPandas(_mover(folder.rstrip("/")), LANDED)


def _packer(folder: str):
    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, place = store_of(folder)
        for frame in frames:
            lengths = []
            for row in frame.itertuples(index=False):
                unfinished = f"{place}.landing/{uuid.uuid4().hex}"
                for made in (place, unfinished.rsplit("/", 1)[0]):
                    store.create_dir(made, recursive=True)
                with store.open_output_stream(unfinished) as out:
                    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
                        with archive.open(row.member, "w", force_zip64=True) as into:
                            for k, path in enumerate(row.paths):
                                for block in _blocks(path, header=k == 0):
                                    into.write(block)
                        archive.writestr(row.extra, b"x")
                    lengths.append(out.tell())
                store.move(unfinished, f"{place}/{row.name}")
            yield pd.DataFrame({"name": frame["name"], "length": lengths})

    return pack


def land_archives(packages: DataFrame, folder: str) -> DataFrame:
    """Write archives of (name, member, paths, extra): one member made of delimited files with equal headers, in the order of
    `paths`, and one file named `extra`. A task packs one archive, block by block."""
    return spread(packages.select("name", "member", "paths", "extra"), "name").mapInPandas(_packer(folder.rstrip("/")), LANDED)


def _lander(folder: str):
    def land(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, place = store_of(folder)
        for frame in frames:
            for name, content in zip(frame["name"], frame["content"], strict=True):
                target = f"{place}/{name}"
                store.create_dir(target.rsplit("/", 1)[0], recursive=True)
                # A task that runs twice writes the same bytes; readers never see half a file.
                unfinished = f"{place.rstrip('/')}.landing/{uuid.uuid4().hex}"
                store.create_dir(unfinished.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(unfinished) as out:
                    out.write(content)
                store.move(unfinished, target)
            yield pd.DataFrame({"name": frame["name"], "length": frame["content"].map(len)})

    return land


def land_files(files: DataFrame, folder: str) -> DataFrame:
    """Write rows of (name, content) as files of `folder`; names may have folders. Gives what was written, lazily."""
    return files.select("name", "content").mapInPandas(_lander(folder.rstrip("/")), LANDED)
