"""Archives of delimited files: manifests, admission rules and expansion in executor memory."""

from __future__ import annotations

import io
import stat
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv
from .listing import PACKAGE_LIMITS, Limits, base_name, over, schema_hint
from .stores import store_of

MANIFEST = (
    "archive string, archive_bytes bigint, member string, is_dir boolean, size bigint, packed bigint, "
    "method int, flags int, mode int, damage string"
)
UNPACKED = "archive string, source_file string, path string, length bigint, problem string"
#: Bytes of a member that a task holds while it unpacks.
BLOCK = 1 << 20
EXPANDED = "archive string, source_file string, content binary, problem string"
_DAMAGE = (zipfile.BadZipFile, EOFError, OSError, RuntimeError, NotImplementedError, zlib.error, ValueError)


def _lister(names: list[str]):
    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                nothing = (path, len(content), *[None] * (len(names) - 3))
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as archive:
                        rows = [
                            (path, len(content), m.filename, m.is_dir(), m.file_size, m.compress_size,
                             m.compress_type, m.flag_bits, m.external_attr >> 16, None)
                            for m in archive.infolist()
                        ]
                except _DAMAGE as error:
                    rows = [(*nothing, str(error))]
                yield pd.DataFrame(rows or [(*nothing, "empty archive")], columns=names)

    return members


def manifest(archives: DataFrame) -> DataFrame:
    """One row per member of each archive of (path, content); a damaged archive gives one row saying so."""
    return archives.select("path", "content").mapInPandas(
        _lister([column.split()[0] for column in MANIFEST.split(", ")]), MANIFEST
    )


def _unsafe(member: Column) -> Column:
    parts = F.split(F.regexp_replace(member, "/$", ""), "/")
    return (
        (member == "")
        | F.contains(member, F.lit("\u0000"))
        | F.contains(member, F.lit("\\"))
        | member.startswith("/")
        | member.rlike("^[A-Za-z]:")
        | F.exists(parts, lambda p: p.isin("", ".", ".."))
    )


def member_schema(member: Column) -> Column:
    """Contract of a member at its allowed place, NULL elsewhere."""
    folder = F.regexp_extract(member, r"^(.*)/[^/]*$", 1)
    hint = schema_hint(base_name(member))
    return F.when((folder == fv.SALES_FOLDER) & (hint == "vendas"), hint).when(
        (folder == fv.DIMENSION_FOLDER) & (hint != "vendas"), hint
    )


def member_problems(members: DataFrame, limits: Limits = PACKAGE_LIMITS) -> DataFrame:
    """(archive, member, problem) for everything that keeps an archive out.

    One archive never has so many members that counting them per archive is a concern; the window is on
    archive and folded name, not on the archive alone.
    """
    name, kind = F.col("member"), F.col("mode").bitwiseAND(F.lit(0o170000))
    clean = F.regexp_replace(name, "/$", "")
    same_path = Window.partitionBy("archive", F.lower(clean))
    marked = members.where("damage is null").withColumn("__same", F.count(F.lit(1)).over(same_path))
    size, packed = F.col("size"), F.col("packed")
    problem = (
        F.when(_unsafe(name), "unsafe path")
        .when(F.col("__same") > 1, "path given twice, letter case aside")
        .when(F.col("flags").bitwiseAND(F.lit(1)) == 1, "encrypted member")
        .when(~F.col("method").isin(zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED), "compression method not allowed")
        .when(kind == stat.S_IFLNK, "symbolic link")
        .when(~kind.isin(0, stat.S_IFREG, stat.S_IFDIR), "special file")
        .when((kind == stat.S_IFREG) & F.col("is_dir"), "file named as folder")
        .when((kind == stat.S_IFDIR) & ~F.col("is_dir"), "folder named as file")
        .when(F.col("is_dir") & ~clean.isin(*fv.ARCHIVE_FOLDERS), "unexpected folder")
        .when(F.col("is_dir"), F.lit(None).cast("string"))
        .when(over(size, limits.file_bytes), "member over the size limit")
        .when((size > 0) & (packed == 0), "invalid compression ratio")
        .when(over(size / F.nullif(packed, F.lit(0)), limits.compression_ratio), "member over the compression ratio")
        .when((name != fv.README_NAME) & member_schema(name).isNull(), "unexpected member")
    )
    per_member = marked.select("archive", "member", problem.alias("problem"))
    damaged = members.where("damage is not null").select("archive", "member", F.col("damage").alias("problem"))
    totals = members.where("damage is null").groupBy("archive").agg(
        F.max("archive_bytes").alias("bytes"),
        F.count_if(~F.col("is_dir")).alias("files"),
        F.sum(F.when(~F.col("is_dir"), size)).alias("unpacked"),
        F.count_if(member_schema(name).isNotNull()).alias("accepted"),
    )
    per_archive = totals.select(
        "archive",
        F.lit(None).cast("string").alias("member"),
        F.explode(
            F.array(
                F.when(over(F.col("bytes"), limits.archive_bytes), "archive over the size limit"),
                F.when(over(F.col("files"), limits.entries), "too many members"),
                F.when(over(F.col("unpacked"), limits.total_bytes), "archive over the unpacked size limit"),
                F.when(F.col("accepted") == 0, "no expected member"),
            )
        ).alias("problem"),
    )
    return per_member.unionByName(damaged).unionByName(per_archive).where("problem is not null")


def _expander(byte_limit: int | None, readme: str):
    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["archive", "source_file", "content", "problem"]
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as archive:
                        for m in archive.infolist():
                            if m.is_dir() or m.filename == readme:
                                continue
                            data, problem = None, None
                            try:
                                with archive.open(m) as source:
                                    # Reading to the end checks the CRC; one byte past the limit is enough to refuse.
                                    data = source.read() if byte_limit is None else source.read(byte_limit + 1)
                                if byte_limit is not None and len(data) > byte_limit:
                                    data, problem = None, "expanded content over the size limit"
                                elif len(data) != m.file_size:
                                    data, problem = None, "expanded size differs from the declared one"
                            except _DAMAGE as error:
                                data, problem = None, f"damaged member: {error}"
                            yield pd.DataFrame([(path, m.filename, data, problem)], columns=names)
                except _DAMAGE as error:
                    yield pd.DataFrame([(path, "", None, f"damaged archive: {error}")], columns=names)

    return expand


def expand(archives: DataFrame, limits: Limits = PACKAGE_LIMITS) -> DataFrame:
    """Members of each archive as files in memory, one at a time; damage becomes a problem row."""
    out = archives.select("path", "content").mapInPandas(_expander(limits.file_bytes, fv.README_NAME), EXPANDED)
    return out.withColumn("schema_hint", member_schema(F.col("source_file")))


def _unpacker(folder: str, byte_limit: int | None, readme: str):
    names = [c.split()[0] for c in UNPACKED.split(", ")]

    def unpacked(archive: zipfile.ZipFile, member: zipfile.ZipInfo) -> tuple[str | None, int, str | None]:
        target, length = f"{folder}/{uuid.uuid4().hex}", 0  # never a name that the archive chose
        store, place = store_of(target)
        store.create_dir(place.rsplit("/", 1)[0], recursive=True)
        with archive.open(member) as source, store.open_output_stream(place) as out:
            while block := source.read(BLOCK):  # reading to the end checks the CRC
                length += len(block)
                if byte_limit is not None and length > byte_limit:
                    return None, length, "expanded content over the size limit"
                out.write(block)
        return target, length, None if length == member.file_size else "expanded size differs from the declared one"

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path in batch["path"]:
                store, place = store_of(path)
                try:
                    with store.open_input_file(place) as source, zipfile.ZipFile(source) as archive:
                        for m in archive.infolist():
                            if m.is_dir() or m.filename == readme:
                                continue
                            try:
                                found = unpacked(archive, m)
                            except _DAMAGE as error:
                                found = (None, 0, f"damaged member: {error}")
                            rows.append((path, m.filename, *found))
                except _DAMAGE as error:
                    rows.append((path, "", None, 0, f"damaged archive: {error}"))
            yield pd.DataFrame(rows, columns=names)

    return unpack


def unpack(archives: DataFrame, folder: str, limits: Limits = PACKAGE_LIMITS) -> DataFrame:
    """Members of each archive of (path) as files of `folder`, whatever their size: a task holds a block of one at a time.

    Each run of the plan writes them again, so its rows are to be staged. The folder has to be one that tasks can open.
    """
    out = archives.select("path").mapInPandas(_unpacker(folder.rstrip("/"), limits.file_bytes, fv.README_NAME), UNPACKED)
    return out.withColumn("schema_hint", member_schema(F.col("source_file")))
