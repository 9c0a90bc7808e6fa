"""Finding windows that occur more than once, without shuffling every window.

Each window of tokens (words or bytes) has an anchor: the smallest hash among the short runs of tokens in it. Equal
windows have equal anchors, and neighbouring windows mostly share theirs, so a document is a short list of anchored runs
of windows. Only anchors that occur more than once can belong to repeated windows; the pieces of text around those are
dealt out by anchor and solved exactly there. Documents of equal text are put together first.

An anchor within a passage that very many documents share would bring all of them to one task. The windows of such hot
anchors are dealt out by 128-bit BLAKE2 digests of their own text, a row for each, so that every group is one distinct window
and is counted by partial aggregates.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage
from .neardup import STEP, mix

#: Runs of one anchor, above which its windows are dealt out one by one; the result is the same.
HOT_RUNS = 2000
#: Stands for NULL ids, before all others.
NO_ID = -(2**63)
BASE = np.uint64(0x100000001B3)


@dataclass(frozen=True)
class Shape:
    """Tokens in a window, tokens in the runs that anchors are chosen from, and how a text becomes token codes."""

    window: int
    short: int
    codes: Callable[[bytes], np.ndarray]
    #: Text of tokens a to b.
    piece: Callable[[bytes, np.ndarray], Callable[[int, int], bytes]]


def powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.full(max(count, 1), base, "uint64")
    out[0] = 1
    return np.cumprod(out)


def run_hashes(codes: np.ndarray, length: int, base: np.uint64 = BASE) -> np.ndarray:
    """Polynomial hashes of every `length` tokens in a row."""
    n = len(codes) - length + 1
    if n < 1:
        return np.empty(0, "uint64")
    inverse = np.uint64(pow(int(base), -1, 2**64))
    sums = np.zeros(len(codes) + 1, "uint64")
    np.cumsum(codes * powers(base, len(codes)), out=sums[1:])
    return mix((sums[length:] - sums[:-length]) * powers(inverse, n) + STEP)


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of every `width` values in a row, by blocks: the end of one and the begin of the next."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    table = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).reshape(-1)
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def anchored(codes: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, number of windows, times) of each run of windows with one anchor.

    `times` is 2 where the anchor occurs twice within a run, so that windows of the run can equal each other.
    """
    width = shape.window - shape.short + 1
    if len(codes) < shape.window:
        return np.empty(0, "int64"), np.empty(0, "int32"), np.empty(0, "int32"), np.empty(0, "int32")
    hashes = run_hashes(codes, shape.short)
    least = sliding_least(hashes, width)
    begins = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    counts = np.diff(np.append(begins, len(least)))
    if counts.max() > width:  # one anchor over and over, in periodic text: pieces stay short
        parts = -(-counts // width)
        first = np.repeat(np.cumsum(parts) - parts, parts)
        begins = np.repeat(begins, parts) + (np.arange(parts.sum()) - first) * width
        counts = np.diff(np.append(begins, len(least)))
    # A place holds an anchor if the largest of the least hashes of the windows around it is its own.
    edge = np.full(width - 1, np.iinfo("uint64").max, "uint64")
    places = np.flatnonzero(~sliding_least(np.concatenate([edge, ~least, edge]), width) == hashes)
    twice = np.flatnonzero((hashes[places[1:]] == hashes[places[:-1]]) & (np.diff(places) <= width))
    times = np.ones(len(begins), "int32")
    for low, high in zip((places[twice] - width + 1).tolist(), places[twice + 1].tolist()):
        times[np.searchsorted(begins, low, "right") - 1 if low > 0 else 0 : np.searchsorted(begins, high, "right")] = 2
    return least[begins].view("int64"), begins.astype("int32"), counts.astype("int32"), times


def keyed(docs: DataFrame) -> DataFrame:
    """d (doc_id, NULL first), key of the text, and the text; NULL texts count as empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(NO_ID)).alias("d"), F.unhex(F.md5(text)).alias("key"), text.alias("text"))


def survey(docs: DataFrame, shape: Shape, whole: Callable[[bytes, np.ndarray], str]) -> DataFrame:
    """A row per document: size in tokens, hash of what is left if nothing is removed, and its anchored runs."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = {k: [] for k in ("size", "whole", "anchors", "starts", "counts", "times")}
            for text in frame["text"]:
                body = text.encode("utf-8", "surrogatepass")
                codes = shape.codes(body)
                out["size"].append(len(codes))
                out["whole"].append(whole(body, codes))
                for name, part in zip(("anchors", "starts", "counts", "times"), anchored(codes, shape)):
                    out[name].append(part)
            ids = frame["doc_id"].astype("Int64")
            yield pd.DataFrame({"doc_id": ids, "d": frame["d"], "key": frame["key"], **out})

    schema = "doc_id long, d long, key binary, size long, whole string, anchors array<long>, starts array<int>, counts array<int>, times array<int>"
    return keyed(docs).mapInPandas(run, schema)


def recurring(rows: DataFrame, docs: DataFrame, stage: Stage, hot_runs: int = HOT_RUNS) -> DataFrame:
    """d, key, text and runs (start, count, anchor, hot) of the first document of each text that has recurring anchors.

    The lists of runs are written before any text is shuffled, so that the shuffles of anchors and of texts do not add up.
    """
    first = rows.groupBy("key").agg(F.min(F.struct("d", "anchors", "starts", "counts", "times")).alias("r"))
    parts = zip(("anchors", "starts", "counts", "times"), ("anchor", "start", "count", "times"))
    zipped = F.explode(F.arrays_zip(*[F.col(f"r.{many}").alias(one) for many, one in parts]))
    runs = first.select("key", F.col("r.d").alias("d"), zipped.alias("run")).select("key", "d", "run.*")
    often = runs.groupBy("anchor").agg(F.sum("times").alias("n")).where("n > 1")
    kept = runs.join(often, "anchor").select("key", "d", F.struct("start", "count", "anchor", (F.col("n") > hot_runs).alias("hot")).alias("run"))
    lists = stage("runs", kept.groupBy("key", "d").agg(F.collect_list("run").alias("runs")))
    del first, zipped, runs, often, kept
    return stage("found", keyed(docs).select("key", "d", "text").join(lists, ["key", "d"]).dropDuplicates(["key", "d"]))


def pieces(found: DataFrame, shape: Shape) -> DataFrame:
    """(anchor, d, key, start, body) of each run whose anchor is not hot; body is the text of all its windows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for d, key, text, runs in zip(frame["d"], frame["key"], frame["text"], frame["runs"]):
                body = text.encode("utf-8", "surrogatepass")
                cut = shape.piece(body)
                for one in runs:
                    if not one["hot"]:
                        start = one["start"]
                        rows.append((one["anchor"], d, key, start, cut(start, start + one["count"] + shape.window - 1)))
                if len(rows) > 20_000:
                    yield pd.DataFrame(rows, columns=["anchor", "d", "key", "start", "body"])
                    rows = []
            yield pd.DataFrame(rows, columns=["anchor", "d", "key", "start", "body"])

    return found.mapInPandas(run, "anchor long, d long, key binary, start int, body binary")


def hot_windows(found: DataFrame, shape: Shape) -> DataFrame:
    """(f, g, d, key, start) of each window of a hot anchor; (f, g) are the halves of a BLAKE2 digest of its text.

    Two windows with one digest are one text: no two others are known, nor can they be found.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for d, key, text, runs in zip(frame["d"], frame["key"], frame["text"], frame["runs"]):
                cut = shape.piece(text.encode("utf-8", "surrogatepass"))
                at = np.concatenate([np.arange(r["start"], r["start"] + r["count"]) for r in runs if r["hot"]])
                digests = b"".join(blake2b(cut(a, a + shape.window), digest_size=16).digest() for a in at.tolist())
                f, g = np.frombuffer(digests, "<i8").reshape(-1, 2).T
                yield pd.DataFrame({"f": f, "g": g, "d": d, "key": key, "start": at.astype("int32")})

    hot = found.where(F.exists("runs", lambda r: r["hot"]))
    return hot.mapInPandas(run, "f long, g long, d long, key binary, start int")


def blocks(frames: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
    """Rows that come ordered by anchor, in blocks of whole anchors holding about `most` bytes."""
    waiting: list[pd.DataFrame] = []
    size = 0
    for frame in frames:
        while len(frame):
            total = size + np.cumsum(frame["body"].map(len).to_numpy())
            over = int(np.searchsorted(total, most, "right"))
            if over >= len(frame):
                waiting.append(frame)
                size = int(total[-1])
                break
            anchors = frame["anchor"].to_numpy()
            changes = np.flatnonzero(anchors[1:] != anchors[:-1]) + 1
            later = changes[changes > over]
            earlier = changes[changes <= over]
            if waiting and waiting[-1]["anchor"].iloc[-1] != anchors[0]:
                earlier = np.append(0, earlier)
            if len(earlier):
                cut = int(earlier[-1])
            elif len(later):
                cut = int(later[0])
            else:
                waiting.append(frame)
                size = int(total[-1])
                break
            waiting.append(frame.iloc[:cut])
            yield pd.concat(waiting, ignore_index=True)
            waiting, size, frame = [], 0, frame.iloc[cut:]
    if waiting:
        yield pd.concat(waiting, ignore_index=True)


def solved(cut: DataFrame, solve: Callable[[pd.DataFrame], list[tuple[int, int, int]]], most: int) -> DataFrame:
    """(key, low, high) of token ranges to remove; `solve` gives (row, low, high) for a block of whole anchors."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(frames, most):
            found = solve(block)
            keys, starts = block["key"].tolist(), block["start"].tolist()
            yield pd.DataFrame([(keys[r], starts[r] + a, starts[r] + b) for r, a, b in found], columns=["key", "low", "high"])

    ordered = cut.repartition("anchor").sortWithinPartitions("anchor", "d", "key", "start")
    return ordered.mapInPandas(run, "key binary, low int, high int")


def ranges_of(flags: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Token ranges covered by the windows whose flag is set."""
    at = np.flatnonzero(flags)
    if not len(at):
        return []
    breaks = np.flatnonzero(np.diff(at) > window)
    lows = at[np.append(0, breaks + 1)]
    highs = at[np.append(breaks, len(at) - 1)] + window
    return list(zip(lows.tolist(), highs.tolist()))


def removed_mask(size: int, spans: list) -> np.ndarray:
    step = np.zeros(size + 1, "int64")
    np.add.at(step, [s["low"] for s in spans], 1)
    np.add.at(step, [s["high"] for s in spans], -1)
    return np.cumsum(step[:-1]) > 0


def trimmed(found: DataFrame, spans: DataFrame, trim: Callable[[bytes, list], tuple[int, int, str]]) -> DataFrame:
    """key, n_removed, n_spans and kept_sha256 of the documents that lose something."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(k, *trim(t.encode("utf-8", "surrogatepass"), s)) for k, t, s in zip(frame["key"], frame["text"], frame["spans"])]
            yield pd.DataFrame(rows, columns=["key", "n_removed", "n_spans", "kept_sha256"])

    lists = spans.groupBy("key").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    return found.select("key", "text").join(lists, "key").mapInPandas(run, "key binary, n_removed long, n_spans long, kept_sha256 string")


def stage_of(docs: DataFrame) -> Stage:
    """Texts are staged with their runs; zstd takes less of the disk."""
    return Stage(docs.sparkSession, "zstd")
