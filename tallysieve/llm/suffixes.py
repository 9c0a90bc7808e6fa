"""Removing repeated byte strings with suffix arrays built by two-stage sorting.

Windows of bytes are gathered by anchor (see anchors.py). The pieces of a shard are joined and their suffixes sorted in
two stages: suffixes smaller than their successor are sorted directly, by as many bytes as a window has; all others
follow by scanning the buckets in order, since removing the first byte of one gives a suffix already in place. Adjacent
common prefixes then show which windows occur more than once; every byte they cover is removed, in all occurrences.
Windows are judged on the input and never cross documents.

NULL texts are empty. A text that occurs in several rows, whatever their ids, is removed whole if it holds a window.
An empty table gives no rows; extra columns are ignored; rows without doc_id are treated like others.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import anchors
from .common import sha256_hex

WINDOW, SHORT = 400, 100
#: Bytes sorted together; the keys of the direct sort take about 200 times as much for a moment.
SHARD_BYTES = 400_000


def byte_codes(body: bytes) -> np.ndarray:
    return np.frombuffer(body, "uint8").astype("uint64") + np.uint64(1)


def byte_piece(body: bytes):
    return lambda a, b: body[a:b]


def shape_of(window: int) -> anchors.Shape:
    return anchors.Shape(window, min(SHORT, window), byte_codes, byte_piece)


def suffix_array(body: bytes, depth: int) -> np.ndarray:
    """Places of all suffixes, ordered by their first `depth` bytes at least."""
    n = len(body)
    text = np.frombuffer(body, "uint8").astype("int64")
    out = np.full(n, -1, "int64")
    if not n:
        return out
    # A suffix is smaller than its successor if, behind its run of equal bytes, a larger one follows.
    change = np.flatnonzero(np.append(text[1:] != text[:-1], True))
    run_end = np.repeat(change, np.diff(np.append(-1, change)))
    smaller = np.append(text, -1)[run_end + 1] > text
    direct = np.flatnonzero(smaller).tolist()
    direct.sort(key=lambda p: body[p : p + depth])
    direct = np.array(direct, "int64")

    larger_counts = np.bincount(text[~smaller], minlength=256)
    smaller_counts = np.bincount(text[smaller], minlength=256)
    begin = np.cumsum(larger_counts + smaller_counts) - larger_counts - smaller_counts
    middle = begin + larger_counts
    firsts = text[direct]
    for byte in np.unique(firsts):
        out[middle[byte] : middle[byte] + smaller_counts[byte]] = direct[firsts == byte]
    head = begin.copy()

    def place(before: np.ndarray) -> None:
        """Appends suffixes to their buckets, in this order."""
        bytes_ = text[before]
        order = np.argsort(bytes_, kind="stable")
        ordered = bytes_[order]
        new = np.append(True, ordered[1:] != ordered[:-1])
        starts = np.flatnonzero(new)
        rank = np.arange(len(ordered)) - np.repeat(starts, np.diff(np.append(starts, len(ordered))))
        out[head[ordered] + rank] = before[order]
        np.add.at(head, ordered[starts], np.diff(np.append(starts, len(ordered))))

    def before(entries: np.ndarray) -> np.ndarray:
        entries = entries[entries > 0] - 1
        return entries[~smaller[entries]]

    place(np.array([n - 1]))  # the last suffix follows from the empty one
    for byte in range(256):
        at = int(begin[byte])
        while at < head[byte]:  # entries of this bucket may add further ones to it
            stop = int(head[byte])
            if len(more := before(out[at:stop])):
                place(more)
            at = stop
        if smaller_counts[byte] and len(more := before(out[middle[byte] : middle[byte] + smaller_counts[byte]])):
            place(more)
    return out


def common_prefixes(body: bytes, order: np.ndarray, most: int) -> np.ndarray:
    """Length, up to `most`, of the prefix that each suffix shares with the one before it in `order`."""
    padded = np.frombuffer(body + bytes(8), "uint8").astype("uint64")
    n = len(body)
    eights = np.zeros(n + most + 8, "uint64")
    for k in range(8):
        eights[:n] |= padded[k : k + n] << np.uint64(56 - 8 * k)
    out = np.zeros(len(order), "int64")
    a, b = order[1:], order[:-1]
    active = np.arange(1, len(order))
    for shift in range(0, most, 8):
        different = eights[a + shift] ^ eights[b + shift]
        same = different == 0
        ended = different[~same]
        # Bytes before the first that differs.
        out[active[~same]] = shift + sum((ended >> np.uint64(8 * k) == 0).astype("int64") for k in range(1, 8))
        active, a, b = active[same], a[same], b[same]
        if not len(active):
            break
    out[active] = most
    return np.minimum(out, most)


def repeated_windows(block: pd.DataFrame, window: int) -> list[tuple[int, int, int]]:
    """(row, low, high) of the bytes that windows occurring more than once cover."""
    rows_of: dict[bytes, list[int]] = {}
    for row, body in enumerate(block["body"]):
        rows_of.setdefault(body, []).append(row)
    bodies = list(rows_of)
    lengths = np.array([len(b) for b in bodies])
    begins = np.cumsum(lengths) - lengths
    joined = b"".join(bodies)
    is_window = np.zeros(len(joined), bool)
    for low, length in zip(begins.tolist(), lengths.tolist()):
        is_window[low : low + length - window + 1] = True
    order = suffix_array(joined, window)
    order = order[is_window[order]]
    same = common_prefixes(joined, order, window) >= window
    repeated = np.zeros(len(joined), bool)
    repeated[order[1:][same[1:]]] = True
    repeated[order[:-1][same[1:]]] = True
    out = []
    for body, low, length in zip(bodies, begins.tolist(), lengths.tolist()):
        rows = rows_of[body]
        if len(rows) > 1:
            out += [(row, 0, length) for row in rows]
        else:
            out += [(rows[0], a, b) for a, b in anchors.ranges_of(repeated[low : low + length - window + 1], window)]
    return out


def trim(body: bytes, spans: list) -> tuple[int, int, str]:
    gone = anchors.removed_mask(len(body), spans)
    kept = np.frombuffer(body, "uint8")[~gone].tobytes()
    return int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype("int8")])) == 1).sum()), sha256_hex(kept)


def remove_repeats(docs: DataFrame, window: int = WINDOW, hot_runs: int = anchors.HOT_RUNS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and n_kept, what is left, of every row.

    Repeats shorter than the window stay: a passage of 50 short words may have fewer bytes than that.
    """
    stage, shape = anchors.stage_of(docs), shape_of(window)
    rows = stage("survey", anchors.survey(docs, shape, lambda body, codes: sha256_hex(body)))
    found = anchors.recurring(rows, docs, stage, hot_runs)
    spans = anchors.solved(anchors.pieces(found, shape), lambda block: repeated_windows(block, window), shard_bytes)
    windows = anchors.hot_windows(found, shape)
    often = windows.groupBy("f", "g").agg(F.count("*").alias("n")).where("n > 1").select("f", "g")
    again = windows.join(often, ["f", "g"]).select("key", F.col("start").alias("low"), (F.col("start") + window).alias("high"))
    cut = anchors.trimmed(found, stage("spans", spans.union(again)), trim)

    times = rows.groupBy("key").agg(F.count("*").alias("times"))
    named = rows.select("doc_id", "key", "size", "whole").join(times, "key").join(cut, "key", "left")
    copy = (F.col("times") > 1) & (F.col("size") >= window)
    return named.select(
        "doc_id", F.col("size").alias("n_bytes"),
        F.when(copy, F.col("size")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.lit(sha256_hex(b""))).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
    ).withColumn("n_kept", F.col("n_bytes") - F.col("n_removed"))
