"""Removing passages of words that occurred before, located by sharded Aho-Corasick automata.

Windows of twenty words are gathered by anchor (see anchors.py). In each shard, windows seen more than once are
confirmed as recurring and compiled into an automaton over word numbers; all texts of the shard are streamed through it,
and every occurrence but the first (by doc_id, then start) is removed with all words it covers. Windows are judged on
the input. Texts equal to an earlier document's are removed whole if they have a window at all.

NULL texts have no words. Rows that repeat id and text are one document; of rows with one id but other texts, the order
of their text hashes decides. Rows without doc_id come before all others. An empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import anchors
from .common import sha256_hex

WINDOW, SHORT = 20, 4
#: Runs of an anchor that one task still takes whole: some 200 MB of windows at most.
HOT_RUNS = 50_000
#: Bytes of text in a shard's automaton: its patterns stay below some 10 MB.
SHARD_BYTES = 200_000


def word_codes(body: bytes) -> np.ndarray:
    words = body.split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), "uint64", len(words))


def word_piece(body: bytes):
    words = body.split()
    return lambda a, b: b" ".join(words[a:b])


def shape_of(window: int) -> anchors.Shape:
    return anchors.Shape(window, min(SHORT, window), word_codes, word_piece)


def automaton(windows: set[tuple[int, ...]], window: int) -> ahocorasick.Automaton:
    out = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for number, words in enumerate(windows):
        out.add_word(words, number)
    out.make_automaton()
    return out


def later_occurrences(block: pd.DataFrame, window: int) -> list[tuple[int, int, int]]:
    """(row, low, high) of the words to remove; rows are in order of anchor, doc_id and start."""
    numbers: dict[bytes, int] = {}
    out, texts, first_of = [], [], {}
    anchor_of = block["anchor"].tolist()
    for row, body in enumerate(block["body"]):
        if (anchor_of[row], body) in first_of:  # the same piece again: all its windows came before
            out.append((row, 0, body.count(b" ") + 1))
            continue
        first_of[anchor_of[row], body] = row
        texts.append((row, tuple([numbers.setdefault(w, len(numbers) + 1) for w in body.split(b" ")])))
    seen: set[tuple[int, ...]] = set()
    recurring: set[tuple[int, ...]] = set()
    for _, words in texts:
        for at in range(len(words) - window + 1):
            part = words[at : at + window]
            (recurring if part in seen else seen).add(part)
    if not recurring:
        return out
    machine = automaton(recurring, window)
    found = [False] * len(recurring)
    for row, words in texts:
        flags = np.zeros(len(words), bool)
        for end, number in machine.iter(words):
            if found[number]:
                flags[end - window + 1] = True
            found[number] = True
        out += [(row, low, high) for low, high in anchors.ranges_of(flags, window)]
    return out


def trim(body: bytes, spans: list) -> tuple[int, int, str]:
    words = body.split()
    gone = anchors.removed_mask(len(words), spans)
    kept = [w for w, g in zip(words, gone.tolist()) if not g]
    return int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype("int8")])) == 1).sum()), sha256_hex(b" ".join(kept))


def remove_repeats(docs: DataFrame, window: int = WINDOW, hot_runs: int = HOT_RUNS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row."""
    stage, shape = anchors.stage_of(docs), shape_of(window)
    rows = stage("survey", anchors.survey(docs, shape, lambda body, codes: sha256_hex(b" ".join(body.split()))))
    found = anchors.recurring(rows, docs, stage, hot_runs)
    spans = anchors.solved(anchors.pieces(found, shape), lambda block: later_occurrences(block, window), shard_bytes)
    windows = anchors.hot_windows(found, shape)
    firsts = windows.groupBy("f", "g").agg(F.min(F.struct("d", "key", "start")).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = windows.join(firsts, ["f", "g"]).where(F.struct("d", "key", "start") != F.col("first"))
    spans = spans.union(later.select("key", F.col("start").alias("low"), (F.col("start") + window).alias("high")))
    cut = anchors.trimmed(found, stage("spans", spans), trim)

    firsts = rows.groupBy("key").agg(F.min("d").alias("first"))
    named = rows.select("doc_id", "d", "key", "size", "whole").join(firsts, "key").join(cut, "key", "left")
    copy = (F.col("d") != F.col("first")) & (F.col("size") >= window)
    return named.select(
        "doc_id", F.col("size").alias("n_words"),
        F.when(copy, F.col("size")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(sha256_hex(b""))).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
    )
