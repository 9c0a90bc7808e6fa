"""Packing token pieces into fixed windows by minimum bin slack.

A document is its token ids and the end id. Ids beyond whole windows are cut at multiples of the window, so a
document gives full pieces and at most one shorter rest. Rests are dealt into shards of similar size (by a hash of
ids, content and place in the staged table, so no source, document, repeated row or missing id can fill one) and each shard is packed on its own: a window starts with the longest
rest and takes the multiset of remaining lengths whose sum comes closest to the free room, found by subset sums in
one big integer per step; the multiset is reused as often as the counts of its lengths allow.

NULL and empty texts are the end id alone. Repeated rows are packed as often as they occur; a row's place
within its shard is decided by (doc_id, start, crc), ties in input order. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage, texts

WINDOW = 4096
END_ID = 2
#: Rests per shard: a shard leaves about one window unfilled, and its table of lengths stays a few hundred kB.
SHARD_PIECES = 20_000
#: Words and stripped words whose ids a Python worker remembers, about 200 bytes each; beyond it only those of the texts
#: at hand are kept.
MEMORY_WORDS, MEMORY_CORES = 450_000, 700_000
#: Characters that are encoded together: the more, the fewer times a word is looked up.
PORTION_CHARS = 8_000_000
#: Stripped from the ends of words before they are encoded; no apostrophe, which the tokenizer treats with what follows.
PUNCTUATION = b".,!?;:#$%&*|()"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
)
PACKED = f"{PIECES}, sequence_id long, offset long"


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Ids of whole texts, equal to the tokenizer's own.

    The tokenizer drops white space, never joins across it, lowers case, and cuts between letters and punctuation. So
    the ids of a text are those of its words in order, and the ids of letters with punctuation behind them are those
    of both in turn. Words are encoded once and remembered; new ones go through the tokenizer together, as one text.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.words: dict[bytes, bytes] = {}
        self.cores: dict[bytes, bytes] = {}

    def encode(self, words: list[bytes]) -> None:
        """Fills `cores`."""
        for at in range(0, len(words), 2000):
            part = words[at : at + 2000]
            decoded = [w.decode("utf-8", "replace") for w in part]
            coded = self.tokenizer.encode(" ".join(decoded), add_special_tokens=False)
            begins = np.cumsum([0] + [len(w) + 1 for w in decoded])[:-1]
            owner = np.searchsorted(begins, np.array([a for a, _ in coded.offsets], dtype="int64"), "right") - 1
            ids = np.array(coded.ids, dtype="<u4").tobytes()
            cuts = (4 * np.searchsorted(owner, np.arange(len(part) + 1))).tolist()
            self.cores.update((word, ids[a:b]) for word, a, b in zip(part, cuts, cuts[1:]))

    def learn(self, words: set[bytes]) -> None:
        """Fills `words`."""
        parts = []
        for word in words:
            core = word.rstrip(PUNCTUATION)
            if core.isalpha() or plain_letters(core.decode("utf-8", "replace")):
                parts.append((word, core, word[len(core) :]))
            else:
                parts.append((word, word, b""))
        needed = {b"", *(p[1] for p in parts), *(p[2] for p in parts)}
        if len(self.cores) + len(needed) > MEMORY_CORES:
            self.cores = {w: self.cores[w] for w in needed if w in self.cores}
        self.cores[b""] = b""
        self.encode([w for w in needed if w not in self.cores])
        cores = self.cores
        self.words.update((word, cores[core] + cores[tail]) for word, core, tail in parts)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; call it with many texts, since new words are learnt once per call."""
        # Arrow splits at the same ASCII white space as bytes.split and tells each distinct word once; bytes stay as they are.
        whole = pa.array([lowered(text) for text in texts], pa.binary()).cast(pa.string(), safe=False)
        split = pc.ascii_split_whitespace(whole)
        coded = split.flatten().dictionary_encode()
        found = coded.dictionary.cast(pa.binary()).to_pylist()
        ids = list(map(self.words.get, found))
        missing = {word for word, known in zip(found, ids) if known is None}
        if missing:
            if len(self.words) + len(missing) > MEMORY_WORDS:
                self.words = {word: known for word, known in zip(found, ids) if known is not None}
            self.learn(missing)
            ids = list(map(self.words.__getitem__, found))
        ends = np.cumsum(np.fromiter(map(len, ids), "int64", len(ids)) // 4)
        of_words = pa.ListArray.from_arrays(np.append(0, ends).astype("int32"), np.frombuffer(b"".join(ids), dtype="<u4"))
        taken = of_words.take(coded.indices)
        cuts = taken.offsets.to_numpy()[split.offsets.to_numpy()].tolist()
        body = taken.values.to_numpy()
        return [body[a:b] for a, b in zip(cuts, cuts[1:])]


def plain_letters(word: str) -> bool:
    """Latin letters that stay letters when normalised and lower-cased (the dotted capital I does not)."""
    return word.isalpha() and max(word) < "\u0250" and "\u0130" not in word


def lowered(text: str) -> bytes:
    """ASCII letters in lower case, unless a combining mark (first byte CC or CD) could compose with one differently."""
    data = text.encode("utf-8", "surrogatepass")
    return data if b"\xcc" in data or b"\xcd" in data else data.lower()


@functools.cache
def encoder(path: str) -> WordEncoder:
    """One per Python worker, which Spark uses for many tasks."""
    return WordEncoder(path)


def portions(texts: list[str], chars: int = 4_000_000) -> Iterator[slice]:
    """Slices of the list holding about so many characters each."""
    begin = size = 0
    for at, text in enumerate(texts):
        size += len(text)
        if size >= chars:
            yield slice(begin, at + 1)
            begin, size = at + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def pieces_of(ids: np.ndarray, window: int) -> list[tuple[int, int, int]]:
    """(start, length, crc32) of each piece."""
    return [
        (start, min(window, len(ids) - start), zlib.crc32(ids[start : start + window].tobytes()))
        for start in range(0, len(ids), window)
    ]


def token_pieces(docs: DataFrame, path: str | None = None, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    path = path or tokenizer_file()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        for frame in frames:
            rows, whole, ids_of = [], [t or "" for t in frame["text"]], frame["doc_id"].tolist()
            for part in portions(whole, PORTION_CHARS):
                for doc_id, body in zip(ids_of[part], encode(whole[part])):
                    ids = np.append(body, np.array([end_id], dtype="<u4"))
                    doc_id = None if pd.isna(doc_id) else int(doc_id)
                    rows += [(doc_id, *piece, len(ids)) for piece in pieces_of(ids, window)]
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"]).astype({"doc_id": "Int64"})

    return texts(docs).mapInPandas(cut, PIECES)


def closest_fill(lengths: Iterable[tuple[int, int]], room: int) -> dict[int, int]:
    """Of (length, count), the counts to take whose sum is the largest not above `room`."""
    reach, steps, mask = 1, [], (1 << (room + 1)) - 1
    if not room:
        return {}
    for length, count in lengths:
        if length > room:
            continue
        times, count = 1, min(count, room // length)
        while count > 0:  # counts in powers of two: every number up to `count` is a sum of them
            take = min(times, count)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            count -= take
            times *= 2
        if reach >> room & 1:
            break
    total, taken = reach.bit_length() - 1, Counter()
    for length, take, before in reversed(steps):
        if not before >> total & 1:  # reached by this step alone
            taken[length] += take
            total -= length * take
    return dict(taken)


def fill_windows(lengths: list[int], window: int = WINDOW) -> list[tuple[int, dict[int, int]]]:
    """Windows as (times, {length: count}); together they use every length exactly once."""
    left = Counter(lengths)
    order = sorted(left)  # lengths that are left, in ascending order
    out = []
    while order:
        longest = order[-1]
        rest = ((n, left[n] - (n == longest)) for n in reversed(order))
        pattern = Counter(closest_fill(rest, window - longest))
        pattern[longest] += 1
        times = min(left[n] // k for n, k in pattern.items())
        for n, k in pattern.items():
            left[n] -= k * times
            if not left[n]:
                del order[bisect_left(order, n)]
        out.append((times, dict(pattern)))
    return out


def pack(pieces: DataFrame, window: int = WINDOW, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Adds sequence_id and offset to (doc_id, start, length, ...) rows. `pieces` is read twice: stage it first."""
    shards = max(1, -(-pieces.count() // shard_pieces))
    # The place of a row spreads rows without id and repeated rows, which are alike in all else.
    spread = F.xxhash64("doc_id", "start", "ids_crc32", "length", F.monotonically_increasing_id())
    dealt = pieces.withColumn("shard", F.pmod(spread, F.lit(shards)))

    def place(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "start", "ids_crc32"], kind="stable").reset_index(drop=True)
        waiting = defaultdict(list)
        for row, length in enumerate(frame["length"]):
            waiting[int(length)].append(row)
        sequence, offset = np.zeros(len(frame), "int64"), np.zeros(len(frame), "int64")
        number = 0
        for times, pattern in fill_windows(frame["length"].tolist(), window):
            for _ in range(times):
                at = 0
                for length in sorted(pattern, reverse=True):
                    for _ in range(pattern[length]):
                        row = waiting[length].pop()
                        sequence[row], offset[row] = number, at
                        at += length
                number += 1
        frame["sequence_id"], frame["offset"] = sequence + (int(key[0]) << 32), offset
        return frame.drop(columns="shard")

    return dealt.groupBy("shard").applyInPandas(place, PACKED)


def pack_documents(docs: DataFrame, path: str | None = None, window: int = WINDOW) -> DataFrame:
    stage = Stage(docs.sparkSession)
    return pack(stage("pieces", token_pieces(docs, path, window)), window)
