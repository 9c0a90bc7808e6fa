"""Near-duplicates by probability minwise hashing of weighted shingles, banding, and exact verification.

A shingle is five words in a row, its weight how often it occurs; texts of one to four words are one shingle. Each
shingle is a Poisson process whose rate is its weight; every arrival falls on a random register, which keeps the first
one. Processes end as soon as they cannot come first anywhere. Two texts agree on a register with probability equal to
their probability Jaccard similarity. Registers are banded; texts that share a band are candidates, and a pair is a
link if its exact similarity is at least the threshold. Linked documents form classes.

Equal word sequences are put together first, so copies cost one row each. In a bucket all texts are compared with one
leader. Where a bucket then still holds several classes, every text outside its largest class is compared with all others,
in blocks of bounded size: a task holds two blocks, counts the shingles that each pair has in common through an index of
one block, settles pairs of texts without repeated shingles by that count, others exactly where the shared mass allows it,
and sends only links that join classes. No pair becomes a row, and no link is lost. A group of texts that are alike below the
threshold costs these counts for all its pairs, which is the price of an exact answer.

Texts are what is classified: rows that share a doc_id but not their words each belong to the class of their own words.
A class is named by its smallest doc_id, and the first of its words with that id stands for it. NULL, empty and blank texts are
classes of their own. Rows without doc_id are returned without a class and kept. Where repeated rows stand for a class,
all of them are marked kept. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage, batches_of, texts, words_of

SHINGLE, THRESHOLD = 5, 0.8
#: At similarity 0.8 a pair shares none of the bands with probability 6e-7.
BANDS, REGISTERS_PER_BAND = 36, 5
REGISTERS = BANDS * REGISTERS_PER_BAND
#: Shingles in a block of texts that one task holds.
BLOCK_SHINGLES = 400_000
PORTION = 2_000_000
#: Rows sent to Python at once; a pair carries the shingles of two texts, which take megabytes where texts are long.
BATCH_ROWS = 100

MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def shingles(words: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of the shingles, in order."""
    if not words:
        return np.empty(0, "uint64")
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), "uint64", len(words))
    size = min(size, len(words))
    out = np.zeros(len(codes) - size + 1, "uint64")
    for k in range(size):
        out = mix(out * STEP + codes[k : k + len(out)] + np.uint64(1))
    return out


def weighted(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, weight) of the distinct shingles of many texts."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets) if sets else np.empty(0, "uint64")
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    first = np.ones(len(values), bool)
    first[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    return owner[at], values[at], np.diff(np.append(at, len(values)))


def signatures(sets: list[np.ndarray], registers: int = REGISTERS) -> np.ndarray:
    """The shingle that arrives first at each register, for each text; texts without shingles keep zeros."""
    owner, element, weight = weighted(sets)
    arrival = np.full(len(sets) * registers, np.inf)
    winner = np.zeros(len(sets) * registers, "uint64")
    last = np.full(len(sets), np.inf)
    time = np.zeros(len(element))
    rate = 1.0 / weight
    turn = np.zeros(1, "uint64")
    while len(element):
        turn += STEP
        random = mix(element + turn)
        time = time - np.log1p(-((random >> np.uint64(11)).astype("float64") * 2.0**-53)) * rate
        alive = time < last[owner]
        owner, element, time, rate, random = owner[alive], element[alive], time[alive], rate[alive], random[alive]
        place = owner * registers + (mix(random) % np.uint64(registers)).astype("int64")
        np.minimum.at(arrival, place, time)
        won = time == arrival[place]
        winner[place[won]] = element[won]
        last = arrival.reshape(len(sets), registers).max(axis=1)
    return winner.reshape(len(sets), registers)


def band_hashes(winners: np.ndarray, bands: int = BANDS) -> np.ndarray:
    per = winners.reshape(len(winners), bands, -1)
    out = np.arange(bands, dtype="uint64")[None, :] * STEP + np.zeros((len(winners), 1), "uint64")
    for k in range(per.shape[2]):
        out = mix(out * STEP + per[:, :, k])
    return out.view("int64")


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Exact probability Jaccard similarity of two lists of shingles."""
    if not len(a) or not len(b):
        return 0.0
    values, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    x = np.bincount(where[: len(a)], minlength=len(values)).astype("float64")
    y = np.bincount(where[len(a) :], minlength=len(values)).astype("float64")
    both = (x > 0) & (y > 0)
    with np.errstate(divide="ignore"):
        ratio = x / y
    order = np.argsort(ratio)
    steps = ratio[order]
    sum_x = np.concatenate([[0.0], np.cumsum(x[order])])
    sum_y = np.concatenate([[0.0], np.cumsum(y[order])])
    cut = np.searchsorted(steps, ratio[both], "right")
    return float((1.0 / ((sum_x[-1] - sum_x[cut]) / x[both] + sum_y[cut] / y[both])).sum())


def key_of(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, key of the word sequence, number of shingles and bands of every row with an id and a word."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ids, keys, sets, size = [], [], [], 0
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                if words := words_of(text):
                    ids.append(doc_id)
                    keys.append(key_of(words))
                    sets.append(shingles(words))
                    size += len(text)
                if size > PORTION:
                    yield pd.DataFrame({"doc_id": ids, "key": keys, "n": [len(s) for s in sets], "bands": list(band_hashes(signatures(sets)))})
                    ids, keys, sets, size = [], [], [], 0
            if ids:
                yield pd.DataFrame({"doc_id": ids, "key": keys, "n": [len(s) for s in sets], "bands": list(band_hashes(signatures(sets)))})

    return texts(docs).where("doc_id is not null").mapInPandas(run, "doc_id long, key binary, n long, bands array<long>")


def bodies_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, grams): the shingles, in order, of the texts in `wanted` (key, doc_id)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            words = [words_of(t) for t in frame["text"]]
            yield pd.DataFrame({"key": [key_of(w) for w in words], "grams": [shingles(w).tobytes() for w in words]})

    rows = texts(docs).join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    found = rows.select("text").mapInPandas(run, "key binary, grams binary")
    return found.join(wanted.select("key"), "key", "left_semi").dropDuplicates(["key"])


def verified(pairs: DataFrame, bodies: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of keys whose texts are similar enough."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keep = [similarity(np.frombuffer(s, "uint64"), np.frombuffer(t, "uint64")) >= threshold for s, t in zip(frame["grams_a"], frame["grams_b"])]
            yield frame.loc[keep, ["a", "b"]]

    first = bodies.select(F.col("key").alias("a"), F.col("grams").alias("grams_a"))
    second = bodies.select(F.col("key").alias("b"), F.col("grams").alias("grams_b"))
    return pairs.join(second, "b").join(first, "a").mapInPandas(run, "a binary, b binary")


class Block:
    """Texts with an index from shingle to the texts that hold it."""

    def __init__(self, grams: list[np.ndarray]) -> None:
        self.grams = grams
        self.owner, self.values, _ = weighted(grams)
        order = np.argsort(self.values, kind="stable")
        self.holders = self.owner[order]
        self.shingles, first = np.unique(self.values[order], return_index=True)
        self.first = np.append(first, len(order))
        self.distinct = np.bincount(self.owner, minlength=len(grams))
        self.plain = self.distinct == [len(g) for g in grams]

    def alike(self, other: np.ndarray, threshold: float, ask: np.ndarray) -> np.ndarray:
        """Which texts of the block, among those asked for, are similar enough to another one."""
        values, weights = np.unique(other, return_counts=True)
        at = np.searchsorted(self.shingles, values)
        at[at == len(self.shingles)] = 0
        found = self.shingles[at] == values if len(self.shingles) else np.zeros(len(values), bool)
        at, weights = at[found], weights[found]
        lengths = self.first[at + 1] - self.first[at]
        places = np.repeat(self.first[at] - np.append(0, np.cumsum(lengths)[:-1]), lengths) + np.arange(lengths.sum())
        holders = self.holders[places]
        common = np.bincount(holders, minlength=len(self.grams))
        mass = np.bincount(holders, np.repeat(weights, lengths), len(self.grams)) / len(other)
        # Probability Jaccard is never above the mass that one side has in common with the other.
        hopeful = ask & (mass >= threshold - 1e-9)
        jaccard = common / (self.distinct + len(values) - common)
        sure = self.plain & (len(values) == len(other)) & (abs(jaccard - threshold) > 1e-9)
        out = hopeful & sure & (jaccard >= threshold)
        for k in np.flatnonzero(hopeful & ~sure):
            out[k] = similarity(self.grams[k], other) >= threshold
        return out


def joining_links(some: pd.DataFrame, others: pd.DataFrame, threshold: float) -> list[tuple[bytes, bytes]]:
    """Pairs of classes that similar texts of two blocks (class, grams) join: a spanning forest, nothing more."""
    classes_, numbers = np.unique(np.array([*some["class"], *others["class"]], object), return_inverse=True)
    name = np.arange(len(classes_))  # of the joined class, for each class
    own, theirs = numbers[: len(some)], numbers[len(some) :]
    block = Block([np.frombuffer(g, "uint64") for g in some["grams"]])
    out = []
    for number, grams in zip(theirs, others["grams"]):
        apart = name[own] != name[number]
        if not apart.any():
            continue
        for k in np.flatnonzero(block.alike(np.frombuffer(grams, "uint64"), threshold, apart)):
            low, high = sorted((name[own[k]], name[number]))
            if low != high:
                out.append((bytes(classes_[low]), bytes(classes_[high])))
                name[name == high] = low
    return out


def connected(links: DataFrame, stage: Stage, label: str) -> DataFrame:
    """(class, to): the smallest key of its component for every key in the links (ca, cb)."""
    ends = links.select(F.col("ca").alias("class")).union(links.select("cb")).distinct()
    named = stage(f"{label}-0", ends.withColumn("to", F.col("class")))
    turn = 0
    while True:
        turn += 1
        a = named.select(F.col("class").alias("ca"), F.col("to").alias("ta"))
        b = named.select(F.col("class").alias("cb"), F.col("to").alias("tb"))
        apart = links.join(a, "ca").join(b, "cb").where("ta <> tb")
        hooks = apart.select(F.greatest("ta", "tb").alias("to"), F.least("ta", "tb").alias("on")).groupBy("to").agg(F.min("on").alias("on"))
        hooks = stage(f"{label}-{turn}-hooks", hooks)
        if hooks.isEmpty():
            return named
        # A key hooked to one that is itself hooked goes further with it at once.
        further = hooks.select(F.col("to").alias("on"), F.col("on").alias("beyond"))
        hooks = hooks.join(further, "on", "left").select("to", F.coalesce("beyond", "on").alias("on"))
        named = stage(f"{label}-{turn}", named.join(hooks, "to", "left").select("class", F.coalesce("on", "to").alias("to")))


def renamed(rows: DataFrame, merged: DataFrame) -> DataFrame:
    """`rows` with their class replaced where it was merged into another."""
    others = [c for c in rows.columns if c != "class"]
    return rows.join(merged, "class", "left").select(*others, F.coalesce("to", "class").alias("class"))


def compared_blocks(members: DataFrame, bodies: DataFrame, threshold: float, block: int) -> DataFrame:
    """Links (ca, cb) between classes that meet in a bucket; `members` is (bucket, key, n, class) of buckets with several."""
    size = members.groupBy("bucket", "class").agg(F.count("*").alias("texts"), F.sum("n").alias("n"))
    most = size.groupBy("bucket").agg(F.max_by("class", F.struct("texts", "class")).alias("largest"), F.sum("n").alias("all"), F.max_by("n", F.struct("texts", "class")).alias("n"))
    plan = most.select("bucket", "largest", F.ceil((F.col("all") - F.col("n")) / block).alias("some_blocks"), F.ceil(F.col("all") / block).alias("other_blocks"))
    dealt = members.join(plan, "bucket")
    # Blocks are dealt by hash: sizes are even without any order within a bucket.
    block_of = lambda blocks: F.pmod(F.xxhash64("key"), F.col(blocks))
    each = lambda blocks: F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1))
    some = dealt.where(F.col("class") != F.col("largest")).select("bucket", "key", "class", block_of("some_blocks").alias("x"), each("other_blocks").alias("y"))
    others = dealt.select("bucket", "key", "class", block_of("other_blocks").alias("y"), each("some_blocks").alias("x"))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(joining_links(left, right, threshold) if len(left) and len(right) else [], columns=["ca", "cb"])

    place = ("bucket", "x", "y")
    # New names on each side: both come from the same tables.
    left, right = (f.join(bodies, "key").select(*place, "class", "grams").toDF(*place, "class", "grams").groupBy(*place) for f in (some, others))
    return left.cogroup(right).applyInPandas(run, "ca binary, cb binary").distinct()


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the class) and kept (what stands for it), a row per row of `docs`."""
    return classified(docs, threshold).select("doc_id", "class_id", "kept")


def classified(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The same with the key of the row's words, NULL for rows without id or words."""
    with batches_of(docs.sparkSession, BATCH_ROWS):
        rows, owners = merged_classes(docs, Stage(docs.sparkSession), threshold)
    # The smallest id of each class, and of its words with that id the first key.
    named = owners.groupBy("class").agg(F.min(F.struct("doc_id", "key")).alias("first"))
    by_key = owners.join(named, "class").select("key", F.col("first.doc_id").alias("class_id"), F.col("first.key").alias("stands"))
    found = rows.select("doc_id", "key").join(by_key, "key")
    kept = (F.col("doc_id") == F.col("class_id")) & (F.col("key") == F.col("stands"))
    wordless = texts(docs).where(F.col("doc_id").isNull() | ~F.coalesce(F.col("text"), F.lit("")).rlike("[^\\x20\\x09-\\x0D]"))
    alone = wordless.select("doc_id", F.lit(None).cast("binary").alias("key"), F.col("doc_id").alias("class_id"), F.lit(True).alias("kept"))
    return found.select("doc_id", "key", "class_id", kept.alias("kept")).unionByName(alone)


def merged_classes(docs: DataFrame, stage: Stage, threshold: float, block: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key, n, bands) of all rows with words, and (key, doc_id, class) with the smallest id of each key; both written."""
    rows = stage("sketch", sketch(docs))
    # Partial aggregation keeps one row per word sequence and task, however many copies there are.
    first = stage("first", rows.groupBy("key").agg(F.min(F.struct("doc_id", "n", "bands")).alias("r")).select("key", "r.*"))
    members = first.select(F.explode("bands").alias("bucket"), "key", "n").distinct()
    shared = members.groupBy("bucket").agg(F.min("key").alias("leader"), F.count("*").alias("texts")).where("texts > 1").drop("texts")
    members = stage("members", members.join(shared, "bucket"))
    pairs = stage("pairs", members.where("key <> leader").select(F.col("leader").alias("a"), F.col("key").alias("b")).distinct())
    wanted = first.join(members.select("key").distinct(), "key", "left_semi").select("key", "doc_id")
    bodies = stage("bodies", bodies_of(docs, wanted))
    links = stage("links", verified(pairs, bodies, threshold).select(F.col("a").alias("ca"), F.col("b").alias("cb")))
    merges = [connected(links, stage, "classes")]

    members = renamed(members.select("bucket", "key", "n", F.col("key").alias("class")), merges[0])
    mixed = members.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high")
    members = stage("mixed", members.join(mixed.select("bucket"), "bucket"))
    links = stage("more_links", compared_blocks(members, bodies, threshold, block or BLOCK_SHINGLES))
    merges.append(connected(links, stage, "merged"))

    owners = first.select("key", "doc_id", F.col("key").alias("class"))
    for merged in merges:
        owners = renamed(owners, merged)
    return rows, stage("owners", owners)


def deduplicated(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, all columns, that stand for their class; of repeated rows one stays, without id all do."""
    none = F.lit(b"")
    judged = classified(docs, threshold).where("doc_id is not null").select("doc_id", F.coalesce("key", none).alias("key"), "kept")
    by_id = judged.groupBy(F.col("doc_id").alias("__id")).agg((F.min("key") < F.max("key")).alias("__several"), F.max("kept").alias("__any"))
    by_id = Stage(docs.sparkSession)("by_id", by_id)
    named = F.col("doc_id").cast("long") == F.col("__id")
    of_one_text = docs.join(by_id.where("not __several and __any"), named, "left_semi").dropDuplicates(["doc_id"])

    @F.pandas_udf("binary")
    def row_key(text: pd.Series) -> pd.Series:
        return pd.Series([key_of(w) if (w := words_of(t)) else b"" for t in text])

    # Ids with several texts: each row is judged by its own words.
    mixed = docs.join(by_id.where("__several"), named, "left_semi").withColumn("__key", row_key(F.col("text").cast("string")))
    stay = judged.where("kept").select(F.col("doc_id").alias("__id"), F.col("key").alias("__stays")).distinct()
    mixed = mixed.join(stay, named & (F.col("__key") == F.col("__stays")), "left_semi").dropDuplicates(["doc_id", "__key"]).drop("__key")
    return of_one_text.unionByName(mixed).unionByName(docs.where("doc_id is null"))
