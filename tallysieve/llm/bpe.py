"""BPE encoding and decoding of whole texts, with reuse of content-defined chunks.

A rolling hash of the last bytes cuts every text into chunks, so that equal passages give equal chunks whatever stands
before them. Chunks that occur at more than one place are encoded once for all documents; the rest of a document is
encoded where it is read, and a document without such chunks is finished there.

A shared chunk lends a document the ids of its inside, from its first white space to its last. What lies between two
insides, with the words that a cut went through, is re-encoded as one text, together with the next word of the inside on
either side. If the ids of these two words come out as they are within the chunk, the join agrees; if not, the
chunk on that side is given up, its bytes go to the text between, and the join is tried again, down to a document that is
encoded whole. The tokenizer drops white space and never joins across it, so disagreement needs another tokenizer.

How chunks are found to be shared: their digests are counted in 2^27 buckets by partial aggregates, and the buckets
that hold two chunks or more become a filter of 16 MB, its largest size, that every task gets. A chunk that passes it by
chance is dealt out like a shared one. On a corpus of many more chunks than buckets nearly all pass: then all chunks are
dealt out, each is still encoded once, and the shuffle grows to that of the texts and their ids. No case is dropped.

Chunks travel by digest, once a task; what a document has of its own travels as one row under the number of its row, so that no source, id,
repeated row or common chunk gathers in one task. NULL and empty texts have no ids. Texts of any length are cut alike, and are
held by one task each. Special tokens' strings in a text are those tokens, as the library has it by default. Repeated
rows and rows without id each give their own row. An empty table gives no rows; columns beyond doc_id and text are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import Stage, texts
from .packing import encoder, portions, tokenizer_file

#: Bytes that the rolling hash sees, mean length of a chunk beyond the least, least length.
SPAN, MEAN, LEAST = 16, 512, 128
FILTER_BITS = 27
GAPS = b" \n\t"
DONE, PARTIAL, CHUNK = range(3)

Finish = Callable[[np.ndarray], tuple]


@functools.cache
def byte_values() -> np.ndarray:
    return np.random.default_rng(12).integers(0, 2**32, 256, dtype="uint32")


def cut_points(data: np.ndarray, mean: int = MEAN) -> np.ndarray:
    """Where chunks may end: behind a byte at which the rolling hash is small, at the start of a character."""
    hashes, factor, seen = byte_values()[data], 2654435761, 1
    while seen < SPAN:  # from the hash of `seen` bytes to that of twice as many
        longer = hashes.copy()
        longer[seen:] += hashes[:-seen] * np.uint32(factor)
        hashes, factor, seen = longer, factor * factor % 2**32, 2 * seen
    cuts = np.flatnonzero((hashes * np.uint32(2654435769)) >> np.uint32(8) < (1 << 24) // mean) + 1
    cuts = cuts[cuts < len(data)]
    return cuts[data[cuts] & 0xC0 != 0x80]


def chunks_of(encoded: list[bytes], mean: int = MEAN, least: int = LEAST) -> Iterator[list[bytes]]:
    """The chunks of each text; joined, they are the text."""
    whole = b"".join(encoded)
    cuts = cut_points(np.frombuffer(whole, "uint8"), mean) if whole else np.zeros(0, "int64")
    ends = np.cumsum([len(e) for e in encoded])
    begins = ends - [len(e) for e in encoded]
    low, high = np.searchsorted(cuts, begins + SPAN), np.searchsorted(cuts, ends)  # no window reaches into the text before
    for begin, end, a, z in zip(begins.tolist(), ends.tolist(), low, high):
        out, last = [], begin
        for cut in cuts[a:z].tolist():
            if cut - last >= least:
                out.append(whole[last:cut])
                last = cut
        if end > last:
            out.append(whole[last:end])
        yield out


def digest_of(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def bucket_of(digest: bytes, bits: int) -> int:
    return int.from_bytes(digest[:8], "little") & ((1 << bits) - 1)


def inside_of(chunk: bytes) -> tuple[int, int] | None:
    """From the first white space to behind the last; None unless there are two words between them."""
    found = [k for k in (chunk.find(g) for g in (b" ", b"\n", b"\t")) if k >= 0]
    if not found:
        return None
    first, last = min(found), max(chunk.rfind(g) for g in (b" ", b"\n", b"\t"))
    return (first, last + 1) if len(chunk[first:last].split(None, 2)) >= 2 else None


def edge_words(inside: bytes) -> tuple[bytes, bytes]:
    """The first word with the white space before it, the last with that behind it."""
    body = inside.lstrip(GAPS)
    ahead = inside[: len(inside) - len(body)] + body.split(None, 1)[0]
    body = inside.rstrip(GAPS)
    return ahead, body.rsplit(None, 1)[-1] + inside[len(body) :]


class Coder:
    """Ids of texts given as UTF-8, as the library gives them."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.words = encoder(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.tokens = [self.tokenizer.id_to_token(k) for k in range(self.tokenizer.get_vocab_size())]
        self.numbers = [str(k) for k in range(len(self.tokens))]
        self.kind = "<u2" if len(self.tokens) <= 1 << 16 else "<u4"  # of ids on their way between tasks

    def encode(self, parts: list[bytes]) -> list[np.ndarray]:
        strings = [p.decode("utf-8", "surrogatepass") for p in parts]
        odd = [k for k, p in enumerate(parts) if any(s in p for s in self.special)]
        ids = self.words(["" if k in odd else s for k, s in enumerate(strings)] if odd else strings)
        for k in odd:
            ids[k] = np.array(self.tokenizer.encode(strings[k], add_special_tokens=False).ids, "<u4")
        return ids

    def decode(self, ids: np.ndarray) -> str:
        if self.tokenizer.decoder is None:  # then the library joins tokens by spaces
            return " ".join(map(self.tokens.__getitem__, ids.tolist()))
        return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)

    def decimals(self, ids: np.ndarray) -> str:
        return " ".join(map(self.numbers.__getitem__, ids.tolist()))


@functools.cache
def coder(path: str) -> Coder:
    """One per Python worker."""
    return Coder(path)


class Plan:
    """How one document is put together: texts to encode, with shared insides between them."""

    def __init__(self, chunks: list[bytes], shared: list[tuple[int, bytes, tuple[int, int]]]) -> None:
        self.chunks, self.shared = chunks, shared

    def give_up(self, chosen: set[int]) -> Plan:
        return Plan(self.chunks, [s for s in self.shared if s[0] not in chosen])

    def betweens(self) -> list[tuple[bytes, bytes, bytes]]:
        """One more than insides: (word before, text, word behind), the words being those of the insides."""
        out, at, tail, before = [], 0, b"", b""
        for k, _, (first, last) in self.shared:
            chunk = self.chunks[k]
            ahead, behind = edge_words(chunk[first:last])
            out.append((before, tail + b"".join(self.chunks[at:k]) + chunk[:first], ahead))
            at, tail, before = k + 1, chunk[last:], behind
        return [*out, (before, tail + b"".join(self.chunks[at:]), b"")]


def repaired(plans: list[Plan], encode: Callable[[list[bytes]], list[np.ndarray]]) -> list[tuple[Plan, list[np.ndarray]]]:
    """Each document's plan with the ids of its texts between insides, after all its joins agree."""
    out: list = [None] * len(plans)
    open_plans = list(enumerate(plans))
    while open_plans:
        parts = [(n, j, *b) for n, (_, plan) in enumerate(open_plans) for j, b in enumerate(plan.betweens())]
        ids = encode([before + text + behind for _, _, before, text, behind in parts])
        words = sorted({w for p in parts for w in (p[2], p[4]) if w})
        own = dict(zip(words, encode(words)))
        nothing = np.zeros(0, "<u4")
        found: list = [([], set()) for _ in open_plans]
        for (n, j, before, _, behind), joined in zip(parts, ids):
            left, right = own.get(before, nothing), own.get(behind, nothing)
            end = len(joined) - len(right)
            shared = open_plans[n][1].shared
            if not np.array_equal(joined[: len(left)], left) or end < len(left):
                found[n][1].add(shared[j - 1][0] if before else shared[j][0])
            if not np.array_equal(joined[max(end, 0) :], right):
                found[n][1].add(shared[j][0] if behind else shared[j - 1][0])
            found[n][0].append(joined[len(left) : end])
        again = []
        for (place, plan), (pieces, refused) in zip(open_plans, found):
            if refused:
                again.append((place, plan.give_up(refused)))
            else:
                out[place] = (plan, pieces)
        open_plans = again
    return out


def shared_filter(docs: DataFrame, bits: int, mean: int, least: int) -> np.ndarray:
    """A bit for each bucket that holds two chunks or more; at most 2^(bits - 5) words reach the driver."""

    def buckets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            whole = [(t or "").encode("utf-8", "surrogatepass") for t in frame["text"]]
            for part in portions(whole):
                yield pd.DataFrame({"bucket": [bucket_of(digest_of(c), bits) for chunks in chunks_of(whole[part], mean, least) for c in chunks]}, dtype="int64")

    often = docs.select("text").mapInPandas(buckets, "bucket long").groupBy("bucket").count().where("count > 1")
    words = often.groupBy(F.shiftright("bucket", 5).alias("word")).agg(F.expr("bit_or(shiftleft(1L, int(bucket & 31)))").alias("mask")).toArrow()
    out = np.zeros(1 << (bits - 5), "uint32")
    out[words["word"].to_numpy()] = words["mask"].to_numpy().astype("uint32")
    return out


def encoded(
    docs: DataFrame, finish: Finish | None = None, schema: str = "ids binary", path: str | None = None,
    bits: int = FILTER_BITS, mean: int = MEAN, least: int = LEAST,
) -> DataFrame:
    """doc_id with what `finish` makes of a document's ids, applied in the task where they are complete.

    Without it: the ids, as little-endian unsigned 32-bit numbers.
    """
    path, finish = path or tokenizer_file(), finish or (lambda ids: (ids.tobytes(),))
    spark = docs.sparkSession
    stage = Stage(spark)
    docs = texts(docs)
    filled = spark.sparkContext.broadcast(shared_filter(docs, bits, mean, least))
    names = StructType.fromDDL(schema).names
    # PARTIAL: ids and lengths of the texts between insides, digests of the chunks; CHUNK: a digest and an inside.
    parts_schema = f"kind int, row long, doc_id long, payload binary, lengths array<int>, digests array<binary>, {schema}"
    columns = ["kind", "row", "doc_id", "payload", "lengths", "digests", *names]

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, sent = filled.value, set()
        encode, kind = coder(path).encode, coder(path).kind
        blank = (None,) * len(names)
        for frame in frames:
            whole = [(t or "").encode("utf-8", "surrogatepass") for t in frame["text"]]
            ids_of, rows_of = frame["doc_id"].tolist(), frame["row"].tolist()
            for part in portions(whole):
                plans, out = [], []
                for chunks in chunks_of(whole[part], mean, least):
                    shared = []
                    for k, chunk in enumerate(chunks):
                        digest = digest_of(chunk)
                        bucket = bucket_of(digest, bits)
                        if words[bucket >> 5] >> np.uint32(bucket & 31) & 1 and (inside := inside_of(chunk)):
                            shared.append((k, digest, inside))
                    plans.append(Plan(chunks, shared))
                for doc_id, row, (plan, pieces) in zip(ids_of[part], rows_of[part], repaired(plans, encode)):
                    doc_id = None if pd.isna(doc_id) else int(doc_id)
                    if not plan.shared:
                        out.append((DONE, row, doc_id, None, None, None, *finish(pieces[0])))
                        continue
                    own = np.concatenate(pieces).astype(kind).tobytes()
                    out.append((PARTIAL, row, doc_id, own, [len(p) for p in pieces], [d for _, d, _ in plan.shared], *blank))
                    for k, digest, (first, last) in plan.shared:
                        if digest not in sent:
                            sent.add(digest)
                            out.append((CHUNK, None, None, plan.chunks[k][first:last], None, [digest], *blank))
                yield pd.DataFrame(out, columns=columns, dtype=object)

    parts = stage("parts", docs.withColumn("row", F.monotonically_increasing_id()).mapInPandas(cut, parts_schema))

    def encode_once(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ids = coder(path).encode([bytes(p) for p in frame["payload"]])
            yield pd.DataFrame({"digest": frame["digest"], "lent": [i.astype(coder(path).kind).tobytes() for i in ids]})

    chunks = parts.where(F.col("kind") == CHUNK).select(F.col("digests")[0].alias("digest"), "payload").dropDuplicates(["digest"])
    lent = stage("lent", chunks.mapInPandas(encode_once, "digest binary, lent binary"))
    partial = parts.where(F.col("kind") == PARTIAL)
    asked = partial.select("row", F.posexplode("digests").alias("n", "digest"))
    none = (F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("array<int>").alias("lengths"))
    pieces = partial.select("row", F.lit(-1).alias("n"), F.col("payload").alias("ids"), "doc_id", "lengths")
    pieces = pieces.unionByName(asked.join(lent, "digest").select("row", "n", F.col("lent").alias("ids"), *none))

    def put_together(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kind, out = np.dtype(coder(path).kind), []
        rows = (r for frame in frames for r in frame.astype({"doc_id": "object"}).itertuples(index=False))
        for _, group in groupby(rows, key=lambda r: r.row):
            own = next(group)
            ends = kind.itemsize * np.cumsum([0, *own.lengths])
            parts = [own.ids[a:z] for a, z in zip(ends.tolist(), ends.tolist()[1:])]
            whole = b"".join([parts[0], *(x for r, text in zip(group, parts[1:]) for x in (r.ids, text))])
            doc_id = None if pd.isna(own.doc_id) else int(own.doc_id)
            out.append((doc_id, *finish(np.frombuffer(whole, kind).astype("<u4"))))
            if len(out) >= 500:
                yield pd.DataFrame(out, columns=["doc_id", *names], dtype=object)
                out = []
        yield pd.DataFrame(out, columns=["doc_id", *names], dtype=object)

    together = pieces.repartition("row").sortWithinPartitions("row", "n").mapInPandas(put_together, f"doc_id long, {schema}")
    stage.free()
    return parts.where(F.col("kind") == DONE).select("doc_id", *names).unionByName(together)


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Number of tokens of every document, digests of its ids and of the text decoded from them."""
    path = path or tokenizer_file()

    def digests(ids: np.ndarray) -> tuple[int, str, str]:
        both = coder(path)
        return len(ids), hashlib.sha256(both.decimals(ids).encode()).hexdigest(), hashlib.sha256(both.decode(ids).encode()).hexdigest()

    return encoded(docs, digests, DIGESTS, path, **options)
