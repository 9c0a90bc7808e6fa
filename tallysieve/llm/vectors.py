"""Vector codes: every vector becomes one byte a part, by codebooks fitted to all vectors.

Components become integers, so that distances, sums and ties are exact and the same on any number of machines. Vectors
are cut into equal parts; each part position has a codebook, which starts as that part of the first vectors and is moved
to the mean of the parts assigned to it, round by round. All vectors take part in each round: tasks send one sum per
entry and component, which Spark adds up; the driver holds codebooks only.

The nearest entry is found by slicing and intersecting. In each dimension the coordinates of a codebook's entries are
sorted, and every prefix of that order has a bit mask of the entries in it. A first guess gives the initial radius, its
distance. Two binary searches a dimension give the range of coordinates within the radius, the exclusive or of two prefix
masks the entries in that range, and the masks of all dimensions, combined by AND, the candidates: a superset of all
entries no farther than the guess, ties included. Only candidates are measured, in the order of their indexes.

Vectors that are NULL or hold NULL or non-finite components are dropped; NULL ids stay, and come last when the first
vectors are chosen. Rows with the same id are ordered by their components. With fewer kept vectors than entries, the
codebooks have as many entries as there are vectors. The vector with the smallest id sets the number of components; rows of
another length, and all rows where that number is no multiple of the parts, have NULL code and error. NULL labels form one
group. A component of 2^26 or more after scaling is an error, since squared distances would leave 64 bits. An empty table
gives no rows. Columns beyond vec_id, embedding and label are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage, sha256_hex

SCALE = 4096
PARTS = 8
ENTRIES = 16  # at most 64: a mask is one uint64
ROUNDS = 6
LARGEST = 2**26


class Slices:
    """One codebook, sliced by dimension."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        self.order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, self.order, axis=0)
        bits = np.left_shift(np.uint64(1), self.order.astype("uint64"))
        self.prefix = np.zeros((len(entries) + 1, entries.shape[1]), "uint64")
        np.bitwise_or.accumulate(bits, axis=0, out=self.prefix[1:])

    def candidates(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """A mask per point: the entries within the radius in every dimension."""
        masks = np.full(len(points), np.uint64(2**64 - 1))
        for d in range(points.shape[1]):
            low = np.searchsorted(self.sorted[:, d], points[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[:, d], points[:, d] + radius, "right")
            masks &= self.prefix[high, d] ^ self.prefix[low, d]
        return masks

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry, ties to the lower index."""
        near = np.minimum(np.searchsorted(self.sorted[:, 0], points[:, 0]), len(self.entries) - 1)
        guess = self.entries[self.order[near, 0]]
        radius = np.sqrt(((points - guess) ** 2).sum(axis=1).astype("float64")).astype("int64") + 1
        masks = self.candidates(points, radius)
        index, least = np.zeros(len(points), "int64"), np.full(len(points), np.iinfo("int64").max)
        for entry, place in enumerate(self.entries):
            rows = np.flatnonzero(masks >> np.uint64(entry) & np.uint64(1))
            distance = ((points[rows] - place) ** 2).sum(axis=1)
            better = distance < least[rows]
            index[rows[better]], least[rows[better]] = entry, distance[better]
        return index, least


@dataclass(frozen=True)
class Codebooks:
    """`entries` has the axes part, entry, position within the part."""

    entries: np.ndarray

    @property
    def components(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def digest(self) -> str:
        return sha256_hex(",".join(map(str, self.entries.ravel().tolist())).encode())

    def assigned(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance), a row per vector and a column per part."""
        parts, _, width = self.entries.shape
        found = [Slices(self.entries[p]).nearest(vectors[:, p * width : (p + 1) * width]) for p in range(parts)]
        return np.stack([i for i, _ in found], axis=1), np.stack([d for _, d in found], axis=1)

    def vector(self, code: str) -> np.ndarray:
        """What a code stands for, in units of the scale."""
        return np.concatenate([self.entries[p][i] for p, i in enumerate(bytes.fromhex(code))])


def scaled(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, vector) of the rows that are kept; vector is an array of integers."""
    vector = F.col("embedding")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = embeddings.where(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    fits = F.forall(whole, lambda x: F.abs(x) < LARGEST)
    checked = F.when(fits, whole.cast("array<int>")).otherwise(F.raise_error(F.lit(f"components must stay below {LARGEST} after scaling")).cast("array<int>"))
    return kept.select("vec_id", "label", checked.alias("vector"))


def matrix(column: pa.ChunkedArray | pa.Array, components: int) -> np.ndarray:
    values = column.flatten() if isinstance(column, pa.Array) else column.combine_chunks().flatten()
    return values.to_numpy(zero_copy_only=False).astype("int64").reshape(-1, components)


def first_books(vectors: DataFrame, parts: int, entries: int) -> Codebooks | None:
    order = [F.col("vec_id").asc_nulls_last(), F.col("vector")]
    first = vectors.orderBy(*order).select("vector").limit(1).collect()
    components = len(first[0]["vector"]) if first else 0
    if not components or components % parts:
        return None
    rows = vectors.where(F.size("vector") == components).orderBy(*order).select("vector").limit(entries).collect()
    return Codebooks(np.array([r["vector"] for r in rows], "int64").reshape(len(rows), parts, -1).transpose(1, 0, 2).copy())


def moved(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every part is assigned, every used entry becomes the mean of its parts, rounded down."""
    parts, entries, width = books.entries.shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, entries), "int64"), np.zeros((parts, entries, width), "int64")
        for batch in batches:
            points = matrix(batch.column("vector"), books.components)
            index, _ = books.assigned(points)
            for p in range(parts):
                counts[p] += np.bincount(index[:, p], minlength=entries)
                for d in range(width):  # exact: the sums of a batch stay far below 2^53
                    sums[p, :, d] += np.bincount(index[:, p], points[:, p * width + d], entries).astype("int64")
        used = np.argwhere(counts > 0)
        yield pa.RecordBatch.from_pydict({
            "part": used[:, 0].astype("int32"), "entry": used[:, 1].astype("int32"), "n": counts[counts > 0],
            "sums": pa.array(sums[counts > 0].tolist(), pa.list_(pa.int64())),
        })

    sent = vectors.where(F.size("vector") == books.components).select("vector").mapInArrow(add_up, "part int, entry int, n long, sums array<long>")
    totals = (
        sent.select("part", "entry", "n", F.posexplode("sums").alias("at", "value")).groupBy("part", "entry", "at")
        .agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    )
    after = books.entries.copy()
    for r in totals.collect():  # one row per component of the codebooks
        after[r["part"], r["entry"], r["at"]] = int(r["total"]) // r["n"]
    return Codebooks(after)


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of staged (vec_id, label, vector) rows; None where no vector can be cut."""
    if not 0 < entries <= 64:
        raise ValueError("a codebook has 1 to 64 entries")
    books = first_books(vectors, parts, entries)
    for _ in range(rounds if books else 0):
        books = moved(vectors, books)
    return books


def encode(vectors: DataFrame, books: Codebooks | None) -> DataFrame:
    """(vec_id, label, code, error) of every row of (vec_id, label, vector)."""
    none = (F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    if books is None:
        return vectors.select("vec_id", "label", *none)
    fits = F.size("vector") == books.components

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, distance = books.assigned(matrix(batch.column("vector"), books.components))
            codes = [row.tobytes().hex() for row in index.astype("uint8")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array(distance.sum(axis=1))],
                ["vec_id", "label", "code", "error"],
            )

    kinds = dict(vectors.dtypes)
    coded = vectors.where(fits).mapInArrow(code, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")
    return coded.unionByName(vectors.where(~fits).select("vec_id", "label", *none))


def compress(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """Codes with their error, the error of all rows with the same label, and the digest of the codebooks."""
    stage = Stage(embeddings.sparkSession)
    vectors = stage("vectors", scaled(embeddings, scale))
    books = train(vectors, parts, entries, rounds)
    coded = stage("codes", encode(vectors, books))
    by_label = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    digest = books.digest() if books else sha256_hex(b"")
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same in SQL, by comparing every part with every entry; for vectors of one length that the parts divide."""
    steps = [
        f"kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})::BIGINT) AS v FROM embeddings "
        "WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "numbered AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r, * FROM kept)",
        f"long AS (SELECT r, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS c, len(v) // {parts} AS w FROM numbered)",
        "cut AS MATERIALIZED (SELECT r, c // w AS part, c % w AS place, x FROM long)",
        f"b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, place, x AS y FROM cut WHERE r <= {entries})",
    ]
    for k in range(rounds + 1):
        steps.append(f"d{k} AS (SELECT r, part, entry, sum((x - y) * (x - y)) AS d FROM cut JOIN b{k} USING (part, place) GROUP BY r, part, entry)")
        steps.append(f"n{k} AS MATERIALIZED (SELECT r, part, min(d * {entries} + entry) AS best FROM d{k} GROUP BY r, part)")
        if k < rounds:
            steps.append(f"s{k} AS (SELECT part, best % {entries} AS entry, place, sum(x) AS s, count(*) AS n FROM cut JOIN n{k} USING (r, part) GROUP BY ALL)")
            steps.append(f"b{k + 1} AS MATERIALIZED (SELECT part, entry, place, CASE WHEN n IS NULL THEN y ELSE ((s - ((s % n) + n) % n) // n)::BIGINT END AS y FROM b{k} LEFT JOIN s{k} USING (part, entry, place))")
    steps.append(f"coded AS (SELECT r, string_agg(printf('%02x', (best % {entries})::INT), '' ORDER BY part) AS code, sum(best // {entries})::BIGINT AS error FROM n{rounds} GROUP BY r)")
    return (
        "WITH " + ",\n".join(steps) + "\nSELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, "
        f"(SELECT sha256(string_agg(y::VARCHAR, ',' ORDER BY part, entry, place)) FROM b{rounds}) AS codebooks_sha256 FROM numbered JOIN coded USING (r)"
    )
