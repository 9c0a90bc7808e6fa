"""A Merkle manifest of a dataset, with inclusion proofs, by butterfly exchange.

Every row is a leaf: the hash of its fields, each with its length. The leaves of a source, ordered by doc_id, are the
lowest level of a tree in which every run of `fanout` neighbours becomes their hash; the sources' roots, ordered by
source, are the leaves of a tree above.

Leaves are ranked by a range shuffle and per-partition counts, never by a window over a source, and cut into aligned
blocks of `fanout ** levels` leaves. A block hashes its own tree in one task. Then blocks exchange roots: in round r
each block gets, from one partner in each of its `fanout - 1` sibling subtrees, the root of that subtree, and hashes
the common ancestor itself. All blocks below an ancestor do so, redundantly; in return every block leaves the last round
with the upper part of its proofs and with the root, and nothing travels down. Where the last subtree is smaller than
its siblings, its members answer for the partners it lacks, by turns. A round moves `fanout` digests a block.

Leaves of a NULL source form a source of their own, which comes first; rows without doc_id come first in their source.
NULL fields are hashed as NULL, which differs from empty. Rows of one source and doc_id are ordered by their leaf, so
repeated rows are interchangeable; each has its proof. Texts of any length are hashed where they are read and do not
travel. An empty table has no rows and no root. Columns beyond the five of documents take no part.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Stage

FANOUT = 3
#: Levels that a block hashes on its own: 2,187 leaves.
LEVELS = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PROVEN = "leaf string, tree_root string, lefts array<string>, rights array<string>"


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(*fields: Column) -> Column:
    return F.sha2(F.concat(*[field(f) for f in fields]), 256)


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climb(nodes: list[str], fanout: int, levels: int | None) -> list[list[str]]:
    """The nodes of each level: `levels` hashings above the given one, or (None) until one node remains."""
    out = [nodes]
    while len(out[-1]) > 1 if levels is None else len(out) <= levels:
        below = out[-1]
        out.append([digest(below[k : k + fanout]) for k in range(0, len(below), fanout)])
    return out


def siblings(levels: list[list[str]], at: int, fanout: int) -> tuple[list[str], list[str]]:
    """For each level but the last: what lies left and right of the node's place in its run."""
    lefts, rights = [], []
    for nodes in levels[:-1]:
        run = at - at % fanout
        lefts.append("".join(nodes[run:at]))
        rights.append("".join(nodes[at + 1 : run + fanout]))
        at //= fanout
    return lefts, rights


def ranked(leaves: DataFrame, order: list[str], block: int, stage: Stage, name: str) -> DataFrame:
    """Adds each leaf's block and place in it, and how many leaves its group has; `leaves` is a staged table.

    A range shuffle by (group, order) makes partitions that follow each other; `row` lets even repeated rows be split.
    """
    ordered = leaves.repartitionByRange("group", *order, "row").sortWithinPartitions("group", *order, "row")
    ordered = stage(f"{name}_ordered", ordered.drop("row").withColumn("at", F.monotonically_increasing_id()))
    ordered = ordered.withColumn("part", F.shiftright("at", 33))
    counts = ordered.groupBy("group", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    parts = Window.partitionBy("group")  # at most a row for each partition
    earlier = F.sum("n").over(parts.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("group", "part", (F.coalesce(earlier, F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(parts).alias("leaves"))
    placed = ordered.join(stage(f"{name}_counts", counts), ["group", "part"])
    position = F.col("at") + F.col("shift")
    return placed.withColumn("block", F.floor(position / block).cast("long")).withColumn("place", position % block).drop("at", "part", "shift")


def block_roots(placed: DataFrame, fanout: int, levels: int) -> DataFrame:
    """A row a block: (group, block, blocks, root) with empty proofs."""

    def root(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        total = int(frame["leaves"].iloc[0])
        nodes = frame.sort_values("place")["leaf"].tolist()
        top = climb(nodes, fanout, levels if total > fanout**levels else None)[-1][0]
        return pd.DataFrame([(key[0], int(key[1]), -(-total // fanout**levels), top)], columns=["group", "block", "blocks", "root"])

    roots = placed.select("group", "block", "place", "leaves", "leaf").groupBy("group", "block")
    none = F.array().cast("array<string>")
    return roots.applyInPandas(root, "group string, block long, blocks long, root string").withColumns({"lefts": none, "rights": none})


def exchange(state: DataFrame, fanout: int, number: int) -> DataFrame:
    """One round: every block of an unfinished tree learns the roots of its sibling subtrees of `fanout ** number` blocks."""
    span = F.lit(fanout**number)
    subtree = F.floor(F.col("block") / span)
    sibling = subtree - subtree % fanout + F.col("digit")
    begin = sibling * span
    partner = begin + F.col("block") % span % F.least(span, F.col("blocks") - begin)
    open_trees = state.where(F.col("blocks") > span)
    asked = (
        open_trees.select("group", "block", "blocks", F.explode(F.sequence(F.lit(0), F.lit(fanout - 1))).alias("digit"))
        .where(begin < F.col("blocks"))
        .select("group", "block", "digit", (subtree % fanout).alias("own"), partner.alias("partner"))
    )
    answers = asked.join(open_trees.select("group", F.col("block").alias("partner"), "root"), ["group", "partner"])
    runs = answers.groupBy("group", "block", "own").agg(F.sort_array(F.collect_list(F.struct("digit", "root"))).alias("run"))  # `fanout` roots

    def side(wanted) -> Column:
        return F.array_join(F.transform(F.filter("run", lambda x: wanted(x["digit"])), lambda x: x["root"]), "")

    heard = runs.select(
        "group", "block", side(lambda d: d < F.col("own")).alias("left"), side(lambda d: d > F.col("own")).alias("right"),
        F.sha2(side(lambda d: d >= 0), 256).alias("ancestor"),
    )
    known = F.col("ancestor").isNotNull()
    return state.join(heard, ["group", "block"], "left").select(
        "group", "block", "blocks",
        F.coalesce("ancestor", "root").alias("root"),
        F.when(known, F.array_append("lefts", F.col("left"))).otherwise(F.col("lefts")).alias("lefts"),
        F.when(known, F.array_append("rights", F.col("right"))).otherwise(F.col("rights")).alias("rights"),
    )


def exchanged(state: DataFrame, fanout: int, stage: Stage, name: str) -> DataFrame:
    """All rounds; each is staged, so that a lost executor costs no more than the round it was in."""
    state = stage(f"{name}_0", state)
    most, number = state.agg(F.max("blocks")).first()[0] or 0, 0
    while fanout**number < most:
        state = stage(f"{name}_{number + 1}", exchange(state, fanout, number))
        number += 1
    return state


def proofs(placed: DataFrame, state: DataFrame, keep: list[str], fanout: int, levels: int) -> DataFrame:
    """Every leaf with its root and its siblings, level by level from below; `state` holds the upper part by block."""
    kept = placed.select("group", *keep).schema.fields[1:]

    def join(key: tuple, rows: pd.DataFrame, upper: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        total = int(rows["leaves"].iloc[0])
        tree = climb(rows["leaf"].tolist(), fanout, levels if total > fanout**levels else None)
        above = upper.iloc[0]
        lefts, rights = list(above["lefts"]), list(above["rights"])
        own = [siblings(tree, k, fanout) for k in range(len(rows))]
        return rows[[*keep, "leaf"]].assign(
            tree_root=above["root"], lefts=[a + lefts for a, _ in own], rights=[b + rights for _, b in own]
        )

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), PROVEN])
    left = placed.select("group", "block", "place", "leaves", "leaf", *keep)
    return left.groupBy("group", "block").cogroup(state.groupBy("group", "block")).applyInPandas(join, schema)


def prove(leaves: DataFrame, keep: list[str], fanout: int = FANOUT, levels: int = LEVELS, stage: Stage | None = None) -> DataFrame:
    """A manifest of rows (source, doc_id, leaf, and the columns to `keep`).

    Gives those columns with `tree_root` (the dataset's), `subroot` (the source's), and `lefts` and `rights`: for each
    level from the leaf to the root, the digests beside the node in its run, joined.
    """
    stage = stage or Stage(leaves.sparkSession)
    # NULL first, then by UTF-8 bytes; as a key it is never NULL.
    group = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))
    leaves = stage("leaves", leaves.withColumns({"group": group, "row": F.monotonically_increasing_id()}))
    placed = ranked(leaves, ["doc_id", "leaf"], fanout**levels, stage, "leaves")
    state = exchanged(block_roots(placed, fanout, levels), fanout, stage, "rounds")

    tops = state.where("block = 0").select(F.lit("").alias("group"), F.col("group").alias("key"), F.col("root").alias("leaf"))
    tops = stage("sources", tops.withColumn("row", F.monotonically_increasing_id()))
    tops_placed = ranked(tops, ["key"], fanout**levels, stage, "sources")
    tops_state = exchanged(block_roots(tops_placed, fanout, levels), fanout, stage, "source_rounds")
    upper = proofs(tops_placed, tops_state, ["key"], fanout, levels).select(
        F.col("key").alias("group"), F.col("leaf").alias("subroot"), F.col("tree_root").alias("root"), F.col("lefts").alias("above"), F.col("rights").alias("beyond")
    )
    state = state.drop("root").join(stage("upper", upper), "group").select(
        "group", "block", F.concat("subroot", "root").alias("root"),  # 64 digits each
        F.concat("lefts", "above").alias("lefts"), F.concat("rights", "beyond").alias("rights"),
    )
    found = proofs(placed, state, [c for c in leaves.columns if c in {"source", "doc_id", *keep}], fanout, levels)
    return found.withColumn("subroot", F.substring("tree_root", 1, 64)).withColumn("tree_root", F.substring("tree_root", 65, 64))


def folded(leaf: Column) -> Column:
    """The root that a leaf gives with the proof in `lefts` and `rights`."""
    sides = F.zip_with("lefts", "rights", lambda a, b: F.struct(a.alias("left"), b.alias("right")))
    return F.aggregate(sides, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_hash() -> Column:
    return F.sha2(F.array_join(F.zip_with("lefts", "rights", lambda a, b: F.concat(a, b)), ""), 256)


def verified_manifest(docs: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """The manifest of documents, each checked after some were tampered with.

    Of documents whose id has an even crc32, line feeds are deleted before the check; what has none stays as it was.
    """
    doc_id, source, lang, n_chars, text = (F.col(c) for c in FIELDS)
    leaf = leaf_hash(doc_id, source, lang, n_chars, text)
    even = F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0
    changed = F.when(even, leaf_hash(doc_id, source, lang, n_chars, F.replace(text, F.lit("\n"), F.lit("")))).otherwise(leaf)
    leaves = docs.select(*FIELDS).select("source", "doc_id", leaf.alias("leaf"), changed.alias("checked"))
    found = prove(leaves, ["checked"], fanout, levels)
    found = found.select(
        "doc_id", "leaf", "subroot", F.col("tree_root").alias("root"), proof_hash().alias("proof_sha256"), folded(F.col("checked")).alias("folded_root")
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def oracle(fanout: int = FANOUT, levels: int = 16, source_levels: int = 10) -> str:
    """The same in SQL, for up to `fanout ** levels` documents a source and `fanout ** source_levels` sources."""

    def text(value: str) -> str:
        return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR) || ':' || {value}::VARCHAR END"

    def hashed(last: str) -> str:
        return "sha256(" + " || ".join(f"({text(f)})" for f in [*FIELDS[:-1], last]) + ")"

    step = "CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END"
    crc = (
        "list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::UBIGINT)), "
        f"lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)::UBIGINT[]), lambda v, i: {step}))"
    )  # without its last inversion, so odd here is even there
    parts = [
        f"raw AS MATERIALIZED (SELECT doc_id, source AS k, {hashed('text')} AS leaf, CASE WHEN doc_id IS NOT NULL AND {crc} & 1 = 1 THEN {hashed("replace(text, chr(10), '')")} ELSE {hashed('text')} END AS checked FROM documents)",
        "a0 AS MATERIALIZED (SELECT doc_id, k, leaf, leaf AS node, checked AS acc, '' AS proof, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY k) AS n FROM raw)",
        "an0 AS MATERIALIZED (SELECT k, i, node, n FROM a0)",
    ]

    def tree(x: str, depth: int, columns: str) -> None:
        """`x`0 are members, `x`n0 nodes; adds the levels above both."""
        for at in range(depth):
            run = f"SELECT k, i // {fanout} AS r, list(node ORDER BY i) AS run, max(n) AS n FROM {x}n{at} GROUP BY k, i // {fanout}"
            parts.append(f"{x}r{at} AS MATERIALIZED ({run})")
            parts.append(f"{x}n{at + 1} AS MATERIALIZED (SELECT k, r AS i, CASE WHEN n = 1 THEN run[1] ELSE sha256(array_to_string(run, '')) END AS node, (n + {fanout - 1}) // {fanout} AS n FROM {x}r{at})")
            left, right = f"array_to_string(run[1:m.i % {fanout}], '')", f"array_to_string(run[m.i % {fanout} + 2:], '')"
            parts.append(
                f"{x}{at + 1} AS MATERIALIZED (SELECT {columns}, m.k, m.i // {fanout} AS i, (m.n + {fanout - 1}) // {fanout} AS n, "
                f"CASE WHEN m.n = 1 THEN acc ELSE sha256({left} || acc || {right}) END AS acc, CASE WHEN m.n = 1 THEN proof ELSE proof || {left} || {right} END AS proof "
                f"FROM {x}{at} m JOIN {x}r{at} r ON m.k IS NOT DISTINCT FROM r.k AND m.i // {fanout} = r.r)"
            )

    tree("a", levels, "doc_id, leaf")
    parts.append(f"tops AS MATERIALIZED (SELECT k AS source, node, row_number() OVER (ORDER BY encode(k) NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM an{levels})")
    parts.append("bn0 AS MATERIALIZED (SELECT 0 AS k, i, node, n FROM tops)")
    parts.append(f"b0 AS MATERIALIZED (SELECT a.doc_id, a.leaf, t.node AS subroot, 0 AS k, t.i, t.n, a.acc, a.proof FROM a{levels} a JOIN tops t ON a.k IS NOT DISTINCT FROM t.source)")
    tree("b", source_levels, "doc_id, leaf, subroot")
    return (
        "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, t.node AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = t.node AS verified FROM b{source_levels} b, bn{source_levels} t"
    )
