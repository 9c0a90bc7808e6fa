"""The manifest against a plain recursive tree, and against its SQL."""

import hashlib
import random
import zlib

import duckdb
import pytest

from tallysieve.llm import manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, root string, lefts int, `group` string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    doc_id, text, lang, source, n_chars = row
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def plain_tree(nodes, at):
    """(root, siblings of each level as (left, right)) by the definition."""
    path = []
    while len(nodes) > 1:
        run = at - at % 3
        path.append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + 3])))
        nodes, at = [h(*nodes[k : k + 3]) for k in range(0, len(nodes), 3)], at // 3
    return nodes[0], path


def plain_manifest(rows):
    def key(s):
        return (s is not None, (s or "").encode())

    sources = sorted({r[3] for r in rows}, key=key)
    leaves = {s: sorted(((r[0] is not None, r[0] or 0, plain_leaf(r), r) for r in rows if r[3] == s), key=lambda x: x[:3]) for s in sources}
    tops = [plain_tree([x[2] for x in leaves[s]], 0)[0] for s in sources]
    out = []
    for k, s in enumerate(sources):
        root, upper = plain_tree(tops, k)
        for at, (_, _, leaf, row) in enumerate(leaves[s]):
            subroot, path = plain_tree([x[2] for x in leaves[s]], at)
            path = path + upper
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[1] is not None
            node = plain_leaf((row[0], row[1].replace("\n", ""), *row[2:])) if tampered else leaf
            for left, right in path:
                node = h(left, node, right)
            out.append((row[0], leaf, subroot, root, h(*(a + b for a, b in path)), node, node == root))
    return sorted(out, key=repr)


def rows_of(frame):
    return sorted((tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in frame.collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    out = [(k, f"a line {k}\nand\nmore", "en", "hot", 10) for k in range(400)]
    out += [(k, rng.choice([None, "", "ünï\n", "x" * 9]), rng.choice([None, "fr"]), rng.choice(["b", "a", "é", "", None, "s"]), rng.choice([None, 3])) for k in range(1000, 1080)]
    out += [(None, "no id\n", None, "hot", 1), (None, "no id\n", None, None, 1), (None, None, None, None, None)]
    out += [(7, "same id\n", "en", "hot", 2)] * 40 + [(7, "another\n", "en", "hot", 2), (9, "one", "en", "lone", 1)]
    out += [(20_000, "long\n" * 200_000, "en", "long", 1)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("levels", [2, 7])
def test_manifest_is_the_plain_tree(spark, rows, levels):
    docs = spark.createDataFrame([(*r, "x", "y", 1, "z") for r in rows], SCHEMA).repartition(5)
    assert rows_of(manifest.verified_manifest(docs, levels=levels)) == plain_manifest(rows)


def test_every_size_of_tree(spark):
    rows = [(k, f"t{k}\n", "en", f"of {count}", 1) for count in (1, 2, 3, 4, 9, 10, 28) for k in range(count)]
    docs = spark.createDataFrame([(*r, "x", "y", 1, "z") for r in rows], SCHEMA)
    assert rows_of(manifest.verified_manifest(docs, levels=1)) == plain_manifest(rows)


def test_sql_says_the_same(spark, rows):
    docs = spark.createDataFrame([(*r, "x", "y", 1, "z") for r in rows], SCHEMA)
    documents = docs.select("doc_id", "text", "lang", "source", "n_chars").toArrow()  # noqa: F841
    found = duckdb.sql(manifest.oracle())
    at = [found.columns.index(c) for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")]
    assert sorted((tuple(r[k] for k in at) for r in found.fetchall()), key=repr) == plain_manifest(rows)


def test_other_fanout_and_kept_columns(spark):
    leaves = spark.createDataFrame([(f"s{k % 3}", k, h(str(k)), k * k) for k in range(50)], "source string, doc_id long, leaf string, mark long")
    found = manifest.prove(leaves, ["mark"], fanout=2, levels=2).collect()
    assert len({r["tree_root"] for r in found}) == 1 and all(r["mark"] == r["doc_id"] ** 2 for r in found)
    for r in found:
        node = r["leaf"]
        for left, right in zip(r["lefts"], r["rights"]):
            node = h(left, node, right)
        assert node == r["tree_root"]


def test_empty_table(spark):
    assert manifest.verified_manifest(spark.createDataFrame([], SCHEMA)).collect() == []
