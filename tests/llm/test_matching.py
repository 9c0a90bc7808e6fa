"""Decontamination, near-duplicates, licences and the pipeline."""

import random
from collections import Counter

import pytest

from tallysieve.llm import decontamination, licenses, neardup
from tallysieve.llm.common import words_of

from .conftest import make_text

QUESTION = "The train covers 120 miles in 3 hours while Alice buys 7 apples for every friend at the market. What is the total price she pays"
SAME = "The train covers 450 miles in 9 hours while Bob buys 8 apples for every friend at the market. What is the total price she pays"
BALLS = "Add 12 red balls and 15 blue balls then take 12 red balls from 15 boxes and give 12 to"
BALLS_SAME = "Add 7 red balls and 9 blue balls then take 7 red balls from 9 boxes and give 7 to"
BALLS_MIXED = "Add 7 red balls and 9 blue balls then take 8 red balls from 4 boxes and give 5 to"


@pytest.fixture(scope="module")
def bench(spark, vocabulary):
    rng = random.Random(12)
    items = [(k, make_text(rng, 30, vocabulary)) for k in range(20)] + [(100, QUESTION), (101, None), (102, ""), (103, "four plain words here"), (104, BALLS)]
    return items, spark.createDataFrame(items, "item_id long, text string")


def test_contaminated_documents_are_found_and_others_left(frame, bench, vocabulary, odd_rows):
    items, table = bench
    rng = random.Random(13)
    rows = [(k, make_text(rng, 60, vocabulary)) for k in range(50)]
    rows += [(200 + k, f"{make_text(rng, 9, vocabulary)} {items[k][1]}\n{make_text(rng, 9, vocabulary)}") for k in range(20)]
    rows += [(300, f"Some words. {SAME} and more"), (301, f"Some words. {BALLS_MIXED} Ann"), (303, f"Some words. {BALLS_SAME} Ann"), (302, "Here are four plain words here.")]
    rows += odd_rows
    found = {(r["doc_id"], r["item_id"]): r for r in decontamination.contaminated(frame(rows), table).collect()}
    assert set(found) == {(200 + k, k) for k in range(20)} | {(300, 100), (302, 103), (303, 104)}
    assert found[300, 100]["n_changed"] >= 2 and found[205, 5]["n_changed"] == 0
    kept = decontamination.clean_documents(frame(rows), table)
    assert kept.columns == frame(rows).columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(d for d, *_ in rows if d is None or not 200 <= d <= 303 or d == 301)


def test_blocks_give_the_same_hits(frame, bench, vocabulary, monkeypatch):
    items, table = bench
    docs = frame([(k, f"before {items[k][1]} behind {items[k + 1][1]}") for k in range(10)])
    whole = sorted(map(tuple, decontamination.contaminated(docs, table).collect()))
    monkeypatch.setattr(decontamination.blocks_of, "__defaults__", (3,))
    assert sorted(map(tuple, decontamination.contaminated(docs, table).collect())) == whole and len(whole) == 20


def test_prefilter_drops_no_hit(vocabulary, bench):
    items, _ = bench
    index = decontamination.Index(items)
    rng = random.Random(14)
    texts = [make_text(rng, 40, vocabulary[:60]) for _ in range(100)] + [t for _, t in items] + [SAME.upper(), SAME]
    coder = decontamination.Coder(index.vocabulary)
    assert decontamination.search_texts(index, coder, texts) == [index.hits(coder, words_of(t)) for t in texts]


def test_empty_benchmark_and_table(spark, frame, bench):
    empty = spark.createDataFrame([], "item_id long, text string")
    docs = frame([(1, QUESTION)])
    assert decontamination.contaminated(docs, empty).collect() == []
    assert decontamination.clean_documents(docs, empty).count() == 1
    assert decontamination.contaminated(frame([]), bench[1]).collect() == []


def brute_classes(rows):
    """Every pair compared; rows with one id are one document."""
    texts = {}
    for d, t, *_ in rows:
        if d is not None and words_of(t):
            texts[d] = neardup.shingles(words_of(t))
    parent = {d: d for d, *_ in rows if d is not None}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if root(a) != root(b) and neardup.similarity(texts[a], texts[b]) >= 0.8:
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {d: root(d) for d in parent}


@pytest.fixture(scope="module")
def copies(vocabulary, odd_rows):
    """Exact copies, near copies of one text that differ from each other, chains, and a shared passage."""
    rng = random.Random(15)
    base = make_text(rng, 120, vocabulary).split()
    shared = make_text(rng, 40, vocabulary)
    rows = [(1000 + k, make_text(rng, 50, vocabulary) + " " + shared) for k in range(40)]
    for k in range(40):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(120)] = f"new{rng.randrange(1000)}"
        rows.append((2000 + k, " ".join(words)))
    chain = make_text(rng, 100, vocabulary).split()
    for k in range(12):
        rows.append((3000 + k, " ".join(chain)))
        chain[k * 8 : k * 8 + 2] = ["next", f"word{k}"]
    rows += [(4000 + k, "  ".join(base)) for k in range(5)]
    rows += [(5000, "a b c a b c a b c " * 4), (5001, "a b c a b c a b c " * 8), (5002, "a b c a b c a b c " * 4 + "d")]
    return rows + odd_rows


@pytest.mark.parametrize("block", [300, neardup.BLOCK_SHINGLES])
def test_classes_match_brute_force(frame, copies, block, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", block)
    out = neardup.classes(frame(copies)).collect()
    want = brute_classes(copies)
    assert Counter((r["doc_id"], r["class_id"]) for r in out) == Counter((d, want.get(d)) for d, *_ in copies)
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["class_id"]) for r in out)


def test_deduplicated_keeps_one_of_each_class(frame, copies):
    docs = frame(copies)
    kept = neardup.deduplicated(docs)
    assert kept.columns == docs.columns
    want = brute_classes(copies)
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter({d: 1 for d, c in want.items() if d == c} | {None: 2})


def test_a_large_group_below_and_around_the_threshold(frame, vocabulary, monkeypatch):
    """Edits of one text, most pairs at 0.6 to 0.9: every link counts, and pairs never become rows."""
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 4000)
    rng = random.Random(21)
    base = make_text(rng, 120, vocabulary).split()
    rows = []
    for k in range(150):
        words = list(base)
        for _ in range(rng.choice([1, 3, 4, 5])):
            words[rng.randrange(120)] = f"new{rng.randrange(10_000)}"
        rows.append((rng.randrange(10**6) * 1000 + k, " ".join(words)))
    out = {r["doc_id"]: r["class_id"] for r in neardup.classes(frame(rows)).collect()}
    assert out == brute_classes(rows) and 1 < len(set(out.values())) < 150


def test_block_counts_agree_with_the_exact_similarity(vocabulary):
    rng = random.Random(22)
    base = make_text(rng, 60, vocabulary).split() + ["again"] * 12
    texts = []
    for _ in range(60):
        words = list(base) if rng.random() < 0.7 else list(dict.fromkeys(base))
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(99)}"
        texts.append(neardup.shingles(" ".join(words[: rng.choice([len(words), 60])]).encode().split()))
    block = neardup.Block(texts)
    for other in texts:
        exact = [neardup.similarity(t, other) >= 0.8 for t in texts]
        assert block.alike(other, 0.8, [True] * 60).tolist() == exact
        assert not block.alike(other, 0.8, [False] * 60).any()


def test_ids_with_several_texts_lose_none(frame, vocabulary):
    rng = random.Random(23)
    a, b, c = (make_text(rng, 40, vocabulary) for _ in range(3))
    docs = frame([(1, a), (2, b), (2, a), (3, b), (4, c), (4, b), (4, None), (1, a), (5, ""), (5, "  ")])
    out = Counter((r["doc_id"], r["class_id"], r["kept"]) for r in neardup.classes(docs).collect())
    assert out == Counter({(1, 1, True): 2, (2, 1, False): 1, (2, 2, True): 1, (3, 2, False): 1, (4, 4, True): 2, (4, 2, False): 1, (5, 5, True): 2})
    kept = Counter((r["doc_id"], r["text"]) for r in neardup.deduplicated(docs).collect())
    assert kept == Counter([(1, a), (2, b), (4, c), (4, None), (5, "")]) or kept == Counter([(1, a), (2, b), (4, c), (4, None), (5, "  ")])


def test_similarity_of_sets_is_jaccard_and_weights_count():
    a, b = [neardup.shingles(t.split()) for t in (b"a b c d e f g h", b"a b c d e f g x")]
    assert neardup.similarity(a, b) == pytest.approx(3 / 5)
    heavy = neardup.shingles(b"a b c d e a b c d e a b c d e".split())
    assert neardup.similarity(heavy, heavy) == pytest.approx(1)
    assert neardup.similarity(a[:0], b) == 0


def test_registers_estimate_the_similarity(vocabulary):
    rng = random.Random(16)
    words = make_text(rng, 300, vocabulary).encode().split() * 2
    other = list(words)
    other[100:130] = make_text(rng, 30, vocabulary).encode().split()
    a, b = neardup.shingles(words), neardup.shingles(other)
    x = neardup.signatures([a, b], 4000)
    assert (x[0] == x[1]).mean() == pytest.approx(neardup.similarity(a, b), abs=0.03)


def test_neardup_of_empty_table(frame):
    assert neardup.classes(frame([])).collect() == []


def dice(a, b):
    import re

    def pairs(text):
        words = [w for w in re.split("[^a-z0-9]+", text.lower()) if w]
        return set(zip(words, words[1:]))

    x, y = pairs(a), pairs(b)
    return 2 * len(x & y) / (len(x) + len(y)) if x and y else 0.0


def test_licences_match_brute_force(frame, odd_rows, vocabulary):
    rng = random.Random(17)
    notes = [t for _, t in licenses.TEMPLATES]
    rows = [(100 + k, f"{make_text(rng, 20, vocabulary)}\n{note}") for k, note in enumerate(notes)]
    rows += [(200 + k, f"{note.upper().replace(' ', '  ')}\nRELEASED under  the MIT licence, twice\n{note}") for k, note in enumerate(notes)]
    rows += [(300, "Released under the MIT"), (301, "Licensed under CC BY 4.0."), (302, "Released under the new MIT License now")]
    rows += odd_rows
    got = sorted(map(tuple, licenses.scan(frame(rows)).collect()), key=str)
    want = []
    for doc_id, text, *_ in rows:
        passages = (text or "").split("\n")
        if len(passages) > 1:
            passages.append(text)
        best = [max((dice(p, t), -k, n) for k, (n, t) in enumerate(sorted(licenses.TEMPLATES))) for p in passages]
        best = [b for b in best if b[0] >= licenses.THRESHOLD]
        want.append((doc_id, ",".join(sorted({b[2] for b in best})), max((b[0] for b in best), default=0.0), len(best)))
    assert [(*g[:2], pytest.approx(g[2]), g[3]) for g in got] == sorted(want, key=str)
    assert licenses.scan(frame([])).collect() == []
    assert licenses.scan(frame([(1, notes[0])]), templates=()).first()["n_passages"] == 0


def test_licence_scan_runs_no_python(frame):
    plan = licenses.scan(frame([(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
