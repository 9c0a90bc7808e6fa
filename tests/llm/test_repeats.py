"""Repeated passages and byte strings against brute force, on both routes for anchors."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tallysieve.llm import anchors, passages, suffixes

from .conftest import make_text


def sha(data):
    return hashlib.sha256(data).hexdigest()


def brute_passages(rows, window):
    """Rows by id; equal (id, text) rows are one document, and ids are unique otherwise."""
    seen, out = set(), {}
    ordered = sorted({(d is not None, d or 0, t or "") for d, t, *_ in rows})
    for has_id, d, text in ordered:
        words = text.encode().split()
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            part = tuple(words[k : k + window])
            if part in seen:
                gone[k : k + window] = [True] * window
            seen.add(part)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out[d if has_id else None, text] = (len(words), sum(gone), sha(kept))
    return Counter((d, *out[d, t or ""]) for d, t, *_ in rows)


def brute_bytes(rows, window):
    times = Counter()
    for _, text, *_ in rows:
        body = (text or "").encode()
        times.update(body[k : k + window] for k in range(len(body) - window + 1))
    out = Counter()
    for d, text, *_ in rows:
        body = (text or "").encode()
        gone = np.zeros(len(body), bool)
        for k in range(len(body) - window + 1):
            if times[body[k : k + window]] > 1:
                gone[k : k + window] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[d, len(body), int(gone.sum()), spans, sha(bytes(b for b, g in zip(body, gone) if not g))] += 1
    return out


@pytest.fixture(scope="module")
def shared_rows(vocabulary):
    """A passage in a third of all texts, near copies, periodic texts, copies and repeated rows."""
    rng = random.Random(9)
    common = make_text(rng, 30, vocabulary)
    rows = []
    for k in range(60):
        text = make_text(rng, rng.randint(5, 60), vocabulary)
        if k % 3 == 0:
            text = f"{make_text(rng, rng.randint(0, 9), vocabulary)} {common}\n{text}"
        if k % 7 == 1:
            words = rows[-1][1].split()
            words[len(words) // 2] = "changed"
            text = " ".join(words)
        rows.append((k * 2, text))
    rows += [(3, "ab " * 90), (5, "abc" * 120), (7, "abc" * 40 + "x"), (9, "a a a a a a a a a b " * 4), (11, rows[0][1]), (0, rows[0][1])]
    return rows


@pytest.mark.parametrize("hot", [0, 4, 10**6])
def test_passages_match_brute_force(frame, shared_rows, odd_rows, hot):
    rows = shared_rows + [r for r in odd_rows if r[0] not in {d for d, _ in shared_rows}]
    got = Counter(map(tuple, passages.remove_repeats(frame(rows), window=8, hot_runs=hot, shard_bytes=3000).collect()))
    assert got == brute_passages(rows, 8)


@pytest.mark.parametrize("hot", [0, 4, 10**6])
def test_bytes_match_brute_force(frame, shared_rows, odd_rows, hot):
    rows = shared_rows + [r for r in odd_rows if len(r[1] or "") < 40_000]
    got = Counter(map(tuple, suffixes.remove_repeats(frame(rows), window=40, hot_runs=hot, shard_bytes=3000).collect()))
    # The last column, n_kept, is what is left.
    assert got == Counter({(*r, r[1] - r[2]): n for r, n in brute_bytes(rows, 40).items()})


@pytest.mark.parametrize("alphabet", [b"a", b"ab", b"abcd", bytes(range(256))])
def test_suffix_array_is_sorted(alphabet):
    rng = random.Random(len(alphabet))
    for n in (0, 1, 2, 3, 40, 300):
        body = bytes(rng.choice(alphabet) for _ in range(n))
        body += body[: n // 2]
        assert suffixes.suffix_array(body, len(body) + 1).tolist() == sorted(range(len(body)), key=lambda k: body[k:])


def test_common_prefixes():
    body = b"banana bandana banana"
    order = suffixes.suffix_array(body, 50)
    found = suffixes.common_prefixes(body, order, 50).tolist()
    for k in range(1, len(order)):
        a, b = body[order[k - 1] :], body[order[k] :]
        assert found[k] == next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))


def test_equal_windows_have_equal_anchors():
    rng = random.Random(4)
    shape = suffixes.shape_of(12)
    for _ in range(30):
        body = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 200)))
        values, starts, counts, times = anchors.anchored(shape.codes(body), shape)
        assert counts.sum() == max(0, len(body) - 11)
        owner = np.repeat(np.arange(len(values)), counts)
        groups = {}
        for k in range(len(body) - 11):
            groups.setdefault(body[k : k + 12], []).append(owner[k])
        for runs in groups.values():
            assert len({values[r] for r in runs}) == 1
            if len(runs) > 1:  # several runs, or one that says so
                assert len(set(runs)) > 1 or times[runs[0]] == 2


def test_empty_tables(frame):
    assert passages.remove_repeats(frame([])).collect() == []
    assert suffixes.remove_repeats(frame([])).collect() == []
