"""Keys within long candidates."""

import random

import numpy as np
import pytest

from tallysieve.llm import secrets


def key(rng, letters="0123456789abcdef", length=32):
    return "".join(rng.choice(letters) for _ in range(length))


def path(rng, middle):
    def word():
        return "".join(rng.choice("abcdefghijklmnoprstu") for _ in range(rng.randint(4, 9)))

    return f"//{word()}.{word()}.net/{word()}/{word()}/{middle or word()}/{word()}/{word()}.tar.gz"


@pytest.fixture(scope="module")
def net():
    rng = random.Random(8)
    texts = [f'see token = "{key(rng, length=rng.randint(24, 60))}" in it' for _ in range(300)]
    texts += [f"get {path(rng, '')} or {path(rng, '')} now" for _ in range(150)]
    views = {True: [], False: []}
    for text in texts:
        base = secrets.base_spans(text)
        for span in base + secrets.other_candidates(text, base):
            views[span[2] != "cnn"] += [secrets.view(text, p) for p in secrets.parts(text, span)]
    return secrets.train(np.stack(views[True]), np.stack(views[False]))


def test_keys_in_the_middle_of_long_candidates_are_marked(net):
    rng = random.Random(9)
    keys = [key(rng, length=11) + "F" + key(rng, length=20) for _ in range(40)]  # no rule takes them
    texts = [f"get {path(rng, k)} now" for k in keys] + [f"get {path(rng, '')} now" for _ in range(40)]
    out = secrets.scan_texts(net, texts)
    masked = [secrets.replaced(t, b + a, "[SECRET]") for t, (b, a, _) in zip(texts, out)]
    assert not any(b for b, _, _ in out)
    assert sum(k[:6] not in m and k[-6:] not in m for k, m in zip(keys, masked)) >= 32
    assert sum(m != t for m, t in zip(masked[40:], texts[40:])) <= 2


def test_parts_cover_long_spans_and_marks_join():
    text = "ab/" + "x" * 130 + "/cd-" + "k" * 20
    span = (0, len(text), "cnn")
    parts = secrets.parts(text, span)
    assert all(e - s <= secrets.INSIDE for s, e in parts) and (137, 157) in parts
    assert {i for s, e in parts for i in range(s, e)} == set(range(len(text)))
    assert secrets.marked(text, span, [(20, 60), (40, 80), (137, 157)]) == [(3, 133, "cnn"), (137, 157, "cnn")]


def test_keys_that_reach_beyond_a_finding_are_marked_whole(net):
    rng = random.Random(10)
    keys = [key(rng, length=26) + "Fa" + key(rng, length=8) for _ in range(20)]  # the rule takes the first 26 only
    texts = [f"some words {k} behind" for k in keys]
    out = secrets.scan_texts(net, texts)
    assert sum(secrets.replaced(t, b + a, "#") == "some words # behind" for t, (b, a, _) in zip(texts, out)) >= 16
    spare = 'set my_token = "abcdef0123456789abcdef0123456789" and some_long_name_token=abcdef0123456789abcdef012345'
    assert secrets.reaching_candidates("set my_token=abcdef0123456789abcdef0123456789", secrets.base_spans("set my_token=abcdef0123456789abcdef0123456789")) == []
    assert all(spare[a:b] == "some_long_name_" or b - a < 16 for a, b, _ in secrets.reaching_candidates(spare, secrets.base_spans(spare)))


def test_the_threshold_keeps_the_recall_below_one_half():
    rng = np.random.default_rng(4)
    net = secrets.Net(
        rng.normal(0, 0.3, (2 * secrets.CHARS, secrets.EMBED)), rng.normal(0, 0.15, (secrets.REACH * secrets.EMBED, secrets.FILTERS)),
        np.zeros(secrets.FILTERS), rng.normal(0, 0.2, 2 * secrets.FILTERS), np.zeros(1),
    )
    x, y = rng.integers(0, 190, (1000, secrets.WIDTH)).astype("uint8"), (np.arange(1000) % 10 == 0).astype(float)
    secrets.calibrate(net, x, y, 0.98)  # an untrained network: all scores are near the share of findings
    scores = net.probabilities(x)
    assert net.threshold < 0.5 and (scores[y > 0] >= net.threshold).mean() >= 0.98
    assert net.precision == pytest.approx(y[scores >= net.threshold].mean())


def test_all_candidates_are_learnt_from_in_shards(spark, frame, monkeypatch):
    """More candidates than a shard takes: each is in one, and the network tells keys from paths as one trained at once does."""
    rng = random.Random(12)
    texts = [f'see token = "{key(rng, length=rng.randint(24, 40))}" in it' for _ in range(300)]
    texts += [f"get {path(rng, '')} or {path(rng, '')} now" for _ in range(300)]
    docs = frame(list(enumerate(texts)))
    found = secrets.labelled(secrets.texts(docs)).distinct().collect()
    stage = secrets.Stage(spark)
    rows = secrets.sharded(spark.createDataFrame(found, "secret boolean, view binary"), 2, 5, stage).collect()
    assert sorted(r["shard"] for r in rows) == list(range(5))
    for secret, column in ((True, "findings"), (False, "others")):
        views = [bytes(r[column][a : a + secrets.WIDTH]) for r in rows for a in range(0, len(r[column]), secrets.WIDTH)]
        assert set(views) == {bytes(r["view"]) for r in found if r["secret"] == secret}
        assert sum(len(r[column]) for r in rows if r["own"] & (1 if secret else 2)) == secrets.WIDTH * len(set(views))
    seen = []
    monkeypatch.setattr(secrets, "train_shards", lambda shards, at=secrets.train_shards: seen.append(shards.count()) or at(shards, epochs=40))
    net = secrets.learn(docs, 150, 250)
    assert seen and seen[0] > 1
    views = {s: np.stack([np.frombuffer(r["view"], "uint8") for r in found if r["secret"] == s]) for s in (True, False)}
    assert (net.probabilities(views[True]) >= net.threshold).mean() > 0.95 and (net.probabilities(views[False]) >= net.threshold).mean() < 0.05
    again = secrets.learn(docs.repartition(3), 150, 250)
    assert all((a == b).all() for a, b in zip(net.params(), again.params())) and net.threshold == again.threshold
