"""Encoding by shared chunks against the library's own ids."""

import hashlib
import random

import numpy as np
import pytest

from tallysieve.llm import bpe

from .conftest import make_text


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.tokenizer_file())


def plain(tokenizer, rows):
    out = []
    for doc_id, text, *_ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        out.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(frame):
    return sorted((tuple(r[c] for c in ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")) for r in frame.collect()), key=repr)


@pytest.fixture(scope="module")
def shared_rows(vocabulary, odd_rows):
    rng = random.Random(6)
    passages = [make_text(rng, rng.randint(50, 400), vocabulary) for _ in range(6)]
    rows = list(odd_rows)
    for k in range(100, 180):
        bits = [make_text(rng, rng.randint(0, 40), vocabulary) + rng.choice(["", " ", "\n", "x", "İ", "́", "<|endoftext|>", "'s", "..", " "]) for _ in range(4)]
        rows.append((k, bits[0] + rng.choice(passages) + bits[1] + rng.choice(passages) + bits[2] + bits[3], "en"))
    rows += [(500 + k, passages[0], "en") for k in range(30)]  # copies
    rows += [(600, "<|startoftext|>a b<|endoftext|> c <|endof text|>" * 9, "en"), (601, "ab " * 5000, "en"), (602, "é" * 3000, "en"), (603, "퟿  \x0b\x1c" * 500, "en")]
    return rows


@pytest.mark.parametrize("options", [{}, {"mean": 24, "least": 8}, {"bits": 6, "mean": 40, "least": 16}])
def test_ids_and_decoded_texts_are_the_librarys(frame, tokenizer, shared_rows, options):
    assert rows_of(bpe.round_trip(frame(shared_rows).repartition(3), **options)) == plain(tokenizer, shared_rows)


def test_ids_themselves(frame, tokenizer, shared_rows):
    found = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in bpe.encoded(frame(shared_rows)).collect()}
    for doc_id, text, *_ in shared_rows:
        if doc_id is not None:
            assert found[doc_id] == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_chunks_join_to_the_text_and_follow_content(vocabulary):
    rng = random.Random(2)
    passage = make_text(rng, 2000, vocabulary)
    texts = [passage.encode(), ("é in front " + passage).encode(), b"", ("tail " * 3 + passage[500:]).encode(), "żółć中文".encode() * 300]
    cut = list(bpe.chunks_of(texts))
    assert [b"".join(c) for c in cut] == texts
    assert all(c.decode() for chunks in cut for c in chunks)  # no character is split
    assert len(set(cut[0]) & set(cut[1])) >= len(cut[0]) - 2 and len(set(cut[0]) & set(cut[3])) > len(cut[0]) // 2


def test_most_of_a_shared_text_comes_from_insides(vocabulary):
    rng = random.Random(9)
    passage = make_text(rng, 600, vocabulary)
    chunks = next(iter(bpe.chunks_of([passage.encode()], 256, 64)))
    plan = bpe.Plan(chunks, [(k, bpe.digest_of(c), bpe.inside_of(c)) for k, c in enumerate(chunks) if bpe.inside_of(c)])
    kept, pieces = bpe.repaired([plan], bpe.coder(bpe.tokenizer_file()).encode)[0]
    assert len(kept.shared) == len(plan.shared) > 5 and len(pieces) == len(plan.shared) + 1
    assert sum(len(t) for _, t, _ in kept.betweens()) < len(passage) / 5  # the rest comes from insides


def test_joins_that_disagree_are_widened_until_they_agree(vocabulary):
    """A tokenizer that pairs words across white space: only whole texts agree."""
    rng = random.Random(1)
    passage = make_text(rng, 400, vocabulary).encode()

    def by_total(parts):
        return [np.full(len(p.split()), len(p.split()), "<u4") for p in parts]

    chunks = next(iter(bpe.chunks_of([passage])))
    plan = bpe.Plan(chunks, [(k, bpe.digest_of(c), bpe.inside_of(c)) for k, c in enumerate(chunks) if bpe.inside_of(c)])
    kept, pieces = bpe.repaired([plan], by_total)[0]
    assert not kept.shared and pieces[0].tolist() == by_total([passage])[0].tolist()


def test_empty_table(frame):
    assert bpe.round_trip(frame([])).collect() == []
