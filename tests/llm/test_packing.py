import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tallysieve.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(packing.tokenizer_file())
    out.encode_special_tokens = True
    return out


def plain_ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


TEXTS = [
    "The cat's whiskers; I'LL go!!", "don't. rock'n. it's, o'clock", "á ́b é x\x1cy z\u0085q", "<|endoftext|> 12 3",
    "İstanbul. İ. ΣΑΣ. ẞ", "J̌ ǰ Å Å K.", "x.” á. ½. é!! क़.", "ͅ ab1.. 12.5, .5 !!.",
    "ǅ. ªº. ʰ, ﬁ 中文。", "a᠎b ﻿c ​ d", "", "   ", "...", "!!!a b###",
]


def test_ids_are_the_tokenizers_own(tokenizer):
    encoded = packing.encoder(packing.tokenizer_file())(TEXTS)
    assert [e.tolist() for e in encoded] == [plain_ids(tokenizer, t)[:-1] for t in TEXTS]


def test_memory_is_bounded_and_harmless(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "MEMORY_WORDS", 5)
    monkeypatch.setattr(packing, "MEMORY_CORES", 5)
    encode = packing.WordEncoder(packing.tokenizer_file())
    for text in TEXTS * 2:
        assert encode([text])[0].tolist() == plain_ids(tokenizer, text)[:-1]


def test_closest_fill_is_the_best_multiset():
    rng = random.Random(1)
    for _ in range(200):
        lengths = sorted(Counter(rng.randint(1, 30) for _ in range(rng.randint(0, 7))).items(), reverse=True)
        room = rng.randint(0, 60)
        sums = {0}
        for n, k in lengths:
            sums = {s + n * j for s in sums for j in range(k + 1) if s + n * j <= room}
        taken = packing.closest_fill(lengths, room)
        assert sum(n * k for n, k in taken.items()) == max(sums)
        assert all(k <= dict(lengths)[n] for n, k in taken.items())


def test_windows_use_every_length_once():
    rng = random.Random(2)
    lengths = [rng.randint(1, 40) for _ in range(500)] + [100] * 5
    windows = packing.fill_windows(lengths, 100)
    used = Counter()
    for times, pattern in windows:
        assert sum(n * k for n, k in pattern.items()) <= 100
        for n, k in pattern.items():
            used[n] += k * times
    assert used == Counter(lengths)
    assert sum(t for t, _ in windows) <= -(-sum(lengths) // 100) + 1  # at most one above the least possible


def test_pieces_tile_documents_and_sequences(frame, odd_rows, tokenizer):
    rows = [r.asDict() for r in packing.pack_documents(frame(odd_rows), window=256).collect()]
    wanted = Counter()
    for doc_id, text, *_ in odd_rows:
        ids = np.array(plain_ids(tokenizer, text), "<u4")
        for at in range(0, len(ids), 256):
            part = ids[at : at + 256]
            wanted[doc_id, at, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == wanted
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r["length"] for r in rows)
    assert len(sequences) <= total / 256 + 2


def test_many_shards_do_not_share_sequences(frame):
    docs = frame([(k, "word " * (k % 40)) for k in range(300)])
    pieces = packing.token_pieces(docs).cache()
    rows = packing.pack(pieces, window=64, shard_pieces=50).collect()
    fill = Counter()
    for r in rows:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 64 and len({s >> 32 for s in fill}) > 3


def test_empty_table(frame):
    assert packing.pack_documents(frame([])).collect() == []


def test_encoder_splits_at_ascii_white_space_and_forgets_words(monkeypatch):
    """Other white space stays inside words; ids are the same where hardly a word is remembered, and each word is looked up once."""
    texts = ["", " ", "a\x1cb  c\x0b\x0cd e\u2028f", "\u00c1\u0301\u00c0 \u0130x", "don't  stop. stop. Stop.", "one " * 500]
    encode = packing.WordEncoder(packing.tokenizer_file())
    asked = []

    class Words(dict):
        def get(self, word, default=None):
            asked.append(word)
            return super().get(word, default)

    encode.words = Words()
    first = encode(texts)
    assert len(asked) == len(set(asked)) < 30
    assert [len(x) for x in first[:2]] == [0, 0] and len(first[-1]) % 500 == 0
    monkeypatch.setattr(packing, "MEMORY_WORDS", 3)
    monkeypatch.setattr(packing, "MEMORY_CORES", 3)
    small = packing.WordEncoder(packing.tokenizer_file())
    again = [small([t])[0] for t in texts]
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(first, again))
    assert encode([]) == []
