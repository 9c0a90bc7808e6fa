"""The corpus pipeline against what was planted, stage by stage and as a whole."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from tallysieve.llm import packing, secrets

from .conftest import make_text


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory, frame, vocabulary):
    """Clean, junk, copied, near-copied, contaminated and leaky documents as tables in a folder; (folder, kept texts)."""
    rng = random.Random(21)
    items = [(k, make_text(rng, 25, vocabulary)) for k in range(5)]
    rows, labels, kept = [], [], {}
    for k in range(500):
        text = make_text(rng, rng.randint(30, 60), vocabulary).capitalize() + "."
        kind = k % 10
        if kind == 0:
            text = " ".join(w.upper() + "!!" for w in text.split())
        elif kind == 1 and k > 10:
            text = kept[k - 4]
        elif kind == 2 and k > 10:
            words = kept[k - 5].split()
            text = " ".join(words[:-1] + ["ending"])
        elif kind == 3:
            text = f"{text} {items[k % 5][1]}"
        elif kind == 4:
            text = text + ' token = "' + "".join(rng.choice("0123456789abcdef") for _ in range(32)) + '"'
        rows.append((k, text))
        labels.append((k, int(kind != 0), 0))
        if kind not in (0, 3) and (kind not in (1, 2) or k <= 10):
            kept[k] = text
    folder = str(tmp_path_factory.mktemp("corpus"))
    frame(rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, kept


def test_run_keeps_and_packs_what_it_should(spark, corpus):
    from tokenizers import Tokenizer

    folder, kept = corpus
    rows = corpus_pipeline.run(spark, folder).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(list(kept))  # every text is shorter than a window
    tokenizer = Tokenizer.from_file(packing.tokenizer_file())
    for r in rows:
        plain = secrets.replaced(kept[r["doc_id"]], secrets.base_spans(kept[r["doc_id"]]), "[SECRET]")
        ids = np.array([*tokenizer.encode(plain, add_special_tokens=False).ids, packing.END_ID], "<u4")
        assert (r["length"], r["ids_crc32"], r["doc_tokens"]) == (len(ids), zlib.crc32(ids.tobytes()), len(ids))
    ends = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= packing.WINDOW


def test_stages_keep_columns_and_take_odd_and_empty_tables(spark, corpus, frame, odd_rows):
    folder, _ = corpus
    for docs in (frame(odd_rows), frame([])):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, folder)
            out.count()
            if name != "packing":
                assert out.columns == docs.columns, name


def test_stages_are_named_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None
