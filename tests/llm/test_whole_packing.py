"""Rows that are alike in their ids."""

from collections import Counter

import pytest

from tallysieve.llm import packing


@pytest.mark.parametrize("doc_id,crc", [(None, lambda k: k), (7, lambda k: 5), (None, lambda k: 5)])
def test_rows_without_id_and_repeated_rows_fill_no_shard(spark, doc_id, crc):
    rows = [(doc_id, 0, 10 + (0 if doc_id else k % 5), crc(k), 20) for k in range(2000)] + [(100 + k, 0, 12, k, 12) for k in range(2000)]
    pieces = spark.createDataFrame(rows, packing.PIECES)
    out = packing.pack(pieces, window=100, shard_pieces=200).collect()
    assert Counter(tuple(r)[:5] for r in out) == Counter(rows)
    sizes = Counter(r["sequence_id"] >> 32 for r in out)
    assert len(sizes) == 20 and max(sizes.values()) < 400
