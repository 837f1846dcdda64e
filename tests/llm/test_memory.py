from __future__ import annotations

import re
from pathlib import Path

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa

from tierflow.llm import bpe, ctw, kernels


def held_mb():
    found = re.search(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())
    return int(found[1]) / 1024


def test_settle_hands_back_what_lies_between_live_objects():
    kept = []
    for _ in range(20_000):
        kept.append((bytes(10_000), bytes(600)))
    full = held_mb()
    kept = [small for _, small in kept]
    kernels.settle()
    assert len(kept) == 20_000 and held_mb() < full - 100


def test_texts_are_encoded_a_slice_at_a_time_and_memory_goes_back(spark, monkeypatch):
    class Rows:
        dtypes = [("doc_id", "bigint")]

        def select(self, *_):
            return self

        def mapInArrow(self, run, schema):
            self.run = run
            return self

    at_once, settled = [], []
    real = bpe.Chunked.encode
    monkeypatch.setattr(bpe, "SLICE_BYTES", 1000)
    monkeypatch.setattr(bpe, "settle", lambda: settled.append(1))
    monkeypatch.setattr(
        bpe.Chunked, "encode", lambda self, texts: at_once.append(sum(map(len, texts))) or real(self, texts)
    )
    rows = bpe.encoded(Rows(), public_tokenizers.path("word_bpe_49k.json"))
    ids = [2**60 + 1, None, *range(98)]
    texts = [None, *(f"some word{i} " * (i % 9) for i in range(99))]
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts)], ["doc_id", "text"])
    found = [r for b in rows.run(iter([batch])) for r in b.to_pylist()]
    assert [r["doc_id"] for r in found] == ids
    assert len(at_once) > 3 and max(at_once) <= 1000 and len(settled) == 2
    assert found[0] == {"doc_id": 2**60 + 1, "ids": b"", "decoded": ""} and found[5]["decoded"]


def test_grams_are_looked_up_a_slice_at_a_time_and_memory_goes_back(monkeypatch):
    class Rows:
        def mapInPandas(self, run, schema):
            return run

    class Shared:
        def __init__(self, name):
            self.value = (name, np.array([1], np.int64), np.array([0.5]))

    at_once, settled = [], []
    real = ctw.grams
    monkeypatch.setattr(ctw, "FIND_CHARS", 1000)
    monkeypatch.setattr(ctw, "settle", lambda: settled.append(1))
    monkeypatch.setattr(ctw, "grams", lambda texts: at_once.append(sum(map(len, texts))) or real(texts))
    texts = [None, *("Some words " * (i % 9) for i in range(99))]
    batch = pd.DataFrame({"row": range(100), "doc_id": range(100), "text": texts})
    found = pd.concat(ctw._pass(Rows(), Shared("a"), Shared("b"), 0)(iter([batch])))
    assert found["n_bytes"].tolist() == [len(ctw.canonical(t)) + 1 for t in texts]
    assert len(at_once) > 3 and max(at_once) <= 1000 and settled
    counts = pd.concat(ctw._counted(iter([batch.assign(text=texts)])))
    assert counts[counts.kind == 2]["n"].item() == sum(not ctw.is_held_out(i) for i in range(100))
    assert len(settled) == 2
