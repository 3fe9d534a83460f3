"""The language model learns from every training text."""

import numpy as np
import pyarrow as pa

from metricloom.llm import hashing, lm


def test_every_training_text_counts_and_fits_the_weights(spark):
    texts = [f"line {i} of a text with the number {i * 7919} in it. " * (i % 5 + 1) for i in range(60)]
    rows = spark.createDataFrame([(i % 2, True, t) for i, t in enumerate(texts)], "half int, train boolean, text string").coalesce(1)
    code, _ = lm.surveyed(rows.drop("half"))
    halves = [rows.where(f"half = {i}").select("train", "text") for i in range(2)]
    counts = [lm.learned(half, code) for half in halves]
    whole = lm.learned(rows.select("train", "text"), code)
    assert (counts[0] + counts[1] == whole).all()
    expected, n = np.zeros((lm.CONTEXTS, lm.GATES)), 0
    for i in range(2):
        chunk, = hashing.chunks(pa.array(texts[i::2]))
        d = lm.decisions(chunk.data, chunk.offsets, code)
        known = lm.tables(counts[1 - i])
        expected += lm.fitted(d, known, np.full((lm.CONTEXTS, lm.GATES), 0.4, np.float32)) * float(len(d.bit))
        n += len(d.bit)
    assert whole.sum() == n * lm.CONTEXTS
    assert np.allclose(lm.mixer(halves, counts, code), expected / n, atol=1e-5)


def test_sums_of_rare_words_go_on_packed(spark, monkeypatch):
    seen = {}
    keep = lm.stored

    def stored(df, purpose, *by):
        seen[purpose] = keep(df, purpose, *by)
        return seen[purpose]

    monkeypatch.setattr(lm, "PART", 400)
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(40))) for i in range(200)], "doc_id long, text string")
    monkeypatch.setattr(lm, "stored", stored)
    got = lm.scored(docs.unionByName(docs.where("doc_id < 3"))).collect()
    parts = 8120 // 800 + 1
    assert 0 < seen["words"].count() <= parts * (parts + 1) < len(docs.collect())
    assert len(got) == 203 and {(r["n_tokens"], r["n_known"]) for r in got} == {(41, 1), (41, 41)}


def test_counts_of_a_small_task_follow_its_text():
    text = "a few words, and no more than these"
    batch = pa.RecordBatch.from_arrays([pa.array([text]), pa.array([True])], ["text", "train"])
    code = lm.trees(np.zeros(65536, np.int64))
    rows = [r for out in lm._counting(code)(iter([batch])) for r in out.to_pylist()]
    sent = sum(len(v) for r in rows for v in r.values() if isinstance(v, bytes))
    assert 0 < sent <= 6 * 3 * 8 * (len(text) + 1)
    assert sum(np.frombuffer(r["counts"], np.int32).sum() for r in rows) == 3 * 8 * (len(text) + 1)
