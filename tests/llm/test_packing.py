"""Packing keeps every id once; words tokenised apart give the tokenizer's ids."""

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from corpus import prose, rows
from metricloom.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
TOKENIZER.encode_special_tokens = True
ENCODER = packing.Encoder(PATH)


def plain(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, packing.END]


def by_words(texts):
    ids, starts = ENCODER(pa.array(texts, pa.large_string()))
    return [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])]


ODD = ["don't we'll 'tis it's", "a  b \n\n c\t d\r\n", "x  y  z　 w", "é à  ß.\nÉté,où", "<|endoftext|>", "1st 2,000.50 a1b2", "…—“q” 😀😀 !!", " ", "\n", "",
       "a\x00b \x1c c \x7f", "ñ" * 5 + " ×÷ ª º", "é x", "A'S 'll' ''s", None, "tab\tend\t", "Ω µ ə word\u0085 next"]


def test_ids_are_the_tokenizers():
    assert by_words(ODD) == [plain(t) for t in ODD]


@given(st.lists(st.text(st.sampled_from("ab Z1.,'\n\t é  ß×-sl "), max_size=30), max_size=6))
@settings(max_examples=150, deadline=None)
def test_ids_of_any_text(texts):
    assert by_words(texts) == [plain(t) for t in texts]


def check(spark_rows, texts):
    want = defaultdict(list)
    for doc_id, text in texts:
        want[doc_id].append(plain(text))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in spark_rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0
        pieces[r.doc_id, r.doc_tokens].append((r.start, ids))
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc_id, every in want.items():
        if len(every) == 1:
            whole = [i for _, ids in sorted(pieces[doc_id, len(every[0])]) for i in ids]
            assert whole == every[0]
            at = 0
            for start, ids in sorted(pieces[doc_id, len(every[0])]):
                assert start == at
                at += len(ids)
    assert sum(len(ids) for found in pieces.values() for _, ids in found) == sum(len(x) for every in want.values() for x in every)
    short = 0
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= packing.WINDOW and (at == packing.WINDOW or at & (at - 1) == 0)
        short += at < packing.WINDOW
    return len(sequences), short


@pytest.mark.parametrize("block", [1 << 20, 3000])
def test_every_id_is_packed_once(spark, documents, monkeypatch, block):
    monkeypatch.setattr(packing, "BLOCK", block)
    source = [*rows(), *[(100 + i, prose(i, 30 + 40 * i), "en", "s") for i in range(25)], (200, prose(9, 9000), "en", "s")]
    got = packing.packed(documents(source), PATH).collect()
    sequences, short = check(got, [(r[0], r[1]) for r in source])
    assert sequences > 20 and short <= 11 * 4


def test_an_empty_table_has_no_pieces(documents):
    assert packing.packed(documents(rows()).limit(0), PATH).collect() == []


def test_runs_give_the_same_sequences(documents):
    source = documents([(i, prose(i, 200), "en", "s") for i in range(40)])
    one, two = (sorted(map(tuple, packing.packed(source, PATH).collect()), key=repr) for _ in range(2))
    assert one == two


def test_neighbours_are_those_of_plain_bm25():
    texts = [np.array(packing.mix(np.arange(5 * i, 5 * i + 40, dtype=np.uint64)) % packing._U(60), np.uint16) for i in range(12)]
    index = packing.Index(texts)
    n, mean = len(texts), np.mean([len(t) for t in texts])
    for seed in range(n):
        score = np.zeros(n)
        for term in set(texts[seed].tolist()):
            df = sum(term in t for t in texts)
            idf = max(np.log((n - df + 0.5) / (df + 0.5)), 0)
            for d, t in enumerate(texts):
                tf = int((t == term).sum())
                score[d] += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(t) / mean))
        found = index.neighbours(seed)
        assert np.allclose(score[found], np.sort(score[score > 1e-12])[::-1])


def test_a_seed_is_joined_by_its_likeliest_text(monkeypatch):
    wording = {k: np.full(600, 300 + k, np.uint16) + np.arange(600, dtype=np.uint16) % 3 * 50 for k in range(6)}
    packer = packing.Packer(0)
    packer.shard([(10 * k + i, wording[k]) for i in range(3) for k in range(6)])
    firsts = defaultdict(list)
    for row in packer.rows:
        firsts[row[4]].append(row[0] // 10)
    assert all(len(set(kinds[:3])) == 1 for kinds in list(firsts.values())[:1])


def test_one_signature_gathers_a_bounded_number_of_texts():
    same = pa.RecordBatch.from_pydict({"doc_id": list(range(100)), "text": ["same words here"] * 100})
    gathered = Counter(r for task in range(40) for b in packing._routed(PATH, task, iter([same])) for r in b.column(1).to_pylist())
    assert max(gathered.values()) == packing.TOGETHER * packing.POOL
    assert sum(gathered.values()) == 4000
