"""Phrase counts, quotient filters and collocations against plain Python."""

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from metricloom.llm import collocation, quotient
from corpus import prose


@given(st.integers(1, 4), st.integers(0, 300), st.integers(0, 20), st.integers(0, 9))
@settings(max_examples=60, deadline=None)
def test_filters_give_back_what_was_counted(n, rows, part_bits, seed):
    pick = np.random.default_rng(seed)
    grams = pick.integers(0, 2**64, (rows, n), np.uint64) if seed % 2 else pick.integers(0, 3, (rows, n)).astype(np.uint64)
    counts = pick.choice([1, 2, 254, 255, 256, 10**12], rows).astype(np.int64)
    want = Counter()
    for gram, count in zip(grams.tolist(), counts.tolist()):
        want[tuple(gram)] += count
    counter = quotient.Counter.empty(n)
    for half in (slice(None, rows // 2), slice(rows // 2, None)):
        counter.add(quotient.permuted(grams[half]), counts[half])
    got = Counter()
    for part, blob in counter.filters(part_bits) if part_bits else [(0, quotient.packed(counter.keys, counter.counts, 0))]:
        keys, found = quotient.unpacked(part, blob)
        assert np.array_equal(keys, keys[np.lexsort(keys.T[::-1])])
        got.update(dict(zip(map(tuple, quotient.restored(keys).tolist()), found.tolist())))
    assert got == want


def test_equal_first_words_of_different_keys_are_kept_apart():
    keys = np.array([[5, 2], [5, 1], [5, 2], [4, 9]], np.uint64)
    got, counts = quotient.folded(keys, np.ones(4, np.int64))
    assert got.tolist() == [[4, 9], [5, 1], [5, 2]] and counts.tolist() == [1, 1, 2]


def brute(rows, least, top):
    f, n, out = Counter(), Counter(), []
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, 5):
                f.update((lang, *words[i : i + m]) for i in range(len(words) - m + 1))
    good = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    for (lang, *w), a in good.items():
        inside = [b for (other, *v), b in good.items() if other == lang and len(v) > len(w)
                  and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))]
        if any(100 * b >= 80 * a for b in inside):
            continue
        cuts = [(2_000_000 * a // (f[lang, *w[:k]] + f[lang, *w[k:]]), k, f[lang, *w[:k]], f[lang, *w[k:]]) for k in range(1, len(w))]
        score, _, left, right = min(cuts)
        out.append((lang, " ".join(w), a, left, right, n[lang], score))
    ranked = []
    for lang in {o[0] for o in out}:
        own = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[6], -o[2], o[1].encode()))
        ranked += [(o[0], i + 1, *o[1:]) for i, o in enumerate(own[:top])]
    return sorted(ranked)


ROWS = [
    *[(i, prose(i, 80), "en", "s") for i in range(25)], *[(50 + i, "Größe über alles, new york city. the OF and", "de", "s") for i in range(9)],
    (90, None, "en", None), (91, "", None, "s"), (92, " \t\n", "en", "s"), (93, "a b a b a b a b. a b", None, "s"), (93, "a b a b a b a b. a b", None, "s"),
    (94, "A\x0bB\x0cc d", "und", "s"), (95, "one", "en", "s"), (96, "x y " * 4000, "en", "s"), (97, "\x00 y é z", "en", "s"), (None, "new york", "de", "s"),
]


@pytest.mark.parametrize("held, bits", [(1 << 19, 28), (40, 15)])
def test_same_phrases_as_brute_force(spark, documents, monkeypatch, held, bits):
    monkeypatch.setattr(collocation, "HELD", held)
    monkeypatch.setattr(collocation, "MAX_FILTER_BITS", bits)
    got = collocation.collocations(documents(ROWS), least=4, top=40).collect()
    want = brute([(lang, text) for _, text, lang, _ in ROWS], 4, 40)
    assert sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got) == want
    assert len({w[0] for w in want}) >= 3


def test_words_that_share_an_id_are_hashed_anew(spark, documents, monkeypatch):
    real = collocation._lang_key
    monkeypatch.setattr(collocation, "mix", lambda x: x)
    # Under the first seed, two languages' words meet in one id.
    monkeypatch.setattr(collocation, "_lang_key", lambda lang, seed: 7 if seed == 1 else real(lang, seed))
    words, seed = collocation.word_counts(documents([(1, "a b", "en", "s"), (2, "a b", "de", "s")]).select("lang", "text"))
    assert seed == 2 and words.count() == 4


def test_an_empty_table_has_no_phrases(documents):
    assert collocation.collocations(documents(ROWS).limit(0)).collect() == []


def test_scores_are_exact_beyond_64_bits(spark):
    a, both = 3 * 10**17, 7 * 10**17 + 1
    row = spark.range(1).select(collocation._score(collocation.F.lit(a), collocation.F.lit(both))).first()
    assert row[0] == 2_000_000 * a // both
