"""Phrase collocations from exact n-gram counts.

Counts are gathered level by level, and a level counts only what the one below
allows: a phrase is no more frequent than any phrase inside it, so nothing
frequent is lost.

1. Words are counted by language and spelling. A word's id is a 64-bit hash
   that the counted table proves to be unique; should two words share one, all
   is hashed anew under another seed.
2. Pairs of frequent words, then runs of three and four whose pairs are all
   frequent, are counted in counting quotient filters (``quotient``): each task
   fills one, sends it on in parts, and the filters of a part are merged. One
   key is one entry of a task, however often it occurs.
3. Frequent phrases alone, some millions of them at most for billions of words,
   are joined with the counts of their pieces.

What tasks know of the level below is a bitmap without false negatives. Its
size is bounded by ``MAX_FILTER_BITS``: beyond that it lets more phrases
through to be counted, and the result stays the same.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from metricloom.llm import quotient
from metricloom.llm.common import stored
from metricloom.llm.hashing import LOWER, Substrings, chunks, mix, word_bounds

LEAST = 30
LONGEST = 4
TOP = 2000
#: Bits of the largest bitmap: 32 MB.
MAX_FILTER_BITS = 28
#: Entries a task holds before it sends them on.
HELD = 1 << 19

# \x20 and \x09 end a word; these bytes end a piece as well.
_PIECE_ENDS = np.zeros(256, bool)
_PIECE_ENDS[[*b".,;:!?", 10, 11, 12, 13]] = True
_BREAKS = _PIECE_ENDS.copy()
_BREAKS[[32, 9]] = True

_U = np.uint64


def _words(batch: pa.RecordBatch, seed: int) -> Iterator[tuple]:
    """(data, starts, ends, ids, piece, text) of the words of each chunk of (lang, text)."""
    for chunk in chunks(batch.column(1)):
        data = LOWER[chunk.data]
        starts, ends, first = word_bounds(data, chunk.offsets, _BREAKS)
        text = np.repeat(np.arange(chunk.size), np.diff(first))
        # Both parts only grow, so equal sums are equal parts.
        piece = np.cumsum(_PIECE_ENDS[data])[starts] + text if len(starts) else starts
        langs = batch.column(0)[chunk.first : chunk.first + chunk.size].dictionary_encode()
        names = np.array([_lang_key(x, seed) for x in langs.dictionary.to_pylist()], np.uint64)
        own = names[langs.indices.to_numpy(zero_copy_only=False)] if len(names) else np.zeros(0, np.uint64)
        ids = mix(Substrings(data)(starts, ends) + own[text])
        yield data, starts, ends, ids, piece, text + chunk.first


def _lang_key(lang: str, seed: int) -> int:
    data = np.frombuffer(lang.encode(), np.uint8)
    end = np.array([len(data)])
    return int(mix(Substrings(data)(np.zeros(1, np.int64), end) + _U(seed))[0])


def _slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.stack([starts, ends], 1).ravel()
    both = pa.Array.from_buffers(
        pa.large_string(), max(len(offsets) - 1, 0), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]
    )
    return both.take(pa.array(np.arange(0, len(offsets), 2)))


def _word_counts(seed: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "lang", "word", "n"]
    held: list[pa.RecordBatch] = []

    def merged() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        ids, n = table["id"].to_numpy(), table["n"].to_numpy()
        # Equal ids of different words must not meet here, else they would not show.
        words = table["word"].combine_chunks().dictionary_encode()
        langs = table["lang"].combine_chunks().dictionary_encode()
        which = words.indices.to_numpy().astype(np.uint64) * _U(len(langs.dictionary) + 1) + langs.indices.to_numpy().astype(np.uint64)
        _, first, group = np.unique(which, return_index=True, return_inverse=True)
        total = np.zeros(len(first), np.int64)
        np.add.at(total, group, n)
        kept = table.take(pa.array(first)).combine_chunks().to_batches()[0]
        return pa.record_batch([pa.array(ids[first]), kept.column(1), kept.column(2), pa.array(total)], names=names)

    for batch in batches:
        for data, starts, ends, ids, _, text in _words(batch, seed):
            if not len(ids):
                continue
            words = _slices(data, starts, ends).dictionary_encode()
            lang = batch.column(0).dictionary_encode()
            code = lang.indices.to_numpy(zero_copy_only=False)[text].astype(np.int64)
            which = words.indices.to_numpy().astype(np.int64) * (len(lang.dictionary) + 1) + code
            _, first, n = np.unique(which, return_index=True, return_counts=True)
            held.append(pa.record_batch([
                pa.array(ids[first].view(np.int64)), lang.dictionary.take(pa.array(code[first])).cast(pa.large_string()),
                words.dictionary.take(pa.array(words.indices.to_numpy()[first])), pa.array(n.astype(np.int64)),
            ], names=names))
            if sum(len(h) for h in held) >= HELD:
                held = [merged()]
                if len(held[0]) >= HELD // 2:
                    yield _plain(held.pop())
    if held:
        yield _plain(merged())


def _plain(batch: pa.RecordBatch) -> pa.RecordBatch:
    return pa.record_batch(
        [batch.column(0), batch.column(1).cast(pa.string()), batch.column(2).cast(pa.string()), batch.column(3)],
        names=["id", "lang", "word", "n"],
    )


def word_counts(docs: DataFrame) -> tuple[DataFrame, int]:
    """``id, lang, word, n`` of every word, and the seed under which ids are unique."""
    for seed in range(1, 100):
        counted = docs.mapInArrow(lambda b, s=seed: _word_counts(s, b), "id long, lang string, word string, n long")
        words = stored(
            counted.groupBy("lang", "word").agg(F.sum("n").alias("n"), F.first("id").alias("id")), "words"
        )
        if words.groupBy("id").agg(F.count("*").alias("k")).where("k > 1").isEmpty():
            return words, seed
    raise ValueError("no seed keeps the words apart")


class Bitmap:
    """Which 64-bit hashes may be in a set, as a bitmap of bounded size."""

    def __init__(self, bits: int, data: bytes) -> None:
        self.shift, self.data = _U(64 - bits), np.frombuffer(data, np.uint8)

    def __contains__(self, _) -> bool:
        raise TypeError("ask for arrays of hashes")

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes >> self.shift
        return (self.data[slot >> _U(3)] >> (slot & _U(7)).astype(np.uint8)) & 1 == 1


def bitmap(hashes: DataFrame, size: int) -> tuple[int, bytes]:
    """Bitmap of the 64-bit column ``h``; its pages are folded where the rows are."""
    bits = min(max(math.ceil(math.log2(max(size, 1))) + 4, 15), MAX_FILTER_BITS)
    slot = F.expr(f"shiftrightunsigned(h, {64 - bits})") + 1
    pages = hashes.select(F.bitmap_bucket_number(slot).alias("page"), F.bitmap_bit_position(slot).alias("bit")) \
        .groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bits"))
    out = bytearray(1 << (bits - 3))
    for page, data in pages.collect():
        out[(page - 1) * 4096 : (page - 1) * 4096 + len(data)] = data
    return bits, bytes(out)


def _grams(counters: Callable, sizes: tuple[int, ...], part_bits: int, seed: int, batches) -> Iterator[pa.RecordBatch]:
    """Filters, in parts, of the phrases of ``sizes`` words that ``counters`` lets through."""
    allowed = counters()
    held = {n: quotient.Counter.empty(n) for n in sizes}
    fresh: dict[int, list] = {n: [] for n in sizes}

    def fold(n: int) -> None:
        if fresh[n]:
            keys = np.concatenate(fresh[n])
            held[n].add(*quotient.folded(keys, np.ones(len(keys), np.int64)))
            fresh[n] = []

    def sent(n: int) -> pa.RecordBatch:
        found = held[n].filters(part_bits)
        held[n] = quotient.Counter.empty(n)
        return pa.record_batch(
            [pa.array([n] * len(found), pa.int32()), pa.array([p for p, _ in found], pa.int64()), pa.array([b for _, b in found], pa.binary())],
            names=["n", "part", "filter"],
        )

    for batch in batches:
        for _, _, _, ids, piece, _ in _words(batch, seed):
            for n, starts in allowed(ids, piece):
                fresh[n].append(quotient.permuted(ids[starts[:, None] + np.arange(n)]))
                if sum(map(len, fresh[n])) >= HELD:
                    fold(n)
                    if len(held[n]) >= HELD:
                        yield sent(n)
    for n in sizes:
        fold(n)
        if len(held[n]):
            yield sent(n)


def _merged(least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Frequent phrases of each part; rows come sorted by (n, part)."""
    at, counter, fresh = None, None, []

    def done() -> pa.RecordBatch:
        fold()
        keep = counter.counts >= least
        ids = quotient.restored(counter.keys[keep]).view(np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1, dtype=np.int32) * at[0]), pa.array(ids.ravel()))
        return pa.record_batch([lists, pa.array(counter.counts[keep])], names=["ids", "f"])

    def fold() -> None:
        if fresh:
            counter.add(np.concatenate([k for k, _ in fresh]), np.concatenate([c for _, c in fresh]))
            fresh.clear()

    for batch in batches:
        for n, part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if (n, part) != at:
                if at:
                    yield done()
                at, counter = (n, part), quotient.Counter.empty(n)
            fresh.append(quotient.unpacked(part, blob.as_buffer()))
            if sum(len(k) for k, _ in fresh) >= HELD:
                fold()
    if at:
        yield done()


def _counted(docs: DataFrame, counters: Callable, sizes: tuple[int, ...], part_bits: int, seed: int, least: int, name: str) -> DataFrame:
    """``ids, f`` of the phrases found ``least`` times or more."""
    filters = docs.mapInArrow(
        lambda b: _grams(counters, sizes, part_bits, seed, b), "n int, part long, filter binary"
    )
    merged = filters.repartition("n", "part").sortWithinPartitions("n", "part").mapInArrow(
        lambda b: _merged(least, b), "ids array<long>, f long"
    )
    return stored(merged, name)


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(mix(a) + b)


def _hashed_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
        yield pa.record_batch([pa.array(_pair_hash(a, b).view(np.int64))], names=["h"])


def frequent_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``ids, f`` of phrases of 1 to ``LONGEST`` words, ``id, lang, word`` of their words,
    and ``lang, n`` of all words, from ``docs`` (``lang, text``)."""
    words, seed = word_counts(docs)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    often = words.where(F.col("n") >= least)
    total, kept = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") >= least)).first()
    # A part takes some 250,000 words' n-grams, so its task stays small at any size.
    part_bits = min(max(math.ceil(math.log2(max(total, 1) / (1 << 18))), 9), 20)
    sc = docs.sparkSession.sparkContext
    known = sc.broadcast(bitmap(often.select(F.col("id").alias("h")), kept))

    def by_words():
        seen = Bitmap(*known.value)

        def allowed(ids: np.ndarray, piece: np.ndarray):
            fine = seen(ids)
            yield 2, np.flatnonzero(fine[:-1] & fine[1:] & (piece[1:] == piece[:-1]))

        return allowed

    pairs = _counted(docs, by_words, (2,), part_bits, seed, least, "pairs")
    hashes = pairs.select(F.get("ids", 0).alias("a"), F.get("ids", 1).alias("b")).mapInArrow(_hashed_pairs, "h long")
    pair_map = sc.broadcast(bitmap(hashes, pairs.count()))

    def by_pairs():
        seen = Bitmap(*pair_map.value)

        def allowed(ids: np.ndarray, piece: np.ndarray):
            fine = seen(_pair_hash(ids[:-1], ids[1:])) & (piece[1:] == piece[:-1])
            three = fine[:-1] & fine[1:]
            yield 3, np.flatnonzero(three)
            yield 4, np.flatnonzero(three[:-1] & fine[2:])

        return allowed

    longer = _counted(docs, by_pairs, (3, 4), part_bits, seed, least, "runs")
    single = often.select(F.array("id").alias("ids"), F.col("n").alias("f"))
    return single.unionByName(pairs).unionByName(longer), often.select("id", "lang", "word"), totals


def _score(a: Column, both: Column) -> Column:
    """floor(2000000 * a / both), exact beyond 64 bits."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.call_function("div", wide(a) * F.lit(2_000_000).cast("decimal(7,0)"), wide(both))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    ``docs`` has ``lang`` and ``text``; other columns are ignored. A null
    language is ``und``, a null text has no words. Repeated rows count each.
    Ties of score and count are ordered by the phrase's bytes. Without a
    phrase that is frequent enough a language has no rows.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text"))
    phrases, words, totals = frequent_phrases(texts, least)
    candidates = phrases.where(F.size("ids") > 1).select("ids", F.col("f").alias("a"))
    sides = phrases.select(F.col("ids").alias("part"), "f")
    cut = candidates.select("ids", "a", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k")).select(
        "ids", "a", "k", F.slice("ids", 1, F.col("k")).alias("head"),
        F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")).alias("tail"),
    )
    scored = (
        cut.join(sides.select(F.col("part").alias("head"), F.col("f").alias("l")), "head")
        .join(sides.select(F.col("part").alias("tail"), F.col("f").alias("r")), "tail")
        .withColumn("score", _score(F.col("a"), F.col("l") + F.col("r")))
        .groupBy("ids").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut"))
        .select("ids", "cut.*")
    )
    size = F.size("ids")
    inner = candidates.where(size > 2).select(
        F.col("a").alias("outer"),
        F.explode(F.flatten(F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda i: F.slice("ids", i, m)),
        ))).alias("ids"),
    ).groupBy("ids").agg(F.max("outer").alias("outer"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    covered = 100 * wide("outer") >= 80 * wide("a")
    left = scored.join(inner, "ids", "left").where(~F.coalesce(covered, F.lit(False))).drop("outer")
    spelt = (
        left.select("ids", F.posexplode("ids").alias("place", "id")).join(words, "id")
        .groupBy("ids").agg(F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("place", "word"))).alias("w"))
        .select("ids", "lang", F.array_join(F.transform("w", lambda w: w["word"]), " ").alias("phrase"))
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.join(spelt, "ids").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
