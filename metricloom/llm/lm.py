"""Language-model scoring by logistic mixing of hashed-context bit predictors.

Texts are bytes with A-Z in lower case and an end mark. Each byte is a walk
down the binary code tree of its predecessor (a Huffman tree of the corpus's
byte pairs), so a likely byte takes few decisions. For each decision several
predictors look up counts of zeros and ones in a hashed table, by the last two
bytes, the last three, and the current word so far; tables hold the counts of
all training texts. Their predictions are mixed in the logistic domain by
weights that a gate selects (how much the two longer contexts have been seen).
The weights are fitted on all training texts too: those of each half are
predicted from the counts of the other half, so no text has helped to predict
itself, and copies of a text lie in one half. For scores both counts are added,
and within a text the weights are refined online: each segment is predicted
with weights corrected by the errors on the segments before it. The sum of the
decisions' log probabilities is the text's; bits per byte follow.

Beside it stands a smoothed unigram score of words. Word counts meet by hash:
words that are frequent anywhere are known from a first pass, at most
``2 x FREQUENT``, and are counted in each task; only the others are dealt out.

What is sent to all tasks is bounded by constants: trees, tables, weights and
the frequent words. Tables are summed in blocks by Spark.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F

from metricloom.llm.common import stored
from metricloom.llm.hashing import IS_SPACE, LOWER, U, Substrings, chunks, mix, pack, word_bounds

BITS = (18, 20, 22)  # log2 of the slots of each predictor's table
CONTEXTS = len(BITS)
FIRST = [sum(1 << b for b in BITS[:k]) for k in range(CONTEXTS + 1)]  # slots before each table
BLOCK_SLOTS = 1 << 14
PAD = 4  # bytes of context before a text
SEGMENT = 256  # bytes between refinements of the weights
REFINE_RATE, REFINE_PRIOR = 2.0, 400.0
GATES = 16
HALVES = 2  # of the training texts, each fitted on the counts of the other
PIECE = 1 << 15  # bytes whose decisions a task holds at once, so they stay in a core's cache
FREQUENT = 20_000
PART = 2_000_000  # word entries a task holds at once
SMOOTHING = 0.1
END = mix(np.array([0xE4D], np.uint64))

_M = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)]


@dataclass
class Trees:
    """A binary code for each preceding byte: decisions of (previous, byte)."""

    length: np.ndarray  # [previous * 256 + byte]
    start: np.ndarray  # of its decisions in node and bit
    node: np.ndarray
    bit: np.ndarray


def trees(pairs: np.ndarray) -> Trees:
    """Huffman trees from counts of byte pairs; an unseen byte counts a little."""
    length, start = np.zeros(65536, np.uint8), np.zeros(65536, np.int32)
    nodes: list[int] = []
    bits: list[int] = []
    for previous in range(256):
        counts = pairs[previous * 256 : previous * 256 + 256]
        heap = [(int(c) * 256 + 1, b, b) for b, c in enumerate(counts.tolist())]
        heapq.heapify(heap)
        parent: dict[int, tuple[int, int]] = {}
        made = 256
        while len(heap) > 1:
            (x, _, a), (y, _, b) = heapq.heappop(heap), heapq.heappop(heap)
            parent[a], parent[b] = (made, 0), (made, 1)
            heapq.heappush(heap, (x + y, made, made))
            made += 1
        for byte in range(256):
            path, at = [], byte
            while at in parent:
                at, bit = parent[at]
                path.append((at - 256, bit))
            length[previous * 256 + byte] = len(path)
            start[previous * 256 + byte] = len(nodes)
            nodes += [n for n, _ in reversed(path)]
            bits += [b for _, b in reversed(path)]
    return Trees(length, start, np.array(nodes, np.uint32), np.array(bits, np.uint8))


@dataclass
class Decisions:
    slots: list[np.ndarray]
    bit: np.ndarray
    ends: np.ndarray  # decisions up to the end of each coded byte
    texts: np.ndarray  # coded bytes up to the start of each text, and in all


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text after ``PAD`` zeros and before one, its end mark; texts' starts."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    start = offsets[:-1] + np.arange(n) * (PAD + 1) + PAD
    out = np.zeros(len(data) + n * (PAD + 1), np.uint8)
    out[np.arange(len(data)) + np.repeat(start - offsets[:-1], sizes)] = LOWER[data]
    return out, start


def decisions(data: np.ndarray, offsets: np.ndarray, code: Trees) -> Decisions:
    """The binary decisions of texts, with each predictor's table slot."""
    text, start = padded(data, offsets)
    sizes = np.diff(offsets) + 1
    texts = np.r_[0, np.cumsum(sizes)]
    # All places after the first few are worked on; those between texts take no decision.
    wide = text.astype(np.uint32)
    last1 = wide[PAD - 1 : -1]
    two = wide[PAD - 2 : -2] << np.uint32(8)
    two |= last1
    three = wide[PAD - 3 : -3] << np.uint32(16)
    three |= two
    space = IS_SPACE[text]
    space |= text == 0
    begin = np.arange(1, len(text) + 1)
    begin *= space
    begin = np.maximum.accumulate(begin, out=begin)[PAD - 1 : -1]
    so_far = (Substrings(text)(begin, np.arange(PAD, len(text))) >> U(32)).astype(np.uint32)
    so_far ^= last1 * _M[2]
    contexts = [two * _M[0], three * _M[1], so_far]
    symbol = last1 << np.uint32(8)
    symbol |= wide[PAD:]
    length = code.length.take(symbol)
    for k in range(PAD):
        length[start[1:] - 2 * PAD + k] = 0
    ends = np.cumsum(length, dtype=np.int64)
    owner = np.repeat(np.arange(len(length)), length)
    flat = (code.start.take(symbol) - (ends - length)).take(owner)
    flat += np.arange(len(owner))
    at = np.arange(texts[-1]) + np.repeat(start - PAD - texts[:-1], sizes)
    ends = ends.take(at)
    node = code.node.take(flat)
    node *= _M[0]
    slots = []
    for k, context in enumerate(contexts):
        slot = ((context ^ (context >> np.uint32(15))) * _M[(k + 1) % 3]).take(owner)
        slot += node
        slot *= _M[k]
        slot ^= node
        slot >>= np.uint32(32 - BITS[k])
        slots.append(slot.astype(np.intp))
    return Decisions(slots, code.bit.take(flat), ends, texts)


@dataclass
class Tables:
    """Of each predictor, by slot: its prediction, and how much it has seen (0-3)."""

    stretch: list[np.ndarray]
    seen: list[np.ndarray]


def tables(counts: np.ndarray) -> Tables:
    """``counts[slot, bit]`` of all tables, end to end, as predictions."""
    stretch, seen = [], []
    for k in range(CONTEXTS):
        own = counts[FIRST[k] : FIRST[k + 1]].astype(np.float32)
        n = own[:, 0] + own[:, 1]
        stretch.append(np.log((own[:, 1] + np.float32(0.4)) / (own[:, 0] + np.float32(0.4))))
        seen.append((n > 0).astype(np.uint8) + (n > 3).astype(np.uint8) + (n > 31).astype(np.uint8))
    return Tables(stretch, seen)


def _inputs(d: Decisions, known: Tables) -> tuple[list[np.ndarray], np.ndarray]:
    gate = known.seen[1].take(d.slots[1])
    gate *= np.uint8(4)
    gate += known.seen[2].take(d.slots[2])
    return [s.take(i) for s, i in zip(known.stretch, d.slots, strict=True)], gate.astype(np.intp)


def _mixed(inputs: list[np.ndarray], gate: np.ndarray, weights: np.ndarray) -> np.ndarray:
    z = weights[0].take(gate)
    z *= inputs[0]
    for k in range(1, CONTEXTS):
        own = weights[k].take(gate)
        own *= inputs[k]
        z += own
    return z


def _error(bit: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Bits less their predicted chances."""
    chance = np.exp(-np.clip(z, -30, 30))
    chance += 1
    np.reciprocal(chance, out=chance)
    return np.subtract(bit, chance, out=chance)


def log_probabilities(d: Decisions, known: Tables, weights: np.ndarray) -> np.ndarray:
    """Natural log of each text's probability, weights refined along the text."""
    count = len(d.texts) - 1
    if not len(d.ends):
        return np.zeros(count)
    inputs, gate = _inputs(d, known)
    z = _mixed(inputs, gate, weights)
    # Segments: at most SEGMENT coded bytes of one text.
    sizes = np.diff(d.texts)
    per = -(-sizes // SEGMENT)
    first = np.r_[0, np.cumsum(per)]
    owner = np.repeat(np.arange(count), per)
    begin = d.texts[owner] + (np.arange(first[-1]) - first[owner]) * SEGMENT
    cut = np.where(begin > 0, d.ends[begin - 1], 0)
    spans = np.diff(np.r_[cut, d.ends[-1]])
    if (per > 1).any():
        error = _error(d.bit, z)
        segment = np.repeat(np.arange(len(spans)), spans)
        before = lambda x: np.r_[0, np.cumsum(x)[:-1]]
        earlier = before(spans)
        earlier = earlier - earlier[first[owner]]
        for k in range(CONTEXTS):
            gradient = before(np.add.reduceat(error * inputs[k], cut).astype(np.float64))
            gradient -= gradient[first[owner]]
            step = (REFINE_RATE * gradient / (REFINE_PRIOR + earlier)).astype(np.float32).take(segment)
            step *= inputs[k]
            z += step
    z *= 1 - 2 * d.bit.astype(np.float32)
    # log(1 + x) by its series where 1 + x would lose x, else by the logarithm, much faster than log1p.
    odds = np.exp(np.clip(z, -30, 30, out=z), out=z)
    chances = np.where(odds < 1e-3, odds - odds * odds / 2, np.log(odds + 1))
    return -np.add.reduceat(np.add.reduceat(chances, cut, dtype=np.float64), first[:-1])


def fitted(d: Decisions, known: Tables, weights: np.ndarray, rate: float = 0.02, step: int = 4096) -> np.ndarray:
    """Weights after online gradient steps over the decisions, in order."""
    inputs, gate = _inputs(d, known)
    weights = weights.copy()
    for i in range(0, len(d.bit), step):
        own = slice(i, i + step)
        xs = [x[own] for x in inputs]
        error = _error(d.bit[own], _mixed(xs, gate[own], weights))
        for k in range(CONTEXTS):
            weights[k] += rate * np.bincount(gate[own], error * xs[k], GATES).astype(np.float32) / 16
    return weights


# --- Spark jobs -------------------------------------------------------------


def _training_rows(batch) -> pa.RecordBatch:
    return batch.filter(batch.column("train"))


def _first_pass(batches):
    """Byte pairs of training texts (kind 0), and words frequent in a batch (1)."""
    pairs = np.zeros(65536, np.int64)
    for batch in batches:
        batch = _training_rows(batch)
        hashes, counts, total = [], [], 0
        for chunk in chunks(batch.column("text")):
            text, start = padded(chunk.data, chunk.offsets)
            sizes = np.diff(chunk.offsets) + 1
            ends = np.cumsum(sizes)
            at = np.arange(ends[-1]) + np.repeat(start - (ends - sizes), sizes)
            pairs += np.bincount((text[at - 1].astype(np.int32) << 8) | text[at], minlength=65536)
            h, c = np.unique(_words(chunk)[0], return_counts=True)
            hashes.append(h)
            counts.append(c)
            total += int(c.sum()) + chunk.size
        if hashes:
            h, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
            c = np.bincount(inverse, np.concatenate(counts)).astype(np.int64)
            often = c * FREQUENT >= max(total, 3 * FREQUENT)
            yield _rows(1, pack(h[often], np.uint64), pack(c[often], np.int64), total)
    yield _rows(0, pack(pairs, np.int64), b"", 0)


_PASS = "kind int, a binary, b binary, n long"


def _rows(kind: int, a: bytes, b: bytes, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([kind], pa.int32()), pa.array([a], pa.binary()), pa.array([b], pa.binary()), pa.array([n], pa.int64())],
        ["kind", "a", "b", "n"],
    )


def surveyed(rows: DataFrame) -> tuple[Trees, np.ndarray]:
    """Code trees, and the hashes of frequent words: words with 1 / FREQUENT of all."""
    found = stored(rows.mapInArrow(_first_pass, _PASS), "survey")
    pairs = np.zeros(65536, np.int64)
    sums = found.where("kind = 0").select(F.col("a")).mapInArrow(_pair_sums, "at int, n long")
    for r in sums.groupBy("at").agg(F.sum("n").alias("n")).where("n > 0").collect():  # 65,536 at most
        pairs[r["at"]] = r["n"]
    words = found.where("kind = 1")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = words.select("a", "b").mapInArrow(_word_sums, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    hot = [r["hash"] for r in often.where(F.col("n") * FREQUENT >= total).collect()]
    return trees(pairs), np.sort(np.array(hot, np.int64).view(np.uint64))


def _pair_sums(batches):
    pairs = np.zeros(65536, np.int64)
    for batch in batches:
        for a in batch.column(0).to_pylist():
            pairs = pairs + np.frombuffer(a, np.int64)
    at = np.flatnonzero(pairs)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(pairs[at])], ["at", "n"])


def _word_sums(batches):
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(a, np.int64)), pa.array(np.frombuffer(b, np.int64))], ["hash", "n"]
            )


def _counting(code: Trees):
    """Counts of zeros and ones of each predictor's slots, in blocks, once a task.

    A block has the places that the task met and their counts, so what is sent
    follows the text of small tasks, and is a few tables' size for large ones.
    """

    def run(batches):
        counts = [np.zeros(2 << b, np.int32) for b in BITS]
        for batch in batches:
            batch = _training_rows(batch)
            for chunk in chunks(batch.column("text"), PIECE):
                d = decisions(chunk.data, chunk.offsets, code)
                for k in range(CONTEXTS):
                    at = d.slots[k] * 2
                    at += d.bit
                    np.add.at(counts[k], at, np.int32(1))
        for k in range(CONTEXTS):
            for i, own in enumerate(counts[k].reshape(-1, 2 * BLOCK_SLOTS), FIRST[k] // BLOCK_SLOTS):
                at = np.flatnonzero(own)
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([i], pa.int32()), pa.array([pack(at, np.uint16)], pa.binary()),
                            pa.array([pack(own[at], np.int32)], pa.binary()),
                        ],
                        ["block", "at", "counts"],
                    )

    return run


def _block_sums(batches):
    block, total = None, None
    for batch in batches:
        for i in range(batch.num_rows):
            number, at, counts = (c[i].as_py() for c in batch.columns)
            if number != block:
                if block is not None:
                    yield _block(block, total)
                block, total = number, np.zeros(2 * BLOCK_SLOTS, np.int64)
            total[np.frombuffer(at, np.uint16)] += np.frombuffer(counts, np.int32)
    if block is not None:
        yield _block(block, total)


def _block(block: int, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int32()), pa.array([pack(np.minimum(total, 2**31 - 1), np.int32)], pa.binary())],
        ["block", "counts"],
    )


def learned(rows: DataFrame, code: Trees) -> np.ndarray:
    """``counts[slot, bit]`` of all tables from the training texts of ``rows``; their size is a constant."""
    blocks = FIRST[-1] // BLOCK_SLOTS
    sums = (
        rows.mapInArrow(_counting(code), "block int, at binary, counts binary")
        .repartition(blocks, "block").sortWithinPartitions("block")
        .mapInArrow(_block_sums, "block int, counts binary")
    )
    counts = np.zeros((blocks, 2 * BLOCK_SLOTS), np.int32)
    for row in stored(sums, "tables").toLocalIterator():
        counts[row["block"]] = np.frombuffer(row["counts"], np.int32)
    return counts.reshape(-1, 2)


def _fitting(code: Trees, known: Tables, start: np.ndarray):
    def run(batches):
        weights, n = start, 0
        for batch in batches:
            for chunk in chunks(batch.column("text"), PIECE):
                d = decisions(chunk.data, chunk.offsets, code)
                weights = fitted(d, known, weights)
                n += len(d.bit)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([pack(weights, np.float32)], pa.binary()), pa.array([n], pa.int64())], ["weights", "n"]
            )

    return run


def _added(counts: list[np.ndarray]) -> np.ndarray:
    """Their sum, held at the largest count."""
    total = counts[0].astype(np.int64)
    for more in counts[1:]:
        total += more
    return np.minimum(total, 2**31 - 1).astype(np.int32)


def mixer(halves: list[DataFrame], counts: list[np.ndarray], code: Trees) -> np.ndarray:
    """Initial weights by gate, fitted on every training text.

    The texts of a half are predicted from the counts of the others. Each task
    fits its own texts, and tasks' weights are averaged by the decisions they saw.
    """
    weights = np.full((CONTEXTS, GATES), 0.4, np.float32)
    total, n = np.zeros((CONTEXTS, GATES)), 0
    for i, half in enumerate(halves):
        known = tables(_added(counts[:i] + counts[i + 1 :]))
        for r in half.mapInArrow(_fitting(code, known, weights), "weights binary, n long").collect():  # 200 bytes a task
            total += np.frombuffer(r["weights"], np.float32).reshape(CONTEXTS, GATES) * float(r["n"])
            n += r["n"]
    return (total / n).astype(np.float32) if n else weights


def _words(chunk) -> tuple[np.ndarray, np.ndarray]:
    data = LOWER[chunk.data]
    starts, ends, at = word_bounds(data, chunk.offsets)
    return (Substrings(data)(starts, ends) if len(starts) else np.zeros(0, np.uint64)), at


def _word_entries(batch):
    """Per chunk: text numbers, word hashes and how often, and the texts' word counts."""
    for chunk in chunks(batch.column("text")):
        hashes, at = _words(chunk)
        text = np.repeat(np.arange(chunk.size), np.diff(at))
        order = np.lexsort((hashes, text))
        hashes, text = hashes[order], text[order]
        new = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])]) if len(text) else np.zeros(0, int)
        times = np.diff(np.r_[new, len(text)])
        yield chunk.first + text[new], hashes[new], times, np.diff(at)


_ENTRY = "part int, ids binary, keys binary, nulls binary, train binary, runs binary, hashes binary, times binary"


def _is_known(hot: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(hot, hashes), max(len(hot) - 1, 0))
    return at, (hot[at] == hashes) if len(hot) else np.zeros(len(hashes), bool)


def _dealt(hot: np.ndarray, parts: int):
    """Entries of words that are not frequent, by word."""

    def run(batches):
        for batch in batches:
            ids = np.asarray(batch.column("doc_id").fill_null(0), np.int64)
            nulls = np.asarray(batch.column("doc_id").is_null())
            keys = np.asarray(batch.column("h"), np.int64)
            train = np.asarray(batch.column("train"))
            texts, hashes, times = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for text, h, c, _ in _word_entries(batch):
                rest = ~_is_known(hot, h)[1]
                texts.append(text[rest])
                hashes.append(h[rest])
                times.append(c[rest])
            text, h, c = (np.concatenate(x) for x in (texts, hashes, times))
            part = (((h >> U(32)) * U(parts)) >> U(32)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            text, h, c, part = text[order], h[order], c[order], part[order]
            bounds = np.searchsorted(part, np.arange(parts + 1)) if parts < len(part) else None
            for p in np.unique(part).tolist():
                lo, hi = (bounds[p], bounds[p + 1]) if bounds is not None else np.searchsorted(part, [p, p + 1])
                own = text[lo:hi]
                new = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                who = own[new]
                values = [
                    pack(ids[who], np.int64), pack(keys[who], np.int64), pack(nulls[who], np.bool_),
                    pack(train[who], np.bool_), pack(np.diff(np.r_[new, hi - lo]), np.int32),
                    pack(h[lo:hi], np.uint64), pack(c[lo:hi], np.int32),
                ]
                names = [f.split()[0] for f in _ENTRY.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p], pa.int32()), *[pa.array([v], pa.binary()) for v in values]], names
                )

    return run


_PARTIAL = "dest int, ids binary, keys binary, nulls binary, total binary, known binary, types long, tokens long"


def _looked_up(dests: int):
    """Sums over each text's entries in a part, packed by where texts are summed.

    A text has a sum in each part that has a word of it, so these go on packed
    and are not rows. A row without ``dest`` has a part's types and tokens.
    """

    def close(rows):
        read = lambda name, kind: [np.frombuffer(r[name], kind) for r in rows]
        runs = np.concatenate(read("runs", np.int32))
        ids, keys = np.concatenate(read("ids", np.int64)), np.concatenate(read("keys", np.int64))
        nulls, train = np.concatenate(read("nulls", np.bool_)), np.concatenate(read("train", np.bool_))
        times = np.concatenate(read("times", np.int32)).astype(np.int64)
        hashes, inverse = np.unique(np.concatenate(read("hashes", np.uint64)), return_inverse=True)
        count = np.bincount(inverse, np.where(np.repeat(train, runs), times, 0), len(hashes))
        types = int((count > 0).sum())
        count = count[inverse]
        at = np.cumsum(runs) - runs
        total = np.add.reduceat(times * np.log10(count + SMOOTHING), at)
        known = np.add.reduceat(np.where(count > 0, times, 0), at)
        tokens = int(times[np.repeat(train, runs)].sum())
        dest = (((mix(keys.view(np.uint64) ^ mix(ids.view(np.uint64))) >> U(32)) * U(dests)) >> U(32)).astype(np.int32)
        order = np.argsort(dest, kind="stable")
        bounds = np.searchsorted(dest[order], np.arange(dests + 1))
        names = [f.split()[0] for f in _PARTIAL.split(", ")]
        for d in np.unique(dest).tolist():
            own = order[bounds[d] : bounds[d + 1]]
            values = [
                pack(ids[own], np.int64), pack(keys[own], np.int64), pack(nulls[own], np.bool_),
                pack(total[own], np.float64), pack(known[own], np.int64),
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([d], pa.int32()), *[pa.array([v], pa.binary()) for v in values], *[pa.array([0], pa.int64())] * 2], names
            )
        yield pa.RecordBatch.from_arrays(
            [pa.array([None], pa.int32()), *[pa.array([b""], pa.binary())] * 5, pa.array([types]), pa.array([tokens])], names
        )

    def run(batches):
        part, rows = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if rows and row["part"] != part:
                    yield from close(rows)
                    rows = []
                part = row["part"]
                rows.append(row)
        if rows:
            yield from close(rows)

    return run


def _text_sums(batches):
    """``doc_id, h, total, known`` of each text, from all its parts' sums."""

    def close(rows):
        ids, keys, nulls, total, known = (
            np.concatenate([np.frombuffer(r[name], kind) for r in rows])
            for name, kind in (("ids", np.int64), ("keys", np.int64), ("nulls", np.bool_), ("total", np.float64), ("known", np.int64))
        )
        order = np.lexsort((nulls, keys, ids))
        ids, keys, nulls = ids[order], keys[order], nulls[order]
        new = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]) | (nulls[1:] != nulls[:-1])])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids[new], mask=nulls[new]), pa.array(keys[new]),
                pa.array(np.add.reduceat(total[order], new)), pa.array(np.add.reduceat(known[order], new)),
            ],
            ["doc_id", "h", "total", "known"],
        )

    dest, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and row["dest"] != dest:
                yield from close(rows)
                rows = []
            dest = row["dest"]
            rows.append(row)
    if rows:
        yield from close(rows)


def _hot_counts(hot: np.ndarray):
    """Training counts of the frequent words and of the end mark, once a task."""

    def run(batches):
        counts, words = np.zeros(len(hot) + 1, np.int64), 0
        for batch in batches:
            words += sum(len(_words(c)[0]) for c in chunks(batch.filter(pa.compute.invert(batch.column("train"))).column("text")))
            batch = _training_rows(batch)
            for chunk in chunks(batch.column("text")):
                hashes = _words(chunk)[0]
                words += len(hashes)
                at, known = _is_known(hot, hashes)
                counts[:-1] += np.bincount(at[known], minlength=len(hot))
                counts[-1] += chunk.size
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[used, -1]), pa.array(np.r_[counts[used], words])], ["at", "n"]
        )

    return run


_SCORED = (
    "doc_id long, h long, held_out boolean, n_tokens long, hot_known long, hot_total double, "
    "n_bytes long, score double"
)


def _scoring(code: Trees, known: Tables, weights: np.ndarray, hot: np.ndarray, counts: np.ndarray):
    logs = np.log10(counts + SMOOTHING)

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            tokens, hot_known, hot_total = np.ones(n, np.int64), np.full(n, int(counts[-1] > 0)), np.full(n, logs[-1])
            size, score = np.zeros(n, np.int64), np.zeros(n)
            for chunk in chunks(batch.column("text"), PIECE):
                own = slice(chunk.first, chunk.first + chunk.size)
                hashes, words = _words(chunk)
                text = np.repeat(np.arange(chunk.size), np.diff(words))
                at, found = _is_known(hot, hashes)
                text, at = text[found], at[found]
                tokens[own] += np.diff(words)
                hot_known[own] += np.bincount(text, counts[at] > 0, chunk.size).astype(np.int64)
                hot_total[own] += np.bincount(text, logs[at], chunk.size)
                size[own] = np.diff(chunk.offsets)
                d = decisions(chunk.data, chunk.offsets, code)
                score[own] = log_probabilities(d, known, weights) / np.log(10)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("h"), pa.compute.invert(batch.column("train")),
                    *[pa.array(x) for x in (tokens, hot_known, hot_total, size, score)],
                ],
                ["doc_id", "h", "held_out", "n_tokens", "hot_known", "hot_total", "n_bytes", "score"],
            )

    return run


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Texts whose ``crc32(id) mod folds`` is 0 are held out; all others are
    learned from, whole. A null or empty text is its end mark alone; a null id
    counts as the empty string. ``bits_per_byte`` counts the end mark's bits
    and is null for an empty text. Repeated rows are learned from as often as
    they come and scored alike. Other columns are ignored. An empty table
    gives no row.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    fold = F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(folds))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), (fold != 0).alias("train"), text.alias("text")
    )
    code, hot = surveyed(rows)
    halves = [rows.where(F.col("train") & (F.pmod(F.col("h"), F.lit(HALVES)) == i)) for i in range(HALVES)]
    parts = [learned(half, code) for half in halves]
    weights = mixer(halves, parts, code)
    known = tables(_added(parts))
    tallies = rows.mapInArrow(_hot_counts(hot), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(len(hot) + 1, np.int64)
    words = 0
    for r in tallies:
        if r["at"] < 0:
            words = r["n"]
        else:
            counts[r["at"]] = r["n"]
    parts = max(1, -(-words // (2 * PART)))
    partial = stored(
        rows.mapInArrow(_dealt(hot, parts), _ENTRY).repartition(parts, "part").sortWithinPartitions("part")
        .mapInArrow(_looked_up(parts), _PARTIAL),
        "words",
    )
    rare = partial.where("dest is null").agg(
        F.coalesce(F.sum("types"), F.lit(0)).alias("types"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")
    ).first()
    total = int(counts.sum()) + rare["tokens"]
    types = int((counts > 0).sum()) + rare["types"]
    sums = (
        partial.where("dest is not null").repartition(parts, "dest").sortWithinPartitions("dest")
        .mapInArrow(_text_sums, "doc_id long, h long, total double, known long")
    )
    done = stored(rows.mapInArrow(_scoring(code, known, weights, hot, counts), _SCORED), "scored")
    # Rows that repeat an id and text have added to the same sums.
    on = lambda a, b: F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.h") == F.col(f"{b}.h"))
    copies = done.groupBy("doc_id", "h").agg(F.count("*").alias("copies"))
    each = copies.alias("c").join(sums.alias("s"), on("c", "s"), "left").select(
        "c.doc_id", "c.h", (F.col("total") / F.col("copies")).alias("total"),
        (F.col("known") / F.col("copies")).alias("known"),
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    denominator = F.log10(F.lit(total + SMOOTHING * (types + 1)))
    bits = -F.col("score") * float(np.log2(10)) / F.col("n_bytes")
    return done.alias("d").join(each.alias("e"), on("d", "e")).select(
        "d.doc_id", "held_out", "n_tokens",
        (F.col("hot_known") + F.round(zero("known")).cast("long")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("hot_total") + zero("total") - F.col("n_tokens") * denominator).alias("base_score"),
        "score", F.when(F.col("n_bytes") > 0, bits).alias("bits_per_byte"),
    )
