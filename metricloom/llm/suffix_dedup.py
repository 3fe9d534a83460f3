"""Removing repeated byte strings, within and across texts.

A byte goes when a string of ``WINDOW`` bytes that covers it starts anywhere
else too. A suffix array of the whole corpus, built column by column, would
need as many rounds over all data as its longest text has bytes, so the
construction is kept for short pieces and the corpus is cut down to them first:

1. *Anchors.* In every window the k-byte string of the smallest hash is its
   anchor; equal windows have equal anchors at equal offsets. Neighbouring
   windows mostly share one, so there is an anchor for some 60 windows. An
   anchor's context is all its windows together.
2. *Whole contexts.* Contexts are counted by hash. Where all contexts of a
   repeated anchor are equal, all their windows repeat: nothing is compared.
3. *Pieces.* Where contexts differ (the edges of repeated passages), one piece
   of each distinct context is cut out, at most 2 * WINDOW bytes. Pieces of an
   anchor meet and are sorted by column-wise construction: each round inserts
   one symbol of every piece, from the right, keeps the order of suffixes by
   one stable radix pass, and updates the common prefixes of neighbours. A
   window repeats when a neighbour shares WINDOW bytes. Rounds are bounded by
   the piece length, whatever the texts' lengths. An anchor with too many
   distinct contexts for one task has its windows counted by hash instead.

Hashes have 64 bits; equality of strings is decided by them in steps 1 and 2,
and by the bytes in step 3. Counting folds in each task, and joins are by
shuffle, so a passage found in a third of all texts is no burden to one task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from metricloom.llm.common import stored
from metricloom.llm.hashing import Chunk, Substrings, U, chunks, mix

WINDOW = 200
ANCHOR = 64
SEGMENT = 1 << 21  # window starts handled at once
PIECES = 20_000  # distinct contexts of one anchor that a task sorts
_PLACE_BITS = U(22)

_ANCHORS = "doc_id long, h long, anchor long, context long, first int, last int, at int"
_PIECE = "doc_id long, h long, anchor long, n long, m long, first int, at int, piece binary"
_COVER = "doc_id long, h long, lo int, hi int"


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, np.uint64).view(np.int64)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def chunk_anchors(chunk: Chunk, window: int, k: int):
    """text, anchor hash, context hash, first and last window start, anchor place."""
    outs = []
    for begin in range(0, max(len(chunk.data) - window + 1, 0), SEGMENT):
        data = chunk.data[begin : begin + SEGMENT + window - 1]
        n = len(data)
        if n < window:
            continue
        at = Substrings(data)
        place = np.arange(n - k + 1)
        hashes = at(place, place + k)
        keyed = (hashes >> _PLACE_BITS << _PLACE_BITS) | place.astype(np.uint64)
        anchor = (_sliding_min(keyed, window - k + 1) & ((U(1) << _PLACE_BITS) - U(1))).astype(np.int64)
        start = np.arange(n - window + 1)
        text = np.searchsorted(chunk.offsets, start + begin, "right") - 1
        inside = start + begin + window <= chunk.offsets[text + 1]
        start, anchor, text = start[inside], anchor[inside], text[inside]
        if not len(start):
            continue
        new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])
        first, last = start[new], start[np.r_[new[1:], len(start)] - 1]
        place, text = anchor[new], text[new]
        context = mix(at(first, last + window) + (place - first).astype(np.uint64) * U(0x9E3779B97F4A7C15))
        shift = begin - chunk.offsets[text]
        outs.append((text, hashes[place], context, first + shift, last + shift, place + shift))
    return outs


def _anchors(window: int, k: int):
    def run(batches):
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1)
            for chunk in chunks(batch.column(2)):
                for text, anchor, context, first, last, at in chunk_anchors(chunk, window, k):
                    row = pa.array(text + chunk.first)
                    ints = [pa.array(x.astype(np.int32)) for x in (first, last, at)]
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(row), keys.take(row), pa.array(_signed(anchor)), pa.array(_signed(context)), *ints],
                        ["doc_id", "h", "anchor", "context", "first", "last", "at"],
                    )

    return run


def _compressed(batches):
    for batch in batches:
        texts = [pa.compress(t, "zstd", asbytes=True) if t else b"" for t in batch.column(2).to_pylist()]
        sizes = [len(t) if t else 0 for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(texts, pa.binary())],
            ["doc_id", "h", "n_bytes", "packed"],
        )


def _unpacked(packed: bytes, size: int) -> bytes:
    return pa.decompress(packed, size, "zstd", asbytes=True) if size else b""


def _cut(window: int):
    """Pieces of a text, from the list of contexts wanted."""

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                text = _unpacked(row["packed"], row["n_bytes"])
                for w in row["wanted"]:
                    piece = text[w["first"] : w["last"] + window]
                    out.append((row["doc_id"], row["h"], w["anchor"], w["n"], w["m"], w["first"], w["at"], piece))
            names = [f.split()[0] for f in _PIECE.split(", ")]
            kinds = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.binary()]
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )

    return run


def repeated_windows(pieces: list[bytes], places: np.ndarray, window: int) -> np.ndarray:
    """For each piece and column, whether the window that starts there repeats.

    Pieces are aligned on their anchors (``places`` says where). Returns a
    boolean matrix; column 0 is the earliest start of any piece. Per round one
    symbol of every piece is inserted in front of its suffix: a stable radix
    pass by symbol renews the order, and the common prefix of new neighbours is
    one more than the least one between them in the old order.
    """
    left = int(places.max())
    lengths = np.array([len(p) for p in pieces])
    width = int((lengths - places).max()) + left
    table = np.full((width, len(pieces)), 256, np.uint16)  # a symbol of its own where a piece is absent
    for i, (piece, place) in enumerate(zip(pieces, places.tolist(), strict=True)):
        table[left - place : left - place + len(piece), i] = np.frombuffer(piece, np.uint8)
    order = np.arange(len(pieces))
    common = np.zeros(len(pieces) + 1, np.int32)  # of each suffix with the one before it
    repeats = np.zeros((len(pieces), left + 1), bool)
    for column in range(width - 1, -1, -1):
        symbols = table[column][order]
        moved = np.argsort(symbols, kind="stable")
        same = np.flatnonzero(symbols[moved][1:] == symbols[moved][:-1])
        now = np.zeros_like(common)
        if len(same):
            spans = np.stack([moved[same] + 1, moved[same + 1] + 1], 1).ravel()
            now[same + 1] = np.minimum.reduceat(common, spans)[::2] + 1
        order, common = order[moved], now
        if column <= left:
            hit = np.maximum(common[:-1], common[1:]) >= window
            repeats[order[hit], column] = True
    own = np.arange(left + 1)[None, :]
    begin = (left - places)[:, None]
    return repeats & (own >= begin) & (own + window <= begin + lengths[:, None])


def _sorted_pieces(window: int):
    """Covered strings of the pieces, whole anchors together."""

    def close(rows):
        places = np.array([r["at"] - r["first"] for r in rows])
        repeats = repeated_windows([r["piece"] for r in rows], places, window)
        left, out = int(places.max()), []
        edges = np.diff(np.pad(repeats, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        for (i, lo), (_, hi) in zip(np.argwhere(edges == 1), np.argwhere(edges == -1), strict=True):
            r = rows[i]
            if r["n"] == 1:  # other contexts are covered as a whole
                base = r["at"] - left
                out.append((r["doc_id"], r["h"], base + int(lo), base + int(hi) - 1 + window))
        return _covers(out)

    def run(batches):
        rows: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if len(rows) >= PIECES and row["anchor"] != rows[-1]["anchor"]:
                    yield close(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield close(rows)

    return run


def _covers(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out, strict=True)) or [()] * 4
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "h", "lo", "hi"]
    )


def _window_hashes(window: int):
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                data = np.frombuffer(r["piece"], np.uint8)
                start = np.arange(len(data) - window + 1)
                lo = (start + r["first"]).astype(np.int32)
                k = len(start)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(k, r["doc_id"] or 0), mask=np.full(k, r["doc_id"] is None)),
                        pa.array(np.full(k, r["h"])), pa.array(np.full(k, r["n"])),
                        pa.array(_signed(Substrings(data)(start, start + window))),
                        pa.array(lo), pa.array((lo + window).astype(np.int32)),
                    ],
                    ["doc_id", "h", "n", "hash", "lo", "hi"],
                )

    return run


def _removed(batches):
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            text = _unpacked(row["packed"], row["n_bytes"])
            runs: list[list[int]] = []
            for c in sorted((c["lo"], c["hi"]) for c in row["covers"] or ()):
                if runs and c[0] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], c[1])
                else:
                    runs.append([*c])
            kept, at = [], 0
            for lo, hi in runs:
                kept.append(text[at:lo])
                at = hi
            kept = b"".join([*kept, text[at:]])
            spans = [{"lo": lo, "hi": hi} for lo, hi in runs]
            digest = hashlib.sha256(kept).hexdigest()
            out.append((row["doc_id"], len(text), len(text) - len(kept), len(runs), digest, kept, spans))
        span = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary(), span]
        columns = list(zip(*out, strict=True)) or [()] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"],
        )


_REMOVED = (
    "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, "
    "spans array<struct<lo:int,hi:int>>"
)


def covers(keyed: DataFrame, packed: DataFrame, window: int, k: int) -> DataFrame:
    """(doc_id, h, lo, hi): strings whose windows all start elsewhere too."""
    keys = ["doc_id", "h"]
    found = stored(keyed.mapInArrow(_anchors(window, k), _ANCHORS), "anchors")
    groups = found.groupBy("anchor").agg(
        F.count("*").alias("n"), F.min("context").alias("lo"), F.max("context").alias("hi")
    ).where("n > 1")
    repeated = stored(
        found.join(groups.select("anchor", (F.col("lo") == F.col("hi")).alias("alike")), "anchor"), "repeated"
    )
    whole = lambda rows: rows.select(*keys, F.col("first").alias("lo"), (F.col("last") + window).alias("hi"))
    mixed = repeated.where("NOT alike")
    contexts = stored(
        mixed.groupBy("anchor", "context").agg(
            F.count("*").alias("n"), F.min(F.struct("doc_id", "h", "first", "last", "at")).alias("one")
        ),
        "contexts",
    )
    again = contexts.where("n > 1").select("anchor", "context")
    sizes = contexts.groupBy("anchor").agg(F.count("*").alias("m"))
    wanted = (
        contexts.join(sizes, "anchor").select(
            F.col("one.doc_id").alias("doc_id"), F.col("one.h").alias("h"),
            F.struct("one.first", "one.last", "one.at", "anchor", "n", "m").alias("w"),
        )
        .groupBy(*keys).agg(F.collect_list("w").alias("wanted"))
    )
    of_text = packed["doc_id"].eqNullSafe(wanted["doc_id"]) & (packed["h"] == wanted["h"])
    pieces = stored(
        packed.join(wanted, of_text).select(packed["doc_id"], packed["h"], "n_bytes", "packed", "wanted")
        .mapInArrow(_cut(window), _PIECE),
        "pieces",
    )
    sorted_ = (
        pieces.where(F.col("m") <= PIECES).repartition("anchor").sortWithinPartitions("anchor")
        .mapInArrow(_sorted_pieces(window), _COVER)
    )
    hashes = pieces.where(F.col("m") > PIECES).mapInArrow(
        _window_hashes(window), "doc_id long, h long, n long, hash long, lo int, hi int"
    )
    twice = hashes.groupBy("hash").agg(F.count("*").alias("k")).where("k > 1").select("hash")
    counted = hashes.where("n = 1").join(twice, "hash").select(*keys, "lo", "hi")
    return (
        whole(repeated.where("alike"))
        .unionByName(whole(mixed.join(again, ["anchor", "context"])))
        .unionByName(sorted_).unionByName(counted)
    )


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    window: int = WINDOW, k: int = ANCHOR,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, spans of every row.

    ``spans`` are the removed runs, which neither overlap nor touch. Texts are
    UTF-8 bytes; a null text has none, and one shorter than ``window`` loses
    none. ``kept`` may be cut inside a character. Rows that repeat an id and
    text each count, so they lose every byte that a window covers. Other
    columns are ignored; an empty table gives no row.
    """
    if not 0 < k < window:
        raise ValueError("the anchor must be shorter than the window")
    text = F.col(text_col).cast("string")
    keyed = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"),
        F.coalesce(text, F.lit("")).cast("binary").alias("text"),
    )
    packed = keyed.mapInArrow(_compressed, "doc_id long, h long, n_bytes long, packed binary")
    texts = keyed.select("doc_id", "h", F.col("text").cast("string").alias("text"))
    covered = (
        covers(texts, packed, window, k).groupBy("doc_id", "h")
        .agg(F.collect_list(F.struct("lo", "hi")).alias("covers"))
    )
    same = packed["doc_id"].eqNullSafe(covered["doc_id"]) & (packed["h"] == covered["h"])
    rows = packed.join(covered, same, "left").select(packed["doc_id"], "n_bytes", "packed", "covers")
    return rows.mapInArrow(_removed, _REMOVED)
