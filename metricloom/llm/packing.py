"""Lexical retrieval packing of documents into training sequences.

Texts become token ids once, and each text is routed to a shard by the least
hash of its token ids, so texts that share rare wording tend to meet. Texts of
``POOL`` neighbouring tasks meet, and a task that sees one signature again and
again spreads it over more places: copies, however many, gather
``POOL * TOGETHER`` at a time. Shards are cut from the routed rows as they stream
through a task, when ``BLOCK`` tokens are together: memory is bounded whatever
the input, and the one shuffle carries ids at two bytes a token.

Each shard has its own inverted index with BM25 weights. A seed text opens a
window; the index returns its neighbours best first, those already used are
passed over, and they fill the window in that order. A neighbour that is longer
than the room is cut, and its rest seeds the next window. A text longer than a
window fills windows of its own, its tail is packed like any other. Only the
last window of a task may be short; it is cut to lengths that are powers of two,
which need no padding.
"""

from __future__ import annotations

import codecs
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from metricloom.llm.hashing import mix, text_bytes

WINDOW = 2048
#: Tokens of a shard, but for the last text it takes.
BLOCK = 1 << 20
#: Id put after every text.
END = 1
#: Texts of one signature that a task routes to one place.
TOGETHER = 8
#: Neighbouring tasks whose texts may meet, so no place gathers more copies at any size.
POOL = 16
#: Bytes of text tokenised at once.
READ = 1 << 22
#: Distinct words a task remembers.
KNOWN = 1 << 19
K1, B = 1.2, 0.75

_ROUTED = "doc_id long, route long, n int, ids binary"
_PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"

_U = np.uint64
_HASH = mix(np.arange(1, (1 << 16) + 1, dtype=np.uint64))


def _kinds() -> np.ndarray:
    """Kind of each byte: 0 unknown, 1 letter, 2 digit, 3 mark but the apostrophe, 4 blank, 5 other white space."""
    kinds = np.zeros(256, np.uint8)
    kinds[33:127] = 3
    kinds[[*range(65, 91), *range(97, 123)]] = 1
    kinds[48:58] = 2
    kinds[39] = 0
    kinds[32] = 4
    kinds[[9, 10, 13]] = 5
    return kinds


_KIND = _kinds()
# (kind before, kind after) between which a token surely ends.
_CUT = np.zeros((6, 6), bool)
_CUT[[1, 1, 2, 2, 3, 3, 1, 2, 3], [4, 5, 4, 5, 4, 5, 3, 3, 1]] = True
_CUT = _CUT.ravel()


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places in ``data`` where a token surely begins, texts' starts among them.

    The tokenizer splits a text before it looks words up: letters, digits and
    marks never share a token, white space after one of them is none of its
    token, and one line end or tab between two of them is a token. So texts may be cut between
    such ASCII characters, and before white space after a two-byte letter, and
    the parts be tokenised one by one. Where a character could be more than one
    of these, nothing is cut.
    """
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    if len(data) > 1:
        kind = _KIND[data]
        cut[1:-1] |= _CUT[kind[:-1] * np.uint8(6) + kind[1:]]
        lead = data[:-2]
        sure = (kind >= 1) & (kind <= 3)
        cut[2:-1] |= sure[:-2] & (kind[1:-1] == 5) & sure[2:]
        cut[2:-1] |= (kind[2:] >= 4) & (data[1:-1] >= 128) & (lead >= 0xC3) & (lead < 0xE0)
    return np.flatnonzero(cut)


# Latin letters only, but for a blank in front: nothing that the tokenizer would split.
_ONE_WORD = "^ ?[A-Za-zÀ-ÖØ-öø-ɏ]+$"


def _characters() -> str:
    """How a byte-level vocabulary spells each byte: printable ones stand for
    themselves, the others follow from 256 on in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return "".join(chr(b if b in printable else next(others)) for b in range(256))


_CHARACTERS = _characters()


class Encoder:
    """Token ids of texts; a distinct word is tokenised once while it is remembered."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Names of special tokens inside a text are ordinary text.
        self.tokenizer.encode_special_tokens = True
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.ends = array("H"), array("q", [0])

    def _rows(self, words: pa.Array) -> np.ndarray:
        """Where the ids of each word stand; words not met before are tokenised."""
        if len(self.known) > KNOWN:
            self._forget()
        every = words.to_pylist()
        one = pc.match_substring_regex(words, _ONE_WORD).to_pylist()
        plain = [w for w, is_one in zip(every, one) if is_one and w not in self.known]
        spelt = codecs.charmap_decode("\n".join(plain).encode(), "strict", _CHARACTERS)[0]
        look_up = self.tokenizer.model.tokenize
        self._learn(plain, ([t.id for t in look_up(w)] for w in spelt.split(_CHARACTERS[10])))
        rest = [w for w, is_one in zip(every, one) if not is_one and w not in self.known]
        for i in range(0, len(rest), 4096):
            part = rest[i : i + 4096]
            self._learn(part, (e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)))
        return np.fromiter(map(self.known.__getitem__, every), np.int64, len(every))

    def _learn(self, words: list[str], found: Iterator[list[int]]) -> None:
        first = len(self.ends) - 1
        for ids in found if words else ():
            self.flat.extend(ids)
            self.ends.append(len(self.flat))
        self.known.update(zip(words, range(first, first + len(words))))

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, ``END`` after each text, and where each text starts."""
        data, offsets = text_bytes(texts)
        at = cuts(data, offsets)
        words = pa.Array.from_buffers(
            pa.large_string(), max(len(at) - 1, 0), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)]
        ).dictionary_encode()
        rows = self._rows(words.dictionary)
        flat, ends = np.array(self.flat, np.uint16), np.array(self.ends, np.int64)
        row = rows[words.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.int64)
        counts = ends[row + 1] - ends[row]
        upto = np.concatenate([[0], np.cumsum(counts)])
        starts = upto[np.searchsorted(at, offsets)] + np.arange(len(offsets))
        out = np.full(int(starts[-1]), END, np.uint16)
        place = np.ones(len(out), bool)
        place[starts[1:] - 1] = False
        out[place] = flat[np.repeat(ends[row] - upto[:-1], counts) + np.arange(upto[-1])]
        return out, starts


def _runs(counts: np.ndarray) -> np.ndarray:
    """0 .. n - 1 for each count, end to end."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def _routed(path: str, task: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encode, seen = Encoder(path), {}
    for ids, texts in _read(batches):
        tokens, starts = encode(texts)
        # Least hash over the tokens but the end; a text of none has the end's.
        spans = np.maximum(starts[1:] - 1, starts[:-1] + 1)
        hashed = _HASH[tokens]
        both = np.stack([starts[:-1], spans], 1).ravel()
        least = np.minimum.reduceat(hashed, np.minimum(both, len(hashed) - 1))[::2] if len(hashed) else hashed
        turn = np.zeros(len(least), np.uint64)
        for i, key in enumerate(least.tolist()):
            turn[i] = seen.get(key, 0) // TOGETHER
            seen[key] = seen.get(key, 0) + 1
        turn = turn * _U(0x9E3779B97F4A7C15) + _U(task // POOL)
        route = mix(least ^ mix(turn)).view(np.int64)
        if len(seen) > 1_000_000:
            seen = {}
        yield pa.record_batch([
            ids.cast(pa.int64()), pa.array(route), pa.array(np.diff(starts).astype(np.int32)),
            pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer((starts * 2).astype(np.int32)), pa.py_buffer(tokens)]),
        ], names=["doc_id", "route", "n", "ids"])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Ids and texts in runs of about ``READ`` bytes."""
    held, size = [], 0
    for batch in batches:
        texts = batch.column(1).cast(pa.large_string())
        lengths = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        done = 0
        while done < batch.num_rows:
            base = lengths[done - 1] if done else 0
            last = max(int(np.searchsorted(lengths, base + READ - size, "right")), done + 1)
            held.append((batch.column(0)[done:last], texts[done:last]))
            size, done = size + int(lengths[last - 1] - base), last
            if size >= READ:
                yield pa.concat_arrays([h[0] for h in held]), pa.concat_arrays([h[1] for h in held])
                held, size = [], 0
    if held:
        yield pa.concat_arrays([h[0] for h in held]), pa.concat_arrays([h[1] for h in held])


class Index:
    """BM25 postings of a shard's texts; common terms weigh nothing and are left out."""

    def __init__(self, texts: list[np.ndarray]) -> None:
        n, size = len(texts), np.array([len(t) for t in texts])
        pairs = np.concatenate(texts).astype(np.uint64) | (np.repeat(np.arange(n, dtype=np.uint64), size) << _U(16))
        pairs, tf = np.unique(pairs, return_counts=True)
        doc, term = (pairs >> _U(16)).astype(np.int64), (pairs & _U(0xFFFF)).astype(np.int64)
        df = np.bincount(term, minlength=1 << 16)
        idf = np.maximum(np.log((n - df + 0.5) / (df + 0.5)), 0)
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[doc] / size.mean()))
        keep = np.flatnonzero(weight > 0)
        self.n, self.terms = n, term[keep]
        self.of = np.searchsorted(doc[keep], np.arange(n + 1))
        order = np.argsort(self.terms, kind="stable")
        self.docs, self.weights = doc[keep][order], weight[keep][order]
        self.at = np.searchsorted(self.terms[order], np.arange((1 << 16) + 1))

    def neighbours(self, seed: int) -> np.ndarray:
        """All texts that share a weighted term with ``seed``, best first; ties by place."""
        terms = self.terms[self.of[seed] : self.of[seed + 1]]
        lo = self.at[terms]
        counts = self.at[terms + 1] - lo
        where = np.repeat(lo, counts) + _runs(counts)
        score = np.bincount(self.docs[where], self.weights[where], self.n)
        order = np.argsort(-score, kind="stable")
        return order[score[order] > 0]


class Packer:
    """Fills windows from shard after shard; one short window may stay at the end."""

    def __init__(self, first_sequence: int) -> None:
        self.next, self.rows = first_sequence, []
        self.window, self.used = [], 0

    def _place(self, doc: tuple, start: int, length: int) -> None:
        self.window.append((doc, start, length))
        self.used += length
        if self.used == WINDOW:
            self._close()

    def _close(self) -> None:
        offset = 0
        for (doc_id, ids), start, length in self.window:
            self.rows.append((doc_id, start, length, len(ids), self.next, offset, ids[start : start + length]))
            offset += length
        self.next, self.window, self.used = self.next + 1, [], 0

    def shard(self, docs: list[tuple]) -> None:
        """Pack ``(doc_id, ids)`` of a shard; a window still open goes on."""
        index = Index([ids for _, ids in docs])
        start = [0] * len(docs)
        unused = np.ones(len(docs), bool)

        def take(d: int) -> bool:
            """Put what fits of a text into the window; True if a rest is left."""
            length = min(len(docs[d][1]) - start[d], WINDOW - self.used)
            self._place(docs[d], start[d], length)
            start[d] += length
            unused[d] = start[d] < len(docs[d][1])
            return bool(unused[d])

        following, rest = 0, None
        while True:
            while following < len(docs) and not unused[following]:
                following += 1
            if rest is None and following == len(docs):
                return
            seed = following if rest is None else rest
            if take(seed):
                rest = seed  # the text was longer than the room: it goes on in the next window
                continue
            rest = None
            if not self.used:
                continue
            for d in index.neighbours(seed):
                if unused[d]:
                    rest = int(d) if take(int(d)) else None
                    if not self.used:
                        break

    def finish(self) -> None:
        """Cut an open window to lengths that are powers of two."""
        todo, self.window, left = self.window, [], self.used
        self.used = 0
        while left:
            room = size = 1 << (left.bit_length() - 1)
            while room:
                doc, start, length = todo.pop(0)
                now = min(room, length)
                self.window.append((doc, start, now))
                if now < length:
                    todo.insert(0, (doc, start + now, length - now))
                room -= now
            self._close()
            left -= size

    def taken(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows)) or [[] for _ in range(7)]
        ids = [np.ascontiguousarray(x, "<u4").tobytes() for x in columns[6]]
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset"]
        order = [columns[0], columns[1], columns[2], columns[3], columns[4], columns[5]]
        return pa.record_batch([*[pa.array(c, pa.int64()) for c in order], pa.array(ids, pa.binary())], names=[*names, "ids"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # Sequences of a task are numbered from a place no other task reaches.
    packer, held, size = Packer(TaskContext.get().partitionId() << 40), [], 0
    for batch in batches:
        for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
            tokens = np.frombuffer(ids.as_buffer(), np.uint16)
            held.append((doc_id, tokens))
            size += len(tokens)
            if size >= BLOCK:
                packer.shard(held)
                held, size = [], 0
                yield packer.taken()
    if held:
        packer.shard(held)
    packer.finish()
    yield packer.taken()


def packed(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Pieces of ``docs`` (``doc_id, text``) in sequences of at most ``WINDOW`` tokens.

    ``doc_id, start, length, doc_tokens, sequence_id, offset`` and ``ids``, the
    piece's ids as little-endian 32-bit numbers. A null text is an empty one
    and has the end's id alone; repeated rows are packed each; a row without an
    id keeps a null; ties among neighbours go to the earlier text of the shard.
    Other columns are ignored. An empty table has no pieces.
    """
    routed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(
        lambda batches: _routed(tokenizer, TaskContext.get().partitionId(), batches), _ROUTED
    )
    # The order within a task is made whole by the sort, so a task that is run
    # again packs the same sequences.
    dealt = routed.repartition("route").sortWithinPartitions("route", "doc_id", "n", F.xxhash64("ids"))
    return dealt.select("doc_id", "ids").mapInArrow(_packed, _PIECES)
