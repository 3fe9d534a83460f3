"""Similarity join on word shingles by rare-first prefix filtering.

Two texts link when the Jaccard similarity of their sets of word n-grams is at
least ``percent`` / 100. The plan, one Spark job after the other:

1. *Signatures.* Each text becomes its set size and a 64-bit digest of its set.
   Equal sets are one class from here on, however many copies there are.
   Tasks also report the n-grams that are frequent among their own texts; an
   n-gram in 2 % of all texts is bound to be reported often enough to be known
   as hot. There are at most ``100 x mean set size`` of those at any corpus size.
2. *Document frequencies.* (n-gram, class) pairs are dealt out by n-gram, packed
   as binary blocks. Only n-grams of two or more classes go on, with their
   frequency. Hot n-grams bypass this step, as they are known to be last in
   the order, so no task ever holds the texts of a hot n-gram.
3. *Prefixes.* Regrouped by class, the n-grams are put in rare-first order:
   those of one class first, then by frequency. A class whose prefix of
   ``n - ceil(t n) + 1`` holds no shared n-gram has no partner and leaves.
4. *Candidates.* Classes that share a prefix n-gram meet, and pass the length,
   positional and suffix filters. Each pair is verified once, on the shared
   n-grams alone: an n-gram of one class is never in an intersection.

For components, most pairs need no look. Lists of more than ``LONG_LIST``
members elect a leader, another one in each list and round, and members that
link with it are merged, so a group of near copies collapses in a few rounds of
linear cost. Then every pair still in different components is looked at: short
lists whole, long ones in blocks, members outside the largest component against
all. That number can only be large if many texts share rare n-grams without
being linked, and no filter of this kind bounds it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from metricloom.llm import components
from metricloom.llm.common import stored
from metricloom.llm.hashing import LOWER, U, Chunk, Substrings, chunks, mix, pack, word_bounds

PERCENT = 85
WORDS = 4
LOCAL_SHARE = 100  # a task reports n-grams found in 1 of so many of its texts
HOT_DF = 1 << 30  # orders every hot n-gram after all others
BLOCK = 2_000_000  # n-grams a task holds at once
SIGNATURE_LONGS = 8  # 512 ranges of the hash space, for the suffix filter
LONG_LIST = 16  # longer lists are merged through leaders before pairs are enumerated
WORTHWHILE = 0.7  # a round that leaves a larger share of the pairs is the last
BLOCK_PAIRS = 1 << 18  # pairs a block of a long list looks at

_SIGNATURE = "kind int, doc_id long, key string, n long, digest long"
_BLOCK = "part long, hot boolean, digests binary, sizes binary, runs binary, grams binary, dfs binary"
_CLASS = "digest long, n int, rare int, grams array<long>, sig array<long>"


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, np.uint64).view(np.int64)


def gram_sets(chunk: Chunk, words: int) -> Iterator[np.ndarray]:
    """The sorted set of n-gram hashes of each text of a chunk.

    A text of fewer words has its whole sequence as its one n-gram.
    """
    data = LOWER[chunk.data]
    starts, ends, at = word_bounds(data, chunk.offsets)
    if not len(starts):
        yield from (np.zeros(0, np.uint64) for _ in range(chunk.size))
        return
    word = Substrings(data)(starts, ends)
    factor = mix(np.arange(11, 11 + words, dtype=np.uint64))
    full = np.zeros(max(len(word) - words + 1, 0), np.uint64)
    for i in range(words):
        full += mix(word[i : i + len(full)] + U(i)) * (factor[i] | U(1))
    full = mix(full)
    for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if j - i >= words:
            yield np.unique(full[i : j - words + 1])
        elif j > i:
            short = (mix(word[i:j] + U(j - i)) * (factor[: j - i] | U(1))).sum(dtype=np.uint64)
            yield mix(np.array([short + U(j - i)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def _digest(grams: np.ndarray) -> int:
    return int(_signed(mix(grams ^ U(0x5851F42D4C957F2D)).sum(dtype=np.uint64, keepdims=True))[0])


def _signatures(words: int):
    def run(batches):
        for batch in batches:
            ids, keys, texts = batch.columns
            sizes, digests, sets, held = [], [], [], 0
            found: dict[int, int] = {}

            def report():
                every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                grams, counts = np.unique(every, return_counts=True)
                often = counts >= max(3, len(sets) / LOCAL_SHARE)
                for g, c in zip(_signed(grams[often]).tolist(), counts[often].tolist(), strict=True):
                    found[g] = found.get(g, 0) + c
                sets.clear()

            for chunk in chunks(texts):
                for grams in gram_sets(chunk, words):
                    sizes.append(len(grams))
                    digests.append(_digest(grams))
                    sets.append(grams)
                    held += len(grams)
                    if held > BLOCK:
                        report()
                        held = 0
            report()
            k = len(found)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([0] * len(sizes) + [1] * k, pa.int32()),
                    pa.concat_arrays([ids, pa.nulls(k, pa.int64())]),
                    pa.concat_arrays([keys, pa.nulls(k, pa.string())]),
                    pa.array(sizes + list(found.values()), pa.int64()),
                    pa.array(digests + list(found), pa.int64()),
                ],
                ["kind", "doc_id", "key", "n", "digest"],
            )

    return run


class _Packer:
    """Blocks of (class, n-gram) pairs, one row for each part."""

    names = ["part", "hot", "digests", "sizes", "runs", "grams", "dfs"]

    @staticmethod
    def rows(part, hot, digest, size, gram, df=None) -> pa.RecordBatch:
        order = np.argsort(part, kind="stable")
        part, digest, size, gram = part[order], digest[order], size[order], gram[order]
        df = None if df is None else df[order]
        new = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (digest[1:] != digest[:-1])])
        run = np.diff(np.r_[new, len(part)])
        heads = np.flatnonzero(np.r_[True, part[new][1:] != part[new][:-1]])
        out: list[list] = [[] for _ in _Packer.names]
        for i, j in zip(heads.tolist(), np.r_[heads[1:], len(new)].tolist(), strict=True):
            own, rows = new[i:j], slice(new[i], new[i] + run[i:j].sum())
            values = (
                int(part[own[0]]), hot,
                pack(digest[own], np.int64), pack(size[own], np.int32), pack(run[i:j], np.int32),
                pack(gram[rows], np.uint64), b"" if df is None else pack(df[rows], np.int32),
            )
            for column, value in zip(out, values, strict=True):
                column.append(value)
        kinds = [pa.int64(), pa.bool_(), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(out, kinds, strict=True)], _Packer.names
        )

    @staticmethod
    def read(row: dict) -> tuple[np.ndarray, ...]:
        run = np.frombuffer(row["runs"], np.int32)
        return (
            np.repeat(np.frombuffer(row["digests"], np.int64), run),
            np.repeat(np.frombuffer(row["sizes"], np.int32), run),
            np.frombuffer(row["grams"], np.uint64),
            np.frombuffer(row["dfs"], np.int32),
        )


def _dealt(words: int, parts: int, hot: np.ndarray):
    """(n-gram, class) pairs by n-gram; hot n-grams by class, with their order."""

    def run(batches):
        for batch in batches:
            sets, digests, held, seen = [], [], 0, set()

            def flush():
                size = np.array([len(s) for s in sets], np.int32)
                gram = np.concatenate(sets)
                digest = np.repeat(np.array(digests, np.int64), size)
                size = np.repeat(size, size)
                at = np.searchsorted(hot, gram)
                known = hot[np.minimum(at, len(hot) - 1)] == gram if len(hot) else np.zeros(len(gram), bool)
                rest = ~known
                part = ((gram >> U(32)) * U(parts)) >> U(32)
                if rest.any():
                    yield _Packer.rows(part[rest].astype(np.int64), False, digest[rest], size[rest], gram[rest])
                if known.any():
                    to = (mix(digest[known].view(np.uint64)) % U(parts)).astype(np.int64)
                    df = HOT_DF + at[known]
                    yield _Packer.rows(to, True, digest[known], size[known], gram[known], df)
                sets.clear()
                digests.clear()

            for chunk in chunks(batch.column(0)):
                for grams in gram_sets(chunk, words):
                    digest = _digest(grams)
                    if not len(grams) or (digest, len(grams)) in seen:
                        continue
                    seen.add((digest, len(grams)))
                    sets.append(grams)
                    digests.append(digest)
                    held += len(grams)
                    if held > BLOCK:
                        yield from flush()
                        held = 0
            if sets:
                yield from flush()

    return run


def _by_part(batches, close):
    """Rows that come sorted by part, handed to ``close`` one part at a time."""
    part, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["part"] != part and rows:
                yield from close(rows)
                rows = []
            part = row["part"]
            rows.append(row)
    if rows:
        yield from close(rows)


def _frequencies(parts: int):
    """Keeps n-grams of two classes or more, with their frequency, by class."""

    def close(rows):
        cold = [_Packer.read(r) for r in rows if not r["hot"]]
        if cold:
            digest, size, gram, _ = (np.concatenate(x) for x in zip(*cold, strict=True))
            order = np.argsort(gram)
            same = gram[order][1:] == gram[order][:-1]
            order = order[np.r_[False, same] | np.r_[same, False]]
            # Copies of a class that came in different blocks count once.
            order = order[np.lexsort((size[order], digest[order], gram[order]))]
            digest, size, gram = digest[order], size[order], gram[order]
            if len(gram):
                first = np.r_[
                    True,
                    (gram[1:] != gram[:-1]) | (digest[1:] != digest[:-1]) | (size[1:] != size[:-1]),
                ]
                digest, size, gram = digest[first], size[first], gram[first]
                new = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
                run = np.diff(np.r_[new, len(gram)])
                df = np.repeat(run, run)
                digest, size, gram, df = (x[df > 1] for x in (digest, size, gram, df))
            if len(gram):
                order = np.lexsort((size, digest))
                to = (mix(digest[order].view(np.uint64)) % U(parts)).astype(np.int64)
                yield _Packer.rows(to, False, digest[order], size[order], gram[order], df[order])
        hot = [r for r in rows if r["hot"]]
        if hot:
            yield pa.RecordBatch.from_pylist(hot, schema=_arrow_block())

    return lambda batches: _by_part(batches, close)


def _arrow_block() -> pa.Schema:
    kinds = [pa.int64(), pa.bool_(), *[pa.binary()] * 5]
    return pa.schema(list(zip(_Packer.names, kinds, strict=True)))


def _classes(percent: int):
    """Classes whose prefix holds a shared n-gram, n-grams in rare-first order."""

    def close(rows):
        digest, size, gram, df = (np.concatenate(x) for x in zip(*map(_Packer.read, rows), strict=True))
        order = np.lexsort((gram, df, size, digest))
        digest, size, gram = digest[order], size[order], gram[order]
        # A hot n-gram comes once from each block that held a copy of the class.
        once = np.r_[True, (digest[1:] != digest[:-1]) | (size[1:] != size[:-1]) | (gram[1:] != gram[:-1])]
        digest, size, gram = digest[once], size[once], gram[once]
        new = np.flatnonzero(np.r_[True, (digest[1:] != digest[:-1]) | (size[1:] != size[:-1])])
        end = np.r_[new[1:], len(digest)]
        n = size[new].astype(np.int64)
        rare = n - (end - new)
        prefix = n - (percent * n + 99) // 100 + 1
        keep = rare < prefix
        if not keep.any():
            return
        new, end = new[keep], end[keep]
        held = np.zeros(len(gram) + 1, np.int64)
        np.add.at(held, new, 1)
        np.add.at(held, end, -1)
        values = _signed(gram[np.cumsum(held)[:-1] > 0])
        offsets = np.r_[0, np.cumsum(end - new)].astype(np.int32)
        bits = 64 * SIGNATURE_LONGS
        ranges = np.repeat(np.arange(len(new)), end - new) * bits + (values & (bits - 1))
        odd = (np.bincount(ranges, minlength=len(new) * bits) & 1).astype(np.uint8)
        sig = np.packbits(odd).view(np.int64)
        sigs = np.arange(len(new) + 1, dtype=np.int32) * SIGNATURE_LONGS
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(digest[new]), pa.array(n[keep].astype(np.int32)),
                pa.array(rare[keep].astype(np.int32)),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                pa.ListArray.from_arrays(pa.array(sigs), pa.array(sig)),
            ],
            ["digest", "n", "rare", "grams", "sig"],
        )

    return lambda batches: _by_part(batches, close)


def text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """Set size and digest by row (kind 0), and n-grams frequent in a task (1)."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text_key(F.col(text_col)).alias("key"),
        F.col(text_col).cast("string").alias("text"),
    )
    return stored(rows.mapInArrow(_signatures(words), _SIGNATURE), "signatures", "kind")


def classes(docs: DataFrame, text_col: str, signed: DataFrame, percent: int, words: int) -> DataFrame:
    """Distinct n-gram sets that may have a partner: id, digest, n, rare, grams, sig.

    ``grams`` has the n-grams found in other sets too, in the global order;
    ``rare`` says how many others come before them.
    """
    total = signed.where("kind = 0").agg(
        F.count("*").alias("texts"), F.coalesce(F.sum("n"), F.lit(0)).alias("grams")
    ).first()
    hot_rows = (
        signed.where("kind = 1").groupBy("digest").agg(F.sum("n").alias("n"))
        .where(F.col("n") * LOCAL_SHARE >= total["texts"]).collect()
    )
    hot = np.sort(np.array([r["digest"] for r in hot_rows], np.int64).view(np.uint64))
    parts = max(1, -(-total["grams"] // BLOCK))
    dealt = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(
        _dealt(words, parts, hot), _BLOCK
    )
    by_gram = dealt.repartition(parts, "part").sortWithinPartitions("part")
    shared = by_gram.mapInArrow(_frequencies(parts), _BLOCK)
    by_class = shared.repartition(parts, "part").sortWithinPartitions("part")
    found = by_class.mapInArrow(_classes(percent), _CLASS)
    return stored(found.select(F.monotonically_increasing_id().alias("id"), "*"), "classes")


def prefixes(found: DataFrame, percent: int) -> DataFrame:
    """(gram, id, n, place in the order, shared, sig) of prefix n-grams.

    ``shared`` counts the class's n-grams that other classes have too; ``sig``
    has a bit for each range of the hash space, set if it holds an odd number.
    """
    prefix = F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)).cast("int") + 1
    rows = found.select(
        "id", "n", "rare", F.size("grams").alias("shared"), "sig",
        F.posexplode(F.slice("grams", F.lit(1), prefix - F.col("rare"))).alias("i", "gram"),
    )
    return rows.select("gram", "id", "n", (F.col("rare") + F.col("i")).alias("place"), "shared", "sig")


def passes(a: str, b: str, percent: int) -> Column:
    """Length, positional and suffix filter for two prefix rows of one n-gram.

    None loses a link. The positional bound holds at the pair's first common
    prefix n-gram. The suffix filter bounds the difference of the two sets from
    below: a range that holds an odd number of one set and an even number of
    the other holds an n-gram that they do not share.
    """
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    i, j = F.col(f"{a}.place"), F.col(f"{b}.place")
    length = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    bound = lambda most: most * 100 >= (n + m - most) * percent
    positional = bound(F.least(n - i, m - j))
    differ = reduce(
        lambda x, y: x + y,
        [
            F.bit_count(F.col(f"{a}.sig")[k].bitwiseXOR(F.col(f"{b}.sig")[k]))
            for k in range(SIGNATURE_LONGS)
        ],
    )
    common = F.floor((F.col(f"{a}.shared") + F.col(f"{b}.shared") - differ) / 2)
    return length & positional & bound(common)


def _ordered(x: str, y: str) -> list[Column]:
    """A pair and its components, the smaller id first."""
    swap = F.col(f"{x}.id") > F.col(f"{y}.id")
    pick = lambda f, a, b, name: F.when(swap, F.col(f"{b}.{f}")).otherwise(F.col(f"{a}.{f}")).alias(name)
    return [
        pick("id", x, y, "a"), pick("id", y, x, "b"), pick("comp", x, y, "comp_a"), pick("comp", y, x, "comp_b"),
    ]


def verified(pairs: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """The distinct pairs that link, with their intersection's size."""
    side = lambda name: found.select(
        F.col("id").alias(name), F.col("n").alias(f"{name}_n"), F.col("grams").alias(f"{name}_grams")
    )
    both = pairs.distinct().join(side("a"), "a").join(side("b"), "b")
    inter = F.size(F.array_intersect("a_grams", "b_grams")).alias("shared")
    return both.select(*pairs.columns, "a_n", "b_n", inter).where(
        F.col("shared") * 100 >= (F.col("a_n") + F.col("b_n") - F.col("shared")) * percent
    ).drop("a_n", "b_n")


_MEMBER = ["id", "n", "place", "shared", "sig", "comp"]


def _leader_pairs(rows: DataFrame, seed: int, percent: int) -> DataFrame:
    """Each member of a list with the list's leader, where components differ."""
    rank = F.struct(F.xxhash64("id", "gram", F.lit(seed)), *_MEMBER)
    lead = rows.groupBy("gram").agg(F.min(rank).alias("y"))
    both = rows.select("gram", F.struct(*_MEMBER).alias("x")).join(lead, "gram")
    return both.where((F.col("x.comp") != F.col("y.comp")) & passes("x", "y", percent)).select(
        *_ordered("x", "y")
    )


def _short_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of one list that are in different components, all in one task."""
    row = F.struct(*_MEMBER)
    x, y = rows.select("gram", row.alias("x")), rows.select("gram", row.alias("y"))
    both = x.join(y, "gram").where(
        (F.col("x.id") < F.col("y.id")) & (F.col("x.comp") != F.col("y.comp")) & passes("x", "y", percent)
    )
    return both.select(*_ordered("x", "y"))


def _list_shapes(rows: DataFrame) -> DataFrame:
    """gram, k, main, rest: a list's length, its largest component, and who is not in it."""
    shares = rows.groupBy("gram", "comp").agg(F.count("*").alias("c"))
    most = F.max(F.struct("c", "comp"))
    return shares.groupBy("gram").agg(F.sum("c").alias("k"), most.alias("m")).select(
        "gram", "k", F.col("m.comp").alias("main"), (F.col("k") - F.col("m.c")).alias("rest")
    )


def _long_pairs(rows: DataFrame, shapes: DataFrame, percent: int) -> DataFrame:
    """Pairs of one list that are in different components, in blocks.

    Members outside the list's largest component are dealt over blocks and meet
    all members there, so a block has about ``BLOCK_PAIRS`` pairs to look at.
    """
    blocks = F.ceil(F.col("rest") * F.col("k") / F.lit(BLOCK_PAIRS)).cast("int")
    open_lists = shapes.where("rest > 0").select("gram", "main", blocks.alias("blocks"))
    own = rows.join(open_lists, "gram")
    x = own.where("comp != main").select(
        "gram", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), F.struct(*_MEMBER).alias("x")
    )
    y = own.select(
        "gram", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "main",
        F.struct(*_MEMBER).alias("y"),
    )
    once = (F.col("y.comp") == F.col("main")) | (F.col("x.id") < F.col("y.id"))
    both = x.join(y, ["gram", "block"]).where(
        once & (F.col("x.comp") != F.col("y.comp")) & passes("x", "y", percent)
    )
    return both.select(*_ordered("x", "y"))


def _placed(rows: DataFrame, moved: DataFrame | None) -> DataFrame:
    """Rows with their class's component; a class not in ``moved`` is its own."""
    if moved is None:
        return rows.withColumn("comp", F.col("id"))
    return rows.join(moved, "id", "left").withColumn("comp", F.coalesce("comp", "id"))


def _merged(moved: DataFrame | None, links: DataFrame) -> DataFrame:
    """(id, comp) of the classes that are not their component's name."""
    roots = stored(components.connected(links, "comp_a", "comp_b").where("id != comp"), "roots")
    if moved is None:
        return roots
    to = roots.select(F.col("id").alias("comp"), F.col("comp").alias("root"))
    earlier = moved.join(to, "comp", "left").select("id", F.coalesce("root", "comp").alias("comp"))
    return stored(earlier.unionByName(roots), "comps")


def link_components(found: DataFrame, percent: int) -> DataFrame:
    """(id, comp) of every class: its own id if it links with no other.

    Leaders are elected anew in long lists until few pairs are left to look at
    or a round leaves most of them; then every pair still apart is looked at.
    """
    rows = prefixes(found, percent)
    long_lists = stored(
        rows.groupBy("gram").agg(F.count("*").alias("k")).where(F.col("k") > LONG_LIST).select("gram"), "long-lists"
    )
    long_rows = stored(rows.join(long_lists, "gram"), "long-rows")
    moved, seed, before = None, 0, None
    while True:
        placed = _placed(long_rows, moved)
        shapes = stored(_list_shapes(placed), "shapes")
        left = shapes.agg(F.sum(F.col("rest") * F.col("k")).alias("pairs"), F.sum("k").alias("rows")).first()
        pairs_left = left["pairs"] or 0
        if pairs_left <= LONG_LIST * (left["rows"] or 0) or before and pairs_left > WORTHWHILE * before:
            break
        # Links between two components are one edge, however many texts they tie.
        open_rows = placed.join(shapes.where("rest > 0").select("gram"), "gram", "left_semi")
        links = stored(
            verified(_leader_pairs(open_rows, seed, percent), found, percent).select("comp_a", "comp_b").distinct(),
            "links",
        )
        if links.isEmpty():
            break
        moved, seed, before = _merged(moved, links), seed + 1, pairs_left
    short = _placed(rows.join(long_lists, "gram", "left_anti"), moved)
    pairs = _short_pairs(short, percent).unionByName(_long_pairs(placed, shapes, percent))
    moved = _merged(moved, verified(pairs, found, percent).select("comp_a", "comp_b").distinct())
    return _placed(found.select("id"), moved)


def similar_pairs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    percent: int = PERCENT, words: int = WORDS,
) -> DataFrame:
    """Every linked pair of distinct n-gram sets: a, b, shared.

    ``a`` and ``b`` are classes (digest, n); :func:`near_duplicates` has the
    digest of each text. All pairs are given, so a group of k similar sets
    gives up to k * (k - 1) / 2 rows; use :func:`near_duplicates` for groups.
    """
    found = classes(docs, text_col, signatures(docs, id_col, text_col, words), percent, words)
    pairs = _short_pairs(_placed(prefixes(found, percent), None), percent).select("a", "b")
    name = lambda c: found.select(F.col("id").alias(c), F.struct("digest", "n").alias(f"{c}_class"))
    linked = verified(pairs, found, percent).join(name("a"), "a").join(name("b"), "b")
    return linked.select(F.col("a_class").alias("a"), F.col("b_class").alias("b"), "shared")


def _members(docs: DataFrame, id_col: str, text_col: str, percent: int, words: int) -> DataFrame:
    """doc_id, key, n, digest, comp, component_id; no comp for rows without words."""
    signed = signatures(docs, id_col, text_col, words)
    found = classes(docs, text_col, signed, percent, words)
    comps = found.select("id", "digest", F.col("n").cast("long").alias("n")).join(
        link_components(found, percent), "id"
    ).drop("id")
    rows = signed.where("kind = 0").drop("kind")
    # A set without a partner is its own component, under its digest and size.
    lone = F.col("comp").isNull()
    comp = F.struct(F.col("comp").alias("id"), F.when(lone, F.col("digest")).alias("digest"), F.when(lone, F.col("n")).alias("n"))
    # Per distinct set first, so copies are folded before anything is joined.
    sets = (
        rows.where("n > 0").groupBy("digest", "n").agg(F.min("doc_id").alias("least"))
        .join(comps, ["digest", "n"], "left").withColumn("comp", comp)
    )
    least = sets.groupBy("comp").agg(F.min("least").alias("component_id"))
    by_set = sets.join(least, "comp").select("digest", "n", "comp", "component_id")
    return rows.join(by_set, ["digest", "n"], "left")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    percent: int = PERCENT, words: int = WORDS,
) -> DataFrame:
    """doc_id, n_shingles, digest, component_id of every row.

    ``component_id`` is the smallest id reachable by links, the row's own
    included. A null or wordless text has no n-gram and is alone. Rows with
    equal sets are linked. A row without id takes part in links, and gets the
    smallest id of its component (null if it is alone). Repeated rows stay
    repeated. Other columns are ignored. An empty table gives no row.
    """
    alone = F.col("n") == 0
    return _members(docs, id_col, text_col, percent, words).select(
        "doc_id", F.col("n").alias("n_shingles"), "digest",
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def deduplicated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    percent: int = PERCENT, words: int = WORDS,
) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id.

    Of rows that repeat one id and text, one stays. Rows without an id yield
    to rows with one. Rows without words are like nothing and all stay.
    Columns of ``docs`` may have any names and come back as they are.
    """
    rows = _members(docs, id_col, text_col, percent, words).where("n > 0")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("first")
    winners = rows.groupBy("comp").agg(first).select("comp", "first.doc_id", "first.key")
    won = winners.select("doc_id", "key").distinct()
    keyed = docs.select(
        F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"),
        text_key(F.col(text_col)).alias("key"),
        F.coalesce(F.col(text_col).cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("worded"),
    )
    same = keyed["id"].eqNullSafe(won["doc_id"]) & (keyed["key"] == won["key"])
    kept = keyed.where("worded").join(won, same, "left_semi")
    copy = F.row_number().over(Window.partitionBy("id", "key").orderBy("worded"))
    once = kept.withColumn("copy", copy).where("copy = 1")
    return once.select("row.*").unionByName(keyed.where("NOT worded").select("row.*"))
