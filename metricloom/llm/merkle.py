"""Merkle manifest of a dataset, with nested intervals as node labels.

Rows are leaves, ranked within a group. A node carries the interval of leaf
ranks it covers, ``[lo, hi)``. At level ``v`` a node starts at a multiple of
``2**v``, so a *bucket* of ``2**BAND`` neighbouring nodes of one level covers
one node ``BAND`` levels up, and everything between the two lies inside the
bucket. The tree is built band by band: a grouping by bucket per band, which
never gathers more than ``2**BAND`` nodes, and as many rounds as the tree has
bands. Ancestors are attached the other way round: each bucket is joined to the
node of the next band that contains its interval, an equi-join on (group,
level, bucket) with the containment of intervals on top, and inside a bucket
the siblings of a node are what the parent's interval has over the node's own.

A proof thus costs one row per leaf whatever the depth: what all leaves of a
bucket share is joined once per bucket.

Groups hang under one root: their subroots, in order of the group, are the
leaves of a second tree of the same kind.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from metricloom.llm.common import let, stored

#: Levels of a band; a bucket holds 2**BAND nodes at most.
BAND = 6

_STEP = "array<struct<level:int,before:string,after:string>>"


@dataclass(frozen=True)
class Tree:
    """``leaves``: ``grp, rank, size, depth, leaf`` and what the caller carries;
    ``bands``: node tables ``grp, level, lo, hi, size, depth, digest``, lowest first."""

    leaves: DataFrame
    bands: list[DataFrame]

    @property
    def nodes(self) -> DataFrame:
        """Every node once: ``grp, level, lo, hi, digest``."""
        found = [
            b.where((F.col("level") > i * BAND) | (F.col("level") == 0))
            for i, b in enumerate(self.bands)
        ]
        return reduce(DataFrame.unionByName, found).select("grp", "level", "lo", "hi", "digest")

    def tops(self) -> DataFrame:
        """``grp, digest`` of each group's last node."""
        return self.nodes_at_top().select("grp", "digest")

    def nodes_at_top(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [
            b.where((F.col("level") == F.col("depth")) & ((F.col("level") > i * BAND) | (F.col("level") == 0)))
            for i, b in enumerate(self.bands)
        ])


def field(value: Column) -> Column:
    """``-`` for null, else byte count, colon and value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the concatenated parts."""
    return F.sha2(F.concat(*parts), 256)


def ranked(leaves: DataFrame) -> DataFrame:
    """``leaves`` (``grp, key, leaf`` and more) with ``rank``, ``size`` and ``depth`` of the group.

    Leaves ascend by ``key``, nulls first; equal keys by their digest, so ties
    give the same tree in any partitioning. Ranks come from one range shuffle
    of narrow rows and a table of counts with a row per partition and group:
    no group, however large, meets in a task.
    """
    dealt = (
        leaves.repartitionByRange("grp", "key", "leaf").sortWithinPartitions("grp", "key", "leaf")
        .withColumn("place", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("place", 33))
    )
    dealt = stored(dealt, "merkle-leaves")
    counts = dealt.groupBy("grp", "part").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("grp").orderBy("part")
    offsets = counts.select(
        "grp", "part", "first",
        (F.sum("n").over(before) - F.col("n")).alias("base"),
        F.sum("n").over(Window.partitionBy("grp")).alias("size"),
    )
    top = F.col("size") - 1
    # Bits of size - 1: the levels until one node is left.
    depth = F.when(top == 0, 0).otherwise(F.length(F.bin(top)))
    return (
        dealt.join(offsets, ["grp", "part"])
        .withColumn("rank", F.col("place") - F.col("first") + F.col("base"))
        .withColumn("depth", depth.cast("int"))
        .drop("place", "part", "first", "base")
    )


def _buckets(level: DataFrame, base: int, *carry: str) -> DataFrame:
    """Nodes of a level gathered by bucket, ``members``, in order, with what is carried."""
    bucket = F.expr(f"shiftright(lo, {base + BAND})")
    rows = level.groupBy("grp", bucket.alias("bucket")).agg(
        F.first("size").alias("size"), F.first("depth").alias("depth"),
        F.array_sort(F.collect_list(F.struct("lo", "hi", "digest", *carry))).alias("members"),
    )
    start = F.shiftleft("bucket", base + BAND)
    return rows.select(
        "grp", "bucket", "size", "depth", "members", start.alias("lo"),
        F.least(start + F.lit(1 << (base + BAND)).cast("long"), F.col("size")).alias("hi"),
    )


def _tree(base: int) -> Column:
    """The nodes of a bucket's levels ``base`` to ``base + BAND``, as far as they exist."""
    pairs = lambda under: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(under) - 1) / 2).cast("int")),
        lambda i: digest(F.get(under, 2 * i), F.coalesce(F.get(under, 2 * i + 1), F.lit(""))),
    )
    steps = F.least(F.lit(BAND), F.greatest(F.col("depth") - base, F.lit(0)))
    # An aggregate's own argument is never computed twice, whatever the optimiser inlines.
    levels = F.aggregate(
        F.sequence(F.lit(0), steps), F.array(F.col("members.digest")),
        lambda made, step: F.when(step == 0, made).otherwise(
            F.concat(made, F.array(pairs(F.element_at(made, -1))))),
    )

    def node(d: Column, i: Column, step: Column) -> Column:
        width = F.call_function("shiftleft", F.lit(1).cast("long"), step + base)
        return F.struct(
            (step + base).cast("int").alias("level"), (F.col("lo") + i * width).alias("lo"),
            F.least(F.col("lo") + (i + 1) * width, F.col("size")).alias("hi"), d.alias("digest"),
        )

    return F.flatten(F.transform(levels, lambda ds, step: F.transform(ds, lambda d, i: node(d, i, step))))


def grown(leaves: DataFrame) -> Tree:
    """The tree of every group of ``leaves`` (``grp, key, leaf`` and more)."""
    leaves = stored(ranked(leaves), "merkle-ranked")
    depth = leaves.agg(F.max("depth")).first()[0]
    level = leaves.select(
        "grp", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "size", "depth",
        F.col("leaf").alias("digest"),
    )
    bands = []
    for base in range(0, max(depth or 0, 1), BAND):
        made = _buckets(level, base).select(
            "grp", "size", "depth", F.explode(_tree(base)).alias("node")
        ).select("grp", "size", "depth", "node.*")
        bands.append(stored(made, "merkle-nodes"))
        level = bands[-1].where((F.col("level") == base + BAND) & (F.col("depth") > base + BAND))
    return Tree(leaves, bands)


def _steps(base: int) -> Column:
    """For a member of a bucket: what each parent's interval has over the node's own.

    Nodes of the level that lie in the parent's interval before the node's own
    and after it; with two children to a node one of both is empty, and for the
    last of an odd level both are.
    """

    def at(level: Column, member: Column, tree: Column) -> Column:
        width = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        lo = member["lo"] - F.pmod(member["lo"], width)
        parent = member["lo"] - F.pmod(member["lo"], width * 2)
        inside = lambda x, a, b: (x["level"] == level) & (x["lo"] >= a) & (x["hi"] <= b)
        text = lambda a, b: F.array_join(
            F.transform(F.filter(tree, lambda x: inside(x, a, b)), lambda x: x["digest"]), "")
        return F.struct(
            level.cast("int").alias("level"),
            text(parent, lo).alias("before"),
            text(lo + width, F.least(parent + width * 2, F.col("size"))).alias("after"),
        )

    last = F.least(F.lit(base + BAND), F.col("depth")) - 1
    levels = F.when(last >= base, F.sequence(F.lit(base), last)).otherwise(F.array().cast("array<int>"))
    return let(_tree(base), lambda tree: F.transform("members", lambda m: F.struct(
        m.alias("member"), F.transform(levels, lambda v: at(v, m, tree)).cast(_STEP).alias("steps"))))


def proofs(tree: Tree, *carry: str) -> DataFrame:
    """``grp, rank, leaf`` and ``carry`` of every leaf with ``path``, its siblings from below.

    A path has a step for each level: the digests of the parent's other
    children, those before the node and those after it.
    """
    above: DataFrame | None = None
    for base in reversed(range(0, len(tree.bands) * BAND, BAND)):
        if base:
            level, more = tree.bands[base // BAND].where(F.col("level") == base), ()
        else:
            more = tuple(carry)
            level = tree.leaves.select(
                "grp", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "size", "depth",
                F.col("leaf").alias("digest"), *more,
            )
        buckets = _buckets(level, base, *more)
        rest = F.array().cast(_STEP)
        if above is not None:
            up = above.select(
                F.col("grp").alias("up_grp"), F.expr(f"shiftright(lo, {base + BAND})").alias("up_bucket"),
                F.col("lo").alias("up_lo"), F.col("hi").alias("up_hi"), F.col("path").alias("up_path"),
            )
            contains = (F.col("up_lo") <= F.col("lo")) & (F.col("hi") <= F.col("up_hi"))
            buckets = buckets.join(
                up, (F.col("grp") == F.col("up_grp")) & (F.col("bucket") == F.col("up_bucket")) & contains, "left"
            )
            rest = F.coalesce(F.col("up_path"), rest)
        found = buckets.withColumn("rest", rest).select(
            "grp", "rest", F.explode(_steps(base)).alias("m")
        ).select("grp", F.col("m.member").alias("member"), F.concat("m.steps", "rest").alias("path"))
        if base:
            above = stored(found.select("grp", "member.lo", "member.hi", "path"), "merkle-paths")
    return found.select(
        "grp", F.col("member.lo").alias("rank"), F.col("member.digest").alias("leaf"),
        *[F.col(f"member.{c}") for c in carry], "path",
    )


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda node, s: digest(s["before"], node, s["after"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


@dataclass(frozen=True)
class Manifest:
    """``rows``: ``grp``, ``leaf``, what is carried, ``subroot``, ``root`` and ``path`` of
    every row; ``groups`` and ``top``: the trees."""

    rows: DataFrame
    groups: Tree
    top: Tree


def manifest(docs: DataFrame, group: str, key: str, fields: list[str], carry: dict[str, Column] | None = None) -> Manifest:
    """Manifest of ``docs``: a tree for each ``group``, leaves by ``key``, one root over all.

    A leaf is the digest of ``fields``; ``carry`` names further columns of the
    result. A null group is one of its own and the first; a null key is a leaf
    before all others; null fields are ``-``. Repeated rows are leaves of equal
    digest, so it does not matter which is which. Very long texts are hashed
    as a stream and never shuffled. An empty table has no rows and no root.
    """
    carry = carry or {}
    mark = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaves = docs.select(
        mark.alias("grp"), F.col(key).alias("key"),
        digest(*[field(F.col(f)) for f in fields]).alias("leaf"),
        *[value.alias(f"c_{name}") for name, value in carry.items()],
    )
    names = [f"c_{name}" for name in carry]
    groups = grown(leaves)
    subroots = groups.tops().select(F.lit("").alias("grp"), F.col("grp").alias("key"), F.col("digest").alias("leaf"))
    top = grown(subroots)
    upper = proofs(top, "key").select(
        F.col("key").alias("grp"), F.col("leaf").alias("subroot"),
        folded(F.col("leaf"), F.col("path")).alias("root"), F.col("path").alias("upper"),
    )
    upper = stored(upper, "merkle-top")
    rows = proofs(groups, "key", *names).join(upper, "grp").select(
        "grp", "key", "leaf", "subroot", "root", F.concat("path", "upper").alias("path"),
        *[F.col(f"c_{name}").alias(name) for name in carry],
    )
    return Manifest(rows, groups, top)


def audited(docs: DataFrame) -> DataFrame:
    """Proofs of ``documents`` rows, and which still hold after tampering.

    Where 7 divides the CRC-32 of the id, the row is changed after the manifest
    was made: one is added to ``n_chars``. A row without an id, and the count
    of a row without one, stay as they are.
    """
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    more = {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    found = F.when(hit, digest(*[field(more.get(f, F.col(f))) for f in fields]))
    made = manifest(docs, "lang", "doc_id", fields, {"tampered": found}).rows
    last = folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return made.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root",
        proof_digest(F.col("path")).alias("proof_sha256"), last.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
