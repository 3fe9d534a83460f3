"""Chat formatting: linking tool calls with their results.

Calls and results of a conversation meet by identifier in a hash join. Calls
are put in topological order of the calls they build on, their arguments are
validated against the tool's schema, and each linked call is serialised as
canonical JSON (keys sorted, no blanks). Rows stay rows: a conversation of any
length is never gathered, its order is the columns (level, turn, seq).
Everything is DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from metricloom.llm.common import stored

#: Tool -> argument -> (type, required). Types: string, integer, number, boolean, array, object.
SCHEMAS = {
    "answer": {"text": ("string", True), "n_chars": ("integer", True), "style": ("string", False)},
    "search": {"query": ("string", True), "limit": ("integer", False)},
}
_TYPES = {
    "string": ["STRING"],
    "integer": ["BIGINT", "INT", "SMALLINT", "TINYINT"],
    "number": ["BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT", "DECIMAL"],
    "boolean": ["BOOLEAN"],
    "array": ["ARRAY"],
    "object": ["OBJECT"],
}


#: Rounds of levels after which what is known is written anew, so plans stay short.
ROUNDS = 16


def _is(value: Column, type_: str) -> Column:
    """Whether a variant has a type of ``_TYPES``; integers may have up to 38 digits."""
    full = F.schema_of_variant(value)
    plain = F.regexp_extract(full, r"^(\w+)", 1).isin(_TYPES[type_])
    return plain | full.rlike(r"^DECIMAL\(\d+, *0\)$") if type_ == "integer" else plain


def argument_errors(name: Column, arguments: Column, schemas: dict) -> Column:
    """Sorted faults of a variant of arguments; empty if it fits its tool's schema."""
    kind = lambda v: F.regexp_extract(F.schema_of_variant(v), r"^(\w+)", 1)
    out = F.when(name.isNull() | ~name.isin(list(schemas)), F.array(F.lit("unknown_tool")))
    for tool, fields in schemas.items():
        checks = []
        for field, (type_, required) in fields.items():
            value = F.try_variant_get(arguments, f"$['{field}']", "variant")
            missing = value.isNull() | (kind(value) == "VOID")
            if required:
                checks.append(F.when(missing, F.lit(f"missing:{field}")))
            checks.append(F.when(~missing & ~_is(value, type_), F.lit(f"type:{field}")))
        known = F.array(*map(F.lit, fields))
        keys = F.map_keys(F.try_variant_get(arguments, "$", "map<string,variant>"))
        extra = F.transform(F.array_except(keys, known), lambda k: F.concat(F.lit("extra:"), k))
        found = F.concat(
            F.filter(F.array(*checks), lambda e: e.isNotNull()),
            F.coalesce(extra, F.array().cast("array<string>")),
        )
        not_object = arguments.isNull() | (kind(arguments) != "OBJECT")
        out = out.when(
            name == tool, F.when(not_object, F.array(F.lit("not_an_object"))).otherwise(F.array_sort(found))
        )
    return out


def chains(single: DataFrame) -> DataFrame:
    """(conv, call_id, target, dist): the end of the chain each call stands in.

    ``single``: (conv, call_id, dep) of the calls that build on one call. A
    chain ends at the first call that is not of these, ``dist`` steps away.
    Steps double in each round, so a chain of n calls takes log2(n) rounds;
    calls on or behind a cycle reach no end and are left out.
    """
    inner = single.select("conv", F.col("call_id").alias("dep"), F.lit(True).alias("inner"))
    steps = stored(
        single.join(inner, ["conv", "dep"], "left").select(
            "conv", "call_id", F.col("dep").alias("target"), F.lit(1).cast("long").alias("dist"),
            F.col("inner").isNull().alias("ended"),
        ),
        "steps",
    )
    ended, open_ = steps.where("ended"), steps.where("NOT ended")
    left, before = open_.count(), None
    # While a chain is open, the calls next behind its ended part end in the round.
    while left and left != before:
        on = ended.unionByName(open_).select(
            "conv", F.col("call_id").alias("target"), F.col("target").alias("end"), F.col("dist").alias("more"),
            "ended",
        )
        steps = stored(
            open_.drop("ended").join(on, ["conv", "target"]).select(
                "conv", "call_id", F.col("end").alias("target"), (F.col("dist") + F.col("more")).alias("dist"),
                "ended",
            ),
            "steps",
        )
        ended, open_ = ended.unionByName(steps.where("ended")), steps.where("NOT ended")
        left, before = open_.count(), left
    return ended.drop("ended")


def levels(calls: DataFrame) -> DataFrame:
    """(conv, call_id, level): one more than the highest level a call builds on.

    Calls that build on none known have level 0; those on or behind a cycle
    have none and are left out. Chains of calls that build on one call each are
    measured whole; beyond that there is one job for each level of calls that
    build on several.
    """
    nodes = calls.select("conv", "call_id").where("conv IS NOT NULL AND call_id IS NOT NULL").distinct()
    edges = stored(
        calls.select("conv", "call_id", F.explode("after").alias("dep")).distinct()
        .join(nodes.withColumnRenamed("call_id", "dep"), ["conv", "dep"]).select("conv", "call_id", "dep"),
        "edges",
    )
    counted = stored(
        edges.groupBy("conv", "call_id").agg(F.count("*").alias("n"), F.min("dep").alias("dep")), "counted"
    )
    behind = stored(chains(counted.where("n = 1").select("conv", "call_id", "dep")), "chains")
    done = stored(
        nodes.join(counted, ["conv", "call_id"], "left_anti").withColumn("level", F.lit(0).cast("long")), "levels"
    )
    ends = behind.select("conv", F.col("call_id").alias("dep"), "target", "dist")
    several = stored(
        edges.join(counted.where("n > 1").select("conv", "call_id"), ["conv", "call_id"])
        .join(ends, ["conv", "dep"], "left").select(
            "conv", "call_id", F.coalesce("target", "dep").alias("dep"),
            (F.coalesce("dist", F.lit(0).cast("long")) + 1).alias("dist"),
        ),
        "several",
    )
    more, rounds = not several.isEmpty(), 0
    while more:
        known = done.select("conv", F.col("call_id").alias("dep"), "level")
        ready = (
            several.join(known, ["conv", "dep"], "left").groupBy("conv", "call_id")
            .agg(F.count("*").alias("n"), F.count("level").alias("k"), F.max(F.col("level") + F.col("dist")).alias("level"))
            .where("n = k").select("conv", "call_id", "level")
        )
        new = stored(ready.join(done, ["conv", "call_id"], "left_anti"), "levels")
        more = not new.isEmpty()
        done, rounds = done.unionByName(new), rounds + 1
        if rounds % ROUNDS == 0:
            done = stored(done, "levels")
    known = done.select("conv", F.col("call_id").alias("target"), "level")
    return done.unionByName(
        behind.join(known, ["conv", "target"]).select("conv", "call_id", (F.col("level") + F.col("dist")).alias("level"))
    )


def linked(calls: DataFrame, results: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    """One row for each call, each result without a call, and each further result of a call.

    ``calls``: conv, call_id, turn, seq, name, arguments (JSON text), after
    (ids of calls it builds on). ``results``: conv, call_id, turn, content and,
    if there is one, role, else ``user``. Both may have more columns, which are
    ignored.

    Columns: conv, call_id, level, turn, seq, status, errors, n_results, json.
    Status is ``linked``, ``pending`` (no result), ``cyclic``, ``invalid``
    (arguments do not fit), ``duplicate`` (an earlier call has the id),
    ``no_id`` (conversation or id is null), or for a result ``unlinked`` or
    ``further``. The first result by (turn, content, role) is part of its call's
    line; each later one is a ``further`` row that names the call, so (turn)
    gives their order and a call with any number of results is never gathered.
    Equal results of a call are counted in ``n_results`` and given once.
    Unparsable or null arguments are not an object, and their text stays as
    ``arguments_raw``; ids in ``after`` that no call has are ignored. Null
    fields, a null role too, are left out of the JSON. An empty table on either
    side is fine.
    """
    role = F.col("role") if "role" in results.columns else F.lit("user")
    results = results.select("conv", "call_id", "turn", "content", role.cast("string").alias("role"))
    calls = calls.select(
        "conv", "call_id", "turn", "seq", "name", "arguments",
        F.coalesce("after", F.array().cast("array<string>")).alias("after"),
    )
    answers = (
        results.where("conv IS NOT NULL AND call_id IS NOT NULL").groupBy("conv", "call_id")
        .agg(F.min(F.struct("turn", "content", "role")).alias("first"), F.count("*").alias("n_results"))
    )
    leads = calls.groupBy("conv", "call_id").agg(F.min(F.struct("turn", "seq")).alias("lead"))
    keys = ["conv", "call_id"]
    rows = (
        calls.join(leads.hint("shuffle_hash"), keys, "left")
        .join(answers.hint("shuffle_hash"), keys, "left")
        .join(levels(calls), keys, "left")
    )
    parsed = F.try_parse_json("arguments")
    errors = argument_errors(F.col("name"), F.col("parsed"), schemas)
    rows = rows.withColumn("parsed", parsed).withColumn("errors", errors)
    status = (
        F.when(F.col("conv").isNull() | F.col("call_id").isNull(), "no_id")
        .when(F.struct("turn", "seq") != F.col("lead"), "duplicate")
        .when(F.col("level").isNull(), "cyclic")
        .when(F.size("errors") > 0, "invalid")
        .when(F.col("first").isNull(), "pending")
        .otherwise("linked")
    )
    line = F.to_json(F.struct(
        F.sort_array("after").alias("after"), F.col("parsed").alias("arguments"),
        F.when(F.col("parsed").isNull(), F.col("arguments")).alias("arguments_raw"), "call_id", "name",
        F.col("first.content").alias("result"), F.col("first.role").alias("result_role"),
        F.lit("assistant").alias("role"),
    ))
    done = rows.select(
        "conv", "call_id", F.col("level").cast("int").alias("level"), "turn", "seq", status.alias("status"),
        "errors", F.coalesce("n_results", F.lit(0).cast("long")).alias("n_results"), line.alias("json"),
    )
    known = calls.select(*keys).distinct()
    alone = results.join(known, keys, "left_anti")
    later = (
        results.join(answers.where("n_results > 1").join(known, keys, "left_semi"), keys)
        .where(F.struct("turn", "content", "role") != F.col("first")).select(*results.columns).distinct()
    )

    def given(rows: DataFrame, status: str, call_id: Column) -> DataFrame:
        line = F.to_json(F.struct(call_id.alias("call_id"), "content", "role"))
        return rows.select(
            "conv", "call_id", F.lit(None).cast("int").alias("level"), "turn", F.lit(0).cast("int").alias("seq"),
            F.lit(status).alias("status"), F.array().cast("array<string>").alias("errors"),
            F.lit(0).cast("long").alias("n_results"), line.alias("json"),
        )

    return done.unionByName(given(alone, "unlinked", F.lit(None).cast("string"))).unionByName(
        given(later, "further", F.col("call_id"))
    )


def calls_of(turns: DataFrame) -> DataFrame:
    """Assistant turns as tool calls: what is answered, and on which call it builds.

    A turn of 400 characters or more asks for a search, its whole text being the
    query, and gives its limit as text, which the schema refuses, when the turn
    is the seventh of eight. A call builds on the one two turns before, through
    the whole conversation.
    """
    long_ = F.length("text") >= 400
    query = F.col("text").alias("query")
    answer = F.to_json(F.struct(F.length("text").alias("n_chars"), F.col("text")))
    search = F.when(
        F.col("turn") % 8 == 7, F.to_json(F.struct(query, F.lit("many").alias("limit")))
    ).otherwise(F.to_json(F.struct(query, F.lit(10).alias("limit"))))
    call_id = lambda turn: F.concat_ws(":", F.lit("call"), turn.cast("string"))
    return turns.where("role = 'assistant'").select(
        F.col("conv_id").alias("conv"), call_id(F.col("turn")).alias("call_id"), "turn",
        F.lit(0).cast("int").alias("seq"),
        F.when(long_, "search").otherwise("answer").alias("name"),
        F.when(long_, search).otherwise(answer).alias("arguments"),
        F.when(F.col("turn") >= 2, F.array(call_id(F.col("turn") - 2)))
        .otherwise(F.array().cast("array<string>")).alias("after"),
    )


def results_of(turns: DataFrame) -> DataFrame:
    """Other turns, with their role, as results of the call in the turn before."""
    return turns.where("role IS DISTINCT FROM 'assistant'").select(
        F.col("conv_id").alias("conv"),
        F.concat_ws(":", F.lit("call"), (F.col("turn") - 1).cast("string")).alias("call_id"),
        "turn", F.col("text").alias("content"), "role",
    )
