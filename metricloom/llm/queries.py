"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from metricloom.llm import (
    chat, collocation, decontaminate, jaccard_join, lm, merkle, mixing, packing, pii, quality,
    suffix_dedup, url_filter, warc,
)
from metricloom.llm.common import read_table
from metricloom.session import work_dir


def op1_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole mixture: every copy with its text, in shuffled order."""
    docs = read_table(spark, sf_dir, "documents")
    made = mixing.mixed(docs, carry=["doc_id", "source", "lang", "text"])
    return made.select("row.*", "copy", "rate", "place")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, deciding rule and verdict of every page's url."""
    rules = url_filter.host_rules(url_filter.HOST_RULES)
    judged = url_filter.judged(read_table(spark, sf_dir, "pages"), rules, carry=["page_id"])
    return judged.select("row.page_id", "host", "path", "rule", "verdict")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back, responses judged by the payload itself."""
    path = work_dir(spark, "warc")
    warc.archive(read_table(spark, sf_dir, "pages"), path)
    records = warc.read(spark, path).where(F.col("record_type").isin("response", "revisit"))
    return warc.intact(records).select(
        warc.page_id(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", warc.page_id(F.col("refers_to")).alias("refers_to"), "intact",
    )


def op4_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of every document repeats elsewhere, and the digest of the rest."""
    found = suffix_dedup.without_repeats(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn but an assistant's as a result, every assistant turn as a call."""
    turns = read_table(spark, sf_dir, "conversations")
    found = chat.linked(chat.calls_of(turns), chat.results_of(turns))
    return found.select(
        F.col("conv").alias("conv_id"), "turn", "call_id", "level", "status",
        F.array_join("errors", ",").alias("errors"), "n_results", "json",
    )


def op6_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    judged = quality.judged(read_table(spark, sf_dir, "documents"), ["doc_id"])
    return judged.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    found = jaccard_join.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op8_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document, learned from nine tenths of them."""
    return lm.scored(read_table(spark, sf_dir, "documents"))


def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates for personal data."""
    done = pii.pseudonymised(read_table(spark, sf_dir, "documents"), ["doc_id"])
    return done.select("row.doc_id", F.col("new_text").alias("text"), "n_replaced")


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark hits and verdict of every document."""
    judged = decontaminate.judged(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), ["doc_id"]
    )
    return judged.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of every language."""
    return collocation.collocations(read_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether it holds after tampering."""
    return merkle.audited(read_table(spark, sf_dir, "documents"))


def op13_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in its sequence, with a checksum of its ids."""
    import public_tokenizers

    pieces = packing.packed(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


QUERIES = {
    "op1_poisson_mixing": op1_poisson_mixing,
    "op2_url_filter": op2_url_filter,
    "op3_warc": op3_warc,
    "op4_repeated_strings": op4_repeated_strings,
    "op5_tool_call_linking": op5_tool_call_linking,
    "op6_distribution_divergence": op6_distribution_divergence,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_context_mixing": op8_context_mixing,
    "op9_surrogates": op9_surrogates,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_retrieval_packing": op13_retrieval_packing,
}

def _lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _js_sql() -> str:
    """``js(r, kind, distance)`` of the histograms ``ch`` and ``cm`` of ``h``."""
    return """
             hist AS (SELECT r, lang, 'c' AS kind, unnest(ch) AS v, generate_subscripts(ch, 1) AS i FROM h
                      UNION ALL
                      SELECT r, lang, 'w', unnest(cm), generate_subscripts(cm, 1) FROM h WHERE cm IS NOT NULL),
             sums AS (SELECT lang, kind, i, sum(v) AS v FROM hist JOIN c USING (lang) GROUP BY ALL),
             ref AS (SELECT lang, kind, i, v / sum(v) OVER (PARTITION BY lang, kind) AS q FROM sums),
             p AS (SELECT r, lang, kind, i, v / nullif(sum(v) OVER (PARTITION BY r, kind), 0) AS p FROM hist),
             js AS (SELECT r, kind, sqrt(greatest(0, sum(
                        CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
                        + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS distance
                    FROM p JOIN ref USING (lang, kind, i) GROUP BY r, kind)"""


_COMMON_ROWS = ", ".join(f"('{lang}', {words})" for lang, words in quality.COMMON_WORDS.items())

def _shares() -> str:
    """Target shares as branches of a CASE on the group; the rest share what is left."""
    named = " ".join(f"WHEN '{name}' THEN {share!r}::DOUBLE" for name, share in mixing.WEIGHTS.items())
    return f"CASE grp {named} ELSE {1 - sum(mixing.WEIGHTS.values())!r}::DOUBLE END"


ORACLES: dict[str, str] = {
    "op1_poisson_mixing": f"""
        WITH d AS (SELECT doc_id, source, lang, text,
                          coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, ''))) AS key,
                          CASE WHEN source IN {tuple(mixing.WEIGHTS)} THEN source ELSE '*' END AS grp,
                          greatest(strlen(coalesce(text, '')), 1) AS size FROM documents),
             q AS (SELECT grp, least({_shares()} * total * {mixing.EPOCHS}::DOUBLE / size, {mixing.MAX_RATE}::DOUBLE) AS rate
                   FROM (SELECT grp, CAST(sum(size) AS DOUBLE) AS size,
                                CAST((SELECT sum(size) FROM d) AS DOUBLE) AS total FROM d GROUP BY grp)),
             k AS (SELECT grp, i, sum(exp(i * ln(rate) - rate - lgamma(i + 1))) OVER (PARTITION BY grp ORDER BY i) AS cdf
                   FROM q, range(0, {mixing.MOST}) AS t(i)),
             c AS (SELECT grp, list(cdf) AS cdfs FROM k GROUP BY grp),
             u AS (SELECT *, (CAST('0x' || substr(md5('{mixing.SEED}|' || key), 1, 13) AS BIGINT) + 0.5::DOUBLE)
                             / 4503599627370496 AS u FROM d),
             n AS (SELECT *, len([x FOR x IN cdfs IF x < u]) AS n FROM u JOIN c USING (grp) JOIN q USING (grp)),
             m AS (SELECT *, CAST(unnest(range(1, n + 1)) AS INTEGER) AS copy FROM n)
        SELECT doc_id, source, lang, text, copy, rate,
               md5('{mixing.SEED}/order|' || key || '|' || CAST(copy AS VARCHAR)) AS place FROM m""",
    "op7_ngram_jaccard_join": rf"""
        WITH RECURSIVE
             d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id,
                          regexp_extract_all({_lower("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
             s AS MATERIALIZED (SELECT DISTINCT r, array_to_string(w[i:i + 3], ' ') AS g
                   FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
             n AS MATERIALIZED (SELECT r, count(*) AS n FROM s GROUP BY r),
             p AS (SELECT a.r AS x, b.r AS y, count(*) AS k FROM s AS a JOIN s AS b USING (g) WHERE a.r < b.r GROUP BY ALL),
             l AS MATERIALIZED (SELECT x, y FROM p JOIN n AS nx ON nx.r = x JOIN n AS ny ON ny.r = y
                   WHERE 100 * k >= 85 * (nx.n + ny.n - k)),
             e AS MATERIALIZED (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
             reach AS (SELECT r AS x, r AS y FROM d
                       UNION SELECT reach.x, e.y FROM reach JOIN e ON reach.y = e.x),
             c AS (SELECT x AS r, min(doc_id) AS component_id FROM reach JOIN d ON d.r = y GROUP BY x)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM d JOIN c USING (r) LEFT JOIN n USING (r)""",
    "op6_distribution_divergence": rf"""
        WITH c(lang, list) AS (VALUES {_COMMON_ROWS}),
             d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t,
                          regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
             k AS (SELECT *, [length(regexp_replace(t, x, '', 'g')) FOR x IN
                              ['[^a-z]+', '[^\x20\x09-\x0D]+', '[^A-Z]+', '[^0-9]+', '[^.,;:!?''"()\-]+', '[\x00-\x7F]+']] AS six
                   FROM d LEFT JOIN c USING (lang)),
             h AS (SELECT r, lang, six || [length(t) - list_sum(six)] AS ch,
                          CASE WHEN list IS NOT NULL THEN [len(list_filter(w, lambda y: y = x)) FOR x IN list]
                               || [len(list_filter(w, lambda y: NOT list_contains(list, y)))] END AS cm FROM k),
             {_js_sql()},
             g AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, e) AS n
                   FROM (SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS e
                         FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d))),
             m AS (SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(i, i + 3)) AS place FROM g WHERE n > 1) GROUP BY r),
             l AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
                   WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
             b AS (SELECT r, doc_id, length(t) AS n_chars, CAST(len(w) AS BIGINT) AS n_words,
                          CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                          CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
                          coalesce(l.n, 0) AS n_dup_lines, coalesce(m.n, 0) AS n_repeat_words,
                          len(w) < 50 OR 100 * coalesce(m.n, 0) > 50 * len(w) AS base_failed
                   FROM d LEFT JOIN m USING (r) LEFT JOIN l USING (r))
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed
               AND (n_chars < {quality.MIN_CHARS_JUDGED} OR coalesce(jc.distance <=
                    {quality.CHAR_LIMIT} + {quality.CHAR_SLACK} / sqrt(n_chars), true))
               AND (n_words < {quality.MIN_WORDS_JUDGED} OR coalesce(jw.distance <=
                    {quality.WORD_LIMIT} + {quality.WORD_SLACK} / sqrt(n_words), true)) AS kept
        FROM b LEFT JOIN (FROM js WHERE kind = 'c') AS jc USING (r) LEFT JOIN (FROM js WHERE kind = 'w') AS jw USING (r)""",
    "op10_benchmark_decontamination": rf"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                          regexp_extract_all({_lower("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
                   FROM documents),
             i AS (SELECT item_id, regexp_extract_all({_lower("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
                   FROM benchmark),
             iw AS (SELECT DISTINCT item_id, least(len(w), 13) AS k, array_to_string(w[s:s + least(len(w), 13) - 1], ' ') AS g
                    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
             dw AS (SELECT r, s, k, array_to_string(w[s:s + k - 1], ' ') AS g
                    FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, (SELECT DISTINCT k FROM iw))),
             h AS (SELECT r, s, k, item_id FROM dw JOIN iw USING (k, g)),
             n AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(s, s + k)) AS place FROM h) GROUP BY r),
             m AS (SELECT r, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
                   FROM (SELECT DISTINCT r, item_id FROM h) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
        FROM d LEFT JOIN n USING (r) LEFT JOIN m USING (r)""",
    "op11_phrase_collocations": rf"""
        WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
                          {_lower("coalesce(text, '')")} AS t FROM documents),
             p AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM d),
             g AS (SELECT lang, m, w[i:i + m - 1] AS w FROM
                     (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p, range(1, {collocation.LONGEST + 1}) AS s(m))),
             f AS MATERIALIZED (SELECT lang, m, array_to_string(w, ' ') AS phrase, any_value(w) AS w, count(*) AS f FROM g GROUP BY lang, m, phrase),
             n AS (SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang),
             c AS MATERIALIZED (SELECT * FROM f WHERE m > 1 AND f >= {collocation.LEAST}),
             k AS (SELECT lang, phrase, w, m, f AS a, unnest(range(1, m)) AS k FROM c),
             s AS (SELECT k.lang, k.phrase, k.w, k.m, a, k, x.f AS l, y.f AS r, CAST(2000000 * a::HUGEINT // (x.f + y.f) AS BIGINT) AS score
                   FROM k JOIN f AS x ON x.lang = k.lang AND x.phrase = array_to_string(k.w[:k.k], ' ')
                          JOIN f AS y ON y.lang = k.lang AND y.phrase = array_to_string(k.w[k.k + 1:], ' ')),
             b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
             o AS (SELECT lang, array_to_string(w[i:i + j - 1], ' ') AS phrase, max(f) AS f FROM
                     (SELECT lang, w, f, j, unnest(range(1, m - j + 2)) AS i FROM
                        (SELECT lang, w, f, m, unnest(range(2, m)) AS j FROM c)) GROUP BY ALL),
             z AS (SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
                   FROM b LEFT JOIN o USING (lang, phrase) WHERE NOT coalesce(100 * o.f >= 80 * a, false))
        SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM z JOIN n USING (lang) WHERE rank <= {collocation.TOP}""",
    "op12_merkle_manifest": """
        WITH RECURSIVE
             table256 AS (SELECT list(list_reduce([i] || range(8), lambda c, x: xor(c >> 1, (c & 1) * 3988292384)) ORDER BY i) AS t FROM range(256) AS r(i)),
             f AS (SELECT doc_id, n_chars, coalesce('=' || lang, '') AS grp,
                          concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                                 coalesce(strlen(lang) || ':' || lang, '-')) AS head,
                          coalesce(strlen(text) || ':' || text, '-') AS tail,
                          xor(list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
                              lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 7 = 0 AS hit
                   FROM documents, table256),
             d AS MATERIALIZED (SELECT row_number() OVER () AS r, *,
                          sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
                          sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) AS changed FROM f),
             o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d),
             v AS (SELECT 0 AS level, grp, i, leaf AS h, count(*) OVER (PARTITION BY grp) AS n FROM o
                   UNION ALL
                   SELECT level + 1, grp, i // 2, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 1) // 2
                   FROM v WHERE n > 1 GROUP BY level, grp, i // 2),
             nodes AS MATERIALIZED (SELECT * FROM v),
             s AS MATERIALIZED (SELECT grp, h AS subroot, row_number() OVER (ORDER BY encode(grp)) - 1 AS i FROM nodes WHERE n = 1),
             w AS (SELECT 0 AS level, i, subroot AS h, count(*) OVER () AS n FROM s
                   UNION ALL
                   SELECT level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 1) // 2
                   FROM w WHERE n > 1 GROUP BY level, i // 2),
             tops AS MATERIALIZED (SELECT * FROM w),
             steps AS (SELECT r, level AS step, x.i AS at, y.h, y.i < x.i AS left FROM
                         (SELECT r, grp, level, o.i >> level AS i FROM o, (SELECT DISTINCT grp AS g, level FROM nodes WHERE n > 1) WHERE g = grp) AS x
                         LEFT JOIN nodes AS y USING (grp, level) WHERE y.i = xor(x.i, 1)
                       UNION ALL
                       SELECT r, 1000 + level, x.i, y.h, y.i < x.i FROM
                         (SELECT r, level, s.i >> level AS i FROM o JOIN s USING (grp), (SELECT DISTINCT level FROM tops WHERE n > 1)) AS x
                         LEFT JOIN tops AS y USING (level) WHERE y.i = xor(x.i, 1)),
             every AS (SELECT r, level AS step FROM o JOIN (SELECT DISTINCT grp, level FROM nodes WHERE n > 1) USING (grp)
                       UNION ALL SELECT r, 1000 + level FROM o, (SELECT DISTINCT level FROM tops WHERE n > 1)),
             path AS MATERIALIZED (SELECT r, row_number() OVER (PARTITION BY r ORDER BY step) AS k, coalesce(h, '') AS h, coalesce("left", false) AS "left"
                      FROM every LEFT JOIN steps USING (r, step)),
             fold AS (SELECT r, 0 AS k, CASE WHEN hit THEN changed ELSE leaf END AS h FROM o
                      UNION ALL
                      SELECT fold.r, fold.k + 1, sha256(CASE WHEN path."left" THEN path.h || fold.h ELSE fold.h || path.h END)
                      FROM fold JOIN path ON path.r = fold.r AND path.k = fold.k + 1),
             p AS (SELECT r, string_agg(h, '' ORDER BY k) AS proof, max(k) AS last FROM path GROUP BY r)
        SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, fold.h AS folded_root, fold.h = root AS verified
        FROM o JOIN s USING (grp) CROSS JOIN (SELECT h AS root FROM tops WHERE n = 1)
             LEFT JOIN p USING (r) JOIN fold ON fold.r = o.r AND fold.k = coalesce(p.last, 0)""",
    "op2_url_filter": """
        WITH r(verdict, host, path) AS (VALUES
               ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
               ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
             u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
                   FROM pages),
             p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                          regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u)
        SELECT p.page_id, p.host, p.path,
               arg_max(r.host || r.path, strlen(r.host || r.path)) AS "rule",
               coalesce(arg_max(r.verdict, strlen(r.host || r.path)), 'allow') AS verdict
        FROM p LEFT JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
        GROUP BY ALL""",
    "op3_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
             m AS (SELECT page_id, strlen(html) AS n, sha1(html) AS digest,
                          max(page_id) OVER (PARTITION BY html) AS holder FROM p)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
               CASE WHEN n >= 1000 AND page_id <> holder THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id <> holder THEN holder END AS refers_to,
               CASE WHEN n < 1000 OR page_id = holder THEN true END AS intact
        FROM m""",
}
