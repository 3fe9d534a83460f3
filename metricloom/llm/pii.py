"""Personal data: detection and keyed, type-consistent surrogates.

An entity is a (kind, canonical value) pair. Its surrogate depends on the key,
the kind and the canonical value alone, so all mentions in all texts get the
same one (coreference), and it keeps the mention's format: punctuation, length,
letter case, hexadecimal digits, country code, check digit, script and gender.

For everything made of digits and letters the surrogate is a keyed permutation
of the values of the same shape, so two entities of a shape never meet. Names
are spelled from syllables by a keyed hash. A collision check over the distinct
entities of the corpus, a Spark job, finds surrogates that two entities share,
that are some entity of the corpus, or that equal their own original; the later
entity draws again until all are distinct. The few redrawn ones are sent along
when counted to be few, and joined by shuffle otherwise.
"""

from __future__ import annotations

import ipaddress
import re
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from metricloom.llm.common import stored

KEY = b"surrogates-1"
SENT_ALONG = 100_000
MAX_DRAWS = 16
ENTITIES = "array<struct<kind:string,value:string>>"

_FEMALE = r"Mrs|Ms|Miss|Madam|Frau|Mme|Madame|Mlle|Señora|Señorita|Sra|Srta|Doña|Госпожа"
_MALE = r"Mr|Sir|Herr|Monsieur|Señor|Sr|Don|Господин"
_NAME = r"[^\W\d_a-zà-öø-ÿа-я][\w'’-]+"
PATTERNS = {
    "email": r"(?<![\w.+-])\w[\w.+%-]*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24}",
    "aws_key": r"\b(?:AKIA|ASIA)[A-Z0-9]{12,20}\b",
    "secret": r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key)\b\s*[=:]\s*[\"']?)(?P<secret_value>[^\s\"',;]{6,})",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    # Any run with two colons or more and a digit, with an IPv4 tail or none; ``ipaddress`` decides.
    "ipv6": r"(?<![\w:.])(?=[0-9A-Fa-f]{0,4}:[0-9A-Fa-f]{0,4}:)(?=:*[0-9A-Fa-f])[0-9A-Fa-f:]{2,39}(?:(?<=:)[0-9]{1,3}(?:\.[0-9]{1,3}){3}|(?<=::)|(?<=[0-9A-Fa-f]))(?!\w|:[\w:]|\.\d)",
    "ipv4": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w)",
    "name": rf"\b(?:(?P<female>{_FEMALE})|(?P<male>{_MALE}))\.? (?P<given>{_NAME})(?: (?P<family>{_NAME}))?",
}
DETECTOR = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, pattern in PATTERNS.items()))
_TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: A text without any of these holds no entity.
TRIGGER = re.compile(
    rf"[0-9@]|::|:[A-Fa-f]{{1,4}}:|\b(?:{_FEMALE}|{_MALE})\b|(?i:password|passwd|pwd|secret|token|api[_-]?key)"
)


def luhn(digits: str) -> int:
    """The check digit that completes ``digits``."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return -total % 10


def iban_check(country: str, rest: str) -> str:
    number = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _is_address(value: str) -> bool:
    try:
        ipaddress.IPv6Address(value)
    except ValueError:
        return False
    return True


def _matches(text: str):
    """What the detector finds; a run of groups that is no address may hold something else."""
    at = 0
    while m := DETECTOR.search(text, at):
        if m["ipv6"] is None or _is_address(m["ipv6"]):
            yield m
            at = m.end()
        else:
            at = m.start() + 1


def mentions(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical value) of the entities of a text, in order."""
    if not text or not TRIGGER.search(text):
        return []
    found, names = [], {}
    for m in _matches(text):
        kind, start, end = m.lastgroup, m.start(), m.end()
        kind = next(k for k in PATTERNS if m[k] is not None)
        if kind == "name":
            gender = "f" if m["female"] else "m"
            for part in ("given", "family") if m["family"] else ("family",):
                group = part if m["family"] else "given"
                # Family names have a gender in Cyrillic script only.
                own = gender if part == "given" or _is_cyrillic(m[group]) else "x"
                names[m[group]] = f"name:{part}:{own}"
                found.append((m.start(group), m.end(group), names[m[group]], m[group].casefold()))
            continue
        if kind == "secret":
            start, end = m.span("secret_value")
        value = text[start:end]
        if kind == "secret" and not any(map(str.isalnum, value)):
            continue  # masked or blank
        if kind in ("ipv4", "ssn", "card", "phone") and not value.isascii():
            value = re.sub(r"\d", lambda d: str(int(d[0])), value)
        if kind == "card":
            value = re.sub(r"\D", "", value)
            if luhn(value[:-1]) != int(value[-1]):
                continue
        elif kind == "iban":
            value = value.replace(" ", "")
            if iban_check(value[:2], value[4:]) != value[2:4]:
                continue
        elif kind == "email":
            value = value.translate(_TO_LOWER)  # no other letters, whose lower case may be longer
        elif kind == "phone":
            value = re.sub(r"[^\d+]", "", value)
        elif kind == "ipv6":
            value = str(ipaddress.IPv6Address(value))
        found.append((start, end, kind, value))
    if names:
        taken = [(s, e) for s, e, *_ in found]
        again = re.compile(r"\b(?:" + "|".join(map(re.escape, sorted(names, key=len, reverse=True))) + r")\b")
        for m in again.finditer(text):
            if not any(s < m.end() and m.start() < e for s, e in taken):
                found.append((m.start(), m.end(), names[m[0]], m[0].casefold()))
        found.sort()
    return found


def _number(key: bytes, *parts: str | int) -> int:
    data = "\x1f".join(map(str, parts)).encode()
    return int.from_bytes(blake2b(data, key=key[:64], digest_size=16).digest(), "big")


def permuted(key: bytes, label: str, symbols: list[int], radices: list[int]) -> list[int]:
    """A keyed bijection on sequences of digits with the given radices.

    A Feistel network: each half is shifted by amounts that depend on the other.
    """
    cut = (len(symbols) + 1) // 2
    halves = [list(symbols[:cut]), list(symbols[cut:])]
    sizes = [radices[:cut], radices[cut:]]
    for turn in range(8):
        mine, other = turn % 2, 1 - turn % 2
        seed = ",".join(map(str, halves[other]))
        shift = 0
        for i, r in enumerate(sizes[mine]):
            if i % 8 == 0:
                shift = _number(key, label, "round", turn, len(symbols), i, seed)
            halves[mine][i] = (halves[mine][i] + shift % 65521) % r
            shift //= 65521
    return halves[0] + halves[1]


_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def same_shape(key: bytes, label: str, value: str, first: int = 0, alphabets=(_DIGITS, _LOWER, _UPPER)) -> str:
    """``value`` with its digits and letters, from ``first`` on, permuted within their class."""
    places = [
        (i, a, a.index(c)) for i, c in enumerate(value) if i >= first
        for a in alphabets if c in a
    ]
    out = list(value)
    new = permuted(key, label, [p for _, _, p in places], [len(a) for _, a, _ in places])
    for (i, a, _), n in zip(places, new, strict=True):
        out[i] = a[n]
    return "".join(out)


_LATIN = ["ba", "be", "bi", "bo", "da", "de", "do", "fa", "fe", "ga", "go", "ka", "ke", "la", "le", "li",
          "lo", "ma", "me", "mi", "na", "ne", "no", "pa", "pe", "ra", "re", "ri", "ro", "sa", "se", "ta"]
_CYRILLIC = ["ба", "бе", "во", "га", "да", "де", "за", "зо", "ка", "ко", "ла", "ле", "ли", "ма", "ми", "мо",
             "на", "не", "но", "па", "по", "ра", "ре", "ро", "са", "се", "со", "та", "те", "то", "ва", "ви"]


def _is_cyrillic(name: str) -> bool:
    return any("\u0400" <= c <= "\u04ff" for c in name)


def spelled(key: bytes, kind: str, value: str, draw: int) -> str:
    """A name of the same part, gender and script, in lower case."""
    _, part, gender = kind.split(":")
    cyrillic = _is_cyrillic(value)
    syllables = _CYRILLIC if cyrillic else _LATIN
    n = _number(key, kind if part == "given" else "name:family", value, draw)
    count = 4 if part == "given" else 6
    stem = "".join(syllables[n >> (5 * i) & 31] for i in range(count))
    if part == "given":
        return stem + {"f": "я" if cyrillic else "a", "m": "н" if cyrillic else "n"}[gender]
    return stem + ({"f": "ва", "m": "в"}[gender] if cyrillic else "s")


def surrogate(key: bytes, kind: str, value: str, draw: int = 0) -> str:
    """The replacement of a canonical value, itself canonical."""
    label = f"{kind}/{draw}"
    if kind.startswith("name:"):
        return spelled(key, kind, value, draw)
    if kind == "card":
        body = same_shape(key, label, value[:-1], 1)
        return body + str(luhn(body))
    if kind == "iban":
        body = same_shape(key, label, value[4:])
        return value[:2] + iban_check(value[:2], body) + body
    if kind == "ipv4":
        octets = [int(x) for x in value.split(".")]
        return ".".join(map(str, permuted(key, label, octets, [256] * 4)))
    if kind == "ipv6":
        number = int(ipaddress.IPv6Address(value))
        nibbles = [number >> 4 * i & 15 for i in range(32)]
        return str(ipaddress.IPv6Address(sum(n << 4 * i for i, n in enumerate(permuted(key, label, nibbles, [16] * 32)))))
    if kind == "email":
        name, _, domain = value.partition("@")
        head, dot, top = domain.rpartition(".")
        return same_shape(key, label, f"{name}@{head}") + dot + top
    if kind == "phone":
        # The country code (one digit for +1 and +7, else two) stays.
        first = 0 if value[0] != "+" else 2 if value[1] in "17" else 3
        return same_shape(key, label, value, first)
    if kind == "aws_key":
        return value[:4] + same_shape(key, label, value[4:], 0, (_DIGITS + _UPPER,))
    if kind == "secret" and not re.search(r"[A-Za-z0-9]", value):
        return "".join(_LOWER[_number(key, label, value, i) % 26] if c.isalnum() else c for i, c in enumerate(value))
    if kind == "secret" and re.fullmatch(r"[0-9a-f]+", value):
        return same_shape(key, label, value, 0, (_DIGITS + "abcdef",))
    return same_shape(key, label, value)


def rendered(mention: str, kind: str, new: str) -> str:
    """The canonical ``new`` in the format of the mention it replaces."""
    if kind in ("phone", "card", "iban"):
        rest = iter(new.replace("+", "") if kind == "phone" else new)
        out = [next(rest) if c.isalnum() else c for c in mention]
        return "".join(out)
    if kind == "email":
        return "".join(n.upper() if c.isupper() else n for c, n in zip(mention, new, strict=True))
    if kind == "ipv6":
        return new.upper() if mention.isupper() else new
    if kind.startswith("name:"):
        return new.upper() if mention.isupper() and len(mention) > 1 else new.capitalize()
    return new


def rewritten(text: str, key: bytes, draws: dict[tuple[str, str], int], draw=None) -> tuple[str, int]:
    """The text with surrogates, and the number of mentions replaced."""
    found = mentions(text)
    if not found:
        return text, 0
    draw = draw or surrogate
    out, at = [], 0
    for start, end, kind, value in found:
        new = draw(key, kind, value, draws.get((kind, value), 0))
        out += [text[at:start], rendered(text[start:end], kind, new)]
        at = end
    return "".join(out) + text[at:], len(found)


def _detected(batches):
    """Distinct entities of each batch of texts."""
    for batch in batches:
        found = {(k, v) for text in batch.column(0).to_pylist() for *_, k, v in mentions(text)}
        kinds, values = zip(*sorted(found), strict=True) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(values, pa.string())], ["kind", "value"])


def _drawn(key: bytes):
    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            new = [surrogate(key, r["kind"], r["value"], r["draw"]) for r in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], [*batch.schema.names, "new"])

    return run


def _family(kind: str) -> Column:
    """Kinds whose values look alike: names of any part and gender are one."""
    return F.when(F.col(kind).startswith("name:"), F.lit("name")).otherwise(F.col(kind))


def assigned(texts: DataFrame, key: bytes = KEY) -> DataFrame:
    """kind, value, draw, new: a distinct surrogate for every entity of a corpus."""
    entities = texts.mapInArrow(_detected, "kind string, value string").distinct()
    state = stored(entities.select("kind", "value", F.lit(0).alias("draw")), "entities")
    for _ in range(MAX_DRAWS):
        state = stored(
            state.select("kind", "value", "draw").mapInArrow(
                _drawn(key), "kind string, value string, draw int, new string"
            ),
            "surrogates",
        )
        # In each group of equal surrogates the smallest (draw, kind, value) keeps it.
        first = state.groupBy(_family("kind").alias("family"), "new").agg(
            F.min(F.struct("draw", "kind", "value")).alias("first")
        )
        real = state.select(_family("kind").alias("family"), F.col("value").alias("new"), F.lit(True).alias("real")).distinct()
        marked = (
            state.withColumn("family", _family("kind"))
            .join(first, ["family", "new"]).join(real, ["family", "new"], "left")
        )
        again = F.coalesce("real", F.lit(False)) | (
            F.struct("draw", "kind", "value") != F.col("first")
        )
        judged = stored(marked.select("kind", "value", "draw", "new", again.alias("again")), "checked")
        if judged.where("again").isEmpty():
            return judged.drop("again")
        state = judged.select("kind", "value", (F.col("draw") + F.col("again").cast("int")).alias("draw"))
    raise ValueError(f"surrogates still collide after {MAX_DRAWS} draws")


def _replacing(key: bytes, few: dict[tuple[str, str], int]):
    def run(batches):
        draw = lru_cache(maxsize=100_000)(surrogate)
        for batch in batches:
            at = batch.schema.get_field_index("__text")
            more = batch.column("__draws").to_pylist() if "__draws" in batch.schema.names else None
            new, counts = [], []
            for i, text in enumerate(batch.column(at).to_pylist()):
                draws = few if not more else {(d["kind"], d["value"]): d["draw"] for d in more[i] or ()}
                out, n = rewritten(text, key, draws, draw)
                new.append(out)
                counts.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(new, pa.string()), pa.array(counts, pa.int64())],
                ["row", "new_text", "n_replaced"],
            )

    return run


def _listed(batches):
    """``row``, text and the distinct entities of each text."""
    for batch in batches:
        found = [
            [{"kind": k, "value": v} for k, v in sorted({(k, v) for *_, k, v in mentions(text)})]
            for text in batch.column("__text").to_pylist()
        ]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("value", pa.string())]))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], [*batch.schema.names, "__found"])


def _with_draws(rows: DataFrame, redrawn: DataFrame) -> DataFrame:
    """Adds ``__draws``: the redrawn entities each text holds, by shuffled joins."""
    keyed = rows.withColumn("__key", F.md5(F.coalesce("__text", F.lit("")).cast("binary")))
    listed = keyed.select("__key", "__text").mapInArrow(_listed, f"__key string, __text string, __found {ENTITIES}")
    of_text = (
        listed.select("__key", F.explode("__found").alias("e")).select("__key", "e.kind", "e.value").distinct()
        .join(redrawn, ["kind", "value"])
        .groupBy("__key").agg(F.collect_list(F.struct("kind", "value", "draw")).alias("__draws"))
    )
    return keyed.join(of_text, "__key", "left").drop("__key")


def pseudonymised(
    docs: DataFrame, carry: list[str] | None = None, text_col: str = "text", key: bytes = KEY
) -> DataFrame:
    """row, new_text, n_replaced of every row of ``docs``.

    ``row`` holds the columns ``carry`` (all by default) as they were. A null
    text stays null and an empty one empty; a text without entities is not
    changed. Equal texts, and repeated rows, are rewritten alike. An empty
    table gives no row.
    """
    if not key:
        raise ValueError("a key is needed")
    columns = docs.columns if carry is None else carry
    text = F.col(text_col).cast("string")
    redrawn = stored(
        assigned(docs.select(text.alias("text")), key).where("draw > 0").select("kind", "value", "draw"), "redrawn"
    )
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), text.alias("__text"))
    few: dict[tuple[str, str], int] = {}
    if redrawn.count() <= SENT_ALONG:
        few = {(r["kind"], r["value"]): r["draw"] for r in redrawn.collect()}
    else:
        rows = _with_draws(rows, redrawn)
    row = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(_replacing(key, few), f"row {row}, new_text string, n_replaced long")
