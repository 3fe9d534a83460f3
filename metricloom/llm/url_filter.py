"""URL filters: all glob rules at once, by a bit-parallel wildcard automaton.

A rule is a glob over the canonical URL ``host + path``: ``?`` is any one
byte, ``*`` any run without ``/``, ``**`` any run. The tokens of all globs are
laid out one bit each over as many 64-bit words as needed, and every URL of a
batch advances through all of them with one Shift-And step per byte:
``state = ((state << 1) & mask[byte]) | (state & loops[byte])``, where loops
are the states a wildcard may stay in. Of the rules that accept, the one
declared most specific wins. Only the url column is read and no row is moved.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from metricloom.llm.hashing import U, text_bytes

ALLOW, BLOCK = "allow", "block"
ROWS = 8192  # URLs advanced together


@dataclass(frozen=True)
class Rule:
    """A glob and what it decides; ``label`` names it in results."""

    glob: str
    verdict: str
    label: str
    weight: int  # the accepting rule of the greatest weight wins, the first of equals


def host_rules(rows: list[tuple[str, str, str]]) -> list[Rule]:
    """Globs for (verdict, host, path prefix): the host itself and all subdomains."""
    out = []
    for verdict, host, path in rows:
        label = f"{host}{path}"
        weight = len(label.encode())
        if any(c in "*?" for c in label):
            raise ValueError(f"a host rule holds no wildcard: {label!r}")
        out.append(Rule(f"{host}{path}**", verdict, label, weight))
        out.append(Rule(f"*.{host}{path}**", verdict, label, weight))
    return out


#: The rules of the registered query.
HOST_RULES = [
    (ALLOW, "com", "/"),
    (BLOCK, "example.com", "/en/"),
    (ALLOW, "www.example.com", "/en/"),
    (BLOCK, "net", "/es/"),
    (BLOCK, "net", "/fr/"),
]


class Automaton:
    """Masks of a list of rules, heaviest first."""

    def __init__(self, rules: list[Rule]) -> None:
        self.rules = sorted(rules, key=lambda r: -r.weight)
        bits = sum(1 + len(self._tokens(r.glob)) for r in self.rules)
        self.words = max(1, -(-bits // 64))
        self.step = np.zeros((256, self.words), np.uint64)
        self.loop = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        self.accepts: list[tuple[int, np.uint64]] = []
        at = 0
        for rule in self.rules:
            # A rule has a bit for "nothing read yet" and one for each token that reads a byte.
            self._set(self.start, at)
            for token, stays in self._tokens(rule.glob):
                if stays:
                    for byte in range(256):
                        if stays == 2 or byte != ord("/"):
                            self._set(self.loop[byte], at)
                if token is None:
                    continue
                at += 1
                for byte in range(256) if token == -1 else (token,):
                    self._set(self.step[byte], at)
            self.accepts.append((at // 64, U(1) << U(at % 64)))
            at += 1

    @staticmethod
    def _set(words: np.ndarray, bit: int) -> None:
        words[bit // 64] |= U(1) << U(bit % 64)

    @staticmethod
    def _tokens(glob: str) -> list[tuple[int | None, int]]:
        """(byte or -1 for any or None at the end, wildcard before it: 0, 1 or 2)."""
        out, stays, data = [], 0, glob.encode()
        for byte in data:
            if byte == ord("*"):
                stays = min(2, stays + 1)
            else:
                out.append((-1 if byte == ord("?") else byte, stays))
                stays = 0
        out.append((None, stays))
        return out

    def match(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Index of the winning rule of each string, or -1."""
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")
        begin, size = offsets[:-1][order], lengths[order]
        state = np.repeat(self.start[None, :], len(order), 0)
        for i in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size, -i, "left"))  # strings longer than i
            byte = data[begin[:live] + i]
            now = state[:live]
            moved = now << U(1)
            moved[:, 1:] |= now[:, :-1] >> U(63)
            state[:live] = (moved & self.step[byte]) | (now & self.loop[byte])
        won = np.full(len(order), -1)
        for k in reversed(range(len(self.rules))):
            word, bit = self.accepts[k]
            won[(state[:, word] & bit) != 0] = k
        out = np.empty_like(won)
        out[order] = won
        return out


def canonical(rows: DataFrame) -> DataFrame:
    """Adds ``host`` (A-Z in lower case) and ``path``; both empty without ``://``."""
    rest = F.regexp_extract("url", r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rows.withColumns({
        "host": F.coalesce(F.translate(host, upper, lower), F.lit("")),
        "path": F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit("")),
    })


def _decided(automaton: Automaton, default: str):
    labels = [r.label for r in automaton.rules] + [None]
    verdicts = [r.verdict for r in automaton.rules] + [default]

    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column("target"))
            won = [
                automaton.match(data, offsets[i : i + ROWS + 1])
                for i in range(0, len(offsets) - 1, ROWS)
            ]
            won = np.concatenate(won).tolist() if won else []
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("row", "host", "path")],
                    pa.array([labels[k] for k in won], pa.string()),
                    pa.array([verdicts[k] for k in won], pa.string()),
                ],
                ["row", "host", "path", "rule", "verdict"],
            )

    return run


def judged(
    pages: DataFrame, rules: list[Rule], default: str = ALLOW, carry: list[str] | None = None,
    url_col: str = "url",
) -> DataFrame:
    """row, host, path, rule, verdict of every page.

    ``row`` holds the columns ``carry`` (all by default), whatever their names.
    A null url, or one without ``://``, has empty host and path and no rule
    but one whose glob accepts the empty string. A url that no rule accepts
    gets ``default``. Long urls are read to their end. Repeated rows are
    judged alike; an empty table gives no row.
    """
    columns = pages.columns if carry is None else carry
    rows = canonical(pages.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(url_col).cast("string").alias("url")
    )).select("row", "host", "path", F.concat("host", "path").alias("target"))
    row = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(
        _decided(Automaton(rules), default),
        f"row {row}, host string, path string, rule string, verdict string",
    )
