"""Secret scans with one combined deterministic automaton.

The rules themselves are compiled into one minimal automaton.  A single pass
over a text's bytes, from its end, meets for every rule each start of a match
together with the longest match's end.  Of these the leftmost, non-overlapping
ones are taken, and matches that are too short are dropped (they still use up
their text).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import compile_matcher, compile_scanner
from .common import ship


@dataclass(frozen=True)
class Rule:
    """A match of ``pattern`` counts with ``min_length`` characters or, if
    ``prefix`` is given, with that many characters after the longest match of
    ``prefix``."""

    kind: str
    pattern: str
    min_length: int = 0
    prefix: str | None = None
    any_case: bool = False


# The three base rules.
_KEY = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
BASE_RULES = (
    Rule("assign", _KEY + "[A-Za-z0-9+/_.=-]+", 12, _KEY, any_case=True),
    Rule("access", "AKIA[A-Z0-9]+", 18),
    Rule("hex", "[0-9a-f]+", 16),
)

# Public token shapes.
MORE_RULES = (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", "gh[opsu]_[A-Za-z0-9]+", 34),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 17),
    Rule("google", "AIza[A-Za-z0-9_-]+", 39),
)
RULES = BASE_RULES + MORE_RULES


SETTLE = 1024  # runs of starts of a rule after which its matches are chosen


@cache
def _scanner(rules: tuple[Rule, ...]):
    """Start row of the combined automaton, and per rule with a prefix that
    prefix's automaton.  Built once per worker process."""
    combined = compile_scanner([(r.pattern, r.any_case) for r in rules])
    return combined.rows()[0], [r.prefix and compile_matcher(r.prefix, r.any_case) for r in rules]


def _chosen(met: list[list[int]]) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping matches, from the right, of all met ones:
    runs (first start, end, last start) of neighbouring starts with one end."""
    out, at = [], 0
    for first, end, last in reversed(met):
        start = max(first, at)
        if start <= last:
            out.append((start, end))
            at = end
    return out[::-1]


def matches(data: bytes, row: list, n_rules: int) -> list[list[tuple[int, int]]]:
    """Per rule its (start, end) in ``data``, leftmost longest, not overlapping:
    one pass, one lookup a byte.

    Where no match of a rule can reach on to the left, what was met of it to the
    right is independent of the rest, so long texts are settled on the way.
    """
    met: list[list[list[int]]] = [[] for _ in range(n_rules)]
    found: list[list[tuple[int, int]]] = [[] for _ in range(n_rules)]
    ends: list[int] = []
    at = len(data)
    for byte in reversed(data):
        row, keep, hits = row[byte]
        if keep is not None:
            ends = [at if k < 0 else ends[k] for k in keep]
        at -= 1
        if hits is not None:
            for rule, k in hits:
                runs = met[rule]
                if runs and runs[-1][0] == at + 1 and runs[-1][1] == ends[k]:
                    runs[-1][0] = at
                else:
                    runs.append([at, ends[k], at])
        elif not at % SETTLE:
            for rule, runs in enumerate(met):
                if len(runs) > SETTLE and rule not in row[256]:
                    found[rule] += _chosen(runs)
                    met[rule] = []
    return [(older + _chosen(runs))[::-1] for older, runs in zip(found, met)]


def spans(text: bytes | None, rules: tuple[Rule, ...] = RULES) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all findings in a UTF-8 text, in code points, by
    start and then in the order of the rules."""
    if not text:
        return []
    row, prefixes = _scanner(rules)
    met = matches(text, row, len(rules))
    found = [(start, k, end)
             for k, (rule, prefix) in enumerate(zip(rules, prefixes)) for start, end in met[k]
             if end - (prefix.longest(text, start) if prefix else start) >= rule.min_length]
    out, byte, point = [], 0, 0
    for start, k, end in sorted(found):
        point += len(text[byte:start].decode())  # matches are ASCII, so cuts are between characters
        byte = start
        out.append((point, point + end - start, rules[k].kind))
    return out


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans): every row with its findings, spans an array of
    (start, end, kind) in code points, end exclusive.

    Null and empty texts have none; equal rows give equal rows; an empty
    table gives an empty result; other columns are not read.
    """
    schema = "doc_id long, spans array<struct<start:int,end:int,kind:string>>"
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[dict(start=s, end=e, kind=k) for s, e, k in spans(t, rules)]
                     for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, type=kind)],
                                             ["doc_id", "spans"])

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def redacted_text(text: str | None, rules: tuple[Rule, ...] = RULES) -> str | None:
    """The text with every finding replaced by ``[kind]``; findings that
    overlap are replaced together, named after the first."""
    if not text:
        return text
    out, at = [], 0
    for start, end, kind in spans(text.encode(), rules):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the findings in ``text`` replaced, all rows and columns
    kept; ``n_chars``, where present and not null, follows a changed text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            old = batch.column(names.index("text")).to_pylist()
            new = [redacted_text(t, rules) for t in old]
            columns = list(batch.columns)
            columns[names.index("text")] = pa.array(new, type=batch.schema.field("text").type)
            if "n_chars" in names:
                i = names.index("n_chars")
                chars = [c if a == b or c is None else len(b)
                         for a, b, c in zip(old, new, columns[i].to_pylist())]
                columns[i] = pa.array(chars, type=batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    ship(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
