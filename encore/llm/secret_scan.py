"""Secret scans with one combined automaton.

All rules are compiled into a single minimal automaton (``automaton``), which
reads every byte of a text once and reports, for every rule, where its
matches end. From each end the rule's reversed automaton walks back to the
leftmost start after the rule's previous match, which gives leftmost
non-overlapping spans. Checks on the matched text (least lengths) follow and
can only drop a span.

A pass costs one table step a byte whatever the number of rules, and texts
are scanned row by row in Arrow batches: no shuffle, no state between rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.automaton import Automaton, compile_rules, parse, reverse
from encore.llm.common import id_and_bytes


@dataclass(frozen=True)
class Rule:
    """``least``: shortest match kept. ``value_least``: shortest value kept, the
    value being what follows the first ``:`` or ``=``, spaces and one quote."""

    kind: str
    pattern: str
    nocase: bool = False
    least: int = 0
    value_least: int = 0


#: The base rules, in the order their spans are listed.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", nocase=True, value_least=12),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    # a run of 16 or more, so that the automaton reports no shorter run
    Rule("hex", r"[0-9a-f]{16,}", least=16),
)

#: Spans added to the base ones.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", r"gh[opsu]_[A-Za-z0-9]+", least=24),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", least=20),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)

RULES = BASE_RULES + MORE_RULES


def _linked(a: Automaton) -> list:
    """The automaton as rows that hold the next rows, and the accept mask last."""
    rows: list[list] = [[] for _ in a.accept]
    for row, after, mask in zip(rows, a.table.tolist(), a.accept.tolist()):
        row.extend(rows[s] for s in after)
        row.append(mask)
    return rows


@lru_cache(maxsize=4)
def compiled(rules: tuple[Rule, ...]) -> tuple[Automaton, list[Automaton]]:
    """The combined automaton, and the reversed one of each rule. Made once on
    the driver and shipped as arrays: their size depends on the rules alone."""
    trees = [parse(r.pattern, r.nocase) for r in rules]
    return compile_rules(trees), [compile_rules([reverse(t)], anchored=True) for t in trees]


class Scanner:
    """Finds the spans of ``rules`` in bytes."""

    def __init__(self, rules: tuple[Rule, ...], automata: tuple[Automaton, list[Automaton]] | None = None) -> None:
        self.rules = rules
        forward, backward = automata or compiled(rules)
        self.classes, self.start = forward.classes, _linked(forward)[0]
        self.back = []
        for a in backward:
            rows = _linked(a)
            self.back.append((a.classes, rows[0], rows[a.dead] if a.dead >= 0 else None))

    def ends(self, body: bytes) -> list[tuple[int, int]]:
        """``(end, mask)``: at ``end`` the rules of ``mask`` cease to match."""
        row, last, found = self.start, 0, []
        for i, c in enumerate(body.translate(self.classes)):
            row = row[c]
            if row[-1] != last:
                if last & ~row[-1]:
                    found.append((i, last & ~row[-1]))
                last = row[-1]
        if last:
            found.append((len(body), last))
        return found

    def spans(self, body: bytes) -> list[tuple[str, int, int]]:
        """``(kind, start, end)`` in bytes, by start, then by rule."""
        out, done = [], [0] * len(self.rules)
        for end, mask in self.ends(body):
            for r, rule in enumerate(self.rules):
                if mask >> r & 1:
                    start = self._first(body, r, done[r], end)
                    if start is None:
                        continue
                    done[r] = end
                    if end - start >= rule.least and _value_length(rule, body[start:end]) >= rule.value_least:
                        out.append((start, r, end))
        return [(self.rules[r].kind, s, e) for s, r, e in sorted(out)]

    def _first(self, body: bytes, r: int, floor: int, end: int) -> int | None:
        """The leftmost start from ``floor`` on of a match of rule ``r`` that ends at ``end``."""
        classes, row, dead = self.back[r]
        best, step = None, 4096
        for high in range(end, floor, -step):
            low = max(floor, high - step)
            at = high
            for c in reversed(body[low:high].translate(classes)):
                row, at = row[c], at - 1
                if row is dead:
                    return best
                if row[-1]:
                    best = at
        return best


def _value_length(rule: Rule, match: bytes) -> int:
    if not rule.value_least:
        return 0
    at = min(i for i in (match.find(b":"), match.find(b"=")) if i >= 0)
    value = match[at + 1 :].lstrip(b" ")
    return len(value[1:] if value[:1] in (b'"', b"'") else value)


def code_points(body: bytes, at: list[int]) -> list[int]:
    """Byte offsets (at character borders) as code point offsets."""
    if body.isascii():
        return at
    before = np.concatenate([[0], np.cumsum((np.frombuffer(body, np.uint8) & 0xC0) != 0x80)])
    return before[at].tolist()


SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan_batches(find: Callable[[bytes], list[tuple[str, int, int]]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for value in batch.column("body"):
            body = value.as_py()
            spans = find(body)
            if spans:
                at = code_points(body, [p for _, s, e in spans for p in (s, e)])
                spans = [{"kind": k, "start": at[2 * i], "end": at[2 * i + 1]} for i, (k, _, _) in enumerate(spans)]
            rows.append(spans)
        yield pa.record_batch([batch.column("doc_id"), pa.array(rows, SPAN_TYPE)], ["doc_id", "spans"])


SPANS_DDL = "doc_id long, spans array<struct<kind:string,start:long,end:long>>"


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` for every row of ``docs``: ``spans`` is an array of
    ``kind, start, end`` in code points (end exclusive), by start, then in
    the order of ``rules``.

    Null and empty texts have no spans; repeated rows and null ids are kept
    as they are; other columns are ignored; an empty table gives no rows.
    """

    automata = compiled(rules)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from scan_batches(Scanner(rules, automata).spans, batches)

    return id_and_bytes(docs, id_col, text_col).mapInArrow(scan, SPANS_DDL)


def digest(spans: DataFrame, base: list[str]) -> DataFrame:
    """``doc_id, n_<kind>`` for the base kinds, ``base_sha256``, ``spans`` as text."""

    def text(s: Column) -> Column:
        return F.concat_ws(",", F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])))

    def having(kinds: list[str]) -> Column:
        return F.filter("spans", lambda x: x["kind"].isin(kinds))

    counts = [F.size(having([k])).cast("long").alias(f"n_{k}") for k in base]
    return spans.select("doc_id", *counts, F.sha2(text(having(base)), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
