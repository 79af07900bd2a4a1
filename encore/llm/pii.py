"""Personal data: exact rules and a character-level BiLSTM-CRF.

The base spans come from fixed rules (``base_spans``). A tagger
(``bilstm_crf``), trained in NumPy, reads characters in context and adds spans
the rules do not have: spaced, masked, spelled-out data, or with other separators. Its
labelled spans are those of the rules, half of them rewritten in their places in such ways
(``SEEN``), which the rules then no longer match.

A text is cut into windows of ``WINDOW`` characters that overlap by half.
Whatever is tagged, as the rules have it or rewritten, holds a digit, an ``@``
or the word dot; a window without one, and without one in the half window next
to it, holds no part of a span and is not decoded. The tag scores of
overlapping windows are averaged, and one Viterbi pass runs over each stretch
of adjoining windows, so spans may run across windows. Stretches above ``RUN``
windows are passed in parts that share two windows, cut in their middle.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.bilstm_crf import Tagger
from encore.llm.common import id_and_bytes, slices
from encore.llm.secret_scan import SPAN_TYPE, SPANS_DDL

KINDS = ("email", "ip", "card", "phone")
WINDOW = 96
HALF = WINDOW // 2
#: Bounds of the fit: texts, their bytes together, and windows.
ROWS, MOST_BYTES, WINDOWS = 5000, 1 << 24, 2000
UNITS, EPOCHS = 16, 10
#: Windows of a stretch that one Viterbi pass covers.
RUN = 64
#: Windows decoded at a time.
AT_ONCE = 2048

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# possessive repeats and the look-behind only spare attempts that must fail
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Local parts hold no ``@``, so each ``@`` has one possible match: the
    whole run before it (not before the last match) and the longest domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0") or "0"
    return len(part) <= 3 and int(part) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)``, leftmost non-overlapping for each kind, failing matches dropped, by start, then kind."""
    out = [(s, 0, e) for s, e in _emails(text)]
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_byte, m[0].split(".")))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def _class_table() -> np.ndarray:
    """Character class of each code point below 128; one more class above, and 0 outside the text."""
    table = np.zeros(129, np.int8)
    singles = " @.-+()_%:=\"'/,\n"
    for c in range(128):
        ch = chr(c)
        if ch.isdigit():
            table[c] = 1
        elif ch.islower():
            table[c] = 2 if ch > "f" else 3
        elif ch.isupper():
            table[c] = 4
        elif ch in singles:
            table[c] = 5 + singles.index(ch)
        else:
            table[c] = 5 + len(singles)
    table[128] = 6 + len(singles)
    return table


_CLASS = _class_table()
CLASSES = int(_CLASS.max()) + 1
TAGS = 1 + 2 * len(KINDS)


def code_array(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def classes_of(codes: np.ndarray) -> np.ndarray:
    return _CLASS[np.minimum(codes, 128)]


def tag_array(length: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Begin and inside tags of labelled spans; of overlapping ones the earlier stays."""
    tags, done = np.zeros(length, np.int8), 0
    for start, kind, end in spans:
        if start >= done:
            tags[start], tags[start + 1 : end] = 1 + 2 * kind, 2 + 2 * kind
            done = end
    return tags


def triggers(codes: np.ndarray) -> np.ndarray:
    """Whether each character is a digit, an ``@`` or the d of the word dot (in either case)."""
    hot = ((codes >= 48) & (codes <= 57)) | (codes == 64)
    if len(codes) > 2:
        low = codes | 32
        at = np.flatnonzero((low[:-2] == 100) & (low[1:-1] == 111) & (low[2:] == 116))
        letter = np.concatenate([[False], (low >= 97) & (low <= 122), [False]])
        hot[at[~letter[at] & ~letter[at + 4]]] = True
    return hot


def window_starts(codes: np.ndarray) -> np.ndarray:
    """Starts of the windows to decode: every half window (block) with a
    trigger counts, with the blocks beside it; a window covers two blocks."""
    at = np.unique(np.flatnonzero(triggers(codes)) // HALF)
    if not len(at):
        return at
    near = np.unique(np.concatenate([at - 2, at - 1, at, at + 1]))
    return near[(near >= -1) & (near * HALF < len(codes))] * HALF


def cut(padded: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Windows of an array that has HALF zeros before and WINDOW behind it."""
    return padded[(starts + HALF)[:, None] + np.arange(WINDOW)]


def pad(x: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(HALF, x.dtype), x, np.zeros(WINDOW, x.dtype)])


def stretches(starts: np.ndarray) -> list[np.ndarray]:
    """The starts as runs of adjoining windows, of at most RUN + 2; of a longer
    run each part repeats the last two windows of the one before."""
    out = []
    for run in np.split(starts, np.flatnonzero(np.diff(starts) != HALF) + 1):
        out += [run[max(0, i - 2) : i + RUN] for i in range(0, len(run), RUN)]
    return [r for r in out if len(r)]


def averaged(scores: np.ndarray) -> np.ndarray:
    """Tag scores of a stretch (positions, tags) from those of its windows
    (length, windows, tags): the mean of the one or two that cover a position."""
    first, second = scores[:HALF], scores[HALF:]
    whole = np.concatenate([first, np.zeros_like(first[:, :1])], axis=1)
    whole[:, 1:] += second
    whole[:, 1:-1] /= 2
    return whole.transpose(1, 0, 2).reshape(-1, scores.shape[2])


def spans_of(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of a text's tags: runs of one kind, cut at begin tags."""
    kind = (tags + 1) // 2
    new = np.flatnonzero((kind[1:] != kind[:-1]) | ((tags[1:] % 2 == 1) & (tags[1:] > 0))) + 1
    edges = np.concatenate([[0], new, [len(tags)]])
    return [(int(a), int(kind[a]) - 1, int(b)) for a, b in zip(edges[:-1], edges[1:]) if b > a and kind[a]]


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _fours(text: str, by: str) -> str:
    d = _digits(text)
    return by.join(d[i : i + 4] for i in range(0, len(d), 4))


def _email(at: str, dot: str) -> Callable[[str], str]:
    def rewrite(text: str) -> str:
        name, host = text.split("@", 1)
        return name + at + host.replace(".", dot)

    return rewrite


def _national(text: str, by: str) -> str:
    d = _digits(text)[-10:]
    return by.join((d[:3], d[3:6], d[6:]))


Rewrites = tuple[tuple[Callable[[str], str], ...], ...]

#: Ways to write a span that the fixed rules do not match, by kind; the tagger learns from these.
SEEN: Rewrites = (
    (_email(" at ", " dot "), _email(" [at] ", " [dot] "), _email("(at)", "(dot)"), _email(" @ ", " . ")),
    (lambda t: t.replace(".", " . "), lambda t: t.replace(".", "[.]"), lambda t: t.replace(".", "-")),
    (
        lambda t: _fours(t, "."),
        lambda t: _fours(t, "/"),
        lambda t: f"{_digits(t)[:4]} **** **** {_digits(t)[-4:]}",
        lambda t: f"xxxx-xxxx-xxxx-{_digits(t)[-4:]}",
    ),
    (lambda t: "00 " + t.lstrip("+").replace("(", "").replace(")", ""), lambda t: _national(t, "."), lambda t: f"({_digits(t)[-10:-7]}) {_digits(t)[-7:-4]} {_digits(t)[-4:]}"),
)

#: Ways that are kept from the fit, to measure what the tagger makes of new ones.
UNSEEN: Rewrites = (
    (_email(" AT ", " DOT "), _email(" {at} ", " {dot} ")),
    (lambda t: t.replace(".", "(.)"), lambda t: t.replace(".", " - ")),
    (lambda t: _fours(t, "_"), lambda t: f"{_digits(t)[:4]} XXXX XXXX {_digits(t)[-4:]}"),
    (lambda t: _national(t, "/"), lambda t: f"{_digits(t)[-10:-7]} *** {_digits(t)[-4:]}"),
)


def rewritten(text: str, ways: Rewrites, rng: np.random.Generator, share: float = 0.5) -> tuple[str, list[tuple[int, int, int]], list[bool]]:
    """``text`` with about ``share`` of its base spans rewritten in their places; all
    its labelled spans ``(start, kind, end)``, and which of them were rewritten.
    A rewriting that the fixed rules still match somewhere is not used."""
    out, spans, changed, at, length = [], [], [], 0, 0
    for start, kind, end in base_spans(text):
        if start < at:
            continue
        old = text[start:end]
        way = ways[kind][rng.integers(len(ways[kind]))]
        new = way(old) if rng.random() < share else old
        if new != old and base_spans(new):
            new = old
        length += start - at
        out += [text[at:start], new]
        spans.append((length, kind, length + len(new)))
        changed.append(new != old)
        length, at = length + len(new), end
    return "".join(out) + text[at:], spans, changed


@dataclass
class PiiModel:
    tagger: Tagger


def fit(texts: list[str], epochs: int = EPOCHS, windows: int = WINDOWS, seed: int = 0) -> PiiModel:
    """Train on the labelled windows of ``texts``, as they are and rewritten: at most
    ``windows``, a quarter of them without a span."""
    rng = np.random.default_rng(seed)
    with_spans, without = [], []
    for text in texts:
        # a text with spans is told twice, rewritten in different ways
        for _ in range(2 if base_spans(text) else 1):
            told, spans, _ = rewritten(text, SEEN, rng)
            codes = code_array(told)
            starts = window_starts(codes)
            if not len(starts):
                continue
            x = cut(pad(classes_of(codes)), starts)
            y = cut(pad(tag_array(len(codes), spans)), starts)
            for a, b in zip(x, y):
                (with_spans if b.any() else without).append((a, b))
    some = [with_spans[i] for i in rng.permutation(len(with_spans))[: windows * 3 // 4]]
    some += [without[i] for i in rng.permutation(len(without))[: windows - len(some)]]
    tagger = Tagger.new(CLASSES, TAGS, UNITS)
    if some:
        tagger.train(np.stack([a for a, _ in some]), np.stack([b for _, b in some]), epochs)
    return PiiModel(tagger)


def fit_pii(docs: DataFrame, rows: int = ROWS, most_bytes: int = MOST_BYTES) -> PiiModel:
    """Train on a bounded sample: of the texts that hold a digit or ``@``, whole and of
    any length, those with the lowest hash, at most ``rows`` and ``most_bytes`` bytes together
    (a text above that by itself is passed over). Only hashes and sizes are ordered
    before the texts are fetched."""
    text = F.col("text").cast("string")
    able = docs.select(text.alias("text")).where(F.octet_length("text") <= most_bytes).where(F.col("text").rlike("[0-9@]"))
    able = able.withColumn("h", F.xxhash64("text"))
    first = able.select("h", F.octet_length("text").alias("size")).groupBy("h").agg(F.min("size").alias("size")).orderBy("h").limit(rows)
    # at most ``rows`` short rows, so one task adds up their sizes
    upto = F.sum("size").over(Window.orderBy("h").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    marks = first.withColumn("upto", upto).where(F.col("upto") <= most_bytes).select("h")
    got = able.join(F.broadcast(marks), "h", "left_semi").dropDuplicates(["h"]).orderBy("h").select("text").toArrow()
    return fit(got.column("text").to_pylist())


def _added(texts: list[str], model: PiiModel) -> list[list[tuple[int, int, int]]]:
    """Tagged spans of each text; windows of all texts are decoded together."""
    codes = [code_array(t) for t in texts]
    tags = [np.zeros(0, np.int8)] * len(texts)
    waiting: list[tuple[int, np.ndarray, int]] = []
    held = 0

    def decode() -> None:
        x = np.concatenate([cut(pad(classes_of(codes[i][max(0, r[0]) : r[-1] + WINDOW])), r - max(0, int(r[0]))) for i, r, _ in waiting])
        scores, _ = model.tagger.scores(x)
        at, parts = 0, []
        for _, r, _ in waiting:
            parts.append(averaged(scores[:, at : at + len(r)]))
            at += len(r)
        found = model.tagger.viterbi(np.concatenate(parts), np.cumsum([0, *map(len, parts)]))
        at = 0
        for (i, r, skip), p in zip(waiting, parts):
            low, high = int(r[0]) + skip, min(int(r[0]) + len(p), len(codes[i]))
            begin = max(low, 0)
            tags[i][begin:high] = found[at + begin - int(r[0]) : at + high - int(r[0])]
            at += len(p)

    for i, c in enumerate(codes):
        starts = window_starts(c)
        if not len(starts):
            continue
        tags[i] = np.zeros(len(c), np.int8)
        last = None
        for r in stretches(starts):
            # a part that shares windows with the one before takes over in the middle of what they share
            waiting.append((i, r, WINDOW // 2 + HALF // 2 if last is not None and r[0] <= last else 0))
            last = int(r[-1])
            held += len(r)
            if held >= AT_ONCE:
                decode()
                waiting, held = [], 0
    if waiting:
        decode()
    return [spans_of(t) if len(t) else [] for t in tags]


_MASKED = re.compile(r"[*xX]")
_NUMBER = re.compile(r"[0-9]+")
_AT = re.compile(r"@|(?<![A-Za-z])at(?![A-Za-z])", re.IGNORECASE)


def holds(kind: int, text: str) -> bool:
    """Whether a tagged span can be of its kind: what it shows must pass the checks
    of the fixed rules. An email names its ``@`` in some way; four parts of an
    address are at most 255; a card with all its digits passes Luhn; a phone number has enough
    digits, masked ones aside."""
    digits = _digits(text)
    if KINDS[kind] == "email":
        return bool(_AT.search(text)) and any(c.isalpha() for c in text)
    if KINDS[kind] == "ip":
        parts = _NUMBER.findall(text)
        return len(parts) == 4 and all(map(_byte, parts))
    if _MASKED.search(text):
        return len(digits) >= 4
    return 12 <= len(digits) <= 19 and luhn(digits) if KINDS[kind] == "card" else 9 <= len(digits) <= 15


def all_spans(texts: list[str], model: PiiModel) -> list[list[dict]]:
    """Base spans, and tagged ones of 6 characters or more with a trigger
    that touch no base span and pass ``holds``, by start, then kind."""
    out = []
    for text, found in zip(texts, _added(texts, model)):
        base = base_spans(text)
        taken = np.zeros(len(text) + 1, bool)
        for s, _, e in base:
            taken[s:e] = True
        more = [(s, k, e) for s, k, e in found if e - s >= 6 and not taken[s:e].any() and triggers(code_array(text[s:e])).any() and holds(k, text[s:e])]
        marked = [(s, k, e, True) for s, k, e in base] + [(s, k, e, False) for s, k, e in more]
        out.append([{"kind": KINDS[k], "start": s, "end": e, "base": b} for s, k, e, b in sorted(marked)])
    return out


def find_pii(docs: DataFrame, model: PiiModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans, base`` for every row of ``docs``: arrays of ``kind,
    start, end`` in code points (end exclusive), by start, then kind; ``base``
    holds the spans of the fixed rules, ``spans`` those and the tagger's.

    Null and empty texts have no spans; repeated rows and null ids are kept;
    other columns are ignored; an empty table gives no rows.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "body", 2 << 20):
            texts = [b.decode("utf-8", "replace") for b in part.column("body").to_pylist()]
            found = all_spans(texts, model)
            base = [[s for s in row if s["base"]] for row in found]
            yield pa.record_batch([part.column("doc_id"), pa.array(found, SPAN_TYPE), pa.array(base, SPAN_TYPE)], ["doc_id", "spans", "base"])

    return id_and_bytes(docs, id_col, text_col).mapInArrow(find, SPANS_DDL + ", base array<struct<kind:string,start:long,end:long>>")


def digest(found: DataFrame) -> DataFrame:
    """``doc_id, n_<kind>`` of the base spans, ``base_sha256``, ``spans`` as text."""

    def text(name: str):  # noqa: ANN202
        return F.concat_ws(",", F.transform(name, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])))

    def count(kind: str):  # noqa: ANN202
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))
