"""Removing long repeated byte strings by a distributed suffix merge sort.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts
anywhere else in the corpus. Sorting every suffix would shuffle many times
the corpus, so the suffix array is sparse: of each window of LENGTH bytes,
the leftmost position with the smallest hash of its next ``GRAM`` bytes (an
anchor) stands for the window. Equal windows have their anchors at the same
place, so nothing is lost, and there is about one anchor in 150 bytes.

1. Anchors whose gram occurs once in the corpus cannot be in a repeat. Grams
   are counted (pre-aggregated), and a bit array of the repeated ones, of
   bounded size, screens anchors in the second scan; a false pass costs
   shuffle, not correctness.
2. Repeats within a piece of text are settled there, and one of each distinct
   window goes on. Each task sorts its passing anchors' suffixes (led by the hash of their
   gram, so that ranges of it split the work evenly), front-codes the run and
   sends it to the range's task.
3. There an LCP-aware loser tree (``loser_tree``) merges the runs. The lengths
   shared by neighbours say which windows agree to the right of their
   anchors; agreement to the left is compared by hashes of the bytes before
   them. Windows that agree with another one are repeated.
4. Repeated windows of a document are joined into spans and cut out.

A gram with more than ``HOT`` anchors (a passage in very many documents) would
land in one task: its windows are counted by their hash instead, which is
pre-aggregated and has no hot key. Hashes of windows are 2 x 64 bits.

A passage of PASSAGE words that another row holds too may be shorter than
LENGTH bytes. Its bytes stay; ``repeated_passages`` counts its words, by the
same anchors over words and by the hashes of their windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.common import bytes_of, joined, slices, stored
from encore.llm.loser_tree import merge, shared
from encore.llm.screen import bit_screen, passes, screened
from encore.llm.words import EXACT, spread, words

LENGTH, GRAM = 400, 100
#: Words of a passage ("over 50 words").
PASSAGE = 51
#: Anchors of one gram that one task handles.
HOT = 20_000
#: Bytes of text worked on at a time, and suffixes that one range should hold.
PIECE, RANGE = 2 << 20, 30_000
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse modulo 2 ** 64, kept for the worker."""
    if base not in _tables or len(_tables[base][0]) < n:
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            a = np.full(n, b, np.uint64)
            a[0] = 1
            both.append(np.multiply.accumulate(a))
        _tables[base] = (both[0], both[1])
    return _tables[base]


def string_hashes(data: np.ndarray, length: int, base: int = _BASES[0]) -> np.ndarray:
    """Hash of the ``length`` bytes from each position on."""
    n = len(data)
    if n < length:
        return np.zeros(0, np.uint64)
    up, down = _powers(base, max(n + 1, PIECE + 2 * LENGTH))
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    return spread((total[length:] - total[: n + 1 - length]) * down[: n + 1 - length])


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x)
    size = -(-n // width) * width
    padded = np.full(size, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """``at, low, high, hash``: anchors of all windows inside the rows, the first
    and last window start that each stands for, and the hash of its gram."""
    none = np.zeros(0, np.int64)
    h = string_hashes(data, gram)
    width = length - gram + 1
    if len(h) < width:
        return none, none, none, np.zeros(0, np.uint64)
    place = np.arange(len(h), dtype=np.uint64)
    best = _sliding_min((h & np.uint64(0xFFFFFFFF00000000)) | place, width)
    at = (best & np.uint64(0xFFFFFFFF)).astype(np.int64)
    valid = np.zeros(len(at) + 1, np.int64)
    room = offsets[1:] - offsets[:-1] >= length
    np.add.at(valid, offsets[:-1][room], 1)
    np.add.at(valid, offsets[1:][room] - length + 1, -1)
    p = np.flatnonzero(np.cumsum(valid[:-1]))
    if not len(p):
        return none, none, none, np.zeros(0, np.uint64)
    new = np.concatenate([[True], (at[p][1:] != at[p][:-1]) | (p[1:] != p[:-1] + 1)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(p)) - 1
    a = at[p[first]]
    # anchors have small hashes by choice: mixed anew, their grams spread over all values
    return a, p[first], p[last], spread(h[a] + np.uint64(1))


def _pieces(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, int]]:
    """``rows, bytes, offsets, shift``: slices of rows, and of a row longer than
    PIECE stretches that overlap by one window less a byte; ``shift`` is where
    in its row a stretch begins."""
    for part in slices(batches, "body", PIECE):
        data, offsets = joined(part.column("body"))
        if part.num_rows > 1 or len(data) <= PIECE:
            yield part, data, offsets, 0
            continue
        for s in range(0, len(data) - length + 1, PIECE):
            view = data[s : s + PIECE + length - 1]
            yield part, view, np.array([0, len(view)]), s


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges low..high, and the range of each."""
    size = high - low + 1
    of = np.repeat(np.arange(len(low)), size)
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + low[of], of


def fresh_anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[tuple, tuple, tuple]:
    """Anchors cut down to windows that do not repeat an earlier one of the
    same piece of text; stretches ``low, high`` of windows that have a twin in
    the piece; and the grams of all anchors with their counts.

    Copies and periodic stretches within a piece (a word said fifty times has
    an anchor every few bytes) are thus settled where they are, and one of
    each distinct window goes on to be compared with the rest of the corpus.
    """
    a, low, high, h = anchors(data, offsets, length, gram)
    none = np.zeros(0, np.int64)
    grams, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
    again = count[inverse] > 1 if len(h) else np.zeros(0, bool)
    if not again.any():
        return (a, low, high, h), (none, none), (grams, count)
    p, of = _ranges(low[again], high[again])
    marks = [string_hashes(data, length, b)[p] for b in _BASES]
    order = np.lexsort(marks)
    same = np.logical_and.reduce([m[order][1:] == m[order][:-1] for m in marks])
    twin, later = np.zeros(len(p), bool), np.zeros(len(p), bool)
    twin[order[1:][same]] = twin[order[:-1][same]] = True
    later[order[1:][same]] = True  # the sort is stable: the first of equal ones stays
    first, last = _stretches(~later, p, of)
    who = np.flatnonzero(again)[of[first]]
    cut = [np.concatenate([x[~again], y]) for x, y in ((a, a[who]), (low, p[first]), (high, p[last]), (h, h[who]))]
    row = np.searchsorted(offsets, p, side="right")
    begin, end = _stretches(twin, p, row)
    return tuple(cut), (p[begin], p[end]), (grams, count)


def _stretches(mask: np.ndarray, p: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the runs where ``mask`` holds, ``p`` goes up by one and ``of`` stays."""
    at = np.flatnonzero(mask)
    if not len(at):
        return at, at
    new = np.concatenate([[True], (p[at][1:] != p[at][:-1] + 1) | (of[at][1:] != of[at][:-1])])
    first = np.flatnonzero(new)
    return at[first], at[np.append(first[1:], len(at)) - 1]


def _gram_counts(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Anchors of each gram that a piece sends on; at least two where it has
    more, so that a gram counts as repeated however rows fall into pieces."""
    for _, data, offsets, _ in _pieces(batches, length):
        (_, _, _, fresh), _, (grams, count) = fresh_anchors(data, offsets, length, gram)
        n = np.minimum(count, 2)
        if len(fresh):
            sent = np.bincount(np.searchsorted(grams, fresh), minlength=len(grams))
            n = np.maximum(n, sent)
        yield pa.record_batch([pa.array(grams.view(np.int64)), pa.array(n)], ["gram", "n"])


_RUN = pa.schema(
    [("part", pa.int32()), ("run", pa.int64()), ("seq", pa.int32()), ("same", pa.int32()), ("rest", pa.binary()), ("left_same", pa.int32()),
     ("left_rest", pa.binary()), ("least", pa.int32()), ("most", pa.int32()), ("at", pa.int64()), ("doc_id", pa.int64()), ("mark", pa.int64())]
)
RUN_DDL = "part int, run long, seq int, same int, rest binary, left_same int, left_rest binary, least int, most int, at long, doc_id long, mark long"


def _sorted_runs(batches: Iterator[pa.RecordBatch], screens: tuple, parts: int, length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Front-coded sorted runs, one a piece of text. ``rest`` follows the first
    ``same`` bytes of the run's last suffix in the range; ``left_rest`` does so
    for the bytes before the anchor, read backwards; the anchor stands for
    windows that start ``least`` to ``most`` bytes before it. Rows with
    ``seq`` -1 are stretches of windows repeated within the piece: ``at`` to ``run``."""
    from pyspark import TaskContext

    task, piece = TaskContext.get().partitionId() if TaskContext.get() else 0, 0
    for rows, data, offsets, shift in _pieces(batches, length):
        (a, low, high, h), (begin, end), _ = fresh_anchors(data, offsets, length, gram)
        if len(begin):
            yield _settled(rows, offsets, shift, begin, end, parts)
        keep = passes(screens[0], h) & ~passes(screens[1], h) if len(h) else np.zeros(0, bool)
        a, low, high, h = a[keep], low[keep], high[keep], h[keep]
        if not len(a):
            continue
        raw = data.tobytes()
        row = np.searchsorted(offsets, a, side="right") - 1
        ids, marks = rows.column("doc_id").to_pylist(), rows.column("mark").to_numpy()
        part = ((h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        heads = h.astype(">u8").tobytes()
        items = []
        for i, (x, lo, hi) in enumerate(zip(a.tolist(), low.tolist(), high.tolist())):
            items.append((heads[8 * i : 8 * i + 8] + raw[x : hi + length], raw[lo:x][::-1], i))
        items.sort()
        cols: list[list] = [[] for _ in _RUN]
        before, left_before, seq, last_part = b"", b"", 0, -1
        for suffix, left, i in items:
            if part[i] != last_part:
                before, left_before, seq, last_part = b"", b"", 0, part[i]
            n, m = shared(before, suffix), shared(left_before, left)
            doc = row[i]
            at = int(a[i] - offsets[doc]) + shift
            values = (int(part[i]), task << 32 | piece, seq, n, suffix[n:], m, left[m:], int(a[i] - high[i]), int(a[i] - low[i]), at, ids[doc], int(marks[doc]))
            for c, v in zip(cols, values):
                c.append(v)
            before, left_before, seq = suffix, left, seq + 1
        piece += 1
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, _RUN)], schema=_RUN)


def _settled(rows: pa.RecordBatch, offsets: np.ndarray, shift: int, begin: np.ndarray, end: np.ndarray, parts: int) -> pa.RecordBatch:
    """Repeats found within a piece, as rows that pass through the merge."""
    doc = np.searchsorted(offsets, begin, side="right") - 1
    n, pick = len(begin), pa.array(doc)
    mark = rows.column("mark").take(pick)
    values = {
        "part": pa.array((mark.to_numpy().view(np.uint64) % np.uint64(parts)).astype(np.int32)),
        "run": pa.array(end - offsets[doc] + shift), "seq": pa.array(np.full(n, -1, np.int32)),
        "at": pa.array(begin - offsets[doc] + shift), "doc_id": rows.column("doc_id").take(pick), "mark": mark,
    }
    return pa.record_batch([values.get(f.name, pa.nulls(n, f.type)) for f in _RUN], schema=_RUN)


_REPEATS = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])
REPEATS_DDL = "doc_id long, mark long, low long, high long"


def _merged(rows: pa.Table, length: int) -> pa.Table:
    """Repeated windows of one range, from its runs (rows by run, then place)."""
    done = pc.equal(rows.column("seq"), -1)
    settled = rows.filter(done).combine_chunks()
    rows = rows.filter(pc.invert(done)).combine_chunks()
    passed = pa.table([settled.column(c) for c in ("doc_id", "mark", "at", "run")], schema=_REPEATS)
    if not rows.num_rows:
        return passed
    run = rows.column("run").to_numpy()
    cuts = np.concatenate([[0], np.flatnonzero(run[1:] != run[:-1]) + 1, [len(run)]])
    same, rest = rows.column("same").to_pylist(), bytes_of(rows.column("rest"))
    coded = list(zip(same, rest))
    runs = [coded[i:j] for i, j in zip(cuts[:-1], cuts[1:])]
    order, agree = np.empty(len(run), np.int64), np.empty(len(run), np.int64)
    for i, (r, place, h, _) in enumerate(merge(runs)):
        order[i], agree[i] = cuts[r] + place, h - 8  # the first 8 bytes are the gram's hash
    least, most = (rows.column(c).to_numpy().astype(np.int64)[order] for c in ("least", "most"))
    lefts = _lefts(rows, cuts)
    left = np.zeros((len(run), int(most.max(initial=0))), np.uint8)
    for i, o in enumerate(order.tolist()):
        left[i, : len(lefts[o])] = np.frombuffer(lefts[o], np.uint8)
    hit = _agreeing(agree, least, most, left, length)
    rows = rows.select(["at", "doc_id", "mark"]).take(pa.array(order)).combine_chunks()
    at, mark = rows.column("at").to_numpy(), rows.column("mark").to_numpy()
    # runs of repeated windows of an anchor: hit[i, o] is the window at[i] - o
    edge = np.diff(np.pad(hit.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    i, o = np.nonzero(edge == 1)
    _, stop = np.nonzero(edge == -1)
    ids = rows.column("doc_id").take(pa.array(i))
    ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
    found = pa.table([ids, pa.array(mark[i]), pa.array(at[i] - stop + 1), pa.array(at[i] - o)], schema=_REPEATS)
    return pa.concat_tables([passed, found])


def _lefts(rows: pa.Table, cuts: np.ndarray) -> list[bytes]:
    same, rest = rows.column("left_same").to_pylist(), bytes_of(rows.column("left_rest"))
    begins, out, before = set(cuts.tolist()), [], b""
    for i, (n, r) in enumerate(zip(same, rest)):
        before = r if i in begins else before[:n] + r
        out.append(before)
    return out


def _agreeing(agree: np.ndarray, least: np.ndarray, most: np.ndarray, left: np.ndarray, length: int) -> np.ndarray:
    """Which windows (anchor x bytes before it) equal another anchor's window.

    ``agree[i]`` is how many bytes suffix i shares with the one before it in
    order: windows o bytes before their anchors agree to the right within
    runs of agree >= length - o; to the left their o bytes must be equal.
    """
    n, width = left.shape
    hit = np.zeros((n, width + 1), bool)
    h = np.zeros(n, np.uint64)
    for o in range(width + 1):
        if o:
            h = spread(h ^ (left[:, o - 1].astype(np.uint64) + np.uint64(1)))
        live = np.flatnonzero((least <= o) & (o <= most))
        if len(live) < 2:
            continue
        run = np.cumsum(agree < length - o)
        # runs are numbered far above byte values, so that the two cannot change places
        key = spread(h[live] ^ spread(run[live].astype(np.uint64) + np.uint64(1 << 40)))
        order = np.argsort(key)
        twin = key[order][1:] == key[order][:-1]
        hit[live[order[1:][twin]], o] = True
        hit[live[order[:-1][twin]], o] = True
    return hit


def _merge_ranges(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range, run and place in; one range is held at a time."""
    held: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        part = table.column("part").to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]])
        for i, j in zip(cuts[:-1], cuts[1:]):
            if j == i:
                continue
            if held and held[-1].column("part")[0].as_py() != int(part[i]):
                yield from _merged(pa.concat_tables(held), length).to_batches()
                held = []
            held.append(table.slice(i, j - i))
    if held:
        yield from _merged(pa.concat_tables(held), length).to_batches()


_WINDOWS = pa.schema([*list(_REPEATS), ("h", pa.int64()), ("g", pa.int64())])
WINDOWS_DDL = REPEATS_DDL + ", h long, g long"


def _window_hashes(batches: Iterator[pa.RecordBatch], hot: np.ndarray, length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """``doc_id, mark, low, high, h, g``: the windows of the hot grams' anchors that
    do not repeat an earlier one of their piece, one a row, and the stretches repeated in the piece (no
    hashes). Both come from the same pieces: another job may cut them elsewhere."""
    for rows, data, offsets, shift in _pieces(batches, length):
        (_, low, high, h), (begin, end), _ = fresh_anchors(data, offsets, length, gram)
        if len(begin):
            row = np.searchsorted(offsets, begin, side="right") - 1
            pick, none = pa.array(row), pa.nulls(len(begin), pa.int64())
            places = [pa.array(x - offsets[row] + shift) for x in (begin, end)]
            yield pa.record_batch([rows.column("doc_id").take(pick), rows.column("mark").take(pick), *places, none, none], schema=_WINDOWS)
        keep = passes(hot, h) if len(h) else np.zeros(0, bool)
        if not keep.any():
            continue
        p, _ = _ranges(low[keep], high[keep])
        row = np.searchsorted(offsets, p, side="right") - 1
        pick = pa.array(row)
        marks = [pa.array(string_hashes(data, length, b)[p].view(np.int64)) for b in _BASES]
        place = pa.array(p - offsets[row] + shift)
        yield pa.record_batch([rows.column("doc_id").take(pick), rows.column("mark").take(pick), place, place, *marks], schema=_WINDOWS)


def repeated_windows(slim: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, mark, low, high``: stretches of window starts whose strings
    start elsewhere too. ``slim``: ``doc_id, mark, body``."""
    spark = slim.sparkSession
    long = slim.where(F.octet_length("body") >= length)
    grams = long.select("body").mapInArrow(lambda it: _gram_counts(it, length, gram), "gram long, n long")
    told = stored(grams.groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1"), "suffix-grams")
    hot = told.where(F.col("n") > HOT)
    screens = (bit_screen(told, "gram"), bit_screen(hot, "gram"))
    total = told.where(F.col("n") <= HOT).agg(F.sum("n")).first()[0] or 0
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(shuffles, -(-total // RANGE))
    runs = long.mapInArrow(lambda it: _sorted_runs(it, screens, parts, length, gram), RUN_DDL)
    # a range is a partition: hashing its number would put several into one task
    ranged = runs.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "run", "seq")
    found = ranged.mapInArrow(lambda it: _merge_ranges(it, length), REPEATS_DDL)
    if not screens[1].any():
        return found
    windows = stored(long.mapInArrow(lambda it: _window_hashes(it, screens[1], length, gram), WINDOWS_DDL), "suffix-hot")
    often = windows.where("h is not null").groupBy("h", "g").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = windows.join(often, ["h", "g"], "left_semi").select("doc_id", "mark", "low", "high")
    settled = windows.where("h is null").select("doc_id", "mark", "low", "high")
    return found.union(repeated).union(settled)


def _word_pieces(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, int]]:
    """``rows, word hashes, offsets, shift``: as ``_pieces``, in words, a quarter
    at a time; a longer row goes on with its last words, one window less a word."""
    piece = max(1, PIECE // 4)
    for part in slices(batches, "body", piece):
        data, offsets = joined(part.column("body"))
        if part.num_rows > 1 or len(data) <= piece:
            w = words(data, offsets, EXACT)
            yield part, w.hash, np.searchsorted(w.row, np.arange(part.num_rows + 1)), 0
            continue
        held, shift = np.zeros(0, np.uint64), 0
        for h in _long_row(data, piece):
            held = np.concatenate([held, h])
            yield part, held, np.array([0, len(held)]), shift
            shift += max(0, len(held) - length + 1)
            held = held[max(0, len(held) - length + 1) :]


def _long_row(data: np.ndarray, piece: int) -> Iterator[np.ndarray]:
    """Word hashes of a row, stretch by stretch; a word longer than ``piece`` is hashed by itself."""
    s, n = 0, len(data)
    while s < n:
        apart = np.flatnonzero(EXACT[data[s : s + piece + 1]] == 0)
        if len(apart) or n - s <= piece:
            e = s + int(apart[-1]) + 1 if n - s > piece else n
            yield words(data[s:e], np.array([0, e - s]), EXACT).hash
        else:
            e = s + piece
            digest = hashlib.blake2b(digest_size=8)
            digest.update(data[s:e])
            while e < n:
                block = data[e : e + piece]
                apart = np.flatnonzero(EXACT[block] == 0)
                block = block[: int(apart[0])] if len(apart) else block
                digest.update(block)
                e += len(block)
                if len(apart):
                    break
            yield np.frombuffer(digest.digest(), np.uint64)
        s = e


def _passage_grams(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    for _, h, offsets, _ in _word_pieces(batches, length):
        grams, n = np.unique(anchors(h, offsets, length, gram)[3], return_counts=True)
        yield pa.record_batch([pa.array(grams.view(np.int64)), pa.array(n.astype(np.int64))], ["gram", "n"])


_STANDS = pa.schema([("part", pa.int64()), ("gram", pa.int64()), ("mark", pa.int64()), ("copies", pa.int64()), ("low", pa.int64()), ("before", pa.int32()), ("hashes", pa.list_(pa.int64()))])
STANDS_DDL = "part long, gram long, mark long, copies long, low long, before int, hashes array<long>"
_RUNS = pa.schema([("mark", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])
RUNS_DDL = "mark long, low long, high long"


def _passage_anchors(batches: Iterator[pa.RecordBatch], screens: tuple, parts: int, length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Anchors whose gram passes, with the hashes of the windows they stand for: the
    first starts at word ``low``, ``before`` words before the anchor. ``part`` is -1 for hot grams."""
    for rows, marks, offsets, shift in _word_pieces(batches, length):
        a, low, high, h = anchors(marks, offsets, length, gram)
        keep = passes(screens[0], h) if len(h) else np.zeros(0, bool)
        a, low, high, h = a[keep], low[keep], high[keep], h[keep]
        if not len(a):
            continue
        p, _ = _ranges(low, high)
        ends = np.concatenate([[0], np.cumsum(high - low + 1)]).astype(np.int32)
        hashes = pa.ListArray.from_arrays(pa.array(ends), pa.array(string_hashes(marks, length)[p].view(np.int64)))
        part = np.where(passes(screens[1], h), -1, ((h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64))
        row = np.searchsorted(offsets, a, side="right") - 1
        of = [rows.column(c).take(pa.array(row)) for c in ("mark", "copies")]
        yield pa.record_batch([pa.array(part), pa.array(h.view(np.int64)), *of, pa.array(low - offsets[row] + shift), pa.array((a - low).astype(np.int32)), hashes], schema=_STANDS)


def _held_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``mark, low, high``: runs of windows that another row holds too, of the anchors of one range."""
    tables = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
    if not tables:
        return
    rows = pa.concat_tables(tables).combine_chunks()
    gram, mark, copies, low, before = (rows.column(c).to_numpy() for c in ("gram", "mark", "copies", "low", "before"))
    lists = rows.column("hashes").combine_chunks()
    size = np.diff(lists.offsets.to_numpy())
    of = np.repeat(np.arange(len(gram)), size)
    step = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
    # equal windows have equal grams at equal distances
    key = spread(lists.flatten().to_numpy().view(np.uint64) ^ spread((before[of] - step).astype(np.uint64)))
    order = np.lexsort([mark[of], key, gram[of]])
    by, k, m = gram[of][order], key[order], mark[of][order]
    new = np.flatnonzero(np.concatenate([[True], (by[1:] != by[:-1]) | (k[1:] != k[:-1])]))
    last = np.append(new[1:], len(order)) - 1
    twice = (m[new] != m[last]) | (np.maximum.reduceat(copies[of][order], new) > 1)
    hit = np.zeros(len(order), bool)
    hit[order] = np.repeat(twice, last - new + 1)
    begin, end = _stretches(hit, step, of)
    yield pa.record_batch([pa.array(mark[of[begin]]), pa.array(low[of[begin]] + step[begin]), pa.array(low[of[end]] + step[end])], schema=_RUNS)


def repeated_passages(slim: DataFrame, length: int = PASSAGE) -> DataFrame:
    """``mark, words``: of texts that share a run of ``length`` words with another
    row, how many of their words lie in such runs. ``slim``: ``doc_id, mark, body``."""
    gram = max(1, length // 4)
    grams = slim.select("body").mapInArrow(lambda it: _passage_grams(it, length, gram), "gram long, n long")
    told = stored(grams.groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1"), "passage-grams")
    screens = (bit_screen(told, "gram"), bit_screen(told.where(F.col("n") > HOT), "gram"))
    total = told.where(F.col("n") <= HOT).agg(F.sum("n")).first()[0] or 0
    parts = max(int(slim.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE))
    # rows of one text are made one: their windows are compared once
    again = bit_screen(slim.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "mark")

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return (b.filter(pa.array(~passes(again, b.column("mark").to_numpy().view(np.uint64)))) for b in batches)

    single = slim.select("mark", "body", F.lit(1).cast("long").alias("copies"))
    copied = slim.select("mark", "body").where(screened(again, "mark")).groupBy("mark", "body").agg(F.count(F.lit(1)).alias("copies"))
    stands = single.mapInArrow(lambda it: _passage_anchors(once(it), screens, parts, length, gram), STANDS_DDL)
    stands = stands.union(copied.mapInArrow(lambda it: _passage_anchors(it, screens, parts, length, gram), STANDS_DDL))
    if screens[1].any():
        stands = stored(stands, "passage-anchors")
    found = stands.where("part >= 0").repartitionById(parts, F.col("part").cast("int")).mapInArrow(_held_again, RUNS_DDL)
    if screens[1].any():
        # a gram with more anchors than one task handles: its windows are counted by their hash
        windows = stands.where("part < 0").select("mark", "copies", "low", "gram", "before", F.posexplode("hashes").alias("i", "h"))
        windows = windows.select("mark", "copies", (F.col("low") + F.col("i")).alias("low"), "gram", (F.col("before") - F.col("i")).alias("o"), "h")
        held = windows.groupBy("h", "gram", "o").agg(F.min("mark").alias("a"), F.max("mark").alias("b"), F.max("copies").alias("n"))
        often = windows.join(held.where("a <> b or n > 1"), ["h", "gram", "o"], "left_semi")
        found = found.union(often.select("mark", "low", F.col("low").alias("high")))
    # each window is in one run: words from where the run before ended
    stop = F.lag(F.col("high") + length).over(Window.partitionBy("mark").orderBy("low"))
    new = found.select("mark", (F.col("high") + length - F.greatest(F.col("low"), F.coalesce(stop, F.col("low")))).alias("words"))
    return new.groupBy("mark").agg(F.sum("words").cast("long").alias("words"))


def _spans(low: np.ndarray, high: np.ndarray, size: int, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by windows that start in the stretches."""
    out: list[list[int]] = []
    for i in np.argsort(low, kind="stable"):
        s, e = int(low[i]), min(size, int(high[i]) + length)
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], [], [], []]
        rest = []
        for value, found in zip(batch.column("body"), batch.column("found")):
            body, stretches = value.as_py(), found.as_py() or []
            low, high = (np.array([s[k] for s in stretches], np.int64) for k in ("low", "high"))
            spans = _spans(low, high, len(body), length)
            edges = [0, *[x for s in spans for x in s], len(body)]
            kept = b"".join(body[i:j] for i, j in zip(edges[::2], edges[1::2]))
            for c, v in zip(out, (len(body), len(body) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())):
                c.append(v)
            rest.append(kept if spans else None)
        ints = [pa.array(c, pa.int64()) for c in out[:3]]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "n_passage_words", "copies"]
        more = [batch.column(c) for c in ("n_passage_words", "copies")]
        yield pa.record_batch([batch.column("doc_id"), *ints, pa.array(out[3], pa.string()), pa.array(rest, pa.binary()), *more], names)


def suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", passage: int = PASSAGE) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, n_passage_words`` for every row of ``docs``.

    ``kept`` are the remaining bytes of the text (null: empty) put together
    (null where nothing was removed: the text itself), ``n_spans`` the
    maximal removed runs, ``n_passage_words`` the words in runs of ``passage``
    words (as they are written, whatever white space is between) that another row
    holds too; they stay unless their bytes are a repeated string. Strings are judged on the input and never cross
    rows; a repeated row repeats all its strings. Null ids are kept; other
    columns are ignored; an empty table gives no rows.
    """
    body = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), body.alias("body")).withColumn("mark", F.xxhash64("body"))
    # equal rows (same id and text) find the same stretches: one of each is kept
    found = repeated_windows(slim.select("doc_id", "mark", "body"), length, gram).distinct()
    found = stored(found, "suffix-repeats")
    told = stored(repeated_passages(slim, passage), "suffix-passages")
    held = slim.select("doc_id", "mark").distinct().join(told, "mark")
    either = found.select("doc_id", "mark", F.struct("low", "high").alias("at"), F.lit(0).cast("long").alias("words"))
    either = either.union(held.select("doc_id", "mark", F.lit(None).cast("struct<low:long,high:long>"), "words"))
    each = either.groupBy("doc_id", "mark").agg(F.collect_list("at").alias("found"), F.max("words").alias("words"))
    screen = bit_screen(found.select("mark").union(told.select("mark")).distinct(), "mark")

    seen = slim.withColumn("touched", screened(screen, "mark"))
    whole = seen.where("not touched").select(
        "doc_id", F.octet_length("body").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.sha2("body", 256).alias("kept_sha256"), F.lit(None).cast("binary").alias("kept"), F.lit(0).cast("long").alias("n_passage_words"),
    )
    # equal rows are made one before they meet their stretches, and are cut once
    rows = seen.where("touched").groupBy("doc_id", "mark", "body").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    hit = rows.alias("s").join(each.alias("e"), F.expr("s.mark = e.mark and s.doc_id <=> e.doc_id"), "left")
    hit = hit.select("s.doc_id", "s.body", "s.copies", "e.found", F.coalesce("e.words", F.lit(0)).cast("long").alias("n_passage_words"))
    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, n_passage_words long"
    cut = hit.mapInArrow(lambda it: _cut(it, length), ddl + ", copies int")
    again = cut.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return whole.union(again.drop("copies", "_copy"))
