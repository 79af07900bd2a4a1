"""Benchmark decontamination: size-partitioned MinHash containment search.

An item is found in a document if at least ``share`` of the item's distinct
word shingles occur in it, wherever they stand and however long the document.

Items are partitioned by their number of shingles (powers of two), as in LSH
Ensemble (Zhu et al., 2016), since how much of a signature a long document
must hit depends on the item's size, not on the document's. The signature of
an item of n shingles is its k smallest shingle hashes. If a document holds at
least ``ceil(share * n)`` of the n shingles, it lacks at most the rest, so of
any n - ceil(share * n) + 1 shingles it holds one: with k at least the largest
such number of the partition, no containment is missed. Signatures are twice as long, and a
candidate must hit as many of the k as the bound then demands, which thins
out documents that share one frequent phrase.

An item of fewer words than a shingle is one shingle of all its words. From
``LEAST_WORDS`` words on it is found inside longer documents too: those give
runs of the lengths that occur among such items. Shorter ones say too little
by themselves, and only documents of exactly their words hold them.

Documents are hashed whole, in one pass. A fixed-size bit array of the
signature hashes (its size is a parameter, whatever the benchmark's) drops
nearly all shingles inside the tasks; the rest meet the signatures in a join.
Candidates are verified by exact containment of the shingle texts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.common import WORD, joined, slices, stored
from encore.llm.words import SPACED, Words, spread, words

#: Bits of the array that screens shingles in the tasks (2 ** 23 bits: 1 MB).
SCREEN_BITS = 23
#: Words from which on an item shorter than a shingle is found inside longer texts.
LEAST_WORDS = 3


def shingle_hashes(w: Words, size: int, lengths: Sequence[int] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first word and words of every run of ``size`` words of one row, and of
    the shorter ``lengths``; a row of fewer words than ``size`` has a shingle of them all."""
    n = len(w.hash)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none
    lead = spread(w.hash)
    row, left = w.row, np.concatenate([np.flatnonzero(w.row[1:] != w.row[:-1]) + 1, [n]])
    stop = left[np.searchsorted(left, np.arange(n), side="right")]
    first = np.ones(n, bool)
    first[1:] = row[1:] != row[:-1]
    at = np.arange(n)
    whole = at + size <= stop
    starts, counts = [np.flatnonzero(whole | first)], []
    counts.append(np.minimum(size, stop[starts[0]] - starts[0]))
    for k in lengths:
        starts.append(np.flatnonzero((at + k <= stop) & ~(first & (at + k == stop))))
        counts.append(np.full(len(starts[-1]), k))
    start, length = np.concatenate(starts), np.concatenate(counts)
    h = length.astype(np.uint64)
    for j in range(size):
        inside = j < length
        h = np.where(inside, spread(h ^ lead[np.where(inside, start + j, 0)]), h)
    return h, start, length


def _shingle_rows(batches: Iterator[pa.RecordBatch], size: int, screen: np.ndarray | None, texts: bool, lengths: Sequence[int]) -> Iterator[pa.RecordBatch]:
    """``row_id, h`` (and ``shingle``, its words folded and joined by spaces)
    for the distinct shingles of each row that pass the screen."""
    for part in slices(batches, "body", 2 << 20):
        data, offsets = joined(part.column("body"))
        w = words(data, offsets, SPACED)
        h, first, length = shingle_hashes(w, size, lengths)
        if screen is not None:
            cell = h >> np.uint64(64 - SCREEN_BITS)
            keep = (screen[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 > 0
            h, first, length = h[keep], first[keep], length[keep]
        if not len(h):
            continue
        row = w.row[first]
        order = np.lexsort((h, row))
        new = np.ones(len(h), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (row[order][1:] != row[order][:-1])
        pick = order[new]
        cols = [part.column("row_id").take(pa.array(row[pick])), pa.array(h[pick].view(np.int64))]
        if texts:
            start, last = w.start[first[pick]], w.end[first[pick] + length[pick] - 1]
            runs = (data[i:j].tobytes().lower().split() for i, j in zip(start.tolist(), last.tolist()))
            cols.append(pa.array([b" ".join(r) for r in runs], pa.binary()))
        yield pa.record_batch(cols, ["row_id", "h", "shingle"][: len(cols)])


def hashed(rows: DataFrame, size: int, screen: np.ndarray | None = None, texts: bool = False, lengths: Sequence[int] = ()) -> DataFrame:
    """``row_id, h`` (and ``shingle``) of ``rows`` (``row_id, body``)."""
    ddl = "row_id long, h long" + ", shingle binary" * texts
    return rows.mapInArrow(lambda it: _shingle_rows(it, size, screen, texts, lengths), ddl)


def _short_lengths(items: DataFrame, size: int) -> list[int]:
    """The word counts from LEAST_WORDS to ``size`` - 1 that occur among the items (``text``)."""
    n = F.regexp_count("text", F.lit(WORD))
    return sorted(r["n"] for r in items.select(n.alias("n")).where((F.col("n") >= LEAST_WORDS) & (F.col("n") < size)).distinct().collect())


def signatures(items: DataFrame, size: int, share: float) -> DataFrame:
    """``item, n, need, h``: the signature of each item (``row_id, body``).

    ``need`` is how many of the k hashes a document with the asked share
    must hold: k - (n - ceil(share * n)), at least 1.
    """
    each = hashed(items, size)
    # an item's shingles are bounded by its text, so the window holds one item's hashes
    n = F.count(F.lit(1)).over(Window.partitionBy("row_id"))
    ranked = each.select(F.col("row_id").alias("item"), "h", n.alias("n"), F.row_number().over(Window.partitionBy("row_id").orderBy("h")).alias("r"))
    missing = F.col("n") - F.ceil(F.col("n") * share - F.lit(1e-9))
    # the partition: sizes from 2^(b-1) + 1 to 2^b share one signature length
    largest = F.pow(F.lit(2), F.ceil(F.log2("n")))
    k = F.least(F.col("n"), (2 * (F.floor(largest * (1 - share)) + 1)).cast("long"))
    return ranked.withColumn("k", k).where("r <= k").select("item", "n", F.greatest(F.lit(1), F.col("k") - missing).cast("long").alias("need"), "h")


def _screen(marks: DataFrame) -> np.ndarray:
    """The bit array of the hashes; built from the distinct cells, of which there
    are at most 2 ** SCREEN_BITS however many hashes."""
    cells = marks.select(F.shiftrightunsigned("h", 64 - SCREEN_BITS).cast("int").alias("c")).groupBy((F.col("c") / 8).cast("int").alias("byte"))
    packed = cells.agg(F.bit_or(F.call_function("shiftleft", F.lit(1), (F.col("c") % 8).cast("int"))).alias("bits")).toArrow()
    out = np.zeros(1 << (SCREEN_BITS - 3), np.uint8)
    out[packed.column("byte").to_numpy()] = packed.column("bits").to_numpy().astype(np.uint8)
    return out


def _row_id(doc_id: Column, text: Column) -> Column:
    """Rows are told apart by id and text, so a repeated row is one row."""
    return F.xxhash64(doc_id.cast("long"), F.coalesce(text.cast("string"), F.lit("")))


def rows_with_items(docs: DataFrame, benchmark: DataFrame, size: int = 5, share: float = 0.8) -> DataFrame:
    """``row_id, doc_id, item_id, n_item, n_shared`` of every row of ``docs`` that
    holds at least ``share`` of an item's distinct shingles."""
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    items = stored(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), body.alias("text")).distinct().select(F.monotonically_increasing_id().alias("item"), "*"), "decontaminate-items"
    )
    lengths = _short_lengths(items, size)
    marks = stored(signatures(items.select(F.col("item").alias("row_id"), F.col("text").cast("binary").alias("body")), size, share), "decontaminate-marks")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body.alias("text"), _row_id(F.col("doc_id"), F.col("text")).alias("row_id"))
    hits = hashed(slim.select("row_id", F.col("text").cast("binary").alias("body")), size, _screen(marks), lengths=lengths).distinct()
    found = hits.join(marks, "h").groupBy("row_id", "item").agg(F.count(F.lit(1)).alias("hits"), F.first("need").alias("need"))
    candidates = stored(found.where("hits >= need").select("row_id", "item"), "decontaminate-candidates")
    listed = items.join(candidates.select("item").distinct(), "item", "left_semi")
    wanted = stored(hashed(listed.select(F.col("item").alias("row_id"), F.col("text").cast("binary").alias("body")), size, texts=True), "decontaminate-wanted")
    total = wanted.groupBy(F.col("row_id").alias("item")).agg(F.count(F.lit(1)).alias("n_item"))
    texts = slim.join(candidates.select("row_id").distinct(), "row_id", "left_semi")
    have = hashed(texts.select("row_id", F.col("text").cast("binary").alias("body")), size, _screen(wanted), texts=True, lengths=lengths)
    both = have.select("row_id", "shingle").distinct().join(wanted.select(F.col("row_id").alias("item"), "shingle"), "shingle")
    shared = both.groupBy("row_id", "item").agg(F.count(F.lit(1)).alias("n_shared"))
    names = texts.select("row_id", "doc_id").distinct()
    held = shared.join(candidates, ["row_id", "item"], "left_semi").join(total, "item").join(items.select("item", "item_id"), "item").join(names, "row_id")
    sure = held.where(F.col("n_shared") >= F.col("n_item") * share - F.lit(1e-9))
    return sure.select("row_id", "doc_id", "item_id", "n_item", "n_shared")


def contained_items(docs: DataFrame, benchmark: DataFrame, size: int = 5, share: float = 0.8) -> DataFrame:
    """``doc_id, item_id, n_item, n_shared, containment`` of every document that
    holds at least ``share`` of an item's distinct shingles.

    Items of fewer than ``size`` words have one shingle of all their words;
    those of fewer than ``LEAST_WORDS`` are held only by documents of exactly these words. Null and empty texts,
    of documents or items, match nothing. A repeated doc_id is judged row by
    row and reported once an item, with the row that holds most; a null
    doc_id or item_id is reported as null. Other columns are ignored.
    """
    sure = rows_with_items(docs, benchmark, size, share)
    best = sure.groupBy("doc_id", "item_id").agg(F.max(F.struct((F.col("n_shared") / F.col("n_item")).alias("containment"), "n_item", "n_shared")).alias("b"))
    return best.select("doc_id", "item_id", "b.n_item", "b.n_shared", "b.containment")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 5, share: float = 0.8) -> DataFrame:
    """The rows of ``docs`` whose doc_id holds no benchmark item; columns as given.

    One row with an item takes all rows of its doc_id along; a null doc_id is
    no id, so such rows go only for an item of their own.
    """
    found = stored(rows_with_items(docs, benchmark, size, share).select("row_id", "doc_id").distinct(), "decontaminate-found")
    ids = found.select(F.col("doc_id").alias("_found")).where("_found is not null").distinct()
    rows = _without(docs, found).select(F.struct("*").alias("row"))
    return rows.join(ids, F.col("row.doc_id").cast("long") == F.col("_found"), "left_anti").select("row.*")


def drop_contaminated_rows(docs: DataFrame, benchmark: DataFrame, size: int = 5, share: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item themselves, whatever
    other rows of the same or of no doc_id hold; columns as given."""
    return _without(docs, rows_with_items(docs, benchmark, size, share).select("row_id", "doc_id").distinct())


def _without(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not among ``found`` (``row_id, doc_id``)."""
    rows = docs.select(F.struct("*").alias("row"), _row_id(F.col("doc_id"), F.col("text")).alias("_row_id"))
    gone = found.select(F.col("row_id").alias("_gone"), F.col("doc_id").alias("_found"))
    same = (F.col("_row_id") == F.col("_gone")) & F.col("row.doc_id").cast("long").eqNullSafe(F.col("_found"))
    return rows.join(gone, same, "left_anti").select("row.*")


#: The same result in DuckDB SQL, over whole tables.
SQL = r"""
WITH d AS (SELECT DISTINCT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
b AS (SELECT DISTINCT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, w, unnest(list_concat(list_transform(range(1, greatest(1, len(w) - 4) + 1), lambda i: array_to_string(w[i:i + 4], ' ')),
      list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')), list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))) AS s FROM d WHERE len(w) > 0),
bs AS (SELECT DISTINCT item_id, w, unnest(list_transform(range(1, greatest(1, len(w) - 4) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM b WHERE len(w) > 0),
n AS (SELECT item_id, w, count(*) AS n_item FROM bs GROUP BY item_id, w),
m AS (SELECT doc_id, ds.w AS dw, item_id, bs.w AS bw, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY doc_id, ds.w, item_id, bs.w),
r AS (SELECT doc_id, m.item_id, n_item, n_shared, n_shared / n_item AS containment FROM m JOIN n ON m.item_id IS NOT DISTINCT FROM n.item_id AND m.bw = n.w
      WHERE n_shared >= n_item * 0.8 - 1e-9)
SELECT doc_id, item_id, max_by(n_item, containment) AS n_item, max_by(n_shared, containment) AS n_shared, max(containment) AS containment
FROM r GROUP BY doc_id, item_id
"""
