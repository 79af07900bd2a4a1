"""SimHash near-duplicates by covering locality-sensitive hashing.

A document's fingerprint has bit b set if bit b is set in over half of the
64-bit hashes of its word shingles. Fingerprints within ``radius`` differing
bits are linked, and linked documents form one group.

Candidates come from Pagh's covering LSH ("Locality-sensitive Hashing without
False Negatives", 2016): bit i is given a nonzero vector m(i) of radius + 1
bits, and table v (every nonzero vector of that length) keeps the bits with
odd inner product <m(i), v>. The m(i) of at most ``radius`` differing bits
cannot span the whole space, so some v is orthogonal to all of them: that
table drops every differing bit and the pair collides there. No pair within
the radius is lost; others are removed by counting the differing bits.

Only distinct fingerprints enter the tables, so exact copies cost nothing.
Buckets of two are checked by an expression. Larger ones are searched with
NumPy, breadth first, and give the edges of a spanning forest only, never
all pairs; a bucket above ``BUCKET`` fingerprints is dealt into blocks, and
each pair of blocks is a group of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import id_and_bytes, placed, stored
from encore.llm.components import components
from encore.llm.screen import bit_screen, screened

BITS = 64
#: Shingles hashed at a time: bounds memory whatever the length of a text.
CHUNK = 1 << 16
#: Fingerprints of a bucket compared in one group.
BUCKET = 4096


def fingerprint(body: bytes, words: int = 4, seed: int = 42) -> int:
    """SimHash of one text, as an unsigned 64-bit number.

    A-Z are lower-cased; words are runs of bytes other than space and
    tab..carriage return. Fewer words than ``words``: one shingle of them
    all; no words: zero.
    """
    parts = body.lower().split()
    if not parts:
        return 0
    n = max(1, len(parts) - words + 1)
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n]
    ends = ends[min(words, len(parts)) - 1 :]
    counts = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, CHUNK):
        part = [digest(line[a:b], seed) for a, b in zip(starts[i : i + CHUNK].tolist(), ends[i : i + CHUNK].tolist())]
        raw = np.array(part, np.uint64).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << int(b) for b in np.flatnonzero(2 * counts > n))


def fingerprints(words: int = 4, seed: int = 42) -> Column:
    """Signed 64-bit fingerprint of the bytes in column ``body``."""

    @F.pandas_udf("long")
    def of(body: pd.Series) -> pd.Series:
        marks = np.fromiter((fingerprint(b, words, seed) for b in body), np.uint64, len(body))
        return pd.Series(marks.view(np.int64))

    return of("body")


def masks(radius: int) -> list[int]:
    """The bit mask of every table of the covering for ``radius``, as signed longs."""
    vectors = (1 << (radius + 1)) - 1
    out = []
    for v in range(1, vectors + 1):
        m = sum(1 << i for i in range(BITS) if ((i % vectors + 1) & v).bit_count() % 2)
        out.append(m - (1 << BITS) if m >> (BITS - 1) else m)
    return out


def _forest(values: np.ndarray, radius: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Edges of a spanning forest of the links among ``values``."""
    left, right = [], []
    rest = values
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = np.bitwise_count(rest ^ x) <= radius
            if near.any():
                found = rest[near]
                left.append(np.full(len(found), x))
                right.append(found)
                queue.extend(found)
                rest = rest[~near]
    return left, right


def _bucket_edges(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket in, edges out. A bucket may span batches; it holds
    at most 2 x BUCKET rows, which bounds what is kept between batches."""
    kept: pa.Table | None = None

    def edges(table: pa.Table) -> pa.RecordBatch:
        keys = [table.column(c).to_numpy() for c in ("t", "k", "a", "b")]
        fp = table.column("fp").to_numpy().view(np.uint64)
        new = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        left, right = [], []
        for i, j in zip(np.concatenate([[0], new]), np.concatenate([new, [len(fp)]])):
            more = _forest(fp[i:j], radius)
            left += more[0]
            right += more[1]
        u, v = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (left, right))
        return pa.record_batch([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        if kept is not None:
            table = pa.concat_tables([kept, table])
        if not table.num_rows:
            continue
        keys = [table.column(c).to_numpy() for c in ("t", "k", "a", "b")]
        last = np.flatnonzero(np.any([k != k[-1] for k in keys], axis=0))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield edges(table.slice(0, cut))
        kept = table.slice(cut).combine_chunks()
    if kept is not None and kept.num_rows:
        yield edges(kept)


def links(marks: DataFrame, radius: int = 4) -> DataFrame:
    """``u, v``: edges that join all fingerprints (column ``fp``, distinct) within ``radius`` bits."""
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(masks(radius))])
    cells = marks.select("fp", F.explode(tables).alias("e")).select("e.t", "e.k", "fp")
    buckets = cells.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("u"), F.max("fp").alias("v")).where("n > 1")
    buckets = stored(buckets, "simhash-buckets")
    pairs = buckets.where("n = 2").where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius).select("u", "v")
    large = buckets.where("n > 2").select("t", "k", F.ceil(F.col("n") / BUCKET).cast("int").alias("blocks"))
    # most cells are in no large bucket: they are dropped before the shuffle
    near = bit_screen(large.select(F.xxhash64("t", "k").alias("cell")), "cell")
    cells = cells.withColumn("cell", F.xxhash64("t", "k")).where(screened(near, "cell"))
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = (
        cells.join(large, ["t", "k"])
        .withColumn("c", block)
        .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("t", "k", F.least("c", "o").alias("a"), F.greatest("c", "o").alias("b"), "fp")
        .repartition("t", "k", "a", "b")
        .sortWithinPartitions("t", "k", "a", "b", "fp")
    )
    found = dealt.mapInArrow(lambda it: _bucket_edges(it, radius), "u long, v long")
    return pairs.union(found).distinct()


def simhash_groups(marks: DataFrame, radius: int = 4) -> DataFrame:
    """``fp, root, component_id`` for the distinct fingerprints of ``marks``
    (columns ``doc_id, fp``): the smallest doc_id of the linked group, null
    only when all its documents lack an id."""
    each = stored(marks.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-marks")
    nodes = components(links(each.select("fp"), radius))
    named = each.join(nodes, each["fp"] == nodes["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    lowest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return named.join(lowest, "root").select("fp", "root", "component_id")


def with_fingerprints(docs: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` (signed long), one row for each row of ``docs``."""
    slim = id_and_bytes(docs, id_col, text_col)
    return slim.select("doc_id", fingerprints(words).alias("fp"))


def simhash_dedup(docs: DataFrame, words: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    ``fingerprint`` is 16 lower-case hex digits, ``component_id`` the
    smallest doc_id reachable over links of at most ``radius`` bits.
    Null and empty texts have fingerprint zero and are linked like any
    other. Repeated rows stay (one result row each); a null doc_id is kept
    and counts as a group's name only when the group has no other. Other
    columns of ``docs`` are ignored. No rows in, no rows out.
    """
    marks = stored(with_fingerprints(docs, words, id_col, text_col), "simhash")
    groups = simhash_groups(marks, radius)
    return marks.join(groups, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group the row with
    the smallest doc_id stays (ids tie: the first row in file order; ids
    null: last). Rows are told apart by their place (``placed``).
    """
    rows, place = placed(docs, "simhash-rows")
    slim = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body"), F.col(place).alias("place"))
    marks = stored(slim.select("doc_id", "place", fingerprints(words).alias("fp")), "simhash")
    named = marks.join(simhash_groups(marks, radius).select("fp", "root"), "fp")
    first = named.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "place")).alias("best"))
    chosen = first.select(F.col("best.place").alias(place))
    return rows.join(chosen, place, "left_semi").drop(place)
