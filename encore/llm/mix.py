"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source has a token budget. Whole epochs (every document once) come first;
what remains of the budget is filled by a weighted sample without replacement:
document d draws an exponential key -ln(u) / quality(d), and documents are
taken in ascending key order until their sizes add up to the rest. u comes
from a hash of the document, so reruns agree.

The prefix sums need no sort of a whole source. Keys are dealt into cells of
about ``CELL`` documents by their place on the key scale; sizes are added up a
cell (pre-aggregated before the shuffle), the running sum over cells finds
the one cell a source's budget ends in, and only that cell is sorted. Its rows are
sorted in ranges (of key, doc_id, size and place), so a cell that holds more than
``CELL`` rows, as of one doc_id said many times, is no task's alone. A source with
a third of all rows thus costs its cell sums and one sort of a cell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.common import placed, stored
from encore.operators.prefix import contiguous_index, running_totals

#: Documents of a cell on average.
CELL = 2000


def n_words(text: Column) -> Column:
    """Words: runs of characters other than space and tab..carriage return (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """Weight between 0.2 and 1: lower for texts with many symbols for their
    length (null and empty: 1)."""
    symbols = F.length(F.regexp_replace(text, r"[^#*$%&|<>!]+", ""))
    return F.coalesce(F.greatest(F.lit(0.2), 1 - 4 * symbols / F.greatest(F.lit(1), F.length(text))), F.lit(1.0))


def unit(*cols: Column) -> Column:
    """A number in (0, 1) from 52 bits of the md5 of the values' text."""
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", *[c.cast("string") for c in cols])), 1, 13), 16, 10)
    return (bits.cast("double") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.0, most: float = 3.0) -> DataFrame:
    """``source, source_size, n, target``: the budget of each source.

    Sources in code point order (null last) weigh ``weights``, repeating, and
    share ``share`` of all sizes. No target exceeds ``most`` times its
    source's size: the excess is shared anew by weight among the others until
    none is above. ``sizes`` has one row a source (``source, source_size, n``).
    """
    order = contiguous_index(sizes, "source", "_i")
    named = sizes.where("source is not null").join(order, "source").select("source", "source_size", "n", F.col("_i").cast("long").alias("i"))
    null = sizes.where("source is null").crossJoin(sizes.agg(F.count("source").alias("i"))).select("source", "source_size", "n", "i")
    # one row a source; the second operand of the cross join above is one row
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("i") % len(weights) + 1).cast("int"))
    flat = stored(named.union(null).select("source", "source_size", "n", weight.alias("w")), "mix-sources")
    total = (flat.agg(F.sum("source_size")).first()[0] or 0) * share
    level, count, cap = None, -1, F.col("source_size") * float(most)
    while True:
        # a capped source stays capped: what it cannot take only raises the level of the others
        capped = F.lit(False) if level is None else F.col("w") * level > cap
        row = flat.agg(
            F.sum(F.when(capped, cap).otherwise(0.0)), F.sum(F.when(capped, 0.0).otherwise(F.col("w"))), F.count(F.when(capped, 1))
        ).first()
        if row[2] == count or not row[1]:
            break
        level, count = (total - (row[0] or 0.0)) / row[1], row[2]
    target = F.lit(0.0) if level is None else F.least(cap, F.col("w") * level)
    return flat.select("source", "source_size", "n", target.alias("target"))


def mix(
    docs: DataFrame,
    size: Column | None = None,
    quality: Column | None = None,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.0,
    most: float = 3.0,
    seed: int = 7,
    place: Column | None = None,
) -> DataFrame:
    """``place, doc_id, size, source, source_size, target, quality, copies, taken``
    for every row of ``docs``.

    ``copies`` is how often the mix holds the document: its source's whole
    epochs, plus one if the sample takes it; ``taken`` is copies x size. The
    sample ends with the document that brings the source closest to its
    target. Documents without words take part with size 0 (taken 0 words).
    Null sources are a source of their own, null ids draw by their text,
    repeated rows draw alike and are ranked by ``place``, which tells rows
    apart (unless given, a number in file order). Other columns are
    ignored; an empty table gives no rows.
    """
    text = F.col("text").cast("string")
    key = -F.log(unit(F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce(text, F.lit("")))), F.lit(seed))) / F.col("quality")
    slim = docs.select(
        (F.monotonically_increasing_id() if place is None else place).alias("place"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        (n_words(text) if size is None else size.cast("long")).alias("size"),
        (quality_weight(text) if quality is None else quality.cast("double")).alias("quality"),
        text.alias("text"),
    )
    slim = stored(slim.withColumn("key", key).drop("text"), "mix-documents")
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    plan = stored(targets(sizes, weights, share, most), "mix-targets")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    plan = plan.withColumn("epochs", epochs).withColumn("rest", rest)
    joined = slim.join(plan, slim["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    # 1 - exp(-key) spreads the keys over (0, 1); a cell is a stretch of it
    cell = F.floor((1 - F.exp(-F.col("key"))) * (F.floor(F.col("n") / CELL) + 1)).cast("long")
    cells = joined.withColumn("cell", cell)
    sums = cells.groupBy("source", "cell").agg(F.sum("size").alias("s"), F.first("rest").alias("rest"))
    upto = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = stored(sums.withColumn("upto", F.sum("s").over(upto)), "mix-cells")
    # the cell in which the budget ends: everything below it is taken, nothing above
    edge = running.where("upto >= rest").groupBy("source").agg(F.min(F.struct("cell", "upto", "s")).alias("e"))
    edge = edge.select(F.col("source").alias("_source"), F.col("e.cell").alias("edge"), (F.col("e.upto") - F.col("e.s")).alias("below"))
    marked = cells.join(edge, cells["source"].eqNullSafe(edge["_source"]), "left").drop("_source")
    group = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("group")
    inside = marked.where(F.col("cell") == F.col("edge")).select(group, F.struct("key", "doc_id", "size", "place").alias("at"), "size")
    ends = edge.join(plan, F.col("_source").eqNullSafe(F.col("source"))).select(group, "below", "rest")
    totals = running_totals(inside, "at", ["size"], group="group").join(ends, "group")
    before = F.col("below") + F.col("cum_size") - F.col("size")
    # the document that the budget ends in is taken if at least half of it fits
    chosen = totals.select(F.col("at.place").alias("place"), (before + F.col("size") / 2 <= F.col("rest")).alias("fits"))
    result = marked.join(chosen.where("fits").select("place", F.lit(1).alias("more")), "place", "left")
    extra = F.when(F.col("rest") <= 0, 0).when(F.col("edge").isNull() | (F.col("cell") < F.col("edge")), 1).otherwise(F.coalesce("more", F.lit(0)))
    copies = (F.col("epochs") + extra).cast("long")
    return result.withColumn("copies", copies).select(
        "place", "doc_id", "size", "source", "source_size", "target", "quality", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed(docs: DataFrame, **options) -> DataFrame:  # noqa: ANN003
    """The rows of the mix: each row of ``docs`` as often as ``mix`` takes it.

    Documents without words are kept once, so that mixing never loses a row
    that costs nothing. Rows are told apart by their place (``placed``).
    """
    numbered, place = placed(docs, "mix-rows")
    counts = mix(numbered, place=F.col(place), **options).select("place", F.when(F.col("size") == 0, 1).otherwise(F.col("copies")).alias("copies"))
    rows = numbered.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(place).alias("place"))
    again = rows.join(counts.where("copies > 0"), "place").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return again.select("row.*")


#: The registered query in DuckDB SQL: the level that targets rise to is the one
#: at which the sources, ordered by what caps them, use up the total.
SQL = r"""
WITH d AS (SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
k AS (SELECT doc_id, source, size, -ln((('0x' || md5(doc_id::VARCHAR || '|7')[1:13])::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
        / greatest(0.2, coalesce(1 - 4 * length(regexp_replace(text, '[^#*$%&|<>!]+', '', 'g')) / greatest(1, length(text)), 1.0)) AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
o AS (SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w FROM s),
c AS (SELECT *, coalesce(sum(3.0 * source_size) OVER (ORDER BY 3.0 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
        sum(w) OVER (ORDER BY 3.0 * source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free FROM o),
v AS (SELECT *, ((SELECT sum(source_size) FROM s) - used) / free AS lv FROM c),
l AS (SELECT min_by(lv, 3.0 * source_size / w) FILTER (lv * w <= 3.0 * source_size) AS level FROM v),
t AS (SELECT source, source_size, least(3.0 * source_size, w * level) AS target,
        CASE WHEN source_size > 0 THEN floor(least(3.0 * source_size, w * level) / source_size) ELSE 0 END AS epochs FROM o, l),
r AS (SELECT doc_id, size, source_size, target, epochs, target - epochs * source_size AS rest,
        coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, ((epochs + CASE WHEN rest > 0 AND before + size / 2 <= rest THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM r
"""
