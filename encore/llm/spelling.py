"""Grouping spelling variants by blocked Gram matrices of letter counts.

Words one edit apart (one code point inserted, deleted or replaced) have
letter counts at a squared distance of 1 (lengths differ by one) or 2 (equal
lengths). The squared distances of two blocks of words come from one NumPy
product, |a|^2 + |b|^2 - 2 a.b; only pairs at 1 or 2 are kept, and their edit
is verified letter by letter.

Blocks are cells of words whose letters, dealt into a few classes, have the
same counts by class; a cell thus holds words of one length. An edit moves at most one
letter from one class to another or adds one letter to a class, so a cell
has to be compared only with itself and with the cells one such move away
(equal or adjacent length). Every pair of cells is compared from one side, and
cells above ``BLOCK`` words are dealt into blocks, each pair of blocks being a
group of its own: no group is unbounded and no near pair is lost.

What a group finds is added up by word before it leaves the task (number of
near words, best near word), so all pairs are never written out.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import stored
from encore.operators.indexing import broadcast_if_small

RUN = r"[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of one side of a group, and letters of a word that count as one word of it.
BLOCK, WIDTH = 2048, 256
#: Words that a cell should hold on average; sets the number of letter classes.
CELL = 512
#: Candidate letters compared at a time.
CHUNK = 1 << 24


def altered_runs(docs: DataFrame, modulus: int = 199, least_length: int = 6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word``: one row for each run of letters of at least ``least_length``
    code points, A-Z lower-cased. With h the crc32 of ``<doc_id>:<run>``, a run whose h
    ``modulus`` divides lacks its code point h % length (from 0) and may
    become shorter than that. A null doc_id counts as empty text."""
    runs = F.regexp_extract_all(F.translate(F.col(text_col).cast("string"), _UPPER, _LOWER), F.lit(RUN), F.lit(0))
    each = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    each = each.where(F.char_length("run") >= least_length)
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    marked = each.select("run", h.alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.expr("substring(run, 1, int(h % char_length(run)))"), F.col("run").substr(at + 2, F.char_length("run")))
    return marked.select(F.when(F.col("h") % modulus == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(runs: DataFrame, least_length: int = 6, least_count: int = 5) -> DataFrame:
    """``word, n``: the distinct words of ``runs`` that are long and frequent enough."""
    long = runs.where(F.char_length("word") >= least_length)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _offsets(classes: int) -> list[tuple[int, ...]]:
    """Steps from a cell to the cells it is compared with: itself, one letter
    moved from a class to a later one, one letter more."""
    unit = np.eye(classes, dtype=int)
    moved = [unit[j] - unit[i] for i, j in itertools.combinations(range(classes), 2)]
    return [tuple(s.tolist()) for s in [np.zeros(classes, int), *moved, *unit]]


def _class_counts(words: list[str], classes: int) -> np.ndarray:
    """Letters of each class in each word; a letter's class is its code point modulo ``classes``."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
    return np.bincount(row * classes + codes % classes, minlength=len(words) * classes).reshape(-1, classes)


def _celled(batches: Iterator[pa.RecordBatch], classes: int) -> Iterator[pa.RecordBatch]:
    """Words with their cell, and the cells they are compared in as the other side."""
    steps = np.array(_offsets(classes))
    for batch in batches:
        words = batch.column("word").to_pylist()
        if not words:
            continue
        counts = _class_counts(words, classes)
        names, of = np.unique(counts, axis=0, return_inverse=True)
        cells = [",".join(map(str, c)) for c in names.tolist()]
        sides = [[",".join(map(str, a)) for a in (c - steps).tolist() if min(a) >= 0] for c in names]
        of = of.reshape(-1).tolist()
        width = pa.array([-(-len(w) // WIDTH) for w in words], pa.int64())
        yield pa.record_batch(
            [batch.column("word"), batch.column("n"), width, pa.array([cells[i] for i in of]), pa.array([sides[i] for i in of], pa.list_(pa.string()))],
            ["word", "n", "width", "cell", "sides"],
        )


def _dealt(words: DataFrame) -> tuple[DataFrame, int]:
    """``cell, a, b, left, own, word, n``: the words of each group, and how many rows there are.

    The group ``(cell, a, b)`` compares block a of the cell's words (``left``)
    with block b of all words of its own and neighbouring cells (``own``
    tells the former).
    """
    weight = words.groupBy("cell", "sides").agg(F.sum("width").alias("m"))
    right = weight.select(F.explode("sides").alias("cell"), "m").groupBy("cell").agg(F.sum("m").alias("t"))
    plan = weight.select("cell", "m").join(right, "cell")
    plan = plan.select("cell", F.ceil(F.col("m") / BLOCK).cast("int").alias("na"), F.ceil(F.col("t") / BLOCK).cast("int").alias("nb"), "m", "t")
    plan = stored(plan, "spelling-cells")
    rows = int(plan.agg(F.sum(F.col("m") * F.col("nb") + F.col("t") * F.col("na"))).first()[0] or 0)
    plan = broadcast_if_small(plan.select("cell", "na", "nb"))

    def block(count: Column) -> Column:
        return F.pmod(F.xxhash64("word"), count).cast("int")

    def others(count: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), count - 1))

    left = words.select("cell", "word", "n").join(plan, "cell").withColumn("b", others(F.col("nb")))
    left = left.select("cell", block(F.col("na")).alias("a"), "b", F.lit(True).alias("left"), F.lit(True).alias("own"), "word", "n")
    sides = words.select(F.col("cell").alias("home"), F.explode("sides").alias("cell"), "word", "n").join(plan, "cell").withColumn("a", others(F.col("na")))
    sides = sides.select("cell", "a", block(F.col("nb")).alias("b"), F.lit(False).alias("left"), (F.col("home") == F.col("cell")).alias("own"), "word", "n")
    return left.union(sides), rows


def _letters(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A matrix of the words' letters (zero after their end), and their lengths."""
    length = np.fromiter(map(len, words), np.int64, len(words))
    out = np.zeros((len(words), int(length.max(initial=0))), np.uint8)
    out[np.arange(out.shape[1]) < length[:, None]] = np.frombuffer(b"".join(words), np.uint8)
    return out, length


def _counts(letters: np.ndarray) -> np.ndarray:
    """How often each byte value is in each row, as doubles or (exact below 4096 letters) floats."""
    rows, width = letters.shape
    flat = np.arange(rows)[:, None] * 256 + letters
    found = np.bincount(flat.reshape(-1), minlength=rows * 256).reshape(rows, 256)
    return found[:, 1:].astype(np.float32 if width < 4096 else np.float64)


def _one_edit(x: np.ndarray, y: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether rows of ``x`` (``length`` letters) become those of ``y`` (as many or
    one more) by one edit: equal before the first difference and after it."""
    width = y.shape[1]
    x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    differ = x != y
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    replaced = differ.sum(axis=1) == 1
    shifted = np.zeros_like(y)
    shifted[:, :-1] = y[:, 1:]
    # letters from the first difference on equal those one place later in y
    after = np.arange(width) >= first[:, None]
    inserted = ~(((x != shifted) & after).any(axis=1))
    longer = (y != 0).sum(axis=1) > length
    return np.where(longer, inserted, replaced)


def near_pairs(left: list[bytes], right: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Places ``i, j`` of all words of ``left`` and ``right`` one edit apart.

    A block of squared distances is one product: rows (|a|^2, 1, a) by
    columns (1, |b|^2, -2 b).
    """
    x, nx = _letters(left)
    y, ny = _letters(right)
    a, b = _counts(x), _counts(y)
    used = (a.any(axis=0)) | (b.any(axis=0))
    a, b = a[:, used], b[:, used]
    a = np.column_stack([(a * a).sum(axis=1), np.ones(len(a), a.dtype), a])
    b = np.column_stack([np.ones(len(b), b.dtype), (b * b).sum(axis=1), -2 * b]).astype(a.dtype)
    if x.shape[1] >= 4096 or y.shape[1] >= 4096:
        a, b = a.astype(np.float64), b.astype(np.float64)
    distance = a @ b.T
    i, j = np.nonzero((distance > 0.5) & (distance < 2.5))
    step = max(1, CHUNK // max(1, x.shape[1] + 1, y.shape[1]))
    width = max(x.shape[1], y.shape[1])
    x, y = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (x, y))
    keep = np.zeros(len(i), bool)
    for s in range(0, len(i), step):
        p, q = i[s : s + step], j[s : s + step]
        swap = nx[p] > ny[q]
        short, long = np.where(swap[:, None], y[q], x[p]), np.where(swap[:, None], x[p], y[q])
        keep[s : s + step] = _one_edit(short, long, np.minimum(nx[p], ny[q]))
    return i[keep], j[keep]


_FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])
FOUND_DDL = "word string, n_near long, best_n long, best string"


def _group_links(group: pa.Table) -> pa.RecordBatch:
    """Number of near words and the best of them, of each word of a group that has one."""
    words, n = group.column("word").to_pylist(), group.column("n").to_numpy()
    # words hold letters up to U+00FF alone: a byte each
    letters = [w.encode("latin-1") for w in words]
    side = group.column("left").to_numpy(zero_copy_only=False)
    own = group.column("own").to_numpy(zero_copy_only=False)
    left, right = np.flatnonzero(side), np.flatnonzero(~side)
    i, j = near_pairs([letters[k] for k in left], [letters[k] for k in right])
    i, j = left[i], right[j]
    # a pair of the cell's own words is met from both sides, any other once
    word = np.concatenate([i, j[~own[j]]])
    other = np.concatenate([j, i[~own[j]]])
    best = _by_text(letters)
    order = np.lexsort([best[other], -n[other], word])
    word, other = word[order], other[order]
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(word)))
    of = group.column("word")
    cols = [of.take(pa.array(word[first])), pa.array(count, pa.int64()), pa.array(n[other[first]]), of.take(pa.array(other[first]))]
    return pa.record_batch([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in cols], schema=_FOUND)


def _by_text(letters: list[bytes]) -> np.ndarray:
    """The rank of each word in code point order."""
    out = np.empty(len(letters), np.int64)
    out[sorted(range(len(letters)), key=letters.__getitem__)] = np.arange(len(letters))
    return out


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group in; one group is held at a time."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("cell", "a", "b"))))
        cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
        for s, e in zip(cuts[:-1], cuts[1:]):
            if s == e:
                continue
            if held and keys[s] != key:
                yield _group_links(pa.Table.from_batches(held))
                held = []
            key = keys[s]
            held.append(batch.slice(s, e - s))
    if held:
        yield _group_links(pa.Table.from_batches(held))


def near_words(words: DataFrame, classes: int | None = None) -> DataFrame:
    """``word, n_near, best_n, best`` for the words (``word, n``; distinct) that
    have a near word: how many, and of those of largest n the first in code point order.

    ``classes`` letter classes make the cells (unless given, as many as
    bring a cell to about ``CELL`` words on average); they change the work, not the result.
    """
    spark = words.sparkSession
    if classes is None:
        # occupied cells of a length grow about sixfold with each class from the third on
        total, classes = words.count(), 3
        while classes < 8 and total > CELL * 50 * 5 ** (classes - 3):
            classes += 1
    celled = words.mapInArrow(lambda it: _celled(it, classes), "word string, n long, width long, cell string, sides array<string>")
    groups, rows = _dealt(stored(celled, "spelling-words"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // (32 * BLOCK)))
    placed = groups.repartition(parts, "cell", "a", "b").sortWithinPartitions("cell", "a", "b")
    found = placed.mapInArrow(_links, FOUND_DDL)
    order = F.struct((-F.col("best_n")).alias("less"), "best")
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(order).alias("m"))
    return merged.select("word", "n_near", (-F.col("m.less")).alias("best_n"), F.col("m.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for rows ``word, form`` (no form null): the end of the
    chain of forms, by pointer doubling. Counts grow at least fivefold a step, so
    chains are short and have no cycle."""
    now = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        far = now.select(F.col("word").alias("_at"), F.col("root").alias("_to"))
        joined = now.join(far, now["root"] == far["_at"], "left")
        # what moved is counted from the written table, not by a second join
        step = stored(joined.select("word", F.coalesce("_to", "root").alias("root"), F.col("_to").isNotNull().alias("moved")), "spelling-roots")
        now = step.select("word", "root")
        if step.where("moved").isEmpty():
            return now


def spelling_variants(words: DataFrame, ratio: int = 5, classes: int | None = None) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of ``words``
    (``word`` of letters up to U+00FF, distinct; ``n`` occurrences).

    A word's form is its near word of largest n (ties: the first in code
    point order) if that n is at least ``ratio`` times its own, else null;
    ``root`` is where following the forms ends (the word itself without a
    form). Words without a near one have ``n_near`` 0.
    """
    near = stored(near_words(words, classes), "spelling-near")
    joined = words.join(near, "word", "left")
    is_form = F.col("best_n") >= ratio * F.col("n")
    named = stored(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    ends = roots(named.where("form is not null"))
    return named.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_groups(docs: DataFrame, modulus: int = 199, least_length: int = 6, least_count: int = 5, ratio: int = 5) -> DataFrame:
    """``spelling_variants`` of the words of ``docs`` (see ``altered_runs``).

    Null and empty texts have no words; repeated rows count each time; a null
    doc_id counts as empty text in the hash; other columns are ignored; an empty
    table gives no rows. Texts and runs of any length are taken whole.
    """
    words = stored(vocabulary(altered_runs(docs, modulus, least_length), least_length, least_count), "spelling-vocabulary")
    return spelling_variants(words, ratio)
