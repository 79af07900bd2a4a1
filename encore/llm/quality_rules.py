"""Quality rules as weak supervision: vote or abstain, estimate, combine.

Each rule looks at the figures of a text and votes good (1), bad (0) or
abstains (null). How far a rule can be trusted is not set by hand:
expectation-maximisation estimates, from the agreement of the rules alone,
how often each votes good, bad or not at all on good and on bad texts, and a
document's verdict is its posterior probability of being good.

Only DataFrame expressions are used. The texts are read once; the figures are
written as a table; EM runs on the counts of distinct vote patterns (at most
3 ** rules rows, however many documents), one small aggregate a round.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import stored

BLANK = r"[\x20\x09-\x0D]+"


def _windows(words: Column) -> Column:
    """A 64-bit hash for each run of three words, in text order."""
    n = F.size(words)
    triples = F.arrays_zip(F.slice(words, 1, n - 2).alias("a"), F.slice(words, 2, n - 2).alias("b"), F.slice(words, 3, n - 2).alias("c"))
    return F.when(n > 2, F.transform(triples, lambda t: F.xxhash64(t["a"], t["b"], t["c"]))).otherwise(F.array().cast("array<bigint>"))


def _repeated(windows: Column) -> Column:
    """Words inside windows that occur twice or more, counted once each."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twin(x: Column, j: Column) -> Column:
        return (x["h"] == F.get("_sorted", j - 1)["h"]) | (x["h"] == F.get("_sorted", j + 1)["h"])

    found = F.filter("_sorted", lambda x, j: F.coalesce(twin(x, j), F.lit(False)))
    return placed, F.size(F.array_distinct(F.flatten(F.transform(found, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))


def figures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The figures of every row of ``docs``; null text: no words.

    ``n_words``; ``word_chars``: code points in words; ``n_symbols``:
    characters of ``#*$%&|<>``; ``n_dup_lines``: lines with a word that equal
    an earlier line; ``n_repeat_words``: words in three-word windows found
    twice or more; ``n_lines``: lines with a word; ``n_marks``: ``!`` and
    ``?``; ``n_upper``: A-Z; ``n_distinct``: distinct words.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    flat = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("t"), F.regexp_replace(text, BLANK, " ").alias("flat"))
    flat = flat.withColumn("flat", F.trim("flat"))
    words = F.when(F.col("flat") != "", F.split("flat", " ")).otherwise(F.array().cast("array<string>"))
    lines = F.filter(F.split("t", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    one = flat.select("doc_id", "t", words.alias("w"), lines.alias("l"), F.length("flat").alias("flat_chars"))
    two = one.withColumn("g", _windows(F.col("w")))
    # only texts with a repeated window need their windows sorted
    two = two.withColumn("twice", F.size(F.array_distinct("g")) < F.size("g"))
    placed, repeated = _repeated(F.col("g"))
    three = two.withColumn("_sorted", F.when(F.col("twice"), placed))
    n_words = F.size("w")
    return three.select(
        "doc_id",
        n_words.cast("long").alias("n_words"),
        (F.col("flat_chars") - F.greatest(F.lit(0), n_words - 1)).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("twice"), repeated).otherwise(0).cast("long").alias("n_repeat_words"),
        F.size("l").cast("long").alias("n_lines"),
        F.length(F.regexp_replace("t", r"[^!?]+", "")).cast("long").alias("n_marks"),
        F.length(F.regexp_replace("t", r"[^A-Z]+", "")).cast("long").alias("n_upper"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
    )


@dataclass(frozen=True)
class Rule:
    """Good votes where ``good`` holds, bad where ``bad`` does; else it abstains.
    ``good`` and ``bad`` are SQL conditions on the figures."""

    name: str
    good: str
    bad: str


RULES = (
    Rule("symbols", "false", "n_symbols > 0.3 * n_words"),
    Rule("marks", "false", "n_marks > 0.4 * n_words"),
    Rule("repeats", "false", "n_repeat_words > 0.3 * n_words"),
    Rule("lines", "false", "n_dup_lines > 0.3 * n_lines"),
    Rule("case", "false", "n_upper > 0.3 * word_chars"),
    Rule("length", "n_words >= 80", "n_words < 30"),
    Rule("variety", "false", "n_words >= 20 and n_distinct < 0.1 * n_words"),
    Rule("word length", "false", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    Rule("plain characters", "n_symbols <= 0.05 * n_words and n_marks <= 0.1 * n_words and n_upper <= 0.1 * word_chars", "false"),
    Rule("plain wording", "n_words >= 20 and n_repeat_words <= 0.2 * n_words and n_dup_lines <= 0.1 * n_lines", "false"),
)

#: Chances of a good vote, a bad vote and none on good and on bad
#: texts that the fit starts from, by which votes a rule can cast.
BOTH = ((0.6, 0.05, 0.35), (0.3, 0.3, 0.4))
ONLY_BAD = ((0.002, 0.01, 0.988), (0.002, 0.25, 0.748))
ONLY_GOOD = ((0.9, 0.002, 0.098), (0.4, 0.002, 0.598))


def starts(rules: tuple[Rule, ...]) -> list[tuple]:
    return [ONLY_BAD if r.good == "false" else ONLY_GOOD if r.bad == "false" else BOTH for r in rules]


def votes(rules: tuple[Rule, ...] = RULES) -> list[Column]:
    """One column ``v<i>`` a rule: 1 good, 0 bad, null abstains (bad goes first)."""
    return [F.when(F.expr(r.bad), 0).when(F.expr(r.good), 1).cast("int").alias(f"v{i}") for i, r in enumerate(rules)]


@dataclass(frozen=True)
class LabelModel:
    """Share of good texts, and for each rule the chances of a good vote, a bad
    vote and none, on a good and on a bad text."""

    good: float
    on_good: tuple[tuple[float, float, float], ...]
    on_bad: tuple[tuple[float, float, float], ...]

    def posterior(self) -> Column:
        """Probability that a text with votes ``v0, v1, ...`` is good."""
        odds = F.log(F.lit((1 - self.good) / self.good))
        for i, (g, b) in enumerate(zip(self.on_good, self.on_bad)):
            v = F.col(f"v{i}")
            voted, against, silent = (F.log(F.lit(y / x)) for x, y in zip(g, b))
            odds = odds + F.when(v == 1, voted).when(v == 0, against).otherwise(silent)
        return 1 / (1 + F.exp(odds))


def fit(patterns: DataFrame, start: list[tuple], rounds: int = 25, prior: float = 0.8, strength: float = 20.0) -> LabelModel:
    """EM over ``v0.., n`` (vote patterns and their counts).

    A Dirichlet prior worth ``strength`` texts, with the chances of ``start``
    (on good and on bad texts, for each rule) as its mean, keeps every chance away from 0 and 1 and the two classes from
    changing places. Every round is one aggregate over the patterns.
    """
    rules = len(start)
    on_good, on_bad = (tuple(x) for x in zip(*start))
    model = LabelModel(prior, on_good, on_bad)
    for _ in range(rounds):
        p = model.posterior()
        cols = [F.sum("n").alias("all"), F.sum(F.col("n") * p).alias("g"), F.sum(F.col("n") * (1 - p)).alias("b")]
        for i in range(rules):
            for name, share in (("g", p), ("b", 1 - p)):
                cols += [F.sum(F.when(F.col(f"v{i}") == v, F.col("n") * share)).alias(f"{name}{i}_{v}") for v in (1, 0)]
        s = {k: v or 0.0 for k, v in patterns.agg(*cols).first().asDict().items()}
        if not s["all"]:
            return model

        def chances(name: str, means: tuple, s: dict = s) -> tuple[tuple[float, float, float], ...]:
            out = []
            for i in range(rules):
                yes, no = (s[f"{name}{i}_{v}"] for v in (1, 0))
                counts = (yes, no, max(0.0, s[name] - yes - no))
                out.append(tuple((c + strength * m) / (s[name] + strength) for c, m in zip(counts, means[i])))
            return tuple(out)

        new = LabelModel((s["g"] + strength * prior) / (s["all"] + strength), chances("g", on_good), chances("b", on_bad))
        moved = max(abs(x - y) for a, b in zip(new.on_good + new.on_bad, model.on_good + model.on_bad) for x, y in zip(a, b))
        model = new
        if moved < 1e-4:
            break
    return model


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The figures of every row of ``docs``, the votes, and ``quality``, ``base_failed``, ``kept``.

    ``base_failed``: fewer than 50 words, or over half of the words in
    repeated windows. ``quality`` is the posterior probability of a good
    text; ``kept`` is false if the base failed, else quality >= ``least``.
    Null and empty texts have zero figures and fail the base; repeated rows
    and null ids are kept as rows; other columns are ignored; an empty
    table gives no rows.
    """
    table = stored(figures(docs, id_col, text_col), "quality-figures")
    voted = table.select("*", *votes(rules))
    names = [f"v{i}" for i in range(len(rules))]
    patterns = stored(voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).coalesce(1), "quality-patterns")
    model = fit(patterns, starts(rules))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = voted.withColumn("quality", model.posterior()).withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))
