"""Quality rules whose cutoffs come with a bound on false rejection.

Four rules measure a share of a text in thousandths: symbols and capitals of its word
characters, repeated lines of its lines, repeated words of its words. A rule rejects a
document above its cutoff. Cutoffs lie on a fixed grid, chosen per stratum from labelled
good documents, which play no other part: for a cutoff that rejects x of n of them, the
exact binomial probability of x or fewer under a false-rejection rate of ``alpha`` is its
p-value. Each (stratum, rule) family is tested from the most lenient cutoff on and stops
at its first failure (fixed-sequence testing), at level ``delta`` divided by the number of
families (Bonferroni). With probability 1 - delta, every chosen cutoff rejects at most
``alpha`` of the good documents of its stratum; ``alpha`` is the permitted total divided
by the number of rules, so that all rules of a stratum together stay within the total.
A stratum with too few labelled documents gets no cutoff and loses nothing to the rules.

All of it is DataFrame expressions; the cutoff table has one row per (stratum, rule).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .support import BLANKS, stored

RULES = ("symbols", "capitals", "lines", "repeats")
#: Cutoffs are 0, 10, ... 990 thousandths; level k is the number of cutoffs exceeded.
GRID_STEP, GRID_SIZE = 10, 100
#: Permitted false rejection of good documents per stratum by all rules, and its risk.
TOTAL_ALPHA, DELTA = 0.02, 0.05
WINDOW = 5
#: Strata up to which the table of cutoffs is broadcast (some 100 bytes a row).
BROADCAST_STRATA = 10_000


def _share(part: Column, whole: Column) -> Column:
    """Thousandths, rounded down; 0 of nothing is 0."""
    return F.when(whole > 0, F.floor(1000 * part / whole)).otherwise(F.lit(0)).cast("long")


def with_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``_n_words`` and the other counts of the base, all named with a leading ``_m_``.

    Words of repeated windows are found by the 64-bit hashes of the windows: when all are
    different there are none; otherwise they are sorted with their places, neighbours of
    equal hash are repeats, and their places cover the words.
    """
    cleaned = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    split = cleaned.withColumn("_words", F.array_remove(F.split("_text", BLANKS), ""))
    n = F.size("_words")
    # Elements by place: slice() would copy the whole array for each window.
    place = F.sequence(F.lit(0), n - WINDOW)
    windows = F.transform(place, lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(WINDOW)]))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    joined = split.select(
        "*",
        n.cast("long").alias("_m_words"),
        F.array_join("_words", "").alias("_joined"),
        F.when(n > WINDOW, windows).otherwise(F.array().cast("array<long>")).alias("_windows"),
        lines.alias("_lines"),
    ).drop("_words")
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    ordered = F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    counted = joined.select(
        *[c for c in joined.columns if c not in ("_joined", "_windows", "_lines")],
        F.length("_joined").cast("long").alias("_m_chars"),
        F.regexp_count("_joined", F.lit(r"[#*$%&|<>]")).cast("long").alias("_m_symbols"),
        F.regexp_count("_joined", F.lit(r"\p{Lu}")).cast("long").alias("_m_capitals"),
        F.size("_lines").cast("long").alias("_m_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("_m_dup_lines"),
        F.when(repeats, ordered).alias("_ordered"),
    )
    size = F.size("_ordered")
    last = F.struct(F.lit(None).cast("long").alias("h"), F.lit(None).cast("int").alias("i"))
    after = F.concat(F.slice("_ordered", F.lit(2), size), F.array(last))
    before = F.concat(F.array(last), F.slice("_ordered", F.lit(1), size - 1))
    same = F.zip_with(
        F.zip_with("_ordered", after, lambda a, b: F.struct(a["h"].alias("h"), a["i"].alias("i"), (a["h"] == b["h"]).alias("e"))),
        before,
        lambda a, b: F.when(a["e"] | (a["h"] == b["h"]), a["i"]),
    )
    placed = counted.withColumn("_places", F.when(size > 0, F.array_sort(F.array_compact(same)))).drop("_ordered")
    steps = F.zip_with("_places", F.slice("_places", F.lit(2), F.size("_places")), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    covered = F.aggregate(steps, F.lit(0), lambda s, x: s + x)
    return placed.withColumn("_m_repeats", F.coalesce(covered, F.lit(0)).cast("long")).drop("_places", "_text")


def shares() -> dict[str, Column]:
    """Each rule's measure in thousandths."""
    return {
        "symbols": _share(F.col("_m_symbols"), F.col("_m_chars")),
        "capitals": _share(F.col("_m_capitals"), F.col("_m_chars")),
        "lines": _share(F.col("_m_dup_lines"), F.col("_m_lines")),
        "repeats": _share(F.col("_m_repeats"), F.col("_m_words")),
    }


def _level(share: Column) -> Column:
    return F.least(F.lit(GRID_SIZE), F.ceil(share / GRID_STEP)).cast("int")


def _binomial_cdf(x: Column, n: Column, alpha: float) -> Column:
    """P(Bin(n, alpha) <= x), summed in logarithms from 0 up."""
    rest, odds = math.log1p(-alpha), math.log(alpha) - math.log1p(-alpha)
    first = n * F.lit(rest)
    start = F.struct(first.alias("t"), first.alias("s"))

    def add(state: Column, i: Column) -> Column:
        term = state["t"] + F.log(n - i + 1) - F.log(i) + F.lit(odds)
        high = F.greatest(term, state["s"])
        return F.struct(term.alias("t"), (high + F.log1p(F.exp(-F.abs(term - state["s"])))).alias("s"))

    steps = F.when(x > 0, F.sequence(F.lit(1).cast("long"), x)).otherwise(F.array().cast("array<long>"))
    return F.aggregate(steps, start, add, lambda state: F.exp(state["s"]))


def choose_cutoffs(good: DataFrame, total_alpha: float = TOTAL_ALPHA, delta: float = DELTA) -> DataFrame:
    """``(stratum, rule, n_good, cutoff)`` from the levels of labelled good documents.

    ``good`` has ``stratum`` and one level column per rule. ``cutoff`` is the lowest grid
    index that the tests certify, null if none. The counts are a histogram of at most
    (strata x rules x 101) cells, combined before the shuffle.
    """
    alpha = total_alpha / len(RULES)
    pairs = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("level")) for r in RULES]))
    cells = good.select("stratum", pairs.alias("p")).groupBy("stratum", "p.rule", "p.level").agg(F.count(F.lit(1)).alias("n"))
    levels = F.transform(F.sequence(F.lit(0), F.lit(GRID_SIZE)), lambda k: F.coalesce(F.element_at("by_level", k), F.lit(0).cast("long")))
    families = cells.groupBy("stratum", "rule").agg(
        F.sum("n").alias("n_good"), F.map_from_entries(F.collect_list(F.struct("level", "n"))).alias("by_level")
    )
    everyone = Window.partitionBy()
    tested = families.withColumn("families", F.count(F.lit(1)).over(everyone)).select(
        "stratum", "rule", "n_good", "families", F.posexplode(levels).alias("k", "n")
    )
    family = Window.partitionBy("stratum", "rule")
    above = F.sum("n").over(family.orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, -1))
    rejected = tested.withColumn("x", F.coalesce(above, F.lit(0)).cast("long")).filter(F.col("k") < GRID_SIZE)
    # Above the mean the probability is at least a half, so no sum is needed there.
    p = F.when(F.col("x") > F.col("n_good") * alpha, F.lit(1.0)).otherwise(_binomial_cdf(F.col("x"), F.col("n_good"), alpha))
    failing = F.when(p > F.lit(delta) / F.col("families"), F.col("k"))
    chosen = rejected.groupBy("stratum", "rule", "n_good").agg(F.max(failing).alias("failed"))
    cutoff = F.when(F.coalesce(F.col("failed"), F.lit(-1)) < GRID_SIZE - 1, F.coalesce(F.col("failed"), F.lit(-1)) + 1)
    return chosen.select("stratum", "rule", "n_good", cutoff.cast("int").alias("cutoff"))


def judge_quality(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    stratum: str = "lang",
    label: str = "quality",
    keep_columns: bool = False,
) -> DataFrame:
    """One row per row of ``docs`` with the base counts, ``base_failed`` and ``kept``.

    A null or empty text has no words, so it fails the base. A null stratum is a stratum of
    its own. ``labels`` holds ``(key, label)``; several rows of one key count as good if
    their largest label is 1; keys without a document and null keys are ignored. Without
    labels no cutoff is certified and only the base decides. Ties with a cutoff are kept
    (a rule rejects strictly above it). ``keep_columns`` returns the columns of ``docs``
    and ``kept`` instead of the counts.
    """
    level_of = {rule: _level(share) for rule, share in shares().items()}
    source = docs.select(
        *([F.struct("*").alias("_row")] if keep_columns else []),
        F.col(key).alias("_key"),
        F.col(stratum).cast("string").alias("_stratum"),
        F.col(text).alias("_source"),
    )
    measured = stored(with_measures(source, "_source").drop("_source"), "quality-measures")
    good = labels.groupBy(F.col(key).alias("_label_key")).agg(F.max(label).alias("_label")).filter("_label = 1")
    holdout = measured.drop("_row").join(good, F.col("_key") == F.col("_label_key"), "left_semi")
    cutoffs = choose_cutoffs(holdout.select(F.col("_stratum").alias("stratum"), *[c.alias(r) for r, c in level_of.items()]))
    by_rule = stored(
        cutoffs.groupBy(F.col("stratum").alias("_of")).agg(
            *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"_cut_{r}") for r in RULES]
        ),
        "quality-cutoffs",
    )
    # A row per stratum: sent to the tasks where they are few, so no text moves to the task
    # of its stratum; with more strata than that, none holds a large share.
    if by_rule.count() <= BROADCAST_STRATA:
        by_rule = F.broadcast(by_rule)
    failed = (F.col("_m_words") < 10) | (100 * F.col("_m_repeats") > 20 * F.col("_m_words"))
    verdicts = [F.coalesce(level_of[r] > F.col(f"_cut_{r}"), F.lit(False)) for r in RULES]
    rejected = verdicts[0] | verdicts[1] | verdicts[2] | verdicts[3]
    judged = measured.join(by_rule, F.col("_stratum").eqNullSafe(F.col("_of")), "left")
    kept = ~failed & ~rejected
    if keep_columns:
        return judged.filter(kept).select("_row.*")
    return judged.select(
        F.col("_key").alias(key),
        F.col("_m_words").alias("n_words"),
        F.col("_m_chars").alias("word_chars"),
        F.col("_m_symbols").alias("n_symbols"),
        F.col("_m_dup_lines").alias("n_dup_lines"),
        F.col("_m_repeats").alias("n_repeat_words"),
        failed.alias("base_failed"),
        kept.alias("kept"),
    )
