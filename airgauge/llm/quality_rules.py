"""Quality rules: a decision list learned from labelled statistics, as Spark conditional expressions.

Sequential covering: a rule (a conjunction of thresholds) is grown on two thirds of the labelled
statistics, pruned on the rest, kept if it is precise there, and what it covers is taken away; then
the next rule is grown. The list becomes one ordered `when` chain. All text work is in built-in
functions; the driver sees only counts per cell of binned features, from a bounded sample of labels.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

# Parameters of the fit. The sample of labelled rows is bounded; every document gets a verdict.
MOST_LABELLED = 12_000
BINS = 12
MOST_RULES = 12
MOST_CONDITIONS = 3
LEAST_PRECISION = 0.9
LEAST_COVER = 5

# Limits of the base rules.
LEAST_WORDS = 50
MOST_REPEATED = 50

FEATURES = ("symbol_share", "upper_share", "bang_share", "dup_line_share", "repeat_share", "distinct_share", "word_length")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # value > cut, else value <= cut
    cut: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > F.lit(self.cut) if self.above else value <= F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def _removed(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _held(d: DataFrame, name: str, value: Column) -> DataFrame:
    """`d` with one more column, behind a generator of one row.

    The optimizer copies a plain projected column into every filter and lambda that uses it; an array
    of words would be split anew for each word. It does not look through a generator.
    """
    return d.select("*", F.explode(F.array(value)).alias(name))


def _repeat_words(words: str) -> Column:
    """Words inside 3-word windows that occur twice or more in the array, each word once."""
    w = F.col(words)
    windows = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.struct(F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"), i.alias("i")),
    )
    return F.when(F.size(w) < 4, F.array().cast("array<struct<h:bigint,i:int>>")).otherwise(F.sort_array(windows))


def features(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The `keep` columns, the counts n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and FEATURES.

    A NULL or empty text has no words and zero in every column.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    d = docs.select(*[F.col(f"`{c}`") for c in keep], whole.alias("_t"))
    trimmed = F.btrim("_t", F.lit(WHITE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    d = _held(d, "_w", words)
    d = d.withColumn("_l", F.filter(F.split("_t", "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != ""))
    d = _held(d, "_s", _repeat_words("_w"))
    s = F.col("_s")
    # sorted by (hash, place): a window is repeated when a neighbour has its hash
    d = d.withColumn(
        "_p",
        F.sort_array(
            F.transform(
                F.filter(
                    s,
                    lambda x, j: ((j > 0) & (F.get(s, j - 1)["h"] == x["h"])) | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)),
                ),
                lambda x: x["i"],
            )
        ),
    )
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
    covered = F.aggregate(
        "_p",
        start,
        lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"],
    )
    chars = F.length(F.translate("_t", WHITE, ""))
    counts = F.struct(
        F.size("_w").cast("long").alias("n_words"),
        chars.cast("long").alias("word_chars"),
        _removed(F.col("_t"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.size("_l").alias("_lines"),
        F.size(F.array_distinct("_w")).alias("_distinct"),
        _removed(F.col("_t"), "!").alias("_bangs"),
        F.length(F.regexp_replace("_t", r"\P{Lu}+", "")).alias("_upper"),
    )
    d = d.select(*[F.col(f"`{c}`") for c in keep], F.inline(F.array(counts)))

    def share(part: str, of: str) -> Column:
        return F.when(F.col(of) > 0, F.col(part) / F.col(of)).otherwise(0.0)

    return d.select(
        *[F.col(f"`{c}`") for c in keep],
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("_upper", "word_chars").alias("upper_share"),
        share("_bangs", "word_chars").alias("bang_share"),
        share("n_dup_lines", "_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("_distinct", "n_words").alias("distinct_share"),
        share("word_chars", "n_words").alias("word_length"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


# --- fit ------------------------------------------------------------------------


def _sample(labels: DataFrame, most: int) -> DataFrame:
    """At most about `most` labelled ids, the same ones on every run: a share of hash space, from the count."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("_quality"))
    n = known.count()
    if n <= most:
        return known
    return known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * most / n))


def statistics(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> tuple[dict[str, list[float]], list[tuple]]:
    """Cut points per feature, and counts per cell: (bins..., prune part?, bad?, count).

    The ids joined to the documents are bounded by `most`, so the join broadcasts them.
    """
    ids = F.broadcast(_sample(labels, most))
    chosen = docs.select("doc_id", "text").join(ids, "doc_id")
    rows = features(chosen, keep=("doc_id", "_quality")).persist()
    f = rows.where(~base_failed())
    try:
        probes = [i / BINS for i in range(1, BINS)]
        # of values above zero, as most shares are zero in most documents
        row = f.agg(*[F.percentile_approx(F.when(F.col(c) > 0, F.col(c)), probes, 1000).alias(c) for c in FEATURES]).first()
        cuts = {c: sorted({0.0, *(row[c] or [])}) for c in FEATURES}
        binned = f.select(
            *[sum((F.when(F.col(c) > F.lit(x), 1).otherwise(0) for x in cuts[c]), F.lit(0)).alias(c) for c in FEATURES],
            (F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3)) == 0).alias("prune"),
            (F.col("_quality") == 0).alias("bad"),
        )
        cells = binned.groupBy(*FEATURES, "prune", "bad").agg(F.count(F.lit(1)).alias("n")).collect()
    finally:
        rows.unpersist()
    return cuts, sorted(tuple(r) for r in cells)


def _covers(rule: Sequence[tuple[int, bool, int]], cell: tuple) -> bool:
    return all((cell[i] > k) == above for i, above, k in rule)


def _counts(rule: Sequence[tuple[int, bool, int]], cells: list[tuple]) -> tuple[int, int]:
    bad = good = 0
    for c in cells:
        if _covers(rule, c):
            bad, good = (bad + c[-1], good) if c[-2] else (bad, good + c[-1])
    return bad, good


def _grow(cells: list[tuple], sizes: list[int]) -> list[tuple[int, bool, int]]:
    """Adds the condition of the largest information gain until no clean row is covered."""
    rule: list[tuple[int, bool, int]] = []
    p0, n0 = _counts(rule, cells)
    while n0 and p0 and len(rule) < MOST_CONDITIONS:
        best = (0.0, None, 0, 0)
        inside = [c for c in cells if _covers(rule, c)]
        for i, bins in enumerate(sizes):
            by = [[0, 0] for _ in range(bins + 1)]
            for c in inside:
                by[c[i]][0 if c[-2] else 1] += c[-1]
            p = n = 0
            for k in range(bins):
                p, n = p + by[k][0], n + by[k][1]
                for above, q, m in ((False, p, n), (True, p0 - p, n0 - n)):
                    if q:
                        gain = q * (math.log2(q / (q + m)) - math.log2(p0 / (p0 + n0)))
                        if gain > best[0] + 1e-9:
                            best = (gain, (i, above, k), q, m)
        if best[1] is None:
            break
        rule.append(best[1])
        p0, n0 = best[2], best[3]
    return rule


def _prune(rule: list[tuple[int, bool, int]], cells: list[tuple]) -> list[tuple[int, bool, int]]:
    """The shortest head of the rule that is best on the pruning part."""

    def worth(r):
        p, n = _counts(r, cells)
        return (p - n) / (p + n) if p + n else -1.0

    heads = [rule[:k] for k in range(1, len(rule) + 1)]
    return max(heads, key=lambda r: (worth(r), -len(r))) if heads else rule


def learn(cuts: dict[str, list[float]], cells: list[tuple]) -> list[Rule]:
    """Ordered rules for rejection; none when the labels show nothing to reject."""
    sizes = [len(cuts[c]) for c in FEATURES]
    rules: list[Rule] = []
    left = cells
    for _ in range(MOST_RULES):
        grown = _grow([c for c in left if not c[-3]], sizes)
        grown = _prune(grown, [c for c in left if c[-3]])
        p, n = _counts(grown, left)
        if not grown or p < LEAST_COVER or p < LEAST_PRECISION * (p + n):
            break
        # bin b holds values above cut b-1 and up to cut b, so "bin > k" is "value > cut k"
        rules.append(tuple(Condition(FEATURES[i], above, cuts[FEATURES[i]][k]) for i, above, k in grown))
        left = [c for c in left if not _covers(grown, c)]
    return rules


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> list[Rule]:
    return learn(*statistics(docs, labels, most))


# --- apply ------------------------------------------------------------------------


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, from 1; 0 when none does."""
    chain = None
    for k, rule in enumerate(rules, 1):
        holds = rule[0].column()
        for c in rule[1:]:
            holds = holds & c.column()
        chain = F.when(holds, k) if chain is None else chain.when(holds, k)
    return F.lit(0) if chain is None else chain.otherwise(0)


def judged(docs: DataFrame, rules: list[Rule], keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Every row of `docs`: counts, base_failed, the rule that rejects it (0: none) and kept.

    NULL and empty texts fail the base rules. Repeated rows get the same verdict each.
    """
    d = features(docs, keep=keep).withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules))
    return d.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
