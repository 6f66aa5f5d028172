"""Quality rules: a decision list learned by sequential covering, applied as SQL conditions.

Everything runs in the JVM. Statistics of a text are array and string functions on its own
row: no explode, no shuffle. Learning reads a narrow staged table of labelled documents;
each step is one aggregation to a bounded number of counts (statistics x cut points x two
labels), from which the driver picks the next condition.

Defined results: a null text counts as empty; an empty or blank text has zero of
everything and fails the base rule; repeated rows of a document each get their verdict; of
several labels of one document the lowest counts. With no labelled rows, or only one label,
no rule is learned and the base rule alone decides. Columns beside ``doc_id`` and ``text``
are ignored when statistics are made and kept by :func:`apply_rules`.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scdstar.llm.common import WORD, characters, words
from scdstar.session import stage

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Bits for a word's position beside 40 bits of hash; longer texts sort whole hashes only.
POSITION_BITS = 24
#: Statistics that conditions may test, as SQL over the base statistics.
STATISTICS = {
    "n_words": "CAST(n_words AS DOUBLE)",
    "mean_word_chars": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_word_share": "n_distinct_words / greatest(n_words, 1)",
    "capital_share": "n_capitals / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "exclamations_per_word": "n_exclamations / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
}


def base_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """The counts that the base rule and all conditions derive from, one row per input row.

    A word is repeated if some window of three words around it occurs twice or more in the
    text. Windows are sorted by hash within the row, so that equal ones are neighbours:
    n log n also for texts that repeat throughout. Windows are told apart by 64-bit hashes.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        *keep,
        words(text).alias("w"),
        F.filter(F.split(text, "\n"), lambda line: F.regexp_like(line, F.lit(WORD)))
        .alias("lines"),
        characters(text, f"[{SYMBOLS}]").alias("n_symbols"),
        characters(text, "[A-Z]").alias("n_capitals"),
        characters(text, "[0-9]").alias("n_digits"),
        characters(text, "!").alias("n_exclamations"),
    )
    # Plain longs sort fast: the upper bits of a window's hash with its position below them.
    # What shares those bits with a neighbour is then compared by whole hashes.
    low = (1 << POSITION_BITS) - 1
    rows = rows.withColumn(
        "packed",
        F.expr(
            f"CASE WHEN size(w) BETWEEN 4 AND {low} THEN sort_array(transform(sequence(0, size(w) - 3),"
            f" i -> (xxhash64(w[i], w[i + 1], w[i + 2]) & {~low}L) | CAST(i AS BIGINT))) END"
        ),
    )
    rows = rows.withColumn(
        "second",
        F.expr(
            f"filter(packed, (x, k) -> shiftright(x, {POSITION_BITS})"
            f" = shiftright(get(packed, k - 1), {POSITION_BITS}))"
        ),
    ).withColumn(
        "likely",
        F.expr(
            f"CASE WHEN size(w) > {low} THEN sequence(0, size(w) - 3)"
            f" WHEN size(second) > 0 THEN transform(filter(packed, (x, k) -> shiftright(x, {POSITION_BITS})"
            f" = shiftright(coalesce(get(packed, k - 1), ~x), {POSITION_BITS}) OR shiftright(x, {POSITION_BITS})"
            f" = shiftright(coalesce(get(packed, k + 1), ~x), {POSITION_BITS})),"
            f" x -> CAST(x & {low} AS INT)) END"
        ),
    ).withColumn(
        "likely",
        F.expr(
            "sort_array(transform(likely, i -> struct(xxhash64(w[i], w[i + 1], w[i + 2]) AS h, i AS i)))"
        ),
    )
    rows = rows.withColumn(
        "twice",
        F.expr(
            "filter(likely, (x, k) -> x.h = coalesce(get(likely, k - 1).h, ~x.h)"
            " OR x.h = coalesce(get(likely, k + 1).h, ~x.h))"
        ),
    )
    return rows.select(
        *keep,
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        "n_symbols",
        F.expr("CAST(size(lines) - size(array_distinct(lines)) AS BIGINT)").alias("n_dup_lines"),
        F.expr(
            "CAST(CASE WHEN twice IS NULL OR size(twice) = 0 THEN 0 ELSE size(array_distinct(flatten("
            "transform(twice, x -> array(x.i, x.i + 1, x.i + 2))))) END AS BIGINT)"
        ).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.expr("CAST(size(array_distinct(w)) AS BIGINT)").alias("n_distinct_words"),
        "n_capitals",
        "n_digits",
        "n_exclamations",
    )


def base_failed() -> Column:
    return F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")


@dataclass(frozen=True)
class Condition:
    """``statistic >= bound`` if ``above``, else ``statistic < bound``."""

    statistic: str
    above: bool
    bound: float

    def column(self) -> Column:
        value = F.expr(STATISTICS[self.statistic])
        return value >= self.bound if self.above else value < self.bound

    def __str__(self) -> str:
        return f"{self.statistic} {'>=' if self.above else '<'} {self.bound:.6g}"


Rule = tuple[Condition, ...]


def _all(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, (c.column() for c in rule), F.lit(True))


def _any(rules: list[Rule]) -> Column:
    return reduce(lambda a, b: a | b, (_all(r) for r in rules), F.lit(False))


def learn_rules(
    labelled: DataFrame,
    cuts: int = 24,
    max_rules: int = 6,
    max_conditions: int = 3,
    min_precision: float = 0.9,
    min_cover: int = 3,
) -> list[Rule]:
    """Rules that reject, learned from base statistics with ``doc_id`` and ``bad`` (0 or 1).

    Two thirds of the documents grow rules, the rest prune them. Growing adds the condition
    of highest gain in information until the rule is pure or full; pruning keeps the first
    conditions that do best on the other third. Covering ends when a pruned rule is
    right on fewer than ``min_precision`` of its pruning rows, or meets less than
    ``min_cover`` bad rows: what no sure rule covers stays.
    """
    names = list(STATISTICS)
    rows = labelled.select(
        "bad",
        (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 0).alias("grow"),
        *[c for c in labelled.columns if c.startswith("n_") or c == "word_chars"],
    )
    quantiles = F.array(*[F.lit((k + 1) / (cuts + 1)) for k in range(cuts)])
    edges = rows.agg(
        *[F.percentile_approx(F.expr(STATISTICS[s]), quantiles, 1000).alias(s) for s in names]
    ).first()
    # Cut points of the bad rows too: what only they have can lie beyond every quantile of all.
    bad_edges = rows.filter("bad = 1").agg(
        *[F.percentile_approx(F.expr(STATISTICS[s]), quantiles, 1000).alias(s) for s in names]
    ).first()
    points = {
        s: sorted({float(x) for e in (edges, bad_edges) for x in (e[s] or [])}) for s in names
    }
    if not any(points.values()):
        return []
    bins = F.array(*[
        F.struct(
            F.lit(k).alias("statistic"),
            F.size(
                F.filter(F.array(*map(F.lit, points[s])), lambda p: p <= F.expr(STATISTICS[s]))
            ).alias("bin"),
        )
        for k, s in enumerate(names)
        if points[s]
    ])
    rows = stage(rows.withColumn("bins", bins), "quality-labelled")

    rules: list[Rule] = []
    while len(rules) < max_rules:
        left = rows.filter(~_any(rules))
        rule: Rule = ()
        while len(rule) < max_conditions:
            counted = (
                left.filter("grow").filter(_all(rule))
                .select("bad", F.explode("bins").alias("x"))
                .groupBy("x.statistic", "x.bin").agg(F.sum("bad").alias("p"), F.count("*").alias("n"))
                .collect()
            )  # at most statistics x (2 cuts + 1) rows
            found = _best(counted, names, points)
            if found is None:
                break
            rule += (found,)
        if not rule:
            break
        tested = left.filter("NOT grow").agg(
            *[
                F.struct(
                    F.sum(F.when(_all(rule[: k + 1]), F.col("bad"))).alias("p"),
                    F.sum(F.when(_all(rule[: k + 1]), 1)).alias("n"),
                )
                for k in range(len(rule))
            ]
        ).first()
        scores = [((2 * (t.p or 0) - (t.n or 0)) / max(t.n or 0, 1), t.p or 0, t.n or 0, -k)
                  for k, t in enumerate(tested)]
        _, p, n, k = max(scores)
        if p < min_cover or p < min_precision * n:
            break
        rules.append(rule[: 1 - k])
    return rules


def _best(counted: list, names: list[str], points: dict[str, list[float]]) -> Condition | None:
    """The condition of highest FOIL gain, by counts for each statistic and bin."""
    by: dict[int, dict[int, tuple[int, int]]] = {}
    for r in counted:
        by.setdefault(r.statistic, {})[r.bin] = (int(r.p), int(r.n))
    best, most = None, 1e-6
    for k, bins in sorted(by.items()):
        p_all, n_all = (sum(x[j] for x in bins.values()) for j in (0, 1))
        if not 0 < p_all < n_all:
            return None
        p_low = n_low = 0
        for i, bound in enumerate(points[names[k]]):
            p, n = bins.get(i, (0, 0))
            p_low, n_low = p_low + p, n_low + n
            for above, p, n in ((False, p_low, n_low), (True, p_all - p_low, n_all - n_low)):
                if p and n < n_all:
                    gain = p * (math.log2(p / n) - math.log2(p_all / n_all))
                    if gain > most:
                        best, most = Condition(names[k], above, bound), gain
    return best


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one ordered conditional: the number of the first rule that
    rejects (0 is the base rule), or null for rows to keep."""
    out = F.when(base_failed(), F.lit(0))
    for k, rule in enumerate(rules, 1):
        out = out.when(_all(rule), F.lit(k))
    return out


def labelled_statistics(statistics: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of labelled documents that pass the base rule, with ``bad``."""
    bad = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id").agg((1 - F.min("quality")).cast("long").alias("bad"))
    )
    return statistics.filter(~base_failed()).join(bad, "doc_id")


def judge(docs: DataFrame, labels: DataFrame, *keep: str, **learning) -> tuple[DataFrame, list[Rule]]:
    """Base statistics of every document with ``base_failed``, ``rule`` and ``kept``, and
    the rules. ``keep`` are further columns of ``docs`` to hold on to."""
    statistics = stage(base_statistics(docs, "doc_id", *keep), "quality-statistics")
    rules = learn_rules(labelled_statistics(statistics, labels), **learning)
    rule = verdict(rules)
    return (
        statistics.withColumn("base_failed", base_failed()).withColumn("rule", rule)
        .withColumn("kept", F.col("rule").isNull()),
        rules,
    )


def apply_rules(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns, without a shuffle.

    Rows go through an array of one or nothing, as the optimizer would move a filter below
    the statistics, and write out their definitions in it again and again.
    """
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text"))
    judged = base_statistics(rows, "row")
    once = F.when(verdict(rules).isNull(), F.array(F.col("row")))
    return judged.select(F.explode(once).alias("row")).select("row.*")
