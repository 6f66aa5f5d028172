"""Mixing sources to target weights: soft domain membership and nonnegative document rates.

1. **Posteriors.** A labelled table trains naive Bayes over three discrete features: how many
   distinct words of the ``toxic`` and of the ``poor`` lexicon a text has, and its share of
   symbol characters. Lexicons are the words that tell a domain from the others best among
   at most ``LABELLED`` labelled documents, a fixed bound; they and the counts by feature and
   domain are aggregations of bounded size. Each document is then scored on its own row.
2. **Rates.** Document ``i`` with ``t_i`` tokens and posterior ``p_ik`` gets a rate
   ``r_i >= 0`` so that the expected tokens of each domain, ``sum_i r_i t_i p_ik``, come to
   the target share of the total. The least squares problem in all rates, with residuals
   relative to their targets, is solved by projected gradient from ``r = 1``: a round is one
   aggregation (the residual of each domain) and one column expression (a step, then the
   larger of it and zero). The step of a document is one over its row sum in the Gram matrix of
   all rates, which bounds that matrix from above: it is the mean of its domains' expected tokens
   over their targets, weighted by its posterior. So small and large domains, long and short
   documents settle alike, and a document of a domain that is on target stays as it is. Steps start from
   points beyond the last rates (Nesterov's momentum, begun anew when it leads uphill). Targets that
   no rates can meet end in the rates that come closest; ``solve`` returns how far off they are, and
   ``mix`` warns of it. Rounds that end without either are an error.
3. **Copies.** A document is taken ``floor(r)`` times, once more with the probability of the
   rest, decided by a hash of its id: the same on every run and after lost executors.

The total is what makes the tokens of the domain ``whole`` come to their target share as
they are, so that documents of that domain are kept and the others are thinned or
repeated around them. All of it is DataFrame functions; the driver sees counts by feature
and sums by domain, and nothing else.

Tokens are words here, runs of anything but the six ASCII white-space characters, counted JVM-side.

Defined results: a null, empty or blank text has no tokens, the posteriors of a text without
lexicon words, and rate 1, as it moves no total. Without labels every posterior is equal. Repeated
rows are documents of their own, with equal rates. Of several labels of one document the
smallest quality and the largest toxic count. Further columns stay as they are.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scdstar.llm.common import words
from scdstar.session import stage

#: Bound on the labelled documents that train the classifier; those of the least id hash.
LABELLED = 20_000
#: Words of a lexicon, and the labelled documents that a word must occur in.
LEXICON, SUPPORT = 64, 5
#: Bounds between the levels of the share of symbol characters.
SYMBOL_LEVELS = (0.002, 0.02, 0.05)
#: Lexicon words from which on their number makes no difference.
MOST_HITS = 3
#: A residual, relative to its target, that is worth a warning.
FAR = 0.01
#: Domains and their target share of expected tokens.
TARGETS = {"good": 0.88, "poor": 0.05, "toxic": 0.07}
#: The domain whose tokens set the total.
WHOLE = "good"


def domain_labels(labels: DataFrame) -> DataFrame:
    """``(doc_id, domain)`` of the labelled table: toxic, else poor, else good."""
    return (
        labels.filter("doc_id IS NOT NULL").groupBy("doc_id")
        .agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
        .select("doc_id", F.expr(
            "CASE WHEN t = 1 THEN 'toxic' WHEN q = 0 THEN 'poor' WHEN q = 1 THEN 'good' END"
        ).alias("domain"))
        .filter("domain IS NOT NULL")
    )


def lexicon(known: DataFrame, domain: str) -> list[str]:
    """The words of highest log odds for ``domain`` in ``known(domain, w)``, at most LEXICON."""
    mine = F.col("domain") == domain
    size = known.agg(F.count(F.when(mine, 1)).alias("a"), F.count(F.when(~mine, 1)).alias("b")).first()
    odds = (
        known.select(mine.alias("mine"), F.explode(F.array_distinct("w")).alias("word"))
        .filter("length(word) > 1").groupBy("word")
        .agg(F.count(F.when(F.col("mine"), 1)).alias("a"), F.count("*").alias("n"))
        .filter(f"a >= {SUPPORT}")
        .withColumn("odds", F.log((F.col("a") + 0.5) / (size["a"] + 1.0))
                    - F.log((F.col("n") - F.col("a") + 0.5) / (size["b"] + 1.0)))
        .filter(f"odds > {math.log(4)}")
        .orderBy(F.desc(F.col("odds") * F.sqrt("a")), "word").limit(LEXICON)
    )
    return [r.word for r in odds.select("word").collect()]


def features(docs: DataFrame, lexicons: list[list[str]]) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``f``, an array of levels: one for each lexicon, then
    the symbols."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct(*docs.columns).alias("row"), text.alias("t"), words(F.lower(F.col("text"))).alias("w"))
    share = F.regexp_count("t", F.lit(r"[#*$%&|!<>]")) / F.greatest(F.length("t"), F.lit(1))
    hits = [
        F.least(F.lit(MOST_HITS), F.size(F.array_intersect("w", F.array(*map(F.lit, chosen)))))
        if chosen else F.lit(0)
        for chosen in lexicons
    ]
    level = F.size(F.filter(F.array(*map(F.lit, SYMBOL_LEVELS)), lambda b: b <= F.col("share")))
    return rows.withColumn("share", share).select(
        "row.*", F.size("w").cast("long").alias("n_tokens"),
        F.array(*hits, level).alias("f"),
    )


def train(docs: DataFrame, labelled: DataFrame, domains: list[str]):
    """Lexicons, log priors, and log likelihoods as ``tables[domain][feature][level]``."""
    chosen = labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED)
    known = stage(docs.select("doc_id", "text").join(chosen, "doc_id"), "mixing-labelled")
    counted = dict(known.groupBy("domain").count().collect())
    held = known.select("domain", words(F.lower(F.col("text"))).alias("w"))
    lexicons = [lexicon(held, d) for d in domains if d != WHOLE]
    by_level = (
        features(known, lexicons).select("domain", F.posexplode("f").alias("feature", "level"))
        .groupBy("domain", "feature", "level").count().collect()
    )  # domains x features x levels
    levels = [MOST_HITS + 1] * len(lexicons) + [len(SYMBOL_LEVELS) + 1]
    seen = {(r.domain, r.feature, r.level): r["count"] for r in by_level}
    total = sum(counted.get(d, 0) + 1 for d in domains)
    priors = [math.log((counted.get(d, 0) + 1) / total) for d in domains]
    tables = [
        [
            [math.log((seen.get((d, k, v), 0) + 0.5) / (counted.get(d, 0) + 0.5 * n)) for v in range(n)]
            for k, n in enumerate(levels)
        ]
        for d in domains
    ]
    return lexicons, priors, tables


def posteriors(docs: DataFrame, model) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``p``, posteriors in the order of the domains."""
    lexicons, priors, tables = model
    rows = features(docs, lexicons)
    scores = [
        " + ".join([f"{prior!r}D"] + [
            f"element_at(array({', '.join(f'{x!r}D' for x in column)}), f[{k}] + 1)"
            for k, column in enumerate(table)
        ])
        for prior, table in zip(priors, tables)
    ]
    rows = rows.withColumn("e", F.expr(f"transform(array({', '.join(scores)}), x -> exp(x))"))
    rows = rows.withColumn("all", F.expr("aggregate(e, 0D, (a, x) -> a + x)"))
    return rows.withColumn("p", F.expr("transform(e, x -> x / all)")).drop("e", "all", "f")


def _dot(weights: list[float]) -> str:
    return " + ".join(f"p[{k}] * {w!r}D" for k, w in enumerate(weights))


def fit_rates(
    scored: DataFrame, weights: list[float], whole: int, rounds: int = 500,
    tolerance: float = 1e-3, every: int = 10,
) -> tuple[DataFrame, list[float]]:
    """``scored(n_tokens, p, ...)`` with ``rate``, and the residual of each domain, relative to its
    target. It ends when all are within ``tolerance``, or a step moves the rates of no domain by more
    than a hundredth of it on average; ``ArithmeticError`` if neither comes about. Rates are written every few rounds,
    which bounds the depth of expressions."""
    start = {"rate": F.lit(1.0), "ahead": F.lit(1.0), "moved": F.lit(0.0)}
    scored = stage(scored.withColumns(start), "mixing-rates")
    size, share = len(weights), sum(weights)
    target = [max(w / share, 1e-3) for w in weights]
    first = scored.agg(
        *[F.sum(F.expr(f"n_tokens * p[{k}]")).alias(f"t{k}") for k in range(size)]
    ).first()
    tokens = [first[f"t{k}"] or 0.0 for k in range(size)]
    if not tokens[whole]:
        return scored.drop("ahead", "moved"), [0.0] * size
    total = tokens[whole] / target[whole]
    curve = _dot([n / total / t for n, t in zip(tokens, target)])
    momentum, last = 1.0, math.inf
    for done in range(rounds):
        sums = scored.agg(*[
            F.sum(F.expr(f"{name} * n_tokens * p[{k}]")).alias(f"{name}{k}")
            for name in ("rate", "ahead", "moved") for k in range(size)
        ]).first()
        off, lead = (
            [sums[f"{name}{k}"] / total / target[k] - 1 for k in range(size)] for name in ("rate", "ahead")
        )
        moved = max(sums[f"moved{k}"] / tokens[k] if tokens[k] else 0.0 for k in range(size))
        if max(map(abs, off)) <= tolerance or (done and moved <= tolerance / 100):
            break
        value = sum(t * x * x for t, x in zip(target, off))
        base, slope = "ahead", lead
        if value > last:
            base, slope, momentum = "rate", off, 1.0
        last, following = value, (1 + math.sqrt(1 + 4 * momentum * momentum)) / 2
        carry, momentum = (momentum - 1) / following, following
        scored = scored.withColumn("new", F.expr(
            f"CASE WHEN n_tokens = 0 THEN 1D ELSE greatest(0D, {base} - ({_dot(slope)}) / ({curve})) END"
        )).withColumns({
            "rate": F.col("new"), "ahead": F.expr(f"new + {carry!r}D * (new - rate)"),
            "moved": F.expr(f"abs(new - {base})"),
        }).drop("new")
        if done % every == every - 1:
            scored = stage(scored, "mixing-rates")
    else:
        raise ArithmeticError(f"rates do not settle in {rounds} rounds; residuals {off}")
    return stage(scored.drop("ahead", "moved"), "mixing-rates"), off


def with_copies(rated: DataFrame) -> DataFrame:
    """``rated`` with ``copies``: how often each document is taken."""
    draw = F.pmod(F.xxhash64(F.lit("mixing"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    return rated.withColumn("copies", F.floor(F.col("rate") + draw).cast("int"))


def solve(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None
) -> tuple[DataFrame, dict[str, float]]:
    """One row per row of ``docs(doc_id, text)``: ``doc_id``, ``n_tokens``, ``p``, ``rate``
    and ``copies``; and by domain how far its expected tokens are off, relative to its target.
    ``targets`` has the domains with their shares."""
    targets = targets or TARGETS
    domains = sorted(targets)
    labelled = domain_labels(labels).filter(F.col("domain").isin(domains))
    model = train(docs, labelled, domains)
    scored = posteriors(docs.select("doc_id", "text"), model).drop("text")
    rated, off = fit_rates(scored, [float(targets[d]) for d in domains], domains.index(WHOLE))
    return with_copies(rated), dict(zip(domains, off))


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """The rows of ``solve``, with a warning if a target is missed by over ``FAR``."""
    mixed, off = solve(docs, labels, targets)
    missed = {d: round(x, 3) for d, x in off.items() if abs(x) > FAR}
    if missed:
        warnings.warn(f"mixing misses targets; relative residuals {missed}", stacklevel=2)
    return mixed


def take(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as its copies say, with the columns of ``docs``."""
    times = mix(docs, labels, targets).groupBy("doc_id").agg(F.max("copies").alias("times"))
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    joined = rows.join(times, F.col("row.doc_id").eqNullSafe(times["doc_id"])).filter("times > 0")
    return joined.select("row", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")
