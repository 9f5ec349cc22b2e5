"""Quality rules with risk-controlled cutoffs.

Each rule rejects a document whose statistic lies beyond a cutoff; the verdict of
a document is that of all rules together, and it is the verdict whose false
rejections are bounded. Labelled documents that pass the base rules are split by a
hash of their ids. On the smaller part, in every stratum (a language), cutoffs are
tightened one move at a time, each the one that rejects most documents labelled bad
for those labelled good, which gives a path from lenient to strict. On the held-out
part the path is tested from its start: a place on it is certified if, were the
true rate of false rejections by the verdict above RISK, so few good documents
rejected by any rule would have probability LEVEL / m at most, by the exact
binomial tail; m counts the strata. As the number of rejections can only grow along
the path, testing stops at the first place that fails, and a stratum's whole path
costs one test. The strictest certified place is taken. With probability 1 - LEVEL
no stratum loses more than RISK of its good documents to the verdict.

A stratum whose held-out good documents could not certify anything even without one
rejection joins a pool of such strata, the smallest strata first, until the pool has
enough; the bound then holds for the pool as one stratum. Pooling looks at numbers of
labels only. A stratum without any label keeps all, and so does a pool that stays
too small.

Labels by majority of a doc_id's rows. A null language is a stratum. Null and
empty texts have zero counts and fail the base rule for short texts. Repeated
rows are judged alike, ties by whole steps of a statistic. Very long texts are
counted whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.doc_stats import document_counts
from tidemark.llm.quality_qda import majority
from tidemark.llm.store import save

RISK = 0.01
LEVEL = 0.05
#: One in so many labelled documents shapes the paths, the others certify.
SHAPING = 3
#: A move must reject at least so many times the share of bad documents as of good ones.
WORTH = 10.0
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Statistic as SQL over the counts; larger is worse. All lie between 0 and 1.
RULES = {
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "bangs": "least(1D, n_bangs / greatest(n_words, 1))",
    "upper": "n_upper / greatest(n_upper + n_lower, 1)",
    "same_next": "n_same_next / greatest(n_words, 1)",
    "unended": "1 - least(1D, 10 * n_stops / greatest(n_words, 1))",
}
#: Cutoffs i / STEPS, from the most lenient, 1, downwards.
STEPS = 50
#: Of documents by (rule, label): numbers by step, the least s with statistic <= s / STEPS.
Counts = dict[tuple[str, int], list[int]]


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X of n trials of probability p."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def least_labels(level: float, risk: float = RISK) -> int:
    """Good documents without which not even no rejection at all certifies."""
    return math.ceil(math.log(level) / math.log1p(-risk))


def pool(good: dict[str | None, int], level: float = LEVEL, risk: float = RISK) -> tuple[list, list]:
    """Strata on their own, and those that are pooled, from numbers of held-out good documents."""
    alone = sorted(good, key=lambda s: (-good[s], s is None, s or ""))
    pooled: list = []
    while alone:
        groups = len(alone) + bool(pooled)
        enough = least_labels(level / groups, risk)
        if good[alone[-1]] >= enough and (not pooled or sum(good[s] for s in pooled) >= enough):
            break
        pooled.append(alone.pop())
    return alone, pooled


def path(counts: Counts, worth: float = WORTH) -> list[tuple[str, int]]:
    """Moves (rule, new cutoff's step), most worthwhile first; each rejects documents labelled bad."""
    total = {y: max((sum(c) for (_, label), c in counts.items() if label == y), default=0) for y in (0, 1)}
    if not total[0] or not total[1]:
        return []
    # above[rule][y][i]: documents beyond i / STEPS
    above = {r: {y: [sum(counts.get((r, y), [0] * (STEPS + 1))[i + 1 :]) for i in range(STEPS + 1)] for y in (0, 1)} for r in {r for r, _ in counts}}
    at, moves = dict.fromkeys(sorted(above), STEPS), []
    while True:
        found = []
        for r, now in at.items():
            for i in range(now):
                bad, good = (above[r][y][i] - above[r][y][now] for y in (0, 1))
                if bad and bad / total[0] >= worth * good / total[1]:
                    found.append((bad / total[0] / (good + 0.5), bad, r, i))
        if not found:
            return moves
        best = max(f[:2] for f in found)
        rule = min(f[2] for f in found if f[:2] == best)
        equal = sorted(f[3] for f in found if f[:2] == best and f[2] == rule)
        i = equal[(len(equal) - 1) // 2]
        at[rule] = i
        moves.append((rule, i))


def certify(rejected: list[int], n: int, level: float, risk: float = RISK) -> int:
    """Moves of a path that are certified; rejected[p]: good documents of n that the first p + 1 moves reject."""
    for p, k in enumerate(rejected):
        if k > n * risk or binomial_tail(k, n, risk) > level:
            return p
    return len(rejected)


def _rejected_by(moves: list[tuple[str, int]]) -> Column:
    """The first move of a path that rejects a row, from 1; a larger number where none does."""
    never = len(moves) + 1
    places = []
    for r in RULES:
        first = [next((p for p, (rule, i) in enumerate(moves, 1) if rule == r and s > i), never) for s in range(STEPS + 1)]
        if min(first) < never:
            places.append(f"element_at(array({', '.join(map(str, first))}), s_{r} + 1)")
    return F.expr(f"least({', '.join([str(never), *places])})") if places else F.lit(never)


def _in(strata: list) -> Column:
    return F.col("stratum").isin([s for s in strata if s is not None]) & F.col("stratum").isNotNull() | (F.col("stratum").isNull() if None in strata else F.lit(False))


def certified_paths(rows: DataFrame) -> list[tuple[list, list[tuple[str, int]]]]:
    """(strata, certified moves) for each stratum or pool, from labelled rows (doc_id, stratum, s_..., y)."""
    rows = rows.withColumn("shaping", F.expr(f"pmod(xxhash64(doc_id), {SHAPING}) = 0"))
    stack = ", ".join(f"'{r}', s_{r}" for r in RULES)
    cells = rows.selectExpr("stratum", "y", "shaping", f"stack({len(RULES)}, {stack}) as (rule, s)").groupBy("stratum", "y", "shaping", "rule", "s").count().collect()
    good: dict = {}
    for stratum, y, shaping, rule, _, c in cells:
        if rule == next(iter(RULES)):
            good[stratum] = good.get(stratum, 0) + (c if y == 1 and not shaping else 0)
    alone, pooled = pool(good)
    groups = [[s] for s in alone] + ([pooled] if pooled else [])
    paths = []
    for strata in groups:
        counts: Counts = {}
        for stratum, y, shaping, rule, s, c in cells:
            if shaping and stratum in strata:
                counts.setdefault((rule, y), [0] * (STEPS + 1))[s] += c
        paths.append(path(counts))
    if not any(paths):
        return []
    group, place = F.lit(-1), F.lit(0)
    for g, (strata, moves) in enumerate(zip(groups, paths, strict=True)):
        group = F.when(_in(strata), g).otherwise(group)
        place = F.when(_in(strata), _rejected_by(moves)).otherwise(place)
    held = rows.where("not shaping and y = 1").select(group.alias("g"), place.alias("p")).groupBy("g", "p").count().collect()
    out = []
    for g, (strata, moves) in enumerate(zip(groups, paths, strict=True)):
        at = {r[1]: r[2] for r in held if r[0] == g}
        rejected = [sum(c for p, c in at.items() if p <= x) for x in range(1, len(moves) + 1)]
        out.append((strata, moves[: certify(rejected, sum(at.values()), LEVEL / len(groups))]))
    return out


def apply_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", label: str = "quality") -> DataFrame:
    """(doc_id, the base counts, base_failed, failed_rules, kept) for every row of ``docs``."""
    counts = document_counts(docs.select("doc_id", F.col(stratum).alias("stratum"), "text"))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    steps = (F.expr(f"cast(least({STEPS}, greatest(0, ceil(({e}) * {STEPS}))) as int)").alias(f"s_{r}") for r, e in RULES.items())
    rows = save(counts.select("doc_id", "stratum", *BASE, base.alias("base_failed"), *steps), "rule-stats")
    chosen = certified_paths(rows.where("not base_failed").join(majority(labels, label), "doc_id"))
    failed = []
    for r in RULES:
        test = F.lit(False)
        for strata, moves in chosen:
            if cut := [i for rule, i in moves if rule == r]:
                test = test | (_in(strata) & (F.col(f"s_{r}") > min(cut)))
        failed.append(F.when(test, F.lit(r)))
    judged = rows.withColumn("failed_rules", F.array_compact(F.array(*failed)))
    return judged.select("doc_id", *BASE, "base_failed", "failed_rules", (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"))
