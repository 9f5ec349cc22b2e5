"""URL filters: longest-match rules, then gradient-boosted trees on lexical features.

Rules are (host, path prefix, verdict). A rule fits its host and all subdomains
where the path starts with the rule's path; the longest rule wins. URLs that no
rule fits are judged by boosted trees of depth two, trained on the URLs that a
rule labels, both labels weighing the same in all. Features are the shape of the
URL, and how often URLs with its host's last label, and with its path's first
part, are labelled block. A labelled URL learns these shares from the other folds
only (folds by a hash of the URL), so that no label shows in its own features.
Every boosting step is one aggregation of gradients by (feature, bin) over a table
of distinct binned feature rows; the trees become one SQL expression, so scoring
stays inside code generation. ``block_score`` is the probability of a block were
both labels equally frequent; 0.5 or more is a block.

A null URL, or one without ``://``, has an empty host and path, fits no rule
and is judged like any other by its features, which are those of an empty
string when null. With no labelled URL, or labels of one kind, every score is
the prior's. Repeated rows, and URLs with equal features, are judged alike. Very
long URLs are judged whole, in time linear in their length.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import save

RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
ROUNDS = 10
RATE = 0.3
BINS = 16
#: L2 penalty on leaf values, and the least hessian weight of a leaf.
PENALTY, LEAST = 1.0, 1.0
#: Folds of labelled URLs, and how many labels the prior weighs in a share.
FOLDS, PRIOR = 5, 4.0
#: Rows (part, fold, share) that may be broadcast, about 60 bytes each.
BROADCAST_SHARES = 50_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Parts of a URL whose labels are counted.
PARTS = ("suffix", "segment")
FEATURES = ("length", "host_length", "host_depth", "depth", "digit_ratio", "entropy", "parameters", *(f"{p}_{x}" for p in PARTS for x in ("rate", "count")))


def with_parts(pages: DataFrame) -> DataFrame:
    url = F.coalesce("url", F.lit(""))
    whole = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, whole, 1), UPPER, LOWER)
    return pages.withColumn("host", host).withColumn("path", F.regexp_extract(url, whole, 2))


def rule_for(rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text, and its verdict; null where none fits."""
    rule = verdict = None
    for host, path, says in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, host + path) if rule is None else rule.when(fits, host + path)
        verdict = F.when(fits, says) if verdict is None else verdict.when(fits, says)
    return rule, verdict


def _lexical(pages: DataFrame) -> DataFrame:
    url = "coalesce(url, '')"
    entropy = f"""aggregate(array_distinct(split({url}, '')), 0D, (a, c) -> a - if(c = '', 0D,
        (length({url}) - length(replace({url}, c, ''))) / length({url}) * log2((length({url}) - length(replace({url}, c, ''))) / length({url}))))"""
    return pages.selectExpr(
        "*",
        f"cast(length({url}) as double) as length",
        "cast(length(host) as double) as host_length",
        "cast(length(path) - length(replace(path, '/', '')) as double) as depth",
        f"if(length({url}) = 0, 0D, length(regexp_replace({url}, '[^0-9]', '')) / length({url})) as digit_ratio",
        f"{entropy} as entropy",
        f"cast(if(instr({url}, '?') = 0, 0, 1 + length(substring_index({url}, '#', 1)) - length(replace(substring_index({url}, '#', 1), '&', ''))) as double) as parameters",
        "cast(length(host) - length(replace(host, '.', '')) as double) as host_depth",
        "substring_index(host, '.', -1) as suffix",
        "split_part(path, '/', 2) as segment",
        f"pmod(xxhash64({url}), {FOLDS}) as fold",
    )


def _shares(labelled: DataFrame, part: str) -> DataFrame:
    """Share of blocked among the labelled URLs with a part, drawn to one half, and their number's logarithm.

    A row for each fold, of the labels outside it, and one of all for fold -1.
    """
    by_fold = labelled.groupBy(F.col(part).alias("_part"), "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("blocked"))
    whole = by_fold.groupBy("_part").agg(F.sum("n").alias("_n"), F.sum("blocked").alias("_blocked"))
    without = by_fold.join(whole, "_part").selectExpr("_part", "fold", "_n - n as n", "_blocked - blocked as blocked")
    both = without.unionByName(whole.selectExpr("_part", "-1L as fold", "_n as n", "_blocked as blocked"))
    return both.selectExpr("_part", "fold as _fold", f"(blocked + {PRIOR / 2}) / (n + {PRIOR}) as {part}_rate", f"ln(1 + n) as {part}_count")


def _with_shares(rows: DataFrame, tables: dict[str, tuple[DataFrame, int]], fold: Column) -> DataFrame:
    for part, (table, n) in tables.items():
        right = F.broadcast(table) if n <= BROADCAST_SHARES else table
        rows = rows.join(right, (F.col(part) == F.col("_part")) & (fold == F.col("_fold")), "left").drop("_part", "_fold")
        rows = rows.fillna({f"{part}_rate": 0.5, f"{part}_count": 0.0})
    return rows


def _bins(cuts: dict[str, list[float]]) -> list[Column]:
    made = []
    for f in FEATURES:
        b = F.lit(0)
        for c in cuts[f]:
            b = b + (F.col(f) > c).cast("int")
        made.append(b.alias(f"b_{f}"))
    return made


def _split(stats: dict[tuple[str, int], tuple[float, float]], cuts: dict[str, list[float]]):
    """The best (feature, bin): rows in bins up to it go left; None if no split gains."""
    best = None
    for f in FEATURES:
        g = [stats.get((f, b), (0.0, 0.0)) for b in range(len(cuts[f]) + 1)]
        gs, hs = sum(x[0] for x in g), sum(x[1] for x in g)
        gl = hl = 0.0
        for b, (dg, dh) in enumerate(g[:-1]):
            gl, hl = gl + dg, hl + dh
            if min(hl, hs - hl) < LEAST:
                continue
            gain = gl * gl / (hl + PENALTY) + (gs - gl) ** 2 / (hs - hl + PENALTY) - gs * gs / (hs + PENALTY)
            if gain > 1e-6 and (best is None or gain > best[0] + 1e-12):
                best = (gain, f, b, -gl / (hl + PENALTY), -(gs - gl) / (hs - hl + PENALTY))
    return best


def train(labelled: DataFrame) -> tuple[dict[str, list[float]], str]:
    """Bin limits, and the log-odds of a block as SQL over the binned features ``b_...``.

    ``labelled`` has the features and y, 1 for block.
    """
    quantiles = [i / BINS for i in range(1, BINS)]
    row = labelled.agg(*(F.percentile_approx(f, quantiles, 1000).alias(f) for f in FEATURES)).first()
    cuts = {f: sorted(set(row[f] or [])) for f in FEATURES}
    cells = save(labelled.select(*_bins(cuts), "y").groupBy(*(f"b_{f}" for f in FEATURES)).agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos")), "cells")
    total = cells.agg(F.sum("n"), F.sum("pos")).first()
    n, pos = total[0] or 0, total[1] or 0
    if not 0 < pos < n:
        return cuts, repr(math.log((pos + 1) / (n - pos + 1)))
    # both labels weigh as much as half of all rows
    score, w_pos, w_neg = "0D", n / (2 * pos), n / (2 * (n - pos))
    stack = ", ".join(f"'{f}', b_{f}" for f in FEATURES)

    def gradients(node: str) -> dict[str, dict[tuple[str, int], tuple[float, float]]]:
        p = f"(1 / (1 + exp(-({score}))))"
        weight = f"(pos * {w_pos!r}D + (n - pos) * {w_neg!r}D)"
        rows = cells.selectExpr(f"{weight} * {p} - pos * {w_pos!r}D as g", f"{weight} * {p} * (1 - {p}) as h", f"{node} as node", *(f"b_{f}" for f in FEATURES))
        found = rows.selectExpr("node", "g", "h", f"stack({len(FEATURES)}, {stack}) as (f, b)").groupBy("node", "f", "b").agg(F.sum("g"), F.sum("h")).collect()
        out: dict = {}
        for r in found:
            out.setdefault(r[0], {})[(r[1], r[2])] = (r[3], r[4])
        return out

    for _ in range(ROUNDS):
        top = _split(gradients("0").get(0, {}), cuts)
        if top is None:
            break
        _, f, b, left, right = top
        sides = gradients(f"if(b_{f} <= {b}, 0, 1)")
        leaves = []
        for side, value in ((0, left), (1, right)):
            s = _split(sides.get(side, {}), cuts)
            leaves.append(repr(RATE * value) if s is None else f"if(b_{s[1]} <= {s[2]}, {RATE * s[3]!r}, {RATE * s[4]!r})")
        score += f" + if(b_{f} <= {b}, {leaves[0]}, {leaves[1]})"
    return cuts, score


def filter_urls(pages: DataFrame, rules=RULES, learn: Column | None = None) -> DataFrame:
    """All columns of ``pages`` with host, path, rule, block_score and verdict; those names are replaced if there.

    ``learn``, over the url, tells which of the URLs that a rule labels are learned from; by default all are.
    """
    added = ("host", "path", "rule", "block_score", "verdict")
    pages = pages.drop(*added)
    rule, says = rule_for(rules)
    urls = pages.select("url") if learn is None else pages.select("url").where(learn)
    labelled = _lexical(with_parts(urls)).withColumn("_says", says).where("_says is not null").withColumn("y", (F.col("_says") == "block").cast("long"))
    tables = {}
    for part in PARTS:
        table = save(_shares(labelled, part), "shares")
        tables[part] = table, table.count()
    cuts, score = train(_with_shares(labelled, tables, F.col("fold")))
    # features get names of their own, so that no column of the table clashes
    kept = [F.col(f"in.{c}") for c in pages.columns]
    full = with_parts(pages.select(F.struct(*pages.columns).alias("in"), "url"))
    full = _with_shares(_lexical(full.withColumn("rule", rule).withColumn("_says", says)), tables, F.lit(-1))
    binned = full.select("in", "host", "path", "rule", "_says", *_bins(cuts))
    judged = binned.withColumn("block_score", F.expr(f"1 / (1 + exp(-({score})))"))
    verdict = F.coalesce("_says", F.when(F.col("block_score") >= 0.5, "block").otherwise("allow"))
    return judged.select(*kept, "host", "path", "rule", "block_score", verdict.alias("verdict"))
