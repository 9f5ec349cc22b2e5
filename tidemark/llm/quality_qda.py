"""Quality classifier: regularised quadratic discriminant over document statistics.

Each class has a mean and a covariance, S_c' = (1 - a - b) S_c + a S + b diag(v),
shrunk to the pooled covariance S and to its diagonal. A document's score is the
logistic function of the difference of the two Gaussian log-densities, by Cholesky
factors computed once, plus the log prior odds; it is tempered by 1/TEMPER, since
statistics of one text are not independent.

The fit uses every labelled row: only class counts, sums and sums of products
leave the executors. Labels are taken per doc_id by majority (even: 1). Without
two classes of two rows every score is one half. Null and empty texts are
scored by their zero statistics, null doc_ids too; neither repeated rows nor
extra columns matter. Very long texts are scored whole, ties alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.doc_stats import document_counts
from tidemark.llm.store import save

SHRINK_POOLED, SHRINK_DIAGONAL = 0.05, 0.05
FLOOR = 1e-4
TEMPER = 3.0
CUT = 0.3
_BIG = 60.0

#: Transformed statistics, each SQL over the counts and bounded.
FEATURES = {
    "x_words": "ln(1 + n_words)",
    "x_word_chars": "ln(1 + word_chars / greatest(n_words, 1))",
    "x_symbols": "sqrt(n_symbols / greatest(word_chars, 1))",
    "x_upper": "sqrt(n_upper / greatest(n_upper + n_lower, 1))",
    "x_digits": "sqrt(n_digits / greatest(word_chars, 1))",
    "x_bangs": "sqrt(n_bangs / greatest(n_words, 1))",
    "x_bars": "sqrt(n_bars / greatest(n_words, 1))",
    "x_stops": "sqrt(n_stops / greatest(n_words, 1))",
    "x_high": "sqrt(n_high / greatest(word_chars, 1))",
    "x_repeats": "sqrt(n_repeat_words / greatest(n_words, 1))",
    "x_same": "sqrt(n_same_next / greatest(n_words, 1))",
    "x_distinct": "n_distinct / greatest(n_words, 1)",
    "x_dup_lines": "sqrt(n_dup_lines / greatest(n_lines, 1))",
    "x_lines": "sqrt(n_lines / greatest(n_words, 1))",
}


@dataclass
class Model:
    prior: float
    means: list[list[float]]
    #: Rows of the inverse Cholesky factor of each class, and half its log-determinant.
    whiten: list[list[list[float]]]
    half_logdet: list[float]


def with_features(counts: DataFrame) -> DataFrame:
    return counts.selectExpr("*", *(f"cast({e} as double) as {n}" for n, e in FEATURES.items()))


def majority(labels: DataFrame, column: str) -> DataFrame:
    """One label (doc_id, y) per document; nulls don't count."""
    return labels.where(f"doc_id is not null and {column} is not null").groupBy("doc_id").agg((F.avg(column) >= 0.5).cast("int").alias("y"))


def fit(rows: DataFrame) -> Model | None:
    """Fit on rows with the features and y, 0 or 1."""
    names = list(FEATURES)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    # sums of products are taken about the mean of all rows, for precision
    about = [float(x or 0) for x in rows.agg(*(F.avg(n) for n in names)).first()]
    centred = rows.select("y", *((F.col(n) - F.lit(x)).alias(n) for n, x in zip(names, about, strict=True)))
    aggs = [F.count(F.lit(1)), *(F.sum(n) for n in names), *(F.sum(F.col(a) * F.col(b)) for a, b in pairs)]
    found = {r[0]: r[1:] for r in centred.groupBy("y").agg(*aggs).collect()}
    if any(found.get(c, (0,))[0] < 2 for c in (0, 1)):
        return None
    d, means, covs, n = len(names), [], [], []
    for c in (0, 1):
        r = found[c]
        mean = np.array(r[1 : d + 1]) / r[0]
        second = np.zeros((d, d))
        for (a, b), v in zip(pairs, r[d + 1 :], strict=True):
            i, j = names.index(a), names.index(b)
            second[i, j] = second[j, i] = v / r[0]
        means.append(mean + np.array(about))
        covs.append(second - np.outer(mean, mean))
        n.append(r[0])
    pooled = (covs[0] * n[0] + covs[1] * n[1]) / sum(n)
    whiten, half = [], []
    for c in (0, 1):
        s = (1 - SHRINK_POOLED - SHRINK_DIAGONAL) * covs[c] + SHRINK_POOLED * pooled + SHRINK_DIAGONAL * np.diag(np.diag(pooled)) + FLOOR * np.eye(d)
        chol = np.linalg.cholesky(s)
        whiten.append(np.linalg.inv(chol).tolist())
        half.append(float(np.log(np.diag(chol)).sum()))
    return Model(float(np.log(n[1] / n[0])), [m.tolist() for m in means], whiten, half)


def score_column(model: Model | None) -> Column:
    """Probability of label 1 from the feature columns."""
    if model is None:
        return F.lit(0.5)
    names = list(FEATURES)

    def density(c: int) -> str:
        parts = []
        for i, row in enumerate(model.whiten[c]):
            terms = " + ".join(f"({row[j]!r}) * ({names[j]} - ({model.means[c][j]!r}))" for j in range(i + 1))
            parts.append(f"pow({terms}, 2)")
        return f"({-model.half_logdet[c]!r} - 0.5D * ({' + '.join(parts)}))"

    odds = f"({model.prior!r} + ({density(1)} - {density(0)}) / {TEMPER!r})"
    return F.expr(f"1 / (1 + exp(-greatest({-_BIG!r}, least({_BIG!r}, {odds}))))")


def score_quality(docs: DataFrame, labels: DataFrame, learn_from: Column | None = None, label: str = "quality") -> DataFrame:
    """(doc_id, score, predicted) for every row of ``docs``; ``learn_from`` selects the rows labels may be used of."""
    rows = save(with_features(document_counts(docs.select("doc_id", "text"))).select("doc_id", *FEATURES), "features")
    learned = rows if learn_from is None else rows.where(learn_from)
    model = fit(learned.join(majority(labels, label), "doc_id"))
    return rows.select("doc_id", score_column(model).alias("score")).withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, learn_from: Column | None = None, label: str = "quality", cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` that score ``cut`` or more, unchanged; texts are not shuffled."""
    rows = save(with_features(document_counts(docs.select("doc_id", "text"))).select("doc_id", *FEATURES), "features")
    learned = rows if learn_from is None else rows.where(learn_from)
    model = fit(learned.join(majority(labels, label), "doc_id"))
    whole = docs.select(F.struct(*docs.columns).alias("_row"), F.col("text").alias("_text"))
    scored = with_features(document_counts(whole, "_text", ["_row"]))
    return scored.where(score_column(model) >= cut).select("_row.*")
