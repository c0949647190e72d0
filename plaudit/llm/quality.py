"""Quality by hierarchical empirical Bayes.

A document's own evidence is a logistic regression on text statistics.  Where it was found
counts too: good and bad labelled documents per host and per path are shrunk, a path toward
its host and a host toward the global rate, by prior strengths that are estimated from the
spread of the sites.  The log odds of the evidence are moved by the log odds of the path's
posterior over those of the global rate.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from plaudit.llm.mixing import word_count
from plaudit.operators.sampling import sample_rows
from plaudit.session import cut_lineage


@dataclass(frozen=True)
class Fit:
    """fit_rows: most labelled rows the text model is fitted on, chosen by hash; the counts per site
    use all.  ridge: weight of the squared coefficients.  steps: Newton steps.
    """

    fit_rows: int = 30_000
    ridge: float = 1.0
    steps: int = 25
    seed: int = 3


def _share(text: Column, letters: str) -> Column:
    """Share of the characters that belong to a regular-expression class."""
    return F.regexp_count(text, F.lit(letters)) / F.greatest(F.char_length(text), F.lit(1))


def features(text: Column) -> list[Column]:
    """Statistics of a whole text; a null text is empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    length, words = F.char_length(text), word_count(text)
    repeated = F.regexp_count(text, F.lit(r"(?<![^\s])(\S+)\s+(?=\1(?!\S))"))
    return [
        F.log1p(length.cast("double")),
        F.log1p(words.cast("double")),
        length / (words + 1) / 10,
        F.sqrt(_share(text, r"[^\p{L}\p{N}\s.,]")),
        F.sqrt(_share(text, r"\p{Lu}")),
        F.sqrt(_share(text, r"[0-9]")),
        F.sqrt(_share(text, r"[|]")),
        F.sqrt(_share(text, r"[.,]")),
        F.sqrt(repeated / (words + 1)),
        F.log1p(length / (F.regexp_count(text, F.lit("\n")) + 1)),
    ]


def fit_evidence(rows: list, how: Fit) -> np.ndarray:
    """Ridge logistic regression by Newton steps on (label, features) rows: mean, scale and coefficients."""
    x, y = np.array([r["x"] for r in rows], float), np.array([r["label"] for r in rows], float)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = (x - mean) / scale
    z = np.column_stack([np.ones(len(z)), z, z**2])
    w = np.zeros(z.shape[1])
    penalty = np.full(len(w), how.ridge)
    penalty[0] = 1e-6
    for _ in range(how.steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty)
        move = np.linalg.solve(hessian, z.T @ (p - y) + penalty * w)
        w -= move / max(1.0, np.abs(move).max())
    return np.concatenate([mean, scale, w])


def evidence(x: list[Column], model: np.ndarray) -> Column:
    """Log odds of good quality from the features."""
    n = len(x)
    mean, scale, w = model[:n], model[n : 2 * n], model[2 * n :]
    total = F.lit(float(w[0]))
    for i, value in enumerate(x):
        z = (value - float(mean[i])) / float(scale[i])
        total = total + z * float(w[1 + i]) + z * z * float(w[1 + n + i])
    return F.greatest(F.lit(-30.0), F.least(F.lit(30.0), total))


def _strength(sites: DataFrame, prior: Column) -> float:
    """Pseudo-observations of the prior, by moments of the rates of sites that have `n` rows, `k` good.

    With no spread beyond chance the prior counts as 1,000 rows, with extreme spread as one.
    """
    rate = F.col("k") / F.col("n")
    chance = prior * (1 - prior)
    row = sites.agg(
        F.sum(F.col("n") * (rate - prior) ** 2).alias("spread"), F.sum(chance).alias("chance"),
        F.sum(F.col("n") * chance).alias("all"),
    ).first()
    if not row["all"]:
        return 1.0
    # E[spread] = chance + (all - chance) / (strength + 1), site by site.
    excess = (row["spread"] - row["chance"]) / max(row["all"] - row["chance"], 1e-9)
    return float(np.clip(1 / max(excess, 1e-9) - 1, 1.0, 1000.0))


def site_posteriors(labelled: DataFrame) -> tuple[DataFrame, DataFrame, float]:
    """Posterior rates per host and per (host, path) from rows of `host`, `path`, `label`; and the global rate.

    A null host or path is a site of its own.
    """
    paths = cut_lineage(labelled.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("k")), "sites")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    n, k = paths.agg(F.sum("n"), F.sum("k")).first()
    rate = ((k or 0) + 1) / ((n or 0) + 2)
    of_host = _strength(hosts, F.lit(rate))
    hosts = hosts.select("host", ((F.col("k") + of_host * rate) / (F.col("n") + of_host)).alias("host_rate"))
    joined = paths.withColumnRenamed("host", "h").join(hosts, F.col("h").eqNullSafe(F.col("host")))
    of_path = _strength(joined, F.col("host_rate"))
    paths = joined.select("host", "path", ((F.col("k") + of_path * F.col("host_rate")) / (F.col("n") + of_path)).alias("path_rate"))
    return hosts, paths, rate


def quality(docs: DataFrame, labels: DataFrame, held_out, id_column: str = "doc_id", text_column: str = "text",
            host_column: str = "source", path_column: str = "lang", how: Fit = Fit()) -> DataFrame:
    """Per row: id, `evidence`, `host_rate`, `path_rate` and `score`, the probability of good quality.

    `labels` has `doc_id` and `quality` (0 or 1; others are left out); rows for which `held_out` of the id
    holds are never learned from.  Sites without labels get the rate of what is above them.
    With labels of one kind only the evidence is 0 and the sites decide.  Null texts are empty.
    """
    x = features(F.col(f"`{text_column}`"))
    rows = docs.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{host_column}`").alias("host"),
        F.col(f"`{path_column}`").alias("path"), F.array(*x).alias("x"),
    )
    rows = cut_lineage(rows, "features")
    known = labels.filter(F.col("quality").isin(0, 1) & ~held_out("doc_id")).select(
        F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("label")
    )
    labelled = cut_lineage(rows.join(known, "id"), "labelled")
    hosts, paths, rate = site_posteriors(labelled)
    sample = sample_rows(labelled.withColumn("row", F.col("id").cast("string")), ["row"], how.fit_rows, how.seed)
    chosen = sample.select("label", "x").collect()
    both = len({r["label"] for r in chosen}) == 2
    values = [F.element_at("x", i + 1) for i in range(len(x))]
    own = evidence(values, fit_evidence(chosen, how)) if both else F.lit(0.0)
    hosts = hosts.select(F.col("host").alias("h"), "host_rate")
    paths = paths.select(F.col("host").alias("hp"), F.col("path").alias("p"), "path_rate")
    # A host may have a third of all documents; its rows are narrow here and adaptive execution splits the join.
    placed = (
        rows.withColumn("evidence", own)
        .join(hosts, F.col("host").eqNullSafe(F.col("h")), "left")
        .join(paths, F.col("host").eqNullSafe(F.col("hp")) & F.col("path").eqNullSafe(F.col("p")), "left")
        .withColumn("host_rate", F.coalesce("host_rate", F.lit(float(rate))))
        .withColumn("path_rate", F.coalesce("path_rate", "host_rate"))
    )
    odds = lambda p: F.log(p / (1 - p))
    total = F.col("evidence") + odds(F.col("path_rate")) - odds(F.lit(float(rate)))
    return placed.select(
        F.col("id").alias(id_column), "evidence", "host_rate", "path_rate", (1 / (1 + F.exp(-total))).alias("score")
    )
