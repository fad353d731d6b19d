"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics, scored in Spark columns.

Small trees on bootstrap samples of the labelled rows give paths; each path is a rule (a conjunction of comparisons).
A lasso logistic fit keeps a few rules. The fit sees a bounded sample on the driver; scoring is a column expression.
"""

from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, quoted
from .labelled import labelled_sample, with_texts

SAMPLE = 20_000
TREES = 24
DEPTH = 3
TREE_ROWS = 4_000
CUTS = 24
PENALTY = 0.002
THRESHOLD = 0.3
SEED = 11


def statistics(text: Column) -> dict[str, Column]:
    """Text statistics as columns over ``_words`` (see :func:`with_statistics`); all finite, for empty texts too."""
    chars = F.greatest(F.length(text), F.lit(1))
    tokens = F.greatest(F.size("_words"), F.lit(1))
    lines = F.split(text, "\n")
    without = lambda pattern: F.length(F.regexp_replace(text, pattern, ""))
    rest = F.greatest(F.size("_words") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("_words", 1, rest), F.slice("_words", 2, rest), lambda a, b: a == b)
    again = F.size(F.filter(pairs, lambda x: x))
    return {
        "log_words": F.log1p(F.size("_words").cast("double")),
        "word_length": chars / tokens,
        "capital_share": 1 - without("[A-Z]+") / chars,
        "symbol_share": 1 - without(r"[#$%&*+<=>@\\^_`{|}~\[\]]+") / chars,
        "mark_share": 1 - without(r"[!?]+") / chars,
        "stop_share": 1 - without(r"[.,;:]+") / chars,
        "digit_share": 1 - without("[0-9]+") / chars,
        "wide_share": (F.octet_length(text) - F.length(text)) / chars,
        "distinct_share": F.size(F.array_distinct("_words")) / tokens,
        "repeat_share": again / tokens,
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines),
    }


def with_statistics(rows: DataFrame, text: str = "text") -> DataFrame:
    """``rows`` with one column per statistic.

    The statistics leave an ``explode`` of one struct. The optimizer does not move later filters and expressions below it,
    where it would repeat every statistic for every rule that names it.
    """
    packed = rows.select(F.struct(*[quoted(c) for c in rows.columns]).alias("row"), quoted(text).alias("text"))
    worded = packed.withColumn("_words", F.filter(F.split("text", SPACE), lambda w: w != ""))
    measured = F.struct(*[c.cast("double").alias(n) for n, c in statistics(F.col("text")).items()])
    once = worded.select("row", F.explode(F.array(measured)).alias("s"))
    return once.select("row.*", *[F.col(f"s.{n}").alias(f"_{n}") for n in statistics(F.lit(""))])


Rule = tuple[tuple[str, bool, float], ...]


@dataclass(frozen=True)
class RuleModel:
    """Score = logistic(intercept + sum of weights of the rules that hold); a rule is (statistic, above, cut) terms."""

    intercept: float
    rules: tuple[Rule, ...] = ()
    weights: tuple[float, ...] = ()

    def column(self) -> Column:
        """The score over statistic columns ``_name``."""
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            holds = F.lit(True)
            for name, above, cut in rule:
                holds = holds & ((F.col(f"_{name}") > cut) if above else (F.col(f"_{name}") <= cut))
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def tree_paths(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int = DEPTH) -> list[tuple]:
    """Paths to all nodes of one tree, as tuples of (feature, above, cut); splits maximise the Gini gain.

    Each split looks at a random half of the features.
    """
    paths: list[tuple] = []

    def grow(rows: np.ndarray, path: tuple) -> None:
        if path:
            paths.append(path)
        share = y[rows].mean()
        if len(path) == depth or len(rows) < 40 or share in (0, 1):
            return
        best = (1e-9, -1, 0.0)
        for f in rng.choice(x.shape[1], size=(x.shape[1] + 1) // 2, replace=False):
            values = x[rows, f]
            cuts = np.unique(np.quantile(values, np.linspace(0.01, 0.99, CUTS)))
            below = values[:, None] <= cuts
            n = below.sum(0)
            ones = (below & (y[rows, None] == 1)).sum(0)
            fit = (n >= 10) & (len(rows) - n >= 10)
            with np.errstate(divide="ignore", invalid="ignore"):
                p, q = ones / n, (y[rows].sum() - ones) / (len(rows) - n)
                gain = share * (1 - share) - (n * p * (1 - p) + (len(rows) - n) * q * (1 - q)) / len(rows)
            gain = np.where(fit, gain, -1)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), int(f), float(cuts[k]))
        if best[1] >= 0:
            above = x[rows, best[1]] > best[2]
            grow(rows[~above], (*path, (best[1], False, best[2])))
            grow(rows[above], (*path, (best[1], True, best[2])))

    grow(np.arange(len(y)), ())
    return paths


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float = PENALTY, rounds: int = 600) -> tuple[float, np.ndarray]:
    """Intercept and weights of an L1-penalised logistic fit (accelerated proximal gradient; free intercept)."""
    n, k = z.shape
    full = np.hstack([np.ones((n, 1)), z])
    step = 4 * n / max(1e-12, np.linalg.norm(full.T @ full, 2))
    weights = np.zeros(k + 1)
    base = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    weights[0] = np.log(base / (1 - base))
    ahead, t = weights.copy(), 1.0
    for _ in range(rounds):
        gradient = full.T @ (1 / (1 + np.exp(-full @ ahead)) - y) / n
        new = ahead - step * gradient
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        following = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / following * (new - weights)
        weights, t = new, following
    return float(weights[0]), weights[1:]


def fit_rules(x: np.ndarray, y: np.ndarray, names: list[str], trees: int = TREES, seed: int = SEED,
              penalty: float = PENALTY) -> RuleModel:
    """A rule model; without labels the score is 0.5 everywhere, with one class it is constant near that class."""
    if len(y) == 0:
        return RuleModel(0.0)
    if y.min() == y.max():
        return RuleModel(3.0 if y[0] else -3.0)
    rng = np.random.default_rng(seed)
    paths: dict[tuple, None] = {}
    classes = [np.nonzero(y == v)[0] for v in (0, 1)]
    for _ in range(trees):
        # Half of a tree's rows from each class, so rare labels are split too.
        rows = np.concatenate([rng.choice(c, size=min(TREE_ROWS // 2, 4 * len(c))) for c in classes])
        paths.update(dict.fromkeys(tree_paths(x[rows], y[rows], rng)))
    rules = list(paths)
    z = np.stack([np.all([(x[:, f] > c) == above for f, above, c in rule], axis=0) for rule in rules], axis=1).astype(float)
    intercept, weights = lasso_logistic(z, y, penalty)
    kept = [(tuple((names[f], above, c) for f, above, c in rule), float(w)) for rule, w in zip(rules, weights, strict=True) if w]
    return RuleModel(intercept, tuple(r for r, _ in kept), tuple(w for _, w in kept))


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
                sample: int = SAMPLE, held_out: int = 0) -> RuleModel:
    """Fit on at most ``sample`` labelled documents outside the held-out fold."""
    rows = with_texts(labelled_sample(labels, label, sample, held_out), docs, id_col, text_col)
    names = list(statistics(F.lit("")))
    got = with_statistics(rows).select("y", *[f"_{n}" for n in names]).orderBy("y", *[f"_{n}" for n in names]).toPandas()
    return fit_rules(got[[f"_{n}" for n in names]].to_numpy(float), got["y"].to_numpy(int), names)


def score_quality(docs: DataFrame, model: RuleModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``_score`` and ``_good`` (score >= threshold).

    Null texts score as empty ones, and empty texts get a score like any other. Only the text is looked at. Repeated rows
    score alike; columns of ``docs`` stay as they are whatever their names, but for earlier ones called ``_score`` or ``_good``.
    """
    rows = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("row"), F.coalesce(quoted(text_col), F.lit("")).alias("text"))
    scored = with_statistics(rows).withColumn("score", model.column())
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("_score", "_good")]
    return scored.select(*kept, F.col("score").alias("_score"), (F.col("score") >= threshold).alias("_good"))


def good_documents(docs: DataFrame, model: RuleModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score well, all their columns unchanged."""
    rows = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("row"), F.coalesce(quoted(text_col), F.lit("")).alias("text"))
    return with_statistics(rows).filter(model.column() >= threshold).select("row.*")


def explain_rules(model: RuleModel) -> list[Mapping[str, object]]:
    """The kept rules with their weights, strongest first."""
    rows = [{"rule": " and ".join(f"{n} {'>' if a else '<='} {c:.4g}" for n, a, c in r), "weight": w}
            for r, w in zip(model.rules, model.weights, strict=True)]
    return sorted(rows, key=lambda r: -abs(r["weight"]))
