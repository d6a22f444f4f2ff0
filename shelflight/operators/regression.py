"""Price regression by batch gradient descent over the sums of the design.

Gradient and cost of a step are a quadratic form in the weights.  Its sums (products of
the numbers, sums of the numbers per level of a label, counts per pair of levels that occur
together) come from grouped aggregations; a descent step is one product with them, and
gives the same weights and costs as a pass over all rows.  The sums are as large as the
model: the driver holds one weight per level, and one count per pair of levels that occurs.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflight import fixed_values as fixed
from shelflight.functions.codes import fit_verdict
from shelflight.functions.draws import draw
from shelflight.functions.quantiles import quantiles
from shelflight.functions.scaling import number
from shelflight.functions.text import normal_brand, to_number
from shelflight.functions.vectors import ratio
from shelflight.roles import Roles
from shelflight.session import settle, small_table


# -- feature preparation ------------------------------------------------------

@dataclass(frozen=True)
class Design:
    """Fitted preparation: medians, means and deviations of the numbers, levels of the labels."""

    target: str
    numeric: tuple[str, ...]
    labels: tuple[str, ...]
    medians: Mapping[str, float]
    means: Mapping[str, float]
    deviations: Mapping[str, float]
    levels: Mapping[str, tuple[str, ...]]
    target_mean: float

    @property
    def names(self) -> list[str]:
        """Feature names; the first level of each label has no feature."""
        return [*self.numeric, *[f"{c}_{v}" for c in self.labels for v in self.levels[c][1:]]]

    def z(self, column: str) -> Column:
        """Imputed and standardised value; a column without spread is 0."""
        x = F.coalesce(number(column), F.lit(self.medians[column]))
        scaled = ratio(x - F.lit(self.means[column]), F.lit(self.deviations[column]))
        return F.coalesce(scaled, F.lit(0.0)).cast("double")

    def apply(self, df: DataFrame) -> DataFrame:
        """Replace the numeric columns by their standardised values."""
        return df.withColumns({c: self.z(c) for c in self.numeric})


def fit_design(df: DataFrame, target: str, numeric: Sequence[str], labels: Sequence[str] = ()) -> Design:
    """Statistics of the rows that have a target, and the labels' levels from the same pass.

    The levels become weights, so they are part of the model that the driver holds.
    """
    df = df.where(number(target).isNotNull())
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), number(c).alias("x")) for c in numeric])).alias("e")).select("e.*")
    medians = {r["c"]: r["q"][0] for r in quantiles(long, "x", [0.5], ["c"]).collect()}
    medians = {c: medians.get(c) for c in numeric}
    filled = {c: F.coalesce(number(c), F.lit(medians[c])).cast("double") for c in numeric}
    stats = df.agg(F.avg(number(target)).alias("target"),
                   *[f(x).alias(f"{k}_{c}") for c, x in filled.items()
                     for k, f in (("mean", F.avg), ("std", F.stddev_samp))],
                   *[F.sort_array(F.collect_set(c)).alias(f"levels_{c}") for c in labels]).first()
    levels = {c: tuple(stats[f"levels_{c}"]) for c in labels}
    return Design(target, tuple(numeric), tuple(labels), medians,
                  {c: stats[f"mean_{c}"] for c in numeric}, {c: stats[f"std_{c}"] for c in numeric},
                  levels, stats["target"] or 0.0)


def catalogue_design(df: DataFrame, roles: Roles = Roles()) -> Design:
    return fit_design(df, roles.price, roles.technical, [roles.category, roles.brand])


def design_matrix(df: DataFrame, design: Design, id: str = Roles().id) -> DataFrame:
    """Non-zero design entries ``(id, osobina, vrednost)``; rows without a target are left out."""
    entries = [F.struct(F.lit(c).alias("osobina"), design.z(c).alias("vrednost")) for c in design.numeric]
    entries += [F.struct(
        F.when(F.col(c) != F.lit(design.levels[c][0]), F.concat(F.lit(f"{c}_"), F.col(c))).alias("osobina"),
        F.lit(1.0).alias("vrednost")) for c in design.labels if design.levels[c]]
    rows = df.where(number(design.target).isNotNull())
    return (rows.select(id, F.explode(F.array(*entries)).alias("_e")).select(id, "_e.*")
            .where(F.col("osobina").isNotNull() & (F.col("vrednost") != 0)))


# -- descent ------------------------------------------------------------------

MODEL_SCHEMA = "design string, names array<string>, weights array<double>, bias double, costs array<double>"


@dataclass
class LinearModel:
    """Weights by feature name, bias, and the cost after every step."""

    design: Design
    weights: dict[str, float]
    bias: float
    costs: list[float] = field(default_factory=list)

    def history(self, spark: SparkSession) -> DataFrame:
        rows = [(i, float(c)) for i, c in enumerate(self.costs)]
        return small_table(spark, rows, "iteracija int, trosak double")

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the fitted preparation, weights and costs as one row below ``path``, replacing what is there."""
        row = (json.dumps(asdict(self.design)), list(self.weights), list(self.weights.values()), self.bias, self.costs)
        small_table(spark, [row], MODEL_SCHEMA).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LinearModel:
        """The model that ``save`` wrote; it predicts as the one that was trained."""
        row = spark.read.schema(MODEL_SCHEMA).parquet(path).first()
        if row is None:
            raise ValueError(f"no model in {path}")
        kept = json.loads(row["design"])
        for name in ("numeric", "labels"):
            kept[name] = tuple(kept[name])
        kept["levels"] = {c: tuple(v) for c, v in kept["levels"].items()}
        return cls(Design(**kept), dict(zip(row["names"], row["weights"])), row["bias"], list(row["costs"]))

    def predict(self, df: DataFrame, column: str = "predikcija", unseen: float | None = None) -> DataFrame:
        """Add the prediction; a label not seen in training weighs ``unseen``, or makes it NULL.

        The weights of a label join as a table of known size: broadcast while it
        is small, shuffled otherwise.
        """
        total, order = F.lit(self.bias), [c for c in df.columns if c != column]
        for c in self.design.numeric:
            total = total + self.design.z(c) * F.lit(self.weights[c])
        for c in self.design.labels:
            seen = [(v, self.weights.get(f"{c}_{v}", 0.0)) for v in self.design.levels[c]]
            table = small_table(df.sparkSession, seen, f"`{c}` string, `_w_{c}` double")
            df = df.join(table, c, "left")
            total = total + F.when(F.col(c).isNull(), 0.0).otherwise(
                F.coalesce(F.col(f"_w_{c}"), F.lit(unseen)))
        return df.withColumn(column, total).select(*order, column)


def cells(df: DataFrame, design: Design) -> DataFrame:
    """Sums per combination of labels; the target is taken from its mean for precision."""
    rows = design.apply(df.where(number(design.target).isNotNull()))
    rows = rows.withColumn("_y", F.col(design.target).cast("double") - F.lit(design.target_mean))
    x, y, p = [F.col(c) for c in design.numeric], F.col("_y"), len(design.numeric)
    sums = {"n": F.count(F.lit(1)).cast("double"), "sy": F.sum(y), "syy": F.sum(y * y)}
    sums |= {f"sx{i}": F.sum(x[i]) for i in range(p)}
    sums |= {f"sxy{i}": F.sum(x[i] * y) for i in range(p)}
    sums |= {f"sxx{i}_{j}": F.sum(x[i] * x[j]) for i in range(p) for j in range(i, p)}
    return rows.groupBy(*design.labels).agg(*[c.alias(k) for k, c in sums.items()])


class _Form:
    """The quadratic form of the squared error: entries (i, j, v) of its matrix, its vector, and its constant.

    The numbers come first, then a place per level that has a weight, then the bias.
    """

    def __init__(self, cell_table: DataFrame, design: Design):
        p, labels = len(design.numeric), design.labels
        self.offsets, at = {}, p
        for c in labels:
            self.offsets[c] = {v: at + i for i, v in enumerate(design.levels[c][1:])}
            at += len(self.offsets[c])
        self.bias = at
        entries: list[tuple[int, int, float]] = []
        self.vector = np.zeros(at + 1)

        def both(i: int, j: int, v: float) -> None:
            entries.append((i, j, v))
            if i != j:
                entries.append((j, i, v))

        sums = ["n", "sy", "syy", *[f"sx{i}" for i in range(p)], *[f"sxy{i}" for i in range(p)],
                *[f"sxx{i}_{j}" for i in range(p) for j in range(i, p)]]
        whole = cell_table.agg(*[F.coalesce(F.sum(k), F.lit(0.0)).alias(k) for k in sums]).first()
        self.rows, mean = whole["n"], design.target_mean
        # The target is held from its mean; the bias is the distance to it while the form is used.
        self.constant = whole["syy"]
        self.vector[self.bias] = whole["sy"]
        both(self.bias, self.bias, whole["n"])
        for i in range(p):
            self.vector[i] = whole[f"sxy{i}"]
            both(i, self.bias, whole[f"sx{i}"])
            for j in range(i, p):
                both(i, j, whole[f"sxx{i}_{j}"])
        for k, c in enumerate(labels):
            for r in cell_table.groupBy(c).agg(*[F.sum(x).alias(x) for x in ("n", "sy", *[f"sx{i}" for i in range(p)])]).collect():
                place = self.offsets[c].get(r[c])
                if place is None:
                    continue
                self.vector[place] = r["sy"]
                both(place, place, r["n"])
                both(place, self.bias, r["n"])
                for i in range(p):
                    both(i, place, r[f"sx{i}"])
            for d in labels[k + 1:]:
                for r in cell_table.groupBy(c, d).agg(F.sum("n").alias("n")).collect():
                    one, other = self.offsets[c].get(r[c]), self.offsets[d].get(r[d])
                    if one is not None and other is not None:
                        both(one, other, r["n"])
        self.i = np.array([e[0] for e in entries])
        self.j = np.array([e[1] for e in entries])
        self.v = np.array([e[2] for e in entries], dtype=float)
        self.mean = mean

    def gradient(self, theta: np.ndarray) -> tuple[np.ndarray, float]:
        """Gradient sums per weight and for the bias, and the sum of squared errors."""
        at = theta.copy()
        at[self.bias] -= self.mean
        product = np.bincount(self.i, weights=self.v * at[self.j], minlength=len(at))
        return product - self.vector, float(at @ product - 2 * at @ self.vector + self.constant)


def descend(cell_table: DataFrame, design: Design, rate: float = 0.01, steps: int = 1000) -> LinearModel:
    """``steps`` full-batch steps from zero; the cost is recorded after each."""
    form = _Form(settle(cell_table, "cells"), design)
    theta, costs = np.zeros(form.bias + 1), []
    now, _ = form.gradient(theta)
    for _ in range(steps):
        theta = theta - rate * now / form.rows
        now, squares = form.gradient(theta)
        costs.append(max(squares, 0.0) / (2 * form.rows))
    names = design.names
    return LinearModel(design, dict(zip(names, map(float, theta[:form.bias]))), float(theta[form.bias]), costs)


def fit(df: DataFrame, design: Design, rate: float = 0.01, steps: int = 1000) -> LinearModel:
    return descend(cells(df, design), design, rate, steps)


# -- split, metrics, training -------------------------------------------------

def split(df: DataFrame, id: str = Roles().id, test_share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Disjoint train and test rows; train has exactly ``int(n * (1 - test_share))`` rows.

    Rows are ordered by a seeded hash of their unique id, so the split does not
    depend on partitions, and the cut is found as an exact quantile of the hash.
    """
    h = draw(F.col(id), seed).cast("double")
    hashed = df.select(F.col(id).alias("_id"), h.alias("_h"))
    n = df.count()
    k = int(n * (1 - test_share))
    if k <= 0 or k >= n:
        return df.where(F.lit(k > 0)), df.where(F.lit(k <= 0))
    cut = quantiles(hashed, "_h", [(k - 0.5) / (n - 1)]).first()["q"][0]
    below = hashed.where(F.col("_h") < cut).count()
    if below >= k:
        return df.where(h < cut), df.where(h >= cut)
    # The cut is a shared hash value: the smallest ids of that value complete the train part.
    last = (hashed.where(F.col("_h") == cut).orderBy("_id").limit(k - below).agg(F.max("_id")).first()[0])
    train = (h < cut) | ((h == cut) & (F.col(id) <= F.lit(last)))
    return df.where(train), df.where(~train)


def evaluate(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Coefficient of determination (0 without variance) and root mean squared error in one row.

    Rows without a value or a prediction do not count.
    """
    df = df.where(number(actual).isNotNull() & number(predicted).isNotNull())
    y, e = F.col(actual).cast("double"), F.col(actual).cast("double") - F.col(predicted)
    sums = df.agg(F.sum(e * e).alias("res"), (F.var_pop(y) * F.count(y)).alias("tot"), F.avg(e * e).alias("mse"))
    r2 = F.when(F.col("tot") != 0, 1 - F.col("res") / F.col("tot")).otherwise(0.0)
    return sums.select(r2.alias("r2"), F.sqrt("mse").alias("rmse"), fit_verdict(r2).alias("ocena"))


@dataclass
class Training:
    model: LinearModel
    train: DataFrame
    test: DataFrame

    def scored(self) -> DataFrame:
        """Test rows with predictions; a brand that only the test part has counts as the first one."""
        return self.model.predict(self.test, unseen=0.0)

    def metrics(self) -> DataFrame:
        return evaluate(self.scored(), self.model.design.target, "predikcija")


def train(df: DataFrame, roles: Roles = Roles(), rate: float = 0.05, steps: int = 2000, seed: int = 42,
          scale_on_train: bool = False) -> Training:
    """Prepare, split 80/20, fit.

    Scaling uses all rows before the split; ``scale_on_train`` keeps the test
    rows out of it.
    """
    wanted = [roles.id, roles.price, roles.category, roles.brand, *roles.technical]
    # Every later pass reads these columns only, and a costly input is computed once.
    rows = settle(df.select(*wanted).where(number(roles.price).isNotNull()))
    part, held_out = split(rows, roles.id, seed=seed)
    design = catalogue_design(part if scale_on_train else rows, roles)
    return Training(fit(part, design, rate, steps), part, held_out)


def estimate(model: LinearModel, items: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Prices of new items typed in as text: empty numbers are missing, unknown labels an error."""
    ready = items.withColumns({c: to_number(F.col(c)) for c in model.design.numeric})
    ready = ready.withColumn(roles.brand, normal_brand(F.col(roles.brand)))
    scored = model.predict(ready)
    unknown = scored.where(F.col("predikcija").isNull()).select(*model.design.labels).first()
    if unknown is not None:
        raise ValueError(f"category and brand were not seen in training: {tuple(unknown)}")
    return scored


def sample_items(spark: SparkSession) -> DataFrame:
    columns = list(fixed.ESTIMATE_SAMPLES[0])
    return small_table(spark, [tuple(s[c] for c in columns) for s in fixed.ESTIMATE_SAMPLES],
                       ", ".join(f"{c} string" for c in columns))
