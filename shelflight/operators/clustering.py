"""Weighted k-means with its seeding, silhouette and descriptions."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflight import fixed_values as fixed
from shelflight.functions.codes import silhouette_verdict
from shelflight.functions.draws import LIMIT, draw
from shelflight.functions.scaling import min_max
from shelflight.functions.vectors import squared_distance
from shelflight.operators import tiles
from shelflight.roles import Roles
from shelflight.session import settle, small_table


def feature_columns(weights: Mapping[str, float]) -> list[str]:
    return [f"f_{c}" for c in weights]


def feature_space(df: DataFrame, weights: Mapping[str, float], k: int | None = None) -> DataFrame:
    """Rows that have every chosen column, with ``f_<column>`` = min-max value times its share.

    The weights are percentages and add up to 100; with ``k`` at least that many
    rows must be left.
    """
    if not weights:
        raise ValueError("choose at least one column")
    if abs(sum(weights.values()) - 100) > 0.1:
        raise ValueError(f"the weights must add up to 100, not {sum(weights.values()):g}")
    rows = df
    for c in weights:
        x = F.col(c).cast("double")
        rows = rows.where(x.isNotNull() & ~F.isnan(x))
    if k is not None and len(rows.limit(k).take(k)) < k:
        raise ValueError(f"fewer than {k} rows have all chosen columns")
    scaled = min_max(rows, list(weights), suffix="__scaled")
    return scaled.withColumns({f"f_{c}": F.col(f"{c}__scaled") * F.lit(w / 100.0) for c, w in weights.items()}
                              ).drop(*[f"{c}__scaled" for c in weights])


def _distances(features: Sequence[str], centroids: Sequence[Sequence[float]]) -> list[Column]:
    xs = [F.col(f) for f in features]
    return [squared_distance(xs, [F.lit(float(v)) for v in c]) for c in centroids]


def assign(df: DataFrame, features: Sequence[str], centroids: Sequence[Sequence[float]],
           column: str = "klaster") -> DataFrame:
    """Index of the nearest centroid; the lowest index wins a tie."""
    ranked = F.array(*[F.struct(d.alias("d"), F.lit(i).alias("i"))
                       for i, d in enumerate(_distances(features, centroids))])
    return df.withColumn(column, F.array_min(ranked)["i"])


def assign_vectors(df: DataFrame, vector: str, centroids: Sequence[Sequence[float]],
                   column: str = "klaster") -> DataFrame:
    """The same for wide vectors held in one array column."""
    def away(centre: Column) -> Column:
        return F.aggregate(F.zip_with(vector, centre, lambda x, c: (x - c) * (x - c)), F.lit(0.0),
                           lambda acc, v: acc + v)

    ranked = F.array(*[F.struct(away(F.lit([float(v) for v in c])).alias("d"), F.lit(i).alias("i"))
                       for i, c in enumerate(centroids)])
    return df.withColumn(column, F.array_min(ranked)["i"])


def seed_centroids(df: DataFrame, features: Sequence[str], k: int, seed: int = 42,
                   id: str = Roles().id) -> list[list[float]]:
    """k-means++ start: every next centroid is drawn with probability by squared distance.

    Each draw is one aggregation: the row with the smallest ``-ln(u) / d²`` has
    been drawn with weight ``d²``.  ``u`` is a seeded hash of the id, so the draw
    does not depend on partitions.
    """
    chosen: list[list[float]] = []
    for step in range(k):
        u = (draw(F.col(id), seed, step) + 0.5) / F.lit(float(LIMIT))
        nearest = F.array_min(F.array(*_distances(features, chosen))) if chosen else F.lit(1.0)
        # With all rows on chosen centroids every weight is 0 and any row will do.
        key = F.struct((nearest <= 0).alias("taken"), F.when(nearest > 0, -F.ln(u) / nearest).otherwise(-F.ln(u)).alias("wait"),
                       F.col(id).alias("id"))
        row = df.agg(F.min_by(F.struct(*features), key).alias("r")).first()["r"]
        if row is None:
            raise ValueError("no rows to choose centroids from")
        chosen.append([float(v) for v in row])
    return chosen


def lloyd(df: DataFrame, features: Sequence[str], start: Sequence[Sequence[float]], rounds: int = 300,
          tolerance: float = 1e-4) -> list[list[float]]:
    """Move centroids to the means of their rows until they rest.

    They rest when the summed squared shift is below ``tolerance``.  A centroid
    without rows stays.  A round is one aggregation to k rows; the features are
    held for the rounds, so none repeats the preparation.
    """
    points = df.select(*features).persist(StorageLevel.MEMORY_AND_DISK)
    centroids = [list(map(float, c)) for c in start]
    try:
        for _ in range(rounds):
            means = {r["klaster"]: [r[f] for f in features] for r in assign(points, features, centroids)
                     .groupBy("klaster").agg(*[F.avg(f).alias(f) for f in features]).collect()}
            moved = [means.get(i, c) for i, c in enumerate(centroids)]
            shift = sum((a - b) ** 2 for new, old in zip(moved, centroids) for a, b in zip(new, old))
            centroids = moved
            if shift < tolerance:
                break
    finally:
        points.unpersist()
    return centroids


def k_means(df: DataFrame, weights: Mapping[str, float] = fixed.CLUSTER_DEFAULT, k: int = fixed.CLUSTER_DEFAULT_K,
            seed: int = 42, id: str = Roles().id) -> tuple[DataFrame, list[list[float]]]:
    """Feature space, seeding, rounds and labels in ``klaster``."""
    space = settle(feature_space(df, weights, k))
    features = feature_columns(weights)
    centroids = lloyd(space, features, seed_centroids(space, features, k, seed, id))
    return assign(space, features, centroids), centroids


def silhouette(df: DataFrame, features: Sequence[str], cluster: str = "klaster", size: int = 1024) -> DataFrame:
    """Mean silhouette by Euclidean distance, in one row ``(skor, verdikt)``.

    Exact: every distance counts.  Equal rows are folded into one weighted point
    first, and points are compared tile by tile.  The work grows with the square
    of the number of distinct points.
    """
    features = list(features)
    points = df.groupBy(*features, cluster).agg(F.count(F.lit(1)).alias("_w"))
    points = points.select(F.array(*[F.col(f).cast("double") for f in features]).alias("x"),
                           F.col(cluster).cast("int").alias("c"), F.col("_w").alias("w"))
    fields = ["x", "c", "w"]
    packed = tiles.pack(points, [], fields, ["x", "c"], size)
    sizes = {r["c"]: r["n"] for r in packed.select(F.explode(F.arrays_zip("c", "w")).alias("m")).groupBy("m.c")
             .agg(F.sum("m.w").alias("n")).collect()}
    if len(sizes) < 2:
        score = small_table(df.sparkSession, [(0.0,)], "skor double")
        return score.select("skor", silhouette_verdict(F.col("skor")).alias("verdikt"))
    labels = np.array(sorted(sizes))

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                a, b = np.vstack(row.a_x), np.vstack(row.b_x)
                square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :]
                near = square - 2 * a @ b.T
                # Where cancellation eats the digits, subtract first instead.
                close = near < 1e-6 * np.maximum(square, 1e-300)
                i, j = np.nonzero(close)
                near[i, j] = ((a[i] - b[j]) ** 2).sum(1)
                distance = np.sqrt(np.maximum(near, 0.0))
                yield _tile_sums(row.tile, distance, row.a_c, row.a_w, row.b_c, row.b_w, labels)
                if row.tile != row.other:
                    yield _tile_sums(row.other, distance.T, row.b_c, row.b_w, row.a_c, row.a_w, labels)

    per_tile = tiles.pairs(packed, [], fields).mapInPandas(
        sums, "tile int, pos int, c int, w long, total array<double>")
    summed = per_tile.groupBy("tile", "pos", "c", "w").agg(
        *[F.sum(F.get("total", F.lit(i))).alias(f"t{i}") for i in range(len(labels))])
    own = reduce(lambda acc, i: F.when(F.col("c") == int(labels[i]), F.col(f"t{i}")).otherwise(acc),
                 range(len(labels)), F.lit(None).cast("double"))
    own_size = F.element_at(F.create_map(*[F.lit(v) for c, n in sizes.items() for v in (c, n)]), F.col("c"))
    a = F.when(own_size > 1, own / (own_size - 1)).otherwise(0.0)
    b = F.array_min(F.array(*[F.when(F.col("c") != int(l), F.col(f"t{i}") / sizes[l]) for i, l in enumerate(labels)]))
    score = F.when(F.greatest(a, b) > 0, (b - a) / F.greatest(a, b)).otherwise(0.0)
    mean = (F.sum(score * F.col("w")) / F.sum("w"))
    return summed.agg(mean.alias("skor")).select("skor", silhouette_verdict(F.col("skor")).alias("verdikt"))


def _tile_sums(tile: int, distance: np.ndarray, c, w, other_c, other_w, labels: np.ndarray) -> pd.DataFrame:
    """Summed distances of the rows of one tile to each cluster of the other tile."""
    by_cluster = np.zeros((len(other_c), len(labels)))
    by_cluster[np.arange(len(other_c)), np.searchsorted(labels, other_c)] = other_w
    return pd.DataFrame({"tile": tile, "pos": np.arange(len(c)), "c": c, "w": w,
                         "total": list(distance @ by_cluster)})


def describe(column: str, mean: Column, grade_code: str = Roles().grade_code) -> Column:
    """Text for the mean of one column; NULL when there is no mean."""
    def number(digits: int, thousands: bool = False) -> Column:
        shown = F.format_number(mean, digits)
        return shown if thousands else F.replace(shown, F.lit(","), F.lit(""))

    if column == grade_code:
        good, bad, digits, after = fixed.CLUSTER_GRADE_TEXTS
        text = F.concat(F.when(mean >= fixed.CLUSTER_GRADE_FROM, good).otherwise(bad), number(digits), F.lit(after))
    elif column in fixed.CLUSTER_TEXTS:
        before, digits, thousands, after = fixed.CLUSTER_TEXTS[column]
        text = F.concat(F.lit(before), number(digits, thousands), F.lit(after))
    else:
        text = F.concat(F.lit(f"{column} ≈ "), number(1))
    return F.when(mean.isNotNull(), text)


def cluster_profile(df: DataFrame, columns: Sequence[str], cluster: str = "klaster",
                    roles: Roles = Roles()) -> DataFrame:
    """Size and description of each cluster: the price first if there is one, then the chosen columns."""
    shown = ([roles.price] if roles.price in df.columns else []) + [
        c for c in columns if c != roles.price and c in df.columns]
    means = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("broj"), *[
        F.avg(F.col(c).cast("double")).alias(f"_m{i}") for i, c in enumerate(shown)])
    default = Roles()
    plain = {getattr(roles, f): getattr(default, f) for f in default.__dataclass_fields__}
    texts = [describe(plain.get(c, c), F.col(f"_m{i}")) for i, c in enumerate(shown)]
    return means.select(cluster, "broj", F.concat_ws(", ", *texts).alias("opis")).orderBy(cluster)
