"""Exact interpolated quantiles without gathering a large group in one place.

Three narrow passes do it, at every size: a mergeable sketch proposes cut points around each wanted
rank, a count per interval tells which intervals hold the ranks, and only the
rows of those intervals are put in order.  The sketch decides how few rows the
last pass touches, never the result: the intervals are counted exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelflight.session import settle

ACCURACY = 20_000


def quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
              accuracy: int = ACCURACY) -> DataFrame:
    """``by..., n, q: array<double>`` with one linearly interpolated quantile per prob.

    Missing values do not count; rows whose key is NULL are a group like any other.
    Without ``by`` there is one row; on empty input its ``q`` is NULL.
    """
    by = list(by)
    src = df.select(*by, F.col(value).cast("double").alias("_x"))
    src = src.where(F.col("_x").isNotNull() & ~F.isnan("_x"))

    slack = 2.0 / accuracy
    cuts = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-slack, slack)})
    sketch = src.groupBy(*by).agg(
        F.count("_x").alias("_n"), F.percentile_approx("_x", cuts, accuracy).alias("_cuts"))
    sketch = settle(sketch, "sketch") if by else sketch.first()
    if not by and not sketch["_n"]:
        return src.groupBy().agg(F.count("_x").alias("n"), F.lit(None).cast("array<double>").alias("q"))

    slots = _attach(src, sketch, by, ["_cuts"]).select(*by, "_x", _slot(len(cuts)).alias("_slot"))
    counts = slots.groupBy(*by, "_slot").agg(F.count("_x").alias("_c"))
    # At most len(cuts) + 1 counts per group, so folding them into one array is safe.
    filled = counts.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_slot", "_c"))).alias("_filled"))
    wanted = _attach(filled, sketch, by, ["_n"]).select(*by, _wanted(probs).alias("_wanted"))
    wanted = settle(wanted, "ranks") if by else wanted.first()

    if not by:
        held = {w["slot"] for w in wanted["_wanted"]}
        src = src.where(_inside(sketch["_cuts"], held))
        slots = _attach(src, sketch, by, ["_cuts"]).select("_x", _slot(len(cuts)).alias("_slot"))
    near = _attach(slots, wanted, by, ["_wanted"])
    near = near.where(F.exists("_wanted", lambda w: w["slot"] == F.col("_slot")))
    ordered = near.groupBy(*by, "_slot", "_x").agg(F.count(F.lit(1)).alias("_c"))
    # One slot holds about 4/accuracy of its group.
    upto = F.sum("_c").over(Window.partitionBy(*by, "_slot").orderBy("_x"))
    ordered = ordered.withColumn("_upto", upto)
    hits = _attach(ordered, wanted, by, ["_wanted"]).select(*by, "_x", F.explode(F.filter("_wanted", lambda w: (
        (w["slot"] == F.col("_slot")) & (w["rank"] < F.col("_upto")) & (w["rank"] >= F.col("_upto") - F.col("_c"))
    ))).alias("_w"))
    ends = hits.groupBy(*by).agg(*[
        F.max(F.when((F.col("_w.i") == i) & (F.col("_w.high") == high), F.col("_x"))).alias(f"_e{i}{int(high)}")
        for i in range(len(probs)) for high in (False, True)])
    n = F.col("_n")
    q = F.array(*[_between(F.col(f"_e{i}0"), F.col(f"_e{i}1"), F.lit(p) * (n - 1)) for i, p in enumerate(probs)])
    return _attach(ends, sketch, by, ["_n"]).select(*by, n.alias("n"), q.alias("q"))


def join_groups(df: DataFrame, dim: DataFrame, by: Sequence[str]) -> DataFrame:
    """Inner join on the keys in which NULL equals NULL."""
    own = [f"_key{i}" for i in range(len(by))]
    dim = dim.withColumnsRenamed(dict(zip(by, own)))
    same = [df[k].eqNullSafe(dim[o]) for k, o in zip(by, own)]
    return df.join(dim, same).drop(*own)


def _attach(df: DataFrame, dim, by: list[str], columns: list[str]) -> DataFrame:
    """Bring per-group values to the rows: joined by key, or literals of the only group."""
    if by:
        return join_groups(df, dim.select(*by, *columns), by)
    return df.withColumns({c: _literal(dim[c]) for c in columns})


def _literal(value) -> Column:
    if value and isinstance(value, list) and isinstance(value[0], tuple):
        return F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in item.asDict().items()]) for item in value])
    return F.lit(value)


def _slot(n_cuts: int) -> Column:
    slot = F.lit(0)
    for i in range(n_cuts):
        slot = slot + F.when(F.col("_x") > F.get("_cuts", F.lit(i)), 1).otherwise(0)
    return slot


def _inside(cuts: list[float], slots: set[int]) -> Column:
    """Range predicates for the slots, which reach the scan."""
    test = F.lit(False)
    for s in slots:
        above = F.col("_x") > cuts[s - 1] if s > 0 else F.lit(True)
        upto = F.col("_x") <= cuts[s] if s < len(cuts) else F.lit(True)
        test = test | (above & upto)
    return test


def _wanted(probs: Sequence[float]) -> Column:
    """For each prob the lower and upper rank: its slot and its position inside the slot."""
    def before(slot: Column) -> Column:
        return F.aggregate(F.filter("_filled", lambda f: f["_slot"] < slot), F.lit(0).cast("long"),
                           lambda acc, f: acc + f["_c"])

    def locate(i: int, rank: Column, high: bool) -> Column:
        holder = F.get(F.filter("_filled", lambda f: (
            (before(f["_slot"]) <= rank) & (rank < before(f["_slot"]) + f["_c"]))), F.lit(0))["_slot"]
        return F.struct(F.lit(i).alias("i"), F.lit(high).alias("high"), holder.alias("slot"),
                        (rank - before(holder)).alias("rank"))

    out = []
    for i, p in enumerate(probs):
        position = F.lit(p) * (F.col("_n") - 1)
        out += [locate(i, F.floor(position).cast("long"), False), locate(i, F.ceil(position).cast("long"), True)]
    return F.array(*out)


def _between(low: Column, high: Column, position: Column) -> Column:
    return low + (high - low) * (position - F.floor(position))
