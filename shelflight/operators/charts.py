"""The data behind every chart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflight import fixed_values as fixed
from shelflight.functions.codes import price_band
from shelflight.functions.quantiles import quantiles
from shelflight.roles import Roles
from shelflight.session import settle, small_table


def value_counts(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Rows per value, most frequent first, without NULL; the first ``n`` if given."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("broj"))
    ranked = counted.orderBy(F.desc("broj"), column)
    return ranked.limit(n) if n is not None else ranked


def share_table(counts: DataFrame, label: str, n: int = 10, remainder: str = fixed.REMAINDER,
                label_from: float = 3.0) -> DataFrame:
    """The ``n`` largest counts and one row for the rest, with percentages.

    ``natpis`` is the text printed on the slice, empty for slices below ``label_from``.
    """
    top = counts.orderBy(F.desc("broj"), label).limit(n)
    total = F.lit(counts.agg(F.sum("broj")).first()[0])
    rest = (top.agg(F.sum("broj").alias("_top")).select(
        F.lit(remainder).alias(label), (total - F.col("_top")).alias("broj"))
        .where(F.col("broj") > 0))
    share = F.lit(100.0) * F.col("broj") / total
    shown = F.when(share >= label_from, F.concat(F.format_number(share, 1), F.lit("%"))).otherwise("")
    return top.select(label, "broj").unionByName(rest).select(
        label, "broj", share.alias("procenat"), shown.alias("natpis"))


def band_histogram(df: DataFrame, price: str = Roles().price, bands=fixed.PRICE_BANDS) -> DataFrame:
    """Rows per price band in band order; empty bands count 0."""
    counted = df.groupBy(price_band(F.col(price), bands).alias("opseg")).agg(F.count(F.lit(1)).alias("_n"))
    axis = small_table(df.sparkSession, [(i, label) for i, (_, label) in enumerate(bands)], "redosled int, opseg string")
    return axis.join(counted, "opseg", "left").select(
        "redosled", "opseg", F.coalesce("_n", F.lit(0)).cast("long").alias("broj")).orderBy("redosled")


def scatter(df: DataFrame, x: str, categories: Sequence[str], roles: Roles = Roles()) -> DataFrame:
    """Points ``(id, category, x, price in thousands)`` of the chosen categories."""
    chosen = df.where(F.col(roles.category).isin(*categories)).dropna(subset=[x, roles.price])
    return chosen.select(roles.id, roles.category, F.col(x).cast("double").alias("x"),
                         (F.col(roles.price).cast("double") / 1000).alias("y"))


def grid_pyramid(points: DataFrame, x: str, y: str, levels: int = 6) -> DataFrame:
    """Points counted on square grids ``(nivo, kx, ky, broj)``: level 0 is one cell, each further one halves both sides.

    The rows are counted once, on the finest grid; the coarser cells are sums of those at most ``4**levels`` counts, so
    every zoom of a chart is served by one table.  The grid spans the values that occur, the last cell includes its
    end; a side without width is one unit wide around its value.  Points without a number on either side do not count.
    """
    p = points.select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    p = p.where(F.col("_x").isNotNull() & F.col("_y").isNotNull() & ~F.isnan("_x") & ~F.isnan("_y"))
    ends = p.agg(*[f(c).alias(f"{k}{c}") for c in ("_x", "_y") for k, f in (("lo", F.min), ("hi", F.max))]).first()
    side = 1 << levels

    def cell(c: str) -> Column:
        low, high = ends[f"lo{c}"], ends[f"hi{c}"]
        if low == high and low is not None:
            low, high = low - 0.5, high + 0.5
        part = (F.col(c) - F.lit(low)) / (F.lit(high) - F.lit(low))
        return F.least(F.floor(part * side), F.lit(side - 1)).cast("int")

    finest = p.groupBy(cell("_x").alias("_kx"), cell("_y").alias("_ky")).agg(F.count(F.lit(1)).alias("_n"))
    zoomed = finest.select("*", F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("nivo"))
    over = F.lit(levels) - F.col("nivo")
    return zoomed.groupBy("nivo", F.call_function("shiftright", F.col("_kx"), over).alias("kx"),
                          F.call_function("shiftright", F.col("_ky"), over).alias("ky")).agg(F.sum("_n").alias("broj"))


def box_stats(df: DataFrame, roles: Roles = Roles(), least: int = 10) -> DataFrame:
    """Quartiles, whisker ends and outlier counts of the price in thousands per category.

    Categories with fewer than ``least`` rows are left out (rows without a price
    count too); ordered by median.
    """
    y = df.select(F.col(roles.category).alias("_g"), (F.col(roles.price).cast("double") / 1000).alias("_y"))
    sizes = y.where(F.col("_g").isNotNull()).groupBy("_g").agg(F.count(F.lit(1)).alias("redova"))
    q = [F.get("q", F.lit(i)) for i in range(3)]
    boxes = (quantiles(y, "_y", [0.25, 0.5, 0.75], ["_g"])
             .join(sizes.where(F.col("redova") >= least), "_g")
             .select("_g", "redova", "n", q[0].alias("q1"), q[1].alias("medijana"), q[2].alias("q3")))
    boxes = settle(boxes)
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col("_y").between(F.col("q1") - reach, F.col("q3") + reach)
    ends = y.where(F.col("_y").isNotNull()).join(boxes, "_g").groupBy(
        "_g", "redova", "n", "q1", "medijana", "q3").agg(
        F.min(F.when(inside, F.col("_y"))).alias("_low"), F.max(F.when(inside, F.col("_y"))).alias("_high"),
        F.count_if(~inside).alias("izvan"))
    return ends.select(
        F.col("_g").alias(roles.category), "redova", "n",
        F.least("q1", "_low").alias("donji_brk"), "q1", "medijana", "q3",
        F.greatest("q3", "_high").alias("gornji_brk"), "izvan").orderBy("medijana", roles.category)


def cluster_centres(df: DataFrame, columns: Sequence[str], cluster: str = "klaster") -> DataFrame:
    """Size and means in original units of each cluster."""
    return df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("broj"), *[F.avg(c).alias(f"sredina_{c}") for c in columns])


def cluster_scatter(df: DataFrame, x: str, y: str, id: str = Roles().id, cluster: str = "klaster") -> DataFrame:
    """Members of each cluster in the first two chosen columns, original units."""
    return df.select(id, cluster, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))


def cluster_histogram(df: DataFrame, value: str, cluster: str = "klaster", bins: int = 20) -> DataFrame:
    """Counts in ``bins`` equal parts of each cluster's own range; the last part includes its end."""
    v = df.where(F.col(value).isNotNull()).select(cluster, F.col(value).cast("double").alias("_v"))
    spans = v.groupBy(cluster).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    # A range without width is one unit wide around its only value.
    flat = F.col("_lo") == F.col("_hi")
    spans = spans.select(cluster, F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
                         F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"))
    spans = settle(spans)
    part = F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins).cast("int")
    counted = (v.join(spans, cluster).groupBy(cluster, F.least(part, F.lit(bins - 1)).alias("deo"))
               .agg(F.count(F.lit(1)).alias("broj")))
    axis = spans.select(cluster, "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("deo"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    return axis.join(counted, [cluster, "deo"], "left").select(
        cluster, "deo", (F.col("_lo") + F.col("deo") * width).alias("od"),
        (F.col("_lo") + (F.col("deo") + 1) * width).alias("do"),
        F.coalesce("broj", F.lit(0).cast("long")).alias("broj"))


def learning_curve(history: DataFrame) -> DataFrame:
    """Cost by iteration, for a logarithmic axis."""
    return history.select("iteracija", "trosak", F.log10("trosak").alias("log10_trosak")).orderBy("iteracija")


def predicted_vs_actual(df: DataFrame, actual: str, predicted: str, id: str = Roles().id) -> DataFrame:
    """Pairs in thousands together with the common ends of both axes."""
    points = df.select(id, (F.col(actual).cast("double") / 1000).alias("stvarno"),
                       (F.col(predicted).cast("double") / 1000).alias("predvidjeno"))
    ends = points.agg(
        F.least(F.min("stvarno"), F.min("predvidjeno")).alias("lo"),
        F.greatest(F.max("stvarno"), F.max("predvidjeno")).alias("hi")).first()
    return points.withColumns({"osa_od": F.lit(ends["lo"]), "osa_do": F.lit(ends["hi"])})
