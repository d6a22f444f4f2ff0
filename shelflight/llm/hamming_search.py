"""Exact top-k search of binary codes by incremental multi-index hashing.

Codes of 64 bits are cut into four segments.  Radii grow one segment at a time: a step looks up, for every query that
is still open, the values at distance ``radius`` from its own in one segment.  After the steps of ``radius`` up to
segment ``s`` (0 to 3), a code that was not found differs by more than ``radius`` bits in the segments up to ``s`` and
by ``radius`` or more in the others, so every code within ``4 radius + s`` is known.  A query closes as soon as that
covers its bound: the least distance within which it has verified enough ids.  A code farther than the bound is no
answer, so the look-up itself leaves it out; codes at the bound come through, and no tie can be missing.

A code that several look-ups find counts at the first of them: the first segment with the least distance.  Equal
codes are folded before: a code carries its least ``k + 1`` ids, each with the number of its rows, up to ``k``, which is all that
any query can use of it, and equal queries are answered once.  Of the codes that a query keeps, one for each code
that its own id has may give no neighbour, so every cut is ``k`` plus that number.

Neighbours are ordered by distance, then id; a row is no neighbour of rows with its own id.  Rows with a null code, or a null id,
are neither found nor answered; repeated ids count once per row.  With ``k`` rows or fewer all others are returned.
An empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelflight.llm.common import stored

K, SEGMENTS, SEGMENT_BITS = 10, 4, 16


def sign_code(vector: Column) -> Column:
    """Bit ``i`` says whether component ``i`` is above zero; null for a null vector or one of more than 64 parts."""
    parts = F.transform(vector, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint")))
    return F.when(F.size(vector) <= SEGMENTS * SEGMENT_BITS, F.aggregate(parts, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b)))


def _segment(code: str, segment: str) -> str:
    return f"shiftrightunsigned({code}, {SEGMENT_BITS} * {segment}) & {(1 << SEGMENT_BITS) - 1}L"


def _folded(pairs: DataFrame, k: int) -> DataFrame:
    """``code, ids``: distinct codes with their least ``k + 1`` ids and their rows.  Partial limits come before the shuffle."""
    order = Window.partitionBy("code").orderBy("id")
    least = pairs.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    return least.groupBy("code").agg(F.sort_array(F.collect_list(F.struct("id", F.least("rows", F.lit(k)).cast("int").alias("rows")))).alias("ids"))


def search(rows: DataFrame, queries: DataFrame, k: int = K, id_column: str = "id", code: str = "code") -> DataFrame:
    """``query_id, rank, id, distance`` of the ``k`` nearest rows of each query."""
    rows = rows.select(F.col(id_column).alias("id"), F.col(code).cast("bigint").alias("code")).dropna()
    asked = queries.select(F.col(id_column).alias("query_id"), F.col(code).cast("bigint").alias("code")).dropna()
    pairs = stored(rows.groupBy("code", "id").agg(F.count(F.lit(1)).alias("rows")), "pairs")
    codes = stored(_folded(pairs, k), "codes")
    total = codes.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0)).alias("n")).first()["n"]
    # Codes of a query's own id, where it has several.
    many = pairs.groupBy("id").agg(F.count(F.lit(1)).alias("own")).where("own > 1")
    still = stored(asked.join(many, asked["query_id"] == many["id"], "left").groupBy(F.col("code").alias("q"))
                   .agg(F.max(F.coalesce("own", F.lit(1))).cast("int").alias("own"))
                   .withColumn("bound", F.lit(SEGMENTS * SEGMENT_BITS)), "open")
    most = still.agg(F.coalesce(F.max("own"), F.lit(1)).alias("own")).first()["own"]
    apart = F.array(*[F.expr(f"bit_count({_segment('q ^ code', str(s))})") for s in range(SEGMENTS)])
    of_query = Window.partitionBy("q")
    enough = F.col("within") >= k + F.col("own")
    found = None
    closed: list[DataFrame] = []
    for radius, segment in product(range(SEGMENT_BITS + 1), range(SEGMENTS)):
        masks = ", ".join(f"{m}L" for m in range(1 << SEGMENT_BITS) if m.bit_count() == radius)
        probes = (still.select("q", "own", "bound", F.explode(F.expr(f"array({masks})")).alias("mask"))
                  .select("q", "own", "bound", F.expr(f"({_segment('q', str(segment))}) ^ mask").alias("value")))
        index = codes.select("code", F.col("ids")[0]["id"].alias("least"), F.size("ids").alias("n"),
                             F.expr(_segment("code", str(segment))).alias("at"))
        # The array's first least element is the look-up that counts.
        new = F.array_position(apart, F.array_min(apart)) == segment + 1
        # Spark does not see how many look-ups a query makes, so it must not take them for a small side.
        met = (probes.hint("merge").join(index, (F.col("value") == F.col("at")) & F.expr("bit_count(q ^ code) <= bound") & new)
               .select("q", "own", "code", "least", "n", F.expr("bit_count(q ^ code)").alias("distance")))
        if found is not None:
            met = met.unionByName(found.where(~F.col("done")).select(met.columns))
        # The first bound is a number, by which Spark cuts before the shuffle.
        kept = (met.withColumn("rank", F.row_number().over(of_query.orderBy("distance", "least"))).where(F.col("rank") <= k + most)
                .where(F.col("rank") <= k + F.col("own")).drop("rank")
                .withColumn("within", F.sum("n").over(of_query.orderBy("distance"))))
        found = stored(kept.withColumn("bound", F.min(F.when(enough, F.col("distance"))).over(of_query))
                       .withColumn("done", F.coalesce(F.col("bound") <= SEGMENTS * radius + segment, F.lit(False))
                                   | (F.max("within").over(of_query) >= total)), "found")
        closed.append(found.where("done").select("q", "own", "code", "distance"))
        state = found.groupBy("q").agg(F.first("bound").alias("nearer"), F.first("done").alias("done"))
        still = stored(still.join(state, "q", "left").where("NOT coalesce(done, false)")
                       .select("q", "own", F.coalesce("nearer", "bound").cast("int").alias("bound")), "open")
        if still.isEmpty():
            break
    else:
        closed.append(found.where("NOT done").select("q", "own", "code", "distance"))
    answers = closed[0]
    for more in closed[1:]:
        answers = answers.unionByName(more)
    near = (answers.join(codes, "code")
            .groupBy("q", "own").agg(F.sort_array(F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct(
                F.col("distance").alias("distance"), i["id"].alias("id"), i["rows"].alias("rows")))))).alias("near"))
            .select("q", F.slice("near", 1, k + F.col("own")).alias("near")))
    others = F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k)
    return (asked.join(near, asked.code == near.q)
            .select("query_id", F.slice(F.flatten(F.transform(others, lambda x: F.array_repeat(x, x["rows"]))), 1, k).alias("near"))
            .select("query_id", F.posexplode("near").alias("at", "hit"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.id").alias("id"), F.col("hit.distance").cast("int").alias("distance")))
