"""Compression of vectors to codes of their parts, by equal-average search.

Vectors become whole numbers, ``floor(4096 x)``, and are cut into equal consecutive parts.  Every part position has a
codebook that starts as that part of the vectors with the least ids; rounds assign every part to the nearest entry and
replace each entry by the floor of its parts' mean.

**Search.** For vectors of d components, ``(sum a - sum b)^2 / d`` is at most their squared distance.  So entries are
sorted by the sum of their components, and a part looks outward from its own sum, always at the nearer side, until the
squared gap exceeds d times the best distance: no entry beyond can be as near.  Equal distances go to the lower index, and
the gap has to exceed strictly, so no tie is lost.

A round is one pass that sends the sums of each entry's parts once per task; entries and sums number ``parts x entries
x d``, which the driver holds, and are added as exact whole numbers.  Numbers too large for 64-bit arithmetic are
worked with as Python's whole numbers, with the same result.

Vectors that are null or hold null or non-finite components are dropped.  The length of vectors is that of the row
with the least key among those whose length the parts divide; rows of another length stay without code and error.
Rows with null keys are coded but begin no codebook; repeated rows count each; among rows with one key the lesser vector
comes first.  With fewer rows than entries the codebooks are smaller.  An error beyond 64 bits is given as the largest
long.  An empty table gives an empty result.  Other columns are kept, but for those named like the outputs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflight.functions.quantiles import join_groups
from shelflight.llm.common import arrow_pass, batch, stored

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Sums travel in limbs of so many bits.
LIMB = 40
MOST = (1 << 63) - 1

Books = list[np.ndarray]


def whole(values: np.ndarray) -> np.ndarray:
    """``floor(SCALE * x)``: 64-bit numbers, or Python's where the search would not fit those."""
    x = values.astype(np.float64)
    with np.errstate(over="ignore"):
        scaled = np.floor(x * SCALE)
    if not x.size or np.abs(scaled).max() < 1 << 52:
        return scaled.astype(np.int64)
    out = np.empty(x.shape, object)
    out.flat = [int(v) * SCALE if abs(v) >= 1 << 53 else int(np.floor(v * SCALE)) for v in x.flat]
    return out


def _wide(numbers: np.ndarray, d: int) -> bool:
    """Whether squares of gaps between such numbers need more than 64 bits."""
    return numbers.dtype == object or bool(numbers.size) and int(np.abs(numbers).max()) >= (1 << 30) // d


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each row of ``x`` the nearest entry's index and squared distance, and how many distances were worked out."""
    n, d = x.shape
    if _wide(x, d) or _wide(book, d):
        x, book = x.astype(object), book.astype(object)
    sums = book.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    sums, own = sums[order], x.sum(axis=1)
    right = np.searchsorted(sums, own)
    left = right - 1
    code, best, seen = np.zeros(n, np.int64), np.full(n, -1, x.dtype), 0
    at = np.arange(n)
    for _ in range(len(book)):
        below, above = left[at] >= 0, right[at] < len(book)
        low = np.where(below, own[at] - sums[np.maximum(left[at], 0)], -1)
        high = np.where(above, sums[np.minimum(right[at], len(book) - 1)] - own[at], -1)
        down = below & (~above | (low <= high))
        gap = np.where(down, low, high)
        # A gap of -1 is that of neither side.
        open_rows = (below | above) & ((best[at] < 0) | (gap * gap <= best[at] * d))
        at, down = at[open_rows], down[open_rows]
        if not len(at):
            break
        entry = order[np.where(down, left[at], right[at])]
        away = x[at] - book[entry]
        distance = (away * away).sum(axis=1)
        seen += len(at)
        nearer = (best[at] < 0) | (distance < best[at]) | ((distance == best[at]) & (entry < code[at]))
        best[at[nearer]], code[at[nearer]] = distance[nearer], entry[nearer]
        left[at[down]] -= 1
        right[at[~down]] += 1
    return code, best, seen


def _rows(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors of a column have the length, and those as whole numbers."""
    fit = np.diff(column.offsets.to_numpy()) == dim
    flat = column.filter(pa.array(fit)).flatten().to_numpy(zero_copy_only=False)
    return fit, whole(flat).reshape(-1, dim)


def _kept(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector has components alone that are finite."""
    endless = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vectors.where(F.col(vector).isNotNull() & ~F.exists(F.col(vector).cast("array<double>"), endless))


def fit(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
        rounds: int = ROUNDS) -> Books:
    """Codebooks of the parts, ``entries x d`` each; none if no vector begins one."""
    rows = _kept(vectors, vector).select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v")).where("key IS NOT NULL")
    divided = rows.where((F.size("v") > 0) & (F.size("v") % parts == 0))
    first = divided.orderBy("key", "v").select(F.size("v")).first()
    if first is None:
        return []
    dim = first[0]
    d = dim // parts
    seeds = [r["v"] for r in divided.where(F.size("v") == dim).orderBy("key", "v").limit(entries).collect()]
    books = [b.copy() for b in np.split(whole(np.array(seeds)), parts, axis=1)]
    values = _kept(vectors, vector).select(F.col(vector).cast("array<double>").alias("v")).where(F.size("v") == dim)
    for _ in range(rounds):
        sums: dict[int, int] = {}
        for r in _sums(values, books, dim).collect():  # parts x entries x (d + 1) slots, whatever the input
            sums[r["slot"]] = sums.get(r["slot"], 0) + (r["n"] << LIMB * r["limb"])
        for p, book in enumerate(books):
            fresh = book.astype(object)
            for e in range(len(book)):
                slot = (p * len(book) + e) * (d + 1)
                if count := sums.get(slot + d, 0):
                    fresh[e] = [sums.get(slot + i, 0) // count for i in range(d)]
            books[p] = fresh if int(np.abs(fresh).max()) > MOST >> 1 else fresh.astype(np.int64)
    return books


def _sums(values: DataFrame, books: Books, dim: int) -> DataFrame:
    """``slot, limb, n``: sums of the components, and the number, of the parts that each entry is nearest to."""
    entries, d = len(books[0]), dim // len(books)

    def step(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(books), entries, d + 1), object)
        for b in batches:
            _, x = _rows(b.column(0), dim)
            for p, (part, book) in enumerate(zip(np.split(x, len(books), axis=1), books)):
                code = nearest(part, book)[0]
                own = np.zeros((entries, d + 1), part.dtype)
                np.add.at(own, code, np.column_stack((part, np.ones(len(part), part.dtype))))
                total[p] += own
        slots, limbs, numbers = [], [], []
        for slot, n in enumerate(total.flat):
            n, limb = int(n), 0
            while n:
                # The last limb has the sign.
                last = abs(n) < 1 << LIMB
                slots.append(slot)
                limbs.append(limb)
                numbers.append(n if last else n & (1 << LIMB) - 1)
                n, limb = 0 if last else n >> LIMB, limb + 1
        yield batch([slots, limbs, numbers], schema)

    return arrow_pass(values, step, "slot int, limb int, n bigint").groupBy("slot", "limb").agg(F.sum("n").alias("n"))


def encode(vectors: DataFrame, books: Books, vector: str = "embedding") -> DataFrame:
    """``vectors`` that are kept, with ``code`` (two hex digits a part) and ``error``."""
    kept = _kept(vectors, vector).drop("code", "error")
    dim = sum(b.shape[1] for b in books)
    at = kept.columns.index(vector)
    fields = [*kept.schema.fields, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]

    def step(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes: list[str | None] = [None] * b.num_rows
            errors: list[int | None] = [None] * b.num_rows
            if books:
                fit, x = _rows(b.column(at), dim)
                found = [nearest(part, book)[:2] for part, book in zip(np.split(x, len(books), axis=1), books)]
                names = np.stack([code for code, _ in found], axis=1).astype(np.uint8)
                error = sum(best.astype(object) for _, best in found)
                for row, name, e in zip(np.flatnonzero(fit).tolist(), names, error):
                    codes[row], errors[row] = name.tobytes().hex(), min(int(e), MOST)
            yield batch([*b.columns, codes, errors], schema)

    return arrow_pass(kept, step, T.StructType(fields))


def decode(coded: DataFrame, books: Books, code: str = "code") -> DataFrame:
    """``coded`` with ``decoded``: the vector of the entries that a code names, as fractions again."""
    tables = [(b / SCALE).astype(float) for b in books]
    kept = coded.drop("decoded")
    at = kept.columns.index(code)
    fields = [*kept.schema.fields, T.StructField("decoded", T.ArrayType(T.DoubleType()))]

    def step(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.column(at).to_pylist()
            yield batch([*b.columns, [None if n is None else np.concatenate([t[e] for t, e in zip(tables, bytes.fromhex(n))]) for n in names]], schema)

    return arrow_pass(kept, step, T.StructType(fields))


def books_sha256(books: Books) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for entry in b for x in entry).encode()).hexdigest()


def coded(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Per kept row: key, ``code, error``, the errors of its label together (``label_error``) and the codebooks' digest."""
    books = fit(vectors, key, vector)
    rows = stored(encode(vectors.select(F.col(key).alias("_key"), F.col(label).alias("_label"), F.col(vector).alias("_v")), books, "_v").drop("_v"), "coded")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    total = F.when(total > MOST, F.lit(MOST)).otherwise(total.cast("bigint"))
    per_label = stored(rows.groupBy("_label").agg(total.alias("label_error")), "labels")
    return join_groups(rows, per_label, ["_label"]).select(
        F.col("_key").alias(key), "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))
