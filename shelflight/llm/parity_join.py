"""N-gram Jaccard join by parity sketches, and the groups that its links form.

A document is the set of its distinct shingles of five words.  Two sets of sizes a <= b with similarity of at least
0.8 have b <= 1.25 a and differ in at most (a + b) / 9 <= a / 4 shingles.

**Sketch.** Every shingle flips one bit of a long bit string, chosen by its hash: shingles that two sets share cancel
out when the strings are compared, so their Hamming distance never exceeds the symmetric difference.

**Pigeonhole join.** Sizes fall into bands of ratio 1.25; a group joins the documents of a band with those of the band
and the next.  With at most D differences in a group, the string is cut into P > D parts, and at least P - D parts of a
linked pair are equal.  Parts are compared by an XOR of hashes of their shingles.  Empty parts are equal in too many
documents; with E empty parts at least P - D - E equal parts are not empty, so only documents with E >= P - D list
their empty parts too, and no linked pair is lost.

**Links without pairs.** Of documents with an equal part, all are first compared with the least one alone: candidates
number no more than parts, however large a group of copies is.  Verified links make components.  A list of equal parts
whose documents then lie in one component is done.  The others are compared in blocks, across components only, by size
and by the sketches' Hamming distance; what passes is verified, and the components are joined.  Every linked pair is
thus verified or already connected.

Verification counts the shingles of both texts, by 64-bit hashes of their words.

Null and empty texts, and texts without words, have the empty set: they link with nothing.  Rows with one ``doc_id``
are one document; with different texts it has the links of all of them, and ``n_shingles`` is that of each row.  Rows
with a null ``doc_id`` link with nothing and have a null component.  An empty table gives an empty result.  Other
columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflight.llm.common import arrow_pass, batch, stored

SHINGLE, RATIO = 5, 1.25
#: Documents in a block of a list that is compared block by block.
BLOCK = 1024
#: Members of a lot of lists, and pairs that a task remembers.
LOT, REMEMBERED = 100_000, 100_000
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Distinct shingle hashes of a text, in order."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(SHINGLE, len(codes))
    n = len(codes) - width + 1
    total = np.full(n, width, np.uint64)
    for i in range(width):
        total += mix(codes[i:i + n] + np.uint64(i)) * _FACTORS[i]
    return np.unique(mix(total))


def upper(low: int) -> int:
    """Largest size of the band that begins at ``low``: the largest that can link with it."""
    return max(low, math.floor(low * RATIO))


_bands: list[tuple[int, int]] = [(1, upper(1))]


def _band_of(n: int) -> int:
    while _bands[-1][1] < n:
        low = _bands[-1][1] + 1
        _bands.append((low, upper(low)))
    first, last = 0, len(_bands) - 1
    while first < last:
        middle = (first + last) // 2
        first, last = (first, middle) if _bands[middle][1] >= n else (middle + 1, last)
    return first


def _parts(group: int) -> tuple[int, int]:
    """Most differences of a linked pair in a group, and its number of parts."""
    most = _bands[group][1] // 4
    return most, most + 1 + -(-most * 3 // 20)


def part_keys(hashes: np.ndarray) -> np.ndarray:
    """Keys of the parts of a set, in all groups that it belongs to."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.uint64)
    own = _band_of(n)
    out = []
    for group in (own, own - 1):
        # In the group below it can only be the larger one, of at most 1.25 times that band's end.
        if group < 0 or group < own and n > _bands[group][1] * RATIO:
            continue
        most, parts = _parts(group)
        at = (hashes % np.uint64(parts)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        first = np.flatnonzero(np.concatenate(([True], np.diff(at[order]) > 0)))
        found, sums = at[order][first], np.bitwise_xor.reduceat(mix(hashes[order] ^ np.uint64(0x5851F42D4C957F2D)), first)
        if parts - len(found) >= parts - most:
            empty = np.setdiff1d(np.arange(parts), found)
            found, sums = np.concatenate((found, empty)), np.concatenate((sums, np.zeros(len(empty), np.uint64)))
        out.append(mix(sums + mix(found.astype(np.uint64) + (np.uint64(group + 1) << np.uint64(40)))))
    return np.concatenate(out)


def sketch(hashes: np.ndarray) -> bytes:
    """Parity sketch of at least twice as many bits as the set has elements, a power of two."""
    size = 64
    while size < 2 * len(hashes):
        size *= 2
    return np.packbits(np.bincount((mix(hashes) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1).tobytes()


def folded(one: bytes, size: int) -> np.ndarray:
    """A sketch as 64-bit words, folded to ``size`` bytes; packed bits fold by whole bytes."""
    bits = np.frombuffer(one, np.uint8)
    while len(bits) > size:
        bits = bits[:len(bits) // 2] ^ bits[len(bits) // 2:]
    return bits.view(np.uint64)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets reach the similarity."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < 80 * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 80 * (len(a) + len(b) - both)


def _lists(docs: DataFrame, buckets: int) -> DataFrame:
    """One pass: rows of documents (``doc_id, n, sketch``), candidates (``a, b``), and lists of three and more.

    Parts travel as arrays, dealt by key into buckets; a bucket is sorted on its own.
    """
    def cut(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        held_keys: list[np.ndarray] = []
        held_docs: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            keys, ids = np.concatenate(held_keys), np.concatenate(held_docs)
            at = (keys % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(at, kind="stable")
            at, keys, ids = at[order], keys[order], ids[order]
            ends = np.flatnonzero(np.append(np.diff(at) > 0, True)) + 1
            starts = np.concatenate(([0], ends[:-1]))
            none = [None] * len(ends)
            return batch([at[starts], none, none, none, [keys[s:e].tobytes() for s, e in zip(starts, ends)],
                          [ids[s:e].tobytes() for s, e in zip(starts, ends)]], schema)

        for b in batches:
            ids, counts, sketches = b.column(0).to_pylist(), [], []
            for doc, t in zip(ids, b.column(1)):
                hashes = shingles(t.as_py())
                counts.append(len(hashes))
                sketches.append(sketch(hashes) if len(hashes) else None)
                if doc is not None and len(hashes):
                    keys = part_keys(hashes)
                    held_keys.append(keys)
                    held_docs.append(np.full(len(keys), doc, np.int64))
                    held += len(keys)
                if held >= 500_000:
                    yield flush()
                    held_keys, held_docs, held = [], [], 0
            none = [None] * len(ids)
            yield batch([[i % buckets for i in range(len(ids))], ids, counts, sketches, none, none], schema)
        if held:
            yield flush()

    def meet(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        def lists(keys: list[bytes], ids: list[bytes]) -> pa.RecordBatch | None:
            key, doc = (np.frombuffer(b"".join(x), kind) for x, kind in ((keys, np.uint64), (ids, np.int64)))
            order = np.lexsort((doc, key))
            key, doc = key[order], doc[order]
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])))
            key, doc = key[new], doc[new]
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            sizes = np.diff(np.append(starts, len(key)))
            many = sizes > 1
            if not many.any():
                return None
            starts, sizes = starts[many], sizes[many]
            least = np.repeat(doc[starts], sizes - 1)
            rest = np.ones(sizes.sum(), bool)
            ends = np.cumsum(sizes)
            rest[ends - sizes] = False
            at = np.repeat(starts - (ends - sizes), sizes) + np.arange(sizes.sum())
            pairs = np.unique(np.stack((least, doc[at[rest]]), 1), axis=0) if len(least) else np.zeros((0, 2), np.int64)
            longer = {doc[s:s + n].tobytes() for s, n in zip(starts[sizes > 2], sizes[sizes > 2])}
            n, m = len(pairs), len(longer)
            return batch([[None] * (n + m), [None] * (n + m), [None] * (n + m), [*pairs[:, 0].tolist(), *[None] * m],
                          [*pairs[:, 1].tolist(), *[None] * m],
                          [*[None] * n, *[np.frombuffer(x, np.int64) for x in longer]]], schema)

        bucket, keys, ids = None, [], []
        for b in batches:
            whole = b.filter(pc.is_null(b.column(4)))
            if whole.num_rows:
                none = [None] * whole.num_rows
                yield batch([whole.column(1), whole.column(2), whole.column(3), none, none, none], schema)
            cut_rows = b.filter(pc.is_valid(b.column(4)))
            for at, k, i in zip(*(cut_rows.column(c).to_pylist() for c in (0, 4, 5))):
                if at != bucket:
                    if keys and (found := lists(keys, ids)) is not None:
                        yield found
                    bucket, keys, ids = at, [], []
                keys.append(k)
                ids.append(i)
        if keys and (found := lists(keys, ids)) is not None:
            yield found

    parts = arrow_pass(docs.select(F.col("doc_id").cast("bigint"), "text"), cut,
                       "bucket int, doc_id bigint, n int, sketch binary, keys binary, ids binary")
    placed = parts.repartition("bucket").sortWithinPartitions("bucket")
    return stored(arrow_pass(placed, meet, "doc_id bigint, n int, sketch binary, a bigint, b bigint, members array<bigint>"), "lists")


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose texts reach the similarity."""
    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
    # Only texts of candidates are stored.  The ids are a stored table, whose size tells Spark how to join them.
    texts = stored(docs.select(F.col("doc_id").cast("bigint").alias("id"), "text").join(ids, "id", "left_semi"), "texts")

    def check(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        last: tuple[str | None, np.ndarray] = (None, np.zeros(0, np.uint64))
        for b in batches:
            keep = []
            for one, other in zip(b.column(2), b.column(3)):
                left = one.as_py()
                if left != last[0]:
                    last = (left, shingles(left))
                keep.append(linked(last[1], shingles(other.as_py())))
            yield batch([b.column(0), b.column(1)], schema).filter(pa.array(keep, pa.bool_()))

    met = (pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
           .join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a"))
    return stored(arrow_pass(met.select("a", "b", "text_a", "text_b"), check, "a bigint, b bigint").distinct(), "links")


def _near(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs whose sizes and sketches do not rule out a link."""
    def check(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for n, m, one, other in zip(*(b.column(i).to_pylist() for i in range(2, 6))):
                size = min(len(one), len(other))
                keep.append(100 * min(n, m) >= 80 * max(n, m)
                            and 9 * int(np.bitwise_count(folded(one, size) ^ folded(other, size)).sum()) <= n + m)
            yield batch([b.column(0), b.column(1)], schema).filter(pa.array(keep, pa.bool_()))

    one = known.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
    other = known.select(F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
    met = pairs.join(one, "a").join(other, "b").select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b")
    return arrow_pass(met, check, "a bigint, b bigint").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``links`` (``a, b``): the least node that it reaches.

    Large and small stars in turn: each round hangs neighbours on the least one that their common node knows.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        after = stored(hung.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        mark = [F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
        if tuple(edges.agg(*mark).first()) == tuple(after.agg(*mark).first()):
            break
        edges = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node").unionByName(roots)


def _across(lists: DataFrame, known: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs of mixed lists that lie in different components and that sizes and sketches do not rule out.

    Versions of one text share many lists, so lists with the same least component go to the same lots, and a
    task gives a pair once.  A lot holds about ``LOT`` members, so a large group has many; the meetings of the blocks
    of one long list are dealt out over them.
    """
    listed = lists.select(F.xxhash64("members").alias("list"), F.posexplode("members").alias("at", "doc_id"))
    placed = (listed.join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left")
              .withColumn("component", F.coalesce("component", "doc_id")))
    mixed = placed.groupBy("list").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.max("at").alias("last"))
    mixed = stored(mixed.where("low < high").select("list", "low", "last", F.expr(f"last div {BLOCK}").cast("int").alias("blocks")), "mixed")
    lots = mixed.groupBy("low").agg(F.ceil(F.sum((F.col("last") + 1) * (F.col("blocks") + 1)) / LOT).alias("lots"))
    mixed = mixed.join(lots, "low").select("list", "low", "blocks", "lots")
    # A member goes to its block's own meeting and to those with the other blocks of its list.
    rows = (placed.join(mixed, "list").withColumn("block", F.expr(f"at div {BLOCK}").cast("int"))
            .select("low", "lots", "list", "doc_id", "component", "block", F.explode(F.expr("sequence(0, blocks)")).alias("other"))
            .select("low", "lots", "list", "doc_id", "component", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
            .withColumn("lot", F.pmod(F.xxhash64("list", "i", "j"), "lots")))
    rows = rows.join(known.select("doc_id", "n", "sketch"), "doc_id")

    def compare(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()

        def pairs(group: list[tuple]) -> list[tuple[int, int]]:
            within = group[0][1] == group[0][2]
            block, ids, of, n = (np.array([g[k] for g in group]) for k in (3, 4, 5, 6))
            names, counts = np.unique(of, return_counts=True)
            usual = names[np.argmax(counts)]  # of two members of different components, one is not of the usual one
            found = []
            folds: dict[int, np.ndarray] = {}
            bytes_of = np.array([len(g[7]) for g in group])
            for x in np.flatnonzero(of != usual):
                fit = (of != of[x]) & (100 * np.minimum(n, n[x]) >= 80 * np.maximum(n, n[x])) & ((of == usual) | (ids > ids[x]))
                if not within:
                    fit &= block != block[x]
                at = np.flatnonzero(fit)
                for small in np.unique(np.minimum(bytes_of[at], bytes_of[x])).tolist():
                    some = at[np.minimum(bytes_of[at], bytes_of[x]) == small]
                    if small not in folds:
                        folds[small] = np.zeros((len(group), small // 8), np.uint64)
                        for y in np.flatnonzero(bytes_of >= small):
                            folds[small][y] = folded(group[y][7], small)
                    apart = np.bitwise_count(folds[small][some] ^ folds[small][x]).sum(axis=1, dtype=np.int64)
                    for y in ids[some[9 * apart <= n[some] + n[x]]].tolist():
                        pair = (min(y, int(ids[x])), max(y, int(ids[x])))
                        if pair not in seen:
                            seen.add(pair)
                            found.append(pair)
            if len(seen) > REMEMBERED:
                seen.clear()
            return found

        at, group = None, []
        for b in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if row[:3] != at:
                    if group:
                        out += pairs(group)
                    at, group = row[:3], []
                group.append(row)
            yield batch([[x for x, _ in out], [y for _, y in out]], schema)
        if group:
            out = pairs(group)
            yield batch([[x for x, _ in out], [y for _, y in out]], schema)

    met = rows.repartition("low", "lot").sortWithinPartitions("low", "lot", "list", "i", "j")
    return arrow_pass(met.select("list", "i", "j", "block", "doc_id", "component", "n", "sketch"), compare, "a bigint, b bigint").distinct()


def join(docs: DataFrame, buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents (``doc_id, n_shingles``, one per row) and their components (``node, component``).

    ``buckets`` are the lots that parts are sorted in, by default sixteen for each shuffle partition.
    """
    spark = docs.sparkSession
    buckets = buckets or 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = _lists(docs.select("doc_id", "text"), buckets)
    rows = table.where("n IS NOT NULL").select("doc_id", "n", "sketch")
    known = rows.where("n > 0 AND doc_id IS NOT NULL")
    pairs = table.where("a IS NOT NULL").select("a", "b").distinct()
    first = _verified(stored(_near(pairs, known), "near"), docs)
    groups = stored(components(first), "groups")
    lists = table.where("members IS NOT NULL").select("members").distinct()
    # A pair that failed before may come again here; it fails again.
    more = _verified(stored(_across(lists, known, groups), "across"), docs)
    if not more.isEmpty():
        groups = components(first.unionByName(more))
    return rows.select("doc_id", F.col("n").cast("bigint").alias("n_shingles")), groups


def similar_groups(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id``."""
    rows, groups = join(docs, buckets)
    return (rows.join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))
