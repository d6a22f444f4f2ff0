"""How filters of a corpus interact: what each one removes in every order, exact duplicates included.

The filters fail a document when it has under 50 words (A), when under 65 % of its words are distinct (B), when over 5 %
of its characters are A-Z (C), when it holds a sign of markup or code (D), or when a smaller ``doc_id`` has the same
text (E).  A to D are told from a text alone; each document gets a mask of what it fails.

**Duplicates by radix tries.** Every task folds the texts of its documents in a compressed trie, whose terminals hold
the least id, so a text that a third of all documents have leaves a task once.  The folded texts are range-partitioned
by adaptive prefixes: a prefix starts at 16 bytes and grows fourfold where too many bytes begin with it, until they
are few or the texts themselves end.  A task inserts the whole texts of a run of prefixes in a trie and reads the least
id off each terminal; only texts that another task has too, or several documents of one task, are reported back.
Comparisons are of whole texts; hashes only count prefixes.

**Orders.** Masks are counted per part with their labels, which makes 32 rows a part; the 120 orders of five filters
are worked out from them.

Null texts are empty ones and fail A.  A document with a null ``doc_id`` is neither smaller than another nor larger, so
it fails E never, and has no labels.  Rows that share the least ``doc_id`` of a text all pass E.  Several labels of one
document count if any is 1.  A null part is the empty string.  Empty tables give no parts.  Long texts are compared
whole.  Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflight.llm.common import arrow_pass, batch, stored

FILTERS = "ABCDE"
# Fixed values of the filters.
LEAST_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 50, 65, 5
UPPER, SIGNS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
DUPLICATE = 1 << FILTERS.index("E")
#: Bytes of the first prefix, how much longer the next is, and most bytes that may begin with one.
PREFIX, GROWTH, PREFIX_BYTES = 16, 4, 32 << 20
#: Bytes of texts in a trie, and what a text counts besides its length.
TRIE_BYTES, TEXT_BYTES = 16 << 20, 64


class Node:
    """A place in a trie: the label of the edge to it, the edges from it by first byte, and what ends here."""

    __slots__ = ("label", "edges", "least", "places", "copies")

    def __init__(self, label: bytes) -> None:
        self.label = label
        self.edges: dict[int, Node] | None = None
        self.least: int | None = None
        self.places: list[int] = []
        self.copies = 0

    def end(self, least: int | None, copies: int) -> None:
        """Documents that end here."""
        self.copies += copies
        if least is not None and (self.least is None or least < self.least):
            self.least = least


class Trie:
    """A compressed trie of whole texts; a terminal knows the least id and how many documents ended there."""

    def __init__(self) -> None:
        self.root = Node(b"")

    def insert(self, text: bytes) -> Node:
        """The node of a text; nothing has ended there if the text is new."""
        node, at = self.root, 0
        while at < len(text):
            child = node.edges.get(text[at]) if node.edges else None
            if child is None:
                child = Node(text[at:])
                node.edges = node.edges or {}
                node.edges[text[at]] = child
                return child
            if text.startswith(child.label, at):
                node, at = child, at + len(child.label)
                continue
            # Where text and label part, by halving.
            same, apart = 1, min(len(child.label), len(text) - at + 1)
            while apart - same > 1:
                middle = (same + apart) // 2
                same, apart = (middle, apart) if text.startswith(child.label[:middle], at) else (same, middle)
            fork = Node(child.label[:same])
            child.label = child.label[same:]
            fork.edges = {child.label[0]: child}
            node.edges[text[at]] = fork
            node, at = fork, at + same
        return node

    def terminals(self) -> Iterator[Node]:
        open_nodes = [self.root]
        while open_nodes:
            node = open_nodes.pop()
            if node.copies:
                yield node
            if node.edges:
                open_nodes.extend(node.edges.values())


def fails(text: bytes, points: int) -> int:
    """Mask of the filters A to D that a text fails."""
    words = text.split()  # of bytes: exactly at blanks and 0x09 to 0x0D
    return ((len(words) < LEAST_WORDS)
            | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
            | (100 * (len(text) - len(text.translate(None, UPPER))) > UPPER_PERCENT * points) << 2
            | (len(text.translate(None, SIGNS)) < len(text)) << 3)


def prefix_lengths(n: int) -> list[int]:
    """Prefixes of a text of ``n`` bytes that are shorter than it."""
    out, length = [], PREFIX
    while length < n:
        out.append(length)
        length *= GROWTH
    return out


def _folded(docs: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """One pass: rows of documents (``doc, part, mask, place``) and of folded texts (``place, least, copies, text, prefixes``)."""
    def step(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        place = (TaskContext.get().partitionId() << 36) - 1
        trie, found, held = Trie(), [], 0

        def flush() -> pa.RecordBatch:
            n = len(found)
            none = [None] * n
            prefixes = [[xxhash.xxh3_64_intdigest(t[:k]) - (1 << 63) for k in prefix_lengths(len(t))] for t, _ in found]
            return batch([none, none, none, [x.places[0] for _, x in found], [x.least for _, x in found], [x.copies for _, x in found],
                          [t for t, _ in found], prefixes], schema)

        for b in batches:
            texts = b.column(1).fill_null("")
            ids, masks, places = b.column(0).to_pylist(), [], []
            for doc, data, points in zip(ids, texts.cast(pa.binary()).to_numpy(zero_copy_only=False), pc.utf8_length(texts).to_pylist()):
                masks.append(fails(data, points))
                node = trie.insert(data)
                if not node.copies:
                    place += 1
                    node.places.append(place)
                    found.append((data, node))
                    held += len(data) + TEXT_BYTES
                node.end(doc, 1)
                places.append(node.places[0])
            none = [None] * len(ids)
            yield batch([b.column(0), b.column(2), masks, places, none, none, none, none], schema)
            if held >= TRIE_BYTES:
                yield flush()
                trie, found, held = Trie(), [], 0
        if found:
            yield flush()

    rows = docs.select(F.col(key).cast("bigint"), F.col(text), F.coalesce(F.col(part).cast("string"), F.lit("")))
    return stored(arrow_pass(rows, step, "doc bigint, part string, mask int, place bigint, least bigint, copies bigint, text binary, prefixes array<bigint>"),
                  "folded")


def _depths(texts: DataFrame, limit: int) -> DataFrame | None:
    """``place, depth`` of texts whose prefix has to be longer than the first; None if no text has."""
    found, inside, depth = None, texts.select("place", "prefixes", "size"), 0
    while True:
        here = inside.where(F.size("prefixes") > depth).withColumn("prefix", F.get("prefixes", F.lit(depth)))
        heavy = stored(here.groupBy("prefix").agg(F.sum("size").alias("_s")).where(F.col("_s") > limit).select("prefix"), "prefixes")
        if heavy.isEmpty():
            return found
        depth += 1
        inside = stored(here.join(heavy, "prefix", "left_semi").select("place", "prefixes", "size"), "deeper")
        longer = inside.select("place", F.lit(depth).alias("depth"))
        found = longer if found is None else found.unionByName(longer)


def _repeated(folded: DataFrame) -> DataFrame:
    """``place, least`` of folded texts that have several documents, here or elsewhere."""
    texts = folded.where("text IS NOT NULL").withColumn("size", F.length("text") + TEXT_BYTES)
    partitions = int(folded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = texts.agg(F.sum("size")).first()[0] or 0
    deeper = _depths(texts, min(PREFIX_BYTES, max(total // (4 * partitions), PREFIX_BYTES >> 9)))
    rows = texts.select("place", "least", "copies", "text")
    if deeper is None:
        rows = rows.withColumn("depth", F.lit(0))
    else:
        deeper = stored(deeper.groupBy("place").agg(F.max("depth").alias("depth")), "depths")
        rows = rows.join(deeper, "place", "left").withColumn("depth", F.coalesce("depth", F.lit(0)))
    length = (F.pow(F.lit(GROWTH), F.col("depth")) * PREFIX).cast("int")
    prefix = F.substring(F.col("text"), F.lit(1), length)

    def step(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        trie, last, held = Trie(), None, 0

        def report() -> pa.RecordBatch:
            same = [node for node in trie.terminals() if node.copies > 1]
            return batch([[p for node in same for p in node.places], [node.least for node in same for _ in node.places]], schema)

        for b in batches:
            for place, least, copies, depth, data in zip(*(b.column(i).to_pylist() for i in range(4)), b.column(4).to_numpy(zero_copy_only=False)):
                begins = data[:PREFIX * GROWTH ** depth]
                # Equal texts have equal prefixes, which come one after another.
                if held >= TRIE_BYTES and begins != last:
                    yield report()
                    trie, held = Trie(), 0
                last = begins
                node = trie.insert(data)
                if not node.copies:
                    held += len(data) + TEXT_BYTES
                node.end(least, copies)
                node.places.append(place)
        yield report()

    dealt = rows.repartitionByRange(max(partitions, -(-total // PREFIX_BYTES)), prefix).sortWithinPartitions(prefix)
    return arrow_pass(dealt.select("place", "least", "copies", "depth", "text"), step, "place bigint, least bigint")


def masks(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``doc, part, mask`` of every document: the filters that it fails, A as 1 to E as 16."""
    folded = _folded(docs, key, text, part)
    rows = folded.where("mask IS NOT NULL").select("doc", "part", "mask", "place")
    repeated = stored(_repeated(folded), "repeated")
    later = F.coalesce(F.col("doc") > F.col("least"), F.lit(False))
    return rows.join(repeated, "place", "left").select("doc", "part", (F.col("mask") + F.when(later, DUPLICATE).otherwise(0)).alias("mask"))


def _orders() -> tuple[list[str], list[str], np.ndarray, np.ndarray]:
    """Orders, the filter of each step, its bit, and the bits of the filters before it."""
    names, letters, bits, earlier = [], [], [], []
    for order in permutations(FILTERS):
        before = 0
        for letter in order:
            names.append("".join(order))
            letters.append(letter)
            bits.append(1 << FILTERS.index(letter))
            earlier.append(before)
            before |= bits[-1]
    return names, letters, np.array(bits), np.array(earlier)


def interactions(counts: DataFrame) -> DataFrame:
    """All orders and steps of every part of ``part, mask, n, good, toxic``; a part has at most 32 rows."""
    def step(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        names, letters, bits, earlier = _orders()
        every = np.arange(1 << len(FILTERS))
        fresh = ((every & earlier[:, None]) == 0).astype(np.int64)
        fail = ((every & bits[:, None]) != 0).astype(np.int64)
        only = (every == bits[:, None]).astype(np.int64)
        steps = np.arange(len(names)) % len(FILTERS) + 1
        for b in batches:
            for part, rows in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                n, good, toxic = (np.zeros(len(every), np.int64) for _ in range(3))
                for row in rows:
                    n[row["mask"]], good[row["mask"]], toxic[row["mask"]] = row["n"], row["good"], row["toxic"]
                removed = (fresh * fail) @ n
                total = {f: int(removed[np.array([x == f for x in letters])].sum()) for f in FILTERS}
                yield batch([[part] * len(names), names, steps, (fresh * (1 - fail)) @ n, removed, ((1 - fresh) * fail) @ n, only @ n,
                             (fresh * fail) @ good, (fresh * fail) @ toxic, [total[f] for f in letters]], schema)

    one = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("rows"))
    return arrow_pass(one, step, "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
                                 "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint")


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """One row per part, order of filters and step; ``labels`` has ``quality`` and ``toxic`` by ``key``."""
    def one(column: str) -> Column:
        return F.coalesce(F.max(F.col(column) == 1), F.lit(False)).cast("bigint")

    marked = stored(masks(docs, key, text, part), "masks")
    known = (labels.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("bigint").alias("doc"))
             .agg(one("quality").alias("good"), one("toxic").alias("toxic")))
    # Documents without a key have no labels and would meet in one task.
    told = marked.where("doc IS NOT NULL").join(known, "doc", "left").select("part", "mask", "good", "toxic")
    other = marked.where("doc IS NULL").select("part", "mask", F.lit(None).cast("bigint").alias("good"), F.lit(None).cast("bigint").alias("toxic"))
    return interactions(told.unionByName(other).groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic")))
