"""Removal of repeated passages by longest-previous-factor arrays.

A byte goes if it lies in a string of ``MATCH`` bytes that also starts in a document with a smaller ``doc_id``: if, at
one of the positions that cover it, the longest previous factor among smaller documents has at least that length.
Only factors of that length matter, so suffixes are ordered by their first ``MATCH`` bytes.

**Dealing.** A suffix array of the whole corpus would sit in one place.  Equal strings share the least hash of their
K-grams, so positions are dealt by it: neighbouring positions with one least hash travel as one run of text, and
all suffixes that could match meet in one bucket.  A run that several documents of a batch have travels once, for the
least of them; the later ones are matched already.  So a passage that very many documents share is met once per batch.

**Suffix order.** A bucket drops suffixes whose hash no other document has.  The rest are sorted by their bytes, then
document and position; neighbours have a longest common prefix of ``MATCH`` or less.  Among suffixes with all ``MATCH``
bytes in common the order is by document, so the previous smaller position, if there is one, is found at the head of
the stretch, and the next smaller one cannot lie behind: the head decides.

**Cutting.** Matched positions go back to their documents as spans, which are merged and cut out.  Everything is judged
on the input, overlaps count, and a document's own repetitions stay.

Text is taken as UTF-8, null as empty.  Texts shorter than ``MATCH`` lose nothing.  Documents with a null ``doc_id`` lose
nothing and count as no one's earlier document.  Rows that share a ``doc_id`` are not earlier than each other; repeated
rows are cut alike.  Very long texts are treated whole.  Other columns are kept by ``cut``.  An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelflight.llm.common import arrow_pass, batch, stored

MATCH, GRAM = 50, 12
#: Bytes of text after which a task sends its runs, and spans after which it sends spans.
BATCH_BYTES, BATCH_SPANS = 16 << 20, 1 << 20
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)
_AT = (0, 8, 16, 24, 32, 40, MATCH - 8)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def eights(text: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on, as numbers whose order is that of the bytes; a view, not a copy."""
    return np.ndarray((len(text) - 7,), ">u8", text, strides=(1,))


def suffix_hash(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of the ``MATCH`` bytes from positions on."""
    total = np.zeros(len(at), np.uint64)
    for k, shift in enumerate(_AT):
        total += x[at + shift].astype(np.uint64) * _ODD[k]
    return mix(total)


def runs(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First position, number of positions, and least hash of the runs of a text of at least ``MATCH`` bytes."""
    x = eights(text)
    last = GRAM - 8
    grams = mix(x[:-last].astype(np.uint64) * _ODD[0] + x[last:].astype(np.uint64) * _ODD[1])
    least, width, span = grams, 1, MATCH - GRAM + 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[:width - span], least[span - width:])
    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    return first, np.diff(np.append(first, len(least))), least[first]


def _gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of several stretches, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _columns(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte: the lowest byte of all, then the next; high bytes, mostly zero, then pack to almost nothing."""
    return np.ascontiguousarray(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _numbers(data: bytes, n: int, at: int) -> np.ndarray:
    """The numbers of ``_columns``."""
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, 4 * n, at).reshape(4, n).T).view("<i4").reshape(-1).astype(np.int64)


class _Sender:
    """Runs of a batch of documents, folded and dealt to buckets."""

    def __init__(self, buckets: int) -> None:
        self.buckets, self.pack = buckets, zstandard.ZstdCompressor(level=3)
        self.clear()

    def clear(self) -> None:
        self.texts: list[np.ndarray] = []
        self.docs: list[tuple[int, int]] = []
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, doc: int, mark: int, text: np.ndarray) -> None:
        first, count, least = runs(text)
        self.parts.append((first, count, least))
        self.texts.append(text)
        self.docs.append((doc, mark))
        self.size += len(text)

    def send(self) -> tuple[list[int], list[bytes], np.ndarray]:
        """Buckets, their blobs, and spans found within the batch."""
        text = np.concatenate(self.texts)
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in self.texts])[:-1]))
        of = np.repeat(np.arange(len(self.parts)), [len(p[0]) for p in self.parts])
        first, count, least = (np.concatenate([p[k] for p in self.parts]) for k in range(3))
        begin = first + offsets[of]
        ids = np.array(self.docs, np.int64)
        # Equal runs: their first and last suffix cover them, unless they are longer than that.
        x = eights(text)
        same = mix(suffix_hash(x, begin) + suffix_hash(x, begin + count - 1) * np.uint64(3) + count.astype(np.uint64) * _ODD[2])
        order = np.lexsort((ids[of, 0], same))
        head = np.maximum.accumulate(np.where(np.concatenate(([True], same[order][1:] != same[order][:-1])), np.arange(len(order)), 0))
        lead = np.empty(len(order), np.int64)
        lead[order] = order[head]
        later = (ids[of, 0] > ids[of[lead], 0]) & (count == count[lead]) & (count <= MATCH)
        at = np.flatnonzero(later)
        if len(at):
            for shift in _AT:
                for end in (0, 1):
                    here, there = begin[at] + end * (count[at] - 1) + shift, begin[lead[at]] + end * (count[at] - 1) + shift
                    later[at[x[here] != x[there]]] = False
            at = np.flatnonzero(later)
        spans = np.stack((ids[of[at], 0], ids[of[at], 1], first[at], first[at] + count[at] + MATCH - 1), 1)
        keep = np.flatnonzero(~later)
        bucket = (least[keep] % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        keep, bucket = keep[order], bucket[order]
        cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(keep) else np.zeros(0, np.int64)
        names, blobs = [], []
        for s, e in zip(cuts, np.append(cuts[1:], len(keep))):
            some = keep[s:e]
            own, back = np.unique(of[some], return_inverse=True)
            sizes = count[some] + MATCH - 1
            names.append(int(bucket[s]))
            blobs.append(self.pack.compress(b"".join((
                np.array([len(own), len(some)], "<i8").tobytes(), ids[own].astype("<i8").tobytes(), _columns(np.diff(back, prepend=0)),
                _columns(first[some]), _columns(count[some]), text[_gather(begin[some], sizes)].tobytes()))))
        self.clear()
        return names, blobs, spans


def previous_factors(text: np.ndarray, begin: np.ndarray, count: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs and positions (within the run) whose longest previous factor in a smaller document has ``MATCH`` bytes."""
    x = eights(text)
    run = np.repeat(np.arange(len(begin)), count)
    at = _gather(begin, count)
    code = suffix_hash(x, at)
    order = np.argsort(code)
    code = code[order]
    heads = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
    whose = doc[run[order]]
    several = np.minimum.reduceat(whose, heads) != np.maximum.reduceat(whose, heads)
    left = order[np.repeat(several, np.diff(np.append(heads, len(code))))]
    if not len(left):
        return left, left
    # Truncated suffix array of what is left, then document order.
    columns = [x[at[left] + shift].astype(np.uint64) for shift in _AT]
    whose = doc[run[left]]
    rank = np.lexsort((whose, *reversed(columns)))
    whole = np.ones(len(rank) - 1, bool)  # whether neighbours have all MATCH bytes in common
    for c in columns:
        c = c[rank]
        whole &= c[1:] == c[:-1]
    head = np.maximum.accumulate(np.where(np.concatenate(([True], ~whole)), np.arange(len(rank)), 0))
    whose = whose[rank]
    found = np.sort(left[rank[whose > whose[head]]])
    return run[found], at[found] - begin[run[found]]


def _spans_of(blob_list: list[bytes]) -> np.ndarray:
    """Spans (document, mark, start, end) of matches in the blobs of one bucket."""
    unpack = zstandard.ZstdDecompressor()
    ids, first, count, texts = [], [], [], []
    for blob in blob_list:
        data = unpack.decompress(blob)
        n_docs, n = np.frombuffer(data, "<i8", 2)
        table = np.frombuffer(data, "<i8", 2 * n_docs, 16).reshape(-1, 2)
        base = 16 + 16 * n_docs
        back, start, size = (_numbers(data, n, base + 4 * n * k) for k in range(3))
        ids.append(table[np.cumsum(back)])
        first.append(start)
        count.append(size)
        texts.append(np.frombuffer(data, np.uint8, offset=base + 12 * n))
    ids, first, count, text = (np.concatenate(x) for x in (ids, first, count, texts))
    begin = np.cumsum(count + MATCH - 1) - (count + MATCH - 1)
    run, at = previous_factors(text, begin, count, ids[:, 0])
    if not len(run):
        return np.zeros((0, 4), np.int64)
    new = np.flatnonzero(np.concatenate(([True], (run[1:] != run[:-1]) | (at[1:] != at[:-1] + 1))))
    last = np.append(new[1:], len(run)) - 1
    where = run[new]
    return np.stack((ids[where, 0], ids[where, 1], first[where] + at[new], first[where] + at[last] + MATCH), 1)


def _lots(found: list[np.ndarray], lots: int) -> tuple[list[int], list[bytes]]:
    """Spans dealt by document into lots, a blob each."""
    spans = np.concatenate(found)
    lot = (spans[:, 0] ^ spans[:, 1]) % lots
    order = np.argsort(lot, kind="stable")
    lot, spans = lot[order], spans[order]
    heads = np.flatnonzero(np.concatenate(([True], lot[1:] != lot[:-1])))
    pack = zstandard.ZstdCompressor(level=3)
    return lot[heads].tolist(), [pack.compress(spans[s:e].astype("<i8").tobytes()) for s, e in zip(heads, np.append(heads[1:], len(spans)))]


def _by_document(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Documents, marks, and merged spans of the blobs of one lot."""
    unpack = zstandard.ZstdDecompressor()
    spans = np.concatenate([np.frombuffer(unpack.decompress(x), "<i8").reshape(-1, 4) for x in blobs])
    spans = spans[np.lexsort((spans[:, 2], spans[:, 1], spans[:, 0]))]
    new = np.concatenate(([True], (spans[1:, :2] != spans[:-1, :2]).any(axis=1)))
    # Ends so far within a document: documents are lifted above each other, so that one running maximum does for all.
    lift = (np.cumsum(new) - 1) * (int(spans[:, 3].max()) + 1)
    reach = np.maximum.accumulate(spans[:, 3] + lift)
    fresh = new | np.concatenate(([True], spans[1:, 2] + lift[1:] > reach[:-1]))
    heads = np.flatnonzero(fresh)
    ends = (reach - lift)[np.append(heads[1:], len(spans)) - 1]
    merged = np.stack((spans[heads, 2], ends), 1).astype("<i4")
    first = np.flatnonzero(new[heads])
    last = np.append(first[1:], len(heads))
    return spans[heads[first], 0], spans[heads[first], 1], [merged[s:e].tobytes() for s, e in zip(first, last)]


def matches(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """``doc_id, mark, spans``: per document and text hash, the merged spans that earlier documents have."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets, lots = buckets or 16 * partitions, partitions

    def send(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        sender = _Sender(buckets)

        def flush() -> pa.RecordBatch:
            names, blobs, spans = sender.send()
            lot, own = _lots([spans], lots) if len(spans) else ([], [])
            # Spans of a lot go along to the bucket of its number, and from there with the others.
            return batch([names + lot, blobs + [None] * len(lot), [None] * len(names) + own], schema)

        for b in batches:
            for doc, mark, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                data = (t.as_py() or "").encode()
                if doc is not None and len(data) >= MATCH:
                    sender.add(doc, mark, np.frombuffer(data, np.uint8))
                if sender.size >= BATCH_BYTES:
                    yield flush()
        if sender.size:
            yield flush()

    def receive(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        bucket, blobs, found, held = None, [], [], 0
        for b in batches:
            for at, blob, spans in zip(*(c.to_pylist() for c in b.columns)):
                if blob is None:
                    yield batch([[at], [spans]], schema)
                    continue
                if at != bucket and blobs:
                    found.append(_spans_of(blobs))
                    held += len(found[-1])
                    blobs = []
                bucket = at
                blobs.append(blob)
                if held >= BATCH_SPANS:
                    yield batch([*_lots(found, lots)], schema)
                    found, held = [], 0
        if blobs:
            found.append(_spans_of(blobs))
        if sum(map(len, found)):
            yield batch([*_lots(found, lots)], schema)

    def gather(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        lot, blobs = None, []
        for b in batches:
            for at, blob in zip(*(c.to_pylist() for c in b.columns)):
                if at != lot and blobs:
                    yield batch([*_by_document(blobs)], schema)
                    blobs = []
                lot = at
                blobs.append(blob)
        if blobs:
            yield batch([*_by_document(blobs)], schema)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    sent = arrow_pass(rows, send, "bucket bigint, blob binary, spans binary")
    placed = sent.repartition("bucket").sortWithinPartitions("bucket")
    found = stored(arrow_pass(placed, receive, "lot bigint, spans binary"), "spans")
    return arrow_pass(found.repartition("lot").sortWithinPartitions("lot"), gather, "doc_id bigint, mark bigint, spans binary")


def _kept(data: bytes, spans: bytes | None) -> tuple[bytes, int, int]:
    """What is left of a text, bytes removed, and stretches removed; spans are merged and in order."""
    if not spans:
        return data, 0, 0
    own = np.frombuffer(spans, "<i4").reshape(-1, 2).tolist()
    left, at, gone = [], 0, 0
    for start, end in own:
        left.append(data[at:start])
        gone += end - start
        at = end
    left.append(data[at:])
    return b"".join(left), gone, len(own)


def _met(docs: DataFrame, buckets: int | None) -> DataFrame:
    found = matches(docs, buckets).select(F.col("doc_id").alias("__doc"), F.col("mark").alias("__mark"), F.col("spans").alias("__spans"))
    return docs.join(found, (F.col("doc_id") == found["__doc"]) & (F.xxhash64("text") == found["__mark"]), "left").drop("__doc", "__mark")


def cut(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """``docs`` with ``text`` cut; a character that a cut goes through is dropped whole."""
    kept = docs.drop("__doc", "__mark", "__spans")
    at = kept.columns.index("text")

    def step(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for t, spans in zip(b.column(at), b.column(b.num_columns - 1)):
                text, spans = t.as_py(), spans.as_py()
                texts.append(text if text is None or not spans else _kept(text.encode(), spans)[0].decode("utf-8", "ignore"))
            yield batch([texts if i == at else b.column(i) for i in range(b.num_columns - 1)], schema)

    return arrow_pass(_met(kept, buckets), step, T.StructType(kept.schema.fields))


def digests(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    def step(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, removed, stretches, sums = [], [], [], []
            for t, spans in zip(b.column(1), b.column(2)):
                data = (t.as_py() or "").encode()
                left, n, runs_gone = _kept(data, spans.as_py())
                sizes.append(len(data))
                removed.append(n)
                stretches.append(runs_gone)
                sums.append(hashlib.sha256(left).hexdigest())
            yield batch([b.column(0), sizes, removed, stretches, sums], schema)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_pass(_met(docs.select("doc_id", "text"), buckets), step,
                      f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
