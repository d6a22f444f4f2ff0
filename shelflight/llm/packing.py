"""Packing of documents into sequences by shortest-pack-first over the histogram of lengths.

Every document's ids, with an end id, are cut into pieces of the sequence length and a shorter rest.  Ranks number the
pieces of each length.  The plan sees the histogram of lengths alone: it goes through the lengths from the longest, puts
as many pieces as it can into the packs with most room, and keeps packs that are filled alike as one pattern with a
count.  All packs are open from the beginning, just as many as the tokens fill, so a length that fits nowhere is cut:
its head fills a pack and its tail joins the histogram at its own, shorter length.  The tokens that no whole pack is
left for go to packs of the powers of two that add up to their number.  So every pack ends full: nothing is padded.

The plan's steps join the pieces back by length and rank.  Ranks are counted within the partitions of the stored
encoding and shifted by a running sum over the partitions per length, so a length that a third of all documents has
is dealt over all tasks.  Histogram and plan are bounded by the sequence length, not by the data: a step ends a length or
uses up a pattern, and each length adds at most one pattern and one cut; corpora of any size give some thousands of steps.

A null or empty text has the end id alone.  Null and repeated keys are documents like others.  An empty table gives an
empty result.  A long text is encoded whole.  Other columns of the input play no part.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelflight.llm.common import arrow_pass, batch, stored, tokenizer_file
from shelflight.llm.token_blocks import encoder_of

SIZE, END_ID = 2048, 1
#: Bytes of ids in a batch of stored documents.
HELD_BYTES = 8 << 20


@dataclass
class Plan:
    """Where the pieces of each length go: for each length the first ranks of its steps, and the steps.

    A step is ``(first rank, packs, sequence, offset, taken, tail)``: pieces go round its ``packs`` from ``sequence`` on,
    at ``offset`` and further on in later turns; ``taken`` of their tokens are placed, and a piece that is longer goes on
    with its tail, whose ranks begin at ``tail``.
    """

    size: int
    sequences: int = 0
    firsts: dict[int, list[int]] = field(default_factory=dict)
    steps: dict[int, list[tuple[int, int, int, int, int, int]]] = field(default_factory=dict)

    def add(self, length: int, step: tuple[int, int, int, int, int, int]) -> None:
        self.firsts.setdefault(length, []).append(step[0])
        self.steps.setdefault(length, []).append(step)

    def place(self, length: int, rank: int) -> Iterator[tuple[int, int, int]]:
        """``(tokens, sequence, offset)`` of the parts of a piece, in order."""
        while True:
            first, packs, sequence, offset, taken, tail = self.steps[length][bisect_right(self.firsts[length], rank) - 1]
            turn, pack = divmod(rank - first, packs)
            yield taken, sequence + pack, offset + turn * length
            if taken == length:
                return
            length, rank = length - taken, tail + pack


def plan(histogram: Mapping[int, int], size: int = SIZE) -> Plan:
    """Shortest-pack-first over ``{length: pieces}``."""
    counts = [0] * (size + 1)
    for length, n in histogram.items():
        counts[length] = n
    whole, rest = divmod(sum(length * n for length, n in enumerate(counts)), size)
    out = Plan(size)
    # Patterns: (room, first sequence, packs, tokens of a full pack), most room first.
    heap = [(-size, 0, whole, size)] if whole else []
    out.sequences = whole
    for bit in range(rest.bit_length()):
        if rest >> bit & 1:
            heap.append((-(1 << bit), out.sequences, 1, 1 << bit))
            out.sequences += 1
    heapq.heapify(heap)
    for length in range(size, 0, -1):
        done = 0
        while done < counts[length]:
            room, sequence, packs, full = heapq.heappop(heap)
            room, left = -room, counts[length] - done
            used = min(packs, left)
            if room >= length:
                # As often as the pattern stays the one with most room.
                next_room = -heap[0][0] if heap else 0
                times = min(room // length, max(0, room - next_room) // length + 1, max(1, left // packs))
                out.add(length, (done, used, sequence, full - room, length, -1))
                remaining = room - times * length
            else:
                times, remaining = 1, 0
                out.add(length, (done, used, sequence, full - room, room, counts[length - room]))
                counts[length - room] += used
            done += used * times
            if remaining:
                heapq.heappush(heap, (-remaining, sequence, used, full))
            if used < packs:
                heapq.heappush(heap, (-room, sequence + used, packs - used, full))
    return out


def _encoded(docs: DataFrame, key: str, text: str, size: int, end_id: int, path: str) -> DataFrame:
    """Stored rows ``part, key, n, whole_at, rest_at, ids``: ids as 16- or 32-bit numbers, and ranks within the part."""
    def step(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        encoder, part = encoder_of(path), TaskContext.get().partitionId()
        narrow = max(encoder.vocab - 1, end_id) < 1 << 16
        end = np.array([end_id], "<u4").tobytes()
        whole, rests = 0, np.zeros(size, np.int64)
        rows: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            return batch([[part] * len(rows), *map(list, zip(*rows))], schema)

        for b in batches:
            for k, ids in zip(b.column(0).to_pylist(), encoder.encode_column(b.column(1))):
                ids += end
                n = len(ids) // 4
                rows.append((k, n, whole, int(rests[n % size]), np.frombuffer(ids, "<u4").astype("<u2").tobytes() if narrow else ids))
                whole += n // size
                rests[n % size] += 1
                held += len(ids)
                if held >= HELD_BYTES:
                    yield flush()
                    rows, held = [], 0
        if rows:
            yield flush()
        encoder.forget()

    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    return stored(arrow_pass(rows, step, "part int, key bigint, n bigint, whole_at bigint, rest_at bigint, ids binary"), "encoded")


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, end_id: int = END_ID,
         path: str | None = None, digest: bool = False) -> DataFrame:
    """Pieces ``key, start, length, doc_tokens, sequence_id, offset`` with ``token_ids``, or with ``ids_crc32`` for a digest."""
    if size < 1:
        raise ValueError("a sequence holds at least one token")
    encoded = _encoded(docs, key, text, size, end_id, path or tokenizer_file("word_bpe_49k.json"))
    lengths = F.array(F.struct(F.lit(size).alias("length"), F.expr(f"n div {size}").alias("pieces")),
                      F.struct((F.col("n") % size).cast("int").alias("length"), F.lit(1).cast("bigint").alias("pieces")))
    counts = stored(encoded.select("part", F.explode(lengths).alias("_l")).select("part", "_l.*").where("length > 0 AND pieces > 0")
                    .groupBy("part", "length").agg(F.sum("pieces").alias("pieces")), "lengths")
    steps = plan({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("pieces").alias("n")).collect()}, size)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per part, with at most ``size`` entries.
    shifts = stored(counts.withColumn("shift", F.coalesce(F.sum("pieces").over(before), F.lit(0)))
                    .groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("length", "shift"))).alias("shifts")), "shifts")
    shift = lambda length: F.coalesce(F.try_element_at("shifts", length), F.lit(0))
    ranked = encoded.join(shifts, "part").select(
        "key", "n", (F.col("whole_at") + shift(F.lit(size))).alias("whole_at"),
        (F.col("rest_at") + shift((F.col("n") % size).cast("int"))).alias("rest_at"), "ids")

    def step(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for k, n, whole_at, rest_at, data in zip(*(c.to_pylist() for c in b.columns)):
                ids = np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4").astype("<u4")
                pieces = [(size, whole_at + i) for i in range(n // size)] + [(n % size, rest_at)] * (n % size > 0)
                start = 0
                for length, rank in pieces:
                    for taken, sequence, offset in steps.place(length, rank):
                        own = ids[start:start + taken]
                        out.append((k, start, taken, n, sequence, offset, zlib.crc32(own.tobytes()) if digest else own.astype(np.int32)))
                        start += taken
            yield batch(list(map(list, zip(*out))) or [[]] * len(schema), schema)

    last = "ids_crc32 bigint" if digest else "token_ids array<int>"
    return arrow_pass(ranked, step, f"key bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, {last}"
                      ).withColumnRenamed("key", key)


def sequences(pieces: DataFrame, size: int = SIZE, pad_id: int = 0) -> DataFrame:
    """``sequence_id, n_tokens, token_ids`` of the packed sequences, padded to ``size`` but for a power of two.

    A sequence has at most ``size`` pieces, so its list is bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "token_ids")))
    whole = pieces.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["token_ids"])).alias("token_ids"))
    n = F.size("token_ids")
    missing = F.when(n.bitwiseAND(n - 1) == 0, 0).otherwise(size - n)
    return whole.select("sequence_id", n.alias("n_tokens"), F.concat("token_ids", F.array_repeat(F.lit(pad_id), missing)).alias("token_ids"))
