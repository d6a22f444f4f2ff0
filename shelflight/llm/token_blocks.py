"""Token ids in binary blocks, packed by an adaptive context-mixing range coder.

A block holds the ids of whole documents.  They are dealt to up to ``LANES`` lanes of equal length, which
are coded side by side, one id per lane and step.  All lanes share the block's model:

* order 0: a frequency for every id, counted so far;
* order 1 and order 2: the id that followed the last one and the last two ids, with a confidence.

The three are mixed: the guesses of order 1 and 2 have weight beside the frequencies of all ids, as much as
guesses of that confidence have earned in the block.  The mixed frequencies drive a carry-free 64-bit range
coder.  The model learns from the ids of a step only after the step, so the decoder follows.  Every block
starts from an empty model and has checksums of its ids and its bytes, so blocks are read alone.

File format: Parquet rows of ``part, seq, first, n_docs, n_tokens, block``; ``part`` numbers the files in
ascending key order and ``first`` the block's first id in its part.  ``block`` is, little-endian:
``MAGIC``, vocabulary size u32, documents u32, ids u64, lanes u32, directory bytes u32, CRC-32 of the ids as
u32, CRC-32 of what follows u32; the directory (zlib: key present u8, key i64, ids u32, each as one array);
the lanes' 16-bit words in the order in which the decoder takes them, which starts with four of each lane.

Null and empty texts have the end id alone.  Null keys come first.  Rows with one key are ordered by their
text's hash; repeated rows stay repeated.  An empty table gives a folder without blocks.  Other columns of the
input play no part.  A text is encoded whole, and a block ends with the document that fills it.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflight.llm.bpe_automaton import byte_letters
from shelflight.llm.common import arrow_pass, batch, tokenizer_file
from shelflight.session import small_table

MAGIC = b"CMRC0002"
HEAD = struct.Struct("<8sIIQIIII")
#: Ids after which a block ends, lanes of a full block, and the fewest steps of a lane.
BLOCK_TOKENS, LANES, MIN_STEPS = 1 << 20, 4096, 256
#: Entries of the order-2 table.
PAIRS = 1 << 18
#: Weight of one counted id, and the sum of frequencies at which all are halved.
COUNTED, HALVE_AT = 16, 1 << 25
TOP, BOTTOM, WORD = np.uint64(1 << 48), np.uint64(1 << 40), np.uint64(16)
LAST = np.uint64(48)
#: How much more weight than all frequencies a guess can earn.
MOST = 15
#: Leading bits by which the decoder looks up frequencies.
GUIDE_BITS = 17
#: By confidence, and 4 more if the guess was wrong: whether it is replaced, and else the change of its confidence.
REPLACED = np.array([0, 0, 0, 0, 1, 1, 0, 0], bool)
CHANGE = np.array([1, 1, 1, 0, 0, 0, -1, -1])
#: Words that one worker remembers, in two generations.
REMEMBERED = 400_000
#: New words that go to the library in one text, and texts whose ids are put together at once.
WORDS_AT_ONCE, TEXTS_AT_ONCE = 5000, 256
BLOCK_SCHEMA = "part int, seq int, first bigint, n_docs int, n_tokens bigint, block binary"
# Lower-case letters of the texts that the fast way takes, and what it does not take: short forms
# after an apostrophe, and characters besides those letters and plain ASCII.
LETTERS = "a-z\xdf-\xf6\xf8-\xff\u0100-\u017f"
ODD = f"'[strvmld]|[^\\t-\\r -~{LETTERS}]"
# As ODD, of text that is not yet lower-cased; the capital i with a dot has no single lower-case letter.
ODD_RAW = f"'[strvmldSTRVMLD]|[^\\t-\\r -~\xc0-\xd6\xd8-\xde{LETTERS}]|\u0130"


class Model:
    """What a block has taught so far.  Guesses are ids; ``vocab`` itself stands for no guess.

    A guess and its confidence (0 to 3) are kept as one number, ``4 * guess + confidence``.  An id is coded as the guess
    of order 2 (kind 0), else as that of order 1 (kind 1), else by its frequency (kind 2).
    """

    def __init__(self, vocab: int) -> None:
        self.vocab = vocab
        self.count = np.ones(vocab, np.int64)
        self.after1 = np.full(vocab, 4 * vocab, np.int64)
        self.after2 = np.full(PAIRS, 4 * vocab, np.int64)
        # By kind, confidence of both guesses and whether they agree: how often ids were coded that way.
        self.seen = np.ones(96, np.int64)
        self.pending: list[np.ndarray] = []
        self.told: list[np.ndarray] = []
        self.refresh()

    def refresh(self) -> None:
        """Take the ids since the last refresh into the frequencies and weights."""
        if self.pending:
            self.count += COUNTED * np.bincount(np.concatenate(self.pending), minlength=self.vocab)
            self.seen += np.bincount(np.concatenate(self.told), minlength=96)
            self.pending.clear()
            self.told.clear()
            if self.count.sum() > HALVE_AT:
                self.count = (self.count + 1) // 2
        self.cum = np.zeros(self.vocab + 1, np.int64)
        np.cumsum(self.count, out=self.cum[1:])
        self.total = total = int(self.cum[-1])
        self.guide: np.ndarray | None = None
        state = np.arange(32)
        right2, right1, wrong = self.seen.reshape(3, 32)
        self.extra2, extra1 = (
            np.where(used, np.clip(right * total // wrong, 1, MOST * total), 0)
            for right, used in ((right2, state // 4 % 4 > 0), (right1, (state % 4 > 0) & (state < 16))))
        self.extra = self.extra2 + extra1
        self.starts = np.concatenate([np.zeros(32, np.int64), self.extra2, self.extra])
        self.sizes = np.concatenate([self.extra2, extra1, np.zeros(32, np.int64)])
        self.sums = (self.extra + total).astype(np.uint64)

    def look(self, last: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Guesses for the next id of each lane; the sum of the mixed frequencies."""
        self.last, self.pair = last, (last * 40503 + before * 30011 + (before >> 5)) & (PAIRS - 1)
        self.v1, self.v2 = self.after1.take(last), self.after2.take(self.pair)
        self.g1, self.g2 = self.v1 >> 2, self.v2 >> 2
        self.sure1, self.sure2 = (self.v1 & 3).astype(np.int8), (self.v2 & 3).astype(np.int8)
        self.state = (self.sure2 << 2) + self.sure1 + ((self.g1 == self.g2).view(np.int8) << 4)
        return self.sums.take(self.state)

    def span(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where ids lie on the line of mixed frequencies: the guesses first, then all ids in their order."""
        self.miss1, self.miss2 = (x != self.g1).view(np.int8), (x != self.g2).view(np.int8)
        way = self.state + ((self.miss2 + (self.miss1 & self.miss2)) << 5)
        self.told.append(way)
        by_count = self.miss1 & self.miss2
        start = self.starts.take(way) + by_count * self.cum.take(x)
        size = self.sizes.take(way) + by_count * self.count.take(x)
        return start.view(np.uint64), size.view(np.uint64)

    def _by_count(self, place: np.ndarray) -> np.ndarray:
        """The last ids whose cumulated frequencies are not above the places; a guide by leading bits comes near them."""
        if self.guide is None:
            self.shift = max(0, self.total.bit_length() - GUIDE_BITS)
            begins = (self.cum[:-1] + ((1 << self.shift) - 1)) >> self.shift
            self.guide = np.cumsum(np.bincount(begins, minlength=(self.total >> self.shift) + 1)) - 1
        x = self.guide.take(place >> self.shift)
        for _ in range(2):
            x += self.cum.take(x + 1) <= place
        far = np.flatnonzero(self.cum.take(x + 1) <= place)
        if len(far):
            x[far] = np.searchsorted(self.cum, place[far], side="right") - 1
        return x

    def find(self, at: np.ndarray) -> np.ndarray:
        """The ids that lie at places on that line."""
        extra = self.extra.take(self.state)
        x = np.where(at < self.extra2.take(self.state), self.g2, self.g1)
        rest = np.flatnonzero(at >= extra)
        x[rest] = self._by_count(at[rest] - extra[rest])
        return x

    def learn(self, x: np.ndarray) -> None:
        new = (x << 2) + 1
        # A right guess gains confidence, a wrong one loses it, and is replaced when it has little.
        for table, at, v, sure, miss in ((self.after1, self.last, self.v1, self.sure1, self.miss1),
                                         (self.after2, self.pair, self.v2, self.sure2, self.miss2)):
            case = sure + (miss << 2)
            table[at] = np.where(REPLACED.take(case), new, v + CHANGE.take(case))
        self.pending.append(x)


def _settle(low: np.ndarray, wide: np.ndarray) -> Iterator[np.ndarray]:
    """Lanes whose leading word is settled, until none is; the caller moves the word, then both numbers are shifted."""
    lanes: np.ndarray | None = None
    while True:
        a, b = (low, wide) if lanes is None else (low.take(lanes), wide.take(lanes))
        settled = (a ^ (a + b)) < TOP
        narrow = b < BOTTOM
        if narrow.any():
            narrow &= ~settled
            b = np.where(narrow, BOTTOM - (a & (BOTTOM - np.uint64(1))), b)
            wide[slice(None) if lanes is None else lanes] = b
            settled |= narrow
        at = np.flatnonzero(settled)
        if not len(at):
            return
        lanes = at if lanes is None else lanes.take(at)
        yield lanes
        low[lanes] = a.take(at) << WORD
        wide[lanes] = b.take(at) << WORD


def _layout(n: int, lanes: int) -> tuple[int, int, int]:
    """Steps, full lanes, and ids of the last lane if it is shorter."""
    steps = -(-n // lanes)
    return steps, n // steps, n % steps


def _due(step: int) -> bool:
    """Whether the model is refreshed before a step: often at first, then every 16 steps."""
    return step % 16 == 0 if step > 16 else step & (step - 1) == 0


def _as_read(lanes: int, whose: list[np.ndarray], words: list[np.ndarray]) -> np.ndarray:
    """Words in the order in which the decoder takes them.

    It begins with four words of each lane, so whenever a lane gives a word, it takes the fourth one after that.
    """
    order = np.argsort(np.concatenate(whose), kind="stable")
    by_lane, place = np.concatenate(words)[order], np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    first = np.searchsorted(np.concatenate(whose)[order], np.arange(lanes))
    return np.concatenate([by_lane[first + i] for i in range(4)] + [by_lane[place[:-4 * lanes] + 4]])


def pack(ids: np.ndarray, vocab: int) -> tuple[int, bytes]:
    """Lanes, and their words, of the coded ids."""
    n = len(ids)
    if not n:
        return 0, b""
    lanes = max(1, min(LANES, n // MIN_STEPS))
    steps, full, rest = _layout(n, lanes)
    lanes = full + (rest > 0)
    grid = np.zeros((lanes, steps), np.int64)
    grid.reshape(-1)[:n] = ids
    grid = np.ascontiguousarray(grid.T)
    model = Model(vocab)
    low, wide = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    whose: list[np.ndarray] = []
    words: list[np.ndarray] = []
    last = before = np.zeros(lanes, np.int64)
    for step in range(steps):
        if _due(step):
            model.refresh()
        m = lanes if step < rest or not rest else full
        x = grid[step, :m]
        unit = wide[:m] // model.look(last[:m], before[:m])
        start, size = model.span(x)
        low[:m] += unit * start
        np.multiply(unit, size, out=wide[:m])
        for go in _settle(low[:m], wide[:m]):
            whose.append(go.astype(np.uint16))
            words.append((low.take(go) >> LAST).astype("<u2"))
        model.learn(x)
        last, before = x, last
    for shift in (48, 32, 16, 0):
        whose.append(np.arange(lanes, dtype=np.uint16))
        words.append(((low >> np.uint64(shift)) & np.uint64(0xFFFF)).astype("<u2"))
    return lanes, _as_read(lanes, whose, words).tobytes()


def unpack(n: int, lanes: int, data: bytes, vocab: int) -> np.ndarray:
    """The ids of ``pack``."""
    if not n:
        return np.zeros(0, np.int64)
    steps, full, rest = _layout(n, lanes)
    if full + (rest > 0) != lanes:
        raise ValueError("lanes and ids do not fit")
    words = np.frombuffer(data, "<u2").astype(np.uint64)
    model = Model(vocab)
    low, wide = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    code = np.zeros(lanes, np.uint64)
    for i in range(4):
        code = (code << WORD) | words[i * lanes:(i + 1) * lanes]
    taken = 4 * lanes
    grid = np.zeros((steps, lanes), np.int64)
    last = before = np.zeros(lanes, np.int64)
    for step in range(steps):
        if _due(step):
            model.refresh()
        m = lanes if step < rest or not rest else full
        whole = model.look(last[:m], before[:m])
        unit = wide[:m] // whole
        at = np.minimum((code[:m] - low[:m]) // unit, whole - np.uint64(1))
        x = grid[step, :m]
        x[:] = model.find(at.view(np.int64))
        start, size = model.span(x)
        low[:m] += unit * start
        np.multiply(unit, size, out=wide[:m])
        for go in _settle(low[:m], wide[:m]):
            code[go] = (code.take(go) << WORD) | words[taken:taken + len(go)]
            taken += len(go)
        model.learn(x)
        last, before = x, last
    return np.ascontiguousarray(grid.T).reshape(-1)[:n]


def block_bytes(keys: list[int | None], counts: list[int], ids: np.ndarray, vocab: int) -> bytes:
    lanes, payload = pack(ids, vocab)
    directory = zlib.compress(
        np.array([k is not None for k in keys], "u1").tobytes()
        + np.array([k or 0 for k in keys], "<i8").tobytes() + np.array(counts, "<u4").tobytes(), 1)
    body = directory + payload
    return HEAD.pack(MAGIC, vocab, len(keys), len(ids), lanes, len(directory),
                     zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(body)) + body


def read_block(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Keys, ids per document, and all ids of a block; ValueError if a checksum fails."""
    magic, vocab, n_docs, n, lanes, size, of_ids, of_body = HEAD.unpack_from(data)
    body = data[HEAD.size:]
    if magic != MAGIC or zlib.crc32(body) != of_body:
        raise ValueError("not a block, or damaged")
    directory = zlib.decompress(body[:size])
    known = np.frombuffer(directory, "u1", n_docs)
    keys = np.frombuffer(directory, "<i8", n_docs, n_docs)
    counts = np.frombuffer(directory, "<u4", n_docs, 9 * n_docs).astype(np.int64)
    ids = unpack(n, lanes, body[size:], vocab)
    if zlib.crc32(ids.astype("<u4").tobytes()) != of_ids:
        raise ValueError("ids and checksum differ")
    return [int(k) if there else None for k, there in zip(keys, known)], counts, ids


def _runs(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen runs of ``ids`` one after the other, and where each begins, with the end of the last."""
    lengths = lengths.take(which)
    ends = np.zeros(len(which) + 1, np.int64)
    np.cumsum(lengths, out=ends[1:])
    place = np.repeat(starts.take(which) - ends[:-1], lengths)
    place += np.arange(len(place))
    return ids.take(place), ends


class Encoder:
    """The tokenizers library behind a memory of words.

    This vocabulary is split at white space and between letters and other characters, and every word's tokens end
    with one that ends a word.  So a text of common letters is cut into words and other stretches, which are
    remembered; new words go to the library in one text, where the tokens that end a word tell them apart again.
    Texts with anything else are cut at blanks alone.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        # The same model for words that need no more than it: cut at blanks, nothing else is done to them.
        self.model = Tokenizer(self.library.model)
        self.model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        names = self.library.get_vocab(with_added_tokens=True)
        self.vocab = max(names.values()) + 1
        self.ends = np.zeros(self.vocab, bool)
        self.ends[[i for t, i in names.items() if t.endswith("</w>")]] = True
        specials = [t.content.lower() for t in self.library.get_added_tokens_decoder().values()]
        self.odd = re.compile("|".join([ODD, *map(re.escape, specials)]))
        # The same for Arrow, before letters are lower-cased.
        either = ["".join(f"[{c}{c.upper()}]" if "a" <= c <= "z" else re.escape(c) for c in t) for t in specials]
        self.odd_raw = "|".join([ODD_RAW, *either])
        self.cut = re.compile(rf"[{LETTERS}]+|[^\s{LETTERS}]+")
        self.common = re.compile(rf"[{LETTERS}]+")
        self.as_letters = {byte: letter for letter, byte in byte_letters().items()}
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def forget(self) -> None:
        """Give back the older half of what was remembered, at the end of a task; the worker may serve other operators."""
        self.older = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _common(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words of common letters, which the library's model takes as the letters that stand for their bytes."""
        made = {}
        for at in range(0, len(words), WORDS_AT_ONCE):
            some = words[at:at + WORDS_AT_ONCE]
            letters = [w if w.isascii() else w.encode().decode("latin-1").translate(self.as_letters) for w in some]
            ids = np.array(self.model.encode_batch_fast([" ".join(letters)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(some):
                data, begin = ids.tobytes(), 0
                for word, end in zip(some, (4 * cuts).tolist()):
                    made[word] = data[begin:end]
                    begin = end
            else:
                split = self.library.model.tokenize
                made |= {w: array("I", [t.id for t in split(m)]).tobytes() for w, m in zip(some, letters)}
        return made

    def _new(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of pieces that are not at hand."""
        common, rest = [], []
        for p in pieces:
            (common if p.islower() and self.common.fullmatch(p) else rest).append(p)
        made = self._common(common)
        words = [p for p in rest if p.isalpha()]
        others = [p for p in rest if not p.isalpha()]
        if others:
            made |= dict(zip(others, self._library(others)))
        if words:
            ids = np.array(self.library.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(words):
                data, at = ids.tobytes(), 0
                for word, end in zip(words, (4 * cuts).tolist()):
                    made[word] = data[at:end]
                    at = end
            else:
                made |= dict(zip(words, self._library(words)))
        return made

    def _parts(self, text: str) -> list[str]:
        low = text.lower()
        if self.odd.search(low):
            return text.replace("\n", " ").split(" ")
        return self.cut.findall(low)

    def _of_words(self, words: list[str]) -> list[bytes]:
        """Ids of different words, remembered or new."""
        own = [self.known.get(w) or self.older.get(w) for w in words]
        made = self._new([w for w, ids in zip(words, own) if ids is None and w])
        if len(self.known) + len(made) > REMEMBERED:
            self.older, self.known = self.known, {"": b""}
        self.known.update((w, ids) for w, ids in made.items() if len(w) <= 64)
        return [made.get(w, b"") if ids is None else ids for w, ids in zip(words, own)]

    def encode_column(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text of a column; a null has none.

        Texts are cut at ASCII white space, which no token spans.  What lies between is told apart once for the whole
        column and cut into words and other stretches there, as a text is by ``_parts``; these are told apart once more,
        and the new ones go to the library together.
        """
        cut = pc.ascii_split_whitespace(texts.fill_null(""))
        coded = cut.flatten().dictionary_encode()
        pieces = coded.dictionary
        spaced = pc.replace_substring_regex(pc.utf8_lower(pieces), f"([{LETTERS}]+)", r" \1 ")
        parts = pc.ascii_split_whitespace(pc.if_else(pc.match_substring_regex(pieces, self.odd_raw), pieces, spaced))
        words = parts.flatten().dictionary_encode()
        own = self._of_words(words.dictionary.to_pylist())
        lengths = np.fromiter(map(len, own), np.int64, len(own)) >> 2
        which = words.indices.to_numpy()
        ids, ends = _runs(np.frombuffer(b"".join(own), "<u4"), np.cumsum(lengths) - lengths, lengths, which)
        at = parts.offsets.to_numpy().astype(np.int64)
        begins = ends[at - at[0]]
        starts, lengths = begins[:-1], np.diff(begins)
        codes, at = coded.indices.to_numpy(), cut.offsets.to_numpy().astype(np.int64)
        at = at - at[0]
        for begin in range(0, len(texts), TEXTS_AT_ONCE):
            some = at[begin:begin + TEXTS_AT_ONCE + 1]
            run, ends = _runs(ids, starts, lengths, codes[some[0]:some[-1]])
            data, cuts = run.tobytes(), (4 * ends[some - some[0]]).tolist()
            for one, other in zip(cuts, cuts[1:]):
                yield data[one:other]

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian u32."""
        if not text:
            return b""
        parts = self._parts(text)
        found = list(map(self.known.get, parts))
        if None in found:
            fresh = {p for p, ids in zip(parts, found) if ids is None}
            made = {p: ids for p in fresh if (ids := self.older.get(p)) is not None}
            made |= self._new([p for p in fresh if p not in made])
            if len(self.known) >= REMEMBERED:
                self.older, self.known = self.known, {"": b""}
            self.known.update((p, ids) for p, ids in made.items() if len(p) <= 64)
            found = [made[p] if ids is None else ids for p, ids in zip(parts, found)]
        return b"".join(found)


_encoders: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """The encoder of a file, made once in each worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def write_blocks(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", path: str | None = None,
                 end_id: int = 2, block_tokens: int = BLOCK_TOKENS) -> None:
    """Encode ``docs``, append ``end_id`` to each document, and write blocks in ascending key order to ``folder``."""
    path = path or tokenizer_file("word_bpe_49k.json")

    def step(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        encoder, end = encoder_of(path), np.array([end_id], "<u4").tobytes()
        vocab = max(encoder.vocab, end_id + 1)
        part = TaskContext.get().partitionId()
        seq = first = held = 0
        keys: list[int | None] = []
        counts: list[int] = []
        pieces: list[bytes] = []

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(pieces), "<u4").astype(np.int64)
            return batch([[part], [seq], [first], [len(keys)], [held], [block_bytes(keys, counts, ids, vocab)]], schema)

        for b in batches:
            for k, ids in zip(b.column(0).to_pylist(), encoder.encode_column(b.column(1))):
                piece = ids + end
                keys.append(k)
                counts.append(len(piece) // 4)
                pieces.append(piece)
                held += counts[-1]
                if held >= block_tokens:
                    yield flush()
                    seq, first, held, keys, counts, pieces = seq + 1, first + held, 0, [], [], []
        if keys:
            yield flush()
        encoder.forget()

    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    order = [F.col("key"), F.xxhash64("text")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    arrow_pass(placed, step, BLOCK_SCHEMA).write.option("compression", "none").parquet(folder)


def _offsets(blocks: DataFrame) -> DataFrame:
    """First id of each part.  One row per part, so the driver may add them up."""
    sizes = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    rows, at = [], 0
    for r in sizes:
        rows.append((r["part"], at))
        at += r["n"]
    return small_table(blocks.sparkSession, rows, "part int, part_start bigint")


def read_blocks(spark: SparkSession, folder: str, digest: bool = False) -> DataFrame:
    """Rows of a folder: ``key, start, n_tokens`` and ``token_ids``, or ``ids_crc32`` instead if only a digest is asked for."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(folder)

    def step(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part_start, first, data in zip(*(b.column(i).to_pylist() for i in range(3))):
                keys, counts, ids = read_block(data)
                ends = np.cumsum(counts)
                runs = [ids[e - n:e] for e, n in zip(ends, counts)]
                what = [zlib.crc32(r.astype("<u4").tobytes()) for r in runs] if digest else [r.astype(np.int32) for r in runs]
                yield batch([keys, part_start + first + ends - counts, counts, what], schema)

    last = "ids_crc32 bigint" if digest else "token_ids array<int>"
    placed = blocks.join(_offsets(blocks), "part").select("part_start", "first", "block")
    return arrow_pass(placed, step, f"key bigint, start bigint, n_tokens bigint, {last}")
