"""BPE encoding by a deterministic automaton, and decoding by its arc labels.

The automaton reads tokens.  It starts as one state with a loop for every byte.  The merges are then
applied in order, each as a gadget: for the merge of ``u`` and ``v`` the state reached by ``u`` is
replaced by a copy without its ``v`` arc, and every state that had an arc ``u`` into a state with an
arc ``v`` gets an arc ``uv`` to where that path led.  All arcs with one label lead to one state, so a
state is known by its last token; it is stored as the gadgets that made it, not as 50,000 arcs, and an
arc of the table is filled in when it is first asked for.  The paths of the finished automaton are the
tokenizations that the merges produce, one for every byte string, and every prefix of a path is a path:
so one pass over a word, following the arcs that spell it, finds its only path.

Null text counts as empty and gives no tokens.  Words are read whole whatever their length.  Rows are
independent of each other: repeated rows give repeated results, an empty table an empty result, and
columns of the input other than the two that are read play no part.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from shelflight.llm.common import arrow_pass, batch, tokenizer_file

# White space and the word pattern of the byte-level vocabulary.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"

#: Words and table entries that one worker remembers, in two generations; older ones are worked out again.
REMEMBERED = 200_000
NEVER = 1 << 60


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Automaton:
    """The automaton of a merge list."""

    def __init__(self, labels: dict[int, bytes], merges: Iterable[tuple[bytes, bytes]]) -> None:
        self.labels = labels
        self.ids = {label: i for i, label in labels.items()}
        self.left: dict[int, int] = {}      # parts of a merged token
        self.right: dict[int, int] = {}
        self.made: dict[int, int] = {}      # gadget that made its arcs
        self.cut: dict[tuple[int, int], int] = {}  # gadget that cut the arc v after u
        self.usable: set[bytes] = {label for label in self.ids if len(label) == 1}
        self.arcs: dict[int, bool] = {}
        for time, (u, v) in enumerate(merges):
            self.gadget(time, u, v)
        self.reach: dict[bytes, int] = {}   # length of the longest label with these first two bytes
        for label in self.usable:
            self.reach[label[:2]] = max(len(label), self.reach.get(label[:2], 1))
        self.by_text = {label: self.ids[label] for label in self.usable}

    def gadget(self, time: int, u: bytes, v: bytes) -> None:
        a, b, made = self.ids[u], self.ids[v], self.ids[u + v]
        if made in self.made:
            raise ValueError(f"two merges make token {made}")
        open_path = u in self.usable and v in self.usable and self.follows(a, b, time)
        self.cut[a, b] = time
        self.left[made], self.right[made], self.made[made] = a, b, time
        if open_path:
            self.usable.add(u + v)

    def follows(self, a: int, b: int, time: int = NEVER) -> bool:
        """Whether the state after ``a`` has an arc ``b`` once the gadgets before ``time`` are applied.

        The state after ``a`` inherits the cuts that the state of its right part had when ``a`` was made,
        and so on inwards; ``b`` came to a state through the arc of its left part, if that was not cut by then.
        """
        until = time
        while True:
            label, still = b, NEVER
            while True:
                when = self.cut.get((a, label), NEVER)
                if when < until and when <= still:
                    return False
                if label not in self.left:
                    break
                still = self.made[label]
                label = self.left[label]
            if a not in self.right:
                return True
            until = min(until, self.made[a])
            a = self.right[a]

    def path(self, word: bytes) -> tuple[int, ...]:
        """The labels of the only path that spells ``word``: longest arcs first, back from positions without a way on."""
        by_text, arcs, reach, n = self.by_text, self.arcs, self.reach, len(word)
        whole = by_text.get(word)
        if whole is not None:
            return (whole,)
        out: list[int] = []
        ends = [0]
        dead: set[int] = set()
        i, j = 0, min(n, reach.get(word[:2], 1))
        while i < n:
            while j > i:
                label = by_text.get(word[i:j])
                if label is not None and j not in dead:
                    if not out:
                        break
                    key = out[-1] << 20 | label
                    arc = arcs.get(key)
                    if arc is None:
                        if len(arcs) >= REMEMBERED:
                            arcs.clear()
                        arc = arcs[key] = self.follows(out[-1], label)
                    if arc:
                        break
                j -= 1
            if j > i:
                out.append(label)
                ends.append(j)
                i, j = j, min(n, j + reach.get(word[j:j + 2], 1))
            else:
                dead.add(i)
                ends.pop()
                out.pop()
                i, j = ends[-1], i - 1
        return tuple(out)


class Codec:
    """Encoder and decoder for the vocabulary file of a byte-level BPE."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, model = byte_letters(), spec["model"]
        spell = {t: bytes(letters[c] for c in t) for t in model["vocab"]}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.automaton = Automaton({i: spell[t] for t, i in model["vocab"].items()},
                                   [(spell[u], spell[v]) for u, v in merges])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = self.automaton.labels | {i: t.encode() for t, i in self.special.items()}
        self.numbers = {i: str(i) for i in self.labels}
        self.words = regex.compile(WORD)
        # A single space between visible characters always begins a word, so text may be cut there.
        self.uneven = re.compile(r" \s|\s |\A\s|\s\Z")
        self.safe = re.compile(r"(?<=\S)(?= \S)")
        self.later: dict[str, tuple[int, ...]] = {}   # pieces after a space, kept without it
        self.before: dict[str, tuple[int, ...]] = {}  # those of the generation before
        self.marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def _words(self, piece: str) -> tuple[int, ...]:
        path = self.automaton.path
        words = self.words.findall(piece)
        if len(words) == 1:
            return path(words[0].encode())
        return tuple(chain.from_iterable([path(w.encode()) for w in words]))

    def _later(self, part: str) -> tuple[int, ...]:
        ids = self.later.get(part)
        if ids is not None:
            return ids
        ids = self.before.get(part)
        if ids is None:
            piece = " " + part
            ids = self.automaton.path(piece.encode()) if part.isalpha() else self._words(piece)
        if len(part) <= 64:
            if len(self.later) >= REMEMBERED:
                self.before, self.later = self.later, {}
            self.later[part] = ids
        return ids

    def _plain(self, text: str) -> list[int]:
        if self.uneven.search(text):
            head, *parts = self.safe.split(text)
            parts = [p[1:] for p in parts]
        else:
            head, *parts = text.split(" ")
        found = list(map(self.later.get, parts))
        if None in found:
            found = [self._later(p) if ids is None else ids for p, ids in zip(parts, found)]
        out = list(self._words(head))
        out.extend(chain.from_iterable(found))
        return out

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if not self.special or "<" not in text or not self.marks.search(text):
            return self._plain(text)
        out: list[int] = []
        for part in self.marks.split(text):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out.extend(self._plain(part))
        return out

    def forget(self) -> None:
        """Give back what was remembered of words, at the end of a task; the worker may serve other operators."""
        self.later, self.before = {}, {}
        self.automaton.arcs.clear()

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a file, made once in each worker."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """One row per row of ``docs``: the key and ``token_ids``."""
    path = path or tokenizer_file("byte_bpe_50k.json")

    def step(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for b in batches:
            yield batch([b.column(0), [own.encode(t.as_py()) for t in b.column(1)]], schema)
        own.forget()

    kind = docs.schema[key].dataType.simpleString()
    return arrow_pass(docs.select(key, text), step, f"{key} {kind}, token_ids array<int>")


def decode(encoded: DataFrame, key: str = "doc_id", ids: str = "token_ids", path: str | None = None) -> DataFrame:
    """One row per row of ``encoded``: the key and ``text``; a null list gives empty text."""
    path = path or tokenizer_file("byte_bpe_50k.json")

    def step(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for b in batches:
            yield batch([b.column(0), [own.decode(x.as_py() or ()) for x in b.column(1)]], schema)

    kind = encoded.schema[key].dataType.simpleString()
    return arrow_pass(encoded.select(key, ids), step, f"{key} {kind}, text string")


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Per row: number of tokens, and SHA-256 of the ids (decimal, joined by commas) and of the text decoded from them.

    Ids stay in the worker that made them; only the digests leave it.
    """
    path = path or tokenizer_file("byte_bpe_50k.json")

    def step(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for b in batches:
            counts, of_ids, of_text = [], [], []
            for t in b.column(1):
                ids = own.encode(t.as_py())
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(",".join(map(own.numbers.__getitem__, ids)).encode()).hexdigest())
                of_text.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
            yield batch([b.column(0), counts, of_ids, of_text], schema)
        own.forget()

    kind = docs.schema[key].dataType.simpleString()
    return arrow_pass(docs.select(key, text), step,
                      f"{key} {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
