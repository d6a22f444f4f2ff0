"""Language identification by rank-order profiles.

A profile lists n-grams of one to three characters by falling frequency.  A document's own list is compared with
that of each language: every n-gram adds the distance between its two places, or the largest distance if the
language's list lacks it.  The language with the smallest sum wins; equal sums go to the lesser name.

N-grams are taken over the whole text, lower-cased, with every run of other characters than letters read as one
blank.  Profiles are learned from a bounded sample of the labelled rows of each language (``TRAIN_ROWS``, chosen by a hash
of key and text; all rows when there are fewer); its size is a parameter and the counting is a grouped sum.

A null text, or one without a letter, is ``und`` with score 0; so is every text when nothing could be learned.
Null languages are not learned.  Documents are judged one by one, so repeated rows get equal answers and an empty
table gives an empty result.  Other columns are kept; those named like the outputs are replaced.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from shelflight.llm.common import arrow_pass, batch

UNKNOWN = "und"
#: Rows that the profile of a language is learned from, and the lengths of the lists.
TRAIN_ROWS, LANGUAGE_LIST, DOCUMENT_LIST = 20_000, 1200, 600
#: Codes that wait to be counted, and counts of a language that a task sends on.
HELD_CODES, MOST_SUMS = 1 << 18, 1 << 20

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters."""
    if not _letters:
        _letters.append(np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)]))
    return _letters[0]


def grams(text: str | None) -> np.ndarray:
    """Codes of the n-grams of a text, 21 bits a character; empty without letters."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    keep = letters()[codes]
    if not keep.any():
        return np.zeros(0, np.int64)
    codes = np.where(keep, codes, 32)
    codes = np.concatenate(([32], codes[(codes != 32) | np.concatenate(([False], codes[:-1] != 32))], [32]))
    if codes[-2] == 32:
        codes = codes[:-1]
    pairs = codes[:-1] << 21 | codes[1:]
    return np.concatenate((codes[codes != 32], pairs, pairs[:-1] << 21 | codes[2:]))


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and how often each occurs."""
    codes = np.sort(codes)
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return codes[first], np.diff(np.append(first, len(codes)))


class Sums:
    """How often each code occurs; what comes in is folded by megabytes, so a large batch is never held as codes."""

    def __init__(self) -> None:
        self.codes, self.often = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.held: list[np.ndarray] = []
        self.n = 0

    def add(self, codes: np.ndarray) -> None:
        self.held.append(codes)
        self.n += len(codes)
        if self.n >= HELD_CODES:
            self.fold()

    def fold(self) -> None:
        if not self.n:
            return
        codes, often = counted(np.concatenate(self.held))
        both, place = np.unique(np.concatenate((self.codes, codes)), return_inverse=True)
        sums = np.zeros(len(both), np.int64)
        np.add.at(sums, place, np.concatenate((self.often, often)))
        self.codes, self.often, self.held, self.n = both, sums, [], 0


@dataclass(frozen=True)
class Profiles:
    """The languages in order, all their n-grams in order, and each n-gram's place in each list."""

    languages: tuple[str, ...]
    codes: np.ndarray
    places: np.ndarray

    def judge(self, text: str | None) -> tuple[str, float]:
        """Language and score: how far the sum of distances lies below the largest possible one."""
        codes = grams(text)
        if not len(codes) or not self.languages:
            return UNKNOWN, 0.0
        codes, often = counted(codes)
        top = np.argsort(-often, kind="stable")[:DOCUMENT_LIST]
        codes = codes[top]
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        places = np.where((self.codes[at] == codes)[:, None], self.places[at], LANGUAGE_LIST)
        apart = np.abs(places - np.arange(len(codes))[:, None])
        apart = np.where(places == LANGUAGE_LIST, LANGUAGE_LIST, apart).sum(axis=0)
        best = int(np.argmin(apart))
        return self.languages[best], 1.0 - float(apart[best]) / (LANGUAGE_LIST * len(codes))


def learn(docs: DataFrame, may_learn: Column | None = None, key: str = "doc_id", text: str = "text",
          lang: str = "lang", train_rows: int = TRAIN_ROWS) -> Profiles:
    """Profiles of the languages of ``docs``, from rows where ``may_learn`` holds, about ``train_rows`` of each language."""
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    if may_learn is not None:
        labelled = labelled.where(may_learn)
    large = labelled.groupBy(lang).count().where(F.col("count") > train_rows).collect()  # a row per language, as in the profiles
    if large:
        share = F.pmod(F.xxhash64(F.col(key), F.col(text), F.lit("language")), F.lit(1 << 32))
        below = F.create_map(*[F.lit(x) for r in large for x in (r[lang], int((1 << 32) * train_rows / r["count"]))])
        labelled = labelled.where(share < F.coalesce(F.try_element_at(below, F.col(lang)), F.lit(1 << 32)))

    def step(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        sums: dict[str, Sums] = {}
        for b in batches:
            for name, t in zip(b.column(0).to_pylist(), b.column(1)):
                own = sums.setdefault(name, Sums())
                own.add(grams(t.as_py()))
                if len(own.codes) > MOST_SUMS:
                    yield batch([[name] * len(own.codes), own.codes, own.often], schema)
                    del sums[name]
        for name, own in sums.items():
            own.fold()
            yield batch([[name] * len(own.codes), own.codes, own.often], schema)

    sums = (arrow_pass(labelled.select(F.col(lang).cast("string"), text), step, "lang string, gram bigint, n bigint")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    lists = sums.withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < LANGUAGE_LIST)
    rows = lists.select("lang", "gram", "place").collect()  # one list of bounded length per language
    languages = sorted({r["lang"] for r in rows})
    codes = np.array(sorted({r["gram"] for r in rows}), np.int64)
    places = np.full((len(codes), len(languages)), LANGUAGE_LIST)
    column = {name: i for i, name in enumerate(languages)}
    for r in rows:
        places[np.searchsorted(codes, r["gram"]), column[r["lang"]]] = r["place"]
    return Profiles(tuple(languages), codes, places)


def identify(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    kept = docs.drop("lang_pred", "score")
    at = kept.columns.index(text)
    fields = [*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]

    def step(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for b in batches:
            judged = [profiles.judge(t.as_py()) for t in b.column(at)]
            yield batch([*b.columns, [x for x, _ in judged], [x for _, x in judged]], schema)

    return arrow_pass(kept, step, T.StructType(fields))


def held_out(key: Column) -> Column:
    """Whether a row is kept from learning."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
