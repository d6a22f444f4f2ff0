"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

A window is ``WINDOW`` consecutive words of a benchmark item, or a whole shorter item.  A document holds a window
if it has the same words in a row.  A window is seen as a set of shingles of ``SHINGLE`` words (fewer for shorter
windows) at known offsets; holding it means holding all of them, so its necessary prefix is one shingle, and the
rarest in the documents is taken.

One pass over the documents keeps, of each row, the places whose shingle may occur in the benchmark: a bit map of
``FILTER`` bits, of one size whatever the benchmark, tells most others away.  From these places come the shingles'
frequencies, hence every window's prefix; places and prefixes are joined by the shingles' 64-bit hashes, windows that
would begin before or end after the document are dropped (position and length bound), and the words of the row, which
are stored beside its places, are compared.  What the bit map lets through in error meets no prefix.

Null texts have no word.  Null items and items without words give no window.  Items with one ``item_id`` count once;
null item ids count as the text ``null``.  Documents are judged row by row, whatever their key: repeated rows stay
and get equal results; an empty benchmark contaminates nothing, an empty table gives an empty result.  Columns of
the input are kept, those named like the outputs replaced.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelflight.llm.common import stored

WINDOW, SHINGLE = 13, 4
#: Bits of the map of known shingles, a power of two: half a megabyte in the plan.
FILTER = 1 << 22
#: A document is contaminated if hit words times this reach its words.
PART = 20
#: Fixed value: everything between words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Places of a hash in the map of known shingles.
BITS = ("{h} & {mask}L", "shiftrightunsigned({h}, 32) & {mask}L")
OUTPUTS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def words(text: Column) -> Column:
    """The words of a text, with A-Z lower-cased; none for null."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), BETWEEN), "")


def _hash(of: str, at: str, length: int) -> str:
    return "xxhash64(" + ", ".join(f"get({of}, {at} + {i})" for i in range(length)) + ")"


def windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW,
            shingle: int = SHINGLE) -> DataFrame:
    """Distinct windows: ``window`` (words), ``items``, and ``shingles`` as structs of q, h and shift."""
    listed = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("item"), words(F.col(text)).alias("w"))
    cut = (listed.where(F.size("w") > 0)
           .withColumn("starts", F.expr(f"sequence(0, greatest(size(w) - {window}, 0))"))
           .select("item", "w", F.explode("starts").alias("s"))
           .select("item", F.expr(f"slice(w, s + 1, {window})").alias("window")))
    folded = cut.groupBy("window").agg(F.collect_set("item").alias("items"))
    by_size = "CASE " + " ".join(
        f"WHEN size(window) = {q} THEN array(struct({q} AS q, {_hash('window', '0', q)} AS h, 0 AS shift))" for q in range(1, shingle)) + (
        f" ELSE transform(sequence(0, size(window) - {shingle}), o -> struct({shingle} AS q, {_hash('window', 'o', shingle)} AS h, o AS shift)) END")
    return folded.withColumn("shingles", F.expr(by_size))


def bit_map(known: DataFrame, bits: int = FILTER) -> Column:
    """A map of ``bits`` bits with two of them set for every hash ``h``, as an array of numbers."""
    at = F.explode(F.array(*(F.expr(e.format(h="h", mask=bits - 1)) for e in BITS)))
    rows = (known.select(at.alias("at"))
            .select(F.expr("CAST(at DIV 64 AS INT)").alias("slot"), F.expr("shiftleft(1L, CAST(at % 64 AS INT))").alias("bit"))
            .groupBy("slot").agg(F.bit_or("bit").alias("value")).collect())  # at most bits / 64 rows
    slots = [0] * (bits // 64)
    for r in rows:
        slots[r["slot"]] = r["value"]
    return F.split(F.lit(",".join(map(str, slots))), ",").cast("array<bigint>")


def _may_hold(slots: Column, h: Column, bits: int) -> Column:
    def bit(at: Column) -> Column:
        return F.getbit(F.get(slots, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1

    mask = F.lit(bits - 1).cast("bigint")
    return bit(h.bitwiseAND(mask)) & bit(F.shiftrightunsigned(h, 32).bitwiseAND(mask))


def _places_of(q: int, slots: Column, bits: int) -> Column:
    """Places of the words ``__w`` whose shingle of ``q`` words may be known."""
    def hashed(i: Column) -> Column:
        return F.xxhash64(*(F.get("__w", i + k) for k in range(q)))

    starts = F.expr(f"CASE WHEN size(__w) >= {q} THEN sequence(0, size(__w) - {q}) ELSE array() END")
    held = F.filter(starts, lambda i: _may_hold(slots, hashed(i), bits))
    return F.transform(held, lambda i: F.struct(i.cast("int").alias("pos"), F.lit(q).alias("q"), hashed(i).alias("h")))


def places(docs: DataFrame, keep: list[str], known: DataFrame, text: str = "text", shingle: int = SHINGLE,
           bits: int = FILTER) -> DataFrame:
    """One stored row per document: a number, the columns to keep, ``n_words``, its words, and ``found``: places that
    may have a known shingle."""
    rows = docs.select(*(F.col(f"`{c}`") for c in keep), words(F.col(text)).alias("__w"))
    slots = bit_map(known, bits)
    lengths = sorted(r["q"] for r in known.select("q").distinct().collect())  # at most SHINGLE values
    found = [_places_of(q, slots, bits) for q in lengths]
    all_found = (F.concat(*found) if found else F.array()).cast("array<struct<pos:int,q:int,h:bigint>>")
    return stored(rows.select(F.monotonically_increasing_id().alias("__row"), *(F.col(f"`{c}`") for c in keep),
                              F.size("__w").alias("n_words"), F.col("__w"), all_found.alias("found")), "places")


def occurrences(base: DataFrame, wins: DataFrame) -> DataFrame:
    """Verified places of windows: ``__row, start, length, items``."""
    seen = base.select("__row", "n_words", F.explode("found").alias("f")).select("__row", "n_words", "f.*")
    often = seen.groupBy("q", "h").agg(F.count(F.lit(1)).alias("n"))
    # A shingle that no document has rules its window out, so the inner join loses nothing.
    listed = wins.select("window", "items", F.size("shingles").alias("parts"), F.explode("shingles").alias("s")).select("window", "items", "parts", "s.*")
    counted = listed.join(often, ["q", "h"]).groupBy("window").agg(
        F.first("items").alias("items"), F.first("parts").alias("parts"), F.count(F.lit(1)).alias("present"),
        F.min(F.struct("n", "h", "shift", "q")).alias("prefix"))
    prefixes = (counted.where("present = parts")
                .select("window", "items", F.col("prefix.q").alias("q"), F.col("prefix.h").alias("h"), F.col("prefix.shift").alias("shift")))
    met = (seen.join(prefixes, ["q", "h"])
           .withColumn("start", F.col("pos") - F.col("shift"))
           .where((F.col("start") >= 0) & (F.col("start") + F.size("window") <= F.col("n_words"))))
    held = (met.select("__row", "start", "window", "items")
            .join(base.where(F.size("found") > 0).select("__row", "__w"), "__row")
            .where(F.expr("slice(__w, start + 1, size(window)) = window")))
    return held.select("__row", "start", F.size("window").alias("length"), "items")


def mark(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, text: str = "text", item: str = "item_id",
         item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE, bits: int = FILTER) -> DataFrame:
    """The kept columns of ``docs`` with ``n_words, n_hit, n_items, items_sha256, contaminated``."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in OUTPUTS]
    wins = stored(windows(benchmark, item, item_text, window, shingle), "windows")
    known = wins.select(F.explode("shingles").alias("s")).select("s.q", "s.h").distinct()
    base = places(docs, keep, known, text, shingle, bits)
    spans = occurrences(base, wins).groupBy("__row").agg(
        F.sort_array(F.collect_set(F.struct("start", "length"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("found_items"))
    covered = F.expr("""aggregate(spans, named_struct('n', 0, 'to', 0),
        (a, s) -> named_struct('n', a.n + greatest(s.start + s.length - greatest(s.start, a.to), 0),
                               'to', greatest(a.to, s.start + s.length)), a -> a.n)""")
    hits = spans.select("__row", covered.cast("bigint").alias("n_hit"), F.size("found_items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("found_items", ","), 256).alias("items_sha256"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return (base.drop("found", "__w").join(hits, "__row", "left")
            .select(*(F.col(f"`{c}`") for c in keep), F.col("n_words").cast("bigint").alias("n_words"), n_hit.alias("n_hit"),
                    F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
                    F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
                    ((n_hit > 0) & (PART * n_hit >= F.col("n_words"))).alias("contaminated")))
