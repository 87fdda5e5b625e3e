"""One-permutation MinHash fingerprints (operator 3), with DataFrame functions only.

Every word shingle is hashed once. The first 8 bits of a hash are its bin; a bin
keeps its smallest hash. An empty bin takes the hash of another one, found by
optimal densification: each bin has its own sequence of bins to try, the same
for all documents, and takes the first that is not empty. The low 4 bits of
each bin are packed, 16 bins to a long, and written as 256 hex digits.

Two fingerprints' share of equal digits is corrected for equality by chance
(1/16). Texts of fewer than five words are one shingle. Null is empty; an empty
text's fingerprint is "", which is like another "" (1.0) and like nothing else
(0.0). Equal texts have equal fingerprints. Repeated rows, and rows that share a
doc_id or have none, are documents of their own; an empty table gives an empty
table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageloom.llm.common import SPACE_RUN, SPACES, pick, shuffle_partitions, text_key

BINS = 256
BITS = 4
#: A hash that stands for an empty bin: the largest of the bin.
EMPTY = (1 << 56) - 1
#: Bins that an empty bin tries, one after the other, before it compares all.
TRIES = 12


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once for a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shingle_hashes(text: Column, words: int = 5) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    split = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))
    hashed = F.transform(split, lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        many = F.transform(F.sequence(F.lit(0), F.size(h) - words), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(words)]))
        few = F.when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(h) >= words, many).otherwise(few)

    return let(hashed, shingles)


def filled(h: Column) -> Column:
    return F.when(h.bitwiseAND(F.lit(EMPTY)) != EMPTY, h)


def probes() -> Column:
    """The bins that each bin tries, from a rule."""
    numbers = F.sequence(F.lit(0), F.lit(BINS * TRIES - 1))
    return F.transform(numbers, lambda i: F.pmod(F.xxhash64(i, F.lit(7)), F.lit(BINS)).cast("int"))


def densified(bins: Column, tries: Column) -> Column:
    """Low bits of each bin, empty ones filled from others; at least one is not empty."""

    def borrowed(b: Column) -> Column:
        tried = [filled(F.get(bins, F.get(tries, b * TRIES + t))) for t in range(TRIES)]
        ranked = F.transform(bins, lambda h, j: F.when(filled(h).isNotNull(), F.struct(F.xxhash64(b, j).alias("rank"), h.alias("hash"))))
        # hashed again, or the few shingles of a short text would share their low bits with others' by chance in many bins at once
        return F.xxhash64(F.coalesce(*tried, F.array_min(ranked)["hash"]), b)

    return F.transform(bins, lambda h, b: F.coalesce(filled(h), borrowed(b)).bitwiseAND(F.lit((1 << BITS) - 1)))


def packed(low: Column) -> Column:
    per = 64 // BITS
    joined = lambda w: F.aggregate(F.slice(low, w * per + 1, per), F.lit(0).cast("bigint"), lambda a, x: F.shiftleft(a, BITS).bitwiseOR(x))
    return F.transform(F.sequence(F.lit(0), F.lit(BINS // per - 1)), joined)


def fingerprint(text: Column) -> Column:
    """16 longs, or null for a text without words."""
    empty = F.transform(F.sequence(F.lit(-128), F.lit(127)), lambda b: F.shiftleft(b.cast("bigint"), 56).bitwiseOR(F.lit(EMPTY)))

    def of_hashes(hashes: Column) -> Column:
        # an empty bin's mark comes after the hashes of its bin, so the first of each bin stands in its place
        ordered = F.sort_array(F.concat(hashes, empty))
        first = lambda s: F.filter(s, lambda x, i: (i == 0) | (F.shiftright(x, 56) != F.shiftright(F.get(s, i - 1), 56)))
        bins = let(ordered, first)
        return F.when(F.size(hashes) > 0, let(probes(), lambda tries: let(bins, lambda b: let(densified(b, tries), packed))))

    return let(shingle_hashes(text), of_hashes)


def as_text(longs: Column) -> Column:
    digits = F.transform(longs, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0"))
    return F.coalesce(F.array_join(digits, ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles, from 0 to 1."""

    def unlike(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        return F.bit_count(d.bitwiseAND(F.lit(0x1111111111111111)))

    differing = F.aggregate(F.zip_with(a, b, unlike), F.lit(0), lambda s, x: s + x)
    chance = 1 / (1 << BITS)
    same = ((1 - differing / BINS) - chance) / (1 - chance)
    return (
        F.when(a.isNull() & b.isNull(), 1.0)
        .when(a.isNull() | b.isNull(), 0.0)
        .otherwise(F.greatest(same, F.lit(0.0)))
    )


def by_size(bounds: list[int], low: int = 0) -> Column:
    """How many of the bounds, in order, are at most doc_id: a tree of comparisons."""
    if not bounds:
        return F.lit(low)
    mid = len(bounds) // 2
    return F.when(F.col("doc_id") < bounds[mid], by_size(bounds[:mid], low)).otherwise(by_size(bounds[mid + 1 :], low + mid + 1))


def with_next(docs: DataFrame, columns: list[str], derived: dict[str, Column]) -> DataFrame:
    """next_<column> of the document that follows by doc_id; the first follows the last.

    docs: doc_id, text_key (which orders rows that share a doc_id; a null doc_id
    comes last) and others; columns may name derived ones, which are worked out
    where the rows are read. The ids are cut into ranges at about equal
    numbers of rows; each range also gets a copy of the row that follows it, so
    that no range has to see another. The driver gets a few ids for each range.
    """
    spark = docs.sparkSession
    ranges = shuffle_partitions(spark)
    cuts = docs.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)] or [0.5], 10 * ranges)).first()[0]
    ranged = docs.withColumn("range", F.when(F.col("doc_id").isNull(), F.lit(ranges)).otherwise(by_size(sorted(set(cuts or [])))))
    firsts = ranged.groupBy("range").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("row"))
    firsts = sorted((r[0], r[1]["doc_id"], r[1]["text_key"]) for r in firsts.collect())
    # a range's first row follows the range before
    follow = [(firsts[i - 1][0], *firsts[i][1:]) for i in range(len(firsts))]
    copies = spark.createDataFrame(follow, "range int, follow_id long, follow_key long")
    same = F.col("doc_id").eqNullSafe(F.col("follow_id")) & (F.col("text_key") == F.col("follow_key"))
    copied = docs.join(F.broadcast(copies), same).dropDuplicates(["range"])  # as many rows as ranges
    both = ranged.withColumn("copy", F.lit(False)).unionByName(copied.select(*docs.columns, "range", F.lit(True).alias("copy")))
    both = both.withColumns(derived)
    order = Window.partitionBy("range").orderBy("copy", F.col("doc_id").asc_nulls_last(), "text_key")
    following = [F.lead(c).over(order).alias(f"next_{c}") for c in columns]
    return both.select(*docs.columns, *derived, "copy", *following).where(~F.col("copy")).drop("copy")


def compare_with_next(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited (the text with its last half from the next document), the longs of
    both fingerprints, and their likenesses.
    """
    docs = pick(docs, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    docs = docs.select("doc_id", text_key(), "text")
    rows = with_next(docs, ["text", "print"], {"print": fingerprint(F.col("text"))})
    half = F.floor(F.char_length("text") / 2).cast("int")
    kept = F.substring("text", F.lit(1), F.char_length("text") - half)
    rows = rows.withColumn("edited", F.concat(kept, F.substring("next_text", F.lit(1), half)))
    rows = rows.withColumn("edited_print", fingerprint(F.col("edited")))
    return rows.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        "edited",
        "print",
        "edited_print",
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )
