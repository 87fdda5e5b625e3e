"""Runs of words that repeat with a period inside one document (operator 11).

A run is a stretch of consecutive words with smallest period q (words q apart are
the same) and at least max(6, 4 q) words that no neighbouring word extends.

Seed and extend along diagonals. Where a run has period q, the words at lag q
agree over at least 3 q places (5 where q is 1). Periods are taken in classes,
from one power of two to the next, and each class has the k-grams of the least
overlap that its periods guarantee: 5 words for q = 1, then 6 for 2 and 3, 12
for 4 to 7, and so on. A k-gram is at least as long as the periods of its
class, so inside a run of smallest period q it does not occur again nearer than
q: another occurrence would give the run a smaller period. Neighbouring
occurrences of a k-gram, linear in number, are thus all the pairs that are
needed. They are taken lag by lag and from left to right. The furthest place
that is covered at the lag is kept: seeds below it lie on a diagonal that was
extended already and are passed over. The others are extended to both sides by
comparing words.

k-grams have exact names (numbers of pairs of names, by sorting), and only
places whose k-gram occurs again in the document go on to longer ones, so text
without repeats costs little more than its words. Rows are worked on where they
are read; nothing is shuffled. A task holds the words of CHUNK_BYTES of text, or
of one longer text.

Null and empty texts have no words and no runs. Rows that share a doc_id or are
repeated are documents of their own, each with its row. Runs that overlap, and
equally long ones, are all returned. An empty table gives an empty table. Other
columns do no harm, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import SPACE_RUN, chunks, offsets, pick, ragged, typed

#: Bytes of text that a task works on at a time.
CHUNK_BYTES = 4 << 20
LEAST_LENGTH, LEAST_PERIODS = 6, 4
RUNS = "array<struct<start: long, length: long, period: long>>"


class Grams:
    """Places whose gram occurs again, in the order of grams and then of places, and the number of each one's gram."""

    def __init__(self, at: np.ndarray, key: np.ndarray):
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        new = np.r_[True, key[1:] != key[:-1]][: len(key)]
        again = ~(new & np.r_[new[1:], True][: len(key)])
        self.at, self.name = at[again], np.cumsum(new[again]) - 1

    def followed(self, other: Grams, step: int, size: int) -> Grams:
        """Grams made of one of these and one of the others that begins step words on; size: number of words."""
        names = np.full(size + step, -1, np.int64)
        names[other.at] = other.name
        at = np.sort(self.at)
        mine = np.full(size, -1, np.int64)
        mine[self.at] = self.name
        second = names[at + step]
        at, second = at[second >= 0], second[second >= 0]
        return Grams(at, mine[at] * (size + 1) + second)

    def neighbours(self, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Place and lag of neighbouring occurrences of a gram that are so far apart."""
        lag = np.diff(self.at)
        wanted = (np.diff(self.name) == 0) & (lag >= least) & (lag <= most)
        return self.at[:-1][wanted], lag[wanted]


def agreeing(words: np.ndarray, a: int, b: int, limit: int, way: int = 1) -> int:
    """How many words from places a and b on are the same, at most limit; way -1 looks back, from the words before."""
    done, step = 0, 64
    while done < limit:
        step = min(step, limit - done)
        if way > 0:
            unlike = words[a + done : a + done + step] != words[b + done : b + done + step]
        else:
            unlike = (words[a - done - step : a - done] != words[b - done - step : b - done])[::-1]
        if unlike.any():
            return done + int(unlike.argmax())
        done += step
        step *= 2
    return done


def extended(words: np.ndarray, bounds: np.ndarray, place: np.ndarray, lag: np.ndarray) -> list[tuple[int, int, int]]:
    """start, length and period of the stretches on which seeds lie; bounds: where documents begin."""
    size = len(words) + 1
    seeds = np.sort(lag * size + place)
    out, i = [], 0
    while i < len(seeds):
        q, p = divmod(int(seeds[i]), size)
        doc = int(np.searchsorted(bounds, p, "right"))
        low, high = int(bounds[doc - 1]), int(bounds[doc])
        end = p + agreeing(words, p, p + q, high - p - q)
        start = p - agreeing(words, p, p + q, p - low, -1)
        out.append((start, end - start + q, q))
        i = int(np.searchsorted(seeds, q * size + end))  # what is covered at this lag
    return out


def runs(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """start, length and period of every run, by start, length; words: numbers; bounds: where documents begin, and the end."""
    size, lengths = len(words), np.diff(bounds)
    longest = int(lengths.max(initial=0))
    if longest < LEAST_LENGTH:
        return np.zeros((0, 3), np.int64)
    # the document is part of a word's name: no gram that reaches into the next one occurs twice
    doc = np.repeat(np.arange(len(lengths)), lengths)
    one = Grams(np.arange(size), doc * (int(words.max()) + 1) + words)
    two = one.followed(one, 1, size)
    gram = two.followed(one, 2, size)
    found = extended(words, bounds, *gram.followed(two, 3, size).neighbours(1, 1))
    k, least = 3, 2
    while len(gram.at) and LEAST_PERIODS * least <= longest:
        gram, k = gram.followed(gram, k, size), 2 * k
        found += extended(words, bounds, *gram.neighbours(least, 2 * least - 1))
        least *= 2
    found = np.array(found, np.int64).reshape(-1, 3)
    found = found[found[:, 1] >= np.maximum(LEAST_LENGTH, LEAST_PERIODS * found[:, 2])]
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    new = np.r_[True, (found[1:, :2] != found[:-1, :2]).any(1)][: len(found)]  # a multiple of the period gives the same stretch
    return found[new]


def collapse(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_words, runs and collapsed_text: its words without those that repeat a run's first period."""
    docs = pick(docs, keep, doc_id="long", text="string")

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, CHUNK_BYTES):
            split = [t.split() for t in texts]
            bounds = offsets([len(s) for s in split])
            flat = [w for s in split for w in s]
            words = pa.array(flat, pa.large_binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
            found = runs(words, bounds)
            doc = np.searchsorted(bounds, found[:, 0], "right") - 1
            dropped = np.zeros(len(words) + 1, np.int64)
            np.add.at(dropped, found[:, 0] + found[:, 2], 1)
            np.add.at(dropped, found[:, 0] + found[:, 1], -1)
            kept = np.cumsum(dropped)[:-1] == 0
            for i in np.unique(doc).tolist():
                split[i] = [flat[j] for j in (np.flatnonzero(kept[bounds[i] : bounds[i + 1]]) + bounds[i]).tolist()]
            columns = [found[:, 0] - bounds[doc], found[:, 1], found[:, 2]]
            structs = pa.StructArray.from_arrays([pa.array(c) for c in columns], ["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(offsets(np.bincount(doc, minlength=len(texts))).astype(np.int32)), structs)
            text = pa.array([b" ".join(s) for s in split], pa.binary()).cast(pa.string())
            rows = [batch.column("doc_id"), pa.array(np.diff(bounds)), lists, text, *map(batch.column, keep)]
            yield pa.RecordBatch.from_arrays(rows, ["doc_id", "n_words", "runs", "collapsed_text", *keep])

    schema = f"doc_id long, n_words long, runs {RUNS}, collapsed_text string"
    return docs.mapInArrow(searched, ", ".join(filter(None, [schema, typed(docs, *keep)])))


def with_looped_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text; about every tenth text ends in a loop of its own words.

    With h the crc32 of the decimal doc_id and g = h / 10, documents whose h is
    divisible by 10 repeat p = 1 + (n - a) / (3 + g % 8) of their n words from word
    a = g % n on. Other texts, and those without words or doc_id, are as they were.
    """
    docs = pick(docs, doc_id="long", text="string")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(F.when(h % 10 == 0, F.col("text")), SPACE_RUN), lambda w: w != "")
    docs = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("words"))
    n = F.when(F.size("words") > 0, F.size("words"))
    docs = docs.select("*", n.alias("n"), (F.col("g") % n).cast("int").alias("a"))
    p = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)).cast("int")
    tail = F.col("n") - F.col("a")
    block = F.slice("words", F.col("a") + 1, p)
    loop = F.slice(F.flatten(F.array_repeat(block, F.ceil(tail / p).cast("int"))), F.lit(1), tail)
    looped = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), loop), " ")
    return docs.select("doc_id", F.when(F.col("n").isNotNull(), looped).otherwise(F.col("text")).alias("text"))
