"""Documents linked by the Jaccard coefficient of their word shingles (operator 9).

Two documents link when their shingle sets share a percentage of their union;
the links' connected components are returned. Every document's shingles are put
in one global order, rare ones first. Two sets that are alike enough share at
least m of the first (size - least overlap + m), for every m (adaptive
multi-match prefixes). Each document picks the m of least estimated cost: the
longer prefix is looked up in more buckets, but as many as m shared shingles
are asked for before a pair is verified. Of two documents the smaller m holds.

1. Documents are hashed: a name for the set, its size, and counts of shingles in
   a sketch of SKETCH cells (of a size that doesn't depend on the data). Equal
   sets have one name from here on, so copies cost nothing more.
2. The sketch gives the global order and the estimates; prefixes are written.
   Buckets with a single set are dropped.
   A pair's sizes tell how much it has to share, and so how early; and the parities
   of groups of shingles (more for larger sets) how much it differs at least.
3. Stars first: each set is verified against the smallest and the largest of
   its buckets, if it shares more than one with them and passes the tests. This links most of a group of near copies with as many pairs as
   members. Buckets of one component are done with. In others that are large each
   set is verified against the one of another component that its parities are
   nearest to, again while this links many: pairs that would link what is linked
   by another way never become rows. Then the pairs in
   different components that pass both tests are found where the bucket is,
   large buckets in blocks of BUCKET_ROWS, and only those become rows: a group
   of sets that lie just below the threshold gives no rows for its pairs. In
   small buckets, which are most, parities would outweigh the pairs: there the
   pairs that share enough are tested by parities. They
   are verified, so no link between components is lost; pairs within a
   component can't change the result. (A link inside a component may go
   unverified; the components are what is returned.)
4. Components are found by large-star and small-star rounds over the links, as
   tables; nothing of this comes to the driver.

Verification compares the words themselves. Set names have 64 bits.

Null and empty texts have no shingles and link with nothing; texts with fewer
words than a shingle are one shingle. Rows that share a doc_id are documents of
their own. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageloom.llm.common import chunks, give_back_driver, materialize, mixed, offsets, pick, ragged, same_row, text_key
from pageloom.session import release, run_dir

SKETCH, BLOCKS = 1 << 19, 16
MOST_MATCHES = 4
#: Hubs that a set is tested against, by sizes and parities, before two of them are verified.
HUBS = 4
#: Cost of verifying a pair, in bucket rows looked up.
VERIFY = 20
#: Bytes of text that a task works on at a time.
CHUNK_BYTES = 4 << 20
#: Bits of the maps of texts that are needed to verify pairs, and of shingles that several sets look up.
TEXT_BITS, KEY_BITS = 1 << 22, 1 << 26
STEP = np.uint64(0x9E3779B97F4A7C15)
#: Counts in the order of shingles beyond this are alike.
MOST_COUNT = 0xFFFFFFFF


#: Two sets differ by at least as many shingles as their parities differ by bits. Sets of more than half as many
#: shingles have the next number of bits too; folded by exclusive or, more bits give fewer.
PARITIES = (256, 1024, 4096)
#: Sets of a bucket whose pairs are looked at in one go, and pairs at a time.
BUCKET_ROWS, PAIRS = 2048, 1 << 18
#: Buckets of more sets are large: there sets look for their nearest first. This is done again if one of so many pairs links.
LARGE_BUCKET, MANY = 64, 4


def least_overlap(size, percent: int):
    """Shingles that a set of a size shares with any that it links with."""
    return -(-size * percent // 100)


def shingles(text: bytes, words: int) -> set[tuple[bytes, ...]]:
    split = text.lower().split()
    if len(split) < words:
        return {tuple(split)} if split else set()
    return set(zip(*(split[i:] for i in range(words)), strict=False))


def lower_words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """Words of texts in lower case, one after the other, and how many each text has."""
    raw = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    raw = raw + np.where((raw >= 65) & (raw <= 90), np.uint8(32), np.uint8(0))
    inside = (raw != 32) & ((raw < 9) | (raw > 13))
    edges = np.flatnonzero(np.diff(inside, prepend=False))
    first, after = edges[::2], edges[1::2]  # the last byte is a blank
    flat = [None, pa.py_buffer(offsets(after - first)), pa.py_buffer(raw[inside])]
    bounds = offsets([len(t) + 1 for t in texts])
    return pa.Array.from_buffers(pa.large_binary(), len(first), flat), np.diff(np.searchsorted(first, bounds))


def sort_runs(values: np.ndarray, starts: np.ndarray) -> None:
    """Sorts each of some runs, one after the other, in place."""
    bounds = starts.tolist()
    for a, b in zip(bounds, bounds[1:], strict=False):
        values[a:b].sort()


class Sets:
    """Hashed shingle sets of the texts of a chunk, each sorted, one after the other."""

    def __init__(self, texts: list[bytes], words: int):
        split, lengths = lower_words(texts)
        coded = split.dictionary_encode()
        named = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
        names = named[coded.indices.to_numpy()]
        starts = offsets(lengths)
        doc = np.repeat(np.arange(len(texts)), lengths)
        size = np.minimum(lengths, words)  # words of a document's shingles
        at = np.arange(len(names))
        first = at[at <= (starts[1:] - size)[doc]]
        hashes, owner = np.zeros(len(first), np.uint64), doc[first]
        for i in range(words):
            inside = size[owner] > i
            hashes[inside] = mixed(hashes[inside] * STEP + names[first[inside] + i])
        sort_runs(hashes, offsets(np.bincount(owner, minlength=len(texts))))
        new = np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])][: len(hashes)]
        self.hashes, self.owner = hashes[new], owner[new]
        self.sizes = np.bincount(self.owner, minlength=len(texts))
        self.starts = offsets(self.sizes)
        raw = self.hashes.tobytes()
        bounds = (self.starts * 8).tolist()
        self.names = np.array([xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)], np.uint64).view(np.int64)

    def parities(self) -> list[bytes]:
        """Bits of each set, as many as its size asks for: whether an odd number of its shingles falls on each."""
        widths = np.array(PARITIES)[parity_level(self.sizes)]
        starts = offsets(widths)
        place = starts[self.owner] + ((self.hashes >> np.uint64(9)) % widths[self.owner].astype(np.uint64)).astype(np.int64)
        odd = np.packbits((np.bincount(place, minlength=starts[-1]) & 1).astype(np.uint8)).tobytes()
        bounds = (starts // 8).tolist()
        return [odd[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def distinct(self) -> np.ndarray:
        """The first document of each set that is not empty."""
        some = np.flatnonzero(self.sizes)
        return some[np.unique(self.names[some], return_index=True)[1]]


def parity_level(sizes: np.ndarray) -> np.ndarray:
    return np.searchsorted(np.array(PARITIES[:-1]) * 2, sizes)


def folded(parity: bytes, level: int) -> bytes:
    """The bits of a smaller level."""
    words = np.frombuffer(parity, np.uint64).reshape(-1, PARITIES[level] // 64)
    return np.bitwise_xor.reduce(words, axis=0).tobytes()


class Candidates:
    """Pairs of buckets that may link, found from rows (key, low, high, block, name, size, wanted, place, component, parity).

    A bucket's rows of two blocks low and high meet under (key, low, high), in
    order; each pair of them is looked at once. Without parities only sizes,
    places and components are tested.
    """

    def __init__(self, rows: pa.Table, percent: int):
        self.percent = percent
        columns = {c: rows.column(c).to_numpy() for c in ("key", "low", "high", "block", "name", "size", "wanted", "place", "component")}
        self.name, self.component, self.block = columns["name"], columns["component"], columns["block"]
        self.size, self.wanted, self.place = (columns[c].astype(np.int64) for c in ("size", "wanted", "place"))
        change = np.zeros(max(len(self.name) - 1, 0), bool)
        for c in ("key", "low", "high"):
            change |= columns[c][1:] != columns[c][:-1]
        starts = np.r_[0, np.flatnonzero(change) + 1, len(self.name)]
        self.end = np.repeat(starts[1:], np.diff(starts))
        self.alone = columns["low"] == columns["high"]
        self.level = parity_level(self.size)
        self.bits = []
        if "parity" not in rows.column_names:
            return
        parities = rows.column("parity").to_pylist()
        for level, width in enumerate(PARITIES):
            blank = bytes(width // 8)
            bits = [folded(p, level) if own >= level else blank for p, own in zip(parities, self.level.tolist(), strict=True)]
            self.bits.append(np.frombuffer(b"".join(bits), np.uint64).reshape(len(bits), width // 64))

    def passed(self) -> Iterator[tuple[np.ndarray, ...]]:
        partners = self.end - np.arange(len(self.end)) - 1
        upto = offsets(partners)
        first = 0
        while first < len(partners):
            last = max(first + 1, int(np.searchsorted(upto, upto[first] + PAIRS, "right")) - 1)
            some = np.arange(first, last)
            i = np.repeat(some, partners[some])
            yield self.alike(i, i + 1 + np.arange(len(i)) - np.repeat(upto[some] - upto[first], partners[some]))
            first = last

    def pairs(self) -> Iterator[pa.RecordBatch]:
        for i, j, m, _ in self.passed():
            yield pa.RecordBatch.from_arrays([*self.ends(i, j), pa.array(m.astype(np.int8))], ["a", "b", "m"])

    def nearest(self) -> pa.RecordBatch:
        """For each row that may link the one it has most room to spare with."""
        most, other = np.full(len(self.name), -1, np.int64), np.zeros(len(self.name), np.int64)
        for i, j, _, spare in self.passed():
            own, spare = np.r_[i, j], np.r_[spare, spare]
            order = np.lexsort((spare, own))
            last = order[np.flatnonzero(np.r_[own[order][1:] != own[order][:-1], True][: len(order)])]
            last = last[spare[last] > most[own[last]]]
            most[own[last]], other[own[last]] = spare[last], np.r_[j, i][last]
        some = np.flatnonzero(most >= 0)
        return pa.RecordBatch.from_arrays([pa.array(self.name[some]), pa.array(most[some]), *self.ends(some, other[some])], ["name", "spare", "a", "b"])

    def ends(self, i: np.ndarray, j: np.ndarray) -> list[pa.Array]:
        return [pa.array(end(self.name[i], self.name[j])) for end in (np.minimum, np.maximum)]

    def alike(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of pairs those that may link: both rows, the smaller m, and how many more bits of their parities might differ."""
        apart = (self.component[i] != self.component[j]) & (self.alone[i] | (self.block[i] != self.block[j]))
        i, j = i[apart], j[apart]
        both = self.size[i] + self.size[j]
        # the least overlap of the pair; what they share that often is among the first of both
        overlap = -(-both * self.percent // (100 + self.percent))
        m = np.minimum(self.wanted[i], self.wanted[j])
        early = (overlap <= np.minimum(self.size[i], self.size[j])) & (self.place[i] < self.size[i] - overlap + m) & (self.place[j] < self.size[j] - overlap + m)
        i, j, m, room = i[early], j[early], m[early], (both - 2 * overlap)[early]
        spare = room.copy()
        for level, bits in enumerate(self.bits):
            tested = np.flatnonzero(np.minimum(self.level[i], self.level[j]) >= level)
            spare[tested] = room[tested] - np.bitwise_count(bits[i[tested]] ^ bits[j[tested]]).sum(1, dtype=np.int64)
            kept = spare >= 0
            i, j, m, room, spare = i[kept], j[kept], m[kept], room[kept], spare[kept]
        return i, j, m, spare


def possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, ...) whose sizes and parities allow a link; sets: name, n_shingles, parity."""
    sides = [sets.select(F.col("name").alias(c), F.col("n_shingles").alias(f"size_{c}"), F.col("parity").alias(f"parity_{c}")) for c in "ab"]
    names = pairs.columns
    rows = pairs.join(sides[0], "a").join(sides[1], "b").select(*names, "size_a", "size_b", "parity_a", "parity_b")

    def tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 4096) for b in batches for i in range(0, b.num_rows, 4096)):
            sizes = [batch.column(f"size_{c}").to_numpy() for c in "ab"]
            both = sizes[0] + sizes[1]
            overlap = -(-both * percent // (100 + percent))
            kept, room = overlap <= np.minimum(*sizes), both - 2 * overlap
            level = parity_level(np.minimum(*sizes))
            parities = [batch.column(f"parity_{c}").to_pylist() for c in "ab"]
            for now in range(len(PARITIES)):
                some = np.flatnonzero(kept & (level >= now))
                x, y = (np.frombuffer(b"".join(folded(p[i], now) for i in some.tolist()), np.uint64).reshape(len(some), PARITIES[now] // 64) for p in parities)
                kept[some] = np.bitwise_count(x ^ y).sum(1, dtype=np.int64) <= room[some]
            yield batch.select(names).filter(pa.array(kept))

    return rows.mapInArrow(tested, pairs.schema)


def whole_groups(batches: Iterator[pa.RecordBatch], group: list[str]) -> Iterator[pa.Table]:
    """Tables of one or more groups each, from rows in their order."""
    held: list[pa.RecordBatch] = []
    for batch in (b.slice(i, 4 * BUCKET_ROWS) for b in batches for i in range(0, b.num_rows, 4 * BUCKET_ROWS)):
        same = np.ones(batch.num_rows, bool)
        for c in group:
            column = batch.column(c).to_numpy()
            same &= column == column[-1]
        whole = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if whole:  # a new group begins here: what came before is complete
            yield pa.Table.from_batches([*held, batch.slice(0, whole)])
            held = []
        elif held and any(batch.column(c)[0] != held[-1].column(c)[-1] for c in group):
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(whole))
    if held:
        yield pa.Table.from_batches(held)


def nearest(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): of each set the pair that most likely links it with another component; rows as for ``candidates``.

    Blocks of a bucket are not brought together, so there are at most as many pairs as rows.
    """
    block = F.pmod(F.xxhash64("name"), F.ceil(F.col("times") / BUCKET_ROWS).cast("int")).cast("int")
    group = ["key", "low", "high"]
    rows = rows.select("key", *(block.alias(c) for c in (*group[1:], "block")), "name", "size", "wanted", "place", "component", "parity")
    rows = rows.repartition(*group).sortWithinPartitions(*group)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in whole_groups(batches, group):
            yield Candidates(groups, percent).nearest()

    pairs = rows.mapInArrow(best, "name long, spare long, a long, b long")
    first = pairs.groupBy("name").agg(F.max(F.struct("spare", "a", "b")).alias("pair"))
    return first.select("pair.a", "pair.b").distinct()


def candidates(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b, m) of the pairs that may link in their buckets; rows: key, name, size, wanted, place, component, times (of the key), and parity if it is to be tested."""
    blocks = F.ceil(F.col("times") / BUCKET_ROWS).cast("int")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("name"), blocks).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    group = ["key", "low", "high"]
    rows = rows.select(*group, "block", "name", "size", "wanted", "place", "component", *(c for c in rows.columns if c == "parity"))
    rows = rows.repartition(*group).sortWithinPartitions(*group)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in whole_groups(batches, group):
            yield from Candidates(groups, percent).pairs()

    return rows.mapInArrow(found, "a long, b long, m byte")


def cells(hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes) % np.uint64(SKETCH)).astype(np.int64)


def matches_wanted(estimate: np.ndarray, size, percent: int, start=0) -> np.ndarray:
    """The m of least estimated cost for sets of a size, each a run of the estimates from its start.

    estimate: whole counts of shingles, ascending within a set.
    """
    upto = offsets(estimate)
    short = size - least_overlap(size, percent)
    best, least = np.ones_like(short), np.full_like(short, np.inf, dtype=float)
    for m in range(1, MOST_MATCHES + 1):
        end = start + np.minimum(short + m, size)
        looked_up = upto[end] - upto[start]
        # a candidate shares m shingles: it is looked up m times, and once apart from the m - 1 most frequent
        cost = looked_up + VERIFY * np.minimum(looked_up / m, upto[np.maximum(end - m + 1, start)] - upto[start])
        better = (cost < least) & ((m == 1) | (short + m <= size))
        best, least = np.where(better, m, best), np.where(better, cost, least)
    return best


def components(links: DataFrame, folder: str | None = None) -> DataFrame:
    """node and component (its smallest node) of links (a, b); its tables lie in a folder."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = materialize(edges, "edges", folder)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.where("u <> v").distinct(), "edges", folder)
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        small = materialize(small.select("e.*").where("u <> v").distinct(), "edges", folder)
        sign = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        settled = sign(small) == sign(edges)
        give_back_driver(links.sparkSession)  # of a round's plans: a driver's heap that fills up grows, and stays so
        if settled:
            return small.select(F.col("u").alias("node"), F.col("v").alias("component"))
        edges = small


def probed(rows: DataFrame, wanted: DataFrame, column: str, size: int) -> DataFrame:
    """Rows whose hash in a column may be among the wanted ones, by a bitmap of a fixed size.

    It saves shuffling rows that a join would drop; with very many wanted hashes
    all bits are set and nothing is left out. The bitmap comes to the rows as a
    table of at most size / 32768 rows of 4096 bytes.
    """
    bit = F.pmod(column, F.lit(size)) + 1  # buckets and positions count from 1
    bucket, position = F.bitmap_bucket_number(bit), F.bitmap_bit_position(bit)
    maps = wanted.groupBy(bucket.alias("bitmap")).agg(F.bitmap_construct_agg(position).alias("bits"))
    byte = F.substring("bits", (F.shiftright(position, 3) + 1).cast("int"), F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), (position % 8).cast("int")) == 1
    return rows.join(F.broadcast(maps), bucket == F.col("bitmap")).where(is_set).select(*rows.columns)


def link(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text_key, n_shingles, component (null without shingles) and component_id of every row."""
    docs = pick(docs, doc_id="long", text="string").select("doc_id", text_key(), "text")
    folder = run_dir(docs.sparkSession, "similar")  # of all tables but the last; deleted in the end
    table = partial(materialize, folder=folder)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text_key", "n_shingles", "name", "parity", "block", "counts"]
        counts = np.zeros(SKETCH, np.int64)
        for batch, texts in chunks(batches, CHUNK_BYTES):
            sets = Sets(texts, words)
            counted = np.isin(sets.owner, sets.distinct())
            counts += np.bincount(cells(sets.hashes[counted]), minlength=SKETCH)
            n = len(texts)
            some = pa.array(sets.names, mask=sets.sizes == 0)
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(sets.sizes), some]
            columns += [pa.array(sets.parities(), pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)
        parts = [c.astype("<u4").tobytes() for c in np.split(np.minimum(counts, 0xFFFFFFFF), BLOCKS)]
        columns = [*[pa.nulls(BLOCKS, pa.int64())] * 4, pa.nulls(BLOCKS, pa.binary()), pa.array(range(BLOCKS), pa.int32()), pa.array(parts, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, text_key long, n_shingles long, name long, parity binary, block int, counts binary"
    first = table(docs.mapInArrow(hashed, schema), "sets")

    def summed(parts: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, "<u4").astype(np.int64) for b in parts.column("counts").to_pylist())
        return pa.table({"block": parts.column("block").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    blocks = first.where("block IS NOT NULL").select("block", "counts").groupBy("block").applyInArrow(summed, "block int, counts binary")
    sketch = np.zeros(SKETCH, np.int64)
    for row in blocks.collect():  # BLOCKS rows, SKETCH cells
        sketch[row.block * (SKETCH // BLOCKS) : (row.block + 1) * (SKETCH // BLOCKS)] = np.frombuffer(row.counts, np.int64)
    noise = int(sketch.mean() + 3 * np.sqrt(sketch.mean()))
    shared = docs.sparkSession.sparkContext.broadcast(sketch)
    kept = first.where("block IS NULL").select("doc_id", "text_key", "n_shingles", "name", "parity")

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in chunks(batches, CHUNK_BYTES):
            sets = Sets(texts, words)
            order = np.minimum(shared.value[cells(sets.hashes)], MOST_COUNT).astype(np.uint64) << np.uint64(32)
            order |= (np.arange(len(order)) - sets.starts[sets.owner]).astype(np.uint64)
            sort_runs(order, sets.starts)  # by count, and by hash, as the sets are sorted
            counts, place = (order >> np.uint64(32)).astype(np.int64), (order & np.uint64(MOST_COUNT)).astype(np.int64)
            hashes, estimates = sets.hashes[sets.starts[sets.owner] + place], np.maximum(counts - noise, 1)
            some = sets.distinct()
            start, size = sets.starts[some], sets.sizes[some]
            wanted = matches_wanted(estimates, size, percent, start)
            taken = size - least_overlap(size, percent) + wanted
            at, entry = ragged(start, taken), np.repeat(np.arange(len(some)), taken)
            columns = [hashes[at].view(np.int64), sets.names[some][entry], size[entry].astype(np.int32), wanted[entry].astype(np.int8), (at - start[entry]).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "name", "size", "wanted", "place"])

    rows = docs.select("text").mapInArrow(prefixes, "key long, name long, size int, wanted byte, place int")
    entries = table(rows, "prefixes")
    several = table(entries.groupBy("key").count().where("count > 1").select("key"), "several")
    entries = probed(entries, several, "key", KEY_BITS).join(several, "key").dropDuplicates(["key", "name"])
    entries = table(entries, "buckets")
    ends = entries.groupBy("key").agg(F.min("name").alias("low"), F.max("name").alias("high"), F.min("wanted").alias("least")).where("low < high")
    entries = entries.join(ends, "key")
    # sets that share too little with all others together need no look at their texts
    met = entries.groupBy("name").agg(F.count("*").alias("n"), F.min(F.least("wanted", "least")).alias("m")).where("n >= m").select("name")
    entries = table(entries.join(met, "name"), "buckets")

    sources = kept.join(met, "name").groupBy("name").agg(F.min(F.struct("doc_id", "text_key", "n_shingles", "parity")).alias("row"))
    sources = table(sources.select("name", "row.*"), "sources")
    def verified(pairs: DataFrame) -> DataFrame:
        def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
                same = []
                for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                    p, q = shingles(x.encode(), words), shingles(y.encode(), words)
                    common = len(p & q)
                    same.append(100 * common >= percent * (len(p) + len(q) - common))
                yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(same))

        # only texts of pairs move
        pairs = table(pairs.select("a", "b"), "pairs")
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct()
        wanted = table(wanted.join(sources.select("name", "doc_id", "text_key"), "name"), "wanted")
        rows = probed(docs, wanted, "text_key", TEXT_BITS)
        texts = rows.join(wanted, same_row(rows, wanted)).select("name", "text").dropDuplicates(["name"])
        left = texts.select(F.col("name").alias("a"), F.col("text").alias("x"))
        right = texts.select(F.col("name").alias("b"), F.col("text").alias("y"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
        done = table(both.mapInArrow(check, "a long, b long"), "links")
        give_back_driver(docs.sparkSession)  # of plans with a dozen joins each
        return done

    star = entries.select(F.col("name").alias("b"), F.explode(F.array("low", "high")).alias("a")).where("a <> b")
    star = star.groupBy("a", "b").count().where("count > 1")

    def likeliest(pairs: DataFrame) -> DataFrame:
        """Of the HUBS hubs that a set shares most keys with, the two first that it may link with."""
        order = Window.partitionBy("b").orderBy(F.desc("count"), "a")
        first = pairs.withColumn("place", F.row_number().over(order)).where(F.col("place") <= HUBS).drop("place")
        return possible(first, sources, percent).withColumn("place", F.row_number().over(order)).where("place <= 2")

    links = verified(likeliest(star))

    found = components(links, folder)

    def open_buckets(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows with their components as found so far, and key and times of the buckets that several components meet in."""
        rows = rows.drop("component", "times").join(found, F.col("name") == F.col("node"), "left")
        rows = table(rows.select("key", "name", "size", "wanted", "place", F.coalesce("component", "name").alias("component")), "buckets")
        counts = rows.groupBy("key").agg(F.min("component").alias("p"), F.max("component").alias("q"), F.count("*").alias("times"))
        return rows, counts.where("p < q").select("key", "times")

    # once more, against the ends of each bucket by component
    rows, several = open_buckets(entries)
    placed = table(rows.join(several, "key"), "open")
    edge = F.struct("component", "name")
    ends = placed.groupBy("key").agg(F.min(edge).alias("low"), F.max(edge).alias("high"))
    again = placed.join(ends, "key").select(F.col("name").alias("b"), "component", F.explode(F.array("low", "high")).alias("hub"))
    again = again.where("hub.component <> component").groupBy(F.col("hub.name").alias("a"), "b").count().where("count > 1")
    links = table(links.unionByName(verified(likeliest(again))), "links")
    found = components(links, folder)
    # in large buckets every set against its nearest, while that links many; the others wait
    parities, linked_many = sources.select("name", "parity"), True
    few, placed = (placed.where(c) for c in (F.col("times") <= LARGE_BUCKET, F.col("times") > LARGE_BUCKET))
    while True:
        rows, several = open_buckets(placed)
        several = table(several, "several")
        if not linked_many or several.isEmpty():
            break
        near = table(nearest(rows.join(several, "key").join(parities, "name"), percent), "near")
        new = verified(near)
        linked_many = MANY * new.count() >= near.count() > 0
        links = table(links.unionByName(new), "links")
        found = components(links, folder)
        placed = rows
    pairs = candidates(rows.join(several, "key").join(parities, "name"), percent)
    # a set has less than LARGE_BUCKET pairs in a small bucket: these are cheaper than a parity in every bucket
    rows, several = open_buckets(few)
    pairs = pairs.unionByName(candidates(rows.join(several, "key"), percent))
    pairs = table(pairs.groupBy("a", "b").agg(F.count("*").alias("n"), F.min("m").alias("m")).where("n >= m").select("a", "b"), "met")
    more = verified(possible(pairs, sources, percent))
    found = components(links.unionByName(more), folder)

    rows = kept.join(found, kept["name"] == found["node"], "left")
    rows = rows.select("doc_id", "text_key", "n_shingles", F.coalesce("component", "name").alias("component"))
    rows = materialize(rows, "rows")
    shared.destroy()
    release(docs.sparkSession, folder)
    give_back_driver(docs.sparkSession)
    smallest = rows.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    out = rows.join(smallest, "component", "left")
    return out.select("doc_id", "text_key", "n_shingles", "component", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The first row by doc_id (null comes last) of each component, and every row without shingles; all columns."""
    linked = link(docs, words, percent)
    groups = linked.groupBy("component", "doc_id", "text_key").agg(F.count("*").alias("times"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key", "times")
    first = groups.where("component IS NOT NULL").groupBy("component").agg(F.min(order).alias("row")).select("row.doc_id", "row.text_key", "row.times")
    alone = groups.where("component IS NULL").select("doc_id", "text_key", F.lit(1).cast("long").alias("times"))
    chosen = materialize(first.unionByName(alone), "chosen")
    # the columns have other names meanwhile, so that none clashes
    rows = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))])
    place = lambda c: F.col(f"_{docs.columns.index(c)}")
    rows = rows.withColumn("doc_id", place("doc_id").cast("long")).withColumn("text_key", F.xxhash64(place("text").cast("string")))

    def taken(groups: DataFrame) -> DataFrame:
        return rows.join(groups, same_row(rows, groups)).select(*[rows[c] for c in rows.columns])

    # of repeated rows one; no other row has to move for that
    repeated = taken(chosen.where("times > 1")).dropDuplicates(["doc_id", "text_key"])
    return taken(chosen.where("times = 1")).unionByName(repeated).drop("doc_id", "text_key").toDF(*docs.columns)
