"""Long byte strings that occur more than once, by deep-shallow suffix sorting (operator 7).

Every string of `length` bytes contains one of a set of anchors: of the grams
(half as long) that start in its first half, the one with the smallest hash.
Equal strings have the same anchor in the same place.

1. Anchors are found where documents are read. Their hashes meet in buckets; an
   anchor that occurs once rules out all strings that it is the anchor of.
2. For the others, the bytes that those strings cover (at most 1.5 lengths) are
   gathered by hash. The parts after the anchor are sorted as suffixes and the
   parts before it, reversed, as well: deep-shallow, that is multikey quicksort
   (8 bytes are a character) to a shallow depth, and blind tries for what is
   still equal there. Going through the suffixes' common prefixes from the
   longest, neighbours in the order of the parts before give, for each, the
   longest string shared on either side of the anchor: exactly its repeats.
3. Groups of more than GROUP strings are compared string by string with hashes in
   Spark instead, where counts are partly summed before they meet.

Equal contexts of a chunk are sent once, so a passage that a third of all
documents have reaches a bucket once for each chunk.

Null texts are empty. A result depends only on the texts; rows that are repeated,
or share a doc_id, are documents of their own, doc_id may be null. Strings never
cross documents. An empty table gives an empty table.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import chunks, materialize, mixed, offsets, pick, raw_texts, same_row, shuffle_partitions, text_key, typed
from pageloom.llm.substrings import BACK, DEALT, MARKED, Chunk, by_document, covered, deal, documents, packed, unpacked

CHUNK_BYTES = 2 << 20
#: Strings of a chunk whose anchors are found in one go.
SLAB = 1 << 17
#: Strings of a group that are sorted in one piece of work.
GROUP = 2000
#: Depth that multikey quicksort goes to, in bytes; smaller groups go to the tries at once.
SHALLOW, FEW = 64, 4

ENTRY = np.dtype([("key", "<u8"), ("at", "<u4"), ("many", "u1")])
BASE = 0x9E3779B97F4A7C15 | 1
TABLE = np.random.default_rng(7).integers(1, 1 << 63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)


class Bytes(Chunk):
    """Documents that a task works on at a time as bytes, one document after the other."""

    def __init__(self, batch: pa.RecordBatch, texts: list[bytes]):
        self.ids, self.rows = batch.column("doc_id").to_numpy(), batch.column("text_key").to_numpy()
        self.starts = offsets([len(t) for t in texts])
        self.raw = np.frombuffer(b"".join(texts), np.uint8)
        self.label()

    def anchors(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Place and hash of each anchor, and the first and the last string that it is the anchor of."""
        n = len(self.raw)
        strings = n - length + 1
        if strings < 1:
            return (np.empty(0, np.int64), np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 2)
        bits = np.uint64(max(24, n.bit_length()))
        parts = [self.slab(i, min(i + SLAB, strings), length, bits) for i in range(0, strings, SLAB)]
        anchor, key, low, high = (np.concatenate(p) for p in zip(*parts, strict=True))
        # a run that a slab's end cuts is one run
        first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (low[1:] != high[:-1] + 1)][: len(anchor)])
        last = np.r_[first[1:], len(anchor)][: len(first)] - 1
        return anchor[first], key[first], low[first], high[last]

    def slab(self, begin: int, end: int, length: int, bits: np.uint64) -> tuple[np.ndarray, ...]:
        """The same of the strings that start from begin to before end; what it holds meanwhile doesn't grow with the chunk."""
        gram, raw = length // 2, self.raw[begin : end + length - 1]
        grams = len(raw) - gram + 1
        power = np.full(len(raw) + 1, BASE, np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(TABLE[raw] * power[:-1], out=sums[1:])
        back = np.full(grams, pow(BASE, -1, 1 << 64), np.uint64)
        back[0] = 1
        hashes = mixed((sums[gram:] - sums[:-gram]) * np.multiply.accumulate(back))
        rank = hashes >> bits << bits | np.arange(begin, begin + grams, dtype=np.uint64)
        least = sliding_least(rank, length - gram + 1) & ((np.uint64(1) << bits) - np.uint64(1))
        start = np.arange(begin, end)
        whole = start[start + length <= self.starts[1:][np.searchsorted(self.starts[1:], start, side="right")]]
        anchor = least[whole - begin].astype(np.int64)
        first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1] + 1)][: len(anchor)])
        last = np.r_[first[1:], len(anchor)][: len(first)] - 1
        return anchor[first], hashes[anchor[first] - begin], whole[first], whole[last]


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each `width` neighbours: from runs in blocks, forwards and backwards."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def blind_trie(strings: list[bytes], ids: list[int]) -> list[int]:
    """ids in the order of their strings. A node is [depth, branches by byte (-1: the string ends)] or a leaf."""
    if len(ids) < 2:
        return ids
    at = lambda i, d: strings[i][d] if d < len(strings[i]) else -1
    root: list | int = ids[0]
    equal: dict[int, list[int]] = {}
    for i in ids[1:]:
        node = root
        while isinstance(node, list):  # blindly to some leaf
            node = node[1].get(at(i, node[0])) if at(i, node[0]) in node[1] else next(iter(node[1].values()))
        depth = common(strings[i], strings[node])
        if depth == len(strings[i]) == len(strings[node]):
            equal.setdefault(node, []).append(i)
            continue
        above, key, node_at = None, None, root
        while isinstance(node_at, list) and node_at[0] < depth:
            above, key = node_at, at(i, node_at[0])
            node_at = node_at[1].get(key)
        if isinstance(node_at, list) and node_at[0] == depth:
            node_at[1][at(i, depth)] = i
            continue
        split = [depth, {at(node, depth): node_at, at(i, depth): i}]
        if above is None:
            root = split
        else:
            above[1][key] = split
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, list):
            stack += [node[1][k] for k in sorted(node[1], reverse=True)]
        else:
            out += [node, *equal.get(node, [])]
    return out


def deep_shallow(strings: list[bytes]) -> list[int]:
    """Numbers of the strings in order."""
    size = SHALLOW // 8
    # a string that ends is padded with zeros; the trie puts it before one that goes on with zeros
    words = np.frombuffer(b"".join(s[:SHALLOW].ljust(SHALLOW, b"\0") for s in strings), ">u8").reshape(-1, size).astype(np.uint64)
    out: list[int] = []
    stack = [(np.arange(len(strings)), 0)]
    while stack:
        ids, depth = stack.pop()
        if len(ids) <= FEW or depth == size:
            out += blind_trie(strings, ids.tolist())
            continue
        word = words[ids, depth]
        pivot = np.sort(word[:: max(1, len(word) // 9)])
        pivot = pivot[len(pivot) // 2]
        stack += [(part, d) for part, d in ((ids[word > pivot], depth), (ids[word == pivot], depth + 1), (ids[word < pivot], depth)) if len(part)]
    return out


def repeats(befores: list[bytes], afters: list[bytes], length: int) -> list[tuple[int, int, int]]:
    """(string, least, most) offsets of the anchor in repeated strings.

    befores (reversed) and afters are what stands on either side of an anchor's
    first byte. No two pairs are equal.
    """
    order = deep_shallow(afters)
    rank = {s: r for r, s in enumerate(deep_shallow(befores))}
    by_rank = sorted(rank, key=rank.get)
    prefix = [common(afters[a], afters[b]) for a, b in zip(order, order[1:], strict=False)]
    parent = list(range(len(order)))
    members = {i: [rank[s]] for i, s in enumerate(order)}
    found = []

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in sorted(range(len(prefix)), key=lambda i: -prefix[i]):
        small, large = sorted((find(i), find(i + 1)), key=lambda r: len(members[r]))
        for r in members.pop(small):
            held = members[large]
            at = bisect_left(held, r)
            for other in (*held[max(0, at - 1) : at], *held[at : at + 1]):
                a, b = by_rank[r], by_rank[other]
                most = min(common(befores[a], befores[b]), length)
                if most >= (least := max(0, length - prefix[i])):
                    found += [(a, least, most), (b, least, most)]
            insort(held, r)
        parent[small] = large
    return found


def repeated(docs: DataFrame, length: int) -> DataFrame:
    """doc_id, text_key and marks (first and last places of runs, 32-bit) of strings that start anywhere else too.

    docs has doc_id (not null), text_key and text.
    """
    buckets = shuffle_partitions(docs.sparkSession)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, CHUNK_BYTES):
            chunk = Bytes(batch, texts)
            at, key, _, _ = chunk.anchors(length)
            at, one = np.unique(at, return_index=True)
            key = key[one]
            order = np.argsort(key, kind="stable")
            first = np.r_[True, key[order][1:] != key[order][:-1]][: len(order)]
            size = np.diff(np.r_[np.flatnonzero(first), len(order)])
            entries = np.empty(int(first.sum()), ENTRY)
            entries["key"], entries["at"], entries["many"] = key[order][first], at[order][first], size > 1
            settled = at[order][np.repeat(size > 1, size)].astype("<u4")
            bucket = ((entries["key"] >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
            yield deal(chunk, entries, bucket, buckets, settled)

    def shared(table: pa.Table) -> pa.Table:
        """Of a bucket's anchors, those that occur again in another chunk."""
        settled = table.column("settled").to_pylist()
        blobs = table.column("entries").to_pylist()
        parts = [unpacked(b"" if s else b, ENTRY) for b, s in zip(blobs, settled, strict=True)]
        entries = np.concatenate(parts)
        _, which, times = np.unique(entries["key"], return_inverse=True, return_counts=True)
        again = np.split((times[which] > 1) & (entries["many"] == 0), offsets([len(p) for p in parts])[1:-1])
        found = [b if s else packed(p["at"][a].astype("<u4")) for b, s, p, a in zip(blobs, settled, parts, again, strict=True)]
        rows = table.column("rows")
        used = [o if r.is_valid else None for o, r in zip(table.column("owners").to_pylist(), rows, strict=True)]
        return pa.table([table.column("chunk"), pa.array(used, pa.binary()), rows, pa.array(found, pa.binary())], ["chunk", "owners", "rows", "entries"])

    def placed(table: pa.Table) -> pa.Table:
        ids, rows, ends = documents(table)
        at = np.concatenate([unpacked(b, np.dtype("<u4")) for b in table.column("entries").to_pylist()])
        return by_document(ids, rows, ends, np.unique(at).astype(np.int64))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text_key", "key", "at", "before", "context", "many", "marks"]
        for batch, texts in chunks(batches, CHUNK_BYTES):
            chunk = Bytes(batch, texts)
            at, key, low, high = chunk.anchors(length)
            owner = np.searchsorted(chunk.starts[1:], at, side="right")
            wanted = [np.frombuffer(m, "<u4") + np.int64(s) for m, s in zip(batch.column("marks").to_pylist(), chunk.starts.tolist(), strict=False)]
            used = np.flatnonzero(np.isin(at, np.concatenate(wanted))).tolist()
            groups: dict[tuple, list[int]] = {}
            for i in used:
                groups.setdefault((int(key[i]), int(at[i] - low[i]), chunk.raw[low[i] : high[i] + length].tobytes()), []).append(i)
            ones = [members[0] for members in groups.values()]
            local = at[ones] - chunk.starts[owner[ones]]
            n = len(ones)
            columns = [
                pa.array(chunk.ids[owner[ones]]),
                pa.array(chunk.rows[owner[ones]]),
                pa.array(key[ones].view(np.int64)),
                pa.array(local.astype(np.int32)),
                pa.array([k[1] for k in groups], pa.int32()),
                pa.array([k[2] for k in groups], pa.binary()),
                pa.array([len(m) > 1 for m in groups.values()], pa.bool_()),
                pa.nulls(n, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)
            # contexts that the chunk has again are repeats as they are
            runs: dict[int, list[int]] = {}
            for members in groups.values():
                for i in members if len(members) > 1 else ():
                    runs.setdefault(int(owner[i]), []).extend((int(low[i] - chunk.starts[owner[i]]), int(high[i] - chunk.starts[owner[i]])))
            of = np.array(list(runs), np.int64)
            k = len(of)
            columns = [pa.array(chunk.ids[of]), pa.array(chunk.rows[of]), pa.nulls(k, pa.int64()), *[pa.nulls(k, pa.int32())] * 2, pa.nulls(k, pa.binary()), pa.nulls(k, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([np.array(r, "<u4").tobytes() for r in runs.values()], pa.binary())], names)

    def sort_group(table: pa.Table) -> pa.Table:
        """Repeats among the contexts of the anchors of a bucket."""
        rows = list(zip(*(table.column(c).to_pylist() for c in ("doc_id", "text_key", "key", "at", "before", "context", "many")), strict=True))
        groups: dict[tuple, dict[tuple, list[int]]] = {}
        for i, (_, _, key, _, before, context, _) in enumerate(rows):
            # hashes may be equal by chance, grams decide
            gram = context[before : before + length // 2]
            groups.setdefault((key, gram), {}).setdefault((before, context), []).append(i)
        marks: dict[tuple[int, int], list[int]] = {}

        def mark(i: int, least: int, most: int) -> None:
            doc, text, _, at, before, context, _ = rows[i]
            least, most = max(least, length - (len(context) - before)), min(most, before)
            if least <= most:
                marks.setdefault((doc, text), []).extend((at - most, at - least))

        for members in groups.values():
            kinds = list(members)
            for kind, same in members.items():
                if len(same) > 1 or rows[same[0]][6]:
                    for i in same:
                        mark(i, 0, length)
            for j, least, most in repeats([c[:b][::-1] for b, c in kinds], [c[b:] for b, c in kinds], length) if len(kinds) > 1 else ():
                for i in members[kinds[j]]:
                    mark(i, least, most)
        keys = list(marks)
        return pa.table(
            {
                "doc_id": pa.array([k[0] for k in keys], pa.int64()),
                "text_key": pa.array([k[1] for k in keys], pa.int64()),
                "marks": pa.array([np.array(m, "<u4").tobytes() for m in marks.values()], pa.binary()),
            }
        )

    found = docs.mapInArrow(anchors, DEALT).groupBy("bucket").applyInArrow(shared, BACK)
    candidates = found.groupBy("chunk").applyInArrow(placed, MARKED).dropDuplicates(["doc_id", "text_key"])
    texts = docs.join(candidates, same_row(docs, candidates)).select(docs["doc_id"], docs["text_key"], "text", "marks")
    kinds = "doc_id long, text_key long, key long, at int, before int, context binary, many boolean, marks binary"
    gathered = materialize(texts.mapInArrow(contexts, kinds), "contexts")
    settled = gathered.where("marks IS NOT NULL").select("doc_id", "text_key", "marks")
    open_rows = gathered.where("marks IS NULL").drop("marks")
    large = materialize(open_rows.groupBy("key").count().where(F.col("count") > GROUP).select("key"), "large")
    small = open_rows.join(large, "key", "left_anti").withColumn("bucket", F.pmod("key", F.lit(8 * buckets)))
    sorted_rows = small.groupBy("bucket").applyInArrow(sort_group, MARKED)

    # the strings of large groups, one by one
    first = F.explode(F.sequence(F.lit(0), F.octet_length("context") - length))
    strings = open_rows.join(large, "key", "left_semi").select("doc_id", "text_key", (F.col("at") - F.col("before")).alias("from"), "many", "context", first.alias("step"))
    string = F.substring("context", F.col("step") + 1, F.lit(length))
    strings = strings.select("doc_id", "text_key", (F.col("from") + F.col("step")).alias("start"), F.sha2(string, 256).alias("name"), F.when(F.col("many"), 2).otherwise(1).alias("times"))
    again = strings.groupBy("name").agg(F.sum("times").alias("n")).where("n > 1").select("name")
    place = F.unhex(F.concat(*[F.lpad(F.hex(F.shiftright("start", s).bitwiseAND(F.lit(255))), 2, "0") for s in (0, 8, 16, 24)]))
    one_by_one = strings.join(again, "name").select("doc_id", "text_key", F.concat(place, place).alias("marks"))
    return settled.unionByName(sorted_rows).unionByName(one_by_one)


def remove_repeats(docs: DataFrame, length: int = 400, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (removed runs: start, end), kept (bytes), kept_text and the columns to keep of every row.

    kept_text is kept without what is left of characters that were cut.
    """
    docs = pick(docs, keep, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    docs = docs.select(F.col("doc_id").alias("id"), text_key(), "text", *keep).withColumn("doc_id", F.coalesce("id", "text_key"))
    inner = docs.select("doc_id", "text_key", "text")
    # of a row: as many runs as its text has
    marks = repeated(inner, length).groupBy("doc_id", "text_key").agg(F.collect_set("marks").alias("marks"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, kept, gone = [], [], []
            texts = raw_texts(batch.column("text"))
            for text, mark in zip(texts, batch.column("marks").to_pylist(), strict=True):
                runs = np.frombuffer(b"".join(mark or []), "<u4").reshape(-1, 2).astype(np.int64)
                change = np.bincount(runs[:, 0], minlength=len(text) + 1) - np.bincount(runs[:, 1] + 1, minlength=len(text) + 1)
                off = covered(np.flatnonzero(np.cumsum(change)[: len(text)] > 0), length, len(text))
                edges = np.flatnonzero(np.diff(np.r_[False, off, False]))
                spans.append([{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)])
                gone.append(int(off.sum()))
                kept.append(np.frombuffer(text, np.uint8)[~off].tobytes())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            sizes = pa.array([len(t) for t in texts], pa.int64())
            columns = [batch.column("id"), sizes, pa.array(gone, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())]
            columns += [pa.array([k.decode(errors="ignore") for k in kept], pa.string()), *[batch.column(c) for c in keep]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "spans", "kept", "kept_text", *keep])

    rows = docs.join(marks, same_row(docs, marks), "left").select("id", "text", "marks", *keep)
    schema = "doc_id long, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary, kept_text string"
    return rows.mapInArrow(cut, ", ".join([schema, *[typed(docs, c) for c in keep]]))
