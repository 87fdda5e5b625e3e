"""Word passages that an earlier document has, found by recompression (operator 4).

The words of all documents are named by hashes of their content, and rounds
name what stands side by side: a pair whose first symbol is in the left and
whose second is in the right half of all symbols becomes one symbol, and so
does a run of equal symbols. Which half a symbol is in, and the name of a pair
or run, depend on nothing but the symbols, so a round names the whole corpus
alike without any exchange, and equal passages get equal symbols inside. Each
symbol keeps the words that its making depended on. If they lie in a window of
words, the window's copies have that symbol in that place.

1. Documents are recompressed where they are read. Every symbol is sent once
   for each chunk of documents to a bucket of its name, with the smallest
   document of the chunk that has it.
2. A bucket finds the symbols that only one document has. A window that must
   contain such a symbol is no repeat. This leaves little more than the repeats
   and what they repeat.
3. The windows left are named by their words (80 bits of two hashes and the bucket)
   and compared in the same way; again a chunk sends a name once.
4. Covered words are removed.

Equal names within a chunk are settled there, so a passage that a third of all
documents have reaches a bucket once for each chunk, not for each document.

Null texts have no words. Rows with a null doc_id neither have nor are earlier
documents and stay whole. Rows that share a doc_id are not earlier than each
other; repeated rows give repeated results. An empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import chunks, mixed, offsets, pick, ragged, same_row, shuffle_partitions, text_key

#: Rounds of recompression: pairs or runs. More rounds give fewer symbols but leave more windows to compare.
ROUNDS = ("runs", "pairs", "pairs", "pairs")
FAR = 1 << 40
STEP = np.uint64(0x9E3779B97F4A7C15)

SYMBOL = np.dtype([("key", "<u4"), ("at", "<u4"), ("wide", "<u2")])
WINDOW = np.dtype([("key", "<u8"), ("more", "<u2"), ("at", "<u4")])
FOUND = np.dtype([("at", "<u4"), ("wide", "<u2")])
#: settled: entries that need no comparison any more
DEALT = "bucket int, chunk binary, owners binary, rows binary, entries binary, settled boolean"
BACK = "chunk binary, owners binary, rows binary, entries binary"
MARKED = "doc_id long, text_key long, marks binary"


class Chunk:
    """Documents that a task works on at a time, and their words as numbers, one document after the other."""

    def __init__(self, batch: pa.RecordBatch, texts: list[bytes]):
        ids = batch.column("doc_id")
        self.split = [t.split() if i else [] for t, i in zip(texts, ids.is_valid().to_pylist(), strict=True)]
        self.ids = ids.fill_null(0).to_numpy()
        self.rows = batch.column("text_key").to_numpy()
        self.starts = offsets([len(s) for s in self.split])
        coded = pa.array([w for s in self.split for w in s], pa.large_binary()).dictionary_encode()
        named = b"".join(map(xxhash.xxh3_128_digest, coded.dictionary.to_pylist()))
        self.names = np.frombuffer(named, "<u8").reshape(-1, 2)[coded.indices.to_numpy()]
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.starts))
        self.label()

    def label(self) -> None:
        #: the same for the same rows, so that a repeated task gives the same
        self.name = xxhash.xxh3_128_digest(self.ids.tobytes() + self.rows.tobytes() + self.starts.tobytes())
        steps = [np.diff(x, prepend=np.int64(0)) for x in (self.ids, self.starts[1:])]
        self.owners = zlib.compress(np.concatenate(steps).astype("<i8").tobytes(), 1)


def owners(table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """doc_id and the end among the chunk's words, of each document of a chunk."""
    steps = np.frombuffer(zlib.decompress(table), "<i8").reshape(2, -1)
    return np.cumsum(steps[0]), np.cumsum(steps[1])


def recompress(names: np.ndarray, doc: np.ndarray, rounds=ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols with the first word and the word after the last that their making depended on.

    Where it depended on the end of a document, these lie far outside.
    """
    first = np.arange(len(names))
    after = first + 1
    for level, kind in enumerate(rounds):
        if not len(names):
            break
        salt = np.full(1, 2 * level + 1, np.uint64)
        joint = np.r_[doc[1:] == doc[:-1], False]
        before = np.r_[False, joint[:-1]]
        # what a symbol depends on if its left or right neighbour has a say
        reach_left = np.where(before, np.r_[0, first[:-1]], -FAR)
        reach_right = np.where(joint, np.r_[after[1:], 0], FAR)
        if kind == "pairs":
            left = (mixed(names + salt * STEP) & np.uint64(1)).astype(bool)
            opens = np.r_[left[:-1] & ~left[1:] & joint[:-1], False]
            closes = np.r_[False, opens[:-1]]
            low = np.where(~left & ~closes, np.minimum(first, reach_left), first)
            high = np.where(left & ~opens, np.maximum(after, reach_right), after)
            kept, pair = np.flatnonzero(~closes), opens[~closes]
            one = kept[pair]
            names, new = names[kept], mixed(names[one] * STEP + mixed(names[one + 1] + salt))
            names[pair] = new
            low[one] = np.minimum(low[one], low[one + 1])
            high[one] = np.maximum(high[one], high[one + 1])
            doc, first, after = doc[kept], low[kept], high[kept]
        else:
            kept = np.flatnonzero(np.r_[True, (names[1:] != names[:-1]) | ~joint[:-1]])
            times = np.diff(np.r_[kept, len(names)])
            last = kept + times - 1
            low, high = np.minimum.reduceat(first, kept), np.maximum.reduceat(after, kept)
            first, after = np.minimum(low, reach_left[kept]), np.maximum(high, reach_right[last])
            names = np.where(times > 1, mixed(names[kept] * STEP + times.astype(np.uint64) * salt), names[kept])
            doc = doc[kept]
    return names, first, after


def packed(entries: np.ndarray) -> bytes:
    """Entries field by field and byte by byte, places as steps: most bytes but names' are zeros, which shuffles compress."""
    parts = []
    for name in entries.dtype.names or ("at",):
        values = entries[name] if entries.dtype.names else entries
        if name == "at":
            values = np.diff(values, prepend=values.dtype.type(0))
        parts.append(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T.tobytes())
    return b"".join(parts)


def unpacked(blob: bytes, kind: np.dtype) -> np.ndarray:
    n = len(blob) // kind.itemsize
    out, start = np.empty(n, kind), 0
    for name in kind.names or ("at",):
        field = kind[name] if kind.names else kind
        raw = np.frombuffer(blob, np.uint8, n * field.itemsize, start).reshape(field.itemsize, n)
        values = np.ascontiguousarray(raw.T).view(field).reshape(n)
        values = np.cumsum(values, dtype=field) if name == "at" else values
        if kind.names:
            out[name] = values
        else:
            out[:] = values
        start += n * field.itemsize
    return out


def deal(chunk: Chunk, entries: np.ndarray, bucket: np.ndarray, buckets: int, settled: np.ndarray | None = None) -> pa.RecordBatch:
    """A row for each bucket with its entries, and one with those that are settled; at least one row."""
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    sent = entries[order]
    used = np.flatnonzero(np.diff(ends)).tolist()
    blobs = [packed(sent[ends[b] : ends[b + 1]]) for b in used]
    done = [False] * len(used)
    if not used or settled is not None and len(settled):
        used.append(int.from_bytes(chunk.name[:4], "little") % buckets)
        blobs.append(packed(settled) if settled is not None else b"")
        done.append(True)
    n = len(used)
    columns = [
        pa.array(used, pa.int32()),
        pa.array([chunk.name] * n, pa.binary()),
        pa.array([chunk.owners] * n, pa.binary()),
        pa.array([chunk.rows.tobytes()] + [None] * (n - 1), pa.binary()),  # once is enough
        pa.array(blobs, pa.binary()),
        pa.array(done),
    ]
    return pa.RecordBatch.from_arrays(columns, ["bucket", "chunk", "owners", "rows", "entries", "settled"])


def extremes(keys: list[np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the smallest and the largest id of the rows with equal keys."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order[1:]] != k[order[:-1]]
    least, most = np.empty_like(ids), np.empty_like(ids)
    if len(ids):
        starts, group = np.flatnonzero(new), np.cumsum(new) - 1
        least[order] = np.minimum.reduceat(ids[order], starts)[group]
        most[order] = np.maximum.reduceat(ids[order], starts)[group]
    return least, most


def documents(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_id, text_key and end of each document of a chunk."""
    i = next(i for i, r in enumerate(table.column("rows").to_pylist()) if r is not None)
    ids, ends = owners(table.column("owners")[i].as_py())
    return ids, np.frombuffer(table.column("rows")[i].as_py(), "<i8"), ends


def by_document(ids, rows, ends, at: np.ndarray) -> pa.Table:
    """Places in a chunk as places in its documents (32-bit)."""
    owner = np.searchsorted(ends, at, side="right")
    local = (at - np.r_[0, ends[:-1]][owner]).astype("<u4")
    cuts = np.flatnonzero(np.diff(owner)) + 1
    used = owner[np.r_[0, cuts]] if len(owner) else owner
    marks = [x.tobytes() for x in np.split(local, cuts)] if len(owner) else []
    return pa.table({"doc_id": pa.array(ids[used]), "text_key": pa.array(rows[used]), "marks": pa.array(marks, pa.binary())})


def from_smaller(docs: DataFrame, window: int) -> DataFrame:
    """doc_id, text_key and marks (first words, 32-bit) of windows that start in a smaller document too.

    docs has doc_id, text_key and text.
    """
    buckets = shuffle_partitions(docs.sparkSession)

    def symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            chunk = Chunk(batch, texts)
            names, first, after = recompress(chunk.names[:, 0], chunk.doc)
            useful = np.flatnonzero(after - first <= window)
            names, first, wide = names[useful], first[useful], (after - first)[useful]
            ids = chunk.ids[chunk.doc[first]]
            least, most = extremes([names], ids)
            sent = ids == least
            names, first = names[sent], first[sent]
            entries = np.empty(len(names), SYMBOL)
            entries["key"], entries["at"] = names & np.uint64(0xFFFFFFFF), first
            # no width: several documents of the chunk have it
            entries["wide"] = np.where(least == most, wide, 0)[sent]
            yield deal(chunk, entries, ((names >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), buckets)

    def settle(table: pa.Table, kind: np.dtype, repeats: bool) -> pa.Table:
        """Of a bucket's entries, those whose name a smaller document has, or those whose name no other has."""
        blobs, settled = table.column("entries").to_pylist(), table.column("settled").to_pylist()
        parts = [unpacked(b"" if s else b, kind) for b, s in zip(blobs, settled, strict=True)]
        entries = np.concatenate(parts)
        having = []
        for part, owned in zip(parts, table.column("owners").to_pylist(), strict=True):
            ids, ends = owners(owned)
            having.append(ids[np.searchsorted(ends, part["at"], side="right")])
        ids = np.concatenate(having)
        if repeats:
            wanted = ids > extremes([entries["key"], entries["more"]], ids)[0]
        else:
            least, _ = extremes([entries["key"]], ids)
            _, most = extremes([entries["key"]], np.where(entries["wide"] == 0, np.iinfo(np.int64).max, ids))
            wanted = (least == most) & (entries["wide"] > 0)
        found = []
        for blob, s, part, mine in zip(blobs, settled, parts, np.split(wanted, offsets([len(p) for p in parts])[1:-1]), strict=True):
            out = np.zeros(int(mine.sum()), FOUND)
            out["at"] = part["at"][mine]
            if not repeats:
                out["wide"] = part["wide"][mine]
            found.append(blob if s else packed(out))
        used = [o if r is not None else None for o, r in zip(table.column("owners").to_pylist(), table.column("rows").to_pylist(), strict=True)]
        columns = [table.column("chunk"), pa.array(used, pa.binary()), table.column("rows"), pa.array(found, pa.binary())]
        return pa.table(columns, ["chunk", "owners", "rows", "entries"])

    def possible(table: pa.Table) -> pa.Table:
        """Of a chunk's windows, those that contain no symbol of their own, by document."""
        ids, rows, ends = documents(table)
        unique = np.concatenate([unpacked(b, FOUND) for b in table.column("entries").to_pylist()])
        total = int(ends[-1]) if len(ends) else 0
        # windows from (end of the symbol - window) to its first word
        low = np.maximum(unique["at"].astype(np.int64) + unique["wide"] - window, 0)
        dead = np.cumsum(np.bincount(low, minlength=total + 1) - np.bincount(unique["at"] + np.int64(1), minlength=total + 1)[: total + 1])
        starts = np.r_[0, ends[:-1]].astype(np.int64)
        room = np.arange(total) + window <= np.repeat(ends, ends - starts)
        alive = np.flatnonzero((dead[:total] == 0) & room)
        return by_document(ids, rows, ends, alive)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            chunk = Chunk(batch, texts)
            marks = [np.frombuffer(m, "<u4") for m in batch.column("marks").to_pylist()]
            at = np.concatenate(marks).astype(np.int64) + np.repeat(chunk.starts[:-1], [len(m) for m in marks])
            key, more = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
            for i in range(window):
                key = mixed(key * STEP + chunk.names[at + i, 0])
                more = mixed(more * STEP + chunk.names[at + i, 1])
            ids = chunk.ids[chunk.doc[at]]
            sent = ids == extremes([key, more], ids)[0]
            entries = np.empty(int(sent.sum()), WINDOW)
            entries["key"], entries["more"], entries["at"] = key[sent], more[sent] & np.uint64(0xFFFF), at[sent]
            # a smaller document of the same chunk has the others
            settled = np.zeros(int((~sent).sum()), FOUND)
            settled["at"] = at[~sent]
            bucket = ((more[sent] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            yield deal(chunk, entries, bucket, buckets, settled)

    def repeats(table: pa.Table) -> pa.Table:
        ids, rows, ends = documents(table)
        at = np.concatenate([unpacked(b, FOUND)["at"] for b in table.column("entries").to_pylist()])
        return by_document(ids, rows, ends, np.unique(at).astype(np.int64))

    named = docs.mapInArrow(symbols, DEALT)
    own = named.groupBy("bucket").applyInArrow(lambda t: settle(t, SYMBOL, False), BACK)
    candidates = own.groupBy("chunk").applyInArrow(possible, MARKED).dropDuplicates(["doc_id", "text_key"])
    texts = docs.join(candidates, same_row(docs, candidates)).select(docs["doc_id"], docs["text_key"], "text", "marks")
    # in order, so that a task that is repeated after a loss makes the same chunks
    texts = texts.sortWithinPartitions("doc_id", "text_key")
    compared = texts.mapInArrow(windows, DEALT).groupBy("bucket").applyInArrow(lambda t: settle(t, WINDOW, True), BACK)
    return compared.groupBy("chunk").applyInArrow(repeats, MARKED)


def covered(starts: np.ndarray, length: int, total: int) -> np.ndarray:
    """Which of total places lie in one of some stretches of a length."""
    change = np.bincount(starts, minlength=total + 1) - np.bincount(starts + length, minlength=total + 1)[: total + 1]
    return np.cumsum(change)[:total] > 0


def remove_repeats(docs: DataFrame, window: int = 13) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words left, joined by blanks) of every row."""
    docs = pick(docs, doc_id="long", text="string").select("doc_id", text_key(), "text")
    marks = from_smaller(docs, window).dropDuplicates(["doc_id", "text_key"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            words, gone, kept = [], [], []
            for text, mark in zip(texts, batch.column("marks").to_pylist(), strict=True):
                split = text.split()
                words.append(len(split))
                if mark is None:
                    gone.append(0)
                else:
                    off = covered(np.frombuffer(mark, "<u4").astype(np.int64), window, len(split))
                    gone.append(int(off.sum()))
                    split = [split[i] for i in np.flatnonzero(~off)]
                kept.append(b" ".join(split))
            columns = [batch.column("doc_id"), pa.array(words, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept"])

    rows = docs.join(marks, same_row(docs, marks), "left").select(docs["doc_id"], "text", "marks")
    return rows.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string")
