"""BPE encoding and decoding by tree concatenation (operator 6).

A text is encoded as the tokenizers library encodes it. Words between ASCII
white space never share a token, so a task encodes each distinct word once.
Text that white space does not split, and documents that are too long for one
piece of work, are cut into pieces that are encoded on their own, the pieces
of a document in different tasks. Neighbours are then put together in a tree:
a window around the join is encoded again and grows until it agrees exactly,
on either side, with a token that is already there.

Why agreement on one token is enough: a sequence of tokens is what BPE gives
for its text just when BPE gives each two neighbours for the text of these
two. The window's tokens are such a sequence, the tokens left and right of it
are, and the agreed tokens stand in both.

Null text is empty and has no tokens. Repeated rows give repeated results;
doc_id may be null or repeated. An empty table gives an empty table.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import chunks, offsets, pick, ragged, shuffle_partitions, text_key

#: Longer documents are encoded in pieces of so many characters.
PIECE_CHARS = 1 << 16
#: Longer words are encoded in halves.
LEAF_CHARS = 1 << 12
#: Words whose tokens a task remembers.
MEMO_WORDS = 600_000
#: Bytes of text that a task encodes at a time.
CHUNK_BYTES = 6 << 20

WORD = re.compile(r"[^\x20\x09-\x0D]+")

Encoded = tuple[np.ndarray, np.ndarray, np.ndarray]  # ids, first character, character after the last


class Encoder:
    """One tokenizer file in a task."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.margin = 1 + max((len(t.content) for t in added), default=0)
        self.added = [t.content.encode() for t in added]
        steps = json.loads(self.tokenizer.to_str())["normalizer"] or {}
        steps = steps.get("normalizers", [steps] * bool(steps))
        self.lowers = any(n["type"] == "Lowercase" for n in steps)
        blank = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
        self.keeps_ascii = all(n["type"] in ("NFC", "NFD", "NFKC", "NFKD", "Lowercase") or n == blank for n in steps)
        self.tokens = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        # in a byte-level vocabulary a character stands for a byte
        self.sizes = np.array([len(t.removesuffix("</w>")) for t in self.tokens])
        self.words = pa.array([], pa.large_string())
        self.flat, self.lengths, self.met = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def forget(self) -> None:
        """Keep what was met more than once since the last time."""
        kept = np.flatnonzero(self.met > 1)
        self.words = self.words.take(pa.array(kept))
        self.flat = self.flat[ragged(offsets(self.lengths)[:-1][kept], self.lengths[kept])]
        self.lengths, self.met = self.lengths[kept], np.zeros(len(kept), np.int64)

    def spans(self, text: str) -> Encoded:
        got = self.tokenizer.encode(text, add_special_tokens=False)
        at = np.array(got.offsets, np.int64).reshape(-1, 2)
        return np.array(got.ids, np.uint32), at[:, 0], at[:, 1]

    def located(self, text: str) -> Encoded:
        """As spans; the tokens of a short word all have the place of the word, so that only its ends are known."""
        words = [(m[0], *m.span()) for m in WORD.finditer(text)]
        ids, at = self.texts([w.encode() for w, _, _ in words])
        sizes = np.diff(at)
        first, after = (np.repeat(np.array([w[i] for w in words], np.int64), sizes) for i in (1, 2))
        for i, (word, start, _) in enumerate(words):
            if len(word) > LEAF_CHARS:
                _, *places = self.tree(word)
                first[at[i] : at[i + 1]], after[at[i] : at[i + 1]] = (p + start for p in places)
        return ids, first, after

    def tree(self, text: str, leaf: int = LEAF_CHARS) -> Encoded:
        if len(text) <= leaf:
            return self.spans(text)
        cut = len(text) // 2
        return self.join(text, cut, self.tree(text[:cut], leaf), self.tree(text[cut:], leaf))

    def join(self, text: str, cut: int, left: Encoded, right: Encoded) -> Encoded:
        """Tokens of a text from those of its parts before and after cut."""
        ids, first, after = left
        r_ids, r_first, r_after = right[0], right[1] + cut, right[2] + cut
        # places between two tokens that are also places between two characters
        l_ok = np.flatnonzero(np.r_[True, first[1:] >= after[:-1]] if len(ids) else [])
        r_ok = np.flatnonzero(np.r_[r_after[:-1] <= r_first[1:], True] if len(r_ids) else [])
        grow = self.margin + 16
        while True:
            near = l_ok[first[l_ok] <= cut - grow]
            far = r_ok[r_after[r_ok] >= cut + grow]
            a = near[-1] if len(near) else -1
            b = far[0] if len(far) else len(r_ids)
            start = first[a] if a >= 0 else 0
            # the window reaches further than the token it has to agree on: its own last token is cut off
            reach = r_after[far[0]] + grow if len(far) else len(text)
            stop = int(reach) if reach < len(text) else len(text)
            w_ids, w_first, w_after = self.spans(text[start:stop])
            w_first, w_after = w_first + start, w_after + start
            # a token and one of its ends tell the other end
            left_agrees = a < 0 or len(w_ids) and w_ids[0] == ids[a] and w_first[0] == first[a]
            end = len(w_ids)
            right_agrees = b == len(r_ids)
            if not right_agrees:
                hit = np.flatnonzero((w_ids == r_ids[b]) & (w_after == r_after[b]))
                right_agrees = bool(len(hit)) and (hit[-1] + 1 == len(w_ids) or w_first[hit[-1] + 1] >= w_after[hit[-1]])
                end = hit[-1] + 1 if right_agrees else end
            if left_agrees and right_agrees:
                a = max(a, 0)
                keep = slice(b + 1, None)
                return (
                    np.r_[ids[:a], w_ids[:end], r_ids[keep]],
                    np.r_[first[:a], w_first[:end], r_first[keep]],
                    np.r_[after[:a], w_after[:end], r_after[keep]],
                )
            grow *= 2

    def distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of words one after the other, and how many each has.

        All words are encoded as one text with blanks between them. That a word's
        tokens are as long together as the word tells where they end; where it
        doesn't hold, as for words that normalizing lengthens, words are encoded
        one by one.
        """
        text = " ".join(words.to_pylist())
        blanks = lambda x: np.flatnonzero(np.frombuffer(x.encode(), np.uint8) == 32)
        alike = self.keeps_ascii and text.isascii()
        if not alike and (normal := self.tokenizer.normalizer) is not None:
            alike = np.array_equal(blanks(normal.normalize_str(text)), blanks(text))
        got = self.tokenizer.encode_batch_fast([text] if alike else [], add_special_tokens=False)
        ids = np.array(got[0].ids if alike else [], np.uint32)
        reached, ends = np.cumsum(self.sizes[ids]), np.cumsum(pc.binary_length(words).to_numpy())
        at = np.searchsorted(reached, ends)
        if len(ids) and at[-1] == len(ids) - 1 and (reached[at] == ends).all():
            return ids, np.diff(at + 1, prepend=0)
        each = self.tokenizer.encode_batch_fast(words.to_pylist(), add_special_tokens=False)
        each = [np.array(e.ids, np.uint32) for e in each]
        return np.concatenate(each), np.array([len(e) for e in each])

    def learn(self, words: pa.Array) -> None:
        """Remember the tokens of words; long ones are encoded in halves."""
        length, plain = pc.binary_length(words).to_numpy(), pc.string_is_ascii(words).to_numpy(zero_copy_only=False)
        short = (length > 0) & (length <= LEAF_CHARS)
        groups = [np.flatnonzero(short & plain), np.flatnonzero(short & ~plain)]
        got = [self.distinct(words.take(pa.array(g))) for g in groups if len(g)]
        for i in np.flatnonzero(length > LEAF_CHARS):
            ids = self.tree(words[i].as_py())[0]
            got.append((ids, np.array([len(ids)])))
            groups.append([i])
        order = np.concatenate(groups).astype(np.int64)
        sizes, starts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        if got:
            sizes[order] = np.concatenate([n for _, n in got])
            starts[order] = offsets(sizes[order])[:-1]
            self.flat = np.concatenate([self.flat, np.concatenate([ids for ids, _ in got])[ragged(starts, sizes)]])
        self.words = pa.concat_arrays([self.words, words])
        self.lengths = np.concatenate([self.lengths, sizes])
        self.met = np.concatenate([self.met, np.zeros(len(words), np.int64)])

    def split(self, texts: list[bytes]) -> pa.Array:
        """Words between ASCII white space, with an empty word between two neighbours of it.

        In lower case, where that changes no token and makes no added token.
        """
        raw = np.frombuffer(b"".join(texts), np.uint8).copy()
        if self.lowers:
            low = raw + np.where((raw >= 65) & (raw <= 90), np.uint8(32), np.uint8(0))
            whole = low.tobytes()
            if not any(a.lower() in whole for a in self.added):
                raw = low
        raw[(raw >= 9) & (raw <= 13)] = 32
        places = offsets([len(t) for t in texts])
        return pc.split_pattern(pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(places), pa.py_buffer(raw)), " ")

    def texts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of texts one after the other, and where each text begins."""
        split = self.split(texts)
        at = split.offsets.to_numpy().astype(np.int64)
        at -= at[0]
        coded = split.flatten().dictionary_encode()
        slots = pc.fill_null(pc.index_in(coded.dictionary, value_set=self.words), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(slots < 0)
        if len(new):
            if len(self.words) + len(new) > MEMO_WORDS and len(self.words):
                self.forget()
                return self.texts(texts)
            slots[new] = len(self.words) + np.arange(len(new))
            self.learn(coded.dictionary.take(pa.array(new)))
        slots = slots[coded.indices.to_numpy()]
        self.met += np.bincount(slots, minlength=len(self.met))
        lengths = self.lengths[slots]
        ids = self.flat[ragged(offsets(self.lengths)[:-1][slots], lengths)]
        return ids, offsets(lengths)[at]

    def decode(self, ids: np.ndarray) -> str:
        """The library's decode without skipping special tokens, for files without a decoder."""
        if self.tokenizer.decoder is not None:
            return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


def encoder(path: str) -> Encoder:
    """One for each process that runs tasks.

    Functions travel to tasks by value, so that a variable of this module would
    be new in each task; the library's module stays.
    """
    import tokenizers

    held = tokenizers.__dict__.setdefault("held_encoders", {})
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


def encode(docs: DataFrame, path: str, decode: bool = False, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit) and, if wanted, decoded text per row.

    path is a tokenizer file that every executor has. Documents of up to
    piece_chars characters are encoded where they are read; longer ones are cut
    into pieces that are dealt over the tasks.
    """
    docs = pick(docs, doc_id="long", text="string")
    schema = "doc_id long, ids binary" + ", decoded string" * decode
    long = F.length("text") > piece_chars

    def finished(coder: Encoder, doc_ids, each: list[np.ndarray]) -> pa.RecordBatch:
        columns = [doc_ids, pa.array([x.astype("<u4").tobytes() for x in each], pa.binary())]
        names = ["doc_id", "ids"]
        if decode:
            columns.append(pa.array([coder.decode(x) for x in each], pa.string()))
            names.append("decoded")
        return pa.RecordBatch.from_arrays(columns, names)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch, texts in chunks(batches, CHUNK_BYTES):
            ids, at = coder.texts(texts)
            yield finished(coder, batch.column("doc_id"), np.split(ids, at[1:-1]))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            got = [coder.located(t) for t in batch.column("text").to_pylist()]
            parts = [pa.array([x[i].astype(t).tobytes() for x in got], pa.binary()) for i, t in enumerate(("<u4", "<i4", "<i4"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *parts], [*batch.schema.names, "ids", "first", "after"])

    def joined(table: pa.Table) -> pa.Table:
        coder = encoder(path)
        table = table.sort_by("piece")
        numbers = table.column("piece").to_pylist()
        copies = numbers.count(0)
        rows = table.take(list(range(0, len(numbers), copies)))  # equal rows have brought equal pieces
        parts = []
        for text, *blobs in zip(*(rows.column(c).to_pylist() for c in ("text", "ids", "first", "after")), strict=True):
            found = [np.frombuffer(b, t) for b, t in zip(blobs, ("<u4", "<i4", "<i4"), strict=True)]
            parts.append((text, tuple(x.astype(np.int64) if i else x for i, x in enumerate(found))))
        while len(parts) > 1:
            pairs = [
                (a[0] + b[0], coder.join(a[0] + b[0], len(a[0]), a[1], b[1]))
                for a, b in zip(parts[::2], parts[1::2], strict=False)
            ]
            parts = pairs + parts[len(pairs) * 2 :]
        ids = parts[0][1][0]
        doc_ids = table.column("doc_id").slice(0, 1).to_pylist() * copies
        return pa.Table.from_batches([finished(coder, pa.array(doc_ids, pa.int64()), [ids] * copies)])

    short = docs.where(~F.coalesce(long, F.lit(False))).mapInArrow(whole, schema)
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, key, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_key", "text")), strict=True):
                parts = [text[i : i + piece_chars] for i in range(0, len(text), piece_chars)]
                columns = [pa.array([doc_id] * len(parts), pa.int64()), pa.array([key] * len(parts), pa.int64())]
                columns += [pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "piece", "text"])

    dealt = docs.where(long).select("doc_id", text_key(), "text").mapInArrow(cut, "doc_id long, text_key long, piece int, text string")
    # with a given number, as adaptive execution would put the few pieces back into one task
    dealt = dealt.repartition(shuffle_partitions(docs.sparkSession), "doc_id", "text_key", "piece")
    done = dealt.mapInArrow(pieces, "doc_id long, text_key long, piece int, text string, ids binary, first binary, after binary")
    return short.unionByName(done.groupBy("doc_id", "text_key").applyInArrow(joined, schema))
