"""Document quality by attention-based multiple-instance learning (operator 8).

A document is a bag of passages of PASSAGE bytes. A passage is described by how
often its kinds of characters follow each other and by a few shares; a layer
encodes it, gated attention weighs the encoded passages against each other, and
the weighted mean is classified. Only documents have labels; what to look at is
learned from them.

The classifier is fitted in numpy on a bounded sample: at most SAMPLE labelled
documents, those with the smallest hash of doc_id, each with all of its
passages. Where documents are long, fewer are taken: no further one after those
taken have SAMPLE_PASSAGES passages together. Everything else is a pass over
the rows.

Null texts are empty; an empty text has one empty passage and gets a score like
any other. Labels without doc_id or value are left out, of several labels of a
document the largest counts. Rows that share a doc_id are scored each by its own
text. Without any label every score is 0.5. An empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import chunks, give_back, give_back_driver, offsets, pick, ragged, typed

PASSAGE = 512
#: Bytes of text described at a time; each takes about 80 bytes meanwhile.
CHUNK_BYTES = 1 << 20
SAMPLE = 6000
#: Passages of all sampled documents together, about 200 MB; the last document may exceed it.
SAMPLE_PASSAGES = 192_000

#: Kind of each byte: small and capital letter, digit, blank, line end, other control, bytes of
#: characters beyond ASCII (first, further), then . , | and four groups of marks, and the rest.
KINDS = 16
_KIND = np.full(256, 15, np.uint8)
_KIND[ord("a") : ord("z") + 1] = 0
_KIND[ord("A") : ord("Z") + 1] = 1
_KIND[ord("0") : ord("9") + 1] = 2
_KIND[32], _KIND[10] = 3, 4
_KIND[[*range(10), *range(11, 32), 127]] = 5
_KIND[192:], _KIND[128:192] = 6, 7
for _i, _marks in enumerate((".", ",", "|", "%&$#*@^~", "!?;:", "()[]{}<>", "\"'-_/")):
    _KIND[[ord(m) for m in _marks]] = 8 + _i
EXTRAS = 7
_SPREAD = np.random.default_rng(3).integers(1, 1 << 60, 256).astype(np.uint64)
FEATURES = KINDS * KINDS + EXTRAS


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One row for each passage, and the number of passages of each text."""
    length = np.array([len(t) for t in texts], np.int64)
    passages = np.maximum(1, -(-length // PASSAGE))
    first = np.cumsum(passages) - passages
    raw = np.frombuffer(b"".join(texts), np.uint8)
    start = np.cumsum(length) - length
    within = np.arange(len(raw)) - np.repeat(start, length)
    passage = np.repeat(first, length) + within // PASSAGE
    total = int(passages.sum())
    kind = _KIND[raw]
    size = np.bincount(passage, minlength=total)
    same = passage[1:] == passage[:-1]
    code = passage[1:][same] * (KINDS * KINDS) + kind[:-1][same].astype(np.int64) * KINDS + kind[1:][same]
    pairs = np.bincount(code, minlength=total * KINDS * KINDS).reshape(total, -1) / np.maximum(size - 1, 1)[:, None]
    blank = (kind >= 3) & (kind <= 5)
    begins = ~blank & np.r_[True, blank[:-1] | (within[1:] == 0)] if len(raw) else blank
    words = np.bincount(passage[begins], minlength=total)
    solid = np.bincount(passage[~blank], minlength=total)
    again = np.bincount(passage[1:][same & (raw[1:] == raw[:-1])], minlength=total)
    # a byte that stands again 2 to 64 places before it in much of the passage: lines or words repeated
    seen = np.zeros(total)
    for step in (8, 16, 32, 64):
        hit = (raw[step:] == raw[:-step]) & (passage[step:] == passage[:-step])
        seen = np.maximum(seen, np.bincount(passage[step:][hit], minlength=total))
    # words that stand twice in a row
    at = np.flatnonzero(begins)
    sums = np.add.reduceat(np.where(blank, np.uint64(0), _SPREAD[raw]), at) if len(at) else at
    twice = passage[at[1:]][(sums[1:] == sums[:-1]) & (passage[at[1:]] == passage[at[:-1]])]
    twice = np.bincount(twice, minlength=total) / np.maximum(words, 1)
    kinds_of_bytes = np.bincount(np.unique(passage * 256 + raw) // 256, minlength=total)
    least = np.maximum(size, 1)
    extras = [size / PASSAGE, words / least, solid / np.maximum(words, 1) / 10, again / least, seen / least, kinds_of_bytes / 64, twice]
    return np.column_stack([np.sqrt(pairs), *extras]).astype(np.float32), passages


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Bags:
    """Passages of documents, one document after the other, for sums over each."""

    def __init__(self, passages: np.ndarray):
        self.starts = np.cumsum(passages) - passages
        self.owner = np.repeat(np.arange(len(passages)), passages)

    def sums(self, x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(x, self.starts, axis=0)

    def softmax(self, x: np.ndarray) -> np.ndarray:
        e = np.exp(x - np.maximum.reduceat(x, self.starts)[self.owner])
        return e / self.sums(e)[self.owner]


class Model:
    """Gated attention over encoded passages."""

    def __init__(self, mean, scale, hidden: int = 32, gate: int = 16, seed: int = 1):
        rng = np.random.default_rng(seed)
        normal = lambda *shape: rng.normal(0, shape[0] ** -0.5, shape).astype(np.float32)
        self.mean, self.scale = mean, scale
        self.p = {
            "encode": normal(len(mean), hidden),
            "shift": np.zeros(hidden, np.float32),
            "look": normal(hidden, gate),
            "gate": normal(hidden, gate),
            "weigh": normal(gate),
            "class": normal(hidden),
            "bias": np.zeros(1, np.float32),
        }

    def forward(self, x, bags: Bags):
        p = self.p
        h = np.tanh(x @ p["encode"] + p["shift"])
        look, gate = np.tanh(h @ p["look"]), sigmoid(h @ p["gate"])
        a = bags.softmax(look * gate @ p["weigh"])
        z = bags.sums(a[:, None] * h)
        return h, look, gate, a, z, z @ p["class"] + p["bias"][0]

    def scores(self, x, passages) -> np.ndarray:
        return sigmoid(self.forward(self.scaled(x), Bags(passages))[-1])

    def scaled(self, x) -> np.ndarray:
        return (x - self.mean) / self.scale

    def gradients(self, x, bags: Bags, labels) -> dict[str, np.ndarray]:
        p = self.p
        h, look, gate, a, z, y = self.forward(x, bags)
        dy = (sigmoid(y) - labels) / len(labels)
        dz = np.outer(dy, p["class"])[bags.owner]
        da = (h * dz).sum(1)
        dl = a * (da - bags.sums(a * da)[bags.owner])
        dg = np.outer(dl, p["weigh"])
        dlook, dgate = dg * gate * (1 - look**2), dg * look * gate * (1 - gate)
        dh = (a[:, None] * dz + dlook @ p["look"].T + dgate @ p["gate"].T) * (1 - h**2)
        return {
            "encode": x.T @ dh,
            "shift": dh.sum(0),
            "look": h.T @ dlook,
            "gate": h.T @ dgate,
            "weigh": (look * gate).T @ dl,
            "class": z.T @ dy,
            "bias": dy.sum(keepdims=True),
        }


def fit(x: np.ndarray, passages: np.ndarray, labels: np.ndarray, epochs: int = 40, batch: int = 128, rate: float = 3e-3) -> Model:
    """Adam on shuffled batches of documents, with a little weight decay; x is scaled in place."""
    mean = x.mean(0)
    spread = np.sqrt(sum(((x[i : i + 8192] - mean) ** 2).sum(0, dtype=np.float64) for i in range(0, len(x), 8192)) / len(x))
    model = Model(mean, spread.astype(np.float32) + np.float32(1e-3))
    labels = labels.astype(np.float32)
    for i in range(0, len(x), 8192):  # in place
        x[i : i + 8192] = model.scaled(x[i : i + 8192])
    starts = np.cumsum(passages) - passages
    rng = np.random.default_rng(2)
    first, second = ({k: np.zeros_like(v) for k, v in model.p.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        now = rate * (1 - epoch / epochs)
        order = rng.permutation(len(labels))
        for at in range(0, len(order), batch):
            docs = order[at : at + batch]
            grads = model.gradients(x[ragged(starts[docs], passages[docs])], Bags(passages[docs]), labels[docs])
            step += 1
            for k, g in grads.items():
                g = g + 1e-4 * model.p[k]
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                model.p[k] -= now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model of labels (doc_id, label) of documents (doc_id, text), fitted on the driver."""
    labels = pick(labels, doc_id="long", label="double").dropna()
    labels = labels.groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    found = pick(docs, doc_id="long", text="string").join(F.broadcast(chosen), "doc_id")  # at most sample rows
    found = found.withColumn("place", F.struct(F.xxhash64("doc_id").alias("hash"), "doc_id", F.xxhash64("text").alias("text_key")))
    passages = F.greatest(F.lit(1), F.ceil(F.octet_length("text") / PASSAGE))
    # rows that share a doc_id could be more than the sample
    sizes = found.select("place", passages.alias("passages")).orderBy("place").limit(sample).collect()
    if not sizes:
        return None
    before = offsets([r.passages for r in sizes])[:-1]
    taken = int((before < SAMPLE_PASSAGES).sum())
    last = sizes[taken - 1].place

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, CHUNK_BYTES):
            x, passages = features(texts)
            cut = np.split(x, np.cumsum(passages)[:-1])
            # most of a passage's pairs of kinds never occur: deflated, a fraction of it comes to the driver
            bags = pa.array([zlib.compress(c.tobytes(), 1) for c in cut], pa.binary())
            columns = [batch.column("place"), batch.column("label"), pa.array(passages), bags]
            yield pa.RecordBatch.from_arrays(columns, ["place", "label", "passages", "x"])

    within = F.col("place") <= F.struct(*[F.lit(v).cast("long").alias(k) for k, v in last.asDict().items()])
    rows = found.where(within).select("text", "place", "label").mapInArrow(described, typed(found, "place", "label") + ", passages long, x binary")
    rows = rows.orderBy("place").limit(taken).toArrow()
    wanted = rows.column("label").to_numpy()
    bags = rows.column("x")
    counts = rows.column("passages").to_numpy()
    del rows
    ends = offsets(counts)
    x = np.empty((ends[-1], FEATURES), np.float32)
    # one array, filled bag by bag: no second copy is held beside the table
    for i, bag in enumerate(bags):
        x[ends[i] : ends[i + 1]] = np.frombuffer(zlib.decompress(bag.as_buffer()), np.float32).reshape(-1, FEATURES)
    del bags, bag
    give_back_driver(docs.sparkSession)  # of the rows that were collected
    model = fit(x, counts, wanted)
    del x
    give_back()
    return model


def score(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text, the columns to keep and score of every row."""
    docs = pick(docs, keep, doc_id="long", text="string")
    if model is None:
        return docs.withColumn("score", F.lit(0.5))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, CHUNK_BYTES):
            got = model.scores(*features(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.float64())], [*batch.schema.names, "score"])

    return docs.mapInArrow(scored, typed(docs, *docs.columns) + ", score double")


def part(parts: int) -> Column:
    """Which part of so many a document is in."""
    return F.crc32(F.col("doc_id").cast("string")) % parts
