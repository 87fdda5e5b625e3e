"""Language-model scores of a log-bilinear model trained by noise-contrastive estimation (operator 5).

The model predicts a token from the two before it: the context is the sum of
their vectors, each times a weight vector of its place, and a class's score is
its product with the context plus a bias. Classes are the FREQUENT most frequent
tokens, one each, and ENDINGS classes of all others by their last two bytes. A
class's probability is normalised over all classes by a matrix product for each
distinct context. Within a class of others a seen token has its share of the
class's count, and the unseen have a share estimated from the tokens seen once.
All unseen tokens are one type, so probabilities sum to 1 over the tokens of
the training texts and that type.

1. Texts are dealt into chunks. A chunk sends the counts of its distinct tokens
   to buckets of their hashes, a bucket adds them up and returns the totals.
2. Every task trains on the training texts it reads, starting from the tokens'
   frequencies, with noise shared by a batch so that all steps are matrix
   products; the tasks' parameters are averaged by tokens.
3. Chunks meet their totals and are scored.

Counting, training and scoring cover every row. Tokens have 64-bit names. Null
texts are empty, with the end as their only token. A null doc_id counts as
training. Rows that share a doc_id are texts of their own. Without training
texts every token is the unseen type, and scores are 0. An empty table gives an
empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import chunks, materialize, offsets, pick, raw_texts, shuffle_partitions, text_key

FREQUENT, ENDINGS, SIZE = 512, 127, 24
CHUNK_BYTES = 8 << 20
BATCH, NOISE, RATE = 4096, 96, 0.1
END = np.uint64(0xE0D)
COUNTED = np.dtype([("token", "<u8"), ("count", "<u4"), ("ending", "u1")])


class Tokens:
    """Tokens of texts one after the other, each text with its end."""

    def __init__(self, texts: list[bytes]):
        split = [t.lower().split() for t in texts]
        sizes = np.array([len(s) for s in split], np.int64)
        coded = pa.array([w for s in split for w in s], pa.large_binary()).dictionary_encode()
        words = coded.dictionary.to_pylist()
        self.names = np.array([xxhash.xxh3_64_intdigest(w) for w in words] + [int(END)], np.uint64)
        last = np.array([(w[-1] << 8 | w[-2:-1][0]) if len(w) > 1 else w[0] for w in words] + [0], np.int64)
        self.endings = (last * 40503 >> 4) % ENDINGS
        self.starts = offsets(sizes + 1)
        self.sizes = sizes + 1
        self.text = np.repeat(np.arange(len(texts)), self.sizes)
        #: which of the names each token has
        self.token = np.full(int(self.starts[-1]), len(words), np.int64)
        self.token[np.arange(len(coded)) + self.text_of_words(sizes)] = coded.indices.to_numpy()

    @staticmethod
    def text_of_words(sizes: np.ndarray) -> np.ndarray:
        return np.repeat(np.arange(len(sizes)), sizes)


class Classes:
    """Classes of tokens: frequent ones first, then those by endings. The last number stands for a text's start."""

    def __init__(self, frequent: np.ndarray):
        self.frequent = np.sort(frequent)
        self.number = len(frequent) + ENDINGS
        self.start = self.number

    def of(self, tokens: Tokens) -> np.ndarray:
        """Class of each of the names."""
        if not len(self.frequent):
            return tokens.endings
        at = np.minimum(np.searchsorted(self.frequent, tokens.names), len(self.frequent) - 1)
        return np.where(self.frequent[at] == tokens.names, at, len(self.frequent) + tokens.endings)

    def sequence(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class of each token, and of the one and the two before it."""
        now = self.of(tokens)[tokens.token]
        place = np.arange(len(now)) - np.repeat(tokens.starts[:-1], tokens.sizes)
        one, two = np.r_[self.start, now[:-1]], np.r_[self.start, self.start, now[:-2]][: len(now)]
        return now, np.where(place < 1, self.start, one), np.where(place < 2, self.start, two)


class Model:
    """words: vectors of classes in a context; places: weights of the two places; classes, bias: of what is predicted."""

    def __init__(self, shares: np.ndarray):
        rng = np.random.default_rng(1)
        n = len(shares)
        self.log_shares = np.log(np.maximum(shares, 1e-12)).astype(np.float32)
        self.p = {
            "words": rng.normal(0, 0.3, (n + 1, SIZE)).astype(np.float32),
            "places": np.ones((2, SIZE), np.float32),
            "classes": rng.normal(0, 0.1, (n, SIZE)).astype(np.float32),
            "bias": self.log_shares.copy(),
        }
        self.squares = {k: np.full_like(v, 0.1) for k, v in self.p.items()}

    def context(self, one, two):
        return self.p["words"][one] * self.p["places"][0] + self.p["words"][two] * self.p["places"][1]

    def step(self, now, one, two, noise, rate: float) -> None:
        """One step of noise-contrastive estimation on a batch, by Adagrad."""
        p = self.p
        first, second = p["words"][one], p["words"][two]
        h = first * p["places"][0] + second * p["places"][1]
        target = p["classes"][now]
        odds = np.float32(np.log(len(noise))) + self.log_shares  # of noise
        real = (h * target).sum(1) + (p["bias"] - odds)[now]
        false = h @ p["classes"][noise].T + (p["bias"] - odds)[noise]
        # of the loss, by the scores: sigmoids
        g_real = (np.tanh(real / 2) - 1) / 2
        g_false = (np.tanh(false / 2) + 1) / 2
        dh = g_real[:, None] * target + g_false @ p["classes"][noise]
        grads = {k: np.zeros_like(v) for k, v in p.items()}
        grads["bias"] = np.bincount(now, g_real, len(p["bias"])).astype(np.float32)
        np.add.at(grads["bias"], noise, g_false.sum(0))
        np.add.at(grads["classes"], noise, g_false.T @ h)
        add_rows(grads["classes"], now, g_real[:, None] * h)
        for place, (words, vectors) in enumerate(((one, first), (two, second))):
            grads["places"][place] = (dh * vectors).sum(0)
            add_rows(grads["words"], words, dh * p["places"][place])
        for k, g in grads.items():
            g /= len(now)
            self.squares[k] += g * g * 100
            p[k] -= rate * 10 * g / np.sqrt(self.squares[k])

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for k, v in self.p.items():
            self.p[k] = flat[at : at + v.size].reshape(v.shape).astype(np.float32)
            at += v.size

    def log_probabilities(self, now, one, two, unseen_share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Natural log of each token's class, and of the unseen type, in its context."""
        code = one * (len(self.log_shares) + 1) + two  # the distinct pairs, by counting
        there = np.zeros((len(self.log_shares) + 1) ** 2, bool)
        there[code] = True
        pairs, which = np.flatnonzero(there), (np.cumsum(there, dtype=np.int32) - 1)[code]
        order = np.argsort(which, kind="stable")
        ends = np.searchsorted(which[order], np.arange(len(pairs) + 1))
        own, unseen = np.empty(len(now)), np.empty(len(now))
        for at in range(0, len(pairs), 4096):
            block = pairs[at : at + 4096]
            scores = self.context(block // (len(self.log_shares) + 1), block % (len(self.log_shares) + 1)) @ self.p["classes"].T + self.p["bias"]
            scores -= scores.max(1, keepdims=True)
            e = np.exp(scores)
            total = e.sum(1, dtype=np.float64)
            mine = order[ends[at] : ends[min(at + 4096, len(pairs))]]
            row = which[mine] - at
            own[mine] = scores[row, now[mine]] - np.log(total)[row]
            unseen[mine] = np.log(np.maximum(e @ unseen_share / total, 1e-300))[row]
        return own, unseen


def add_rows(to: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    order = np.argsort(at, kind="stable")
    ordered = at[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    to[ordered[first]] += np.add.reduceat(rows[order], first)


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    held_out: of doc_id, true for the rows that are not learned from.
    """
    docs = pick(docs, doc_id="long", text="string").select("doc_id", text_key(), "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    number = max(1, -(-total // CHUNK_BYTES))
    dealt = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(number)))
    buckets = shuffle_partitions(docs.sparkSession)

    def counts(table: pa.Table) -> pa.Table:
        tokens = Tokens(raw_texts(table.column("text").combine_chunks()))
        learned = ~table.column("held_out").to_numpy()[tokens.text]
        entries = np.empty(len(tokens.names), COUNTED)
        entries["token"], entries["ending"] = tokens.names, tokens.endings
        entries["count"] = np.bincount(tokens.token[learned], minlength=len(tokens.names))
        entries = entries[np.argsort(tokens.names)]  # an order that scoring finds again
        bucket = ((entries["token"] >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
        used = np.flatnonzero(np.diff(ends))
        blobs = [entries[order[ends[b] : ends[b + 1]]].tobytes() for b in used]
        return pa.table({"bucket": pa.array(used, pa.int32()), "chunk": pa.array([table.column("chunk")[0].as_py()] * len(used), pa.int64()), "entries": pa.array(blobs, pa.binary())})

    def totals(table: pa.Table) -> pa.Table:
        """Totals of a bucket's tokens, to each chunk in its order; and rows about all tokens (chunk is null).

        These are the most frequent tokens with their totals, and for each class
        of endings the number of tokens, of all occurrences and of tokens seen once.
        """
        parts = [np.frombuffer(b, COUNTED) for b in table.column("entries").to_pylist()]
        every = np.concatenate(parts)
        names, which = np.unique(every["token"], return_inverse=True)
        count = np.bincount(which, every["count"], len(names)).astype(np.int64)
        ending = np.zeros(len(names), np.uint8)
        ending[which] = every["ending"]
        blobs = [c.astype("<i8").tobytes() for c in np.split(count[which], offsets([len(p) for p in parts])[1:-1])]
        top = np.lexsort((names, -count))[:FREQUENT]
        top = top[count[top] > 0]
        kinds = [np.bincount(ending, w, ENDINGS).astype(np.int64) for w in (count > 0, count, count == 1)]
        n = len(parts)
        rows = {
            "chunk": table.column("chunk").to_pylist() + [None] * (len(top) + ENDINGS),
            "bucket": table.column("bucket").to_pylist() + [None] * (len(top) + ENDINGS),
            "totals": blobs + [None] * (len(top) + ENDINGS),
            "token": [None] * n + names[top].view(np.int64).tolist() + [None] * ENDINGS,
            "ending": [None] * n + ending[top].tolist() + list(range(ENDINGS)),
            "types": [None] * (n + len(top)) + kinds[0].tolist(),
            "count": [None] * n + count[top].tolist() + kinds[1].tolist(),
            "once": [None] * (n + len(top)) + kinds[2].tolist(),
        }
        return pa.table(rows, schema=pa.schema([(k, pa.binary() if k == "totals" else pa.int32() if k in ("bucket", "ending") else pa.int64()) for k in rows]))

    counted = dealt.groupBy("chunk").applyInArrow(counts, "bucket int, chunk long, entries binary")
    known = counted.groupBy("bucket").applyInArrow(totals, "chunk long, bucket int, totals binary, token long, ending int, types long, count long, once long")
    known = materialize(known, "totals")

    # at most FREQUENT and ENDINGS rows come to the driver
    frequent = known.where("token IS NOT NULL").orderBy(F.desc("count"), "token").limit(FREQUENT).select("token", "ending", "count").collect()
    endings = known.where("types IS NOT NULL").groupBy("ending").agg(*[F.sum(c).alias(c) for c in ("types", "count", "once")]).collect()
    types, of_ending, once = (np.zeros(ENDINGS) for _ in range(3))
    for r in endings:
        types[r.ending], of_ending[r.ending], once[r.ending] = r["types"], r["count"], r["once"]
    train_tokens, vocabulary = int(of_ending.sum()), int(types.sum())
    for r in frequent:
        of_ending[r.ending] -= r["count"]
        once[r.ending] -= r["count"] == 1
    names = np.array([r.token for r in frequent], np.int64).view(np.uint64)
    own = np.array([r["count"] for r in frequent], np.float64)[np.argsort(names)]
    classes = Classes(names)
    shares = np.r_[own, of_ending] / max(1, train_tokens)
    # of a class of endings, what the unseen have: as often as tokens are seen once
    unseen = np.r_[np.zeros(len(own)), np.where(of_ending > 0, (once + 0.1) / (of_ending + 1), 1.0)].astype(np.float32)
    class_counts = np.r_[own, of_ending]

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, rng, seen = Model(shares), np.random.default_rng(2), 0
        noise_from = np.cumsum(shares / shares.sum())
        for _, texts in chunks(batches):
            # short numbers sort fast
            now, one, two = (x.astype(np.int16) for x in classes.sequence(Tokens(texts)))
            order = rng.permutation(len(now))
            for at in range(0, len(order), BATCH):
                b = order[at : at + BATCH]
                noise = np.minimum(np.searchsorted(noise_from, rng.random(NOISE)), len(shares) - 1)
                model.step(now[b], one[b], two[b], noise, RATE)
            seen += len(now)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([model.flat()], pa.list_(pa.float32())), pa.array([seen], pa.int64())], ["parameters", "tokens"])

    model = Model(shares)
    if train_tokens:
        trained = docs.where("NOT held_out").select("text").mapInArrow(train, "parameters array<float>, tokens long")
        each = trained.select("tokens", F.posexplode("parameters").alias("at", "value"))
        mean = each.groupBy("at").agg((F.sum(F.col("value") * F.col("tokens")) / F.sum("tokens")).alias("value"))
        got = mean.toPandas()  # a row for each parameter
        flat = np.zeros(len(got), np.float64)
        flat[got["at"].to_numpy()] = got["value"].to_numpy()
        model.load(flat)

    def scored(texts: pa.Table, totals: pa.Table) -> pa.Table:
        tokens = Tokens(raw_texts(texts.column("text").combine_chunks()))
        order = np.argsort(tokens.names)
        bucket = ((tokens.names[order] >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
        count = np.zeros(len(order), np.int64)
        for b, blob in zip(totals.column("bucket").to_pylist(), totals.column("totals").to_pylist(), strict=True):
            count[order[bucket == b]] = np.frombuffer(blob, "<i8")
        kind = classes.of(tokens)
        base = np.log10((count + 0.1) / (train_tokens + 0.1 * (vocabulary + 1)))
        seen = count[tokens.token] > 0
        now, one, two = classes.sequence(tokens)
        of_class, of_unseen = model.log_probabilities(now, one, two, unseen)
        with np.errstate(divide="ignore", invalid="ignore"):
            within = np.where(kind < len(own), 0.0, np.log((1 - unseen[kind]) * count / class_counts[kind]))
        log = np.where(seen, of_class + within[tokens.token], of_unseen) / np.log(10)
        add = lambda x: np.add.reduceat(x, tokens.starts[:-1])
        n = len(tokens.sizes)
        columns = {
            "doc_id": texts.column("doc_id"),
            "held_out": texts.column("held_out"),
            "n_tokens": pa.array(tokens.sizes),
            "n_known": pa.array(add(seen.astype(np.int64))),
            "train_tokens": pa.array(np.full(n, train_tokens, np.int64)),
            "base_score": pa.array(add(base[tokens.token])),
            "score": pa.array(add(log)),
        }
        return pa.table(columns)

    mine = known.where("chunk IS NOT NULL").select("chunk", "bucket", "totals")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return dealt.groupBy("chunk").cogroup(mine.groupBy("chunk")).applyInArrow(scored, schema)
