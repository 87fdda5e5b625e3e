import random

import numpy as np
import pytest

from pageloom.llm import similar

SCHEMA = "doc_id long, text string, name int, TEXT string"


def brute(rows, words, percent):
    sets = [similar.shingles((t or "").encode(), words) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, p in enumerate(sets):
        for j in range(i):
            common = len(p & sets[j])
            if p and sets[j] and 100 * common >= percent * (len(p) + len(sets[j]) - common):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (doc, _) in enumerate(rows):
        least.setdefault(find(i), []).append(doc)
    smallest = {k: min((d for d in v if d is not None), default=None) for k, v in least.items()}
    return [(doc, len(sets[i]), smallest[find(i)]) for i, (doc, _) in enumerate(rows)]


def near_copies(rng):
    vocabulary = [f"w{i}" for i in range(300)] + ["A", "a", "É", "é"]
    common = " ".join(rng.choice(vocabulary) for _ in range(25))
    rows = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 40, 120, 400]))]
        for _ in range(rng.choice([1, 2, 9, 25])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append(" ".join(text) + (f"\n{common}" if rng.random() < 0.3 else ""))
    rows += ["", None, "one", "ONE", "one two", "one two three", "ONE two Three", "  \n"]
    ids = rng.sample(range(10**6), len(rows))
    rows = list(zip(ids, rows, strict=True))
    return rows + [rows[0], (rows[0][0], rows[20][1]), (None, rows[5][1])]


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80)])
def test_against_brute_force(spark, words, percent):
    rows = near_copies(random.Random(words))
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA).repartition(4)
    got = similar.link(docs, words, percent).drop("text_key", "component").collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, words, percent), key=key)


def test_chains_are_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (205, 205)], "a long, b long")
    got = {r.node: r.component for r in similar.components(links).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100}


def test_prefixes_share_as_many_as_wanted():
    rng = np.random.default_rng(1)
    for _ in range(300):
        universe = rng.permutation(60)
        x = set(universe[: rng.integers(5, 50)].tolist())
        y = set(list(x)[rng.integers(0, 4) :]) | set(universe[50 : 50 + rng.integers(0, 3)].tolist())
        if 100 * len(x & y) < 90 * len(x | y):
            continue
        wanted, prefix = [], []
        for s in (x, y):
            m = similar.matches_wanted(rng.integers(1, 100, len(s)), len(s), 90)
            wanted.append(m)
            prefix.append(set(sorted(s)[: len(s) - similar.least_overlap(len(s), 90) + m]))
        assert len(prefix[0] & prefix[1]) >= min(wanted)


@pytest.mark.parametrize("percent", [80, 90])
def test_candidates_are_all_pairs_that_pass_the_tests(spark, monkeypatch, percent):
    """Of large sets and of buckets in several blocks; parities never leave out a pair that links."""
    monkeypatch.setattr(similar, "BUCKET_ROWS", 7)
    monkeypatch.setattr(similar, "PAIRS", 40)
    rng = random.Random(percent)
    texts, rows = [], []
    for n in (30, 600, 3000, 2040):
        base = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        for _ in range(20):
            text = list(base)
            for _ in range(rng.randrange(0, n // 25 + 1)):
                text[rng.randrange(n)] = f"x{rng.randrange(10**6)}"
            text[-1] = f"y{len(texts)}"  # no two are the same
            texts.append(" ".join(text).encode())
    sets = similar.Sets(texts, 3)
    parities = sets.parities()
    for i in range(len(texts)):
        key = i // 20
        rows.append((key, int(sets.names[i]), int(sets.sizes[i]), 1, 0, i if i % 5 else key, bytearray(parities[i]), 20))
    schema = "key long, name long, size int, wanted byte, place int, component long, parity binary, times long"
    frame = spark.createDataFrame(rows, schema).repartition(3)
    got = [(r.a, r.b) for r in similar.candidates(frame, percent).collect()]
    assert len(got) == len(set(got))
    words = [similar.shingles(t, 3) for t in texts]
    linked, possible = set(), 0
    for i in range(len(texts)):
        for j in range(i // 20 * 20, i):
            if rows[i][5] == rows[j][5] or rows[i][1] == rows[j][1]:
                continue
            possible += 1
            common = len(words[i] & words[j])
            if 100 * common >= percent * (len(words[i]) + len(words[j]) - common):
                linked.add((min(rows[i][1], rows[j][1]), max(rows[i][1], rows[j][1])))
    assert linked <= set(got) and len(got) < possible
    sets_table = spark.createDataFrame([(r[1], r[2], r[6]) for r in rows], "name long, n_shingles long, parity binary")
    every = [(rows[i][1], rows[j][1], 3) for i in range(len(rows)) for j in range(i)]
    pairs = spark.createDataFrame(every, "a long, b long, count long")
    left = {(min(r.a, r.b), max(r.a, r.b)) for r in similar.possible(pairs, sets_table, percent).collect()}
    assert linked <= left and len(left) < len(every) / 2


def test_pairs_that_link_by_another_way_are_no_rows(spark, monkeypatch):
    rng, base = random.Random(7), [f"w{i}" for i in range(150)]
    rows = []
    for k in range(200):
        text = list(base)
        for at in rng.sample(range(len(base)), 2):
            text[at] = f"e{k}x{at}"
        rows.append((k, " ".join(text)))
    made, candidates = [], similar.candidates

    def counted(*args):
        pairs = candidates(*args)
        made.append(pairs.count())
        return pairs

    monkeypatch.setattr(similar, "candidates", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = similar.link(docs, 5, 80).select("doc_id", "n_shingles", "component_id").collect()
    want = brute(rows, 5, 80)
    assert sorted(map(tuple, got)) == sorted(want)
    assert made[0] < 1000  # 3865 of the pairs link, and each meets in many buckets


def test_nearest_gives_each_set_one_pair(spark):
    rng = random.Random(5)
    bits = [bytes(32), bytes([1]) + bytes(31), bytes([3]) + bytes(31), bytes([255] * 9) + bytes(23)]
    rows = [(1, i, 100, 1, 0, i % 3, rng.choice(bits), 90) for i in range(90)] + [(2, 500, 100, 1, 0, 7, bits[0], 2), (2, 501, 100, 1, 0, 7, bits[0], 2)]
    frame = spark.createDataFrame(rows, "key long, name long, size int, wanted byte, place int, component long, parity binary, times long")
    differ = lambda p, q: (int.from_bytes(p) ^ int.from_bytes(q)).bit_count()
    of = {r[1]: r for r in rows}
    least = {}
    for i in range(90):
        apart = [differ(of[i][6], of[j][6]) for j in range(90) if of[i][5] != of[j][5]]
        if min(apart) <= 200 - 2 * 89:
            least[i] = min(apart)
    got = similar.nearest(frame, 80).collect()
    assert len(got) <= len(least) and all(of[a][5] != of[b][5] for a, b in got)
    best = {}
    for a, b in got:
        for i in (a, b):
            best[i] = min(best.get(i, 999), differ(of[a][6], of[b][6]))
    assert best == least


def test_more_bits_fold_into_fewer():
    rng = random.Random(1)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(n)).encode() for n in (10, 700, 5000)]
    whole = similar.Sets(texts, 3).parities()
    assert [8 * len(p) for p in whole] == list(similar.PARITIES)
    odd = similar.Sets(texts, 3)
    for parity, i in zip(whole, range(3), strict=True):
        places = (odd.hashes[odd.owner == i] >> np.uint64(9)) % np.uint64(256)
        want = np.packbits((np.bincount(places.astype(int), minlength=256) & 1).astype(np.uint8)).tobytes()
        assert similar.folded(parity, 0) == want


def test_empty_table(spark):
    assert similar.link(spark.createDataFrame([], SCHEMA)).collect() == []


def test_keep_one_with_clashing_columns_and_repeated_rows(spark):
    text = "one two three four five six seven"
    rows = [(1, text, "a", "k"), (1, text, "a", "k"), (2, text.upper(), "b", "k"), (None, "", "c", None), (None, "", "c", None), (3, "x y", "d", "l")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, linked string, text_key string")
    kept = similar.keep_one(docs, 5, 80)
    assert kept.columns == docs.columns
    got = sorted((tuple(r) for r in kept.collect()), key=str)
    assert got == sorted([rows[0], rows[3], rows[4], rows[5]], key=str)


def test_words_are_those_of_a_split_on_ascii_white_space():
    texts = [b"", b" ", b"A b\x0bC\x1cd", "É é\tx".encode(), b"\n\nlast"]
    words, counts = similar.lower_words(texts)
    split = [t.lower().split() for t in texts]
    assert words.to_pylist() == [w for s in split for w in s]
    assert counts.tolist() == [len(s) for s in split]


def test_rows_of_small_buckets_carry_no_parities(spark, monkeypatch):
    """They outweighed the pairs themselves; the result is that of all pairs."""
    rng = random.Random(11)
    rows, common = [], [f"c{i}" for i in range(300)]
    for k in range(100):  # pairs that share half or nearly all of what they have, and a line that all have
        text = [f"w{k // 2}x{i}" for i in range(60)]
        if k % 2:
            for at in rng.sample(range(60), 30 if k % 4 == 1 else 1):
                text[at] = f"e{k}x{at}"
        rows.append((k, " ".join([*text, *(common[:20] if k % 3 else [])])))
    seen, candidates = [], similar.candidates

    def noted(rows, percent):
        seen.append((("parity" in rows.columns), [r.times for r in rows.select("times").distinct().collect()]))
        return candidates(rows, percent)

    monkeypatch.setattr(similar, "candidates", noted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = similar.link(docs, 3, 90).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows, 3, 90))
    assert any(times for _, times in seen)
    assert all(min(times, default=similar.LARGE_BUCKET + 1) > similar.LARGE_BUCKET for parity, times in seen if parity)
