"""Packing pieces into sequences by minimum bin slack (operator 10).

A sequence is filled with the combination of available lengths that leaves the
least space: a subset-sum table over the lengths, kept as the bits of an
integer, whose highest bit is the fullest combination that contains the longest
piece left. The combination is removed and the next sequence is filled. Pieces
of one length are alike, so a combination is taken as often as the lengths last:
the work is bounded by the number of distinct lengths, not by the pieces.

Pieces are dealt at random into groups of about group_rows, each packed by a
task of its own; a group ends with at most one sequence that is not full for
want of pieces. Only lengths and keys travel, never tokens.

Lengths are from 1 to the capacity; rows with null or other lengths raise.
Ties between equal lengths are broken by the key columns. An empty table gives
an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pieces that a task packs.
GROUP_ROWS = 8192


def fullest(lengths: list[tuple[int, int]], room: int) -> list[tuple[int, int]]:
    """(length, times) of a combination with the largest sum up to room; lengths: (length, available)."""
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length, left in lengths:
        # one more piece of a length per step: places reached before it are kept for the way back
        for _ in range(min(left, room // length)):
            new = (reach | reach << length) & mask
            if new == reach:
                break
            steps.append((length, reach))
            reach = new
            if reach >> room:
                break
        if reach >> room:
            break
    at, used = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        if not before >> at & 1:
            used[length] = used.get(length, 0) + 1
            at -= length
    return list(used.items())


def fill(counts: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Combinations with the number of sequences that are filled so; counts: pieces of each length."""
    counts = {k: v for k, v in counts.items() if v}
    order = sorted(counts, reverse=True)
    out = []
    while order:
        longest = order[0]
        counts[longest] -= 1
        rest = [(k, counts[k]) for k in order if counts[k] and k <= capacity - longest]
        counts[longest] += 1
        used = dict(fullest(rest, capacity - longest))
        used[longest] = used.get(longest, 0) + 1
        times = min(counts[k] // n for k, n in used.items())
        out.append((list(used.items()), times))
        for k, n in used.items():
            counts[k] -= n * times
        order = [k for k in order if counts[k]]
    return out


def pack(pieces: DataFrame, keys: list[str], capacity: int, group_rows: int = GROUP_ROWS) -> DataFrame:
    """The key columns and length of pieces with sequence_id and offset.

    pieces: key columns, which together tell pieces apart, and length. It is
    read twice, once to be counted.
    """
    groups = max(1, round(pieces.count() / group_rows))
    dealt = pieces.select(*keys, F.col("length").cast("long"), F.pmod(F.xxhash64(*keys), F.lit(groups)).alias("packing_group"))

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", *keys], kind="stable", ignore_index=True)
        lengths = rows["length"].to_numpy()
        if len(lengths) and not (1 <= lengths[0] and lengths[-1] <= capacity):
            raise ValueError(f"lengths must be from 1 to {capacity}")
        found, starts, number = np.unique(lengths, return_index=True, return_counts=True)
        free = dict(zip(found.tolist(), starts.tolist(), strict=True))
        sequence, place = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
        done = 0
        for used, times in fill(dict(zip(found.tolist(), number.tolist(), strict=True)), capacity):
            at, ids = 0, done + np.arange(times)
            for length, n in used:
                for _ in range(n):
                    mine = slice(free[length], free[length] + times)
                    sequence[mine], place[mine] = ids, at
                    free[length] += times
                    at += length
            done += times
        group = int(rows["packing_group"].iloc[0])
        return rows.drop(columns="packing_group").assign(sequence_id=sequence * groups + group, offset=place)

    fields = [f for f in dealt.schema.fields if f.name != "packing_group"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", sequence_id long, offset long"
    return dealt.groupBy("packing_group").applyInPandas(place, schema)


def cut(documents: DataFrame, tokens: Column, capacity: int, ending: int) -> DataFrame:
    """doc_id, piece, start, length and ids of the pieces of documents; tokens: little-endian 32-bit ids.

    Every document ends with the id given, so none is without a piece.
    """
    whole = F.concat(tokens, F.lit(int(ending).to_bytes(4, "little")))
    last = F.floor((F.octet_length("whole") / 4 - 1) / capacity).cast("int")
    parts = documents.select("doc_id", whole.alias("whole")).select("doc_id", "whole", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    ids = F.substring("whole", F.col("piece") * (4 * capacity) + 1, F.lit(4 * capacity))
    return parts.select(
        "doc_id",
        "piece",
        (F.col("piece").cast("long") * capacity).alias("start"),
        ids.alias("ids"),
    ).withColumn("length", (F.octet_length("ids") / 4).cast("long"))
