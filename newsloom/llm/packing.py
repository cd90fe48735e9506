"""Filling containers of fixed capacity with items of varying length.

Method: shortest-pack-first over the length histogram.  Lengths are placed longest first; each goes to the
packs that hold least so far, pack counts being updated per pattern rather than per item, and new packs are
opened only when none has room.  The histogram has at most ``capacity`` entries whatever the number of items,
so packing it on the driver is bounded by the capacity; items are then joined to the patterns by their rank
among the items of equal length.  Ranks are numbered in ``PARTS`` parts per length plus an offset, so a length
that a third of all items have is no single task.

An item longer than the capacity is split into full containers and a rest, no other item is split.

Defined results: null and negative lengths count as 0; an item of length 0 needs no room and goes to container
0; capacities below 1 are refused; repeated rows of one key count once; containers are numbered from 0 without gaps.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.session import stash

PARTS = 64


def pack_histogram(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (how many containers, [(length, how many of it)]) that place every item of the histogram."""
    heap: list[tuple[int, int, int, object]] = []  # total, serial, containers, pattern as linked (length, number, rest)
    serial = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left > 0:
            if heap and heap[0][0] + length <= capacity:
                total, _, count, pattern = heapq.heappop(heap)
                # as many rounds as this pack stays the shortest with room: at least one item for each container of the pattern
                used = min(count, left)
                if used < count:
                    serial += 1
                    heapq.heappush(heap, (total, serial, count - used, pattern))
                serial += 1
                heapq.heappush(heap, (total + length, serial, used, (length, 1, pattern)))
                left -= used
            else:
                each = capacity // length
                full, rest = divmod(left, each)
                for count, number in ((full, each), (1 if rest else 0, rest)):
                    if count:
                        serial += 1
                        heapq.heappush(heap, (length * number, serial, count, (length, number, None)))
                left = 0
    out = []
    for _, _, count, pattern in sorted(heap, key=lambda x: x[1]):
        items: dict[int, int] = {}
        while pattern:
            length, number, pattern = pattern  # type: ignore[misc]
            items[length] = items.get(length, 0) + number
        out.append((count, sorted(items.items(), reverse=True)))
    return out


def _slots(histogram: dict[int, int], capacity: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """length -> (first rank, first container, number of containers) of each pattern's share."""
    shares: dict[int, list[tuple[int, int, int]]] = {}
    rank: dict[int, int] = {}
    base = 0
    for count, items in pack_histogram(histogram, capacity):
        for length, number in items:
            shares.setdefault(length, []).append((rank.get(length, 0), base, count))
            rank[length] = rank.get(length, 0) + count * number
        base += count
    return {k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in shares.items()}


def pack(items: DataFrame, key: str, size: str, capacities: dict[str, int]) -> DataFrame:
    """capacity_name, container_id, key, piece_no, tokens: every item once per capacity, split only if longer."""
    if any(c < 1 for c in capacities.values()):
        raise ValueError("a capacity must be 1 at least")
    names = sorted(capacities)
    rows = stash(items.select(key, F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("bigint").alias("n")).dropDuplicates([key]), "sizes")
    kinds = F.explode(F.array(*[F.struct(F.lit(i).alias("kind"), F.lit(capacities[n]).cast("bigint").alias("cap")) for i, n in enumerate(names)]))
    pieces = rows.filter("n > 0").select(key, "n", kinds.alias("k")).select(key, "n", "k.kind", "k.cap")
    pieces = pieces.select(key, "kind", "cap", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr("(n - 1) div cap"))).alias("piece"))
    pieces = pieces.select(key, "kind", "piece", F.least("cap", F.col("n") - F.col("piece") * F.col("cap")).alias("len"), F.pmod(F.xxhash64(key, "piece"), F.lit(PARTS)).alias("part"))
    counts = stash(pieces.groupBy("kind", "len", "part").agg(F.count("*").alias("n")), "size-counts")
    histogram: dict[int, dict[int, int]] = {i: {} for i in range(len(names))}
    for r in counts.groupBy("kind", "len").agg(F.sum("n").alias("n")).toLocalIterator():  # at most one entry per length up to the capacity
        histogram[r["kind"]][r["len"]] = r["n"]
    slots = items.sparkSession.sparkContext.broadcast({i: _slots(histogram[i], capacities[n]) for i, n in enumerate(names)})
    before = counts.select("kind", "len", "part", (F.sum("n").over(Window.partitionBy("kind", "len").orderBy("part")) - F.col("n")).alias("before"))
    local = F.row_number().over(Window.partitionBy("kind", "len", "part").orderBy(key, "piece")) - 1
    ranked = pieces.withColumn("local", local).join(before, ["kind", "len", "part"]).select(key, "kind", "piece", "len", (F.col("local") + F.col("before")).alias("rank"))
    key_type = rows.schema[key].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = slots.value
        for b in batches:
            kind, length, rank = (np.asarray(b.column(c)) for c in (1, 3, 4))
            where = np.zeros(len(kind), np.int64)
            code = kind.astype(np.int64) << 32 | length
            for c in np.unique(code):
                at = np.flatnonzero(code == c)
                start, base, count = table[int(c >> 32)][int(c & 0xFFFFFFFF)]
                share = np.searchsorted(start, rank[at], "right") - 1
                where[at] = base[share] + (rank[at] - start[share]) % count[share]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(where), b.column(0), b.column(2), b.column(3)], names=["kind", "container_id", key, "piece_no", "tokens"])

    placed = ranked.mapInArrow(place, f"kind int, container_id bigint, `{key}` {key_type}, piece_no bigint, tokens bigint")
    empty = rows.filter("n = 0").select(kinds.alias("k"), key).select("k.kind", F.lit(0).cast("bigint").alias("container_id"), key, F.lit(0).cast("bigint").alias("piece_no"), F.lit(0).cast("bigint").alias("tokens"))
    name = F.element_at(F.array(*map(F.lit, names)), F.col("kind") + 1).alias("capacity_name")
    return placed.unionByName(empty).select(name, "container_id", key, "piece_no", "tokens")


def fill_report(packed: DataFrame, capacities: dict[str, int]) -> DataFrame:
    """capacity_name, containers, tokens, fill (share of the room that is used)."""
    sizes = F.create_map(*[x for k, v in capacities.items() for x in (F.lit(k), F.lit(v))])
    used = packed.filter("tokens > 0").groupBy("capacity_name", "container_id").agg(F.sum("tokens").alias("t")).groupBy("capacity_name").agg(F.count("*").alias("containers"), F.sum("t").alias("tokens"))
    return used.select("capacity_name", "containers", "tokens", (F.col("tokens") / (F.col("containers") * sizes[F.col("capacity_name")])).alias("fill"))
