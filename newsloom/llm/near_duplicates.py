"""Near-duplicate records by tensored banding, with exact verification.

Method.  Each text is a set of word shingles; texts with one and the same set form a class, and only one record
of each class goes on.  ``tables`` independent tensors have ``side`` left and ``side`` right collections of two
minhashes each; every (left, right) pair of a tensor is a table key, so ``tables * side**2`` keys of four
minhashes come from ``4 * tables * side`` minhashes.  The pairs of collections are never written out: a record
is shuffled once per *left* collection and carries the tensor's right collections along; records that share a
left key sit together, and inside such a run those that also share a right key have the same table key.  That
is ``tables * side`` rows a record instead of ``tables * side**2``.

Two records whose one-bit sketches differ too much are let go at once; a pair that shares at least two table
keys is verified exactly on the full shingle sets.

Hot keys.  A run longer than ``run_cap`` or a table key with more than ``key_cap`` records is not expanded where
it stands: its records go to a second level, which spreads them over many tasks.  They are keyed there by (hot key,
left collection of any tensor but the hot key's own one) and by (hot key, right collection of the hot key's tensor
but its own one), so that a hot key and any second table key, of whatever tensor, are two shared table keys.

Defaults are for a similarity of 0.5 with no pair just below 0.55 (5 tensors of 5 + 5 collections: a pair of
similarity 0.56 is missed with probability 0.006, of 0.6 with 0.001; see ``tests/llm``).

Defined results: null fields count as empty; a text of fewer than ``width`` words has no shingles and is similar
to nothing; repeated rows of one id count once; columns beside the named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import shingles as S
from newsloom.session import spread, stash


@dataclass(frozen=True)
class Plan:
    width: int = 5
    threshold: float = 0.8
    tables: int = 5
    side: int = 5
    #: Bits of the 64-bit sketch that must agree.  At similarity 0.55 a pair agrees in 49.6 (standard deviation 3.3).
    agree: int = 40
    #: Table keys a pair must share.
    hits: int = 2
    #: Records of one left key, and of one table key, from which on they go to the second level.
    run_cap: int = 100_000
    key_cap: int = 256
    #: Rows a task gathers before it works off the runs that have ended.
    buffer: int = 50_000

    @property
    def lefts(self) -> int:
        return self.tables * self.side


def signatures(df: DataFrame, key: str, texts: list[str], plan: Plan, keep: list[str] | None = None) -> DataFrame:
    """key, kept columns, rid (hash of the key), cid (id of the shingle set, null without shingles), sk (sketch), s0.. (left and right key)."""
    keep = keep or []
    rows = spread(df.select(key, *keep, F.xxhash64(key).alias("rid"), *[F.col(c).alias(f"_t{i}") for i, c in enumerate(texts)]))
    cols = [f"_t{i}" for i in range(len(texts))]
    head = [key, *keep, "rid"]
    out_fields = [rows.schema[c] for c in head]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values, offsets = S.shingle_sets(S.joined_texts(b, cols), plan.width)
            sig = S.minhashes(values, offsets, 4 * plan.lefts)
            some = np.diff(offsets) > 0
            data = [b.column(c) for c in head]
            data += [pa.array(S.signed(S.set_ids(values, offsets)), mask=~some), pa.array(S.signed(S.sketches(sig, 64)[0]))]
            for k in range(plan.lefts):
                left, right = S.combine(sig[4 * k], sig[4 * k + 1]), S.combine(sig[4 * k + 2], sig[4 * k + 3])
                data.append(pa.array(S.signed((left.astype(np.uint64) << np.uint64(32)) | right)))
            yield pa.RecordBatch.from_arrays(data, names=[*head, "cid", "sk", *(f"s{k}" for k in range(plan.lefts))])

    from pyspark.sql import types as T

    schema = T.StructType([*out_fields, T.StructField("cid", T.LongType()), T.StructField("sk", T.LongType()), *(T.StructField(f"s{k}", T.LongType()) for k in range(plan.lefts))])
    return rows.mapInArrow(run, schema)


FILTER_BITS = 25  # a filter has at most 2**25 bits (4 MB), whatever the number of records


def perhaps_in(rows: DataFrame, wanted: DataFrame, rid: str = "rid", n: int | None = None) -> DataFrame:
    """The rows whose id may be among the wanted ones: a one-hash Bloom filter in parts of 4 KB, broadcast because its size has
    a bound.  It lets some others through and never drops a wanted row.

    It has 32 bits for each of ``n`` wanted ids (counted where not given; more may come, at the price of more that
    pass), up to ``FILTER_BITS``.  Positions go to their part before bits are set, so the shuffle is that of the ids."""
    n = wanted.count() if n is None else n
    bits = min(FILTER_BITS, max(15, (32 * n).bit_length()))
    bit = F.pmod(F.xxhash64(rid), F.lit(1 << bits))
    place = F.struct(F.shiftright(bit, 15).alias("_part"), bit.bitwiseAND(F.lit(32767)).alias("pos"))
    spots = wanted.select(place.alias("p")).select("p._part", "p.pos").repartition("_part")
    parts = spots.groupBy("_part").agg(F.bitmap_construct_agg("pos").alias("_bits"))
    marked = rows.withColumn("_p", place).withColumn("_part", F.col("_p._part")).join(F.broadcast(parts), "_part")
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_p.pos div 8 + 1 as int), 1)")), 16, 10).cast("int")
    return marked.filter(byte.bitwiseAND(F.expr("shiftleft(1, cast(_p.pos % 8 as int))")) != 0).drop("_p", "_part", "_bits")


def sets_of(df: DataFrame, key: str, texts: list[str], plan: Plan, wanted: DataFrame | None = None) -> DataFrame:
    """rid, sh: the shingle set of each record, or of those that may be wanted."""
    cols = [f"_t{i}" for i in range(len(texts))]
    rows = spread(df.select(F.xxhash64(key).alias("rid"), *[F.col(c).alias(f"_t{i}") for i, c in enumerate(texts)]))
    if wanted is not None:
        rows = perhaps_in(rows, wanted).select("rid", *cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values, offsets = S.shingle_sets(S.joined_texts(b, cols), plan.width)
            yield pa.RecordBatch.from_arrays([b.column("rid"), S.sets_column(values, offsets)], names=["rid", "sh"])

    return rows.mapInArrow(run, "rid bigint, sh array<int>")


def _packed(plan: Plan) -> int:
    return (plan.side + 2) // 2


def _left_rows(classes: DataFrame, plan: Plan, prefix: str | None = None) -> DataFrame:
    """p0, p1.., sk, rid: one row per left collection; the high half of p0 is its key, the other halves the right keys."""
    low = lambda c: c.bitwiseAND(F.lit(0xFFFFFFFF))

    def packed(left, rights):
        halves = [left, *rights] + [F.lit(0).cast("bigint")] * (len(rights) % 2 == 0)
        return [F.shiftleft(halves[i], 32).bitwiseOR(halves[i + 1]).alias(f"p{i // 2}") for i in range(0, len(halves), 2)]

    rows, own = [], []
    for k in range(plan.lefts):
        t = k // plan.side
        rights = [low(F.col(f"s{t * plan.side + j}")) for j in range(plan.side)]
        lead = [F.lit(k), F.shiftright(F.col(f"s{k}"), 32)]
        left = low(F.xxhash64(*([F.col(prefix)] if prefix else []), *lead))
        own.append(low(F.xxhash64(*lead)))
        rows.append(packed(left, rights))
    if prefix:
        hot_left, hot_right = F.shiftrightunsigned(prefix, 32), low(F.col(prefix))
        # the left collection that a hot key came from would only find the same group again
        rows = [[*fields, (own[k] != hot_left).alias("use")] for k, fields in enumerate(rows)]
        for k in range(plan.lefts):  # pairs of the hot key's tensor that share its left collection only, and two right ones
            t, j = divmod(k, plan.side)
            rights = [low(F.col(f"s{t * plan.side + i}")) for i in range(plan.side)]
            left = low(F.xxhash64(F.col(prefix), F.lit(plan.lefts + k), rights[j]))
            others = [low(F.xxhash64("rid", F.lit(i))) if i == j else r for i, r in enumerate(rights)]
            mine = F.array_contains(F.array(*own[t * plan.side : (t + 1) * plan.side]), hot_left)
            rows.append([*packed(left, others), (mine & (rights[j] != hot_right)).alias("use")])
    rows = [F.struct(*fields) for fields in rows]
    out = classes.select("rid", "sk", F.explode(F.array(*rows)).alias("r")).select(*[F.col(f"r.p{i}") for i in range(_packed(plan))], "sk", "rid", *(["r.use"] if prefix else []))
    return out.filter("use").drop("use") if prefix else out


def _collisions(plan: Plan, last: bool):
    """Over rows sorted by p0: the pairs of one run that share a right key and agree in the sketch; long runs and
    crowded keys come out as ``hot`` rows instead (not at the last level)."""
    n_packed, side, differ = _packed(plan), plan.side, 64 - plan.agree

    def pairs(cols: list[np.ndarray], sk: np.ndarray, rid: np.ndarray, key_cap: float):
        left = cols[0] >> np.uint64(32)
        halves = [cols[0] & S._M32] + [h for c in cols[1:] for h in (c >> np.uint64(32), c & S._M32)]
        for j in range(side):
            key = (left << np.uint64(32)) | halves[j]
            order = np.argsort(key, kind="stable")
            key = key[order]
            same = key[1:] == key[:-1]
            if not same.any():
                continue
            edge = np.flatnonzero(np.concatenate(([True], ~same)))
            size = np.diff(np.append(edge, len(key)))
            many = size > 1
            hot = many & (size > key_cap)
            if hot.any():
                members = order[np.repeat(hot, size)]
                yield rid[members], None, key[np.repeat(hot, size)]
            live = np.repeat(many & ~hot, size)
            idx, k = order[live], key[live]
            for step in range(1, int(size[many & ~hot].max(initial=1))):
                hit = np.flatnonzero(k[step:] == k[:-step])
                a, b = idx[hit], idx[hit + step]
                near = np.bitwise_count(sk[a] ^ sk[b]) <= differ
                x, y = rid[a[near]], rid[b[near]]
                yield np.minimum(x, y), np.maximum(x, y), None

    def emit(a, b, hot):
        n = len(a)
        none = np.ones(n, bool)
        return pa.RecordBatch.from_arrays(
            [pa.array(a), pa.array(np.zeros(n, np.int64) if b is None else b, mask=none if b is None else None), pa.array(S.signed(np.zeros(n, np.uint64) if hot is None else hot), mask=none if hot is None else None)],
            names=["a", "b", "hot"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        cut: np.uint64 | None = None  # left key of the last run that was too long: its later rows are hot too

        def hot_rows(rid: np.ndarray, left: np.uint64) -> pa.RecordBatch:
            return emit(rid.view(np.int64), None, np.full(len(rid), left, np.uint64) << np.uint64(32))

        def close(cols: list[np.ndarray], whole: bool):
            """Work off all ended runs; returns the rows of the run that may go on."""
            nonlocal cut
            out = []
            if cut is not None:
                more = int(np.searchsorted(cols[0] >> np.uint64(32), cut, "right"))
                if more:
                    out.append(hot_rows(cols[-1][:more], cut))
                    cols = [c[more:] for c in cols]
            p0 = cols[0]
            if not len(p0):
                return cols, out
            left = p0 >> np.uint64(32)
            end = len(p0) if whole else int(np.searchsorted(left, left[-1]))
            if not whole and end == 0 and len(p0) > plan.run_cap and not last:
                cut = left[-1]
                out.append(hot_rows(cols[-1], cut))
                return [c[:0] for c in cols], out
            done = [c[:end] for c in cols]
            for a, b, hot in pairs(done[:n_packed], done[n_packed], done[n_packed + 1].view(np.int64), np.inf if last else plan.key_cap):
                if len(a):
                    out.append(emit(a, b, hot))
            return [c[end:] for c in cols], out

        size = 0
        for batch in batches:
            new = [np.asarray(batch.column(i)).view(np.uint64) for i in range(n_packed + 2)]
            held.append(new)
            size += len(new[0])
            if size < plan.buffer:
                continue
            cols, out = close([np.concatenate(c) for c in zip(*held)], False)
            yield from out
            held, size = [cols], len(cols[0])
        if held:
            yield from close([np.concatenate(c) for c in zip(*held)], True)[1]

    return run


def _collide(rows: DataFrame, plan: Plan, last: bool = False) -> DataFrame:
    run = _collisions(plan, last)
    key = F.shiftrightunsigned("p0", 32)
    ordered = rows.repartition(key).sortWithinPartitions(key)
    return ordered.mapInArrow(run, "a bigint, b bigint, hot bigint")


def candidates(classes: DataFrame, plan: Plan) -> DataFrame:
    """Pairs (a, b) of class representatives, a < b, that share enough table keys."""
    first = stash(_collide(_left_rows(classes, plan), plan), "bands")
    pairs = first.filter("b is not null").select("a", "b", F.lit(1).alias("n"))
    hot = first.filter("hot is not null").select(F.col("a").alias("rid"), "hot").distinct()
    if hot.limit(1).count():
        second = _collide(_left_rows(hot.join(classes, "rid"), plan, "hot"), plan, last=True)
        pairs = pairs.unionByName(second.filter("b is not null").select("a", "b", F.lit(plan.hits).alias("n")))
    return pairs.filter("a <> b").groupBy("a", "b").agg(F.sum("n").alias("n")).filter(F.col("n") >= plan.hits).select("a", "b")


def verified(cands: DataFrame, sets: Callable[[DataFrame], DataFrame], plan: Plan) -> DataFrame:
    """The candidates whose Jaccard similarity over the full shingle sets reaches the threshold: a, b, similarity.

    ``sets`` gives the sets (rid, sh) of the wanted ids; others may be among them."""
    sides = stash(cands.select("a", "b"), "candidates").select("a", "b", F.explode(F.array("a", "b")).alias("rid"))
    both = sides.join(sets(sides.select("rid")), "rid").groupBy("a", "b").agg(F.min_by("sh", "rid").alias("x"), F.max_by("sh", "rid").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    return (
        both.select("a", "b", (common / (F.size("x") + F.size("y") - common)).alias("similarity"))
        .filter(F.col("similarity") >= plan.threshold)
    )


def near_duplicates(df: DataFrame, key: str, texts: list[str], plan: Plan) -> tuple[DataFrame, DataFrame]:
    """(pairs, members): pairs (a, b, similarity) between representatives of different texts; members (key, rid) of
    every record with shingles, rid being its representative.  No link between different texts is left out."""
    feats = stash(signatures(df, key, texts, plan).filter("cid is not null"), "signatures")
    sig = ["sk", *(f"s{k}" for k in range(plan.lefts))]
    classes = feats.groupBy("cid").agg(F.min("rid").alias("rid"), *[F.first(c).alias(c) for c in sig])
    found = verified(candidates(classes, plan), lambda ids: sets_of(df, key, texts, plan, ids), plan)
    reps = feats.groupBy("cid").agg(F.min("rid").alias("rid"))
    members = feats.select(key, "cid").distinct().join(reps, "cid").select(key, "rid")
    return found, members


def similar_pairs(df: DataFrame, key: str, texts: list[str], plan: Plan) -> DataFrame:
    """All pairs of records (key_a < key_b) of the threshold's similarity or more, copies expanded."""
    found, members = near_duplicates(df, key, texts, plan)
    found, members = stash(found.select("a", "b"), "pairs"), stash(members, "members")
    ids = members.select(F.col(key).alias("x"), F.col("rid").alias("a"))
    other = members.select(F.col(key).alias("y"), F.col("rid").alias("b"))
    across = found.join(ids, "a").join(other, "b").select("x", "y")
    more = members.groupBy("rid").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("rid").alias("a"))
    within = ids.join(more, "a").join(other.withColumnRenamed("b", "a"), "a").filter("x < y").select("x", "y")
    return across.unionByName(within).select(F.least("x", "y").alias(f"{key}_a"), F.greatest("x", "y").alias(f"{key}_b"))
