"""Checking each batch of articles against everything the same source delivered before.

Method: multi-key sorted-neighbourhood runs.  Every record has several sort keys, which put it into key ranges; each
batch is merged as one sorted run into the persisted key ranges, and only windows around its records are compared.

* Exact keys (content hash, page, shingle set): kept as one 64-bit hash each for the first record that had it.  A record is
  found when its key is kept already, or when it is not the first of its batch with it.  The first record comes from
  a map-side combined minimum and the rest by an anti join on the record's own id, so a key that holds a third of
  all rows is never gathered.
* Text: ``keys`` sort keys, each of three minhashes; a range is (source, key number, the three minhashes), and within a
  range records stand by time.  Only the first record of each (source, shingle set) takes part: later copies are found as
  such.  A new record is compared with the ``window`` records before it in each of its ranges; of those whose 128-bit sketches agree enough,
  the ``best`` nearest are verified on the full shingle sets.
* A record that this does not find, although it had more near ones or a longer range before it, goes to an exact second step:
  it is compared with all earlier records of those ranges, which are spread over ``SLICES`` tasks each.  So windows
  only save work, and nothing is lost by crowding.

A pair of similarity 0.56 falls into one range for at least one of the 24 keys with probability 0.990 (0.6: 0.997, 0.7: 0.99995),
whatever the size of the range, and its sketches agree enough with 0.9996.  A record with several earlier partners has as many chances.

Kept under ``path``, a folder all executors share: a manifest (``operators.state.Manifest``) names the runs, so a new
``ArrivalIndex`` on the same path goes on where the last one stopped.  A run holds key rows in parts by source, sorted by range within
each file; a batch reads the parts of its own sources, and of those the rows that pass a filter of its ranges.  After
``compact_after`` runs they are merged into one.  A batch that is older than what is kept is refused.

Defined results: null hash, null or blank page, text without shingles and null source match nothing; order is
(collected_at, article_id), null times first; rows repeated whole count once.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm import near_duplicates as ND
from newsloom.llm import shingles as S
from newsloom.operators.state import Manifest
from newsloom.session import spread, stash, stash_path

#: Tasks over which the earlier records of one range are spread in the second step.
SLICES = 8
_CHUNK = 2_000_000


@dataclass(frozen=True)
class Neighbourhood:
    width: int = 5
    threshold: float = 0.8
    keys: int = 24
    #: Minhashes of a key: more of them make ranges of texts that share little rarer.
    depth: int = 3
    window: int = 2048
    #: Near records of one range that are verified first.
    best: int = 3
    #: Bits of the 128-bit sketch that must agree; at similarity 0.55 a pair agrees in 99 (standard deviation 4.7).
    agree: int = 84


def page_key(url: Column) -> Column:
    """What decides the page of a URL: host without case, www. and port, path without final /, parameters id and page."""
    u = F.trim(url)
    rest = F.regexp_replace(u, r"(?i)^https?://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), r":\d*$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), "/$", "")
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    return F.when(u != "", F.concat_ws("\n", host, path, F.regexp_extract(query, r"(?:^|&)id=([^&]*)", 1), F.regexp_extract(query, r"(?:^|&)page=([^&]*)", 1)))


def features(df: DataFrame, key: str, source: str, at: str, hash_col: str, url_col: str, texts: list[str], nb: Neighbourhood, keep: list[Column] | None = None) -> DataFrame:
    """id, src (hash of the source), t (microseconds), kept columns, h, u (hashes of hash and page), rid, cid, sk0, sk1, k0.. (sort keys), sh (shingle set)."""
    keep = keep or []
    have = F.col(source).isNotNull()
    mark = lambda kind, c: F.when(have & c.isNotNull(), F.xxhash64(F.lit(kind), source, c))
    page = page_key(F.col(url_col))
    head = [F.col(key).alias("id"), F.when(have, F.xxhash64(source)).alias("src"), F.coalesce(F.unix_micros(at), F.lit(-(1 << 62))).alias("t"), *keep]
    head += [mark("h", F.col(hash_col)).alias("h"), mark("u", page).alias("u"), F.xxhash64(key).alias("rid")]
    rows = spread(df.select(*head, *[F.col(c).alias(f"_t{i}") for i, c in enumerate(texts)]))
    cols = [f"_t{i}" for i in range(len(texts))]
    names = [c for c in rows.columns if c not in cols]
    width, n_keys, depth = nb.width, nb.keys, nb.depth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values, offsets = S.shingle_sets(S.joined_texts(b, cols), width)
            sig = S.minhashes(values, offsets, max(S.N_MINHASH, n_keys * depth))
            data = [b.column(c) for c in names]
            data += [pa.array(S.signed(S.set_ids(values, offsets)), mask=np.diff(offsets) == 0), *(pa.array(S.signed(w)) for w in S.sketches(sig, 128))]
            for k in range(n_keys):
                one = np.zeros(len(offsets) - 1, np.uint64)
                for i in range(depth):
                    one = S.mix(one * np.uint64(5) + sig[depth * k + i].astype(np.uint64))
                data.append(pa.array(S.signed(one)))
            yield pa.RecordBatch.from_arrays([*data, S.sets_column(values, offsets)], names=[*names, "cid", "sk0", "sk1", *(f"k{k}" for k in range(n_keys)), "sh"])

    longs = [T.StructField(c, T.LongType()) for c in ("cid", "sk0", "sk1", *(f"k{k}" for k in range(n_keys)))]
    return rows.mapInArrow(run, T.StructType([rows.schema[c] for c in names] + longs + [T.StructField("sh", T.ArrayType(T.IntegerType()))]))


def _near_before(nb: Neighbourhood):
    """Over rows sorted by (range, time): for each fresh row the ``best`` nearest of the ``window`` before it (and all of its own time) as (a, b), and
    (b, rng) where more are near or stand before the window."""
    differ, window, best = 128 - nb.agree, nb.window, nb.best

    def emit(a: np.ndarray, b: np.ndarray, rng: np.ndarray | None = None) -> pa.RecordBatch:
        left = pa.array(a) if rng is None else pa.nulls(len(b), pa.int64())
        return pa.RecordBatch.from_arrays([left, pa.array(b), pa.nulls(len(b), pa.int64()) if rng is None else pa.array(rng)], names=["a", "b", "rng"])

    def compare(rows: np.ndarray, depth: np.ndarray, cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        rng, sk0, sk1, rid, _, t = cols
        n = np.minimum(depth, window)
        late = np.repeat(rows, n)
        early = np.repeat(rows - n, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        apart = np.bitwise_count((sk0[early] ^ sk0[late]).view(np.uint64)).astype(np.int16) + np.bitwise_count((sk1[early] ^ sk1[late]).view(np.uint64))
        near = np.flatnonzero(apart <= differ)
        early, late, apart = early[near], late[near], apart[near]
        order = np.lexsort((-early, apart, late))
        early, late = early[order], late[order]
        first = np.maximum.accumulate(np.where(np.concatenate(([True], late[1:] != late[:-1])), np.arange(len(late)), 0)) if len(late) else late
        rank = np.arange(len(late)) - first
        few = (rank < best) | (t[early] == t[late])  # of one time either may be the later one
        if few.any():
            yield emit(rid[early[few]], rid[late[few]])
        more = np.union1d(np.unique(late[rank >= best]), rows[depth > window])
        if len(more):
            yield emit(None, rid[more], rng[more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail, before = None, 0  # rows that may still be in a window, and how many of the range stood before them
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [np.asarray(batch.column(i)) for i in range(6)]
            was = len(tail[0]) if tail else 0
            cols = [np.concatenate(c) for c in zip(tail, new)] if tail else new
            rng, fresh = cols[0], cols[4]
            begin = np.maximum.accumulate(np.where(np.concatenate(([True], rng[1:] != rng[:-1])), np.arange(len(rng)), 0))
            depth = np.arange(len(rng)) - begin + np.where(begin == 0, before, 0)
            rows = was + np.flatnonzero((fresh[was:] > 0) & (depth[was:] > 0))
            work = np.cumsum(np.minimum(depth[rows], window))
            for part in np.split(rows, np.searchsorted(work, np.arange(_CHUNK, work[-1], _CHUNK))) if len(rows) else []:
                if len(part):
                    yield from compare(part, depth[part], cols)
            keep = max(int(begin[-1]), len(rng) - window)
            before = int(depth[keep])
            tail = [c[keep:] for c in cols]

    return run


def _all_before(nb: Neighbourhood):
    """Over rows sorted by (range, slice, time): each sought row with all earlier ones of its slice whose sketches agree."""
    differ = 128 - nb.agree

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [np.asarray(batch.column(i)) for i in range(6)]
            cols = [np.concatenate(c) for c in zip(held, new)] if held else new
            was = len(held[0]) if held else 0
            rng, sk0, sk1, rid, sought, own = cols
            begin = np.maximum.accumulate(np.where(np.concatenate(([True], rng[1:] != rng[:-1])), np.arange(len(rng)), 0))
            a, b = [], []
            for i in was + np.flatnonzero(sought[was:]):
                part = slice(begin[i], i)
                apart = np.bitwise_count((sk0[part] ^ sk0[i]).view(np.uint64)).astype(np.int16) + np.bitwise_count((sk1[part] ^ sk1[i]).view(np.uint64))
                near = rid[part][(apart <= differ) & (own[part] > 0)]
                a.append(near)
                b.append(np.full(len(near), rid[i]))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])
            kept = slice(begin[-1], None)
            # of the range that goes on, only what belongs to the slice is looked at again
            mine = np.flatnonzero(own[kept] > 0) + begin[-1]
            held = [c[mine] for c in cols]

    return run


class ArrivalIndex:
    """Runs kept between batches, under ``path`` (a folder all executors share).

    ``add`` merges a batch and returns the ids of its records that repeat an earlier one.  Only one writer at a time; of two the
    second one's manifest is refused."""

    def __init__(self, spark: SparkSession, path: str, key: str, source: str, at: str, hash_col: str, url_col: str, texts: list[str], nb: Neighbourhood, parts: int = 8, compact_after: int = 8):
        self.spark, self.path = spark, path.rstrip("/")
        self.key, self.names, self.nb, self.parts, self.compact_after = key, (key, source, at, hash_col, url_col, texts), nb, parts, compact_after
        self.manifest = Manifest(spark, f"{self.path}/manifest")

    def _state(self) -> dict:
        return self.manifest.read() or {"keys": [], "exact": [], "sets": [], "last": None}

    def _new(self, name: str) -> str:
        return f"{self.path}/{name}/run={uuid.uuid4().hex[:12]}"

    def _read(self, paths: list[str], schema: str) -> DataFrame | None:
        return self.spark.read.schema(schema).parquet(*paths) if paths else None

    def _part(self, src: Column) -> Column:
        return F.pmod(src, F.lit(self.parts)).cast("int")

    def keys_in(self, paths: list[str]) -> DataFrame | None:
        """The key rows of these runs."""
        columns = "rng long, sk0 long, sk1 long, rid long, t long, part int"
        if not paths:
            return None
        return self.spark.read.option("basePath", f"{self.path}/keys").schema(columns).parquet(*paths).select("rng", "sk0", "sk1", "rid", "t", "part")

    def kept_keys(self, state: dict, parts: list[int]) -> DataFrame | None:
        """The kept key rows of some parts."""
        kept = self.keys_in(state["keys"])
        return None if kept is None else kept.filter(F.col("part").isin(parts))

    def add(self, batch: DataFrame) -> DataFrame:
        key, source, at, hash_col, url_col, texts = self.names
        path = self._new("features")
        features(batch.dropDuplicates([key]), key, source, at, hash_col, url_col, texts, self.nb).write.parquet(path)
        return self.add_features([path])

    def add_features(self, paths: list[str]) -> DataFrame:
        """The ids found in a batch whose features (one row an id) lie in these folders, where they stay."""
        feats, state = self.spark.read.parquet(*paths), self._state()
        bounds = feats.agg(F.min(F.struct("t", "id")).alias("lo"), F.max(F.struct("t", "id")).alias("hi"), F.collect_set(self._part(F.col("src"))).alias("parts"), F.count("*").alias("n")).first()
        if bounds["lo"] is None:
            return feats.select(F.col("id").alias(self.key))
        lo, hi = ([bounds[c]["t"], bounds[c]["id"]] for c in ("lo", "hi"))
        if state["last"] is not None and lo <= state["last"]:
            raise ValueError(f"the batch begins at {lo}, before the end of what is kept, {state['last']}")
        found, new = self._by_exact_keys(feats, state, bounds["n"])
        reps = feats.drop("sh", "h", "u").filter("cid is not null and src is not null").join(new.filter("kind = 2").select("id"), "id", "left_semi").dropDuplicates(["id"])
        ranges = F.array(*[F.xxhash64("src", F.lit(k), f"k{k}") for k in range(self.nb.keys)])
        rows = reps.select(F.explode(ranges).alias("rng"), "sk0", "sk1", "rid", "t", self._part(F.col("src")).alias("part"))
        run = {"keys": self._new("keys"), "exact": self._new("exact")}
        rows.sortWithinPartitions("part", "rng", "t").write.partitionBy("part").parquet(run["keys"])
        new.select("mark").write.parquet(run["exact"])
        now = {**{k: [*state[k], run[k]] for k in run}, "sets": [*state["sets"], *paths], "last": hi}
        by_text = self._by_text(feats.select("rid", "t", "id"), found, run["keys"], state, now, bounds)
        out = stash(found.unionByName(by_text).distinct().withColumnRenamed("id", self.key), "found")
        self.manifest.write(now)
        if len(now["keys"]) >= self.compact_after:
            self.compact()
        return out

    def _by_exact_keys(self, feats: DataFrame, state: dict, n: int) -> tuple[DataFrame, DataFrame]:
        """(ids of the records with a key that is kept or is not theirs first; id, kind, mark of the keys that are new)."""
        kinds = F.array(*[F.struct(F.lit(i).alias("kind"), mark.alias("mark")) for i, mark in enumerate([F.col("h"), F.col("u"), F.when(F.col("src").isNotNull() & F.col("cid").isNotNull(), F.xxhash64("src", "cid"))])])
        rows = feats.select("id", "t", F.explode(kinds).alias("k")).select("id", "t", "k.kind", "k.mark").filter("mark is not null")
        first = rows.groupBy("kind", "mark").agg(F.min(F.struct("t", "id")).alias("f")).select("kind", "mark", "f.id")
        kept = self._read(state["exact"], "mark long")
        if kept is not None:
            first = first.join(ND.perhaps_in(kept, first, "mark", 3 * n), "mark", "left_anti")
        first = stash(first, "firsts")
        return rows.select("id", "kind").join(first.select("id", "kind"), ["id", "kind"], "left_anti").select("id").distinct(), first

    def _by_text(self, feats: DataFrame, done: DataFrame, run: str, state: dict, now: dict, bounds) -> DataFrame:
        """Ids found by text; for those that are ``done`` already the search may end early."""
        plan = ND.Plan(width=self.nb.width, threshold=self.nb.threshold)
        fresh = self.keys_in([run])
        rows = fresh.withColumn("fresh", F.lit(1))
        kept = self.kept_keys(state, bounds["parts"])
        if kept is not None:
            rows = rows.unionByName(ND.perhaps_in(kept, fresh, "rng", bounds["n"] * self.nb.keys).withColumn("fresh", F.lit(0)))
        ordered = rows.select("rng", "sk0", "sk1", "rid", "fresh", "t").repartition("rng").sortWithinPartitions("rng", "t")
        met = stash(ordered.mapInArrow(_near_before(self.nb), "a bigint, b bigint, rng bigint"), "neighbours")
        names = feats.select("rid", "t", "id").distinct()

        def named(pairs: DataFrame) -> DataFrame:
            """The later of each similar pair, by (time, id); a record that is not of this batch is the earlier one."""
            sets = lambda ids: ND.perhaps_in(self._read(now["sets"], "rid long, sh array<int>"), ids)
            same = ND.verified(pairs.filter("a <> b").distinct(), sets, plan)
            place = names.select("rid", F.struct("t", "id").alias("o"))
            both = same.join(place.select(F.col("rid").alias("b"), F.col("o").alias("y")), "b", "left").join(place.select(F.col("rid").alias("a"), F.col("o").alias("x")), "a", "left")
            return both.select(F.greatest("x", "y")["id"].alias("id")).distinct()

        found = named(met.filter("a is not null").select("a", "b"))
        more = met.filter("rng is not null").select(F.col("b").alias("rid"), "rng").distinct()
        if more.isEmpty():
            return found
        found = stash(found, "found")
        settled = names.join(found.unionByName(done), "id").select("rid")
        sought = stash(more.join(settled, "rid", "left_anti"), "sought")
        if sought.isEmpty():
            return found
        here = rows.join(sought.select("rng").distinct(), "rng", "left_semi").join(sought.withColumn("sought", F.lit(1)), ["rng", "rid"], "left")
        mine = F.pmod(F.col("rid"), F.lit(SLICES)).cast("int")
        wide = here.withColumn("slice", F.explode(F.when(F.col("sought") == 1, F.sequence(F.lit(0), F.lit(SLICES - 1))).otherwise(F.array(mine))))
        wide = wide.select(F.xxhash64("rng", "slice").alias("rng"), "sk0", "sk1", "rid", F.coalesce("sought", F.lit(0)).alias("sought"), (F.col("slice") == mine).cast("int").alias("own"), "t")
        ordered = wide.repartition("rng").sortWithinPartitions("rng", "t").select("rng", "sk0", "sk1", "rid", "sought", "own")
        return found.unionByName(named(ordered.mapInArrow(_all_before(self.nb), "a bigint, b bigint")))

    def compact(self) -> None:
        """Merge all runs into one; of the shingle sets only those of records that are in the key ranges stay."""
        state = self._state()
        if len(state["keys"]) < 2:
            return
        now = {k: [self._new(k)] for k in ("keys", "exact", "sets")}
        keys = self.keys_in(state["keys"])
        keys.repartition("part").sortWithinPartitions("part", "rng", "t").write.partitionBy("part").parquet(now["keys"][0])
        self.spark.read.parquet(*state["exact"]).distinct().write.parquet(now["exact"][0])
        kept = self.keys_in(now["keys"]).select("rid").distinct()
        self._read(state["sets"], "rid long, sh array<int>").join(kept, "rid", "left_semi").write.parquet(now["sets"][0])
        self.manifest.write({**state, **now})


def found_in(df: DataFrame, key: str, source: str, at: str, hash_col: str, url_col: str, texts: list[str], nb: Neighbourhood, period: str = "year", **index) -> DataFrame:
    """Ids of the records that repeat an earlier one of their source by hash, page or text: the history goes through an
    index in batches, one a calendar ``period``; features are made once for all."""
    spark, path = df.sparkSession, stash_path(df.sparkSession, "arrivals")
    batch = F.coalesce(F.date_format(F.date_trunc(period, at), "yyyyMMdd"), F.lit("0")).alias("batch")
    feats = features(df, key, source, at, hash_col, url_col, texts, nb, [batch])
    feats.write.partitionBy("batch").parquet(f"{path}/features")
    kept = ArrivalIndex(spark, f"{path}/index", key, source, at, hash_col, url_col, texts, nb, **index)
    # as many as there are periods
    batches = sorted(str(r[0]) for r in spark.read.schema(feats.schema).parquet(f"{path}/features").select("batch").distinct().collect())
    out = None
    for b in batches:
        got = kept.add_features([f"{path}/features/batch={b}"])
        out = got if out is None else out.unionByName(got)
    return df.select(key).limit(0) if out is None else out
