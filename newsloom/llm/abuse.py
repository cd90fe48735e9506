"""Scoring documents for abusive, hateful or sexual content by their nearest labelled examples.

Method: exact TF-IDF cosine to labelled passages, found with block-max inverted indexes; distance-weighted votes.

* Documents are read as short passages (parts of lines, longer ones as overlapping windows).  Words are brought
  to a plain form first: invisible signs, look-alikes, digits and signs standing for letters, single letters
  parted by signs, letters repeated; runs of ideographs become pairs of neighbours.
* Every passage of the labelled documents is indexed.  Terms carry idf weights from the labelled passages; a
  passage's norm counts all its terms, known or not.
* Labels are given for documents, and a flagged document is mostly harmless.  Its passages compete for the flag:
  one keeps it if most of its neighbours' votes come from passages of other flagged documents that keep theirs.
* Postings are cut into blocks with their largest weight (``Index``).  The blocks of a passage's terms bound the
  cosine to each range of the index; ranges below ``least``, or below the k-th nearest flagged passage, are skipped
  (exactly), flagged ranges first, so that a passage without a flagged neighbour costs one look at the bounds.
* The ``k`` nearest passages of other documents, with those as near as the last, vote with the square of their cosine;
  a clean document's vote weighs ``clean_worth``, as clean documents are reviewed less often.  The share of flagged votes, shrunk by a
  weak prior, is the passage's score.
* Calibration on this very run: what each piece of evidence (a group of like flagged passages) has found in all
  documents is compared with all labels, of documents in the index or not.  Evidence that finds clean documents, or far fewer reviewed
  flagged ones than other evidence does, has its scores lowered (``reliability``).  A document's score is that of
  its worst passage, which is given as evidence.

Labels: the index is built of at most ``MAX_LABELLED`` documents, chosen by hash of the id.  No label is copied to a
result: a reviewed document is scored by its neighbours like any other, never by itself.

Defined results: null, empty and blank text score 0 with no evidence; without labels every score is 0; repeated
rows of an id count once; a document labelled twice is flagged if one label flags it.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.lookalikes import LETTERS, RADICALS, is_invisible
from newsloom.session import spread, stash

#: Labelled documents an index is built of.
MAX_LABELLED = 2500
MAX_MEMO = 300_000
#: Passages whose postings of one term make a block.
RANGE = 128
_HAN = "㐀-䶿一-鿿"
_FOLD = {ord(o): k for k, others in LETTERS.items() for o in others} | {ord(k): v for k, v in RADICALS.items()}
#: Digits and signs that stand for letters.
_STANDS_FOR = str.maketrans("013457@$!|+€", "oieastasiite")
_ENDS = ".!?;。！？；…,，、"
CHUNK = re.compile(f"\n|[{_HAN}]+|[^\\s{_HAN}]+")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W\d_][ .\-_*·丶]{1,2}){2,}[^\W\d_](?![^\W_])")
_HAN_GAP = re.compile(f"(?<=[{_HAN}])[ .\\-_*·丶'　]{{1,2}}(?=[{_HAN}])")


@dataclass(frozen=True)
class Votes:
    k: int = 9
    least: float = 0.4
    #: From this score on a document is a case.
    cut: float = 0.5
    window: int = 8
    step: int = 4
    prior: float = 0.3
    #: A vote of a clean document counts as so many of flagged ones, which are reviewed far more often than others.
    clean_worth: float = 6.0
    #: Neighbours that decide whether a passage of a flagged document stays flagged, rounds of it, the power with
    #: which passages of one document compete, votes that are held back, and the claim that is enough.
    reviewers: int = 25
    rounds: int = 8
    rivalry: float = 1.5
    doubt: float = 0.1
    keep: float = 0.3
    #: Cosine from which two flagged passages are one piece of evidence.
    alike: float = 0.6
    #: Standard deviations by which evidence may find fewer reviewed flagged documents than usual.
    luck: float = 1.5


_INVISIBLE = re.compile("[" + "".join(re.escape(c) for c in map(chr, range(0x110000)) if is_invisible(c) and ord(c) < 0xE0000) + "\U000e0000-\U000e01ef]+")
_FOLDED = re.compile("[\u0131\u0250-\u02ff\u0370-\u058f\u13a0-\u13ff\u2e80-\u2fdf]")


def _plain(text: str) -> str:
    if not text.isascii():
        text = _INVISIBLE.sub("", text)
        if not unicodedata.is_normalized("NFKC", text):
            text = unicodedata.normalize("NFKC", text)
        if _FOLDED.search(text):
            text = text.translate(_FOLD)
        text = _HAN_GAP.sub("", text)
    text = text.lower()
    return _SPACED.sub(lambda m: re.sub(r"[ .\-_*·丶]", "", m[0]), text)


def word_forms(chunk: str) -> list[str]:
    """Plain words of a chunk without blanks and ideographs."""
    if not any(c.isalpha() for c in chunk):
        return ["#"] if any(c.isdigit() for c in chunk) else []
    out = []
    chunk = "".join(c for c in unicodedata.normalize("NFD", chunk) if unicodedata.category(c) != "Mn")
    if re.search(r"[^\W\d_][\d@$!|+€]+[^\W_]|[\d@$!|+€][^\W\d_]", chunk) and not re.fullmatch(r"[$€#@]?[\d.,]+(?:m|k|bn|b|%|st|nd|rd|th)?", chunk.strip("()[]\"'.,!?;:")):
        chunk = chunk.translate(_STANDS_FOR) if not chunk.startswith(("#", "@")) else chunk
    for w in re.findall(r"[^\W_]+(?:\*+[^\W_]*)?", re.sub(r"(?<=[^\W\d_])[.\-_·'’](?=[^\W\d_](?:[^\W\d_]*[.\-_·'’]|$|[^\w]))", "", chunk)):
        if any(c.isdigit() for c in w):
            out.append("#")
        else:
            out.append(re.sub(r"(.)\1{2,}", r"\1\1", w))
    return out


END = -2


class Reader(dict):
    """chunk -> term ids, with ``END`` where a passage ends; unknown terms have the id -1."""

    def __init__(self, terms: dict[str, int]):
        super().__init__()
        self.terms = terms
        self.judged: dict[bytes, tuple] = {}  # what passages of documents outside the index came to

    def __missing__(self, chunk: str) -> list[int]:
        if len(self) >= MAX_MEMO:
            self.clear()
        get = self.terms.get
        if chunk == "\n":
            got = [END]
        elif "㐀" <= chunk[0] <= "鿿":
            got = [get(chunk[i : i + 2], -1) for i in range(len(chunk) - 1)] or [get(chunk, -1)]
        else:
            got = [get(w, -1) for w in word_forms(chunk)]
            if chunk[-1] in _ENDS or (chunk[-1] in "\"')”’" and len(chunk) > 1 and chunk[-2] in _ENDS):
                got.append(END)
        self[chunk] = got
        return got

    def passages(self, texts: list[str | None], v: Votes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(term, passage of each term, text of each passage): the passages of all texts, one after the other."""
        flat: list[int] = []
        ends = []
        for t in texts:
            if t and not t.isspace():
                flat.extend(chain.from_iterable(map(self.__getitem__, CHUNK.findall(_plain(t)))))
            flat.append(END)
            ends.append(len(flat))
        term = np.array(flat, np.int64)
        stop = np.flatnonzero(term == END)
        begin = np.concatenate(([0], stop[:-1] + 1))
        size = stop - begin
        begin, size = begin[size > 0], size[size > 0]
        number = np.where(size <= v.window, 1, (size - v.window + 2 * v.step - 1) // v.step)
        nth = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
        start = np.repeat(begin, number) + nth * v.step
        size = np.minimum(v.window, np.repeat(begin + size, number) - start)
        spot = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
        return term[spot], np.repeat(np.arange(len(start)), size), np.searchsorted(np.array(ends, np.int64), start, "right")


class Words(dict):
    """Gives every new word the next id; used to read the labelled documents."""

    def get(self, word: str, _=None) -> int:
        return self.setdefault(word, len(self))


class Index:
    """Labelled passages with block-max posting lists.

    Passages stand in the order (flagged, heaviest term), so that like ones are neighbours, and are cut into ranges of
    ``RANGE``; no range holds both kinds.  The part of a term's posting list in one range is a block, kept with its
    largest weight.  For a query the maxima of its terms' blocks bound every range; only ranges whose bound reaches what
    is sought are opened, all others are skipped."""

    def __init__(self, docs: list[tuple[int, str, bool]], v: Votes):
        words = Words()
        reader = Reader(words)
        rows: dict[tuple, None] = {}
        term, row, owner = reader.passages([text for _, text, _ in docs], v)
        for one, i in zip(np.split(term, np.flatnonzero(np.diff(row)) + 1) if len(term) else [], owner):
            doc, _, bad = docs[i]
            rows.setdefault((doc, bad, *sorted(set(one.tolist()))))
        keys = list(rows)
        seen = np.zeros(len(words) + 1)
        owners: dict[int, set] = defaultdict(set)
        for doc, _, *terms in keys:
            for t in terms:
                seen[t] += 1
                owners[t].add(doc)
        kept = [t for t in range(len(words)) if len(owners[t]) > 1]  # a term of one document only cannot join two
        new = {t: i for i, t in enumerate(kept)}
        n = max(1, len(keys))
        idf = np.log((n + 1) / (seen + 0.5))
        self.unknown = float(np.log(n + 1) / 2)  # names and numbers: known to be rare, not known to matter
        self.terms = {w: new[t] for w, t in words.items() if t in new}
        self.idf = idf[kept].astype(np.float32) if kept else np.zeros(0, np.float32)
        made = []
        for doc, bad, *terms in keys:
            known = np.array([new[t] for t in terms if t in new], np.int64)
            w = self.idf[known]
            norm = np.sqrt((w**2).sum() + self.unknown**2 * (len(terms) - len(known)))
            if len(known) and norm:
                made.append((doc, bad, known, (w / norm).astype(np.float32)))
        made.sort(key=lambda m: (not m[1], int(m[2][m[3].argmax()]), m[0]))
        self.reviewed = {doc for doc, _, _ in docs}
        self.share = float(np.mean([bad for _, _, bad in docs])) if docs else 0.0
        self.fill(made, v)
        self.convict(v)
        # once more, with the passages that keep the flag standing first
        order = np.argsort(~self.bad, kind="stable")
        self.group = self.group[order]
        self.fill([(m[0], bool(b), *m[2:]) for m, b in zip(made, self.bad)], v, [m[1] for m in made])

    def fill(self, made: list[tuple], v: Votes, of_flagged: list[bool] | None = None) -> None:
        of_flagged = of_flagged or [m[1] for m in made]
        order = sorted(range(len(made)), key=lambda i: not made[i][1])
        made = [made[i] for i in order]
        n_terms, n_bad = len(self.idf), sum(m[1] for m in made)
        self.doc, self.bad = np.array([m[0] for m in made], np.int64), np.array([m[1] for m in made], bool)
        self.worth = np.where(np.array([of_flagged[i] for i in order], bool), 1.0, v.clean_worth)
        self.at = np.concatenate(([0], np.cumsum([len(m[2]) for m in made]))).astype(np.int64)
        self.flat = np.concatenate([m[2] for m in made]) if made else np.zeros(0, np.int64)
        self.weight = np.concatenate([m[3] for m in made]) if made else np.zeros(0, np.float32)
        self.base = n_bad / len(made) if made else 0.0
        at = np.arange(len(made))
        ranges = np.where(at < n_bad, at // RANGE, -(-n_bad // RANGE) + (at - n_bad) // RANGE)
        self.bad_ranges, self.n_ranges = -(-n_bad // RANGE), int(ranges.max(initial=-1)) + 1
        row = np.repeat(at, np.diff(self.at))
        place = np.lexsort((row, self.flat))
        term, self.post, self.post_weight = self.flat[place], row[place], self.weight[place]
        code = term * max(1, self.n_ranges) + ranges[self.post] if len(made) else np.zeros(0, np.int64)
        head = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else np.zeros(0, np.int64)
        self.block_at = np.append(head, len(code))
        self.block_range = ranges[self.post[head]] if len(made) else head
        self.block_max = np.maximum.reduceat(self.post_weight, head) if len(head) else np.zeros(0, np.float32)
        self.blocks = np.searchsorted(term[head], np.arange(n_terms + 1))
        first_clean = [np.searchsorted(self.block_range[a:b], self.bad_ranges) + a for a, b in zip(self.blocks[:-1], self.blocks[1:])]
        self.blocks_bad = np.array(first_clean, np.int64)
        self.max_bad = np.zeros(n_terms, np.float32)
        mine = self.block_range < self.bad_ranges
        np.maximum.at(self.max_bad, term[head][mine], self.block_max[mine])

    def convict(self, v: Votes) -> None:
        """Decide which passages of flagged documents keep the flag.

        A flagged document has at least one that earns it; a clean document has none.  A passage's claim is the share of its
        neighbours' votes that come from such passages; within a document the claims compete, so that a passage
        which only ever stands beside better ones loses its own, however often that is."""
        n = int(self.bad.sum())
        of = np.unique(self.doc[:n], return_inverse=True)[1]
        row, other, vote, harmless = [], [], [], np.zeros(n)
        for p in range(n):
            cos, met = self.neighbours(self.flat[self.at[p] : self.at[p + 1]], self.weight[self.at[p] : self.at[p + 1]], self.doc[p], v, v.reviewers)
            votes, mine = cos**2, met < n
            harmless[p] = (votes * self.worth[met])[~mine].sum()
            row.append(np.full(int(mine.sum()), p))
            other.append(met[mine])
            vote.append(votes[mine])
        row, other, vote = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (row, other, vote))
        total = np.bincount(row, vote, n) + harmless + v.doubt
        guilt, share = np.ones(n), np.zeros(n)
        for _ in range(v.rounds):
            share = np.bincount(row, vote * guilt[other], n) / total
            best = np.full(int(of.max(initial=-1)) + 1, 1e-9)
            np.maximum.at(best, of, share)
            guilt = (share / best[of]) ** v.rivalry
        self.bad[:n] = share >= v.keep
        self.group = np.arange(len(self.bad))  # like flagged passages are one piece of evidence
        alike = vote >= v.alike**2
        pair = row[alike], other[alike]
        while True:
            low = self.group.copy()
            np.minimum.at(low, pair[0], self.group[pair[1]])
            np.minimum.at(low, pair[1], self.group[pair[0]])
            low = low[low]
            if (low == self.group).all():
                break
            self.group = low

    def open_ranges(self, terms: np.ndarray, weights: np.ndarray, begin: np.ndarray, end: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """(cosines, passages) of all passages as near as ``least`` in the blocks begin..end of the terms."""
        size = end - begin
        if not size.any():
            return np.zeros(0), np.zeros(0, np.int64)
        block = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
        ranges, w = self.block_range[block], np.repeat(weights, size)
        bound = np.bincount(ranges, w * self.block_max[block], self.n_ranges)
        live = bound[ranges] >= least
        if not live.any():
            return np.zeros(0), np.zeros(0, np.int64)
        block, w = block[live], w[live]
        size = self.block_at[block + 1] - self.block_at[block]
        spot = np.repeat(self.block_at[block] - np.cumsum(size) + size, size) + np.arange(size.sum())
        cos = np.bincount(self.post[spot], np.repeat(w, size) * self.post_weight[spot])
        met = np.flatnonzero(cos >= least)
        return cos[met], met

    def neighbours(self, terms: np.ndarray, weights: np.ndarray, doc: int, v: Votes, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(cosines, passages) of the k nearest passages of other documents and those as near as the k-th, none below
        ``least``; nothing when no flagged passage is among those as near as ``least``."""
        nothing = np.zeros(0), np.zeros(0, np.int64)
        cos, met = self.open_ranges(terms, weights, self.blocks[terms], self.blocks_bad[terms], v.least)
        other = self.doc[met] != doc
        cos, met = cos[other], met[other]
        if not len(met):
            return nothing
        need = v.least if len(cos) < k else max(v.least, float(np.partition(cos, -k)[-k]) - 1e-6)
        more, also = self.open_ranges(terms, weights, self.blocks_bad[terms], self.blocks[terms + 1], need)
        other = self.doc[also] != doc
        cos, met = np.concatenate((cos, more[other])), np.concatenate((met, also[other]))
        if len(met) > k:  # whatever is as near as the k-th votes too, so that the order of the index does not decide
            near = cos >= np.partition(cos, -k)[-k] - 1e-6
            cos, met = cos[near], met[near]
        best = np.lexsort((met, -cos))
        return cos[best], met[best]

    def score_batch(self, docs: list[int], texts: list[str | None], reader: Reader, v: Votes) -> tuple[np.ndarray, list[list[tuple]]]:
        """(best score below the cut, evidence from the cut on) of each document; evidence is (passage of the index,
        score, cosine), for each nearest flagged passage the best."""
        score, found = np.zeros(len(docs)), [{} for _ in docs]
        flat, row, owner = reader.passages(texts, v)
        n = len(owner)
        if not n or not len(self.idf):
            return score, [[] for _ in docs]
        known = flat >= 0
        code = np.sort(row[known] * len(self.idf) + flat[known])
        code = code[np.concatenate(([True], code[1:] != code[:-1]))] if len(code) else code
        r, t = code // len(self.idf), code % len(self.idf)
        w = self.idf[t]
        strange = np.bincount(row[~known], minlength=n)
        norm2 = np.bincount(r, w.astype(np.float64) ** 2, n) + self.unknown**2 * strange
        w = (w / np.sqrt(np.maximum(norm2, 1e-9))[r]).astype(np.float32)
        bound = np.bincount(r, w * self.max_bad[t], n)
        begin = np.searchsorted(r, np.arange(n + 1))
        for p in np.flatnonzero(bound >= v.least):
            terms = t[begin[p] : begin[p + 1]]
            i = owner[p]
            memo = reader.judged if docs[i] not in self.reviewed else {}
            name = terms.tobytes() + bytes([strange[p]])
            got = memo.get(name)
            if got is None:
                cos, met = self.neighbours(terms, w[begin[p] : begin[p + 1]], docs[i], v, v.k)
                got = (0.0, -1, 0.0)
                if len(met) and self.bad[met].any():
                    vote, bad = cos**2 * self.worth[met], self.bad[met]
                    got = (float((vote[bad].sum() + v.prior * self.base) / (vote.sum() + v.prior)), int(met[bad][0]), float(cos[bad][0]))
                if len(memo) >= MAX_MEMO:
                    memo.clear()
                memo[name] = got
            s, at, cosine = got
            if s < v.cut:
                score[i] = max(score[i], s)
            elif s > found[i].get(at, (0.0,))[0]:
                found[i][at] = (s, cosine)
        return score, [[(at, *x) for at, x in f.items()] for f in found]


def reliability(tally: list[tuple[int, int, int, int]], v: Votes) -> dict[int, float]:
    """group -> factor of its scores, from (group, reviewed flagged, reviewed clean, other documents) found by it.

    What really is a case was reviewed at about the same rate whatever it says; evidence that finds many documents
    of which too few are among the reviewed flagged ones, even with the luck of small numbers, is common wording.
    The usual rate is that of all evidence which is not below it."""
    if not tally:
        return {}
    group, flagged, clean, other = np.array(tally, np.int64).reshape(-1, 4).T
    n = flagged + clean + other
    most = flagged + v.luck * np.sqrt(flagged + 1) + 0.5
    factor = np.ones(len(n))
    for _ in range(v.rounds):
        usual = flagged[factor == 1].sum() / max(1, n[factor == 1].sum())
        factor = np.minimum(1.0, most / np.maximum(usual * n, 1e-9))
    factor = factor * (flagged + 1) / (flagged + v.clean_worth * clean + 1)
    return dict(zip(group.tolist(), factor.tolist()))


def marks_of(labels: DataFrame, key: str, label: str, clean: str) -> DataFrame:
    """(key, _bad): every labelled document once, 1 if one of its labels flags it."""
    return labels.filter(F.col(label).isNotNull()).groupBy(key).agg(F.max((F.lower(F.trim(label)) != clean).cast("int")).alias("_bad"))


def labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, clean: str) -> list[tuple[int, str, bool]]:
    """At most ``MAX_LABELLED`` labelled documents (key, text, flagged), chosen by hash."""
    chosen = marks_of(labels, key, label, clean).orderBy(F.xxhash64(key), key).limit(MAX_LABELLED)
    rows = docs.select(key, F.col(text).alias("_text")).filter("_text is not null").join(F.broadcast(chosen), key).collect()
    return sorted({(r[key], r["_text"], bool(r["_bad"])) for r in rows})


def score(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, clean: str = "clean", v: Votes = Votes(), keep: list[str] | None = None) -> DataFrame:
    """key, kept columns, score, near (labelled document that is nearest), cosine, is_case: every document once."""
    keep = keep or []
    made = Index(labelled(docs, labels, key, text, label, clean), v)
    shared = docs.sparkSession.sparkContext.broadcast(made)
    rows = spread(docs.select(key, *keep, F.col(text).alias("_text")))
    readers: dict[int, Reader] = {}
    kind = rows.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        reader = readers.setdefault(0, Reader(index.terms))
        for b in batches:
            low, found = index.score_batch(b.column(0).to_pylist(), b.column(b.num_columns - 1).to_pylist(), reader, v)
            flat = [x for f in found for x in f]
            at = np.array([x[0] for x in flat], np.int64)
            near = pa.array(index.doc[at]).cast(b.column(0).type)
            parts = [pa.array(index.group[at].astype(np.int32)), near, pa.array([x[1] for x in flat], pa.float64()), pa.array([x[2] for x in flat], pa.float64())]
            evidence = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]).astype(np.int32)), pa.StructArray.from_arrays(parts, names=["g", "near", "s", "cosine"]))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(low), evidence], names=[key, *keep, "_low", "_evidence"])

    name = kind.simpleString()
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in [key, *keep]) + f", _low double, _evidence array<struct<g:int,near:{name},s:double,cosine:double>>"
    scored = stash(rows.mapInArrow(run, schema).dropDuplicates([key]), "scored")
    # at most as many groups as the index has passages, and the index is bounded
    hits = scored.filter("size(_evidence) > 0").select(key, F.explode(F.array_distinct("_evidence.g")).alias("g")).join(marks_of(labels, key, label, clean), key, "left")
    tally = hits.groupBy("g").agg(F.count_if(F.col("_bad") == 1), F.count_if(F.col("_bad") == 0), F.count_if(F.col("_bad").isNull()))
    factors = reliability([tuple(r) for r in tally.collect()], v)
    factor = docs.sparkSession.createDataFrame([(g, f) for g, f in factors.items() if f < 1], "g int, _factor double")
    each = scored.filter("size(_evidence) > 0").select(key, *keep, "_low", F.explode("_evidence").alias("e")).select("*", "e.g").join(F.broadcast(factor), "g", "left")
    each = each.withColumn("_s", F.col("e.s") * F.coalesce("_factor", F.lit(1.0)))
    best = each.groupBy(key).agg(*[F.first(c).alias(c) for c in keep], F.greatest(F.max("_s"), F.first("_low")).alias("score"), F.max_by("e", F.struct("_s", F.col("e.cosine"), -F.col("e.g"))).alias("e"))
    none = scored.filter("size(_evidence) = 0").select(key, *keep, F.col("_low").alias("score"), F.lit(None).cast(kind).alias("near"), F.lit(None).cast("double").alias("cosine"))
    out = best.select(key, *keep, "score", "e.near", "e.cosine").unionByName(none)
    return out.select(key, *keep, F.round("score", 6).alias("score"), "near", F.round("cosine", 6).alias("cosine"), (F.col("score") >= v.cut).alias("is_case"))


def rates(scored: DataFrame, source: str) -> DataFrame:
    """source, docs, cases, rate, mean_score."""
    return scored.groupBy(source).agg(F.count("*").alias("docs"), F.count_if("is_case").alias("cases"), F.avg(F.col("is_case").cast("double")).alias("rate"), F.avg("score").alias("mean_score"))
