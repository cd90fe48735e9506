"""Terms of a list found in texts: longest first, whole words where a term is not Chinese.

A theta join against the term list would compare every text with every term.  Here the list goes to the workers
as one automaton, after a check of its size, and each text is read once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.session import spread

try:
    import ahocorasick
except ImportError:  # the slow way below is used instead
    ahocorasick = None

MAX_TERMS = 500_000
_SEPARATORS = re.compile(r"[\W_]+")


def plain(text: str | None) -> str:
    """Lower case, signs made single blanks, a blank at either end."""
    return f" {_SEPARATORS.sub(' ', (text or '').lower()).strip()} "


def pattern_of(term: str) -> str:
    p = plain(term)
    return p.strip() if re.search("[一-鿿]", p) else p


class Terms:
    def __init__(self, terms: list[tuple[str, str]]):
        """(value, term); of a term with several values the smallest counts."""
        best: dict[str, str] = {}
        for value, term in terms:
            p = pattern_of(term)
            if p.strip():
                best[p] = min(best.get(p, value), value)
        self.best = best
        self.auto = None
        if ahocorasick and best:
            self.auto = ahocorasick.Automaton()
            for p, v in best.items():
                self.auto.add_word(p, (p, v))
            self.auto.make_automaton()

    def find(self, text: str | None) -> str | None:
        """Value of the longest term in the text; ties go to the smaller value."""
        t = plain(text)
        hits = [hit for _, hit in self.auto.iter(t)] if self.auto else [(p, v) for p, v in self.best.items() if p in t]
        return min(((-len(p.strip()), v) for p, v in hits), default=(0, None))[1]


_kept: dict[int, Terms] = {}


def terms_for(name: int, shared) -> Terms:
    """The automaton of a broadcast list: one a worker process, not one a task."""
    if name not in _kept:
        _kept.clear()
        _kept[name] = Terms(shared.value)
    return _kept[name]


def first_term(df: DataFrame, key: str, text: str, terms: DataFrame, value: str, term: str, out: str) -> DataFrame:
    """key and ``out``: the value of the longest term in each text, or null."""
    listed = [(r[0], r[1]) for r in terms.select(value, term).filter(F.col(value).isNotNull() & F.col(term).isNotNull()).distinct().limit(MAX_TERMS + 1).collect()]
    if len(listed) > MAX_TERMS:
        raise ValueError(f"more than {MAX_TERMS} terms")
    listed.sort()
    shared, name_of = df.sparkSession.sparkContext.broadcast(listed), hash(tuple(listed))
    rows = spread(df.select(key, text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = terms_for(name_of, shared)
        memo: dict[str | None, str | None] = {}
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([memo[t] if t in memo else memo.setdefault(t, found.find(t)) for t in b.column(1).to_pylist()], pa.string())], names=[key, out])
            if len(memo) > 100_000:
                memo.clear()

    return rows.mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, `{out}` string")
