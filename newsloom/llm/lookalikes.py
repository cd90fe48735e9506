"""Bringing text that looks alike but differs in its characters to one form.

Method: look-alike relations between strings and code points (compatibility forms that keep the shape, canonical
equivalents, a table of look-alike letters, invisible characters, blanks, hyphens) are closed transitively by
union-find; a composed letter belongs to every composed look-alike of its base and marks.  Each class
is represented by its most frequent member in the corpus, and a text is rewritten greedily (leftmost, longest)
with a multi-pattern automaton over all other members.

Code points are counted over the whole corpus in one pass; the counts are at most one row per code point of
Unicode, so gathering them is bounded.  A string counts as often as its rarest code point.

Letters with and without accents, different digits and different Latin letters stay different.

Defined results: null gives null, a text of invisible characters and blanks gives the empty string; ties between
representatives go to the shortest, then the smallest member.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.session import spread, stash

# Letters that look like a Latin letter, by that letter.
LETTERS = {
    "A": "АΑᎪ", "B": "ВΒᏴ", "C": "СϹᏟ", "D": "Ꭰ", "E": "ЕΕᎬ", "G": "ԌᏀ", "H": "НΗᎻ", "I": "ІΙ", "J": "ЈᎫ", "K": "КΚᏦ", "L": "Ꮮ", "M": "МΜᎷ",
    "N": "Ν", "O": "ОΟՕ", "P": "РΡᏢ", "Q": "Ԛ", "R": "Ꭱ", "S": "ЅՏᏚ", "T": "ТΤᎢ", "U": "Ս", "V": "ѴᏙ", "W": "ԜᎳ", "X": "ХΧ", "Y": "УΥҮ", "Z": "ΖᏃ",
    "a": "аɑα", "c": "сϲ", "d": "ԁ", "e": "еҽ", "g": "ɡց", "h": "һհ", "i": "іιı", "j": "јϳ", "l": "ӏ", "n": "ո", "o": "оοօ", "p": "рρ",
    "q": "ԛզ", "s": "ѕ", "u": "սυ", "v": "ѵν", "w": "ԝ", "x": "х", "y": "уγү",
}
# Signs that look alike.
SIGNS = {"-": "‐‑‒–−⁃˗﹘", "'": "‘’ʼ′＇", '"': "“”″", ":": "ː∶꞉", ".": "․", ",": "‚", "/": "∕⁄", "|": "ǀ∣", "·": "‧・･•∙"}
# Radicals that have no compatibility mapping, each with its ideograph.
RADICALS = dict(zip("⺁⺅⺇⺉⺋⺎⺏⺒⺕⺗⺘⺙⺜⺝⺟⺠⺡⺢⺣⺤⺥⺨⺩⺪⺫⺬⺭⺮⺯⺰⺱⺳⺶⺷⺹⺼⺽⻀⻁⻂⻃⻄⻅⻆⻈⻉⻋⻌⻍⻎⻐⻑⻒⻓⻔⻖⻘⻙⻚⻛⻜⻝⻟⻠⻢⻣⻤⻥⻦⻧⻨⻩⻪⻫⻬⻭⻮⻯⻰⻲⻳", "厂亻几刂㔾兀尣巳彐心扌攵日月母民氵氺灬爫爫犭王疋目示礻竹糹纟罓网羊羊耂肉臼艹虎衤西西见角讠贝车辶辶辶钅長长长门阝青韦页风飞食飠饣马骨鬼鱼鸟卤麦黄黾斉齐歯齿竜龙龜龟"))
_VISIBLE_FORMAT = frozenset("؀؁؂؃؄؅۝܏࣢")
_SAME_SHAPE = ("<wide>", "<narrow>", "<noBreak>", "<compat>", "<font>")


def is_invisible(c: str) -> bool:
    o = ord(c)
    return (unicodedata.category(c) == "Cf" and c not in _VISIBLE_FORMAT) or 0xFE00 <= o <= 0xFE0F or 0xE0100 <= o <= 0xE01EF or o in (0x34F, 0x115F, 0x1160, 0x3164, 0x180B, 0x180C, 0x180D)


class UnionFind:
    def __init__(self) -> None:
        self.up: dict[str, str] = {}

    def root(self, x: str) -> str:
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def union(self, a: str, b: str) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def relations(points: list[str]) -> UnionFind:
    """Look-alike classes over the code points of a corpus and the strings they are the same as.  A letter with marks that is no code
    point of its own comes out by its letter and its marks."""
    uf = UnionFind()
    for kept, others in [*LETTERS.items(), *SIGNS.items(), *((v, k) for k, v in RADICALS.items())]:
        for o in others:
            uf.union(kept, o)
    for p in [*points, *list(uf.up)]:
        uf.root(p)
        if len(p) > 1:
            continue
        if is_invisible(p):
            uf.union("", p)
        elif p.isspace():
            uf.union(" ", p)
        else:
            how = unicodedata.decomposition(p)
            if how and (how[0] != "<" or how.startswith(_SAME_SHAPE)):
                same = unicodedata.normalize("NFKC", p)
                uf.union(p, same.strip() or " ")
    changed = True
    while changed:
        changed = False
        by_skeleton: dict[str, str] = {}
        for s in list(uf.up):
            if s:
                skeleton = "".join(uf.root(c) for c in unicodedata.normalize("NFD", s))
                if by_skeleton.setdefault(skeleton, s) != s:
                    changed |= uf.union(by_skeleton[skeleton], s)
    return uf


def rewriting(counts: dict[str, int]) -> dict[str, str]:
    """member -> representative, for every member that is not its class's representative."""
    uf = relations(list(counts))
    classes = defaultdict(list)
    for s in uf.up:
        classes[uf.root(s)].append(s)
    freq = lambda s: counts.get(s, 0) if len(s) == 1 else min((counts.get(c, 0) for c in s), default=0)
    out = {}
    for members in classes.values():
        kept = "" if "" in members else " " if " " in members else min(members, key=lambda s: (unicodedata.normalize("NFC", s) != s, -freq(s), len(s), s))
        out |= {m: kept for m in members if m != kept}
    return out


class Rewriter:
    def __init__(self, table: dict[str, str]):
        self.first = frozenset(s[0] for s in table)
        self.automaton = ahocorasick.Automaton()
        for s, kept in table.items():
            self.automaton.add_word(s, (len(s), kept))
        if table:
            self.automaton.make_automaton()

    def once(self, text: str) -> str:
        if self.first.isdisjoint(text):
            return text
        out, at = [], 0
        for end, (n, kept) in self.automaton.iter_long(text):
            out += (text[at : end - n + 1], kept)
            at = end + 1
        return "".join(out) + text[at:]

    def rewrite(self, text: str) -> str:
        """Until nothing changes: removing an invisible character may bring a mark to its base, and a base in its
        common form may compose with its mark.  Representatives are composed, so a round that composes nothing is the last but one."""
        for _ in range(len(text) + 5):
            new = unicodedata.normalize("NFC", self.once(text))
            if new == text:
                break
            text = new
        return text

    def key(self, text: str) -> str:
        """The form that equal-looking texts share, letter case and amount of blanks aside."""
        return re.sub(r"\s+", " ", self.rewrite(self.rewrite(text).lower())).strip()


def count_points(df: DataFrame, columns: list[str]) -> dict[str, int]:
    """How often each code point stands in the columns: at most one row per code point of Unicode is gathered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for b in batches:
            for col in b.columns:
                seen.update("\n".join(x for x in col.to_pylist() if x))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["p", "n"])

    rows = df.select(*columns).mapInArrow(run, "p string, n bigint").groupBy("p").agg(F.sum("n").alias("n"))
    return {r["p"]: r["n"] for r in rows.toLocalIterator()}


def look_keys(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """key, the columns, and for each column c its common form ``c_form`` and its comparison key ``c_key``."""
    shared = df.sparkSession.sparkContext.broadcast(rewriting(count_points(df, columns)))
    rows = spread(df.select(key, *columns))
    made: dict[int, Rewriter] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rewriter = made.setdefault(0, None) or made.setdefault(1, Rewriter(shared.value))
        for b in batches:
            data, names = list(b.columns), list(b.schema.names)
            for i, c in enumerate(columns):
                texts = b.column(i + 1).to_pylist()
                data += [pa.array([None if t is None else rewriter.rewrite(t) for t in texts], pa.string()), pa.array([None if t is None else rewriter.key(t) for t in texts], pa.string())]
                names += [f"{c}_form", f"{c}_key"]
            yield pa.RecordBatch.from_arrays(data, names=names)

    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, " + ", ".join(f"`{c}` string" for c in columns) + ", " + ", ".join(f"`{c}_form` string, `{c}_key` string" for c in columns))


def equal_looking_pairs(df: DataFrame, key: str, title: str, norm: str) -> DataFrame:
    """Pairs (key_a < key_b) whose titles look the same though ``title`` or ``norm`` (both non-null) differ.

    Variants (title, norm) of one look are paired first and only then expanded to their records, and only looks
    with more than one variant are looked at: a headline that many records share letter by letter costs nothing.
    """
    rows = look_keys(df, key, [title, norm]).select(key, F.col(title).alias("t"), F.col(norm).alias("n"), F.coalesce(f"{title}_key", f"{norm}_key").alias("look"))
    rows = rows.filter("look <> ''").withColumn("v", F.xxhash64(F.coalesce("t", F.lit("\u0001")), F.coalesce("n", F.lit("\u0001"))))
    rows = stash(rows, "looks-all")
    many = rows.groupBy("look").agg(F.min("v").alias("x"), F.max("v").alias("y")).filter("x <> y").select("look")
    rows = stash(rows.join(many, "look", "left_semi").distinct(), "looks")
    variants = rows.select("look", "v", "t", "n").distinct()
    other = variants.select("look", F.col("v").alias("w"), F.col("t").alias("t2"), F.col("n").alias("n2"))
    differ = ~F.col("t").eqNullSafe(F.col("t2")) | F.coalesce(F.col("n") != F.col("n2"), F.lit(False))
    pairs = variants.join(other, "look").filter((F.col("v") < F.col("w")) & differ).select("look", "v", "w")
    a = rows.select("look", "v", F.col(key).alias("x"))
    b = rows.select("look", F.col("v").alias("w"), F.col(key).alias("y"))
    return pairs.join(a, ["look", "v"]).join(b, ["look", "w"]).filter("x <> y").select(F.least("x", "y").alias(f"{key}_a"), F.greatest("x", "y").alias(f"{key}_b")).distinct()
