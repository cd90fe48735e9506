"""Mapping freely typed names to the entry of a reference list that is meant.

Method: typed names and reference spellings are brought to one form (look-alikes, letter case, accents, traditional
characters, separators, legal forms).  A multi-pattern automaton over all canonical names and aliases finds the
mentions embedded in a name; the longest non-overlapping ones win, and count if what is left beside them is
nothing but wrapping ("shares of", legal forms, a ticker in brackets; leftover words of one or two letters count as such).
Remaining names go to a token-set similarity: pairs of words, with slips of the pen, cut short or abbreviated, weighted by how few
entries have the word; names without blanks that fit nothing are compared as sets of one joined word, Chinese names
as a whole with one slip or cut short.  When two entries are equally near the name is ``unmatched``, as it is when none is near.

The reference list is a small dimension table: it is read by the driver after a check of its size
(``MAX_SPELLINGS``; a longer list is refused) and sent to the workers, so typed names are never shuffled.

Defined results: null, empty and blank names are ``unmatched``; repeated rows of an id count once; a spelling that
two entries share belongs to neither.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.lookalikes import LETTERS, RADICALS, is_invisible

MAX_SPELLINGS = 500_000
UNMATCHED = "unmatched"
_HAN = "㐀-䶿一-鿿"
_FOLD = {ord(o): k for k, others in LETTERS.items() for o in others} | {ord(k): v for k, v in RADICALS.items()}
# Traditional characters common in names of firms and authorities, each followed by its simplified form.
_TRADITIONAL = "製制藥药學学機机車车電电業业銀银險险證证鋼钢鐵铁紡纺織织軟软體体遊游戲戏訊讯導导礦矿紙纸務务運运輸输貿贸會会員员長长東东國国華华廣广門门馬马魚鱼龍龙麗丽維维羅罗納纳薩萨倫伦蘭兰爾尔達达諾诺賽赛萊莱盧卢貝贝費费維维澤泽詩诗統统計计監监總总團团園园島岛灣湾漢汉陽阳陸陆雲云風风飛飞鳳凤鴻鸿齊齐聯联興兴榮荣寶宝財财資资產产農农畜畜糧粮飲饮餐餐飯饭館馆樓楼場场廠厂儀仪錶表鐘钟鏡镜燈灯纜缆線线網网絡络環环護护衛卫醫医療疗藝艺術术書书報报紅红綠绿藍蓝銅铜鋁铝鋅锌錫锡鎳镍鈦钛鋰锂氫氢氣气熱热燃燃點点億亿萬万與与當当發发開开關关際际進进遠远連连達达邊边選选遺遗郵邮鄉乡鄭郑醬酱釀酿釋释里里鑽钻鑫鑫閃闪間间閱阅隊队階阶隨随難难離离電电靈灵項项順顺須须領领頭头題题額额類类顯显騰腾驗验驛驿鮮鲜鳥鸟麥麦黃黄點点龐庞庫库應应廳厅張张強强彈弹復复徑径徵征態态慶庆戶户據据擇择損损換换揚扬搖摇攝摄攜携敵敌數数斷断時时晉晋曆历條条極极構构槍枪樂乐標标橋桥檔档權权歐欧歡欢歲岁歷历殘残殺杀氈毡決决沒没況况溫温滿满滅灭漁渔濟济濱滨無无煉炼煙烟營营爐炉爭争獎奖獨独瑪玛環环璽玺畫画異异疊叠療疗皺皱盜盗盤盘眾众礎础禮礼種种稱称穩稳競竞筆笔簡简籌筹約约級级紀纪純纯紐纽組组結结給给絕绝經经綜综緊紧編编練练縣县縮缩績绩繼继續续罰罚職职聖圣聞闻聲声腦脑膠胶臨临舉举艦舰蓋盖莊庄蔣蒋蕭萧藥药蘇苏蘋苹處处虛虚號号蟲虫補补裝装複复見见規规視视親亲覺觉觀观訂订討讨訓训記记設设許许訴诉評评詞词試试話话誠诚語语說说課课調调談谈請请論论諮咨謝谢識识譯译議议讀读變变讓让貨货責责貴贵買买賀贺賓宾賜赐賞赏賠赔質质賴赖購购贈赠趙赵趨趋跡迹軌轨軍军軸轴較较載载輕轻輝辉輪轮轉转辦办辭辞迴回邏逻鄰邻"
_SIMPLE = {ord(a): b for a, b in zip(_TRADITIONAL[::2], _TRADITIONAL[1::2])}
# Words that say nothing about which entry is meant.
WRAPPING = frozenset("the of and inc incorporated ltd limited corp corporation co company plc ag sa nv bv se spa oyj ab asa gmbh kg llc llp lp holdings holding group groep shares share stock stocks equity bonds units adr common class ordinary unit coltd".split())
WRAPPING_HAN = ["股份有限责任公司", "有限责任公司", "股份有限公司", "集团有限公司", "控股有限公司", "有限公司", "股份公司", "集团公司", "控股集团", "集团", "股份", "控股", "公司", "股票", "总署", "等公司", "等"]
_HAN_TAIL = re.compile("(?:" + "|".join(WRAPPING_HAN) + ")+$")


def plain(name: str) -> str:
    """One form for look-alikes, case, accents and traditional characters."""
    s = unicodedata.normalize("NFKC", "".join(c for c in name if not is_invisible(c))).translate(_FOLD)
    s = "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) != "Mn")
    return s.lower().translate(_SIMPLE)


def latin_tokens(text: str) -> list[str]:
    text = re.sub(r"\b(s\.a|n\.v|b\.v|a\.g|s\.p\.a|p\.l\.c|co\.\s*,?\s*ltd)\b\.?", lambda m: " " + re.sub(r"[.,\s]", "", m[0]) + " ", text)
    return re.findall(r"[a-z0-9]+", text)


def han_part(text: str) -> str:
    return re.sub(f"[^{_HAN}]", "", text)


def slips(a: str, b: str, most: int) -> int:
    """Edit distance with swapped neighbours counting one; most + 1 when larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            d = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            new.append(d)
        before, row = row, new
        if min(row) > most:
            return most + 1
    return row[-1]


def shorter(s: str, most: int) -> set[str]:
    """s and all that is left of it after dropping up to ``most`` characters."""
    out = layer = {s}
    for _ in range(most):
        layer = {x[:i] + x[i + 1 :] for x in layer for i in range(len(x))}
        out = out | layer
    return out


class Near:
    """Spellings within a few slips, found by the forms both have with characters dropped."""

    def __init__(self, most: int):
        self.most, self.at = most, defaultdict(set)

    def add(self, spelling: str, entry: str) -> None:
        for s in shorter(spelling, self.most):
            self.at[s].add((spelling, entry))

    def find(self, text: str, most: int) -> list[tuple[int, str]]:
        """(slips, entry) of the nearest entries; several only when they are equally near."""
        best: dict[str, int] = {}
        for s in shorter(text, min(most, self.most)):
            for spelling, entry in self.at.get(s, ()):
                d = slips(text, spelling, most)
                if d <= most and d < best.get(entry, 99):
                    best[entry] = d
        low = min(best.values(), default=0)
        return [(d, e) for e, d in best.items() if d == low]


def abbreviates(short: str, full: str) -> bool:
    """Cut short, or the first letter and others in order, possibly as a plural."""
    if len(short) < 2 or short[0] != full[0]:
        return False
    if len(short) >= 3 and full.startswith(short):
        return True
    it = iter(full)
    return len(short) >= 3 and all(c in it for c in short)


def akin(a: str, b: str) -> bool:
    """Forms of one word: abbreviated either way, of one stem, or a slip apart."""
    stem = len(a) >= 4 and len(b) >= 4 and a[:3] == b[:3]
    return stem or abbreviates(a, b) or abbreviates(b, a) or slips(a, b, 1) <= 1


#: Similarity that a name must have at least.
LEAST = 0.5


def pair_weight(a: str, b: str) -> float:
    """How surely two words are one: equal, a slip or two apart, abbreviated, of one stem; 0 if they are not."""
    if a == b:
        return 1.0
    if min(len(a), len(b)) >= 4 and slips(a, b, 2 if min(len(a), len(b)) >= 10 else 1) <= (2 if min(len(a), len(b)) >= 10 else 1):
        return 0.9
    if abbreviates(a, b) or abbreviates(b, a):
        return 0.8
    return 0.7 if len(a) >= 4 and len(b) >= 4 and a[:3] == b[:3] else 0.0


def token_set_similarity(typed: list[str], words: tuple[str, ...], worth: dict[str, float]) -> float:
    """Worth of the best pairs by the worth of all words of either set; 0 unless every typed word has a pair and the
    spelling's most telling word is written, but for slips, in full."""
    worth = {x: worth[x] * (1.0 if x == words[0] else 0.3) for x in words}  # a name leads with what tells it from others
    left, total, most = list(words), 0.0, max(words, key=lambda x: worth[x])
    for t in sorted(typed, key=lambda t: -max((pair_weight(t, x) for x in words), default=0.0)):
        weight, x = max(((pair_weight(t, x), x) for x in left), default=(0.0, ""))
        if weight == 0.0 or (x == most and weight < 0.9):
            return 0.0
        left.remove(x)
        total += weight * worth[x]
    return 0.0 if most in left else total / sum(worth[x] for x in words)


class Matcher:
    def __init__(self, spellings: list[tuple[str, str]]):
        """spellings: (canonical id, spelling)."""
        owners: dict[str, set[str]] = defaultdict(set)
        self.exact = set()
        self.latin, self.han = Near(2), Near(1)
        self.by_word: dict[str, set[tuple[tuple[str, ...], str]]] = defaultdict(set)  # word, or a word less one letter -> spellings with it
        self.prefix: dict[str, set[str]] = defaultdict(set)
        for entry, raw in spellings:
            p = plain(raw)
            z, w = han_part(p), [t for t in latin_tokens(re.sub(f"[{_HAN}]", " ", p)) if t not in WRAPPING]
            if z and not w:
                z = _HAN_TAIL.sub("", z) or z
                owners[z].add(entry)
                self.han.add(z, entry)
                for n in range(3, len(z)):
                    self.prefix[z[:n]].add(entry)
            elif w:
                owners[" ".join(w)].add(entry)
                for word in w:
                    for s in shorter(word, 1) if len(word) >= 4 else {word}:
                        self.by_word[s].add((tuple(w), entry))
                if len(w) > 1:
                    self.latin.add("".join(w), entry)
                    self.latin.add("".join(sorted(w)), entry)
        # a word of many entries says little about which one is meant
        having: dict[str, set[str]] = defaultdict(set)
        for spelled in self.by_word.values():
            for words, entry in spelled:
                for word in words:
                    having[word].add(entry)
        self.worth = {word: 1 / len(entries) for word, entries in having.items()}
        self.automaton = ahocorasick.Automaton()
        for spelling, entries in owners.items():
            if len(entries) == 1:
                self.automaton.add_word(spelling, (spelling, next(iter(entries))))
        if owners:
            self.automaton.make_automaton()
        self.memo: dict[str, str] = {}

    def match(self, name: str | None) -> str:
        if not name:
            return UNMATCHED
        got = self.memo.get(name)
        if got is None:
            if len(self.memo) >= 200_000:
                self.memo.clear()
            got = self.memo[name] = self.find(name)
        return got

    def find(self, name: str) -> str:
        text = plain(name)
        tick = re.match(r"\s*\$?([a-z]{2,6})\s+[-–:|]\s+(?=\S)", text)  # a ticker before the name
        if tick:
            text = text[tick.end() :]
        bare = re.sub(r"[(（\[【][^)）\]】]*(?:[)）\]】]|$)", " ", text)  # what stands in brackets comes second
        for t in (bare, text) if bare.strip() else (text,):
            entry = self.mentioned(t) or self.similar(t)
            if entry:
                return entry
        return (tick and self.mentioned(tick[1])) or UNMATCHED

    def mentioned(self, text: str) -> str | None:
        """The one entry whose spelling is embedded, if only wrapping is left beside it."""
        z, w = han_part(text), latin_tokens(re.sub(f"[{_HAN}]", " ", text))
        line = " ".join(w)
        found, rest = set(), []
        for s, is_han in ((z, True), (line, False)):
            at = 0
            left = []
            if s and len(self.automaton):
                for end, (spelling, entry) in self.automaton.iter_long(s):
                    start = end - len(spelling) + 1
                    whole = is_han or ((start == 0 or s[start - 1] == " ") and (end + 1 == len(s) or s[end + 1] == " "))
                    if whole and start >= at:
                        found.add(entry)
                        left.append(s[at:start])
                        at = end + 1
            left.append(s[at:])
            rest.append(left)
        if len(found) != 1:
            return None
        han_left = "".join(_HAN_TAIL.sub("", x) for x in rest[0])
        words_left = [t for x in rest[1] for t in x.split() if t not in WRAPPING and not (len(t) <= 2)]
        return next(iter(found)) if not han_left and not words_left else None

    def similar(self, text: str) -> str | None:
        z, w = han_part(text), [t for t in latin_tokens(re.sub(f"[{_HAN}]", " ", text)) if t not in WRAPPING]
        if z:
            return self.similar_han(_HAN_TAIL.sub("", z) or z)
        return self.by_tokens(w) if w else None

    def by_tokens(self, w: list[str]) -> str | None:
        """The entry whose set of words is most similar (``token_set_similarity``); ``LEAST`` of similarity is needed, and of two equally similar entries neither is meant.  Names
        whose words are run together or cut apart otherwise are compared as sets of the one joined word."""
        found: set[tuple[tuple[str, ...], str]] = set()
        for t in w:
            for s in shorter(t, 1) if len(t) >= 4 else {t}:
                found |= self.by_word.get(s, set())
        best: dict[str, float] = {}
        for words, entry in found:
            s = token_set_similarity(w, words, self.worth)
            if s >= LEAST:
                best[entry] = max(best.get(entry, 0.0), s)
        if not best and len(joined := "".join(w)) >= 7:
            most = 2 if len(joined) >= 10 else 1
            for form in {joined, "".join(sorted(w))}:
                for d, entry in self.latin.find(form, most):
                    best[entry] = max(best.get(entry, 0.0), 1 - d / len(joined))
        top = max(best.values(), default=0.0)
        leaders = [e for e, s in best.items() if s > top - 1e-9]
        return leaders[0] if len(leaders) == 1 else None

    def similar_han(self, z: str) -> str | None:
        if len(z) < 3:
            return None
        if len(owners := self.prefix.get(z, ())) == 1:
            return next(iter(owners))
        near = self.han.find(z, 1) if len(z) >= 4 else []
        if len({e for _, e in near}) == 1:
            return near[0][1]
        if len(z) >= 4 and not near:  # cut short, and one slip
            fits = {e for i in range(len(z)) for p, owners in self._wild(z, i) for e in owners}
            if len(fits) == 1:
                return next(iter(fits))
        return None

    def _wild(self, z: str, i: int):
        if not hasattr(self, "gaps"):
            self.gaps = defaultdict(set)
            for p, owners in self.prefix.items():
                for k in range(len(p)):
                    self.gaps[p[:k] + "\0" + p[k + 1 :]] |= owners
        owners = self.gaps.get(z[:i] + "\0" + z[i + 1 :])
        return [(z, owners)] if owners else []


_matchers: dict[int, Matcher] = {}


def matcher_for(name: int, shared) -> Matcher:
    """The matcher of a broadcast list: one a worker process, not one a task."""
    if name not in _matchers:
        _matchers.clear()
        _matchers[name] = Matcher(shared.value)
    return _matchers[name]


def map_names(df: DataFrame, key: str, name: str, reference: DataFrame, entry: str, spellings: list[str]) -> DataFrame:
    """key, canonical_id (or ``unmatched``) of every row of ``df``."""
    both = None
    for c in spellings:
        part = reference.select(F.col(entry).alias("e"), F.col(c).alias("s")).filter("e is not null and trim(s) <> ''")
        both = part if both is None else both.unionByName(part)
    listed = [(r["e"], r["s"]) for r in both.distinct().limit(MAX_SPELLINGS + 1).collect()]
    if len(listed) > MAX_SPELLINGS:
        raise ValueError(f"the reference list has more than {MAX_SPELLINGS} spellings")
    listed.sort()
    shared, name_of = df.sparkSession.sparkContext.broadcast(listed), hash(tuple(listed))
    rows = df.select(key, F.col(name).alias("_name"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = matcher_for(name_of, shared)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([matcher.match(x) for x in b.column(1).to_pylist()], pa.string())], names=[key, "canonical_id"])

    return rows.mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, canonical_id string").distinct()
