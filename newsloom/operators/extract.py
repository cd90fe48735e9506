"""Names of firms and public bodies in headlines, found by what ends them.

A name is a run of capitalised words that ends in a word of the sector (or body) table, or a run of two to six ideographs before
such a Chinese ending that begins at a border: the start, a blank, a sign, or one of the words that join two names.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions import text as X
from newsloom.operators import vocabulary as V

_HAN = r"[\x{4e00}-\x{9fff}]"
#: Signs and joining words before a Chinese name.
_BORDER = "^|[\\s\\p{P}]|与|和|对|批准|获"


def _latin(endings: list[str]) -> str:
    return r"((?:\p{Lu}[\p{L}'-]+ ){1,3}(?:" + "|".join(e.capitalize() for e in endings) + r"))(?:[^\p{L}]|$)"


def _chinese(endings: list[str]) -> str:
    return f"(?:{_BORDER})({_HAN}{{2,6}}?(?:" + "|".join(endings) + "))"


def _named(title: Column, latin: list[str], han: list[str]) -> Column:
    t = clean_candidate(title)
    return F.coalesce(*[F.nullif(F.regexp_extract(t, p, 1), F.lit("")) for p in (_latin(latin), _chinese(han))])


def headline_entity(title: Column, sectors: list = V.SECTORS) -> Column:
    """The first firm of a headline, Latin names first."""
    return _named(title, [s[0] for s in sectors], [s[1] for s in sectors])


def headline_institution(title: Column, bodies: list = V.BODIES) -> Column:
    """The first public body of a headline, Latin names first."""
    return _named(title, [b[0] for b in bodies], [b[1] for b in bodies])


def clean_candidate(name: Column) -> Column:
    """A candidate without wire marks before it ("UPDATE 1-", "Exclusive:", "更新："), quotes, brackets and what follows a comma or dash at its end."""
    t = F.regexp_replace(X.squeeze(name), r"^(?:(?:UPDATE \d+|RPT|CORRECTED|REFILE|EXCLUSIVE|Exclusive|Corrected|Follow-up|更新|更正|独家|跟进)\s*[-:：]\s*)+", "")
    t = F.regexp_replace(t, r"[\x{201c}\x{201d}\"“”【】《》]", " ")
    return F.regexp_replace(X.squeeze(t), r"[\s,，;；:：-]+$", "")


def looks_like_company(name: Column, sectors: list = V.SECTORS) -> Column:
    """Two to four capitalised words or three to eight ideographs, ending like a firm, without figures."""
    n = X.squeeze(name)
    latin = r"^(?:\p{Lu}[\p{L}'-]+ ){1,3}(?:" + "|".join(s[0].capitalize() for s in sectors) + ")$"
    chinese = f"^{_HAN}{{1,6}}(?:" + "|".join(s[1] for s in sectors) + ")$"
    return ~n.rlike("[0-9]") & (n.rlike(latin) | n.rlike(chinese))


def company_variants(name: Column) -> Column:
    """Spellings under which a firm is looked up: as written, without legal forms, and its leading words without the last one where two or more are left."""
    n = X.squeeze(name)
    bare = X.squeeze(F.regexp_replace(n, "(?i)[ ,.]*\\b(?:inc|ltd|corp|group|holdings|plc|co)\\.?$", ""))
    lead = F.regexp_extract(bare, r"^(\S+ \S+(?: \S+)*) \S+$", 1)
    return F.array_sort(F.array_distinct(F.filter(F.array(n, bare, lead, F.lower(bare)), lambda x: x != "")))
