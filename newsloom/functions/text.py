"""Scalar text functions as column expressions; none leaves the JVM."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Blanks of every kind.
BLANKS = r"[\s\p{Z}]+"
#: Query parameters that only track, and the prefix of a family of them.
TRACKING_PARAMS = ["oc", "src", "guccounter"]
TRACKING_PREFIX = "utm_"
#: Legal forms that are not part of a company's name.
LEGAL_FORMS = ["有限责任公司", "股份有限公司", "有限公司", "集团", "股份", "Inc", "Ltd", "Corp", "Group", "Holdings", "PLC"]
HAN = r"[\x{4e00}-\x{9fff}]"


def squeeze(c: Column) -> Column:
    """Trimmed, runs of blanks made one space."""
    return F.trim(F.regexp_replace(c, BLANKS, " "))


def title_key(c: Column) -> Column:
    return F.lower(squeeze(c))


def code_point(n: Column) -> Column:
    """The character of a code point; the replacement character where there is none."""
    good = n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
    return F.when(good, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")).otherwise("\ufffd")


def unescape(c: Column) -> Column:
    """Named entities (of HTML 4) and numeric ones as their character, once; anything else after an ampersand stays."""
    names = F.create_map(*[F.lit(x) for name, n in name2codepoint.items() for x in (name, chr(n))])

    def one(piece: Column) -> Column:
        body = F.regexp_extract(piece, r"^(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]*);", 1)
        hexed = F.conv(F.regexp_extract(body, "^#[xX](.+)", 1), 16, 10).cast("bigint")
        sign = F.when(body.rlike("^#[xX]"), code_point(hexed)).when(body.startswith("#"), code_point(F.substring(body, 2, 9).cast("bigint"))).otherwise(F.element_at(names, body))
        return F.coalesce(F.concat(sign, F.substr(piece, F.length(body) + 2)), F.concat(F.lit("&"), piece))

    pieces = F.split(c, "&")
    whole = F.concat(F.element_at(pieces, 1), F.array_join(F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces), F.lit(1))), one), ""))
    return F.when(F.contains(c, F.lit("&")), whole).otherwise(c)


def strip_html(c: Column) -> Column:
    """Entities become their signs first, then tags become blanks, so that escaped tags go too."""
    return squeeze(F.regexp_replace(unescape(c), "<[^>]+>", " "))


def _recoded(part: Column) -> Column:
    """A part of a query, decoded and encoded again: blanks as +, only letters, figures and _.-~ as they are."""
    plain = F.coalesce(F.try_url_decode(part), part)
    return F.replace(F.replace(F.url_encode(plain), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _without_tracking(c: Column) -> Column:
    base, query = F.regexp_extract(c, r"^([^?#]*)", 1), F.regexp_extract(c, r"^[^?#]*\?([^#]*)", 1)
    name = lambda p: F.substring_index(p, "=", 1)
    plain = lambda p: F.lower(F.coalesce(F.try_url_decode(name(p)), name(p)))
    kept = F.filter(F.split(query, "&"), lambda p: p.rlike("^[^=]+=.+") & ~plain(p).isin(TRACKING_PARAMS) & ~plain(p).startswith(TRACKING_PREFIX))
    kept = F.transform(kept, lambda p: F.concat(_recoded(name(p)), F.lit("="), _recoded(F.regexp_extract(p, "^[^=]+=(.*)", 1))))
    together = F.flatten(F.transform(F.array_distinct(F.transform(kept, name)), lambda n: F.filter(kept, lambda p: name(p) == n)))
    full = F.when(F.size(kept) > 0, F.concat(base, F.lit("?"), F.array_join(together, "&"))).otherwise(base)
    scheme = F.lower(F.regexp_extract(c, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    web = scheme.isin("http", "https")
    lowered = F.when(web, F.concat(scheme, F.substr(full, F.length(scheme) + 1))).otherwise(full)
    return F.when((scheme == "") | (web & c.rlike(r"(?i)^https?://[^/?#]+")), lowered).otherwise(F.when(c.isNotNull(), ""))


def canonical_url(c: Column) -> Column:
    """Without fragment, tracking and empty parameters, the others encoded alike and those of one name together; a click
    link gives its target; '' for other schemes than http(s) and for http(s) without a host; a link without a scheme stays."""
    click = c.rlike(r"(?i)^[a-z]+://[^/?#]*bing\.com[^/?#]*/([^?#]*/)?news/apiclick\.aspx([?#]|$)")
    target = F.regexp_extract(c, r"[?&]url=([^&#]+)", 1)
    once = F.coalesce(F.try_url_decode(target), target)
    twice = F.coalesce(F.try_url_decode(F.replace(once, F.lit("+"), F.lit("%2B"))), once)
    return _without_tracking(F.when(click & (target != ""), twice).otherwise(c))


def url_host(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(c, r"(?i)^https?://([^/?#:]+)", 1)), r"^www\.", "")


def skeleton(c: Column, most: int = 120) -> Column:
    """Lower case, without dates, only words with single blanks between."""
    bare = F.regexp_replace(title_key(c), r"[0-9]{1,4}(?:[./:-][0-9]{1,2})+", " ")
    return F.substring(F.trim(F.regexp_replace(bare, r"[^\p{L}\p{N}_]+", " ")), 1, most)


def focus(c: Column, most: int = 140) -> Column:
    """The first sentence of a headline."""
    return F.substring(F.trim(F.regexp_extract(squeeze(c), r"^([^。！？!?;；]*)", 1)), 1, most)


def language(*cs: Column) -> Column:
    return F.when(F.concat_ws(" ", *cs).rlike(HAN), "zh").otherwise("en")


def slug(c: Column) -> Column:
    """ASCII slug; long ones are cut and told apart by a hash, names without ASCII letters are a hash."""
    c = squeeze(c)
    s = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    mark = F.substring(F.sha1(c), 1, 12)
    return F.when(s == "", F.concat(F.lit("zh-"), mark)).when(F.length(s) > 80, F.concat(F.substring(s, 1, 64), F.lit("-"), mark)).otherwise(s)


def lookup_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "")


def company_key(c: Column) -> Column:
    """Name without legal forms and separators."""
    return F.lower(F.regexp_replace(F.regexp_replace(c, "(?:" + "|".join(LEGAL_FORMS) + ")", ""), r"[\s_,.-]+", ""))


def hashed_id(prefix: str, size: int, *parts: Column) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, size))
