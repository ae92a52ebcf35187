"""Scalar functions as column expressions: identity, titles, periods, similarity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data model: white space that canonical forms trim, exchanges by code prefix, ordinal digits and units.
UNICODE_BLANKS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0                　"
EXCHANGES = {"6": "SSE", "0": "SZSE", "3": "SZSE", "4": "BSE", "8": "BSE"}


def body_status(title: Column, body: Column) -> Column:
    """heading_only for a title without text, empty for neither, else content."""
    blank = F.coalesce(body, F.lit("")) == ""
    return F.when(blank & (F.coalesce(title, F.lit("")) != ""), "heading_only").when(blank, "empty").otherwise("content")


def source_tier(kind: Column, briefings: Sequence[str]) -> Column:
    return F.when(kind.isin(*briefings), "tier_0b").otherwise("tier_0a")


def percent_encoded(segment: Column) -> Column:
    """RFC 3986 with nothing but the unreserved characters left as they are."""
    encoded = F.url_encode(segment)
    for old, new in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        encoded = F.replace(encoded, F.lit(old), F.lit(new))
    return encoded


def asset_uri(service: str, version: int, kind: str, ident: Column) -> Column:
    return F.concat(F.lit(f"asset://{service}/v{version}/{kind}/"), percent_encoded(ident))


def canonical_code(code: Column) -> Column:
    return F.upper(F.trim(code, F.lit(UNICODE_BLANKS)))


def exchange_of(code: Column) -> Column:
    first = F.substring(code, 1, 1)
    chain = F.when(F.lit(False), F.lit(None).cast("string"))
    for prefix, name in EXCHANGES.items():
        chain = chain.when(first == prefix, name)
    return chain


def canonical_security(code: Column, exchange: Column) -> Column:
    """struct(code, exchange, error): a given exchange must agree with the code's."""
    clean = canonical_code(code)
    derived, given = exchange_of(clean), F.upper(F.trim(exchange))
    error = F.when(clean == "", "blank code").when(given.isNotNull() & derived.isNotNull() & (given != derived), "exchange mismatch")
    return F.struct(clean.alias("code"), F.coalesce(given, derived).alias("exchange"), error.alias("error"))


def report_period(title: Column, kind: Column) -> Column:
    """``2024A`` for annual and ``2024Q3`` for quarterly reports; null where the title has no year or no quarter."""
    year = F.nullif(F.regexp_extract(title, r"((?:19|20)\d{2})", 1), F.lit(""))
    quarter = F.nullif(F.regexp_extract(title, r"Q([1-4])", 1), F.lit(""))
    return F.when(kind == "annual", F.concat(year, F.lit("A"))).when(kind == "interim", F.concat(year, F.lit("Q2"))).when(kind == "quarterly", F.concat(year, F.lit("Q"), quarter))


def semantic_key(parts: Mapping[str, Column]) -> Column:
    """name=value joined by "|"; a missing value is written None."""
    return F.concat_ws("|", *[F.concat(F.lit(f"{name}="), F.coalesce(value.cast("string"), F.lit("None"))) for name, value in parts.items()])


def prefixed_sha256(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def folded_crc32(text: Column) -> Column:
    """CRC-32 as a signed 32-bit number."""
    value = F.crc32(text)
    return F.when(value >= 2**31, value - 2**32).otherwise(value)


def canonical_title(title: Column) -> Column:
    """Lower case without leading numbering, continuation marks and punctuation; runs of blanks are one."""
    out = F.lower(title)
    for pattern, put in (
        (r"^\s*(?:[(（]?(?:\d+(?:\.\d+)*|[一二三四五六七八九十百]+)[)）.、]?\s+|[(（][^)）]{1,4}[)）]\s*)", ""),
        (r"[(（](?:续|continued)[)）]\s*$", ""),
        (r"[及与]", "和"),
        (r"[\s\p{Punct}]+", " "),
    ):
        out = F.regexp_replace(out, pattern, put)
    return F.trim(out)


def characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def grams(text: Column, n: int) -> Column:
    """Distinct characters (n = 1) or pairs of neighbouring ones (n = 2), in time proportional to the text's length."""
    found = characters(text)
    if n == 2:
        # The characters are named by a list of one, so that the text is cut once and not wherever they stand.
        paired = lambda all: F.zip_with(all, F.slice(all, F.lit(2), F.greatest(F.size(all), F.lit(1))), lambda x, y: F.concat(x, y))
        found = F.array_compact(F.transform(F.array(found), paired)[0])
    elif n != 1:
        raise ValueError("grams of one or two characters only")
    return F.array_distinct(found)


#: Characters of the shortest text that is likened to another.
SHORTEST = 4


def blend(one_shared: Column, one_right: Column, two_shared: Column, two_left: Column, two_right: Column) -> Column:
    """0.6 of the coverage of the right's characters plus 0.4 of the bigrams' Dice coefficient, from numbers of distinct grams."""
    return 0.6 * (one_shared / one_right) + 0.4 * (2 * two_shared / (two_left + two_right))


def title_similarity(left: Column, right: Column, shortest: int = SHORTEST) -> Column:
    """The blend of coverage and Dice coefficient; 0 if either is short."""
    one_l, one_r, two_l, two_r = grams(left, 1), grams(right, 1), grams(left, 2), grams(right, 2)
    alike = blend(F.size(F.array_intersect(one_l, one_r)), F.size(one_r), F.size(F.array_intersect(two_l, two_r)), F.size(two_l), F.size(two_r))
    return F.when((F.length(left) < shortest) | (F.length(right) < shortest), F.lit(0.0)).otherwise(alike)


NUMBERING = [
    ("chapter", 1, r"^\s*(?:第[一二三四五六七八九十百\d]+[章节]|chapter\s+\d+)"),
    ("cjk_list", 2, r"^\s*[一二三四五六七八九十]+、"),
    ("cjk_bracket", 3, r"^\s*[(（][一二三四五六七八九十]+[)）]"),
    ("decimal", 4, r"^\s*\d+\.\d+"),
    ("number", 4, r"^\s*\d+[.、]"),
    ("bracket", 5, r"^\s*[(（]\d+[)）]"),
    ("letter", 6, r"^\s*[a-zA-Z][.)]"),
]


def numbering(title: Column) -> Column:
    """struct(family, rank) of the first numbering form that a heading has; nulls without one."""
    family = reduce(lambda chain, n: chain.when(title.rlike(n[2]), n[0]), NUMBERING, F.when(F.lit(False), F.lit(None).cast("string")))
    rank = reduce(lambda chain, n: chain.when(title.rlike(n[2]), n[1]), NUMBERING, F.when(F.lit(False), F.lit(None).cast("int")))
    return F.struct(family.alias("family"), rank.alias("rank"))


def suspicious_glyphs(text: Column) -> Column:
    """At least 24 visible characters, none Chinese, 45 % punctuation or more, 12 different or more: text of a wrong encoding."""
    visible = F.regexp_replace(text, r"\s+", "")
    marks = F.length(visible) - F.length(F.regexp_replace(visible, r"[\p{Punct}]", ""))
    distinct = F.size(F.array_distinct(characters(visible)))
    return (F.length(visible) >= 24) & ~visible.rlike(r"[一-鿿]") & (marks >= 0.45 * F.length(visible)) & (distinct >= 12)


CROCKFORD = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"


def ulid_millis(ulid: Column) -> Column:
    """Milliseconds since 1970 that the first ten characters of a ULID say."""
    digits = F.transform(F.sequence(F.lit(1), F.lit(10)), lambda i: F.instr(F.lit(CROCKFORD), F.substring(F.upper(ulid), i, F.lit(1))) - 1)
    return F.aggregate(digits, F.lit(0).cast("long"), lambda total, d: total * 32 + d)


def excerpt(text: Column, start: int, n: int) -> Column:
    """struct(text, start, end, sha256) of a part of a text, by characters."""
    part = F.substring(text, start + 1, n)
    return F.struct(part.alias("text"), F.lit(start).alias("start"), (F.lit(start) + F.length(part)).alias("end"), prefixed_sha256(part).alias("sha256"))
