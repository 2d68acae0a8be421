"""Link, entity, robots and sitemap expressions over whole page texts."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .urls import resolve_sql
from .values import let, sql_let

# One pass over the page: comments and raw-text elements are consumed as matches of their own,
# so anchors inside them are never seen; group 2 is set only for a start tag <a ... href=value>.
# Possessive quantifiers keep the matcher iterative and free of backtracking.
_HREF = (
    r"(?is)<(?:!--.*?(?:-->|\z)"
    r"|(?<raw>script|style|textarea|title|xmp|iframe|noembed|noframes)\b.*?(?:</\k<raw>\b|\z)"
    r"|a(?=[\s/])"
    r"(?:[\s/]++|(?!href[\s=/>])[^\s\"'>/=][^\s>/=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>][^\s>]*+)?+)?+)*+"
    r"href\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s\"'>][^\s>]*+))"
)
# A reference, its semicolon included if it has one; a name before an equals sign needs one.
_ENTITY_RUNS = r"(?s)(&(?:#[0-9]++;?+|#[xX][0-9A-Fa-f]++;?+|[A-Za-z][A-Za-z0-9]*+(?:;|(?!=)))|[^&]++|&)"
_XML_RUNS = r"(?s)(&(?:#[0-9]++|#[xX][0-9A-Fa-f]++|[A-Za-z][A-Za-z0-9]*+);|[^&]++|&)"

# Named references come from the standard library's table, which has some without a semicolon too;
# XML knows these five only.
_XML_NAMES = {"amp;": "&", "lt;": "<", "gt;": ">", "quot;": '"', "apos;": "'"}


def _char(code: str) -> str:
    """SQL: character of a code point; U+FFFD for those no text may hold."""
    return sql_let(
        "code",
        code,
        "case when code > 0 and code <= 1114111 and not code between 55296 and 57343"
        " then decode(unhex(lpad(hex(code), 8, '0')), 'UTF-32') else '�' end",
    )


def _number(x: str) -> str:
    """SQL: the character of a numeric reference of any length. Beyond 7 digits no code point is left."""
    digits = rf"regexp_extract(run, r'^&#{'[xX]' if x else ''}0*([0-9A-Fa-f]*);?$', 1)"
    value = "cast(conv(d, 16, 10) as bigint)" if x else "cast(if(d = '', '0', d) as bigint)"
    return _char(sql_let("d", digits, f"case when length(d) > 7 then 1114112 when d = '' then 0 else {value} end"))


def _decoded(t: str, names: dict[str, str]) -> str:
    """SQL: character references replaced in one pass, so that a decoded ``&`` starts no new one."""
    # Apostrophes are written as JSON escapes: a raw SQL literal cannot hold them.
    table = json.dumps(names).replace("'", "\\u0027")
    decode_run = (
        "case when run = '&amp;' then '&' when not run rlike r'^&.+$' then run"
        " when run rlike r'^&#[xX]' then "
        + _number("x")
        + " when startswith(run, '&#') then "
        + _number("")
        + f" else coalesce(try_element_at(from_json(r'{table}', 'map<string,string>'), substring(run, 2)), run) end"
    )
    return (
        f"case when contains({t}, '&') then array_join(transform("
        f"regexp_extract_all({t}, r'{_XML_RUNS if names is _XML_NAMES else _ENTITY_RUNS}', 1), run -> {decode_run}), '') else {t} end"
    )


def _href_value(raw: str) -> str:
    """SQL: value of one attribute text: quotes off, character references decoded."""
    bare = rf"case when {raw} rlike r'^[\x22\x27]' then substring({raw}, 2, length({raw}) - 2) else {raw} end"
    return sql_let("bare", bare, _decoded("bare", html5))


def decode_entities(c: Column, *, xml: bool = False) -> Column:
    return let(c, f"t -> {_decoded('t', _XML_NAMES if xml else html5)}")


def raw_hrefs(page: Column) -> Column:
    """Attribute texts of every ``a[href]`` in page order, still quoted and encoded."""
    return F.array_remove(F.regexp_extract_all(page, F.lit(_HREF), F.lit(2)), "")


def href_text(raw: Column) -> Column:
    return let(raw, f"raw -> {_href_value('raw')}")


def page_links(page: Column, base: Column) -> Column:
    """Array of the resolved targets of a page's non-empty ``a[href]``, unparseable ones left out."""
    found = raw_hrefs(page)
    resolved = sql_let(
        "href", _href_value("attr"), f"case when href = '' then null else {resolve_sql('href', 'doc.base')} end"
    )
    parts = F.struct(found.alias("found"), base.alias("base"))
    return let(parts, f"doc -> array_compact(transform(doc.found, attr -> {resolved}))")


def is_html(content_type: Column) -> Column:
    return F.coalesce(content_type.contains("text/html"), F.lit(False))


def robots_sitemap(body: Column) -> Column:
    """Address on the first ``Sitemap:`` line; NULL without such a line, ``''`` when it is empty."""
    line = F.get(F.filter(F.split(body, "\n"), lambda l: F.lower(l).startswith("sitemap:")), F.lit(0))
    return F.regexp_replace(F.regexp_replace(line, r"^[^:]*:", ""), r"(?U)^[\s﻿]+|[\s﻿]+$", "")


def is_sitemap_index(body: Column) -> Column:
    return F.coalesce(body.rlike(r"<sitemapindex[\s/>]"), F.lit(False))


def sitemap_locs(body: Column) -> Column:
    """``loc`` texts of a sitemap (under ``url``) or a sitemap index (under ``sitemap``).

    Pattern-based, so that a cut-off file still yields the entries before the cut.
    """

    def entries(tag: str) -> str:
        return rf"regexp_extract_all(xml, r'(?s)<{tag}(?:\s[^>]*+)?>(.*?)(?:</{tag}\s*>|\z)', 1)"

    text = (
        r"case when contains(loc, '<![CDATA[') then regexp_replace(loc, r'(?s)<!\[CDATA\[(.*?)\]\]>', '$1')"
        f" else {_decoded('loc', _XML_NAMES)} end"
    )
    blocks = (
        r"case when xml rlike r'<sitemapindex[\s/>]' then " + entries("sitemap")
        + r" when xml rlike r'<urlset[\s/>]' then " + entries("url") + " end"
    )
    locs = f"transform(flatten(transform({blocks}, block -> {entries('loc').replace('xml,', 'block,')})), loc -> {text})"
    return let(F.regexp_replace(body, r"(?s)<!--.*?(?:-->|\z)", ""), f"xml -> {locs}")
