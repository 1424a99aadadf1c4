"""HTML fields as Spark expressions, and one parser in Python for nested containers.

``tokens`` reads a page once, inside the JVM, into its tags and the text between them; title, date,
summary and links are looked up among these. The patterns give nothing back once they have taken it
(possessive), so no page makes them recurse or try again: not unbalanced quotes, nor a tag with very
many attributes. Text of a container whose extent depends on balanced tags needs a parser:
``elements_in`` gives the elements inside each container as an array, and Spark expressions do the rest.

What the Python functions give is put behind an ``explode`` before it is filtered (``once``): Spark
then does not run them a second time in a filter below, while filters on other columns still go
down to the scan. They take plain rows, of which Spark sends a hundred at a time: ten thousand pages, as
an Arrow batch has them, may be more than a worker can hold.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from html import unescape as unescape_text

from pyspark.sql import Column
from pyspark.sql import functions as F

ELEMENTS = "array<struct<container:int,tag:string,classes:string,href:string,datetime:string,text:string>>"
READ = f"found:{ELEMENTS},error:string"
#: Signs of text that the elements of one page may hold together in a worker.
MOST_TEXT = 64 << 20

# Elements that are one token, elements whose text is not read, and those that never have content.
RAW = frozenset(("script", "style"))
UNREAD = frozenset(("template",))
VOID = frozenset((
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
))

# A value that is not closed is none: its quote then begins an attribute, or is part of a bare value.
_VALUE = r"""(?:\s*+(?:=++\s*+(?:'[^']*+'|"[^"]*+"|(?!['"])[^>\s]*+)|=++\s++|(?:=(?==))++=[^>\s]*+))?+"""
_ATTRIBUTE = rf"""(?<=['"\s/])[^\s/>][^\s/=>]*+{_VALUE}"""
_NAME = r"[a-zA-Z][^\t\n\r\f />\x00]*+"
_START = rf"<{_NAME}[\s/]*+(?:{_ATTRIBUTE}(?:\s|/(?!>))*+)*+\s*+/?+>"
_UNREAD = rf"""<(script|style)(?=[\t\n\r\f >/])(?:\s|/(?!>))*+(?:{_ATTRIBUTE}(?:\s|/(?!>))*+)*+>.*?(?:</\s*+\1\s*+>|\z)"""
_COMMENT = r"<!--.*?--\s*+>"
_MARKUP = rf"<(?:/(?=[^>])|\?|!(?!--))[^>]*+>|</>|{_UNREAD}|{_START}"
# what looks like a tag but is not closed as one is text up to the next >, or to the end if there is none
_TEXT = rf"<{_NAME}(?=\x00)|<(?:[a-zA-Z]|!--)[^>]*+>|<(?=[a-zA-Z/!?])[^>]*+\z|[^<]++|<"
_TOKEN = rf"(?is){_COMMENT}|<!--.*+|{_MARKUP}|{_TEXT}"
_TOKEN_AFTER_OPEN_COMMENT = rf"(?is){_MARKUP}|{_TEXT}"

# The same in Python, for one token.
_START_NAME = re.compile(rf"<({_NAME})")
_END_NAME = re.compile(r"</(?:\s*+([a-zA-Z][-.a-zA-Z0-9:_]*+)\s*+>|([a-zA-Z][^\t\n\r\f />\x00]*+))", re.A)
_NEXT_ATTRIBUTE = re.compile(rf"(?:\s|/(?!>))*+({_ATTRIBUTE})", re.A)
_NAME_AND_VALUE = re.compile(r"([^\s/>][^\s/=>]*+)\s*+(=.*)?\Z", re.A | re.S)


def once(column: Column) -> Column:
    """The value as a row of its own, computed once; rows without a value are left out."""
    return F.explode(F.array_compact(F.array(column)))


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def tokens(html: Column) -> Column:
    """The page as an array of its tags and the texts between them, in order; null for no page.

    Read as ``html.parser`` does: quoted values hold any sign, a script or style is one token to its end
    tag, and what is not closed is text. Marked sections (``<![``) end at the next ``>``.
    """
    def whole(found: Column) -> Column:
        last = F.get(found, F.size(found) - 1)
        is_open = last.startswith("<!--") & ~last.rlike(rf"(?s)\A{_COMMENT}\z")
        # after a comment that is not closed no other one is
        rest = F.regexp_extract_all(last, F.lit(_TOKEN_AFTER_OPEN_COMMENT), F.lit(0))
        return F.when(is_open, F.concat(F.slice(found, F.lit(1), F.size(found) - 1), rest)).otherwise(found)

    return _bind(F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(0)), whole)


def is_start(token: Column, tag: str) -> Column:
    """Is it an opening ``tag``?"""
    near = F.lower(F.substring(token, 1, len(tag) + 1)) == f"<{tag}"
    return near & token.rlike(rf"(?is)\A(?=<{tag}[\t\n\r\f />\x00])(?:{_UNREAD}|{_START})\z")


def is_end(token: Column, tag: str) -> Column:
    """Is it a closing ``tag``?"""
    return token.startswith("</") & token.rlike(rf"(?i)\A</(?:\s*+{tag}\s*+>|{tag}[\t\n\r\f />\x00])")


def is_text(token: Column) -> Column:
    """Is it text, and no tag, comment, script or style?"""
    return ~token.startswith("<") | ~token.rlike(rf"(?is)\A(?:{_COMMENT}|{_MARKUP})\z")


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of an opening tag, references still encoded; the last one if it is there
    more than once, null without a value."""
    def is_own(a: Column) -> Column:
        return (F.lower(F.substring(a, 1, len(name))) == name) & a.rlike(rf"(?s)\A.{{{len(name)}}}(?:[\s=]|\z)")

    def value(a: Column) -> Column:
        given = F.regexp_extract(a, rf"(?s)\A.{{{len(name)}}}\s*+(=.*+)?+\z", 1)
        quoted = given.rlike(r"""(?s)\A=++\s*+(?:"[^"]*+"|'[^']*+')\z""")
        return (
            F.when(given == "", F.lit(None).cast("string"))
            .when(quoted, F.regexp_extract(given, r"(?s)\A=++\s*+.(.*).\z", 1))
            .when(given.rlike(r"""\A={2,}+['"]"""), F.regexp_replace(given, r"\A=++", "="))
            .otherwise(F.regexp_replace(given, r"\A=++\s*+", ""))
        )

    each = F.regexp_extract_all(tag, F.lit(rf"(?is)\G(?:\A<{_NAME})?+(?:\s|/(?!>))*+({_ATTRIBUTE})"), F.lit(1))
    return _bind(F.filter(each, is_own), lambda own: value(F.get(own, F.size(own) - 1)))


def has_class(tag: Column, name: str) -> Column:
    """Is ``name``, in its own case, among the classes of an opening tag?"""
    return F.coalesce(F.array_contains(F.split(attribute(tag, "class"), r"\s+"), name), F.lit(False))


def _fits(token: Column, tag: str, cls: str | None, where: tuple[str, str] | None) -> Column:
    found = is_start(token, tag)
    if cls:
        found = found & has_class(token, cls)
    if where:
        found = found & attribute(token, where[0]).eqNullSafe(where[1])
    return found


def first_text(page: Column, tag: str, cls: str | None = None, where: tuple[str, str] | None = None) -> Column:
    """Text of the first such element among the tokens of a page, up to its end tag or else to the end,
    references still encoded; null when there is none. ``where`` is an attribute and its value."""
    def joined(rest: Column) -> Column:
        end = F.array_min(F.transform(rest, lambda t, i: F.when(is_end(t, tag), i)))
        inside = F.slice(rest, F.lit(1), F.coalesce(end, F.size(rest)))
        return F.array_join(F.filter(inside, is_text), "")

    start = F.array_min(F.transform(page, lambda t, i: F.when(_fits(t, tag, cls, where), i)))
    return _bind(start, lambda at: F.when(at.isNotNull(), _bind(F.slice(page, at + 2, F.size(page)), joined)))


def first_tag(page: Column, tag: str, cls: str | None = None) -> Column:
    """The first such opening tag among the tokens of a page; null when there is none."""
    return F.get(F.filter(page, lambda t: _fits(t, tag, cls, None)), F.lit(0))


def anchors(page: Column, cls: str | None = None) -> Column:
    """Link targets of all such anchors that have one, in page order, from the tokens of a page."""
    found = F.transform(F.filter(page, lambda t: _fits(t, "a", cls, None)), lambda t: attribute(t, "href"))
    return F.filter(found, lambda h: h.isNotNull())


def unescape(column: Column) -> Column:
    """Character references decoded."""

    @F.udf("string", useArrow=False)
    def decode(text):
        return None if text is None else unescape_text(text)

    return decode(column)


def read_elements(
    html: Column, tag: str, cls: str | None, wanted: tuple[str, ...], text: tuple[str, ...] = (), *,
    nested: bool = True, most_text: int = MOST_TEXT,
) -> Column:
    """(found, error): elements named in ``wanted`` inside each ``tag`` (class ``cls``), in page order.

    Tags are closed only by their own end tag or an outer one, so an unclosed paragraph holds the
    text of the paragraphs after it; the text of many of these grows with their square. With
    ``nested=False`` a wanted tag ends an open one of its name in the same container, and all texts
    together are no longer than the page. ``container`` numbers the containers of a page from 0; one
    with no wanted element still gives one entry, with a null tag. The text is given for the
    elements named in ``text`` only. Pages that do not name the class are not sent to Python.

    What goes wrong with a page is its ``error`` (then nothing is found), and no other page's: texts of
    more than ``most_text`` signs together, or what Python says.
    """

    @F.udf(f"struct<{READ}>", useArrow=False)
    def parse(page):
        if page["tokens"] is None:
            return None, None
        try:
            return _elements(page["tokens"], page["texts"], tag, cls, wanted, text, nested, most_text), None
        except Exception as problem:  # one page must not end the others
            return [], f"{type(problem).__name__}: {problem}"

    def both(page: Column) -> Column:
        return parse(_bind(tokens(page), lambda t: F.struct(t.alias("tokens"), F.transform(t, is_text).alias("texts"))))

    if cls is None:
        return both(html)
    named = html.contains(cls)
    none = F.struct(F.array().cast(ELEMENTS).alias("found"), F.lit(None).cast("string").alias("error"))
    return F.when(html.isNull() | named, both(F.when(named, html))).otherwise(none)


def _attributes(token: str, at: int) -> tuple[dict[str, str | None], int]:
    """Attributes of an opening tag, whose name ends at ``at``, with references decoded, and where they end.

    Of each name the last one counts.
    """
    out = {}
    while found := _NEXT_ATTRIBUTE.match(token, at):
        name, given = _NAME_AND_VALUE.match(found[1]).groups()
        if given:
            value = given.lstrip("=").lstrip(" \t\n\r\f\v")
            if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'":
                value = value[1:-1]
            elif value[:1] in ("'", '"'):
                value = "=" + value
            given = unescape_text(value)
        out[name.lower()] = given
        at = found.end()
    return out, at


def _elements(page, is_text, tag, cls, wanted, text, nested, most_text) -> list[dict]:
    """The entries of one page, from its tokens and whether each is text; every token is met once."""
    opened, counts, containers = [], Counter(), []  # (name, container, records); open ones of a name; places in opened
    found, pieces, hidden, numbered = [], [], 0, 0

    def shut(records):
        for record in records:
            record["end"] = len(pieces)

    def close(name):
        nonlocal hidden
        last = None
        while last != name:
            last, container, records = opened.pop()
            counts[last] -= 1
            hidden -= last in UNREAD
            if container is not None:
                containers.pop()
            shut(records)

    for token, plain in zip(page, is_text):
        if plain:
            if not hidden:
                pieces.append(unescape_text(token))
            continue
        if token.startswith("</"):
            end = _END_NAME.match(token)
            name = (end[1] or end[2]).lower() if end else None
            if counts[name]:
                close(name)
            continue
        start = _START_NAME.match(token)
        if not start:
            continue
        name = start[1].lower()
        if not nested and name in wanted and counts[name]:
            inner = containers[-1] if containers else -1
            if any(opened[i][0] == name for i in range(len(opened) - 1, inner, -1)):
                close(name)
        attributes, at = {}, 0
        if name == tag or name in wanted or token.endswith("/>"):
            attributes, at = _attributes(token, start.end())
        classes, records, container = attributes.get("class") or "", [], None
        if name in wanted:
            records = [
                {"container": opened[i][1], "tag": name, "classes": classes, "href": attributes.get("href"),
                 "datetime": attributes.get("datetime"), "start": len(pieces), "end": None}
                for i in containers
            ]
            found += records
        if name == tag and (cls is None or cls in classes.split()):
            container = numbered
            numbered += 1
        if name in VOID or name in RAW or at and token[at:].strip() == "/>":
            shut(records)
            continue
        if container is not None:
            containers.append(len(opened))
        opened.append((name, container, records))
        counts[name] += 1
        hidden += name in UNREAD
    for _, _, records in opened:
        shut(records)
    before = [0]
    for piece in pieces:
        before.append(before[-1] + len(piece))
    total = sum(before[r["end"]] - before[r["start"]] for r in found if r["tag"] in text)
    if total > most_text:
        raise ValueError(f"{total} signs of text in nested elements, {most_text} at most")
    for record in found:
        start, end = record.pop("start"), record.pop("end")
        record["text"] = "".join(pieces[start:end]) if record["tag"] in text else None
    filled = {r["container"] for r in found}
    found += [dict.fromkeys(("tag", "classes", "href", "datetime", "text")) | {"container": c} for c in range(numbered) if c not in filled]
    return sorted(found, key=lambda r: r["container"])


def of_container(elements: Column, number: int, tag: str) -> Column:
    """Elements of one container and tag."""
    return F.filter(elements, lambda e: (e["container"] == number) & (e["tag"] == tag))
