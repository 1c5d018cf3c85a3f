"""Markdown of pruned pages."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitefacts import params
from sitefacts.functions.common import bind, cut, empty_array, strip
from sitefacts.functions.html import attribute, decode_entities, span_start, span_text, text_index

TRUNCATED = "\n\n...[Truncated]..."
SECTION_BREAK = "\n\n---\n\n"
NONE_DETECTED = "None detected"

# Marks in the running text: end of a block, start and end of a link.
_BLOCK, _LINK, _LINK_END = "\u0001", "\u0002", "\u0003"


def is_line(tokens: Column, span: Column) -> Column:
    return F.get(tokens, span_start(span))["tag"].isin(*params.LINE_TAGS)


def line_of(tag: Column, text: Column, tok: Column) -> Column:
    """Markdown line of an element; the blank lines around headings and paragraphs belong to it."""
    href = F.coalesce(attribute(tok, "href"), F.lit(""))
    link = bind(
        href,
        lambda h: F.when(
            (h != "") & ~h.startswith("#"), F.concat(F.lit("["), text, F.lit("]("), h, F.lit(")"))
        ).otherwise(text),
    )
    return (
        F.when(tag == "h1", F.concat(F.lit("\n# "), text, F.lit("\n")))
        .when(tag == "h2", F.concat(F.lit("\n## "), text, F.lit("\n")))
        .when(tag.isin("h3", "h4"), F.concat(F.lit("\n### "), text, F.lit("\n")))
        .when(tag == "li", F.concat(F.lit("- "), text))
        .when(tag == "a", link)
        .otherwise(F.concat(text, F.lit("\n")))
    )


def line(tokens: Column, index: Column, span: Column) -> Column:
    """Markdown line of the element at ``span``; null if it has less than two characters of text."""

    def of_text(text):
        t = F.get(tokens, span_start(span))
        return F.when(F.length(text) >= 2, line_of(t["tag"], text, t["tok"]))

    return bind(span_text(index, span, " "), of_text)


def line_rows(tokens: Column, spans: Column) -> Column:
    """``array<struct<pos, line>>`` of all elements that give a line."""
    found = lambda index: F.transform(
        F.filter(spans, lambda s: is_line(tokens, s)), lambda s: F.struct(span_start(s).alias("pos"), line(tokens, index, s).alias("line"))
    )
    return bind(text_index(tokens, " "), found)


def outline(tokens: Column, spans: Column, budget: int) -> Column:
    """All lines in document order.

    Gathering stops once the lines hold more than ``budget`` characters that are not white space: what
    follows is past the cut of :func:`clip` whatever the clean-up removes. This keeps pages whose elements
    were left open, and therefore nest thousands deep, from repeating their text thousands of times.
    """

    def state(text, used):
        return F.struct(text.alias("text"), used.alias("used"))

    def step(acc, span, index):
        def added(new_line):
            used = F.length(F.regexp_replace(new_line, r"[\s\p{Z}\x1c-\x1f\x85]+", ""))  # no clean-up removes these
            return F.when(new_line.isNull(), acc).otherwise(
                state(F.concat(acc["text"], new_line, F.lit("\n")), acc["used"] + used)
            )

        return F.when(acc["used"] > budget, acc).otherwise(bind(line(tokens, index, span), added))

    def folded(index):
        start = state(F.lit(""), F.lit(0))
        return F.aggregate(F.filter(spans, lambda s: is_line(tokens, s)), start, lambda acc, s: step(acc, s, index), lambda acc: acc["text"])

    lines = bind(text_index(tokens, " "), folded)
    return strip(F.regexp_replace(lines, r"\n{3,}", "\n\n"))


def blocks(tokens: Column) -> Column:
    """``array<struct<text, link_chars>>``: running text between block-level tags, empty blocks left out."""

    def piece(t):
        text = F.regexp_replace(decode_entities(t["tok"]), r"[\s\p{Z}\x01\x02\x03]+", " ")
        return (
            F.when(t["kind"] == "text", text)
            .when(t["tag"].isin(*params.BLOCK_TAGS), _BLOCK)
            .when((t["tag"] == "a") & (t["kind"] == "open"), _LINK)
            .when((t["tag"] == "a") & (t["kind"] == "close"), _LINK_END)
            .when(t["tag"] == "br", " ")
            .otherwise("")
        )

    def block(raw):
        text = F.trim(F.regexp_replace(F.translate(raw, _LINK + _LINK_END, ""), " +", " "))
        linked = F.regexp_extract_all(raw, F.lit(f"{_LINK}([^{_LINK}{_LINK_END}]*){_LINK_END}"), F.lit(1))
        return F.struct(text.alias("text"), F.length(F.array_join(linked, "")).alias("link_chars"))

    running = F.array_join(F.transform(tokens, piece), "")
    return F.filter(F.transform(F.split(running, _BLOCK), block), lambda b: b["text"] != "")


def is_prose(
    block: Column, min_chars: int = params.MIN_BLOCK_CHARS, max_link_share: float = params.MAX_LINK_SHARE
) -> Column:
    length = F.length(block["text"])
    return (length >= min_chars) & (block["link_chars"] <= length * max_link_share)


def block_key(text: Column) -> Column:
    return F.sha2(text, 256)


def main_text(all_blocks: Column, repeated: Column | None = None) -> Column:
    """Prose blocks, one per paragraph, without those whose key is in ``repeated``."""
    prose = F.filter(all_blocks, lambda b: is_prose(b))
    if repeated is not None:
        prose = F.when(F.size(F.coalesce(repeated, empty_array("string"))) == 0, prose).otherwise(
            F.filter(prose, lambda b: ~F.array_contains(repeated, block_key(b["text"])))
        )
    return F.array_join(F.transform(prose, lambda b: b["text"]), "\n\n")


def tidy(markdown: Column) -> Column:
    """Runs of blanks and tabs become one blank, runs of blank lines one empty line."""
    narrow = F.regexp_replace(markdown, r"[ \t]+", " ")
    return strip(F.regexp_replace(narrow, r"\n[\s\p{Z}]*\n", "\n\n"))


def clip(markdown: Column, budget: int = params.MARKDOWN_BUDGET) -> Column:
    return bind(
        markdown,
        lambda m: F.when(F.length(m) > budget, F.concat(cut(m, 1, budget), F.lit(TRUNCATED))).otherwise(m),
    )


def choose(main: Column, fallback: Column, budget: int, min_chars: int = params.MIN_MAIN_TEXT) -> Column:
    """Main text if there is enough of it, else the outline; tidied and clipped."""
    return clip(tidy(F.when(F.length(strip(main)) > min_chars, strip(main)).otherwise(fallback)), budget)


def listing(values: Column) -> Column:
    return F.when(F.size(values) == 0, NONE_DETECTED).otherwise(F.array_join(values, ", "))


def section(url: Column, markdown: Column) -> Column:
    return F.concat(F.lit("## Content from Page: "), url, F.lit("\n\n"), markdown)


def join_sections(sections: Column | Sequence[Column]) -> Column:
    return F.array_join(sections, SECTION_BREAK)


def request(
    domain: Column, context: Column, emails: Column, profiles: Column, template: str = params.REQUEST_TEMPLATE
) -> Column:
    """Text of one extraction request. The fields are put between the literal parts of the template, so
    braces in a page's text mean nothing."""
    fields = {
        "{domain}": domain,
        "{context}": context,
        "{emails}": listing(emails),
        "{profiles}": listing(profiles),
    }
    pieces = re.split("(" + "|".join(map(re.escape, fields)) + ")", template)
    return F.concat(*[fields[p] if p in fields else F.lit(p) for p in pieces if p])
