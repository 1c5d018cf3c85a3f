"""Main content of a pruned page as Markdown blocks: the element of greatest text mass, with its structure kept.

Elements are ranges of tokens. The mass of a range is its text outside links less its text inside links, and running
sums over the tokens give the mass of every element at once. The container element of greatest mass holds the main
content; its headings, list items, paragraphs and table rows become the blocks of a Markdown text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitefacts import params
from sitefacts.functions.common import bind, empty_array, running
from sitefacts.functions.html import attribute, decode_entities, span_start, span_stop

HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
# Elements whose own text is content however short it is; text straight in any other element must be longer.
PARAGRAPHS = ("p", "dt", "dd", "blockquote", "pre", "figcaption", "caption", "address")
BLOCKS = (*params.BLOCK_TAGS, "caption", "center", "figcaption")
CONTAINERS = ("body", "main", "article", "section", "div", "td", "dl", "ul", "ol", "table", "blockquote", "center")

# Marks in the running text of the content. None is white space.
_LOOSE, _PARAGRAPH, _ITEM, _ITEM_END, _ROW, _ROW_END, _CELL = "\x01", "\x02", "\x03", "\x04", "\x05", "\x06", "\x07"
_LINK, _LINK_TEXT, _LINK_END = "\x0e", "\x0f", "\x10"
_LEVELS = {tag: chr(0x11 + i) for i, tag in enumerate(HEADINGS)}
_ENDS = r"\x01-\x07\x11-\x16"  # what ends a run of text
_BLANK = r"[\s\p{Z}\x01-\x1f]+"

def linked(tokens: Column) -> Column:
    """For every token 1 if the last ``a`` tag or block tag up to it opened a link, else another number."""

    def event(t: Column) -> Column:
        return (
            F.when((t["tag"] == "a") & (t["kind"] == "open"), 1)
            .when((t["tag"] == "a") | t["tag"].isin(*BLOCKS), 2)
            .otherwise(0)
            .cast("bigint")
        )

    return running(F.transform(tokens, event), lambda last, now: F.when(now == 0, last).otherwise(now))


def masses(tokens: Column) -> Column:
    """Running sums over the tokens: characters of text outside links less those inside, white space left out."""

    def mass(t: Column, link: Column) -> Column:
        chars = F.length(F.regexp_replace(decode_entities(t["tok"]), _BLANK, "")).cast("bigint")
        return F.when(t["kind"] != "text", F.lit(0).cast("bigint")).when(link == 1, -chars).otherwise(chars)

    return running(F.zip_with(tokens, linked(tokens), mass), lambda a, b: a + b)


def main_span(tokens: Column, spans: Column) -> Column:
    """First and last token of the container of greatest mass; of equals the innermost; the page if there is none."""

    def best(sums: Column) -> Column:
        def scored(span: Column) -> Column:
            first, last = span_start(span), span_stop(span)
            mass = F.get(sums, last) - F.when(first == 0, F.lit(0).cast("bigint")).otherwise(F.get(sums, first - 1))
            return F.struct(mass.alias("mass"), first.alias("first"), last.alias("last"))

        containers = F.filter(spans, lambda s: F.get(tokens, span_start(s))["tag"].isin(*CONTAINERS))
        page = F.struct(F.lit(None).cast("bigint").alias("mass"), F.lit(0).alias("first"), (F.size(tokens) - 1).alias("last"))
        return F.coalesce(F.array_max(F.transform(containers, scored)), page)

    return bind(masses(tokens), best)


def _piece(t: Column) -> Column:
    """A token as running text with marks."""
    text = F.regexp_replace(decode_entities(t["tok"]), _BLANK, " ")
    href = F.trim(F.regexp_replace(F.coalesce(attribute(t["tok"], "href"), F.lit("")), _BLANK, " "))
    opens = t["kind"] == "open"
    found = F.when(t["kind"] == "text", text)
    found = found.when((t["tag"] == "a") & opens, bind(href, lambda h: F.concat(F.lit(_LINK), F.when(h.startswith("#"), "").otherwise(h), F.lit(_LINK_TEXT))))
    found = found.when((t["tag"] == "a") & (t["kind"] == "close"), _LINK_END)
    found = found.when(t["tag"].isin("td", "th"), F.when(opens, _CELL).otherwise(" "))
    found = found.when(t["tag"] == "tr", F.when(opens, _ROW).otherwise(_ROW_END))
    found = found.when(t["tag"] == "li", F.when(opens, _ITEM).otherwise(_ITEM_END))
    for tag, mark in _LEVELS.items():
        found = found.when((t["tag"] == tag) & opens, mark)
    found = found.when(t["tag"].isin(*PARAGRAPHS) & opens, _PARAGRAPH)
    return found.when(t["tag"].isin(*BLOCKS), _LOOSE).when(t["tag"] == "br", " ").otherwise("")


def _plain(run: Column) -> Column:
    """Text of a run without marks."""
    bare = F.regexp_replace(F.regexp_replace(run, r"\x0e[^\x0f]*\x0f", ""), r"[\x01-\x07\x0e-\x16]", "")
    return F.trim(F.regexp_replace(bare, " +", " "))


def _with_links(run: Column) -> Column:
    """Text of a run with its links as Markdown."""
    links = F.regexp_replace(run, r"\x0e([^\x0e\x0f\x10]+)\x0f ?([^\x0e\x0f\x10]*[^ \x0e\x0f\x10]) ?\x10", "[$2]($1)")
    return _plain(links)


def blocks(tokens: Column) -> Column:
    """``array<struct<kind, text, line, link_chars>>`` of some tokens, empty blocks left out.

    Kinds are ``row``, ``item``, ``heading``, ``paragraph``, ``cell`` and ``loose``. A table row of several cells
    without elements of their own inside is one block; other rows give a block for each of their parts.
    """
    marked = F.array_join(F.transform(tokens, _piece), "")
    items_first = F.regexp_replace(marked, r"\x03[\x01-\x03\x05\x06 ]*([^\x01-\x07\x11-\x16])", "\x03$1")  # an item's own text may lie deeper
    runs = F.regexp_extract_all(items_first, F.lit(rf"\x05[^\x01-\x06\x11-\x16]*\x06|[\x02\x03\x07\x11-\x16]?[^{_ENDS}]+"), F.lit(0))

    def block(run: Column) -> Column:
        first = F.substring(run, 1, 1)
        cells = F.filter(F.transform(F.split(run, _CELL), _with_links), lambda c: c != "")
        row = F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
        text = F.when(first == _ROW, F.array_join(F.filter(F.transform(F.split(run, _CELL), _plain), lambda c: c != ""), " ")).otherwise(_plain(run))
        kind = (
            F.when(first == _ROW, F.when(F.size(cells) > 1, "row").otherwise("cell"))
            .when(first == _ITEM, "item")
            .when(first == _PARAGRAPH, "paragraph")
            .when(first == _CELL, "cell")
            .when(first.isin(*_LEVELS.values()), "heading")
            .otherwise("loose")
        )
        line = (
            F.when((first == _ROW) & (F.size(cells) > 1), row)
            .when(first == _ITEM, F.concat(F.lit("- "), _with_links(run)))
            .when(first.isin(*_LEVELS.values()), F.concat(F.repeat(F.lit("#"), F.ascii(first) - 0x10), F.lit(" "), _with_links(run)))
            .otherwise(_with_links(run))
        )
        chars = F.length(F.array_join(F.regexp_extract_all(run, F.lit(r"\x0f([^\x0e\x0f\x10]*)\x10"), F.lit(1)), ""))
        return F.struct(kind.alias("kind"), text.alias("text"), line.alias("line"), chars.alias("link_chars"))

    return F.filter(F.transform(runs, block), lambda b: b["text"] != "")


def main_blocks(tokens: Column, spans: Column) -> Column:
    """Blocks of the page's main content."""
    span = main_span(tokens, spans)
    return bind(span, lambda s: blocks(F.slice(tokens, s["first"] + 1, s["last"] - s["first"] + 1)))


def is_content(block: Column, min_chars: int = params.MIN_BLOCK_CHARS, max_link_share: float = params.MAX_LINK_SHARE) -> Column:
    """Not mostly links; and text that no content element holds must have some length."""
    length = F.length(block["text"])
    return (block["link_chars"] <= length * max_link_share) & ((block["kind"] != "loose") | (length >= min_chars))


def main_markdown(
    all_blocks: Column,
    repeated: Column | None = None,
    min_chars: int = params.MIN_BLOCK_CHARS,
    max_link_share: float = params.MAX_LINK_SHARE,
) -> Column:
    """Content blocks as Markdown, without those whose key is in ``repeated``; items and rows of one list stand together."""

    def unrepeated(found: Column) -> Column:
        if repeated is None:
            return found
        known = F.coalesce(repeated, empty_array("string"))
        return F.when(F.size(known) == 0, found).otherwise(F.filter(found, lambda b: ~F.array_contains(known, F.sha2(b["text"], 256))))

    def joined(kept: Column) -> Column:
        def piece(b: Column, i: Column) -> Column:
            close = b["kind"].isin("item", "row") & (F.get(kept, i - 1)["kind"] == b["kind"])
            return F.concat(F.when(i == 0, "").when(close, "\n").otherwise("\n\n"), b["line"])

        return F.array_join(F.transform(kept, piece), "")

    return bind(unrepeated(F.filter(all_blocks, lambda b: is_content(b, min_chars, max_link_share))), joined)
