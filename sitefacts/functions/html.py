"""HTML as arrays of tokens and element spans, inside the page's own row.

A page is tokenised with one regular expression, and a left fold with a stack of open elements matches
the tags. Both are ordinary Spark expressions on one row, so a page never leaves its task: there is no
explode, no sort and no shuffle between the scan of the pages and the pruned text, contacts or links.

Matching follows the tree rules of a lenient HTML parser: a closing tag ends the nearest open element
of that name together with everything left open inside it; a closing tag without such an element is
ignored; what stays open ends with the page.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitefacts import params
from sitefacts.functions.common import any_of, bind, cut, empty_array, running, strip

# Comment, raw element, tag with quoted values, any other markup, text, stray bracket.
TOKEN_PATTERN = (
    r"(?is)<!--.*?-->"
    r"|<script\b.*?</script\s*>"
    r"|<style\b.*?</style\s*>"
    r"""|<[a-z](?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+>"""
    r"|<[a-z/!?][^>]*>"
    r"|(?:[^<]++|<[^a-z/!?<])++"
    r"|<"
)
TAG_PATTERN = r"^</?([A-Za-z][^\s/>]*)"
RAW_END = r"(?i)</(?:script|style)\s*>$"
ATTRIBUTE_PATTERN = r"""[^\s"'<>/=]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?"""
REFERENCE = r"^&([A-Za-z][A-Za-z0-9]{1,40}|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});"


def _entity_names() -> Column:
    pairs = "\x01".join(f"{name}\x02{char}" for name, char in params.ENTITIES.items())
    return F.str_to_map(F.lit(pairs), F.lit("\x01"), F.lit("\x02"))


def decode_entities(text: Column) -> Column:
    """Decode complete character references; cut-off ones stay as they are."""

    def numbered(digits, base):
        code = F.conv(digits, base, 10).try_cast("bigint")
        usable = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        windows = F.try_element_at(F.array(*[F.lit(c) for c in params.WINDOWS_1252.values()]), (code - 127).cast("int"))
        plain = F.when(usable, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        return F.when(code.between(128, 159), windows).otherwise(plain)

    def piece(p):
        def decoded(name):
            char = (
                F.when(name.rlike("^#[xX]"), numbered(cut(name, 3, 6), 16))
                .when(name.startswith("#"), numbered(cut(name, 2, 7), 10))
                .otherwise(F.try_element_at(_entity_names(), name))
            )
            rest = F.substring(p, F.length(name) + 3, F.length(p))
            return F.coalesce(F.concat(char, rest), p)

        return bind(F.regexp_extract(p, REFERENCE, 1), decoded)

    def pieces(t):
        return F.array_join(F.transform(F.split(t, "(?=&)"), piece), "")

    return bind(text, lambda t: F.when(t.contains("&"), pieces(t)).otherwise(t))


def _or_empty(html: Column) -> Column:
    return F.coalesce(html, F.lit(""))


def tokenize(html: Column) -> Column:
    """``array<struct<kind, tag, tok>>`` in document order.

    Kinds: open, close, void (no content), raw (script or style with its body), text, comment, decl.
    """
    return F.transform(F.regexp_extract_all(_or_empty(html), F.lit(TOKEN_PATTERN), F.lit(0)), _classify)


def _classify(tok: Column) -> Column:
    def token(kind, tag):
        return F.struct(kind.alias("kind"), tag.alias("tag"), tok.alias("tok"))

    def markup(tag):
        nameless = (
            F.when(tok.startswith("<!--"), "comment")
            .when(tok.startswith("<!") | tok.startswith("<?"), "decl")
            .otherwise("text")
        )
        kind = (
            F.when(tag == "", nameless)
            .when(tok.startswith("</"), "close")
            .when(tag.isin("script", "style") & tok.rlike(RAW_END), "raw")
            .when(tag.isin(*params.VOID_TAGS) | tok.endswith("/>"), "void")
            .otherwise("open")
        )
        return token(kind, tag)

    name = F.lower(F.regexp_extract(tok, TAG_PATTERN, 1))
    return F.when(tok.startswith("<"), bind(name, markup)).otherwise(token(F.lit("text"), F.lit("")))


# Spans are packed into one number, start * 2^32 + stop: cheap to copy, and they sort by start.
SPAN_BASE = 1 << 32


def span_start(span: Column) -> Column:
    return F.shiftright(span, 32).cast("int")


def span_stop(span: Column) -> Column:
    return span.bitwiseAND(F.lit(SPAN_BASE - 1)).cast("int")


def _span(start: Column, stop: Column) -> Column:
    return start.cast("bigint") * SPAN_BASE + stop


def element_spans(tokens: Column) -> Column:
    """Packed token ranges (0-based, inclusive) of all elements in document order.

    Elements without content are one token. An opening tag directly followed by its own closing tag (as
    far as tags go) needs no stack either; only the remaining tags go through the fold.
    """

    def tag_marks(kinds):
        return F.filter(
            F.transform(
                tokens,
                lambda t, i: F.struct(i.alias("pos"), t["kind"].alias("kind"), t["tag"].alias("tag")),
            ),
            lambda m: m["kind"].isin(*kinds),
        )

    def is_pair(opening, closing):
        return (opening["kind"] == "open") & (closing["kind"] == "close") & (opening["tag"] == closing["tag"])

    def from_marks(marks):
        leaves = F.transform(
            F.filter(
                F.transform(marks, lambda m, i: F.struct(m.alias("m"), F.get(marks, i + 1).alias("n"))),
                lambda p: is_pair(p["m"], p["n"]),
            ),
            lambda p: _span(p["m"]["pos"], p["n"]["pos"]),
        )
        nested = F.filter(
            marks,
            lambda m, i: ~F.coalesce(is_pair(m, F.get(marks, i + 1)), F.lit(False))
            & ~F.coalesce(is_pair(F.get(marks, i - 1), m), F.lit(False)),
        )
        return F.concat(leaves, _matched(nested, F.size(tokens) - 1))

    childless = F.transform(tag_marks(("void", "raw")), lambda m: _span(m["pos"], m["pos"]))
    return F.array_sort(F.concat(childless, bind(tag_marks(("open", "close")), from_marks)))


# A fold copies its state at every step, so one that gathered all spans of a page would be quadratic.
# The marks are folded in runs of this length instead, and only the spans of one run travel along.
RUN_LENGTH = 128


def _matched(marks: Column, last: Column) -> Column:
    """Spans of the elements opened and closed by ``marks``; what is left open stops at ``last``."""

    def state(tags, starts, done):
        return F.struct(tags.alias("tags"), starts.alias("starts"), done.alias("done"))

    def ended(acc, count, own_stop, inner_stop):
        """The ``count`` innermost open elements; only the outermost of them owns the closing tag."""
        return F.transform(
            F.slice(acc["starts"], F.lit(1), count),
            lambda s, i: _span(s, F.when(i == count - 1, own_stop).otherwise(inner_stop)),
        )

    def step(acc, m):
        k = F.array_position(acc["tags"], m["tag"]).cast("int")
        opened = state(
            F.array_prepend(acc["tags"], m["tag"]), F.array_prepend(acc["starts"], m["pos"]), acc["done"]
        )
        closed = state(
            F.slice(acc["tags"], k + 1, F.size(acc["tags"])),
            F.slice(acc["starts"], k + 1, F.size(acc["starts"])),
            F.concat(acc["done"], ended(acc, k, m["pos"], m["pos"] - 1)),
        )
        return F.when(m["kind"] == "open", opened).otherwise(F.when(k == 0, acc).otherwise(closed))

    def run_step(acc, run):
        return F.aggregate(
            run,
            state(acc["tags"], acc["starts"], empty_array("bigint")),
            step,
            lambda r: state(r["tags"], r["starts"], F.concat(acc["done"], r["done"])),
        )

    def runs(items):
        count = F.ceil(F.size(items) / RUN_LENGTH).cast("int")
        return F.when(count <= 1, F.array(items)).otherwise(
            F.transform(
                F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))),
                lambda r: F.slice(items, r * RUN_LENGTH + 1, F.lit(RUN_LENGTH)),
            )
        )

    nothing_open = state(empty_array("string"), empty_array("int"), empty_array("bigint"))
    return F.aggregate(
        bind(marks, runs),
        nothing_open,
        run_step,
        lambda acc: F.concat(acc["done"], ended(acc, F.size(acc["starts"]), last, last)),
    )


def span_depths(spans: Column) -> Column:
    """How deep each element lies; the outermost have depth 1.

    Starts and stops in one order: at a start, as many elements are open as starts came up to it, less the stops.
    """
    starts = F.transform(spans, lambda s: span_start(s).cast("bigint") * 2)
    stops = F.transform(spans, lambda s: span_stop(s).cast("bigint") * 2 + 1)
    in_order = F.transform(F.sort_array(F.concat(starts, stops)), lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    return F.transform(F.filter(in_order, lambda m: m["x"] % 2 == 0), lambda m, nth: 2 * nth + 1 - m["i"])


# --- attributes ---------------------------------------------------------------------------------------


def attribute_items(tok: Column) -> Column:
    """``name`` or ``name=value`` pieces of a tag, in order."""
    inside = F.regexp_replace(tok, r"^<[^\s/>]+", "")
    return F.when(tok.rlike(r"\s|/."), F.regexp_extract_all(inside, F.lit(ATTRIBUTE_PATTERN), F.lit(0))).otherwise(
        empty_array("string")
    )


def item_name(item: Column) -> Column:
    return F.lower(F.regexp_extract(item, r"^[^\s=]+", 0))


def item_value(item: Column) -> Column:
    return F.regexp_extract(item, r"""(?s)^[^=]*=\s*["']?(.*?)["']?$""", 1)


def attribute(tok: Column, name: str) -> Column:
    """Decoded value of an attribute: empty if it has none, null if the tag lacks it. The last one wins."""
    named = F.filter(attribute_items(tok), lambda a: item_name(a) == name)
    present = tok.rlike(rf"(?i)[\s\"'/]{name}[\s=>/]")
    return F.when(present, decode_entities(item_value(F.try_element_at(named, F.lit(-1)))))


def is_noise(tok: Column, noise_words: Sequence[str] = params.NOISE_WORDS) -> Column:
    """Noise word in class or id, hidden from assistive tools, or hidden by inline style."""
    words = any_of(noise_words)

    def marks_noise(item):
        name, value = item_name(item), decode_entities(item_value(item))
        return (
            (name.isin("class", "id") & F.lower(value).rlike(words))
            | ((name == "aria-hidden") & (value == "true"))
            | ((name == "style") & F.replace(F.lower(value), F.lit(" ")).rlike("display:none|visibility:hidden"))
        )

    suspicious = tok.rlike(r"(?i)class|id|aria-hidden|style") & tok.contains("=")
    return suspicious & F.exists(attribute_items(tok), marks_noise)


# --- pruning ------------------------------------------------------------------------------------------


def dropped_spans(
    tokens: Column,
    spans: Column,
    strip_tags: Sequence[str] = params.STRIP_TAGS,
    noise_words: Sequence[str] = params.NOISE_WORDS,
) -> Column:
    """Spans of the elements that go, each with everything inside it."""

    def goes(span):
        t = F.get(tokens, span_start(span))
        return t["tag"].isin(*strip_tags) | is_noise(t["tok"], noise_words)

    return F.filter(spans, goes)


def kept_tokens(tokens: Column, dropped: Column) -> Column:
    """Tokens outside every dropped span, comments left out.

    Spans are in order of their start and never overlap in part, so one lies outside all others if it starts after
    the greatest stop so far; what is kept lies between two such neighbours.
    """

    def between(reached: Column) -> Column:
        outer = F.filter(dropped, lambda s, i: (i == 0) | (span_start(s) > F.get(reached, i - 1)))

        def gaps(spans: Column) -> Column:
            ends = F.concat(F.transform(spans, lambda s: span_start(s)), F.array(F.size(tokens)))
            begins = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: span_stop(s) + 1))
            return F.flatten(F.zip_with(begins, ends, lambda b, e: F.slice(tokens, b + 1, F.greatest(e - b, F.lit(0)))))

        return bind(outer, gaps)

    reached = running(F.transform(dropped, lambda s: span_stop(s).cast("bigint")), lambda a, b: F.greatest(a, b))
    inside = F.when(F.size(dropped) == 0, tokens).otherwise(bind(reached, between))
    return F.filter(inside, lambda t: t["kind"] != "comment")


def render(tokens: Column, kept_attributes: Sequence[str] = params.KEPT_ATTRIBUTES) -> Column:
    """HTML of the tokens, tags reduced to the kept attributes."""

    def rebuilt(t):
        kept = F.filter(attribute_items(t["tok"]), lambda a: item_name(a).isin(*kept_attributes))
        pairs = F.transform(
            kept,
            lambda a: F.concat(
                F.lit(" "), item_name(a), F.lit('="'), F.replace(item_value(a), F.lit('"'), F.lit("&quot;")), F.lit('"')
            ),
        )
        end = F.when(t["tok"].endswith("/>"), "/>").otherwise(">")
        return F.concat(F.lit("<"), t["tag"], F.array_join(pairs, ""), end)

    def piece(t):
        return (
            F.when(t["kind"] == "close", F.concat(F.lit("</"), t["tag"], F.lit(">")))
            .when(t["kind"].isin("open", "void"), rebuilt(t))
            .otherwise(t["tok"])
        )

    return F.array_join(F.transform(tokens, piece), "")


# --- text ---------------------------------------------------------------------------------------------


def visible_text(tokens: Column) -> Column:
    """All text of the page, pieces joined by a blank; no comments, scripts or styles."""
    texts = F.filter(tokens, lambda t: t["kind"] == "text")
    return decode_entities(F.array_join(F.transform(texts, lambda t: t["tok"]), " "))


def text_index(tokens: Column, separator: str) -> Column:
    """``struct<units, ends>``: all text of the page, and where in it each token's text ends.

    Every piece is stripped, and empty ones are left out. Units are of four bytes, so any element's text is a range
    that is found without going through what is before it.
    """

    def indexed(pieces: Column) -> Column:
        joined = F.array_join(F.transform(pieces, lambda p: F.when(p == "", "").otherwise(F.concat(p, F.lit(separator)))), "")
        sizes = F.transform(pieces, lambda p: F.when(p == "", 0).otherwise(F.length(p) + len(separator)).cast("bigint"))
        return F.struct(F.encode(joined, "UTF-32").alias("units"), running(sizes, lambda a, b: a + b).alias("ends"))

    return bind(F.transform(tokens, lambda t: F.when(t["kind"] == "text", strip(decode_entities(t["tok"]))).otherwise("")), indexed)


def span_text(index: Column, span: Column, separator: str) -> Column:
    """Text of one element, from :func:`text_index` with the same separator."""
    begin = F.when(span_start(span) == 0, F.lit(0).cast("bigint")).otherwise(F.get(index["ends"], span_start(span) - 1))

    def of(low: Column) -> Column:
        size = F.get(index["ends"], span_stop(span)) - low - len(separator)
        units = F.substring(index["units"], (low * 4 + 1).cast("int"), (size * 4).cast("int"))
        # With a character before it, the first one of the text is never taken for a byte order mark.
        text = F.decode(F.concat(F.encode(F.lit("x"), "UTF-32"), units), "UTF-32")
        return F.when(size <= 0, F.lit("")).otherwise(F.substring(text, F.lit(2), (size + 1).cast("int")))

    return bind(begin, of)


def anchors(tokens: Column, spans: Column, separator: str = "") -> Column:
    """``array<struct<pos, href, text>>`` of the ``a`` elements that have an href."""
    links = F.filter(spans, lambda s: F.get(tokens, span_start(s))["tag"] == "a")

    def found(index: Column) -> Column:
        return F.transform(
            links,
            lambda s: F.struct(
                span_start(s).alias("pos"),
                attribute(F.get(tokens, span_start(s))["tok"], "href").alias("href"),
                span_text(index, s, separator).alias("text"),
            ),
        )

    return F.filter(bind(text_index(tokens, separator), found), lambda a: a["href"].isNotNull())


def hrefs(tokens: Column) -> Column:
    """Hrefs of all ``a`` tags; needs no element matching."""
    tags = F.filter(tokens, lambda t: (t["tag"] == "a") & (t["kind"] != "close"))
    return F.filter(F.transform(tags, lambda t: attribute(t["tok"], "href")), lambda h: h.isNotNull())


def title(html: Column) -> Column:
    """Text of the first title, white space collapsed."""
    inner = F.regexp_extract(_or_empty(html), r"(?is)<title\b[^>]*>(.*?)</title", 1)
    return strip(F.regexp_replace(decode_entities(inner), r"\s+", " "))


def is_challenge(html: Column, terms: Sequence[str] = params.CHALLENGE_TERMS) -> Column:
    return F.lower(title(html)).rlike(any_of(terms))
