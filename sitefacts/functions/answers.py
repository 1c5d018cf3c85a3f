"""Stored model answers: unwrap, parse, check and normalise. Narrow expressions on one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitefacts import params
from sitefacts.functions.common import cut, empty_array, strip
from sitefacts.functions.contacts import PROFILE_ROOT
from sitefacts.functions.urls import name_from_domain

FENCE = "`" * 3
TEXT_FIELDS = ("company_name", "company_overview", "target_audience_icp", "confidence_reasoning")
MEMBER_TYPE = "array<struct<name:string,role:string,linkedin_url:string>>"
SCORE = "decimal(20,10)"


def unfence(raw: Column) -> Column:
    """Text after the first json fence (else the first fence) and before the last one."""
    text = strip(raw)
    inner = (
        F.when(text.contains(FENCE + "json"), cut(text, F.instr(text, FENCE + "json") + 7, F.length(text)))
        .when(text.contains(FENCE), cut(text, F.instr(text, FENCE) + 3, F.length(text)))
        .otherwise(text)
    )
    after_last = F.length(F.substring_index(inner, FENCE, -1))
    body = F.when(inner.contains(FENCE), cut(inner, 1, F.length(inner) - after_last - 3)).otherwise(inner)
    return strip(body)


def parse(text: Column) -> Column:
    """The text as one VARIANT value; null unless the whole text is exactly one JSON value.

    The parser ignores what follows a value, so the text is parsed inside an array and inside an object: one that
    closes a bracket early breaks one of the two.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    named = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    alone = F.try_variant_get(listed, "$[1]", "variant").isNull() & named.isNotNull()
    return F.when(alone, F.try_variant_get(listed, "$[0]", "variant"))


def field(doc: Column, name: str, as_type: str = "variant") -> Column:
    return F.try_variant_get(doc, f"$.{name}", as_type)


def kind(value: Column) -> Column:
    """JSON kind of a VARIANT: OBJECT, ARRAY, STRING, NUMBER, BOOLEAN or VOID; null if absent."""
    name = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    return F.when(name.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "NUMBER").otherwise(name)


def _is(value: Column, wanted: str) -> Column:
    return F.coalesce(kind(value) == wanted, F.lit(False))


def _items(doc: Column, name: str) -> Column:
    return F.coalesce(field(doc, name, "array<variant>"), empty_array("variant"))


def _is_list_of(doc: Column, name: str, item_ok) -> Column:
    value = field(doc, name)
    return value.isNull() | (_is(value, "ARRAY") & F.forall(_items(doc, name), item_ok))


def _filled(member: Column, name: str) -> Column:
    return _is(field(member, name), "STRING") & (strip(field(member, name, "string")) != "")


def _member_ok(member: Column) -> Column:
    url = field(member, "linkedin_url")
    url_ok = url.isNull() | kind(url).isin("VOID", "STRING")
    return _is(member, "OBJECT") & _filled(member, "name") & _filled(member, "role") & url_ok


def score(doc: Column) -> Column:
    """The answer's own score; numeric text counts, anything else is null."""
    value = field(doc, "data_confidence_score")
    return F.when(kind(value).isin("NUMBER", "STRING"), field(doc, "data_confidence_score", SCORE))


def error_fields(doc: Column) -> Column:
    """Names of the fields that break the record; empty for a valid one."""
    in_range = F.coalesce(score(doc).between(0, 1), F.lit(False))
    checks = [(name, _is(field(doc, name), "STRING")) for name in TEXT_FIELDS]
    checks += [
        ("contact_points", _is_list_of(doc, "contact_points", lambda c: _is(c, "STRING"))),
        ("key_leadership", _is_list_of(doc, "key_leadership", _member_ok)),
        ("data_confidence_score", in_range),
    ]
    failed = F.array(*[F.when(~ok, F.lit(name)) for name, ok in checks])
    return F.filter(failed, lambda f: f.isNotNull())


def member_url(url: Column) -> Column:
    """Trimmed URL; a bare handle becomes a profile URL; blank, ``null`` and ``none`` are no URL."""
    clean = F.rtrim(strip(url), F.lit("/"))
    return F.when((clean == "") | F.lower(clean).isin("null", "none"), F.lit(None).cast("string")).otherwise(
        F.when(clean.rlike("^[A-Za-z0-9_-]+$"), F.concat(F.lit(PROFILE_ROOT), clean)).otherwise(clean)
    )


def member(name: Column, role: Column, url: Column) -> Column:
    return F.struct(name.alias("name"), role.alias("role"), url.alias("linkedin_url"))


def members(doc: Column) -> Column:
    """Leaders of a valid answer, normalised."""
    return F.transform(
        _items(doc, "key_leadership"),
        lambda m: member(
            strip(field(m, "name", "string")),
            strip(field(m, "role", "string")),
            member_url(F.when(_is(field(m, "linkedin_url"), "STRING"), field(m, "linkedin_url", "string"))),
        ),
    )


def clean_contacts(contacts: Column) -> Column:
    """Trimmed, lower case, no blanks, first of each kept in order."""
    return F.array_distinct(F.filter(F.transform(contacts, lambda c: F.lower(strip(c))), lambda c: c != ""))


def contacts(doc: Column) -> Column:
    """String contacts of an answer, normalised; anything else in the list is left out."""
    strings = F.filter(_items(doc, "contact_points"), lambda c: _is(c, "STRING"))
    return clean_contacts(F.transform(strings, lambda c: F.try_variant_get(c, "$", "string")))


def text_or(doc: Column, name: str, default: Column) -> Column:
    """A salvaged text field: the default if absent, the printed value if it is no text."""
    value = field(doc, name)
    return F.when(value.isNull(), default).otherwise(
        F.when(_is(value, "VOID"), F.lit("None")).otherwise(field(doc, name, "string"))
    )


def overview(text: Column) -> Column:
    return F.when(strip(text) == "", params.OVERVIEW_UNAVAILABLE).otherwise(strip(text))


def rubric(overview_text: Column, audience: Column, contact_points: Column, leaders: Column) -> Column:
    """Share of the record that is filled, as an exact decimal."""

    def worth(condition: Column, value: str) -> Column:
        return F.when(condition, F.lit(value).cast("decimal(3,2)")).otherwise(F.lit("0.00").cast("decimal(3,2)"))

    has_overview = (F.length(strip(overview_text)) > 20) & (overview_text != params.OVERVIEW_UNAVAILABLE)
    has_url = F.exists(leaders, lambda m: m["linkedin_url"].isNotNull())
    return (
        worth(has_overview, "0.25")
        + worth(F.length(strip(audience)) > 10, "0.25")
        + worth(F.size(contact_points) > 0, "0.20")
        + worth(F.size(leaders) > 0, "0.20")
        + worth(has_url, "0.10")
    ).cast("decimal(3,2)")


def blend(own: Column, filled: Column) -> Column:
    """Mean of the answer's score and the rubric, two decimals, within 0 and 1.

    Rounds exact ties to the even digit on decimals; binary floating point may fall to the other side.
    """
    mean = F.bround((own.cast(SCORE) + filled) / F.lit(2).cast("decimal(1,0)"), 2)
    return F.least(F.greatest(mean, F.lit(0).cast("decimal(3,2)")), F.lit(1).cast("decimal(3,2)")).cast("double")


def default_name(domain: Column) -> Column:
    return name_from_domain(domain)
