"""Search-hit expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitefacts.functions.common import bind, strip
from sitefacts.functions.contacts import profile_in_text

UNKNOWN_ROLE = "Founder / Executive"


def needs_search(leaders: Column) -> Column:
    """No leader, or one without a URL."""
    return (F.size(leaders) == 0) | F.exists(leaders, lambda m: m["linkedin_url"].isNull())


def leader_query(leader: Column, company: Column) -> Column:
    return F.concat(leader, F.lit(" "), company, F.lit(" linkedin"))


def company_query(company: Column) -> Column:
    return F.concat(company, F.lit(" founder CEO linkedin"))


def hit_profile(href: Column, body: Column) -> Column:
    """Profile URL of a hit: from its address, else from its text."""
    return F.coalesce(profile_in_text(href), profile_in_text(body))


def name_and_role(title: Column, company: Column, separator: str = "-") -> Column:
    """``struct<name, role>`` from a title such as ``Name - Role at Company | LinkedIn``."""

    def named(parts):
        role = F.coalesce(F.get(parts, 1), F.lit(UNKNOWN_ROLE))
        name = F.coalesce(F.get(parts, 0), F.concat(company, F.lit(" Founder/CEO")))
        return F.struct(name.alias("name"), role.alias("role"))

    clean = F.replace(F.replace(title, F.lit("| LinkedIn"), F.lit("")), F.lit("- LinkedIn"), F.lit(""))
    parts = F.filter(F.transform(F.split(strip(clean), separator, -1), strip), lambda p: p != "")
    return bind(parts, named)


def title_names(title: Column, name: Column) -> Column:
    """Every word of the name occurs in the title."""
    words = F.split(F.lower(strip(name)), r"\s+")
    return F.forall(words, lambda w: F.lower(title).contains(w))
