"""URL and domain expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitefacts import params
from sitefacts.functions.common import any_of, bind, capitalized, empty_array, strip

# Scheme, authority, path, query and fragment as RFC 3986 (appendix B) splits them.
URL_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(//([^/?#]*))?([^?#]*)(\?[^#]*)?(#.*)?$"


def normalize_domain(raw: Column) -> Column:
    """Trimmed, lower case, without http schemes and trailing slashes."""
    bare = F.regexp_replace(F.lower(strip(raw)), "https?://", "")
    return F.rtrim(bare, F.lit("/"))


def root_url(domain: Column) -> Column:
    return F.concat(F.lit("https://"), domain)


def with_scheme(url: Column) -> Column:
    return F.when(url.rlike("^https?://"), url).otherwise(F.concat(F.lit("https://"), url))


def name_from_domain(domain: Column) -> Column:
    return capitalized(F.substring_index(domain, ".", 1))


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, URL_PARTS, 1))


def authority(url: Column) -> Column:
    return F.regexp_extract(url, URL_PARTS, 3)


def path(url: Column) -> Column:
    return F.regexp_extract(url, URL_PARTS, 4)


def host(url: Column) -> Column:
    return F.lower(authority(url))


def _without_dots(full_path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of a path that starts with a slash."""

    def step(done, segment):
        return (
            F.when(segment == ".", done)
            .when(segment == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
            .otherwise(F.array_append(done, segment))
        )

    def resolved(segments):
        tail = F.when(F.get(segments, F.size(segments) - 1).isin(".", ".."), "/").otherwise("")
        return F.aggregate(
            segments, empty_array("string"), step, lambda done: F.concat(_as_path(done), tail)
        )

    def _as_path(done):
        return F.array_join(F.transform(done, lambda s: F.concat(F.lit("/"), s)), "")

    body = F.regexp_replace(full_path, "^/", "")
    clean = F.regexp_replace(bind(F.split(body, "/", -1), resolved), "^/{2,}", "/")
    return F.when(full_path.rlike(r"(?:^|/)\.\.?(?:/|$)"), clean).otherwise(full_path)


def parts(url: Column) -> Column:
    return F.struct(scheme(url).alias("scheme"), authority(url).alias("authority"), path(url).alias("path"))


def resolve(base: Column, href: Column) -> Column:
    """Absolute URL of an href on a page, with query and fragment dropped and no trailing slash."""

    def joined(both):
        page, link = both["page"], both["link"]
        folder = F.concat(F.lit("/"), F.regexp_replace(page["path"], "^/|[^/]*$", ""))
        target_path = (
            F.when(link["path"] == "", page["path"])
            .when(link["path"].startswith("/"), _without_dots(link["path"]))
            .otherwise(_without_dots(F.regexp_replace(F.concat(folder, link["path"]), "/{2,}", "/")))
        )
        link_scheme = F.when(link["scheme"] == "", page["scheme"]).otherwise(link["scheme"])
        relative = (link_scheme == page["scheme"]) & (link["authority"] == "")
        return F.when(
            relative, F.concat(page["scheme"], F.lit("://"), page["authority"], target_path)
        ).otherwise(F.concat(link_scheme, F.lit("://"), link["authority"], link["path"]))

    both = bind(strip(href), lambda h: F.struct(parts(base).alias("page"), parts(h).alias("link")))
    return canonical(bind(both, joined))


def canonical(url: Column) -> Column:
    """Scheme, authority and path; no trailing slash unless the path is just that."""

    def put_together(p):
        own_path = F.regexp_replace(p["path"], ";[^/]*$", "")
        clean = F.concat(p["scheme"], F.lit("://"), p["authority"], own_path)
        return F.when(F.length(own_path) > 1, F.rtrim(clean, F.lit("/"))).otherwise(clean)

    return bind(bind(url, parts), put_together)


def is_internal(
    base: Column, url: Column, extensions: Sequence[str] = params.ASSET_EXTENSIONS
) -> Column:
    """Same authority as the page or below it, a web scheme, and no asset."""
    home, target = host(with_scheme(base)), host(url)
    same_site = (target == home) | target.endswith(F.concat(F.lit("."), home))
    return same_site & scheme(url).isin("http", "https") & ~F.lower(path(url)).rlike(any_of(extensions) + "$")


def is_followable(href: Column, prefixes: Sequence[str] = params.SKIPPED_HREF_PREFIXES) -> Column:
    return (href != "") & ~href.rlike("^" + any_of(prefixes))


def is_self_link(base: Column, url: Column) -> Column:
    home = F.rtrim(base, F.lit("/"))
    return (url == home) | (url == F.concat(home, F.lit("/")))


def link_score(url: Column, text: Column, weights: Mapping[str, int] = params.LINK_WEIGHTS) -> Column:
    """Weight of every keyword in the URL plus weight of every keyword in the link text."""
    in_url, in_text = F.lower(url), F.lower(text)
    score = F.lit(0)
    for word, weight in weights.items():
        score = score + F.when(in_url.contains(word), weight).otherwise(0)
        score = score + F.when(in_text.contains(word), weight).otherwise(0)
    return score
