"""Email and profile-URL expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitefacts import params
from sitefacts.functions.common import any_of, strip

# --- fixed values: what an address and a profile link look like ---
_USER, _DOMAIN = "[A-Za-z0-9._%+-]", r"[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
ADDRESS = rf"(?U)\b{_USER}+@{_DOMAIN}"
PROFILE_LINK = r"(?i)https?://(?:www\.)?linkedin\.com/in/([a-zA-Z0-9_-]+)/?"
COMPANY_LINK = r"(?i)https?://(?:www\.)?linkedin\.com/company/([a-zA-Z0-9_-]+)/?"
ANY_PROFILE_LINK = r"(?i)https?://(?:[a-z]{2,3}\.)?linkedin\.com/in/([a-zA-Z0-9_-]+)/?"
PROFILE_ROOT = "https://www.linkedin.com/in/"
COMPANY_ROOT = "https://www.linkedin.com/company/"
# --- end of fixed values ---

# Finds the same addresses as ADDRESS, but tries each run of user-name characters only once, so that long
# runs (encoded blobs) cost linear time. Group 1 is the address.
ADDRESS_SCAN = rf"(?U)(?:\G|(?<!{_USER}))(?:(?!\b){_USER})*+(\b{_USER}++@{_DOMAIN})"


def mailto_addresses(hrefs: Column) -> Column:
    """Addresses of mailto links, lower case. They are taken as they are: no deny list applies."""
    links = F.filter(F.transform(hrefs, strip), lambda h: F.lower(h).startswith("mailto:"))
    targets = F.transform(links, lambda h: strip(F.substring_index(F.regexp_replace(h, "^[^:]*:", ""), "?", 1)))
    return F.transform(F.filter(targets, lambda t: t.rlike("^" + ADDRESS)), F.lower)


def text_addresses(text: Column) -> Column:
    """All addresses in a text, lower case, repeats included."""
    found = F.regexp_extract_all(text, F.lit(ADDRESS_SCAN), F.lit(1))
    return F.when(text.contains("@"), F.transform(found, F.lower)).otherwise(F.array().cast("array<string>"))


def is_allowed(
    address: Column,
    domains: Sequence[str] = params.DENIED_EMAIL_DOMAINS,
    endings: Sequence[str] = params.DENIED_EMAIL_ENDINGS,
    users: Sequence[str] = params.DENIED_EMAIL_USERS,
) -> Column:
    """No asset file name, placeholder domain (exact) or placeholder user (exact)."""
    user, domain = F.substring_index(address, "@", 1), F.substring_index(address, "@", -1)
    return ~domain.rlike(any_of(endings) + "$") & ~domain.isin(*domains) & ~user.isin(*users)


def allowed_text_addresses(text: Column) -> Column:
    return F.filter(text_addresses(text), lambda a: is_allowed(a))


def _site_links(hrefs: Column) -> Column:
    ours = F.filter(F.transform(hrefs, strip), lambda h: h.contains("linkedin.com"))
    return F.transform(ours, lambda h: F.rtrim(F.substring_index(h, "?", 1), F.lit("/")))


def anchor_profiles(hrefs: Column) -> Column:
    """Profile links in anchors, kept as written up to the query."""
    return F.filter(_site_links(hrefs), lambda u: u.contains("/in/"))


def anchor_companies(hrefs: Column) -> Column:
    return F.filter(_site_links(hrefs), lambda u: ~u.contains("/in/") & u.contains("/company/"))


def _rebuilt(html: Column, pattern: str, root: str) -> Column:
    handles = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(pattern), F.lit(1))
    return F.transform(handles, lambda h: F.concat(F.lit(root), h))


def markup_profiles(html: Column) -> Column:
    """Profile links anywhere in the HTML, scripts included, rebuilt from their handle."""
    return _rebuilt(html, PROFILE_LINK, PROFILE_ROOT)


def markup_companies(html: Column) -> Column:
    return _rebuilt(html, COMPANY_LINK, COMPANY_ROOT)


def distinct_sorted(*lists: Column) -> Column:
    return F.array_sort(F.array_distinct(F.concat(*lists)))


def profile_in_text(text: Column, reserved: Sequence[str] = params.RESERVED_HANDLES) -> Column:
    """Profile URL of the first match, rebuilt; null if there is none or its handle is reserved."""
    handle = F.regexp_extract(text, ANY_PROFILE_LINK, 1)
    usable = (handle != "") & ~F.lower(handle).isin(*reserved)
    return F.when(usable, F.concat(F.lit(PROFILE_ROOT), handle))
