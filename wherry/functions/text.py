"""Normalization of identifiers and URLs, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Numbers that are placeholders, not people: counted up or down, or with seven equal digits at the end.
PHONE_SEQUENCES = r"^(0123456789|1234567890|234567890[0-9]|9876543210)$"
PHONE_REPEATS = r"(0000000|1111111|2222222|3333333|4444444|5555555|6666666|7777777|8888888|9999999)$"


def blank_to_null(c: Column) -> Column:
    trimmed = F.trim(c)
    return F.when(trimmed != "", trimmed)


def anonymous_key(c: Column) -> Column:
    """Trimmed, case kept; null if blank."""
    return blank_to_null(c)


def lowered_key(c: Column) -> Column:
    """Trimmed and lower-cased; null if blank."""
    return F.lower(blank_to_null(c))


def canonical_email(c: Column) -> Column:
    """For Gmail addresses: without dots and suffix, at gmail.com; null for other hosts."""
    email = lowered_key(c)
    local, host = F.split_part(email, F.lit("@"), F.lit(1)), F.split_part(email, F.lit("@"), F.lit(2))
    plain = F.regexp_replace(F.split_part(local, F.lit("+"), F.lit(1)), r"\.", "")
    return F.when(host.isin("gmail.com", "googlemail.com") & (plain != ""), F.concat(plain, F.lit("@gmail.com")))


def nanp_phone(c: Column) -> Column:
    """+1 and ten digits for a valid North American number; null otherwise."""
    digits = F.regexp_replace(c, r"\D", "")
    ten = F.when((F.length(digits) == 11) & digits.startswith("1"), F.substring(digits, 2, 10)).otherwise(digits)
    valid = ten.rlike(r"^[2-9]\d{2}[2-9]\d{6}$") & (F.substring(ten, 4, 3) != "555") & ~ten.rlike(PHONE_REPEATS) & ~ten.rlike(PHONE_SEQUENCES)
    return F.when(valid, F.concat(F.lit("+1"), ten))


def evidence_keys(**identifiers: Column) -> Column:
    """Sorted array of type:value for the identifiers that are there."""
    tagged = [F.when(c.isNotNull(), F.concat(F.lit(f"{kind}:"), c)) for kind, c in identifiers.items()]
    return F.array_sort(F.filter(F.array(*tagged), lambda x: x.isNotNull()))


def query_parameter(url: Column, name: str) -> Column:
    """The first value of a parameter in the query string, not in the fragment; null if missing or empty."""
    query = F.regexp_extract(F.split_part(url, F.lit("#"), F.lit(1)), r"\?(.*)$", 1)
    value = F.regexp_extract(query, rf"(?:^|&){name}=([^&]*)", 1)
    return F.when(value != "", value)


def url_host(url: Column) -> Column:
    """The host, lower-cased, without port and leading www."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1))
    plain = F.regexp_replace(host, r"^www\.", "")
    return F.when(plain != "", plain)


def url_path(url: Column) -> Column:
    """The path without query and fragment and without a closing slash; / for the root."""
    path = F.regexp_replace(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), r"/+$", "")
    return F.when(path == "", F.lit("/")).otherwise(path)


#: Channel -> the hosts, with any subdomain, that belong to it.
CHANNEL_HOSTS = {
    "meta": r"(^|\.)(facebook\.com|instagram\.com)$", "google": r"(^|\.)(google\.com|google\.[a-z]{2,3})$|^com\.google\.", "bing": r"(^|\.)(bing\.com)$",
    "youtube": r"(^|\.)(youtube\.com|youtu\.be)$", "trustpilot": r"(^|\.)(trustpilot\.com)$",
}


def is_host_of(host: Column, channel: str) -> Column:
    """Whether a host is one of a channel's or under it; null for null."""
    return F.lower(host).rlike(CHANNEL_HOSTS[channel])


def hash_key(*parts: Column) -> Column:
    """Lower-case MD5 of the parts joined by |; null if any part is."""
    return F.when(F.greatest(*[p.isNull() for p in parts]) if len(parts) > 1 else parts[0].isNull(), F.lit(None)).otherwise(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])))


def first_known(*columns: Column) -> Column:
    """The first column that is neither null nor blank."""
    return F.coalesce(*[blank_to_null(c) for c in columns])
