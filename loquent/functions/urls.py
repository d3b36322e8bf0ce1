"""Video URL predicates and parts as column expressions.

The parts come from regular expressions rather than ``parse_url``, which fails
on malformed URLs and rejects hosts with an underscore.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from loquent.functions.text import strip

# Hosts, URL shapes, messages and canonical form that users of
# the video site rely on.
VIDEO_HOSTS = ("youtube.com", "youtu.be")
SHORT_LINK_HOSTS = ("youtu.be",)
VIDEO_PARAMETER = "v"
LIST_MARKER = "list="
URL_SHAPES = (
    r"^https://(www\.)?youtube\.com/watch\?.*v=[\w-]+",
    r"^https://youtu\.be/[\w-]+",
    r"^https://(www\.)?youtube\.com/playlist\?.*list=[\w-]+",
)
CANONICAL_PREFIX = "https://www.youtube.com/watch?v="
EMPTY_URL_MESSAGE = "Please enter a YouTube URL"
WRONG_URL_MESSAGE = "Must be a youtube.com or youtu.be URL"
WRONG_HOST_MESSAGE = "Not a YouTube URL: "

_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*"
_HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#]*@)?([^/?#:@]+)"
_PATH = _AUTHORITY + r"([^?#]*)"
_QUERY = r"^[^?#]*\?([^#]*)"


def host(url: Column) -> Column:
    """Lower-case host name; '' when there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1))


def _equals_or_below(name: Column, domains: Sequence[str]) -> Column:
    found = name.isin(list(domains))
    for domain in domains:
        found = found | name.endswith("." + domain)
    return found


def host_allowed(url: Column, hosts: Sequence[str] = VIDEO_HOSTS) -> Column:
    """True if the host is one of ``hosts`` or below one of them."""
    bare = F.regexp_replace(host(url), r"^www\.", "")
    return _equals_or_below(bare, hosts)


def is_list_url(url: Column) -> Column:
    """True if the URL carries a list parameter anywhere."""
    return F.coalesce(url, F.lit("")).contains(LIST_MARKER)


def video_id(
    url: Column,
    short_hosts: Sequence[str] = SHORT_LINK_HOSTS,
    parameter: str = VIDEO_PARAMETER,
) -> Column:
    """Video id readable from the URL alone, or null.

    Short links carry it as their path; on every other host it is the first
    non-blank ``parameter``. The host is not checked against an allowlist.
    """
    text = F.coalesce(url, F.lit(""))
    path = F.regexp_replace(F.regexp_extract(text, _PATH, 1), r"^/+|;[^/]*$", "")
    query = F.regexp_extract(text, _QUERY, 1)
    raw = F.regexp_extract(query, rf"(?:^|&){parameter}=([^&]+)", 1)
    decoded = F.coalesce(F.try_url_decode(raw), raw)
    is_short = _equals_or_below(host(text), short_hosts)
    return F.nullif(F.when(is_short, path).otherwise(decoded), F.lit(""))


def validate(url: Column) -> Column:
    """STRUCT<ok, kind>: kind is 'video' or 'playlist', or a message if not ok."""
    clean = strip(F.coalesce(url, F.lit("")))
    known = F.lit(False)
    for shape in URL_SHAPES:
        known = known | clean.rlike("(?U)" + shape)
    kind = (
        F.when(clean == "", F.lit(EMPTY_URL_MESSAGE))
        .when(~known, F.lit(WRONG_URL_MESSAGE))
        .when(is_list_url(clean), F.lit("playlist"))
        .otherwise(F.lit("video"))
    )
    return F.struct(known.alias("ok"), kind.alias("kind"))


def canonical_url(identifier: Column) -> Column:
    return F.concat(F.lit(CANONICAL_PREFIX), identifier)
