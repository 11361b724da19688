"""Expressions on the text of one request: time, user agent and URL."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from logwarden import fixed_values as V


def contains_any(text: Column, tokens: Sequence[str]) -> Column:
    """True when ``text`` holds one of ``tokens``; a token that contains another adds nothing."""
    needed = [t for t in tokens if not any(o != t and o in t for o in tokens)]
    return reduce(lambda a, b: a | b, [text.contains(t) for t in needed])


def lowered(text: Column) -> Column:
    """Lower-case text with NULL read as empty, so the flags built on it are never NULL."""
    return F.lower(F.coalesce(text, F.lit("")))


def _matched(value: Column, pattern: str, group: int) -> Column:
    """Matched text or NULL. An empty text would do too, but each failing try_cast costs
    a Java exception, so the common misses are kept away from it."""
    return F.nullif(F.regexp_extract(value, pattern, group), F.lit(""))


def parse_event_time(timestamp: Column) -> Column:
    """Wall-clock time of ``yyyy-MM-dd HH:mm:ss[.ffffff]`` text, NULL for anything else.

    TIMESTAMP_NTZ keeps the result independent of the session time zone.
    """
    return _matched(timestamp, V.TIMESTAMP_PATTERN, 0).try_cast("timestamp_ntz")


def is_bot(user_agent: Column) -> Column:
    return contains_any(lowered(user_agent), V.BOT_TOKENS)


def browser_type(user_agent: Column) -> Column:
    """Client family; tools and scanners win over the browser they claim to be."""
    agent = lowered(user_agent)
    tool = reduce(
        lambda a, b: a | b,
        [agent.startswith(p) for p in V.BOT_PREFIXES],
        contains_any(agent, V.BOT_TOKENS),
    )
    family = F.when(tool, "Bot/Tool").when(contains_any(agent, V.SCANNER_TOKENS), "Scanner")
    for label, tokens in V.BROWSER_TOKENS:
        family = family.when(contains_any(agent, tokens), label)
    return family.otherwise("Other")


def base_url(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def has_suspicious_params(url: Column, tokens: Sequence[str] = V.SUSPICIOUS_TOKENS) -> Column:
    return contains_any(lowered(url), tokens).cast("int")


def trailing_id(path: Column) -> Column:
    """Number after the last slash; NULL without one or when it exceeds a long."""
    return _matched(path, r"/(\d+)$", 1).try_cast("long")


def is_post_login(path: Column, method: Column) -> Column:
    return F.when((path == "/login") & (method == "POST"), 1).otherwise(0)


def is_error(status: Column) -> Column:
    return F.when(status >= 400, 1).otherwise(0)


def is_offhours(event_time: Column) -> Column:
    hour = F.hour(event_time)
    return ((hour < V.OFFHOURS_BEFORE) | (hour > V.OFFHOURS_AFTER)).cast("int")
