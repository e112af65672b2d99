"""Strings, query strings and cookies."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(text: Column) -> Column:
    """True for null and for the empty string."""
    return text.isNull() | (text == "")


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def query_param(query: Column, name: str) -> Column:
    """The value of ``name`` in a query string, ``''`` when there is none.

    The key ignores case, the last usable pair wins, a pair needs exactly one
    value, and trailing ``=`` signs do not count. One greedy match finds the
    last pair without splitting the text.
    """
    pattern = rf"(?is)^(?:.*&)?{re.escape(name)}=([^=&]+)=*(?:&.*)?$"
    return F.coalesce(F.regexp_extract(query, pattern, 1), F.lit(""))


def query_string(url: Column) -> Column:
    """The part of a URL between ``?`` and ``#``; null when there is none."""
    return blank_to_null(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1))


def missing(message: Column) -> Column:
    """Whether a message is null or has white space only."""
    return message.isNull() | (F.trim(message) == "")


def json_map(text: Column, on_error: str = "fail") -> Column:
    """A JSON object as a map of strings; nested values stay JSON text.

    Blank and missing text is no map. Damaged text stops the job; with
    ``on_error='quarantine'`` it gives null, and :func:`damaged_map` tells which
    rows to set apart.
    """
    if on_error not in ("fail", "quarantine"):
        raise ValueError(f"on_error must be fail or quarantine, not {on_error!r}")
    there = F.when(~missing(text), text)
    parsed = F.from_json(there, "map<string,string>")
    if on_error == "quarantine":
        return parsed
    stop = F.raise_error(F.lit("damaged JSON object"))
    return F.when(there.isNotNull() & parsed.isNull(), stop).otherwise(parsed)


def damaged_map(text: Column) -> Column:
    """Whether there is text that is no readable JSON object."""
    return ~missing(text) & F.from_json(text, "map<string,string>").isNull()


# Cookie keys and the text for an unknown skin.
COOKIE_OPEN_ID = "cookie_open_id"
COOKIE_SESSION = "JSESSIONID"
COOKIE_SKIN = "mulri_skin_id"
UNKNOWN_SKIN = "未知"


def cookie_user(user_id: Column, cookie: Column, on_error: str = "fail") -> Column:
    """The user id, else an id from the cookie, ``''`` if the cookie has none.

    A damaged cookie stops the job where it is needed; with
    ``on_error='quarantine'`` it gives null.
    """
    jar = json_map(cookie, on_error)
    from_cookie = F.coalesce(
        blank_to_null(F.try_element_at(jar, F.lit(COOKIE_OPEN_ID))),
        F.try_element_at(jar, F.lit(COOKIE_SESSION)),
        F.lit(""),
    )
    if on_error == "quarantine":
        from_cookie = F.when(~damaged_map(cookie), from_cookie)
    return F.when(~is_blank(user_id), user_id).when(~is_blank(cookie), from_cookie)


def cookie_skin(cookie: Column, on_error: str = "fail") -> Column:
    """The skin named in the cookie, else the unknown marker; damage as above."""
    jar = json_map(cookie, on_error)
    skin = F.coalesce(F.try_element_at(jar, F.lit(COOKIE_SKIN)), F.lit(UNKNOWN_SKIN))
    return skin if on_error == "fail" else F.when(
        ~F.coalesce(damaged_map(cookie), F.lit(False)), skin)
