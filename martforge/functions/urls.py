"""URL helpers: host, query parameters, cut at a marker, strip query string.

All are JVM-side string expressions.  The host is cut leniently, as the source's
URL parser does: the scheme is optional, characters that RFC 3986 forbids do not
matter, and a port or user part is left out.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def url_host(col) -> Column:
    """Lower-cased host of a URL, the scheme being optional; NULL when there is none."""
    host = F.regexp_extract(_c(col), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.lower(F.nullif(host, F.lit("")))


def referrer_host(col, none_label: str = "none") -> Column:
    """Host of a referrer, or ``none_label`` when there is no referrer."""
    c = _c(col)
    return F.when(c.isNull(), F.lit(none_label)).otherwise(url_host(c))


def url_param(col, name: str) -> Column:
    """Value of query parameter ``name`` (first occurrence), NULL if absent or empty."""
    pat = r"[?&]" + re.escape(name) + r"=([^&#]*)"
    return F.nullif(F.regexp_extract(_c(col), pat, 1), F.lit(""))


def strip_query(col) -> Column:
    """Remove everything from the first ``?``."""
    return F.regexp_replace(_c(col), r"\?.*$", "")


def split_at(col, marker: str) -> tuple[Column, Column]:
    """Split into (text before the first marker, text between first and second marker).

    Missing second part is NULL; extra parts are dropped; NULL input gives (NULL, NULL).
    """
    parts = F.split(_c(col), re.escape(marker))
    return F.get(parts, 0), F.get(parts, 1)
