"""Route names, surrogate keys and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col

# The name spaces of RFC 4122.
NAMESPACE_DNS = "6ba7b8109dad11d180b400c04fd430c8"
NAMESPACE_URL = "6ba7b8119dad11d180b400c04fd430c8"


def route(origin: Column | str, destination: Column | str) -> Column:
    """``origin-destination``; a NULL end counts as empty text."""
    empty = F.lit("")
    return F.concat(F.coalesce(_col(origin), empty), F.lit("-"), F.coalesce(_col(destination), empty))


def route_ws(origin: Column | str, destination: Column | str) -> Column:
    """``origin-destination``; a NULL end is dropped together with the separator."""
    return F.concat_ws("-", _col(origin), _col(destination))


def md5_key(*cols: Column | str) -> Column:
    """Surrogate key over the parts; NULL parts are skipped."""
    return F.md5(F.concat_ws("|", *[_col(c).cast("string") for c in cols]))


def md5_id(*cols: Column | str) -> Column:
    """Row id over the parts; NULL parts keep their place as empty text."""
    return F.md5(F.concat_ws("|", *[F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]))


def uuid5(c: Column | str, namespace: str = NAMESPACE_URL) -> Column:
    """Name-based version 5 UUID of the text."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(_col(c), "UTF-8")))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab" * 4)
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )
