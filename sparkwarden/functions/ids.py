"""Session ids: name-based UUIDs (version 5) computed inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the URL namespace of RFC 4122.
NAMESPACE_URL = "6ba7b8119dad11d180b400c04fd430c8"


def name_digest(name: Column) -> Column:
    """SHA-1 of namespace and name, as 40 hex digits."""
    return F.sha1(F.concat(F.unhex(F.lit(NAMESPACE_URL)), F.encode(name, "UTF-8")))


def uuid5_from_digest(digest: Column) -> Column:
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def session_name(src_ip: Column, tool: Column, index: Column) -> Column:
    return F.concat_ws("|", src_ip, tool, index.cast("string"))
