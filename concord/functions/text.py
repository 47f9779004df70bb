"""White space as Python's ``str.strip()`` sees it, in JVM functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
# Python's str.strip() whitespace: Unicode White_Space plus \x1c-\x1f.
WS = r"[\s\x{1C}-\x{1F}]"
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
            "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def strip_ws(c: Column) -> Column:
    """``str.strip()``: leading and trailing Unicode whitespace (a character-set trim, no regex)."""
    return F.btrim(c, F.lit(WS_CHARS))
