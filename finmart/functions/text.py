"""Text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters of Portuguese and their plain forms, position by position.
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçñÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑ"
PLAIN = "aaaaaeeeeiiiiooooouuuucnAAAAAEEEEIIIIOOOOOUUUUCN"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The Unicode white-space characters.
WHITE_SPACE = (" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
               "\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def trim_all(c) -> Column:
    """Strip every kind of white space, tabs and line ends too, from both ends."""
    return F.btrim(_c(c), F.lit(WHITE_SPACE))


def deaccent(c) -> Column:
    return F.translate(_c(c), ACCENTED, PLAIN)
