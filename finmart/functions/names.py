"""Column-name cleaners: pure functions on names, applied with :func:`rename_by`."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame


def first_line(name: str) -> str:
    return name.partition("\n")[0]


def underscored(name: str) -> str:
    return name.strip().replace(" ", "_")


def lower_underscored(name: str) -> str:
    """Lower case, spaces to ``_``, no commas."""
    return name.replace(",", "").replace(" ", "_").lower()


def without_spaces(name: str) -> str:
    return name.replace(" ", "")


def deaccented(name: str) -> str:
    return "".join(ch for ch in unicodedata.normalize("NFKD", name) if not unicodedata.combining(ch))


def snake(name: str) -> str:
    """Plain ASCII lower snake case; camel-case humps and every other run of characters become ``_``."""
    text = deaccented(name)
    text = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", text)
    return re.sub(r"[^0-9a-z]+", "_", text.lower()).strip("_")


def unique(names: Iterable[str]) -> list[str]:
    """Give the second and later bearers of a name a suffix ``_1``, ``_2``, ..."""
    seen: dict[str, int] = {}
    out: list[str] = []
    for name in names:
        n = seen.get(name, 0)
        seen[name] = n + 1
        out.append(f"{name}_{n}" if n else name)
    return out


def rename_by(df: DataFrame, *cleaners: Callable[[str], str]) -> DataFrame:
    """Apply the cleaners, in order, to every column name."""
    names = df.columns
    for clean in cleaners:
        names = [clean(n) for n in names]
    return df.toDF(*unique(names))
