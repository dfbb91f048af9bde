"""Names of columns that operators add to a caller's table or use inside."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fresh(columns: Sequence[str], *names: str) -> list[str]:
    """``names``, each with as many underscores before it as it takes to differ from ``columns`` and each other."""
    taken, out = {c.lower() for c in columns}, []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out


def make_room(df: DataFrame, *added: str) -> DataFrame:
    """``df`` whose columns named like an ``added`` one have ``input_`` before their name, as often as needed."""
    taken = {a.lower() for a in added} | {c.lower() for c in df.columns}
    names = {}
    for c in df.columns:
        new = c
        while new.lower() in {a.lower() for a in added} or new != c and new.lower() in taken:
            new = f"input_{new}"
        taken.add(new.lower())
        names[c] = new
    if all(c == n for c, n in names.items()):
        return df
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
