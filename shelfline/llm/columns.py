"""Working on tables whose own columns may have any names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def free(name: str, taken: Sequence[str]) -> str:
    """``name`` with as many leading underscores as it takes to differ from the names taken, whatever their case."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


class Numbered:
    """A table under numbered column names, so that names used inside an operator cannot meet its own."""

    def __init__(self, docs: DataFrame) -> None:
        self.names = docs.columns
        self.df = docs.toDF(*[f"c{i}" for i in range(len(self.names))])

    def at(self, name: str) -> str:
        """The column that is called ``name``; the first of several."""
        lower = [n.lower() for n in self.names]
        return f"c{self.names.index(name) if name in self.names else lower.index(name.lower())}"

    def back(self, df: DataFrame, **new: Column) -> DataFrame:
        """``df`` under the old names, with new columns under free ones."""
        own = [F.col(f"c{i}").alias(n) for i, n in enumerate(self.names)]
        return df.select(*own, *[c.alias(free(n, self.names)) for n, c in new.items()])
