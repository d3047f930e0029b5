"""Typed access to raw provider records, whether JSON text or columns.

Both readers answer the same questions (``text``, ``whole``, ``epoch``, ``flag``), so a
normalizer is written once and keeps column pruning when the dump is columnar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .times import epoch_seconds

_WHOLE = r"^\s*[+-]?[0-9]+\s*$"


class JsonFields:
    """Fields of a parsed JSON record (``VARIANT`` column)."""

    def __init__(self, variant: Column):
        self._variant = variant

    def text(self, name: str) -> Column:
        return F.try_variant_get(self._variant, f"$.{name}", "string")

    def whole(self, name: str) -> Column:
        return F.try_variant_get(self._variant, f"$.{name}", "bigint")

    def epoch(self, name: str) -> Column:
        return epoch_seconds(self.text(name))

    def flag(self, name: str) -> Column:
        return F.try_variant_get(self._variant, f"$.{name}", "boolean")


class TakenFields:
    """Fields of a parsed JSON record, each taken out of it once however often it is asked for.

    Answers refer to fields of the struct column ``place``; ``struct`` makes it once all have been asked for.
    """

    def __init__(self, variant: Column, place: str):
        self._json, self._place = JsonFields(variant), place
        self._taken: dict[str, Column] = {}

    def _take(self, kind: str, name: str) -> Column:
        key = f"{kind}_{name}"
        self._taken.setdefault(key, getattr(self._json, kind)(name).alias(key))
        return F.col(f"{self._place}.{key}")

    def text(self, name: str) -> Column:
        return self._take("text", name)

    def whole(self, name: str) -> Column:
        return self._take("whole", name)

    def epoch(self, name: str) -> Column:
        return self._take("epoch", name)

    def flag(self, name: str) -> Column:
        return self._take("flag", name)

    def struct(self) -> Column:
        return F.struct(*self._taken.values())


class ColumnFields:
    """Fields of a columnar record; a field the dump lacks is null."""

    def __init__(self, df: DataFrame):
        self._types = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def _column(self, name: str) -> Column:
        return F.col(name) if name in self._types else F.lit(None)

    def text(self, name: str) -> Column:
        return self._column(name).cast("string")

    def whole(self, name: str) -> Column:
        column = self._column(name)
        if self._types.get(name) == "string":
            column = F.when(F.rlike(column, F.lit(_WHOLE)), column)
        return column.try_cast("bigint")

    def epoch(self, name: str) -> Column:
        if self._types.get(name) in ("bigint", "int", "smallint", "tinyint"):
            return F.col(name).cast("bigint")
        return epoch_seconds(self.text(name))

    def flag(self, name: str) -> Column:
        return self._column(name).try_cast("boolean")
