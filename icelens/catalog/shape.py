"""One output description used on both sides of a check.

``"season game_id:l toi:r6 team:s"`` lists columns with a type: ``l`` 64-bit integer,
``r6`` double rounded to 6 digits (negative zero removed), ``s`` text, ``b`` boolean as
0/1, ``a`` array joined with commas; without a type the column passes as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _parse(spec: str) -> list[tuple[str, str]]:
    return [tuple(item.split(":")) if ":" in item else (item, "s") for item in spec.split()]


def shaped(df: DataFrame, spec: str) -> DataFrame:
    def cast(name: str, kind: str) -> Column:
        col = F.col(name)
        if kind in ("l", "b"):
            return col.cast("long")
        if kind.startswith("r"):
            value = F.round(col.cast("double"), int(kind[1:]))
            return F.when(value == 0, F.lit(0.0)).otherwise(value)
        if kind == "a":
            return F.concat_ws(",", col.cast("array<string>"))
        return col.cast("string")

    return df.select(*[cast(n, k).alias(n) for n, k in _parse(spec)])


def shaped_sql(query: str, spec: str, source: str) -> str:
    """Finish ``query`` (a list of CTEs, ``WITH ...``) with the columns of ``source``."""
    def cast(name: str, kind: str) -> str:
        if kind in ("l", "b"):
            return f"CAST({name} AS BIGINT) AS {name}"
        if kind.startswith("r"):
            value = f"ROUND(CAST({name} AS DOUBLE), {kind[1:]})"
            return f"CASE WHEN {value} = 0 THEN 0.0::DOUBLE ELSE {value} END AS {name}"
        if kind == "a":
            return f"array_to_string({name}, ',') AS {name}"
        return f"CAST({name} AS VARCHAR) AS {name}"

    columns = ", ".join(cast(n, k) for n, k in _parse(spec))
    return f"{query}\nSELECT {columns} FROM {source}"
