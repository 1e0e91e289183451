"""Small helpers that print the same fixed dimensions/buckets as SQL text for
the DuckDB oracle (so the oracle and the Spark query share one definition)."""

from __future__ import annotations

from collections.abc import Sequence


def lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    return repr(v)


def bucket_case(col: str, edges: Sequence[float], labels: Sequence[str], include_lowest: bool = False) -> str:
    parts = []
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        lower = f"{col} >= {lo}" if (include_lowest and i == 0) else f"{col} > {lo}"
        cond = lower if hi == float("inf") else f"{lower} AND {col} <= {hi}"
        parts.append(f"WHEN {cond} THEN {lit(labels[i])}")
    return "CASE " + " ".join(parts) + " END"


def values_table(name: str, columns: Sequence[str], rows: Sequence[Sequence]) -> str:
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"{name}({', '.join(columns)}) AS (SELECT * FROM (VALUES {body}) AS t({', '.join(columns)}))"


def round_sig(expr: str, digits: int = 9) -> str:
    """SQL twin of ``hearth.functions.exprs.round_sig``."""
    x = f"({expr})"
    up = f"({digits - 1} - floor(log10(abs({x}))))"
    return (f"CASE WHEN {x} = 0 OR {x} IS NULL OR isnan({x}) THEN {x} "
            f"WHEN {up} >= 0 THEN round({x} * pow(10.0, {up})) / pow(10.0, {up}) "
            f"ELSE round({x} / pow(10.0, -{up})) * pow(10.0, -{up}) END")
