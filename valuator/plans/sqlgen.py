"""Small helpers that render the oracle SQL from the same fixed values the
Spark operators use (band bounds, label lists)."""

from __future__ import annotations

from collections.abc import Sequence


def band_case(expr: str, bands: Sequence[tuple[float, float]], gaps: str = "reference") -> str:
    parts = []
    for i, (lo, hi) in enumerate(bands):
        if gaps == "reference":
            parts.append(f"WHEN abs({expr}) >= {lo} AND abs({expr}) <= {hi} THEN {i}")
        else:
            parts.append(f"WHEN abs({expr}) <= {hi} THEN {i}")
    return f"CAST(CASE {' '.join(parts)} ELSE {len(bands)} END AS INTEGER)"


def r6(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6)"
