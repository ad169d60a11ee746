"""Order-free comparison of two result frames."""

from __future__ import annotations

import decimal
import math

import pandas as pd


def _cell(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
        return "~"
    if isinstance(x, decimal.Decimal):
        return f"{x:f}"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, float):
        return repr(x + 0.0) if x != 0 else "0.0"
    return str(x)


def _rows(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    return sorted(tuple(_cell(x) for x in row) for row in frame[columns].astype(object).itertuples(index=False))


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None when both hold the same columns and rows, else what differs first."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for c in got.columns:  # an integer column with nulls is a float column on one side
        if {got[c].dtype.kind, want[c].dtype.kind} == {"i", "f"}:
            got, want = (f.assign(**{c: f[c].astype("Int64")}) if f[c].isna().any() else f for f in (got, want))
    kinds = lambda f: {c: ("f" if f[c].dtype.kind == "f" else f[c].dtype.kind) for c in f.columns}
    a, b = _rows(got), _rows(want)
    for left, right in zip(a, b):
        if left != right:
            return f"values {left} != {right}; kinds {kinds(got)} / {kinds(want)}"
    return None
