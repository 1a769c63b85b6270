"""Small tables for the operator tests."""

from __future__ import annotations

import os

import pandas as pd


def write_tables(folder, **tables: pd.DataFrame) -> str:
    for name, frame in tables.items():
        frame.to_parquet(os.path.join(str(folder), f"{name}.parquet"), index=False)
    return str(folder)


def rows(df) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]
