"""Small helpers shared by the tests."""

from contextlib import redirect_stdout
from datetime import datetime
from io import StringIO


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def plan(df, mode: str = "simple") -> str:
    out = StringIO()
    with redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
