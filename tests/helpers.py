from __future__ import annotations

import io
from collections import Counter
from contextlib import redirect_stdout


def rows(df):
    """All rows as plain tuples, in an order of their own."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def explained(df) -> str:
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()
