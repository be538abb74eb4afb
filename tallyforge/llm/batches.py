"""Slices of Arrow batches by text, since words as Python values take many times a text's room."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd

SLICE_CHARS = 4_000_000


def slices(pdf: pd.DataFrame, text: str = "text", rows: int = 1_000_000) -> Iterator[pd.DataFrame]:
    """pdf in order, in slices of at most `rows` rows and about SLICE_CHARS characters; a longer text makes its own slice."""
    total = np.cumsum([len(t) if isinstance(t, str) else 0 for t in pdf[text]])
    first = 0
    while first < len(pdf):
        done = total[first - 1] if first else 0
        n = min(rows, max(1, int(np.searchsorted(total, done + SLICE_CHARS)) - first))
        yield pdf.iloc[first : first + n]
        first += n
