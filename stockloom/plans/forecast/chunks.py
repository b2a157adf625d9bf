"""Memory bound for steps that pad a batch of keys to its longest series."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd

# Bytes of one padded working set; a single longer series is a chunk of its own.
BUDGET = 64 << 20


def length_chunks(pdf: pd.DataFrame, column: str, step_bytes: int, budget: int | None = None, row_bytes: int = 0) -> Iterator[pd.DataFrame]:
    """Rows by rising length of an array column, cut where padding the chunk to
    its longest series would take more than ``budget`` bytes; every row takes
    ``row_bytes`` besides."""
    budget = BUDGET if budget is None else budget
    lengths = pdf[column].map(len).to_numpy()
    order = np.argsort(lengths, kind="stable")
    first = 0
    for i, row in enumerate(order):
        if i > first and (i + 1 - first) * (lengths[row] * step_bytes + row_bytes) > budget:
            yield pdf.iloc[order[first:i]].reset_index(drop=True)
            first = i
    if len(order) > first:
        yield pdf.iloc[order[first:]].reset_index(drop=True)
