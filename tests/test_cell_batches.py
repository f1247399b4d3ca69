"""Rows go to cells in short batches."""

import numpy as np
import pandas as pd

from tallyguard.operators import neighbours


def test_cells_are_sent_in_short_batches():
    rows = pd.DataFrame({"key": [str(i) for i in range(5000)], "vec": [np.array([float(i)]) for i in range(5000)]})
    assert max(len(p) for p in neighbours._parts([rows])) <= neighbours.SENT_ROWS
    row = np.repeat(np.arange(5000), 7)
    sent = list(neighbours._sent(rows, row, np.tile(np.arange(7), 5000)))
    assert max(len(p) for p in sent) <= neighbours.SENT_ROWS
    back = pd.concat(sent)
    assert (back["key"].astype(int).to_numpy() == row).all() and (back["cell"].to_numpy() == np.tile(np.arange(7), 5000)).all()
