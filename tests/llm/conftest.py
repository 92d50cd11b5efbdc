import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from brute import documents, edited, prose  # noqa: E402


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, short, very long, repeated and copied texts."""
    base = prose(1, 120)
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "One"), (5, "a b c d"), (6, "a b c d"),
            (7, base), (8, base), (8, base), (9, base.upper()), (10, edited(base, 2, 0.02)),
            (11, edited(base, 3, 0.03)), (12, prose(9, 30000, 5000)), (None, base), (None, None),
            (13, "é ü 中文 mot " * 20), (14, "x " * 300)]
    rows += [(20 + k, edited(prose(100 + k // 6, 150), k, 0.004 * (k % 6))) for k in range(60)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return documents(spark, odd_rows)


@pytest.fixture(scope="session")
def none(spark):
    return documents(spark, [])
