"""Line similarity (twice the matched characters over the total) as a pandas UDF."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Lines whose lengths differ by more than this share of the longer one are not compared.
LENGTH_GATE = 0.5
#: A match this good ends the search.
ENOUGH = 0.995


def near_in_length(line: Column, others: Column, gate: float = LENGTH_GATE) -> Column:
    """Those of the other lines that are worth comparing."""
    size = F.length(line)
    return F.filter(others, lambda x: F.abs(F.length(x) - size) <= gate * F.greatest(F.length(x), size))


@F.pandas_udf(DoubleType())
def best_line_ratio(lines: pd.Series, candidates: pd.Series) -> pd.Series:
    """The best ratio of each line to any of its candidates, 0 without; the first that is good enough counts."""

    def search(line, others):
        found, matcher = 0.0, SequenceMatcher(None, "", line, False)
        for other in others:
            matcher.set_seq1(other)
            # two upper bounds come before the ratio
            if min(matcher.real_quick_ratio(), matcher.quick_ratio()) > found:
                found = max(found, matcher.ratio())
            if found >= ENOUGH:
                return found
        return found

    return pd.Series([search(x, c) for x, c in zip(lines, candidates)], dtype="float64")
