"""The quality score of a trajectory, in hundredths so that sums are exact."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import filled


def heuristic(outcome: Column, context: Column, signals: Column, events: Column, n_commits: Column, warnings: Column) -> Column:
    """0.5, a tenth each for merged, a context, signals and a passed validation; half a tenth for 3 commits, less for redactions."""
    size = lambda a: F.coalesce(F.size(a), F.lit(0))
    told = F.coalesce(F.exists(warnings, lambda w: F.contains(w, F.lit("redacted"))), F.lit(False))
    passed = F.coalesce(F.exists(events, lambda e: e["result"] == "pass"), F.lit(False))
    points = lambda when, n: F.when(when, n).otherwise(0)
    total = F.lit(50) + points(outcome == "merged", 10) + points(filled(context).isNotNull(), 10) + points(size(signals) > 0, 10) + points(passed, 10) + points(F.coalesce(n_commits, F.lit(0)) >= 3, 5) - points(told, 5)
    return F.least(F.greatest(total, F.lit(0)), F.lit(100)).cast("double") / 100
