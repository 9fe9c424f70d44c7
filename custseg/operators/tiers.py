"""Feature tiers and segment names (declared by the source project's defaults, not used by
its pipeline): each feature is cut into 4 tiers at its quartiles, the tiers are summed into
a score, and the score is named by thresholds.

Tier of x = number of quartile bounds strictly below x (frequency, monetary: higher is
better) or strictly above x (recency: lower is better), 0..3. Score = sum of tiers (0..9).
Segment = the name with the largest threshold the score exceeds ("score > 8" -> top, > 6
-> high, > 3 -> medium, > 0 -> low); a score of 0 exceeds none and is null.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.quantiles import quantile_lists

HIGHER_IS_BETTER = {"recency": False, "frequency": True, "monetary": True}


def tier_bounds(df: DataFrame, features: list[str], n_tiers: int) -> dict[str, list[float]]:
    levels = [float(v) for v in np.linspace(0, 1, n_tiers + 1)[1:-1]]
    found = quantile_lists(df, features, levels)
    return {f: found[f][1] if f in found else [0.0] * len(levels) for f in features}


def rfm_tiers(df: DataFrame, tiers: dict[str, int] = C.RFM_TIERS_PER_FEATURE,
              segments: dict[str, int] = C.RFM_SCORE_SEGMENT_GT,
              higher_is_better: dict[str, bool] = HIGHER_IS_BETTER) -> DataFrame:
    """Adds ``<feature>_tier``, ``rfm_score`` and ``segment``. The bounds are a k-row summary
    (one aggregate); the tiers are literal comparisons."""
    feats = list(tiers)
    bounds = {}
    for n in sorted(set(tiers.values())):
        group = [f for f in feats if tiers[f] == n]
        bounds.update(tier_bounds(df, group, n))
    out = df
    for f in feats:
        x = F.col(f).cast("double")
        if higher_is_better.get(f, True):
            parts = [(x > F.lit(b)).cast("int") for b in bounds[f]]
        else:
            parts = [(x < F.lit(b)).cast("int") for b in bounds[f]]
        out = out.withColumn(f + "_tier", sum(parts[1:], parts[0]) if parts else F.lit(0))
    score = sum((F.col(f + "_tier") for f in feats[1:]), F.col(feats[0] + "_tier"))
    out = out.withColumn("rfm_score", score)
    name = F.lit(None).cast("string")
    for seg, gt in sorted(segments.items(), key=lambda kv: kv[1]):
        name = F.when(F.col("rfm_score") > gt, F.lit(seg)).otherwise(name)
    return out.withColumn("segment", name)
