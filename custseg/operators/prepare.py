"""Feature preparation: quantile transform to a normal, IQR outliers, standard scaling.

Fitting computes a handful of numbers per feature (50 quantiles, two quartiles, a mean and
a standard deviation); only those reach the driver. Transforming is then literal Column
arithmetic, fused into whole-stage codegen. Quantiles are exact (linear interpolation) and
ranked across partitions. Empty inputs give empty outputs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.stats import ppf_stages
from ..functions.quantiles import quantile_lists
from ..session import materialise


def quantile_levels(n_quantiles: int, n_rows: int) -> list[float]:
    m = max(1, min(n_quantiles, n_rows))
    return [float(v) for v in np.linspace(0.0, 1.0, m)] if m > 1 else [0.0]


@dataclass
class QuantileModel:
    references: list[float]
    quantiles: dict[str, list[float]]


def fit_quantile_transform(df: DataFrame, features: list[str], n_quantiles: int = C.N_QUANTILES,
                           approx: float | None = None) -> QuantileModel:
    """Quantiles at min(n_quantiles, n) evenly spaced levels; a feature without values maps to itself. Exact
    unless ``approx`` names the rank error of a one-pass sketch."""
    n = df.count()
    levels = quantile_levels(n_quantiles, n)
    found = quantile_lists(df, features, levels, approx)
    return QuantileModel(levels, {f: list(np.maximum.accumulate(found[f][1])) if f in found else [0.0] * len(levels)
                                  for f in features})


def _interp_parts(x, xp: list[float], fp: list[float]):
    """(count expression, value-given-count builder) for numpy.interp on literal knots."""
    m = len(xp)
    xs = F.array(*[F.lit(float(v)) for v in xp])
    fs = F.array(*[F.lit(float(v)) for v in fp])

    def value(c):
        xj, fj = F.element_at(xs, F.greatest(c, F.lit(1))), F.element_at(fs, F.greatest(c, F.lit(1)))
        xk = F.element_at(xs, F.least(c + 1, F.lit(m)))
        fk = F.element_at(fs, F.least(c + 1, F.lit(m)))
        return (F.when(x.isNull(), F.lit(None).cast("double"))
                .when(c == 0, F.lit(float(fp[0])))
                .when(c >= m, F.lit(float(fp[-1])))
                .when(xj == x, fj)
                .otherwise((fk - fj) / (xk - xj) * (x - xj) + fj))
    return F.size(F.filter(xs, lambda v: v <= x)), value


def quantile_transform(df: DataFrame, features: list[str], model: QuantileModel,
                       suffix: str = "") -> DataFrame:
    """Map each feature through its fitted quantiles to a standard normal score.

    p = mean of the forward and the mirrored interpolation (ties land mid-range);
    values within 1e-7 of either end map to 0 or 1 (the lower end wins); then the inverse
    normal CDF, clipped to the scores of 1e-7 and 1 - 1e-7. Built as a few wide projections
    over all features (intermediate columns keep every expression small).
    """
    base = df.columns
    refs = model.references
    nrefs = [-v for v in reversed(refs)]
    # stage 1: knot counts
    s1 = []
    for f in features:
        g = model.quantiles[f]
        x = F.col(f).cast("double")
        cf, _ = _interp_parts(x, g, refs)
        cb, _ = _interp_parts(-x, [-v for v in reversed(g)], nrefs)
        s1 += [cf.alias(f"_qf_{f}"), cb.alias(f"_qb_{f}")]
    out = df.select(*base, *s1)
    # stage 2: p in [0, 1]
    s2 = []
    for f in features:
        g = model.quantiles[f]
        x = F.col(f).cast("double")
        _, vf = _interp_parts(x, g, refs)
        _, vb = _interp_parts(-x, [-v for v in reversed(g)], nrefs)
        p = (F.when(x - C.BOUNDS_THRESHOLD < g[0], F.lit(0.0))
             .when(x + C.BOUNDS_THRESHOLD > g[-1], F.lit(1.0))
             .otherwise(F.lit(0.5) * (vf(F.col(f"_qf_{f}")) - vb(F.col(f"_qb_{f}")))))
        s2.append(p.alias(f"_qp_{f}"))
    out = out.select(*base, *s2)
    # stage 3/4: inverse normal CDF, clipped
    lo, hi = clip_bounds()
    out = ppf_stages(out, base, [f"_qp_{f}" for f in features], [f"_qz_{f}" for f in features])
    keep = [c for c in base if c not in [f + suffix for f in features]]
    return out.select(*keep, *[F.least(F.greatest(F.col(f"_qz_{f}"), F.lit(lo)), F.lit(hi)).alias(f + suffix)
                               for f in features])


def clip_bounds() -> tuple[float, float]:
    from statistics import NormalDist
    eps = float(np.spacing(1))
    nd = NormalDist()
    return nd.inv_cdf(C.BOUNDS_THRESHOLD - eps), nd.inv_cdf(1 - (C.BOUNDS_THRESHOLD - eps))


def iqr_bounds(df: DataFrame, cols: list[str], factor: float = C.IQR_FACTOR, approx: float | None = None
               ) -> dict[str, tuple[float, float]]:
    qs = quantile_lists(df, cols, [0.25, 0.75], approx)
    out = {}
    for c in cols:
        q1, q3 = qs[c][1] if c in qs else (float("-inf"), float("inf"))
        spread = factor * (q3 - q1)
        out[c] = (q1 - spread, q3 + spread)
    return out


def outlier_condition(bounds: dict[str, tuple[float, float]], cols: list[str], mode: str = "last",
                      suffix: str = ""):
    """Strictly outside [lo, hi]. ``last``: only the last column decides (the source's
    behaviour); ``any``: an outlier in any column."""
    def out(c):
        lo, hi = bounds[c]
        v = F.col(c + suffix).cast("double")
        return (v < F.lit(lo)) | (v > F.lit(hi))
    if mode == "last":
        return out(cols[-1])
    if mode == "any":
        cond = out(cols[0])
        for c in cols[1:]:
            cond = cond | out(c)
        return cond
    raise ValueError("mode must be 'last' or 'any'")


def remove_outliers(df: DataFrame, features: list[str] = C.RFM_FEATURES, mode: str = "last",
                    n_quantiles: int = C.N_QUANTILES, factor: float = C.IQR_FACTOR, approx: float | None = None) -> DataFrame:
    """Quantile-transform the features, flag IQR outliers there, drop those rows; the
    original feature values are kept.

    The transform is monotone (non-decreasing), so "score below the lower IQR bound" holds
    exactly for the data values below the smallest value whose score reaches the bound.
    Those two thresholds per feature come from one more aggregate; the final filter then
    compares raw values only (cheap, and a plain predicate for the optimizer). ``approx`` is the rank
    error of sketched quantiles; without it they are exact.
    """
    df = materialise(df, "outlier_rows")          # several passes follow: compute the features once
    model = fit_quantile_transform(df, features, n_quantiles, approx)
    t = quantile_transform(df, features, model, suffix="__q")
    zb = iqr_bounds(t, [f + "__q" for f in features], factor, approx)
    aggs = []
    for f in features:
        lo, hi = zb[f + "__q"]
        z, x = F.col(f + "__q"), F.col(f).cast("double")
        aggs += [F.min(F.when(z >= lo, x)).alias(f + "__a"), F.max(F.when(z <= hi, x)).alias(f + "__b")]
    row = t.agg(*aggs).first()
    bounds = {}
    for f in features:
        a, b = row[f + "__a"], row[f + "__b"]
        bounds[f] = (float("inf") if a is None else a, float("-inf") if b is None else b)
    cond = outlier_condition(bounds, features, mode)
    return df.where(~F.coalesce(cond, F.lit(False)))


@dataclass
class ScalerModel:
    mean: dict[str, float]
    scale: dict[str, float]

    def to_rows(self):
        return [(f, self.mean[f], self.scale[f]) for f in self.mean]


def fit_standard_scaler(df: DataFrame, features: list[str]) -> ScalerModel:
    """Mean and population standard deviation (ddof 0); zero deviation, or no values -> scale 1."""
    aggs = []
    for f in features:
        aggs += [F.avg(F.col(f).cast("double")).alias(f + "_m"), F.stddev_pop(F.col(f).cast("double")).alias(f + "_s")]
    row = df.agg(*aggs).first()
    return ScalerModel({f: float(row[f + "_m"] or 0.0) for f in features},
                       {f: (float(row[f + "_s"]) if row[f + "_s"] else 1.0) for f in features})


def scaled(feature: str, model: ScalerModel) -> Column:
    return (F.col(feature).cast("double") - F.lit(model.mean[feature])) / F.lit(model.scale[feature])


def standard_scale(df: DataFrame, features: list[str], model: ScalerModel) -> DataFrame:
    return df.withColumns({f: scaled(f, model) for f in features})


def scale_data(df: DataFrame, features: list[str] = C.RFM_FEATURES) -> tuple[DataFrame, ScalerModel]:
    model = fit_standard_scaler(df, features)
    return standard_scale(df, features, model), model
