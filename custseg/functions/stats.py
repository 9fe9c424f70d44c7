"""Statistical Column expressions: inverse normal CDF and piecewise-linear interpolation.

Both are pure Column arithmetic (codegen, no Python per row). The same formulas are
rendered as SQL text for the DuckDB oracle by :func:`ppf_sql` / :func:`interp_sql`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Wichura (1988), Algorithm AS 241 (PPND16), coefficient tables.
# ---------------------------------------------------------------------------
AS241_A = [3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3,
           1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4,
           3.3430575583588128105e4, 2.5090809287301226727e3]
AS241_B = [1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
           2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4,
           5.2264952788528545610e3]
AS241_C = [1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0,
           3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1,
           2.27238449892691845833e-2, 7.74545014278341407640e-4]
AS241_D = [1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
           1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4,
           1.05075007164441684324e-9]
AS241_E = [6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0,
           2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3,
           2.71155556874348757815e-5, 2.01033439929228813265e-7]
AS241_F = [1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
           7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7,
           2.04426310338993978564e-15]


def _horner(coefs, r):
    acc = F.lit(coefs[-1])
    for c in reversed(coefs[:-1]):
        acc = acc * r + F.lit(c)
    return acc


def _horner_sql(coefs, r: str) -> str:
    acc = repr(coefs[-1])
    for c in reversed(coefs[:-1]):
        acc = f"(({acc}) * {r} + {c!r})"
    return acc


def ppf_sql(p: str) -> str:
    """SQL text of the inverse of the standard normal CDF (AS241) for the oracle; ``p`` is an SQL expression."""
    q = f"({p} - 0.5)"
    r1 = f"(0.180625 - {q} * {q})"
    central = f"({q} * {_horner_sql(AS241_A, r1)} / {_horner_sql(AS241_B, r1)})"
    r = f"sqrt(-ln(CASE WHEN {q} < 0 THEN {p} ELSE 1.0 - {p} END))"
    rn, rf = f"({r} - 1.6)", f"({r} - 5.0)"
    near = f"({_horner_sql(AS241_C, rn)} / {_horner_sql(AS241_D, rn)})"
    far = f"({_horner_sql(AS241_E, rf)} / {_horner_sql(AS241_F, rf)})"
    tail = f"(CASE WHEN {r} <= 5.0 THEN {near} ELSE {far} END)"
    return (f"(CASE WHEN {p} IS NULL THEN NULL WHEN {p} <= 0 THEN '-inf'::DOUBLE "
            f"WHEN {p} >= 1 THEN 'inf'::DOUBLE WHEN abs({q}) <= 0.425 THEN {central} "
            f"WHEN {q} < 0 THEN -{tail} ELSE {tail} END)")


def ppf_stages(df, keep: list[str], p_cols: list[str], out_cols: list[str]):
    """Inverse of the standard normal CDF (AS241, ~1e-16 relative error) of several columns in two wide
    projections -> keep + out_cols. p <= 0 -> -inf, p >= 1 -> +inf, null -> null."""
    s1 = []
    for pc in p_cols:
        p = F.col(pc)
        q = p - F.lit(0.5)
        s1 += [p.alias(pc), q.alias(pc + "_q"), (F.lit(0.180625) - q * q).alias(pc + "_r1"),
               F.sqrt(-F.log(F.when(q < 0, p).otherwise(F.lit(1.0) - p))).alias(pc + "_r")]
    df = df.select(*keep, *s1)
    s2 = []
    for pc, oc in zip(p_cols, out_cols):
        p, q, r1, r = F.col(pc), F.col(pc + "_q"), F.col(pc + "_r1"), F.col(pc + "_r")
        central = q * _horner(AS241_A, r1) / _horner(AS241_B, r1)
        near = _horner(AS241_C, r - F.lit(1.6)) / _horner(AS241_D, r - F.lit(1.6))
        far = _horner(AS241_E, r - F.lit(5.0)) / _horner(AS241_F, r - F.lit(5.0))
        tail = F.when(r <= 5.0, near).otherwise(far)
        tail = F.when(q < 0, -tail).otherwise(tail)
        s2.append(F.when(p.isNull(), F.lit(None).cast("double"))
                  .when(p <= 0, F.lit(float("-inf")))
                  .when(p >= 1, F.lit(float("inf")))
                  .when(F.abs(q) <= 0.425, central)
                  .otherwise(tail).alias(oc))
    return df.select(*keep, *s2)


def interp_sql(x: str, xs: str, fs: str, m: int) -> str:
    """SQL text of numpy.interp; ``xs`` and ``fs`` are SQL list expressions of length m."""
    c = f"len(list_filter({xs}, lambda v: v <= {x}))"
    xj, fj = f"({xs})[greatest({c}, 1)]", f"({fs})[greatest({c}, 1)]"
    xk, fk = f"({xs})[least({c} + 1, {m})]", f"({fs})[least({c} + 1, {m})]"
    return (f"(CASE WHEN {x} IS NULL THEN NULL WHEN {c} = 0 THEN ({fs})[1] "
            f"WHEN {c} >= {m} THEN ({fs})[{m}] WHEN {xj} = {x} THEN {fj} "
            f"ELSE ({fk} - {fj}) / ({xk} - {xj}) * ({x} - {xj}) + {fj} END)")


def sql_list(values) -> str:
    return "[" + ", ".join(repr(float(v)) + "::DOUBLE" for v in values) + "]"
