"""Per-group least squares from sufficient statistics.

Every model of the forecasting layer is a linear regression per series (and per
candidate). Instead of moving a series to one task, we aggregate its Gram matrix
``X'X`` (upper triangle), ``X'y``, ``y'y`` and ``n`` as sums: a distributive
aggregate that Spark computes partially on every input partition and merges after
the shuffle, so a series holding a third of all rows costs no more than any other. The solve is a k x k system per group (k <= ~40), done in a
``mapInPandas`` over the small statistics table.

Several fits over the same rows (candidate column subsets, ridge strengths,
fit/validation masks) come from the same statistics: a subset model uses a
sub-matrix, a validation error is ``y'y - 2 b'X'y + b'X'X b`` on the validation
Gram. No row is scored twice.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def packed_len(k: int) -> int:
    return k * (k + 1) // 2


def gram_stats(df: DataFrame, group_cols: Sequence[str], x_cols: Sequence[str], y_col: str,
               masks: dict[str, Column] | None = None, intercept: bool = True) -> DataFrame:
    """One row per group: for every mask ``m``: ``m_n, m_xtx, m_xty, m_yty``.

    Rows with a NULL regressor or target are skipped. With ``intercept`` the first
    regressor is the constant 1. ``xtx`` is the packed upper triangle, row-major.

    Each row contributes one vector ``[x_i x_j (i <= j), x_i y, y^2]`` to every mask
    it belongs to; Spark ML's ``Summarizer`` sums those vectors per (group, mask) as
    one aggregate with partial merge (hundreds of scalar ``sum``s cost seconds of
    code generation for no gain). A small second aggregation lays the masks side by
    side; a mask with no rows in a group comes out with ``n = 0`` and zero sums.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    masks = masks or {"all": F.lit(True)}
    # hundreds of products: as one SQL text they are parsed at once, as Columns each would cost driver calls
    xs = (["1.0D"] if intercept else []) + [f"cast(`{c}` as double)" for c in x_cols]
    y = f"cast(`{y_col}` as double)"
    complete = F.expr(" and ".join(f"`{c}` is not null" for c in [y_col, *x_cols]))
    k = len(xs)
    p = packed_len(k)
    vec = F.expr("array(" + ", ".join([f"{xs[i]} * {xs[j]}" for i in range(k) for j in range(i, k)] + [f"{x} * {y}" for x in xs] + [f"{y} * {y}"]) + ")")
    group_cols = list(group_cols)
    if len(masks) == 1:
        # one mask: filter and aggregate once; groups without masked rows do not appear
        (name, m), = masks.items()
        g = (df.filter(complete & m)
               .select(*group_cols, array_to_vector(vec).alias("_v"))
               .groupBy(*group_cols)
               .agg(F.count(F.lit(1)).alias(f"{name}_n"), Summarizer.sum(F.col("_v")).alias("_s")))
        arr = vector_to_array(F.col("_s"))
        return g.select(*group_cols, f"{name}_n", F.slice(arr, 1, p).alias(f"{name}_xtx"),
                        F.slice(arr, p + 1, k).alias(f"{name}_xty"),
                        F.element_at(arr, p + k + 1).alias(f"{name}_yty"))
    segs = F.filter(F.array(*[F.when(m, F.lit(name)) for name, m in masks.items()]), lambda x: x.isNotNull())
    rows = df.filter(complete).select(*group_cols, array_to_vector(vec).alias("_v"), F.explode(segs).alias("_seg"))
    g = (rows.groupBy(*group_cols, "_seg")
             .agg(F.count(F.lit(1)).alias("_n"), Summarizer.sum(F.col("_v")).alias("_s"))
             .select(*group_cols, "_seg", "_n", vector_to_array("_s").alias("_s")))
    wide = g.groupBy(*group_cols).agg(*[
        agg for name in masks for agg in (
            F.max(F.when(F.col("_seg") == name, F.col("_n"))).alias(f"_n_{name}"),
            F.first(F.when(F.col("_seg") == name, F.col("_s")), ignorenulls=True).alias(f"_s_{name}"))])
    out = [F.col(c) for c in group_cols]
    for name in masks:
        arr = F.col(f"_s_{name}")
        ok = arr.isNotNull()
        out += [F.coalesce(F.col(f"_n_{name}"), F.lit(0)).cast("bigint").alias(f"{name}_n"),
                F.when(ok, F.slice(arr, 1, p)).otherwise(F.array_repeat(F.lit(0.0), p)).alias(f"{name}_xtx"),
                F.when(ok, F.slice(arr, p + 1, k)).otherwise(F.array_repeat(F.lit(0.0), k)).alias(f"{name}_xty"),
                F.when(ok, F.element_at(arr, p + k + 1)).otherwise(F.lit(0.0)).alias(f"{name}_yty")]
    return wide.select(*out)


def unpack(packed, k: int) -> np.ndarray:
    a = np.zeros((k, k))
    iu = np.triu_indices(k)
    a[iu] = np.asarray(packed, dtype=float)
    return a + np.triu(a, 1).T


def solve(xtx: np.ndarray, xty: np.ndarray, cols: Sequence[int], ridge: float = 0.0,
          unpenalized: Sequence[int] = (0,), rcond: float = 1e-10) -> tuple[np.ndarray | None, int]:
    """Coefficients on ``cols`` (full-length vector, zeros elsewhere) and the numerical rank.

    Columns are equilibrated by their diagonal, then solved by SVD least squares:
    exactly collinear regressors (e.g. ``prev_count`` next to the first lag of the
    count it copies) get the minimum-norm solution instead of failing; fitted
    values are the same. ``ridge`` is added to the diagonal of penalised columns.
    Returns ``(None, 0)`` when a column is all zero or the result is not finite.
    """
    cols = list(cols)
    k = xtx.shape[0]
    a = xtx[np.ix_(cols, cols)].copy()
    b = xty[cols].copy()
    if ridge:
        for i, c in enumerate(cols):
            if c not in unpenalized:
                a[i, i] += ridge
    d = np.sqrt(np.clip(np.diag(a), 0, None))
    if np.any(d == 0) or not np.all(np.isfinite(a)):
        return None, 0
    a_s = a / np.outer(d, d)
    b_s = b / d
    z, _, rank, _ = np.linalg.lstsq(a_s, b_s, rcond=rcond)
    if not np.all(np.isfinite(z)):
        return None, 0
    beta = np.zeros(k)
    beta[cols] = z / d
    return beta, int(rank)


def sse(beta: np.ndarray, xtx: np.ndarray, xty: np.ndarray, yty: float) -> float:
    """Residual sum of squares of ``beta`` on the rows summarised by the statistics."""
    return float(yty - 2.0 * beta @ xty + beta @ xtx @ beta)


def dot(cols: Sequence[str], coef: str, intercept: bool = True) -> Column:
    """``coef[0] + sum(coef[i] * x_i)`` as one Catalyst expression (no UDF); ``cols`` are SQL expressions, ``coef`` a column."""
    off = 2 if intercept else 1
    terms = [f"element_at(`{coef}`, {i + off}) * cast({c} as double)" for i, c in enumerate(cols)]
    return F.expr(" + ".join(([f"element_at(`{coef}`, 1)"] if intercept else []) + terms))


def solve_enet(xtx: np.ndarray, xty: np.ndarray, cols: Sequence[int], lam: float, l1_ratio: float,
               max_iter: int = 20_000, tol: float = 1e-10) -> np.ndarray | None:
    """Elastic net with an unpenalised intercept (column 0) from Gram statistics.

    Minimises ``1/(2n) |y - b0 - X b|^2 + lam * (l1_ratio |b|_1 + (1 - l1_ratio)/2 |b|^2)``
    by coordinate descent on the centred covariance ``S = X'X/n - xbar xbar'`` and
    ``c = X'y/n - xbar ybar`` (no pass over rows). ``l1_ratio = 0`` is ridge.
    Returns the full-length coefficient vector, or None (also where the descent does not end).
    """
    beta = solve_enet_batch(xtx[None], xty[None], cols, lam, l1_ratio, max_iter, tol)[0]
    return beta if np.all(np.isfinite(beta)) else None


def unpack_batch(packed: np.ndarray, k: int) -> np.ndarray:
    """(m, k(k+1)/2) packed upper triangles -> (m, k, k) symmetric matrices."""
    m = packed.shape[0]
    a = np.zeros((m, k, k))
    iu = np.triu_indices(k)
    a[:, iu[0], iu[1]] = packed
    return a + np.triu(a, 1).transpose(0, 2, 1)


def solve_batch(xtx: np.ndarray, xty: np.ndarray, cols: Sequence[int],
                rcond: float = 1e-10) -> tuple[np.ndarray, np.ndarray]:
    """``solve`` for a stack of systems at once: (m, k, k), (m, k) -> betas (m, k), ranks (m,).

    Same equilibration and minimum-norm semantics as ``solve`` (Hermitian pseudo-inverse
    with singular values below ``rcond`` x largest dropped). Failed rows (a zero column,
    non-finite values) come back as NaN with rank 0.
    """
    cols = list(cols)
    m, k = xty.shape
    a = xtx[:, cols][:, :, cols]
    b = xty[:, cols]
    beta = np.full((m, k), np.nan)
    rank = np.zeros(m, dtype=int)
    d = np.sqrt(np.clip(np.diagonal(a, axis1=1, axis2=2), 0, None))
    ok = np.all(d > 0, axis=1) & np.all(np.isfinite(a), axis=(1, 2)) & np.all(np.isfinite(b), axis=1)
    if not ok.any():
        return beta, rank
    a, b, d = a[ok], b[ok], d[ok]
    a_s = a / (d[:, :, None] * d[:, None, :])
    z = np.einsum("mij,mj->mi", np.linalg.pinv(a_s, rcond=rcond, hermitian=True), b / d)
    ev = np.abs(np.linalg.eigvalsh(a_s))
    rank[ok] = (ev > rcond * ev.max(axis=1, keepdims=True)).sum(axis=1)
    sub = np.zeros((ok.sum(), k))
    sub[:, cols] = z / d
    beta[ok] = sub
    return beta, rank


def sse_batch(beta: np.ndarray, xtx: np.ndarray, xty: np.ndarray, yty: np.ndarray) -> np.ndarray:
    """Residual sums of squares for a stack of coefficient vectors."""
    return yty - 2.0 * np.einsum("mi,mi->m", beta, xty) + np.einsum("mi,mij,mj->m", beta, xtx, beta)


def _enet_optimum(S: np.ndarray, c: np.ndarray, start: np.ndarray, a1: float, a2: float) -> np.ndarray | None:
    """The exact minimum by feature-sign search from ``start``; None where it does not get there."""
    Q, x, slack = S + a2 * np.eye(len(c)), start.copy(), 1e-9 * np.max(np.abs(c), initial=0.0)
    sign = np.sign(x)
    for _ in range(100 * len(c)):
        on = sign != 0
        try:
            goal = np.zeros_like(x)
            goal[on] = np.linalg.solve(Q[np.ix_(on, on)], c[on] - a1 * sign[on])
        except np.linalg.LinAlgError:
            return None
        # the lowest point on the way to the goal: there, or where a coefficient gets zero
        step = goal - x
        crossing = np.flatnonzero(x * goal < 0)
        points = [x + q * step for q in (*(-x[crossing] / step[crossing]), 1.0)]
        for p, j in zip(points, crossing):
            p[j] = 0.0
        x = min(points, key=lambda p: 0.5 * p @ Q @ p - c @ p + a1 * np.abs(p).sum())
        sign, slope = np.sign(x), c - Q @ x
        if np.all(np.abs(slope - a1 * sign)[x != 0] <= slack):
            beyond = np.where(x == 0, np.abs(slope) - a1, -np.inf)
            j = int(np.argmax(beyond))
            if beyond[j] <= slack:
                return x
            sign[j] = np.sign(slope[j])
    return None


def solve_enet_batch(xtx: np.ndarray, xty: np.ndarray, cols: Sequence[int], lam: float, l1_ratio: float,
                     max_iter: int = 20_000, tol: float = 1e-10) -> np.ndarray:
    """``solve_enet`` for a stack of systems: coordinate descent vectorised across rows.

    Each row is iterated until its own changes are below ``tol``, whatever the others do; one that
    is slow is solved exactly after a thousand sweeps. Rows that cannot be fitted, or are not done
    after ``max_iter`` sweeps, come back as NaN.
    """
    cols = [c for c in cols if c != 0]
    m, k = xty.shape
    out = np.full((m, k), np.nan)
    n = xtx[:, 0, 0]
    ok = n > 0
    if not ok.any():
        return out
    X, Y, nn = xtx[ok], xty[ok], n[ok]
    xbar = X[:, 0, cols] / nn[:, None]
    ybar = Y[:, 0] / nn
    S = X[:, cols][:, :, cols] / nn[:, None, None] - xbar[:, :, None] * xbar[:, None, :]
    c = Y[:, cols] / nn[:, None] - xbar * ybar[:, None]
    a1, a2 = lam * l1_ratio, lam * (1.0 - l1_ratio)
    diag = np.diagonal(S, axis1=1, axis2=2) + a2
    good = np.all(diag > 0, axis=1) & np.all(np.isfinite(S), axis=(1, 2)) & np.all(np.isfinite(c), axis=1)
    b = np.full((len(nn), len(cols)), np.nan)
    rows = np.flatnonzero(good)             # still iterated
    s, t, d, x = S[rows], c[rows], diag[rows], np.zeros((len(rows), len(cols)))
    live = np.ones(len(rows), bool)
    for sweep in range(1, max_iter + 1):
        if not live.any():
            break
        delta = np.zeros(len(rows))
        for j in range(len(cols)):
            r = t[:, j] - np.einsum("mi,mi->m", s[:, j, :], x) + s[:, j, j] * x[:, j]
            new = np.where(live, np.sign(r) * np.maximum(np.abs(r) - a1, 0.0) / d[:, j], x[:, j])
            delta = np.maximum(delta, np.abs(new - x[:, j]))
            x[:, j] = new
        done = live & (delta < tol)
        b[rows[done]] = x[done]
        live &= ~done
        if sweep % 1000 == 0:
            for i in np.flatnonzero(live):
                exact = _enet_optimum(s[i], t[i], x[i], a1, a2)
                if exact is not None:
                    b[rows[i]], live[i] = exact, False
        if 2 * live.sum() < len(rows):
            rows, s, t, d, x = rows[live], s[live], t[live], d[live], x[live]
            live = np.ones(len(rows), bool)
    beta = np.zeros((len(nn), k))
    beta[:, cols] = b
    beta[:, 0] = ybar - np.einsum("mi,mi->m", xbar, b)
    beta[~np.all(np.isfinite(beta), axis=1)] = np.nan
    out[ok] = beta
    return out
