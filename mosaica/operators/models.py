"""Grouped models: every pass over the data is one aggregation for all groups at once; per group only a small system is solved."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mosaica.functions.scalars import normal_pvalues, t_pvalues
from mosaica.operators.aggregates import grouped_quantiles
from mosaica.operators.joins import lattice_neighbours
from mosaica.operators.lineage import cut

INTERCEPT = "(Intercept)"


def design(df: DataFrame, types: list[str], covariate: str | None = None, pairs: list[str] = (), intercept: bool = True) -> tuple[DataFrame, list[str]]:
    """df with the model's columns, and their names: intercept, sorted types, covariate, type:covariate, pairs. Absent types are 0."""
    cols = {}
    if intercept:
        cols[INTERCEPT] = F.lit(1.0)
    for t in sorted(types):
        cols[t] = F.coalesce(F.col(f"`{t}`"), F.lit(0.0)) if t in df.columns else F.lit(0.0)
    if covariate:
        cols[covariate] = F.col(covariate).cast("double")
        for t in sorted(types):
            cols[f"{t}:{covariate}"] = cols[t] * cols[covariate]
    for p in pairs:
        cols[p] = F.coalesce(F.col(f"`{p}`"), F.lit(0.0)) if p in df.columns else F.lit(0.0)
    return df.withColumns(cols), list(cols)


def gram(df: DataFrame, keys: list[str], y: Column, X: list[Column], weight: Column | None = None) -> DataFrame:
    """(keys, n, _gram): the upper triangle of [X y]' W [X y], row by row, from the complete rows of each group."""
    cols = [*X, y]
    w = F.lit(1.0) if weight is None else weight
    ok = w.isNotNull()
    for c in cols:
        ok = ok & c.isNotNull()
    sums = [F.sum(F.when(ok, w * a * b)) for i, a in enumerate(cols) for b in cols[i:]]
    return df.groupBy(*keys).agg(F.count(F.when(ok, 1)).alias("n"), F.array(*sums).alias("_gram"))


def _square(g: list[float], k: int) -> np.ndarray:
    m = np.zeros((k, k))
    m[np.triu_indices(k)] = np.array([np.nan if v is None else v for v in g], float)
    return np.triu(m) + np.triu(m, 1).T


def _fit_rows(it: Iterator[pd.DataFrame], keys: list[str], names: list[str], normal: bool) -> Iterator[pd.DataFrame]:
    k = len(names)
    for pdf in it:
        out = []
        for row in pdf.to_dict("records"):
            m, n = _square(row["_gram"], k + 1), int(row["n"])
            xx, xy, yy = m[:k, :k], m[:k, k], m[k, k]
            status, beta, se = "ok", np.full(k, np.nan), np.full(k, np.nan)
            d = np.sqrt(np.diag(xx)) if np.isfinite(xx).all() else np.zeros(k)
            if n <= k or not np.isfinite(m).all() or (d == 0).any() or np.linalg.matrix_rank(xx / np.outer(d, d), tol=1e-9) < k:
                status = "singular"
            else:
                inv = np.linalg.inv(xx / np.outer(d, d)) / np.outer(d, d)
                beta = inv @ xy
                s2 = 1.0 if normal else max(0.0, yy - beta @ xy) / (n - k)
                se = np.sqrt(s2 * np.diag(inv))
            with np.errstate(all="ignore"):
                t = beta / se
            p = normal_pvalues(t) if normal else t_pvalues(t, np.full(k, n - k))
            for i, name in enumerate(names):
                out.append(tuple(row[c] for c in keys) + (n, name, beta[i], se[i], t[i], p[i], status))
        yield pd.DataFrame(out, columns=[*keys, "n", "term", "estimate", "std_error", "statistic", "p_value", "status"])


def _schema(df: DataFrame, keys: list[str]) -> str:
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    return "".join(f"`{k}` {types[k]}, " for k in keys)


def _none(df: DataFrame, cols: list[str]) -> DataFrame:
    """NaN of numpy back to null."""
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in cols})


def fit_ols(df: DataFrame, keys: list[str], y: str, X: list[str], weight: str | None = None) -> DataFrame:
    """Tidy least squares per group: keys, n, term, estimate, std_error, statistic, p_value, status. Singular groups have null estimates."""
    g = gram(df, keys, F.col(y).cast("double"), [F.col(f"`{c}`").cast("double") for c in X], None if weight is None else F.col(weight))
    schema = _schema(df, keys) + "n long, term string, estimate double, std_error double, statistic double, p_value double, status string"
    out = g.mapInPandas(lambda it: _fit_rows(it, keys, X, False), schema)
    return _none(out, ["estimate", "std_error", "statistic", "p_value"])


def _coefficients(fit: DataFrame, keys: list[str], X: list[str]) -> DataFrame:
    """(keys, beta): the estimates of a fit as an array in the order of X."""
    at = F.map_from_entries(F.collect_list(F.struct("term", "estimate")))
    return fit.groupBy(*keys).agg(at.alias("m")).select(*keys, F.array(*[F.col("m")[c] for c in X]).alias("beta"))


def _linear(X: list[str]) -> Column:
    return sum((F.col("beta")[i] * F.col(f"`{c}`") for i, c in enumerate(X)), F.lit(0.0))


def fit_glm(df: DataFrame, keys: list[str], y: str, X: list[str], family: str = "gamma", link: str = "log", rounds: int = 25, tol: float = 1e-8) -> DataFrame:
    """Generalised linear model by iterated weighted least squares: families gaussian, gamma, poisson, binomial; links log, identity, logit.

    Each round is one weighted aggregation; it ends when no group moves by more than tol.
    """
    start = {"log": F.log(F.greatest(F.col(y), F.lit(1e-10)) if family != "binomial" else (F.col(y) + 0.5) / 2), "identity": F.col(y), "logit": F.log((F.col(y) + 0.5) / (1.5 - F.col(y)))}[link]
    data = cut(df.select(*keys, F.col(y).cast("double").alias("_y"), *[F.col(f"`{c}`").cast("double").alias(c) for c in X], start.cast("double").alias("_eta0")))
    beta = None
    for _ in range(rounds):
        cur = data.withColumn("_eta", F.col("_eta0")) if beta is None else data.join(beta, keys).withColumn("_eta", _linear(X)).drop("beta")
        eta = F.col("_eta")
        mu = {"log": F.exp(eta), "identity": eta, "logit": 1 / (1 + F.exp(-eta))}[link]
        slope = {"log": mu, "identity": F.lit(1.0), "logit": mu * (1 - mu)}[link]
        var = {"gaussian": F.lit(1.0), "gamma": mu * mu, "poisson": mu, "binomial": mu * (1 - mu)}[family]
        work = cur.withColumn("_z", eta + (F.col("_y") - mu) / slope).withColumn("_w", slope * slope / var)
        fit = cut(fit_ols(work, keys, "_z", X, "_w"))
        new = _coefficients(fit, keys, X)
        if beta is not None:
            move = F.aggregate(F.zip_with("beta", "_old", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda s, v: s + F.coalesce(v, F.lit(0.0)))
            worst = new.join(beta.withColumnRenamed("beta", "_old"), keys).agg(F.max(move)).first()[0]
            if worst is None or worst < tol:
                return fit
        beta = cut(new)
    return fit.withColumn("status", F.when(F.col("status") == "ok", "not converged").otherwise(F.col("status")))


def fit_robust(df: DataFrame, keys: list[str], y: str, X: list[str], rounds: int = 20, tol: float = 1e-6) -> DataFrame:
    """Bisquare M-estimation: Huber weights in the first rounds, MAD scale, weighted least squares each round. Groups that still move by tol in the last
    round have the status `not converged`."""
    data = cut(df.select(*keys, F.col(y).cast("double").alias("_y"), *[F.col(f"`{c}`").cast("double").alias(c) for c in X]))
    fit = cut(fit_ols(data, keys, "_y", X))
    for i in range(rounds):
        beta = _coefficients(fit, keys, X)
        res = data.join(beta, keys).withColumn("_r", F.col("_y") - _linear(X)).drop("beta")
        scale = grouped_quantiles(res, keys, {"_s": (F.abs("_r") * 1.4826, 0.5)})
        u = F.abs(F.col("_r")) / F.greatest(F.col("_s"), F.lit(1e-12))
        w = F.when(u <= 1.345, 1.0).otherwise(1.345 / u) if i < 3 else F.when(u < 4.685, F.pow(1 - F.pow(u / 4.685, F.lit(2.0)), F.lit(2.0))).otherwise(0.0)
        new = cut(fit_ols(res.join(scale, keys).withColumn("_w", w), keys, "_y", X, "_w"))
        moved = cut(new.join(fit.select(*keys, "term", F.col("estimate").alias("_old")), [*keys, "term"]).groupBy(*keys).agg(F.max(F.abs(F.col("estimate") - F.col("_old"))).alias("_moved")))
        fit, worst = new, moved.agg(F.max("_moved")).first()[0]
        if i > 3 and (worst is None or worst < tol):
            return fit
    late = moved.where(F.col("_moved") >= tol).select(*keys, F.lit(True).alias("_late"))
    late = fit.join(late, keys, "left") if keys else fit.crossJoin(F.broadcast(late.agg(F.max("_late").alias("_late"))))  # one row
    return late.withColumn("status", F.when(F.col("_late") & (F.col("status") == "ok"), "not converged").otherwise(F.col("status"))).drop("_late")


# ---- spatial lag model ----


def trace_moments(px: DataFrame, keys: list[str], order: int = 12, probes: int = 16, seed: int = 1) -> DataFrame:
    """(keys, n, moments, radius): tr(W^k) / n for k = 1..order of the rook graph: k = 2 exact, odd ones 0 (the graph has two colours), higher even ones by
    hashed +-1 probes; and a bound of the largest eigenvalue that is never below it, the greatest growth of a positive vector in one step."""
    W = cut(lattice_neighbours(px, keys=keys))
    sign = F.when(F.col("probe") == 0, 1.0).when(F.pmod(F.xxhash64("ims_idx", "probe", F.lit(seed)), F.lit(2)) == 0, 1.0).otherwise(-1.0)
    v0 = px.select(*keys, "ims_idx", F.explode(F.sequence(F.lit(0), F.lit(probes))).alias("probe")).withColumn("v0", sign)
    n = px.groupBy(*keys).agg(F.count("*").alias("n"))
    exact = W.groupBy(*keys).agg((F.sum(F.col("w") * F.col("w"))).alias("t2"))
    v, even = v0.withColumn("v", F.col("v0")), []
    for k in range(1, order // 2 + 1):  # v'W^(2k)v = |W^k v|^2, as W is symmetric
        before = v
        v = cut(W.join(v.select(*keys, F.col("ims_idx").alias("neighbour"), "probe", "v"), [*keys, "neighbour"]).groupBy(*keys, "ims_idx", "probe").agg(F.sum(F.col("w") * F.col("v")).alias("v")))
        even.append(v.where("probe > 0").groupBy(*keys).agg((F.sum(F.col("v") * F.col("v")) / probes).alias(f"t{2 * k}h")))
    grown = v.where("probe = 0").join(before.where("probe = 0").select(*keys, "ims_idx", F.col("v").alias("_b")), [*keys, "ims_idx"])
    out = n.join(exact, keys, "left").join(grown.groupBy(*keys).agg(F.max(F.col("v") / F.col("_b")).alias("radius")), keys, "left")
    for e in even:
        out = out.join(e, keys, "left")
    value = lambda k: F.lit(0.0) if k % 2 else F.coalesce(F.col("t2") if k == 2 else F.col(f"t{k}h"), F.lit(0.0)) / F.col("n")
    return out.select(*keys, "n", F.array(*[value(k) for k in range(1, order + 1)]).alias("moments"), F.coalesce("radius", F.lit(0.0)).alias("radius"))


def spectrum(moments: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and weights of a Gauss quadrature over the squared eigenvalues of W that has the given moments, at most half as many nodes as even moments."""
    m = np.concatenate(([1.0], np.asarray(moments, float)[1::2])) / max(radius, 1e-12) ** (2 * np.arange(len(moments) // 2 + 1))
    for k in range(len(m) // 2, 0, -1):
        hankel = m[np.add.outer(np.arange(k), np.arange(k))]
        if np.linalg.eigvalsh(hankel)[0] > 1e-10:
            coef = np.linalg.solve(hankel, m[k : 2 * k])
            x = np.roots(np.concatenate(([1.0], -coef[::-1])))
            w = np.linalg.solve(np.vander(x, increasing=True).T, m[:k])
            if np.isrealobj(x) and (w > 0).all() and (x > -1e-9).all():
                return np.clip(x, 0, 1) * radius**2, w / w.sum()
    return np.array([moments[1]]), np.array([1.0])


def _log_det(rho: float, nodes: np.ndarray, weights: np.ndarray) -> float:
    return 0.5 * float(np.sum(weights * np.log(np.maximum(1e-300, 1 - rho * rho * nodes))))


def log_det(rho: float, moments: np.ndarray, radius: float = 4.0) -> float:
    """ln det(I - rho W) / n = mean of ln(1 - rho^2 l^2) / 2 over the eigenvalues l, which lie symmetric about 0 and within radius. With N nodes the error is
    of the order of ((1 - sqrt(1 - q^2)) / q)^(4 N) for q = |rho| times the largest eigenvalue: 3e-4 at q = 0.8 with three nodes."""
    return _log_det(rho, *spectrum(np.asarray(moments, float), radius))


EXACT_PIXELS = 1500  # regions up to so many pixels have their eigenvalues computed


def region_eigenvalues(px: DataFrame, keys: list[str], most: int = EXACT_PIXELS) -> DataFrame:
    """(keys, eigen): all eigenvalues of the rook graph's W of each group of at most `most` pixels (one group meets in a task); larger groups have no row."""
    small = px.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") <= most).select(*keys)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        at = {p: i for i, p in enumerate(zip(pdf["ims_x"].tolist(), pdf["ims_y"].tolist()))}
        w = np.zeros((len(pdf), len(pdf)))
        for (x, y), i in at.items():
            for near in ((x + 1, y), (x, y + 1)):
                if near in at:
                    w[i, at[near]] = w[at[near], i] = 1.0
        return pd.DataFrame([(*[pdf[k].iloc[0] for k in keys], np.linalg.eigvalsh(w).tolist())], columns=[*keys, "eigen"])

    kept = px.join(small, keys, "left_semi").select(*keys, "ims_x", "ims_y")
    return kept.groupBy(*keys).applyInPandas(solve, _schema(px, keys) + "eigen array<double>")


class LogDeterminant:
    """ln det(I - rho W) / n of one region and its second derivative: by all eigenvalues where they are known, else by the quadrature of spectrum()."""

    def __init__(self, eigen, moments, radius: float):
        if eigen is not None:
            self.l = np.asarray(eigen, float)
            self.weights = np.full(len(self.l), 1 / max(1, len(self.l)))
            self.radius = float(np.abs(self.l).max()) if len(self.l) else 0.0
        else:
            nodes, weights = spectrum(np.asarray(moments, float), radius)
            self.l = np.concatenate((np.sqrt(nodes), -np.sqrt(nodes)))  # eigenvalues lie symmetric about 0
            self.weights, self.radius = np.concatenate((weights, weights)) / 2, radius

    def value(self, rho: float) -> float:
        return float(np.sum(self.weights * np.log(np.maximum(1e-300, 1 - rho * self.l))))

    def second(self, rho: float) -> float:
        return -float(np.sum(self.weights * (self.l / (1 - rho * self.l)) ** 2))

    def mean_inverse(self, rho):
        """tr((I - rho W)^-1) / n for one rho or many."""
        return np.sum(self.weights / (1 - np.multiply.outer(rho, self.l)), axis=-1)


def _lag_rows(it: Iterator[pd.DataFrame], keys: list[str], names: list[str]) -> Iterator[pd.DataFrame]:
    k = len(names)
    for pdf in it:
        out = []
        for row in pdf.to_dict("records"):
            m, n = _square(row["_gram"], k + 2), int(row["n"])
            det = LogDeterminant(row["eigen"], row["moments"], float(row["radius"]))
            terms, status = ["rho", *names], "ok"
            est = se = np.full(k + 1, np.nan)
            ll = s2 = np.nan
            xx, xy, xl = m[:k, :k], m[:k, k], m[:k, k + 1]  # Gram of [X, y, Wy]
            if n <= k + 1 or not np.isfinite(m).all() or np.linalg.matrix_rank(xx) < k:
                status = "singular"
            else:
                inv = np.linalg.inv(xx)
                ee = lambda a, b, xa, xb: m[a, b] - xa @ inv @ xb
                e00, e01, e11 = ee(k, k, xy, xy), ee(k, k + 1, xy, xl), ee(k + 1, k + 1, xl, xl)
                rss = lambda rho: max(1e-300, e00 - 2 * rho * e01 + rho * rho * e11)

                def loss(rho):
                    return -(n * det.value(rho) - n / 2 * np.log(rss(rho) / n))

                most = 0.999 / max(det.radius, 1e-3)  # I - rho W is regular where |rho| times the largest eigenvalue is below 1
                lo, hi, g = -most, most, (5**0.5 - 1) / 2
                a, b = hi - g * (hi - lo), lo + g * (hi - lo)
                for _ in range(80):
                    if loss(a) < loss(b):
                        hi, b = b, a
                        a = hi - g * (hi - lo)
                    else:
                        lo, a = a, b
                        b = lo + g * (hi - lo)
                rho = (lo + hi) / 2
                s2 = rss(rho) / n
                beta, ll = inv @ (xy - rho * xl), -loss(rho) - n / 2 * (np.log(2 * np.pi) + 1)
                if abs(rho) > 0.999 * most:
                    status = "at bound"
                first = 2 * (rho * e11 - e01)
                curve = -n * det.second(rho) + n / 2 * (2 * e11 / rss(rho) - (first / rss(rho)) ** 2)
                var_rho = 1 / curve if curve > 0 else np.nan
                bl = inv @ xl
                est = np.concatenate(([rho], beta))
                se = np.sqrt(np.concatenate(([var_rho], s2 * np.diag(inv) + bl * bl * var_rho)))
            with np.errstate(all="ignore"):
                z = est / se
            for t, e, s, zz, p in zip(terms, est, se, z, normal_pvalues(z)):
                out.append(tuple(row[c] for c in keys) + (n, t, e, s, zz, p, ll, s2, status))
        yield pd.DataFrame(out, columns=[*keys, "n", "term", "estimate", "std_error", "statistic", "p_value", "log_likelihood", "sigma2", "status"])


def spatial_lag(df: DataFrame, keys: list[str], y: str) -> DataFrame:
    """df with Wy: the sum of y over rook neighbours (ims_x, ims_y) of the same group, 0 for isolated pixels."""
    W = lattice_neighbours(df.select(*keys, "ims_idx", "ims_x", "ims_y"), keys=keys)
    lag = W.join(df.select(*keys, F.col("ims_idx").alias("neighbour"), F.col(y).alias("_v")), [*keys, "neighbour"]).groupBy(*keys, "ims_idx").agg(F.sum(F.col("w") * F.col("_v")).alias("Wy"))
    return df.join(lag, [*keys, "ims_idx"], "left").fillna(0.0, subset=["Wy"])


def fit_lag(df: DataFrame, keys: list[str], y: str, X: list[str], order: int = 12, probes: int = 16, exact: int = EXACT_PIXELS) -> DataFrame:
    """Maximum likelihood of y = rho W y + X b + e per group, tidy; rows with a null go before W is built.

    The likelihood in rho needs only the Gram matrix of [X, y, Wy] and ln det(I - rho W): by the eigenvalues of groups of up to `exact` pixels, by the trace moments of W beyond,
    one row a group. rho is sought within the inverse of the largest eigenvalue of the group's graph; status is `at bound` where the likelihood rises up to it.
    """
    full = cut(df.dropna(subset=[y, *X]))
    lagged = spatial_lag(full, keys, y)
    g = gram(lagged, keys, F.col("Wy"), [*[F.col(f"`{c}`").cast("double") for c in X], F.col(y).cast("double")])
    eigen = cut(region_eigenvalues(full, keys, exact))
    large = cut(full.join(eigen.select(*keys), keys, "left_anti"))
    out = g.join(eigen, keys, "left").withColumn("moments", F.lit(None).cast("array<double>")).withColumn("radius", F.lit(0.0))
    if not large.isEmpty():
        moments = trace_moments(large, keys, order, probes).select(*keys, "moments", "radius")
        out = out.drop("moments", "radius").join(moments, keys, "left").withColumn("radius", F.coalesce("radius", F.lit(0.0)))
    schema = _schema(df, keys) + "n long, term string, estimate double, std_error double, statistic double, p_value double, log_likelihood double, sigma2 double, status string"
    return _none(out.mapInPandas(lambda it: _lag_rows(it, keys, X), schema), ["estimate", "std_error", "statistic", "p_value", "log_likelihood", "sigma2"])


def coef_table(fit: DataFrame, keys: list[str], terms: list[str]) -> DataFrame:
    """One row a group: n and the estimate of every term."""
    return fit.groupBy(*keys, "n").pivot("term", terms).agg(F.first("estimate"))


def fit_second(fit: DataFrame, samples: DataFrame, covariates: list[str]) -> DataFrame:
    """Second level per (mz, term): weighted least squares of the first level's estimates on sample covariates, weight 1 / (se sqrt n)^2.

    fit: mz, sample_id, term, estimate, std_error, n. Groups without any estimate drop out, null weights too; covariates constant over
    the samples are left out.
    """
    top = samples.agg(*[F.count_distinct(c).alias(c) for c in covariates]).first() if covariates else {}
    used = [c for c in covariates if top[c] > 1]
    base = fit.withColumnRenamed("term", "celltype").join(samples.select("sample_id", *used), "sample_id")
    base = base.where("estimate is not null and std_error is not null").withColumn("_w", 1 / F.when(F.col("std_error") > 0, F.col("std_error") * F.col("std_error") * F.col("n"))).withColumn(INTERCEPT, F.lit(1.0))
    return fit_ols(base, ["mz", "celltype"], "estimate", [INTERCEPT, *used], "_w")


def fit_second_random(fit: DataFrame, samples: DataFrame, group: str, grid: int = 17, refine: int = 2) -> DataFrame:
    """Random intercept by `group` with known variances: per (mz, term) the variance of groups by restricted likelihood over a grid that is
    refined around the best, and the mean with its standard error. Groups of one level give a null row.

    Sums per (mz, term, group) hold all that is needed; the grid is a short array beside them.
    """
    base = fit.withColumnRenamed("term", "celltype").join(samples.select("sample_id", F.col(group).alias("_g")), "sample_id")
    base = base.where("estimate is not null and std_error > 0").withColumn("_w", 1 / (F.col("std_error") * F.col("std_error")))
    w, y = F.col("_w"), F.col("estimate")
    sums = base.groupBy("mz", "celltype", "_g").agg(F.sum(w).alias("w"), F.sum(w * y).alias("wy"), F.sum(w * y * y).alias("wyy"), F.sum(F.log(w)).alias("lw"))
    spread = base.groupBy("mz", "celltype").agg(F.var_samp("estimate").alias("v"))
    lists = sums.groupBy("mz", "celltype").agg(F.collect_list(F.struct("w", "wy", "wyy", "lw")).alias("s")).join(spread, ["mz", "celltype"])

    def solve(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for r in pdf.itertuples(index=False):
                a = np.array([[x["w"], x["wy"], x["wyy"], x["lw"]] for x in r.s], float)
                if len(a) < 2 or not np.isfinite(a).all():
                    out.append((r.mz, r.celltype, None, None, None, len(a), "too few groups"))
                    continue
                lo, hi = 0.0, 4 * (r.v if r.v and np.isfinite(r.v) else 1.0) + 1e-12
                for _ in range(refine + 1):
                    taus = np.linspace(lo, hi, grid)
                    h = 1 / (1 + taus[:, None] * a[None, :, 0])
                    sw, swy = (a[:, 0] * h).sum(1), (a[:, 1] * h).sum(1)
                    mu = swy / sw
                    quad = (a[:, 2] - taus[:, None] * a[:, 1] ** 2 * h).sum(1) - swy**2 / sw
                    reml = 0.5 * (np.log(h).sum(1) - np.log(sw) - quad)
                    i = int(reml.argmax())
                    step = taus[1] - taus[0]
                    lo, hi = max(0.0, taus[i] - step), taus[i] + step
                out.append((r.mz, r.celltype, float(mu[i]), float(sw[i] ** -0.5), float(taus[i]), len(a), "ok"))
            yield pd.DataFrame(out, columns=["mz", "celltype", "estimate", "std_error", "tau2", "n_groups", "status"])

    return lists.mapInPandas(solve, "mz double, celltype string, estimate double, std_error double, tau2 double, n_groups int, status string")


def predict_lag(df: DataFrame, fit: DataFrame, keys: list[str], y: str, X: list[str]) -> DataFrame:
    """trend X b, signal rho W y and residual of every row."""
    lagged = spatial_lag(df, keys, y).join(_coefficients(fit, keys, [*X, "rho"]), keys)
    out = lagged.withColumn("trend", _linear(X)).withColumn("signal", F.col("beta")[len(X)] * F.col("Wy"))
    return out.withColumn("residual", F.col(y) - F.col("trend") - F.col("signal")).drop("beta", "Wy")


def _walk(points: DataFrame, keys: list[str], own: list[str], sent: str) -> DataFrame:
    """points (keys, ims_x, ims_y, own columns; positions unique in a group) with w_<sent>, the sum of `sent` over the rook neighbours, 0 without any. One shuffle that
    reads the points once: every point sends itself and, to the four places around it, what they sum."""
    none = [F.lit(None).cast("double").alias(c) for c in own]
    places = [F.struct(F.lit(True).alias("own"), F.col("ims_x").alias("ims_x"), F.col("ims_y").alias("ims_y"), *[F.col(c).cast("double").alias(c) for c in own], F.lit(0.0).alias("sent"))]
    places += [F.struct(F.lit(False).alias("own"), (F.col("ims_x") + i).alias("ims_x"), (F.col("ims_y") + j).alias("ims_y"), *none, F.col(sent).cast("double").alias("sent")) for i, j in ((0, 1), (0, -1), (1, 0), (-1, 0))]
    all_ = points.select(*keys, F.explode(F.array(*places)).alias("_p")).select(*keys, "_p.*")
    got = all_.groupBy(*keys, "ims_x", "ims_y").agg(F.max("own").alias("_own"), *[F.max(c).alias(c) for c in own], F.sum("sent").alias(f"w_{sent}"))
    return got.where("_own").drop("_own")


def spectral_bound(px: DataFrame, keys: list[str], steps: int = 6) -> DataFrame:
    """(keys, radius): a bound of the largest eigenvalue of each group's rook graph that is never below it, the greatest growth of a positive vector in one
    step after some steps; 0 for groups of isolated pixels."""
    v = px.select(*keys, "ims_x", "ims_y", F.lit(1.0).alias("v"))
    for _ in range(steps - 1):  # scaled, since it grows by up to four a step; pixels without neighbours leave
        v = _walk(v, keys, ["v"], "v").where("w_v > 0").select(*keys, "ims_x", "ims_y", (F.col("w_v") / 4).alias("v"))
    grown = _walk(v, keys, ["v"], "v").groupBy(*keys).agg(F.max(F.col("w_v") / F.col("v")).alias("radius"))
    return px.select(*keys).distinct().join(grown, keys, "left").select(*keys, F.coalesce("radius", F.lit(0.0)).alias("radius"))


MAX_STEPS, STEPS_A_CUT = 3000, 8


def solve_lag(points: DataFrame, keys: list[str], rhs: str, tol: float = 1e-8) -> DataFrame:
    """points (keys, ims_idx, ims_x, ims_y, rhs, rho, radius) with u, the solution of (I - rho W) u = rhs, and status.

    A Chebyshev iteration: with q = |rho| radius < 1 the error after k steps is known to fall by 1 / T_k(1 / q), so each group's number of steps for a relative error of tol
    is known beforehand, and no inner product is needed between steps; groups that have made their steps leave at the next checkpoint. A step is one shuffle.
    status: ok; `outside` with a null u where q >= 1; `not converged` where the steps known to be needed pass MAX_STEPS or the residual shows otherwise."""
    at, own = [*keys, "ims_x", "ims_y"], ["_c", "rho", "_q", "_steps", "u", "_prev", "_w"]
    q = F.abs(F.col("rho")) * F.col("radius")
    arcosh = lambda x: F.log(x + F.sqrt(x * x - 1))
    needed = F.when(q < 1e-12, 1.0).when(q < 1, F.ceil(arcosh(F.greatest(F.lit(1.0), q / (1 - q) / tol)) / arcosh(1 / q)) + 1.0).otherwise(0.0)
    start = points.select(*at, F.col(rhs).cast("double").alias("_c"), F.col("rho").cast("double").alias("rho"), q.alias("_q"), needed.alias("_steps"))
    state = cut(start.withColumns({"u": F.when(F.col("_q") < 1, F.col("_c")), "_prev": F.lit(0.0), "_w": F.lit(2.0)}))
    rounds = min(MAX_STEPS, int(state.agg(F.max("_steps")).first()[0] or 0))
    done = state.where("_steps = 0")
    state = state.where("_steps > 0")
    for step in range(1, rounds + 1):
        near = _walk(state, keys, own, "u")
        plain = F.col("rho") * F.col("w_u") + F.col("_c")
        weight = F.lit(1.0) if step == 1 else 1 / (1 - F.col("_q") * F.col("_q") * F.col("_w") / 4)
        near = near.withColumn("_go", F.col("_steps") >= step).withColumn("_weight", weight)
        new = F.col("_weight") * (plain - F.col("_prev")) + F.col("_prev") if step > 1 else plain
        keep = lambda a, c: F.when(F.col("_go"), a).otherwise(F.col(c)).alias(c)
        state = near.select(*at, "_c", "rho", "_q", "_steps", keep(new, "u"), keep(F.col("u"), "_prev"), keep(F.lit(2.0) if step == 1 else F.col("_weight"), "_w"))
        if step % STEPS_A_CUT == 0:
            state = cut(state)
            done, state = done.unionByName(state.where(F.col("_steps") <= step)), state.where(F.col("_steps") > step)
    state = cut(state.unionByName(done))
    check = _walk(state, keys, own, "u")
    off = F.max(F.abs(F.col("rho") * F.col("w_u") + F.col("_c") - F.col("u"))).alias("_off")
    worst = check.groupBy(*keys).agg(off, F.max(F.abs("_c")).alias("_size"), F.max("_q").alias("_top"))
    status = F.when(F.col("_top") >= 1, "outside").when(F.coalesce(F.col("_off") <= 100 * tol * F.col("_size"), F.lit(True)), "ok").otherwise("not converged")
    return points.join(state.select(*at, "u"), at).join(worst.select(*keys, status.alias("status")), keys)


def predict_tc(df: DataFrame, fit: DataFrame, keys: list[str], X: list[str], tol: float = 1e-8) -> DataFrame:
    """df with `predicted`, (I - rho W)^-1 X b for every pixel, and the solver's status (solve_lag). A null in X counts as 0
    there; `predicted` is null where rho lies outside the bound, and with the status `no fit` at the pixels of groups without one."""
    base = df.join(_coefficients(fit, keys, [*X, "rho"]), keys).withColumn("_xb", F.coalesce(_linear(X), F.lit(0.0))).withColumn("rho", F.col("beta")[len(X)])
    base = cut(base.where("rho is not null").select(*keys, "ims_idx", "ims_x", "ims_y", "_xb", "rho"))
    solved = solve_lag(base.join(spectral_bound(base, keys), keys), keys, "_xb", tol)
    out = df.join(solved.select(*keys, "ims_idx", F.col("u").alias("predicted"), F.col("status").alias("status")), [*keys, "ims_idx"], "left")
    return out.withColumn("status", F.coalesce("status", F.lit("no fit")))


WALKS = 24  # steps of the vector of ones


def walk_series(px: DataFrame, keys: list[str], steps: int = WALKS) -> DataFrame:
    """(keys, n, walks, radius): 1' T_k(W / radius) 1 / n for k = 0 .. 2 steps, T_k being Chebyshev's polynomials, from `steps` products of W with the vector of ones:
    two inner products a step give two of them."""
    at = [*keys, "ims_x", "ims_y"]
    bound = cut(spectral_bound(px, keys))
    state = cut(px.select(*at).join(bound, keys).withColumn("radius", F.greatest("radius", F.lit(1e-9))).withColumns({"t": F.lit(1.0), "p": F.lit(0.0)}))
    found = []
    for j in range(steps + 1):
        near = _walk(state, keys, ["radius", "t", "p"], "t")
        grown = F.col("w_t") / F.col("radius")
        state = cut(near.withColumn("_t", grown if j == 0 else 2 * grown - F.col("p")).select(*at, "radius", F.col("t").alias("p"), F.col("_t").alias("t")))
        found.append(state.groupBy(*keys).agg(F.avg(F.col("p") * F.col("p")).alias(f"e{j}"), F.avg(F.col("p") * F.col("t")).alias(f"o{j}")))
    out = px.groupBy(*keys).agg(F.count("*").alias("n")).join(bound, keys)
    for f in found:
        out = out.join(f, keys)
    # T_2j = 2 T_j^2 - T_0 and T_(2j+1) = 2 T_j T_(j+1) - T_1
    s = [F.col("e0"), F.col("o0")]
    for j in range(1, steps + 1):
        s += [2 * F.col(f"e{j}") - s[0], 2 * F.col(f"o{j}") - s[1]]
    return out.select(*keys, "n", F.array(*s[: 2 * steps + 1]).alias("walks"), "radius")


def total_factor(rho, walks: np.ndarray, radius: float):
    """(value, remainder): 1' (I - rho W)^-1 1 / n for one rho or many by its Chebyshev series, 1 / (1 - q x) = (1 + 2 sum z^k T_k(x)) / sqrt(1 - q^2) with
    q = rho radius and z = (1 - sqrt(1 - q^2)) / q, and a bound of what the terms beyond the known ones can add; NaN where |q| >= 1."""
    q = np.asarray(rho, float) * radius
    with np.errstate(all="ignore"):
        root = np.sqrt(1 - q * q)
        z = q / (1 + root)
        powers = z[..., None] ** np.arange(1, len(walks))
        return (walks[0] + 2 * (powers * walks[1:]).sum(-1)) / root, 2 * np.abs(z) ** len(walks) / (1 - np.abs(z)) / root


def impacts(fit: DataFrame, px: DataFrame, keys: list[str], term: str, draws: int = 200, seed: int = 3, steps: int = WALKS, exact: int = EXACT_PIXELS) -> DataFrame:
    """(keys, direct, direct_se, direct_p, indirect.., total.., total_remainder, rho, rho_se, rho_p, log_likelihood, sigma2, sse) of a term of a lag fit, one row a group of ok fits.

    direct = b tr((I - rho W)^-1) / n, by the eigenvalues of groups of up to `exact` pixels, by quadrature of trace moments beyond; total = b 1'(I - rho W)^-1 1 / n by
    the walk series, with a bound of its remainder; indirect is their difference. Standard errors come from draws of rho and the coefficient, independent and normal, seeded by
    the group; draws of rho outside the bound are drawn at it. px: keys, ims_idx, ims_x, ims_y of the fitted pixels."""
    at = lambda t, c: F.max(F.when(F.col("term") == t, F.col(c)))
    wide = fit.where("status = 'ok'").groupBy(*keys).agg(
        at("rho", "estimate").alias("rho"), at("rho", "std_error").alias("rho_se"), at("rho", "p_value").alias("rho_p"), at(term, "estimate").alias("b"), at(term, "std_error").alias("b_se"),
        F.max("log_likelihood").alias("log_likelihood"), F.max("sigma2").alias("sigma2"), F.max("n").alias("n"),
    )
    px = cut(px.select(*keys, "ims_idx", "ims_x", "ims_y"))
    eigen = cut(region_eigenvalues(px, keys, exact))
    large = px.join(eigen.select(*keys), keys, "left_anti")
    rows = wide.join(walk_series(px, keys, steps).drop("n"), keys).join(eigen, keys, "left")
    rows = rows.join(trace_moments(large, keys).select(*keys, "moments"), keys, "left") if not large.isEmpty() else rows.withColumn("moments", F.lit(None).cast("array<double>"))
    kinds = ("direct", "indirect", "total")
    own = ["total_remainder", "rho", "rho_se", "rho_p", "log_likelihood", "sigma2", "sse"]

    def effects(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for r in pdf.to_dict("records"):
                det = LogDeterminant(r["eigen"], r["moments"], r["radius"])
                rng = np.random.default_rng([seed, zlib.crc32(repr([r[k] for k in keys]).encode())])
                most = 0.999 / max(r["radius"], 1e-9)
                shift = rng.standard_normal((2, draws))
                rho = np.clip(np.concatenate(([r["rho"]], r["rho"] + np.nan_to_num(r["rho_se"]) * shift[0])), -most, most)
                b = np.concatenate(([r["b"]], r["b"] + np.nan_to_num(r["b_se"]) * shift[1]))
                factor, remainder = total_factor(rho, np.array(r["walks"], float), r["radius"])
                direct, total = b * det.mean_inverse(rho), b * factor
                row = [r[k] for k in keys]
                for v in (direct, total - direct, total):
                    sd = float(np.std(v[1:], ddof=1)) if draws > 1 else np.nan
                    row += [v[0], sd, float(normal_pvalues(np.array([v[0] / sd if sd else np.nan]))[0])]
                out.append((*row, abs(b[0]) * remainder[0], r["rho"], r["rho_se"], r["rho_p"], r["log_likelihood"], r["sigma2"], r["sigma2"] * r["n"]))
            yield pd.DataFrame(out, columns=[*keys, *[f"{k}{e}" for k in kinds for e in ("", "_se", "_p")], *own])

    columns = [f"{k}{e}" for k in kinds for e in ("", "_se", "_p")] + own
    return _none(rows.mapInPandas(effects, _schema(fit, keys) + ", ".join(f"{c} double" for c in columns)), columns)


def zscore(df: DataFrame, col: str, keys: list[str], out: str) -> DataFrame:
    """Standardise by groups that may be large: moments are aggregated and joined, not windowed."""
    m = df.groupBy(*keys).agg(F.avg(col).alias("_m"), F.stddev_samp(col).alias("_s"))
    return df.join(m, keys).withColumn(out, (F.col(col) - F.col("_m")) / F.col("_s")).drop("_m", "_s")


def named(df: DataFrame, column_names: dict[str, str]) -> DataFrame:
    """df with the columns that play the given roles under the roles' names: {"value": "intensity", "mz": "peak"}."""
    return df.withColumnsRenamed({own: role for role, own in column_names.items()})


def associate(df: DataFrame, keys: list[str], y: str, X: list[str], method: str = "SAR") -> DataFrame:
    """First level by method: SAR (spatial lag), lm or rlm. A group that cannot be fitted has a status other than ok."""
    return {"SAR": fit_lag, "lm": fit_ols, "rlm": fit_robust}[method](df, keys, y, X)


