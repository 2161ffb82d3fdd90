"""Penalised Poisson models, any number of them in one job.

Every Newton step is one pass: a task adds up, from each row, the gradient and curvature of all models of the row's key
that train on it (all folds but its own, all penalties), so rows are never copied for them. The sums, one row a key and
task, are then solved key by key. Coefficients of at most BROADCAST_MODELS models are sent to the tasks and back at a
time; of more, keys are worked on in as many groups, each over its own rows. A species that holds most rows is summed up
by all tasks like any other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import features as scaling
from ..operators import metrics

FLOOR = 1e-4
#: Models that are fitted at a time, as their coefficients are sent to every task.
BROADCAST_MODELS = 50_000


def poisson_target(label: Column) -> Column:
    """1 for presences, a small intensity for background."""
    return F.when(label == 1, F.lit(1.0)).otherwise(F.lit(FLOOR))


def _eta(features: list[str], beta: str = "beta") -> Column:
    eta = F.col(beta)[0]
    for k, f in enumerate(features):
        eta = eta + F.col(beta)[k + 1] * F.col(f)
    # greatest() passes nulls over: without a model there is no eta.
    return F.when(F.col(beta).isNotNull(), F.least(F.greatest(eta, F.lit(-30.0)), F.lit(30.0)))


def _bad(columns: list[str]) -> Column:
    bad = F.lit(False)
    for f in columns:
        bad = bad | F.col(f).isNull() | F.isnan(f)
    return bad


def _with_models(rows: DataFrame, models: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """rows with the columns of their key's model; null keys are a key.

    No hint: tables of models are read from files or made at the driver, so Spark knows their size and broadcasts small
    ones only.
    """
    named = models.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in models.columns if c not in keys])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return rows.join(named, on, how).drop(*[f"__{k}" for k in keys])


def _numbered(keys_of: DataFrame, keys: list[str], variants: int) -> tuple[DataFrame, int]:
    """keys with __chunk and __key: groups of keys with BROADCAST_MODELS models or so, and a number within the group; how
    many groups there are."""
    chunks = max(1, -(-keys_of.count() * variants // max(BROADCAST_MODELS, 1)))
    chunked = keys_of.withColumn("__chunk", F.pmod(F.xxhash64(*keys), F.lit(chunks)).cast("int"))
    return chunked.withColumn("__key", F.row_number().over(Window.partitionBy("__chunk").orderBy(*keys)) - 1), chunks


class _Newton:
    """One group's models: K keys times V variants, and the passes over the rows that move them."""

    def __init__(self, held: np.ndarray, penalties: np.ndarray, p: int) -> None:
        self.held, self.penalties, self.p = held, penalties, p
        self.low = np.tril_indices(p)

    def begin(self, counts: list) -> None:
        """counts: rows of __key, __fold, n, total, bad."""
        k, v = 1 + max(r["__key"] for r in counts), len(self.held)
        self.n, total, bad = np.zeros((k, v), np.int64), np.zeros((k, v)), np.zeros((k, v), bool)
        for r in counts:
            trains = self.held != r["__fold"]
            self.n[r["__key"]] += trains * r["n"]
            total[r["__key"]] += np.where(trains, r["total"] or 0.0, 0.0)
            bad[r["__key"]] |= trains & r["bad"]
        mean = total / np.maximum(self.n, 1)
        none = ~bad & ~(mean > 0)
        self.beta = np.zeros((k, v, self.p))
        self.beta[..., 0] = np.log(np.where(mean > 0, mean, 1.0))
        self.error = np.full((k, v), None, object)
        self.error[bad], self.error[none] = "features or target missing", "no positive target"
        self.done = bad | none

    def step(self, rows: DataFrame) -> None:
        shared = rows.sparkSession.sparkContext.broadcast((self.beta, ~self.done, self.n))
        held, penalties, p, low = self.held, self.penalties, self.p, self.low

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            beta, active, _ = shared.value
            found: dict[int, np.ndarray] = {}
            for batch in batches:
                key, fold, *values = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
                # Rows that lack a number are only in folds that no open model trains on.
                *x, y = np.nan_to_num(np.array(values, float))
                x = np.column_stack([np.ones(len(y)), *x])
                order = np.argsort(key, kind="stable")
                for own in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
                    k = int(key[own[0]]) if len(own) else 0
                    if not len(own) or not active[k].any():
                        continue
                    on = np.flatnonzero(active[k])
                    xo = x[own]
                    mu = np.exp(np.clip(xo @ beta[k, on].T, -30, 30))
                    trains = fold[own][:, None] != held[on][None, :]
                    gradient = np.where(trains, mu - y[own][:, None], 0.0).T @ xo
                    curvature = np.where(trains, mu, 0.0).T @ (xo[:, low[0]] * xo[:, low[1]])
                    if k not in found:
                        found[k] = np.zeros((len(held), p + len(low[0])))
                    found[k][on] += np.hstack([gradient, curvature])
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([s.tobytes() for s in found.values()], pa.binary())], ["__key", "data"])

        def solved(parts: pa.Table) -> pa.Table:
            k = parts.column("__key")[0].as_py()
            total = sum(np.frombuffer(d) for d in parts.column("data").to_pylist()).reshape(len(held), -1)
            beta, active, n = (a[k] for a in shared.value)
            moves, errors = np.zeros_like(beta), [None] * len(held)
            for v in np.flatnonzero(active):
                g, h = total[v, :p] / n[v], np.zeros((p, p))
                h[low] = total[v, p:] / n[v]
                h += np.tril(h, -1).T
                pull = penalties[v] * np.array([0.0] + [1.0] * (p - 1))
                try:
                    moves[v] = np.linalg.solve(h + np.diag(pull) + 1e-12 * np.eye(p), g + pull * beta[v])
                except np.linalg.LinAlgError as e:
                    errors[v] = str(e)
            return pa.table({"__key": pa.array([k], pa.int32()), "moves": pa.array([moves.tobytes()], pa.binary()), "errors": pa.array([errors], pa.list_(pa.string()))})

        dealt = rows.mapInArrow(sums, "__key int, data binary").groupBy("__key")
        for r in dealt.applyInArrow(solved, "__key int, moves binary, errors array<string>").toArrow().to_pylist():
            k, moves = r["__key"], np.frombuffer(r["moves"]).reshape(-1, p)
            largest = np.abs(moves).max(-1)
            self.beta[k] -= moves * np.minimum(1.0, 4.0 / np.maximum(largest, 1e-300))[:, None]
            failed = np.array([e is not None for e in r["errors"]])
            self.error[k][failed] = [e for e in r["errors"] if e is not None]
            self.done[k] |= failed | (largest < 1e-7)  # a step's error is about its square
        shared.destroy()


def fit_variants(rows: DataFrame, keys: list[str], features: list[str], stage: Callable[[DataFrame], DataFrame], variants: list[tuple[int | None, float]], fold: str | None = None, target: str = "target", rounds: int = 25) -> DataFrame:
    """keys, held, alpha, n, beta (intercept first), status, error: a model for each key of rows and each variant.

    A variant (held, alpha) trains on the rows whose fold isn't held (all rows if it is None) and minimises
    mean(mu - y eta) + alpha / 2 |beta|^2, the intercept left out of the penalty. A model whose data are missing or not
    numbers, or that doesn't converge, has status fail and its error; others aren't affected. Null keys are a key.
    stage: writes a frame and reads it again.
    """
    slim = stage(rows.select(*keys, (F.coalesce(F.col(fold), F.lit(-2)) if fold else F.lit(-2)).cast("int").alias("__fold"), *[F.col(c).cast("double").alias(f"__x{k}") for k, c in enumerate([*features, target])]))
    values = [f"__x{k}" for k in range(len(features) + 1)]
    ids, chunks = _numbered(slim.select(*keys).distinct(), keys, len(variants))
    ids = stage(ids)
    own = _with_models(slim, ids, keys).select("__chunk", "__key", "__fold", *values)
    if chunks > 1:  # so that each group reads little more than its own rows
        own = stage(own.sortWithinPartitions("__chunk"))
    held, alphas = np.array([-1 if h is None else h for h, _ in variants]), np.array([a for _, a in variants], float)
    schema = "__key int, held int, alpha double, n long, beta array<double>, status string, error string"
    out = None
    for c in range(chunks):
        part = own.where(F.col("__chunk") == c).drop("__chunk")
        counts = part.groupBy("__key", "__fold").agg(F.count("*").alias("n"), F.sum(values[-1]).alias("total"), F.max(_bad(values)).alias("bad")).collect()
        if not counts and chunks > 1:
            continue
        found: list[tuple] = []
        if counts:
            group = _Newton(held, alphas, len(features) + 1)
            group.begin(counts)
            for _ in range(rounds):
                if group.done.all():
                    break
                group.step(part)
            for k in range(len(group.n)):
                for v, (h, a) in enumerate(variants):
                    error = group.error[k, v] or (None if group.done[k, v] else "no convergence")
                    if group.n[k, v]:
                        found.append((k, h, float(a), int(group.n[k, v]), group.beta[k, v].tolist(), "fail" if error else "ok", error))
        models = rows.sparkSession.createDataFrame(found, schema)
        named = ids.where(F.col("__chunk") == c).join(F.broadcast(models), "__key").select(*keys, "held", "alpha", "n", "beta", "status", "error")
        named = stage(named)  # a join's size would be guessed as a product, too large to be broadcast
        out = named if out is None else out.unionByName(named)
    return out


def fit(rows: DataFrame, keys: list[str], features: list[str], stage: Callable[[DataFrame], DataFrame], alpha: float = 1e-4, target: str = "target", rounds: int = 25) -> DataFrame:
    """keys, alpha, n, beta, status, error: one model for each key of rows; see fit_variants."""
    return fit_variants(rows, keys, features, stage, [(None, alpha)], target=target, rounds=rounds).drop("held")


def score(rows: DataFrame, models: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """rows with score, exp(eta) of their key's model; null where a feature is missing or not a number, or without a model."""
    table = models.where("status = 'ok'").select(*keys, "beta")
    return _with_models(rows, table, keys, "left").withColumn("score", F.when(~_bad(features), F.exp(_eta(features)))).drop("beta")


def gradient(rows: DataFrame, models: DataFrame, keys: list[str], features: list[str], target: str = "target", fold: str | None = None) -> DataFrame:
    """keys, n, term, gradient of the penalised objective at each model's coefficients: zero at its optimum, and only there.

    fold: for models of fit_variants(), one result for each held and alpha beside the keys, over the rows that such a model
    trains on. Only numbers are summed up, so tasks combine their own rows in memory; coefficients are joined to the sums.
    """
    x = {"intercept": F.lit(1.0), **{f: F.col(f) for f in features}}
    by = [*keys, "held", "alpha"] if fold else keys
    table = models.where("status = 'ok'").select(*by, "n", "beta", F.col("alpha").alias("penalty"))
    met = _with_models(rows.select(*keys, *features, target, *([fold] if fold else [])), table.select(*by, "beta"), keys)
    if fold:
        met = met.where(F.col("held").isNull() | ~F.col(fold).eqNullSafe(F.col("held")))
    off = F.exp(_eta(features)) - F.col(target)
    sums = met.groupBy(*by).agg(*[F.avg(off * v).alias(f"__{t}") for t, v in x.items()])
    found = _with_models(sums, table, by)
    pulled = [F.struct(F.lit(t).alias("term"), (F.col(f"__{t}") + (F.col("penalty") * F.col("beta")[k] if k else 0.0)).alias("gradient")) for k, t in enumerate(x)]
    return found.select(*by, "n", F.explode(F.array(*pulled)).alias("g")).select(*by, "n", "g.*")


def cross_validate(rows: DataFrame, keys: list[str], features: list[str], alphas: list[float], stage: Callable[[DataFrame], DataFrame], folds: int = 5) -> DataFrame:
    """rows (with fold 0 to folds - 1) once for each alpha, with alpha and the score of the model that didn't see their fold.

    The score is null where a feature is missing, or there is no such model.
    """
    rows = stage(rows)
    models = fit_variants(rows, keys, features, stage, [(k, float(a)) for k in range(folds) for a in alphas], fold="fold")
    none = F.array(*[F.struct(F.lit(float(a)).alias("alpha"), F.lit(None).cast("array<double>").alias("beta")) for a in alphas])
    each = F.struct("alpha", F.when(F.col("status") == "ok", F.col("beta")).alias("beta"))
    table = models.groupBy(*keys, F.col("held").alias("fold")).agg(F.collect_list(each).alias("__models"))
    met = _with_models(rows, table, [*keys, "fold"], "left")
    met = met.select(*rows.columns, F.explode(F.coalesce("__models", none)).alias("__model")).select(*rows.columns, "__model.*")
    return met.withColumn("score", F.when(~_bad(features), F.exp(_eta(features)))).drop("beta")


def stored(rows: DataFrame, models: DataFrame, keys: list[str], features: list[str], stage: Callable[[DataFrame], DataFrame], scaler: DataFrame | None = None, thresholds: DataFrame | None = None) -> DataFrame:
    """keys, beta, top, threshold, means, deviations: all that scoring new data takes of each model.

    rows: the training rows with raw features. scaler: what features.scaler() gave of them if the models were fitted to
    scaled features; its means and deviations are stored, too, otherwise null. top: the largest score over the rows.
    thresholds: keys, threshold as shares of top, such as the pooled cross-validation's; without them it is that of the
    best F1 over the rows.
    """
    held = models.where("status = 'ok'").select(*keys, "beta")
    if scaler is not None:
        held = _with_models(held, scaler.select(*keys, "means", "deviations"), keys)
    else:
        held = held.withColumns({c: F.lit(None).cast("array<double>") for c in ("means", "deviations")})
    scored = _with_models(rows, held, keys).withColumn("score", _raw_score(features)).where("score is not null")
    top = scored.groupBy(*keys).agg(F.max("score").alias("top"))
    if thresholds is None:
        share = F.round(F.col("score") / F.col("top"), 9)
        thresholds = metrics.best_f1(stage(_with_models(scored, top, keys).select(*keys, "label", share.alias("score"))), keys)
    return _with_models(_with_models(held, top, keys), thresholds.select(*keys, "threshold"), keys)


def _raw_score(features: list[str]) -> Column:
    """exp(eta) of raw features by beta, means and deviations; null where a feature is missing or there is no model."""
    eta = F.col("beta")[0]
    for k, f in enumerate(features):
        eta = eta + F.col("beta")[k + 1] * scaling.by_stored(F.col(f), F.col("means")[k], F.col("deviations")[k])
    return F.when(F.col("beta").isNotNull() & ~_bad(features), F.exp(F.least(F.greatest(eta, F.lit(-30.0)), F.lit(30.0))))


def predict_presence(rows: DataFrame, table: DataFrame, keys: list[str], features: list[str], mode: str = "stored") -> DataFrame:
    """rows with intensity (the score's share of a top) and present (1 at the stored threshold or more).

    table: what stored() gave; features are raw, and are scaled as they were for the fit. mode "stored": the top is that
    of the training rows, so a row's result doesn't depend on others, and streams can be scored; "batch": it is the
    largest score of the key's rows at hand. Both columns are null where a feature is missing or there is no model.
    """
    if mode not in ("stored", "batch"):
        raise ValueError(f"mode {mode} isn't stored or batch")
    met = _with_models(rows, table.select(*keys, "beta", "top", "threshold", "means", "deviations"), keys, "left").withColumn("__score", _raw_score(features))
    if mode == "batch":
        top = met.groupBy(*keys).agg(F.max("__score").alias("top"))
        met = _with_models(met.drop("top"), top, keys, "left")
    share = F.round(F.col("__score") / F.col("top"), 9)
    return met.withColumn("intensity", share).withColumn("present", (F.col("intensity") >= F.col("threshold")).cast("int")).drop("beta", "top", "threshold", "means", "deviations", "__score")


def glm(rows: DataFrame, features: list[str], target: str = "target", alpha: float = 1e-4):
    """The same model by Spark ML, to be saved and loaded. Its penalty is relative to the sum of intensities."""
    mean = rows.agg(F.avg(target)).first()[0]
    steps = [VectorAssembler(inputCols=features, outputCol="x"), GeneralizedLinearRegression(family="poisson", link="log", featuresCol="x", labelCol=target, regParam=alpha / mean, maxIter=50, tol=1e-10)]
    return Pipeline(stages=steps).fit(rows)


def importance(models: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """keys, feature, coefficient, rank by absolute size."""
    named = models.select(*keys, F.posexplode("beta").alias("k", "coefficient")).where("k > 0")
    named = named.withColumn("feature", F.element_at(F.array(*[F.lit(f) for f in features]), F.col("k")))
    order = Window.partitionBy(*keys).orderBy(F.abs("coefficient").desc(), "feature")
    return named.select(*keys, "feature", "coefficient", F.row_number().over(order).alias("rank"))
