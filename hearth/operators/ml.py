"""Modelling on Spark.

Linear models (OLS, ridge, lasso) are fitted from per-fold Gram matrices
``[1 x y]'[1 x y]`` gathered in ONE distributed pass: each task folds its Arrow
batches into a small (p+2)^2 matrix with numpy, Spark sums them per fold, and
only those k small matrices reach the driver.  Every alpha of the grid and
every fold (and the per-fold standardisation) is then solved from them
exactly, so a 25-alpha x 5-fold search costs one scan, not 125 fits.
Forests use Spark ML's distributed estimator, boosted trees ``operators.boosting``.
"""

from __future__ import annotations

import json
import random
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth import constants as K
from hearth.operators.quantiles import column_quantiles, exact_quantiles, mode_of

RANDOM_SEED = 42


# ---- preprocessing stages ------------------------------------------------------

class ColumnFill(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Fill NULLs from a fitted ``{column: value}`` map (exact medians / modes)."""

    values = Param(Params._dummy(), "values", "JSON object column -> fill value", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, values: str = "{}"):
        super().__init__()
        self._setDefault(values="{}")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        vals = json.loads(self.getOrDefault(self.values))
        vals = {k: v for k, v in vals.items() if k in df.columns and v is not None}
        return df.fillna(vals) if vals else df


def fit_fill_values(df: DataFrame, numeric: Sequence[str], text: Sequence[str]) -> dict:
    """P10/M3/M4: exact median per numeric column, mode per text column,
    ``NoFeature`` when a text column has no value at all."""
    out: dict = {c: v[0] for c, v in column_quantiles(df, numeric, [0.5])[None].items()} if numeric else {}
    if text:
        long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v"))
                                               for c in text])).alias("_p")).select("_p.*")
        modes = {r["column"]: r["mode"] for r in mode_of(long, "v", by=["column"]).collect()}
        for c in text:
            out[c] = modes.get(c) if modes.get(c) is not None else K.ABSENT
    return out


def preprocessing_pipeline(numeric: Sequence[str], text: Sequence[str], fills: dict,
                           output: str = "features") -> Pipeline:
    """M6/M7: fill -> index (unseen -> extra slot) -> one-hot keeping every
    real level (unseen -> all zeros) -> assemble numeric + one-hot."""
    stages: list = [ColumnFill(values=json.dumps(fills))]
    ohe_cols = []
    if text:
        idx = [f"{c}__idx" for c in text]
        ohe_cols = [f"{c}__ohe" for c in text]
        stages += [StringIndexer(inputCols=list(text), outputCols=idx, handleInvalid="keep", stringOrderType="alphabetAsc"),
                   OneHotEncoder(inputCols=idx, outputCols=ohe_cols, dropLast=True, handleInvalid="error")]
    stages.append(VectorAssembler(inputCols=list(numeric) + ohe_cols, outputCol=output, handleInvalid="keep"))
    return Pipeline(stages=stages)


def training_sets(df: DataFrame, numeric: Sequence[str], text: Sequence[str], fold: str, folds: Sequence) -> dict:
    """{f: (fills, levels)} learned without fold f, all from a few shared passes:
    what ``fit_fill_values`` and an alphabetical index of the filled texts find on
    these rows.  A column without holes needs no fill."""
    hole = lambda c: F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
    holes = df.agg(*[F.count_if(hole(c)).alias(f"n{i}") for i, c in enumerate(numeric)]).first() if numeric else ()
    missing = [c for c, n in zip(numeric, holes, strict=True) if n]
    medians = column_quantiles(df, missing, [0.5], fold, folds) if missing else {}
    counted: list = []
    if text:  # bounded by the one-hot width and the folds
        long = df.select(F.col(fold).alias("f"), F.explode(F.array(*[F.struct(F.lit(t).alias("c"), F.col(t).cast("string").alias("v")) for t in text])).alias("p"))
        counted = long.select("f", "p.*").groupBy("f", "c", "v").agg(F.count(F.lit(1)).alias("n")).collect()
    out = {}
    for f in folds:
        fills = {c: v[0] for c, v in medians.get(f, {}).items()}
        levels: dict = {}
        for t in text:
            n: dict = {}
            for r in counted:
                if r["c"] == t and r["f"] != f:
                    n[r["v"]] = n.get(r["v"], 0) + r["n"]
            known = [v for v in n if v is not None]
            fills[t] = min(known, key=lambda v: (-n[v], v)) if known else K.ABSENT
            levels[t] = sorted({fills[t] if v is None else v for v in n})
        out[f] = fills, levels
    return out


def dense_features(df: DataFrame, numeric: Sequence[str], text: Sequence[str], fills: dict, levels: dict, keep: Sequence[str] = (),
                   output: str = "features") -> DataFrame:
    """The ``keep`` columns and the vectors and slot attributes of
    ``preprocessing_pipeline`` from its fitted fills and levels: no pass to fit, no
    indexer and encoder call per text, and slots that are read by position."""
    filled = ColumnFill(values=json.dumps(fills)).transform(df)
    attrs = [("numeric", c) for c in numeric] + [("binary", f"{t}__ohe_{lv}") for t in text for lv in levels[t]]
    known = [pa.array(levels[t], pa.string()) for t in text]

    def vectors(batches):
        for b in batches:
            x = np.zeros((b.num_rows, len(attrs)))
            for j in range(len(numeric)):
                x[:, j] = b.column(f"_x{j}").to_numpy(zero_copy_only=False)  # NULL becomes NaN
            at = len(numeric)
            for j, values in enumerate(known):
                i = pc.fill_null(pc.index_in(b.column(f"_t{j}"), values), -1).to_numpy()
                rows = np.flatnonzero(i >= 0)
                x[rows, at + i[rows]] = 1.0
                at += len(values)
            ends = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * len(attrs))
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keep))], pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], names=[*keep, output])

    cols = [F.col(c).cast("double").alias(f"_x{j}") for j, c in enumerate(numeric)] + [F.col(t).cast("string").alias(f"_t{j}") for j, t in enumerate(text)]
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField(output, T.ArrayType(T.DoubleType()))])
    rows = filled.select(*keep, *cols).mapInArrow(vectors, schema)
    groups: dict = {}
    for i, (kind, name) in enumerate(attrs):
        groups.setdefault(kind, []).append({"idx": i, "name": name})
    return rows.withColumn(output, array_to_vector(output).alias(output, metadata={"ml_attr": {"attrs": groups, "num_attrs": len(attrs)}}))


def feature_names(assembled: DataFrame, col: str = "features") -> list[str]:
    """Names of the assembled vector's slots from its ML attribute metadata."""
    meta = assembled.schema[col].metadata.get("ml_attr", {})
    attrs = meta.get("attrs", {})
    slots = [(a["idx"], a["name"]) for group in attrs.values() for a in group]
    n = meta.get("num_attrs", len(slots))
    names = {i: nm for i, nm in slots}
    return [names.get(i, f"feature_{i}") for i in range(n)]


# ---- Gram statistics -----------------------------------------------------------

@dataclass
class LinearFit:
    """Coefficients on the ORIGINAL (unscaled) feature slots."""

    intercept: float
    coef: np.ndarray
    alpha: float
    kind: str

    def weights(self) -> list[float]:
        return [float(self.intercept), *map(float, self.coef)]


def _slots(scaled: int | bool, p: int) -> int:
    """How many leading slots are standardised: all, none, or the number given
    (the numeric block; one-hot slots after it keep their scale)."""
    return (p if scaled else 0) if isinstance(scaled, bool) else min(scaled, p)


def _standardised(zz: np.ndarray, scaled: int | bool):
    """n, means, mean of y, centred X'X and X'y on the fitted scale, the scale
    of each slot and centred y'y."""
    n = zz[0, 0]
    mu, my = zz[0, 1:-1] / n, zz[0, -1] / n
    cxx = zz[1:-1, 1:-1] - n * np.outer(mu, mu)
    cxy = zz[1:-1, -1] - n * mu * my
    sd = np.ones(len(mu))
    k = _slots(scaled, len(mu))
    sd[:k] = np.sqrt(np.clip(np.diag(cxx)[:k] / n, 0, None))
    sd[sd <= 0] = 1.0
    return n, mu, my, cxx / np.outer(sd, sd), cxy / sd, sd, zz[-1, -1] - n * my * my


#: Sweeps after which a lasso that has not converged is an error.
LASSO_SWEEPS = 20_000


def lasso_descent(a: np.ndarray, b: np.ndarray, yy: float, n: float, alpha: float, start: np.ndarray | None = None,
                  tolerance: float = 1e-6) -> np.ndarray:
    """``(1/2n)||y - Xw||^2 + alpha ||w||_1`` by coordinate descent on centred
    Gram statistics, from ``start``, until the duality gap is below
    ``tolerance`` y'y.  Raises when it stays above 1e-4 y'y."""
    p = len(b)
    w = np.zeros(p) if start is None else start.copy()
    grad = b - a @ w
    diag = np.diag(a)
    usable = np.flatnonzero(diag > 1e-12 * max(1.0, float(diag.max(initial=0.0))))
    w[np.setdiff1d(np.arange(p), usable)] = 0.0
    grad = b - a @ w
    gap = np.inf
    for sweep in range(LASSO_SWEEPS):
        for j in usable if sweep % 10 == 0 else np.flatnonzero(w):  # mostly over what is not zero
            old = w[j]
            rho = grad[j] + diag[j] * old
            w[j] = np.sign(rho) * max(abs(rho) - n * alpha, 0.0) / diag[j]
            if w[j] != old:
                grad -= a[:, j] * (w[j] - old)
        if sweep % 5 == 0:
            rr, ry = yy - b @ w - grad @ w, yy - b @ w
            shrink = min(1.0, n * alpha / max(np.abs(grad[usable]).max(initial=0.0), 1e-300))
            gap = 0.5 * rr * (1 + shrink * shrink) + n * alpha * np.abs(w).sum() - shrink * ry
            if gap <= tolerance * max(yy, 1e-300):
                return w
    if gap > 1e-4 * yy:
        raise RuntimeError(f"lasso with alpha {alpha} has not converged after {LASSO_SWEEPS} sweeps")
    return w


def solve_linear(zz: np.ndarray, kind: str, alpha: float, scale: int | bool = True, start: np.ndarray | None = None,
                 tolerance: float = 1e-6) -> LinearFit:
    """OLS (minimum-norm, via pseudo-inverse), ridge ``||y-Xw||^2 + alpha||w||^2``
    or lasso with an unpenalised intercept, mapped back to the original
    features.  ``scale``: the slots that are standardised first (see
    ``_slots``); the penalty acts on that scale."""
    n, mu, my, a, b, sd, yy = _standardised(zz, scale)
    if kind == "linear" or (kind == "ridge" and alpha <= 0):
        w = np.linalg.pinv(a, hermitian=True) @ b
    elif kind == "ridge":
        w = np.linalg.solve(a + alpha * np.eye(len(b)), b)
    elif kind == "lasso":
        w = lasso_descent(a, b, yy, n, alpha, start, tolerance)
    else:
        raise ValueError(kind)
    coef = w / sd
    return LinearFit(float(my - mu @ coef), coef, alpha, kind)


def _sse(zz: np.ndarray, fit: LinearFit) -> float:
    w = np.concatenate([[fit.intercept], fit.coef])
    return float(zz[-1, -1] - 2 * w @ zz[:-1, -1] + w @ zz[:-1, :-1] @ w)


def select_alpha(grams: dict, kind: str, alphas: Sequence[float], scale: int | bool = True) -> tuple[float, dict]:
    """k-fold CV over the alpha grid from the folds' Gram matrices; each fold
    walks the grid from its largest alpha, starting from the fit before."""
    total = sum(grams.values())
    sse = dict.fromkeys(alphas, 0.0)
    for zz in grams.values():
        rest, start = total - zz, None
        sd = _standardised(rest, scale)[5]
        for alpha in sorted(alphas, reverse=True):
            fit = solve_linear(rest, kind, alpha, scale, start, tolerance=1e-4)
            start = fit.coef * sd
            sse[alpha] += _sse(zz, fit)
    scores = {a: v / total[0, 0] for a, v in sse.items()}
    return min(alphas, key=lambda a: (scores[a], a)), scores


# ---- model specs ----------------------------------------------------------------

@dataclass(frozen=True)
class ModelSpec:
    name: str
    kind: str  # linear | ridge | lasso | forest | gbt | boosted
    feature_set: str = "full"
    scale_numeric: bool = False
    log_skewed: bool = False
    alphas: tuple = ()
    params: dict = field(default_factory=dict)


# fixed values: the compared model family
DEFAULT_SPECS = (
    ModelSpec("linear_regression", "linear", "reduced_linear", True, True),
    ModelSpec("ridge_regression", "ridge", "reduced_linear", True, True, tuple(np.logspace(-3, 3, 25))),
    ModelSpec("lasso_regression", "lasso", "reduced_linear", True, True, tuple(np.logspace(-4, 0, 25))),
    ModelSpec("random_forest", "forest", "full", False, False,
              params={"numTrees": 350, "minInstancesPerNode": 2, "featureSubsetStrategy": "sqrt", "maxDepth": 30}),
    ModelSpec("boosted_trees", "boosted", "full", False, False,
              params={"rounds": 500, "rate": 0.035, "depth": 3, "subsample": 0.85, "colsample": 0.85}),
)


def tree_estimator(spec: ModelSpec, label: str = "label", features: str = "features"):
    common = dict(featuresCol=features, labelCol=label, seed=RANDOM_SEED)
    if spec.kind == "forest":
        return RandomForestRegressor(**common, **spec.params)
    if spec.kind == "gbt":
        return GBTRegressor(**common, **spec.params)
    raise ValueError(spec.kind)


def importance_table(model, names: Sequence[str]) -> pd.DataFrame:
    """``(feature, importance, raw_value, importance_type)``; names fall
    back to ``feature_i`` when they do not line up."""
    if isinstance(model, LinearFit):
        vals, kind = np.asarray(model.coef), "coefficient_abs"
    elif hasattr(model, "featureImportances"):
        vals, kind = model.featureImportances.toArray(), "feature_importance"
    else:
        return pd.DataFrame(columns=["feature", "importance", "raw_value", "importance_type"])
    if len(names) != len(vals):
        names = [f"feature_{i}" for i in range(len(vals))]
    out = pd.DataFrame({"feature": list(names), "importance": np.abs(vals), "raw_value": vals, "importance_type": kind})
    return out.sort_values(["importance", "feature"], ascending=[False, True]).reset_index(drop=True)


#: Rows of the short importance report.
TOP_FEATURES = 25


def top_importances(table: DataFrame, n: int = TOP_FEATURES) -> DataFrame:
    """O3: the ``n`` most important features with their rank from 1."""
    top = table.orderBy(F.desc("importance"), "feature").limit(n)
    order = Window.orderBy(F.desc("importance"), "feature")  # over n rows
    return top.withColumn("rank", F.row_number().over(order))


def sample_param_maps(grid: dict, n_iter: int, seed: int = RANDOM_SEED) -> list[dict]:
    """``n_iter`` distinct random draws from a parameter grid (seeded)."""
    keys = sorted(grid)
    rnd = random.Random(seed)
    seen, out = set(), []
    total = int(np.prod([len(grid[k]) for k in keys]))
    while len(out) < min(n_iter, total):
        pick = tuple(rnd.randrange(len(grid[k])) for k in keys)
        if pick not in seen:
            seen.add(pick)
            out.append({k: grid[k][i] for k, i in zip(keys, pick)})
    return out


# fixed values: tuning grids (Spark parameter names; depth capped at Spark's 30)
FOREST_GRID = {"numTrees": [250, 400, 600], "maxDepth": [30, 12, 20], "minInstancesPerNode": [1, 2, 4],
               "featureSubsetStrategy": ["sqrt", "0.5", "0.8"]}
GBT_GRID = {"maxIter": [300, 500, 800], "stepSize": [0.02, 0.035, 0.05, 0.08], "maxDepth": [2, 3, 4],
            "subsamplingRate": [0.75, 0.85, 1.0], "featureSubsetStrategy": ["0.75", "0.85", "1.0"],
            "minInstancesPerNode": [1, 3, 5]}
BOOST_GRID = {"rounds": [300, 500, 800], "rate": [0.02, 0.035, 0.05, 0.08], "depth": [2, 3, 4], "subsample": [0.75, 0.85, 1.0],
              "colsample": [0.75, 0.85, 1.0], "penalty": [1.0, 3.0, 5.0, 10.0], "min_rows": [1, 3, 5]}


def tune_trees(assembled: DataFrame, spec: ModelSpec, grid: dict, n_iter: int = 12, folds: int = 3,
               label: str = "label", features: str = "features", key: Sequence[str] = ("fold",),
               parallelism: int = 4):
    """Seeded random search scored on log-RMSE with Spark's CrossValidator
    over a deterministic fold column (hash of the key, not row position)."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.tuning import CrossValidator

    from hearth.operators.metrics import fold_of

    est = tree_estimator(spec, label, features)
    maps = [{est.getParam(k): v for k, v in m.items()} for m in sample_param_maps(grid, n_iter)]
    data = assembled.withColumn("_cvfold", fold_of(*key, k=folds))
    cv = CrossValidator(estimator=est, estimatorParamMaps=maps, foldCol="_cvfold", numFolds=folds,
                        evaluator=RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse"),
                        parallelism=parallelism, seed=RANDOM_SEED)
    model = cv.fit(data)
    best = int(np.argmin(model.avgMetrics))
    return model, {p.name: v for p, v in maps[best].items()}, float(model.avgMetrics[best])


# ---- scoring ----------------------------------------------------------------------

def to_price(pred_log: str = "prediction", name: str = "predicted_price"):
    """``expm1`` back to price, floored at 0."""
    return F.greatest(F.expm1(F.col(pred_log)), F.lit(0.0)).alias(name)


@dataclass
class ScoringBundle:
    """What scoring needs, saved side by side under one folder.

    Linear models carry a column-level ``design`` and score as one SQL
    expression; tree models carry the fitted preprocessing pipeline.
    """

    prep: PipelineModel | None
    model: object
    columns: list
    defaults: dict
    version: str
    mape: float | None = None
    design: object | None = None

    def save(self, path: str) -> None:
        from pyspark.sql import SparkSession

        if self.prep is not None:
            self.prep.write().overwrite().save(f"{path}/prep")
        if isinstance(self.model, LinearFit):
            meta = {"kind": self.model.kind, "alpha": self.model.alpha, "weights": self.model.weights()}
        else:
            self.model.write().overwrite().save(f"{path}/model")
            meta = {"kind": type(self.model).__name__}
        doc = {"columns": self.columns, "defaults": self.defaults, "version": self.version, "mape": self.mape,
               "model": meta, "design": self.design.to_json() if self.design is not None else None,
               "has_prep": self.prep is not None}
        SparkSession.getActiveSession().createDataFrame([(json.dumps(doc),)], "doc string").coalesce(1) \
            .write.mode("overwrite").text(f"{path}/bundle")

    @staticmethod
    def load(spark, path: str) -> "ScoringBundle":
        from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel

        doc = json.loads(spark.read.text(f"{path}/bundle").first()[0])
        prep = PipelineModel.load(f"{path}/prep") if doc.get("has_prep") else None
        meta = doc["model"]
        if meta["kind"] in ("linear", "ridge", "lasso"):
            w = meta["weights"]
            model = LinearFit(w[0], np.asarray(w[1:]), meta["alpha"], meta["kind"])
        elif meta["kind"] == "RandomForestRegressionModel":
            model = RandomForestRegressionModel.load(f"{path}/model")
        else:
            model = GBTRegressionModel.load(f"{path}/model")
        design = LinearDesign.from_json(doc["design"]) if doc.get("design") else None
        return ScoringBundle(prep, model, doc["columns"], doc["defaults"], doc["version"], doc.get("mape"), design)

    def score(self, batch: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Align -> predict -> price scale, with the model version."""
        cols = [c for c in self.columns if c not in keep]
        aligned = batch.select(*keep, *[F.col(c) if c in batch.columns else F.lit(self.defaults.get(c, K.ABSENT)).alias(c)
                                        for c in cols])
        if self.design is not None and isinstance(self.model, LinearFit):
            x = aligned.withColumn("prediction", linear_expression(self.design, self.model))
        else:
            x = self.model.transform(self.prep.transform(aligned))
        return x.select(*keep, to_price(), F.lit(self.version).alias("model_version"))


def confidence_range(oof: DataFrame, scores: DataFrame, edges: Sequence[float], labels: Sequence[str],
                     predicted: str = "predicted", actual: str = "actual", low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Per bucket of the predicted price, exact quantiles of the relative
    out-of-fold error ``actual / predicted - 1``; every score gets the range of
    its bucket (a table of at most ``len(labels)`` rows, broadcast)."""
    from hearth.functions.exprs import right_closed_bucket

    rel = oof.where(F.col(predicted) > 0).select(
        right_closed_bucket(predicted, edges, labels, include_lowest=True).alias("_bucket"),
        (F.col(actual) / F.col(predicted) - 1).alias("_rel"))
    bands = exact_quantiles(rel.where(F.col("_bucket").isNotNull()), "_rel", [low, high], by=["_bucket"],
                            names=["_lo", "_hi"])
    s = scores.withColumn("_bucket", right_closed_bucket(predicted, edges, labels, include_lowest=True))
    out = s.join(F.broadcast(bands), "_bucket", "left")
    return out.withColumn("range_low", F.greatest(F.col(predicted) * (1 + F.col("_lo")), F.lit(0.0))) \
        .withColumn("range_high", F.col(predicted) * (1 + F.col("_hi"))).drop("_bucket", "_lo", "_hi")


# ---- column-level linear design (no vector assembly) -------------------------------

@dataclass
class LinearDesign:
    """Numeric columns (NULL -> fitted fill) and one-hot text columns (every
    seen level kept, unseen -> all zeros), described by plain columns so both
    the Gram pass and predictions avoid assembling ML vectors.

    The Gram pass runs on a wider form in which a missing value is a slot of
    its own; ``collapse`` then applies any fills, so one pass serves training
    sets with different fills (``fills_without[f]``: learned without fold f)."""

    numeric: list
    text: list
    fills: dict
    levels: dict
    missing: list = field(default_factory=list)  # columns that have NULLs
    fills_without: dict = field(default_factory=dict)

    def names(self) -> list[str]:
        return list(self.numeric) + [f"{t}_{lv}" for t in self.text for lv in self.levels[t]]

    def without(self, fold) -> "LinearDesign":
        """The design with the fills learned without a fold."""
        return replace(self, fills={**self.fills, **self.fills_without.get(fold, {})})

    def numeric_values(self) -> list:
        return [F.coalesce(F.col(c).cast("double"), F.lit(float(self.fills.get(c) or 0.0))) for c in self.numeric]

    def text_value(self, t: str):
        return F.coalesce(F.col(t).cast("string"), F.lit(self.fills.get(t) or K.ABSENT))

    def level_index(self, t: str):
        """Slot of a value's level; -1 if unseen, -2 if missing."""
        m = F.create_map(*[x for i, lv in enumerate(self.levels[t]) for x in (F.lit(lv), F.lit(i))]) if self.levels[t] else None
        known = F.coalesce(F.element_at(m, F.col(t).cast("string")), F.lit(-1)) if m is not None else F.lit(-1)
        return F.when(F.col(t).isNull(), F.lit(-2)).otherwise(known)

    def wide_slots(self) -> list[tuple[str, str, str | None]]:
        """(kind, column, level) of the wide form's slots between 1 and y."""
        return (
            [("number", c, None) for c in self.numeric] + [("missing", c, None) for c in self.numeric if c in self.missing]
            + [("level", t, lv) for t in self.text for lv in self.levels[t]] + [("missing", t, None) for t in self.text if t in self.missing]
        )

    def wide_columns(self) -> list:
        """Columns that ``wide_matrix`` turns into the wide form's slots."""
        return [*[F.col(f"`{c}`").cast("double").alias(f"_x{j}") for j, c in enumerate(self.numeric)],
                *[self.level_index(t).alias(f"_i{j}") for j, t in enumerate(self.text)]]

    def wide_matrix(self, b: pa.RecordBatch, ends: int = 0) -> np.ndarray:
        """The wide form of a batch, one slot a row of the matrix; ``ends``: rows
        of ones to leave before the first slot and after the last."""
        n, p = b.num_rows, len(self.numeric)
        z = np.zeros((len(self.wide_slots()) + 2 * ends, n))
        z[:ends] = z[len(z) - ends :] = 1.0
        at = ends + p
        for j, c in enumerate(self.numeric):
            x = b.column(f"_x{j}").to_numpy(zero_copy_only=False)  # NULL becomes NaN
            hole = np.isnan(x)
            z[ends + j] = np.where(hole, 0.0, x)
            if c in self.missing:
                z[at] = hole
                at += 1
        every, lost = np.arange(n), []
        for j, t in enumerate(self.text):
            idx = b.column(f"_i{j}").to_numpy()
            ok = idx >= 0
            z[at + idx[ok], every[ok]] = 1.0
            at += len(self.levels[t])
            if t in self.missing:
                lost.append(idx == -2)
        for row in lost:
            z[at] = row
            at += 1
        return z

    def slots_in(self, whole: "LinearDesign") -> list[int]:
        """Where this design's wide slots are among those of ``whole``."""
        at = {s: i for i, s in enumerate(whole.wide_slots())}
        return [at[s] for s in self.wide_slots()]

    def fill_matrix(self) -> np.ndarray:
        """Maps the wide slots to the filled ones (names())."""
        slots = self.wide_slots()
        at = {s: i for i, s in enumerate(slots)}
        out = np.zeros((len(slots), len(self.numeric) + sum(len(self.levels[t]) for t in self.text)))
        k = 0
        for c in self.numeric:
            out[at["number", c, None], k] = 1.0
            if c in self.missing:
                out[at["missing", c, None], k] = float(self.fills.get(c) or 0.0)
            k += 1
        for t in self.text:
            for lv in self.levels[t]:
                out[at["level", t, lv], k] = 1.0
                if t in self.missing and lv == (self.fills.get(t) or K.ABSENT):
                    out[at["missing", t, None], k] = 1.0
                k += 1
        return out

    def collapse(self, wide: np.ndarray) -> np.ndarray:
        m = self.fill_matrix()
        full = np.zeros((m.shape[0] + 2, m.shape[1] + 2))
        full[0, 0] = full[-1, -1] = 1.0
        full[1:-1, 1:-1] = m
        return full.T @ wide @ full

    def to_json(self) -> str:
        return json.dumps({"numeric": self.numeric, "text": self.text, "fills": self.fills, "levels": self.levels})

    @staticmethod
    def from_json(doc: str) -> "LinearDesign":
        d = json.loads(doc)
        return LinearDesign(d["numeric"], d["text"], d["fills"], d["levels"])


def fit_linear_design(df: DataFrame, numeric: Sequence[str], text: Sequence[str], fold: str | None = None) -> LinearDesign:
    """Fills and levels over all rows; with ``fold``, also the fills of columns
    that have NULLs as learned without each fold.  (Levels need no such care: a
    level that a training set lacks has a zero column there and weight 0.)"""
    both = [*numeric, *text]
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(both)]).first() if both else ()
    missing = [c for c, n in zip(both, nulls, strict=True) if n]
    folds = sorted(r[0] for r in df.select(fold).distinct().collect()) if fold and missing else []  # k values
    medians = column_quantiles(df, numeric, [0.5], fold, folds, missing) if numeric else {s: {} for s in [None, *folds]}
    counted: list = []
    if text:  # bounded by the one-hot width and the folds
        f = F.col(fold) if folds else F.lit(None)
        long = df.select(f.alias("f"), F.explode(F.array(*[F.struct(F.lit(t).alias("c"), F.col(t).cast("string").alias("v")) for t in text])).alias("_p"))
        counted = long.select("f", "_p.*").groupBy("f", "c", "v").agg(F.count(F.lit(1)).alias("n")).collect()

    def fills_of(left_out, columns) -> dict:
        """Medians and most frequent texts (ties: the smallest) without a fold."""
        got = {c: v[0] for c, v in medians[left_out].items() if c in columns}
        for t in [t for t in text if t in columns]:
            n: dict = {}
            for r in counted:
                if r["c"] == t and r["v"] is not None and (left_out is None or r["f"] not in (left_out, None)):
                    n[r["v"]] = n.get(r["v"], 0) + r["n"]
            got[t] = min(n, key=lambda v: (-n[v], v)) if n else K.ABSENT
        return got

    fills = fills_of(None, both)
    levels = {t: sorted({fills[t] if r["v"] is None else r["v"] for r in counted if r["c"] == t}) for t in text}
    return LinearDesign(list(numeric), list(text), fills, levels, missing, {f: fills_of(f, missing) for f in folds})


def _summed(df: DataFrame) -> dict[int, np.ndarray]:
    """Sum of equally sized arrays per ``f``, from rows (f, part, v) with one
    row a task and f: at most 64 arrays meet in a group, over three levels."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(v) for v in rows["v"]], axis=0)
        return pd.DataFrame({"f": rows["f"].iloc[:1], "part": rows["part"].iloc[:1], "v": [total.tobytes()]})

    schema = "f int, part long, v binary"
    for _ in range(2):
        df = df.withColumn("part", F.floor(F.col("part") / 64)).groupBy("f", "part").applyInPandas(add, schema)
    return {r["f"]: np.frombuffer(r["v"]) for r in df.groupBy("f").applyInPandas(add, schema).collect()}


def design_gram_by_fold(df: DataFrame, design: LinearDesign, label: str, fold: str | None) -> dict:
    """``{fold: Z'Z}`` with ``Z = [1, wide slots, y]`` from ONE pass."""
    d = len(design.wide_slots()) + 2
    cols = [F.col(fold).cast("int").alias("f") if fold else F.lit(0).alias("f"), *design.wide_columns(), F.col(label).cast("double").alias("y")]

    def partial(batches):
        from pyspark import TaskContext

        acc: dict[int, np.ndarray] = {}
        for b in batches:
            if b.num_rows:
                z = design.wide_matrix(b, ends=1)
                z[-1] = b.column("y").to_numpy(zero_copy_only=False)
                fv = b.column("f").to_numpy(zero_copy_only=False)
                for f_val in np.unique(fv):
                    x = z[:, fv == f_val]
                    acc[int(f_val)] = acc.get(int(f_val), 0) + x @ x.T
        if acc:
            yield _sum_rows(acc, TaskContext.get().partitionId())

    sums = _summed(df.select(*cols).mapInArrow(partial, "f int, part long, v binary"))
    return {f: v.reshape(d, d) for f, v in sums.items()}


def _sum_rows(sums: dict[int, np.ndarray], part: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array([part] * len(sums), pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())],
        names=["f", "part", "v"])


#: Rows whose leverages are computed together.
_LEVERAGE_ROWS = 1 << 11


def leave_one_out_alphas(df: DataFrame, problems: dict, alphas: Sequence[float], scale: int | bool, label: str, fold: str,
                         whole: LinearDesign | None = None) -> dict:
    """The ridge alpha with the least leave-one-out error for each training set,
    all from one pass.  ``problems``: {fold left out (or None), or a tuple that
    ends with it: (design with its fills, Gram matrix)}; with ``whole``, the
    designs may be restrictions of it, each with its own numbers standardised.
    A row's error without itself is its residual over one minus its leverage;
    both come from the eigenvectors of the Gram matrix.  Directions in which no
    row of the training set differs have no part in either."""
    keys = list(problems)
    if not keys:
        return {}
    first = whole or problems[keys[0]][0]
    ready = []
    for key in keys:
        design, zz = problems[key]
        n, mu, my, a, b, sd, _ = _standardised(zz, scale if whole is None or isinstance(scale, bool) else len(design.numeric))
        value, vector = np.linalg.eigh(a)
        some = value > len(value) * np.finfo(float).eps * max(float(value.max(initial=0.0)), 0.0)
        value, vector = value[some], vector[:, some]
        shrink = 1.0 / (value[:, None] + np.asarray(alphas, float)[None, :])
        turn = vector / sd[:, None]
        slots = np.zeros((len(first.wide_slots()), len(value)))
        slots[design.slots_in(first)] = design.fill_matrix() @ turn
        ready.append((key[-1] if isinstance(key, tuple) else key, np.ascontiguousarray(slots.T), (mu @ turn)[:, None], n, my,
                      np.ascontiguousarray(shrink.T), np.ascontiguousarray(((vector.T @ b)[:, None] * shrink).T)))
    cols = [F.col(fold).cast("int").alias("f"), *first.wide_columns(), F.col(label).cast("double").alias("y")]

    def partial(batches):
        from pyspark import TaskContext

        sse = np.zeros((len(ready), len(alphas)))
        for b in batches:
            if not b.num_rows:
                continue
            wide, y, fv = first.wide_matrix(b), b.column("y").to_numpy(zero_copy_only=False), b.column("f").to_numpy(zero_copy_only=False)
            for f in np.unique(fv):
                at = np.flatnonzero(fv == f)
                for lo in range(0, len(at), _LEVERAGE_ROWS):
                    x, target = wide[:, at[lo : lo + _LEVERAGE_ROWS]], y[at[lo : lo + _LEVERAGE_ROWS]]
                    for i, (left_out, turn, mean, n, my, shrink, weight) in enumerate(ready):
                        if left_out is None or left_out != f:
                            u = turn @ x
                            u -= mean
                            error = target - my - weight @ u
                            u *= u
                            error /= np.clip(1.0 - 1.0 / n - shrink @ u, 1e-12, None)
                            sse[i] += np.einsum("ij,ij->i", error, error)
        yield _sum_rows({0: sse}, TaskContext.get().partitionId())

    total = _summed(df.select(*cols).mapInArrow(partial, "f int, part long, v binary"))
    sse = total[0].reshape(len(ready), len(alphas)) if total else np.zeros((len(ready), len(alphas)))
    return {key: float(alphas[int(np.argmin(sse[i]))]) for i, key in enumerate(keys)}


def linear_expression(design: LinearDesign, fit: LinearFit):
    """The fitted model as one SQL expression over the original columns
    (codegen-friendly: numeric terms plus one literal-map lookup per text column)."""
    w = np.asarray(fit.coef, dtype=float)
    expr = F.lit(float(fit.intercept))
    for j, v in enumerate(design.numeric_values()):
        if w[j] != 0.0:
            expr = expr + F.lit(float(w[j])) * v
    off = len(design.numeric)
    for t in design.text:
        lv = design.levels[t]
        pairs = [x for i, level in enumerate(lv) if w[off + i] != 0.0 for x in (F.lit(level), F.lit(float(w[off + i])))]
        off += len(lv)
        if pairs:
            expr = expr + F.coalesce(F.element_at(F.create_map(*pairs), design.text_value(t)), F.lit(0.0))
    return expr


def linear_fits(df: DataFrame, design: LinearDesign, spec: ModelSpec, label: str = "label", fold: str = "fold",
                grams: dict | None = None) -> dict:
    """{fold: (design, fit)} of models fitted without that fold, and {None: ...}
    fitted on all rows.  Fills and alpha come from the training rows alone:
    ridge by leave-one-out, lasso by CV over the training folds."""
    grams = grams or design_gram_by_fold(df, design, label, fold)
    return linear_fits_together(df, design, {0: (design, grams)}, spec, label, fold)[0]


def linear_fits_together(df: DataFrame, whole: LinearDesign, parts: dict, spec: ModelSpec, label: str = "label", fold: str = "fold") -> dict:
    """``linear_fits`` of several designs, {name: (design, Gram matrices)}, each
    ``whole`` or a restriction of it; ridge alphas of all come from one pass."""
    total, grams_of, scales = {}, {}, {}
    for name, (design, grams) in parts.items():
        scales[name] = len(design.numeric) if spec.scale_numeric else False
        for key in [*sorted(grams), None]:
            d = design.without(key)
            rest = {f: d.collapse(zz) for f, zz in grams.items() if f != key}
            if rest:
                total[name, key], grams_of[name, key] = (d, sum(rest.values())), rest
    alphas = dict.fromkeys(total, 0.0)
    if spec.alphas and spec.kind == "ridge":
        alphas = leave_one_out_alphas(df, total, spec.alphas, len(whole.numeric) if spec.scale_numeric else False, label, fold, whole)
    elif spec.alphas:
        alphas = {k: select_alpha(g, spec.kind, spec.alphas, scales[k[0]])[0] if len(g) > 1 else min(spec.alphas) for k, g in grams_of.items()}
    out: dict = {name: {} for name in parts}
    for (name, key), (d, zz) in total.items():
        out[name][key] = d, solve_linear(zz, spec.kind, alphas[name, key], scales[name])
    return out


def predicted(df: DataFrame, design: LinearDesign, models: dict[str, dict], fold: str, keep: Sequence[str]) -> DataFrame:
    """The ``keep`` columns and a prediction column per entry of ``models``
    ({fold of a row: (design, fit)}; a row whose fold is missing gets NULL), all
    from one matrix product per Arrow batch.  The models' designs are
    ``design`` or restrictions of it, with any fills."""
    folds = sorted({f for by in models.values() for f in by if f is not None})
    weights = {f: np.full((len(models), len(design.wide_slots()) + 1), np.nan) for f in folds}
    for j, by in enumerate(models.values()):
        for f in folds:
            if f in by:
                d, fit = by[f]
                weights[f][j] = 0.0
                weights[f][j, -1] = fit.intercept
                weights[f][j, d.slots_in(design)] = d.fill_matrix() @ np.asarray(fit.coef, float)
    names = list(models)
    schema = T.StructType([df.schema[c] for c in keep if c not in names] + [T.StructField(n, T.DoubleType()) for n in names])
    kept = [c for c in keep if c not in names]

    def run(batches):
        for b in batches:
            out = np.full((len(names), b.num_rows), np.nan)
            x, fv = design.wide_matrix(b), b.column("_f")
            known = fv.is_valid().to_numpy(zero_copy_only=False)
            fv = fv.fill_null(0).to_numpy()
            for f in np.unique(fv[known]).tolist():
                if f in weights:
                    m = known & (fv == f)
                    out[:, m] = weights[f][:, :-1] @ x[:, m] + weights[f][:, -1:]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(kept))], *[pa.array(v, mask=np.isnan(v)) for v in out]], names=[*kept, *names])

    return df.select(*kept, F.col(fold).cast("int").alias("_f"), *design.wide_columns()).mapInArrow(run, schema)


def linear_oof(df: DataFrame, design: LinearDesign, spec: ModelSpec, label: str = "label", fold: str = "fold",
               name: str = "prediction", grams: dict | None = None, keep: Sequence[str] | None = None) -> tuple[DataFrame, dict]:
    """Out-of-fold predictions for OLS/ridge/lasso: each row by the model fitted
    without its fold.  ``info`` has the fits and the alpha of the refit on all
    rows."""
    grams = grams or design_gram_by_fold(df, design, label, fold)
    fits = linear_fits(df, design, spec, label, fold, grams)
    out = predicted(df, design, {name: fits}, fold, df.columns if keep is None else keep)
    return out, {"alpha": fits[None][1].alpha if None in fits else 0.0, "fits": fits, "grams": grams}


def gram_matrix(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """``[1 x]'[1 x]`` over numeric columns (NULLs must be filled first), one pass."""
    design = LinearDesign(list(cols), [], {c: 0.0 for c in cols}, {})
    zz = design_gram_by_fold(df.withColumn("_y0", F.lit(0.0)), design, "_y0", None)
    return zz.get(0, np.zeros((len(cols) + 2, len(cols) + 2)))[:-1, :-1]


def sub_design(design: LinearDesign, grams: dict, columns: Sequence[str]) -> tuple[LinearDesign, dict]:
    """Restrict a design and its per-fold Gram matrices to a subset of the
    columns (a feature-group ablation): the sub-problem's ``Z'Z`` is a block
    of the full one, so no data pass is needed."""
    keep = set(columns)
    idx = [0, *[1 + i for i, (_, c, _) in enumerate(design.wide_slots()) if c in keep], len(design.wide_slots()) + 1]
    sub = LinearDesign(
        [c for c in design.numeric if c in keep], [t for t in design.text if t in keep],
        {c: v for c, v in design.fills.items() if c in keep}, {t: v for t, v in design.levels.items() if t in keep},
        [c for c in design.missing if c in keep],
        {f: {c: v for c, v in fills.items() if c in keep} for f, fills in design.fills_without.items()},
    )
    return sub, {f: zz[np.ix_(idx, idx)] for f, zz in grams.items()}
