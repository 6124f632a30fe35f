"""Models on MLlib: ridge, boosted trees, forest with quantiles, drivers, validation."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaycast.functions.columns import features_hash, hash_unit
from assaycast.functions.stats import exact_percentile, exact_percentiles
from assaycast.session import scratch_dir


@dataclass
class Fitted:
    """A fitted model with what scoring needs: input columns and their training means."""

    name: str
    pipeline: PipelineModel
    columns: list[str]
    means: dict[str, float]
    params: dict = field(default_factory=dict)

    @property
    def hash(self) -> str:
        return features_hash(self.columns)

    @property
    def model(self):
        return self.pipeline.stages[-1]


def packed(columns: Sequence[str]) -> Column:
    """The inputs as one array: plans stay small however many features there are."""
    return F.expr(f"array({', '.join(f'CAST(`{c}` AS DOUBLE)' for c in columns)})")


def training_means(train: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Mean of each usable column (one small row per column; columns never seen in training drop out)."""
    long = train.select(F.posexplode(packed(columns)).alias("i", "x"))
    rows = long.groupBy("i").agg(F.avg("x").alias("m")).collect()
    means = {r["i"]: r["m"] for r in rows}
    return {c: float(means[i]) for i, c in enumerate(columns) if means.get(i) is not None}


def _literal(values: Sequence) -> Column:
    """An array constant, parsed from one text: hundreds of single literals are slow to build."""

    def text(v) -> str:
        if isinstance(v, str):
            return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return f"{v!r}D" if isinstance(v, float) else repr(v)

    return F.expr(f"array({', '.join(text(v) for v in values)})")


def _complete(means: dict[str, float]) -> Column:
    """Input array in which missing entries take the mean of the training rows."""
    return F.zip_with(packed(list(means)), _literal(list(means.values())), lambda x, m: F.coalesce(x, m))


def filled(df: DataFrame, means: dict[str, float]) -> DataFrame:
    """Add the model input vector."""
    return df.withColumn("features", array_to_vector(_complete(means)))


def _fit(name: str, train: DataFrame, columns: Sequence[str], estimator, params: dict) -> Fitted:
    train = train.where(F.col("target").isNotNull())
    means = training_means(train, columns)
    model = Pipeline(stages=[estimator]).fit(filled(train, means).select("target", "features"))
    return Fitted(name, model, list(means), means, params)


def fit_ridge(train: DataFrame, columns: Sequence[str], reg: float = 1.0) -> Fitted:
    """Linear regression with an L2 penalty on standardised inputs; one distributed Gram matrix."""
    est = LinearRegression(labelCol="target", regParam=reg, elasticNetParam=0.0, standardization=True, solver="normal")
    return _fit("ridge", train, columns, est, {"reg": reg})


def fit_gbt(train: DataFrame, columns: Sequence[str], rounds: int = 20, depth: int = 5, seed: int = 7) -> Fitted:
    est = GBTRegressor(labelCol="target", maxIter=rounds, maxDepth=depth, seed=seed, lossType="squared")
    return _fit("gbt", train, columns, est, {"rounds": rounds, "depth": depth})


def fit_forest(train: DataFrame, columns: Sequence[str], trees: int = 30, depth: int = 5, seed: int = 7) -> Fitted:
    est = RandomForestRegressor(labelCol="target", numTrees=trees, maxDepth=depth, seed=seed, leafCol="leaf")
    return _fit("forest", train, columns, est, {"trees": trees, "depth": depth})


def score(fitted: Fitted, feat: DataFrame, name: str = "predicted") -> DataFrame:
    """Prediction for every row; the rows keep their own columns."""
    out = fitted.pipeline.transform(filled(feat, fitted.means))
    return out.select(*feat.columns, F.col("prediction").alias(name))


# ---- quantiles from a forest ----------------------------------------------------------------


@dataclass
class ForestQuantiles:
    """Quantile forest: the target distribution of the training rows in each leaf, in ``bins`` bins."""

    fitted: Fitted
    edges: list[float]
    centres: list[float]
    leaves: str  # path of the (tree, leaf, weights) table


def fit_forest_quantiles(
    train: DataFrame, fitted: Fitted, bins: int = 50, path: str | None = None
) -> ForestQuantiles:
    """Leaf histograms of a fitted forest.

    Size: trees x 2^depth x bins numbers, fixed by the parameters whatever the training rows.
    """
    train = train.where(F.col("target").isNotNull())
    shares = {f"e{i}": i / bins for i in range(1, bins)}
    row = exact_percentiles(train, "target", shares).first()
    edges = sorted({float(row[c]) for c in shares})
    bin_no = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e < F.col("target")))
    binned = fitted.pipeline.transform(filled(train, fitted.means)).select(
        "target", bin_no.alias("bin"), vector_to_array("leaf").alias("leaf")
    )
    found = {r["bin"]: r["c"] for r in binned.groupBy("bin").agg(F.avg("target").alias("c")).collect()}
    nearest = sorted(found)
    centres = [found[min(nearest, key=lambda b, i=i: abs(b - i))] for i in range(len(edges) + 1)]
    places = binned.select("bin", F.posexplode("leaf").alias("tree", "leaf"))
    counts = places.groupBy("tree", F.col("leaf").cast("int").alias("leaf")).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("bin") == i).alias(f"b{i}") for i in range(len(centres))]
    )
    weights = counts.select(
        "tree", "leaf", F.array(*[F.col(f"b{i}") / F.col("n") for i in range(len(centres))]).alias("w")
    )
    path = path or scratch_dir(train.sparkSession, "leaves")
    weights.coalesce(1).write.mode("overwrite").parquet(path)
    return ForestQuantiles(fitted, edges, centres, path)


def predict_quantiles(
    fq: ForestQuantiles, feat: DataFrame, keys: Sequence[str], shares: dict[str, float]
) -> DataFrame:
    """Quantiles per row: leaf weights averaged over the trees, read off cumulatively.

    The leaf table is broadcast; its size is fixed by the forest's parameters (see above).
    """
    spark = feat.sparkSession
    hist = F.broadcast(spark.read.parquet(fq.leaves))
    leaves = fq.fitted.pipeline.transform(filled(feat, fq.fitted.means)).select(
        *keys, F.posexplode(vector_to_array("leaf")).alias("tree", "_leaf")
    )
    n = len(fq.centres)
    summed = (
        leaves.withColumn("leaf", F.col("_leaf").cast("int"))
        .join(hist, ["tree", "leaf"])
        .groupBy(*keys)
        .agg(F.array(*[F.avg(F.col("w")[i]) for i in range(n)]).alias("_w"))
    )
    values = F.array(*[F.lit(float(c)) for c in fq.centres])

    def at(q: float) -> Column:
        start = F.struct(F.lit(0.0).alias("cum"), F.lit(0).alias("i"))

        def step(s: Column, x: Column) -> Column:
            cum = s["cum"] + x
            return F.struct(cum.alias("cum"), (s["i"] + F.when(cum < q - 1e-9, 1).otherwise(0)).alias("i"))

        return F.get(values, F.least(F.aggregate("_w", start, step)["i"], F.lit(n - 1)))

    return summed.select(*keys, *[at(q).alias(name) for name, q in shares.items()])


def conformal(val: DataFrame, test: DataFrame, level: float = 0.8, pred: str = "predicted", actual: str = "actual") -> DataFrame:
    """Split-conformal band: the prediction plus or minus the validation residual at ``level``."""
    width = exact_percentile(val.select(F.abs(F.col(pred) - F.col(actual)).alias("r")), "r", level)
    out = test.withColumn("_w", width.scalar())
    return out.withColumns({"p10": F.col(pred) - F.col("_w"), "p90": F.col(pred) + F.col("_w")}).drop("_w")


# ---- drivers --------------------------------------------------------------------------------


def linear_contributions(
    df: DataFrame, keys: Sequence[str], weights: dict[str, float], means: dict[str, float],
    groups: dict[str, list[str]] | None = None,
) -> DataFrame:
    """weight x (value - mean) per feature: the exact Shapley value of a linear model. Long form.

    With ``groups`` the values of a group's features are added up; without, each feature stands alone.
    """
    names = list(weights)
    used = {c: means[c] for c in names}
    off = F.zip_with(_complete(used), _literal(list(used.values())), lambda x, m: x - m)
    parts = F.zip_with(off, _literal([float(weights[c]) for c in names]), lambda d, w: w * d)
    long = df.select(*keys, F.posexplode(parts).alias("_i", "contribution"))
    if groups is None:
        return long.select(*keys, F.get(_literal(names), F.col("_i")).alias("feature"), "contribution")
    owner = {c: g for g, cols in groups.items() for c in cols}
    feature = F.get(_literal([owner[c] for c in names]), F.col("_i")).alias("feature")
    return long.groupBy(*keys, feature).agg(F.sum("contribution").alias("contribution"))


def ridge_weights(fitted: Fitted) -> dict[str, float]:
    return dict(zip(fitted.columns, [float(v) for v in fitted.model.coefficients]))


def group_contributions(
    fitted: Fitted, feat: DataFrame, keys: Sequence[str], groups: dict[str, list[str]], permutations: int = 10, seed: int = 7
) -> DataFrame:
    """Sampled Shapley values of feature groups for any model.

    Each row is scored along ``permutations`` orders of the groups, switching one group after another
    from the training mean to the row's value; a group's share is the mean change at its switch. Every
    second order is the one before it reversed, which is exact where groups interact by twos; an odd
    number leaves the last order without its reverse. The copies per row are permutations x (groups + 1),
    fixed by the configuration.
    """
    import random

    rng = random.Random(seed)
    names = sorted(groups)
    steps, orders = [], []
    order = names[:]
    for p in range(permutations):
        if p % 2:
            order.reverse()
        else:
            rng.shuffle(order)
        orders.append({g: i + 1 for i, g in enumerate(order)})
        steps += [(p, s) for s in range(len(names) + 1)]
    place = [[pos[g] for g in names] for pos in orders]
    grid = F.array(
        *[F.struct(F.lit(p).alias("p"), F.lit(s).alias("s"), _literal(place[p]).alias("pos")) for p, s in steps]
    )
    group_of = {c: names.index(g) for g, cols in groups.items() for c in cols}
    # columns outside all groups always show the row's value
    owner = _literal([group_of.get(c, -1) for c in fitted.columns])
    rows = feat.select(*keys, _complete(fitted.means).alias("_x"), F.explode(grid).alias("_g"))
    tagged = F.zip_with("_x", owner, lambda x, g: F.struct(x.alias("x"), g.alias("g")))

    def shown(entry: Column, mean: Column) -> Column:
        here = (entry["g"] < 0) | (F.get(F.col("_g.pos"), entry["g"]) <= F.col("_g.s"))
        return F.when(here, entry["x"]).otherwise(mean)

    mixed = F.zip_with(tagged, _literal(list(fitted.means.values())), shown)
    inputs = rows.select(*keys, "_g", array_to_vector(mixed).alias("features"))
    scored = fitted.pipeline.transform(inputs).select(*keys, "_g", "prediction")

    def share(g: str) -> Column:
        sign = F.lit(0)
        for p, pos in enumerate(orders):
            here = F.col("_g.p") == p
            sign = F.when(here & (F.col("_g.s") == pos[g]), 1).when(here & (F.col("_g.s") == pos[g] - 1), -1).otherwise(sign)
        return F.sum(F.col("prediction") * sign) / permutations

    wide = scored.groupBy(*keys).agg(*[share(g).alias(f"g{i}") for i, g in enumerate(names)])
    parts = F.array(
        *[F.struct(F.lit(g).alias("feature"), F.col(f"g{i}").alias("contribution")) for i, g in enumerate(names)]
    )
    return wide.select(*keys, F.explode(parts).alias("p")).select(*keys, "p.feature", "p.contribution")


# ---- validation -----------------------------------------------------------------------------

Fit = Callable[[DataFrame, Sequence[str]], Fitted]


def walk_forward_cv(
    folded: DataFrame, columns: Sequence[str], candidates: dict[str, Fit], folds: Sequence[int]
) -> DataFrame:
    """MAE of each candidate over expanding-window folds (frames from ``assign_folds``)."""
    scored = None
    for (name, fit), fold in itertools.product(candidates.items(), folds):
        part = folded.where(F.col("fold") == fold)
        fitted = fit(part.where(F.col("role") == "train"), columns)
        val = part.where(F.col("role") == "val").where(F.col("target").isNotNull())
        out = score(fitted, val).select(
            F.lit(name).alias("model"), F.lit(fold).alias("fold"), F.abs(F.col("predicted") - F.col("target")).alias("e")
        )
        scored = out if scored is None else scored.unionByName(out)
    return scored.groupBy("model").agg(
        F.avg("e").alias("cv_mae"), F.count(F.lit(1)).alias("n"), F.count_distinct("fold").alias("n_folds")
    )


def best_model(cv: DataFrame) -> str:
    return cv.orderBy("cv_mae", "model").first()["model"]


def random_role(keys: Sequence[str], share: float = 0.8, seed: int = 7) -> Column:
    """Random split by a hash of the row key; for the ablation only."""
    return F.when(hash_unit(*[F.col(k) for k in keys], F.lit(seed)) < share, "train").otherwise("test")


def ablation(
    df: DataFrame, columns: Sequence[str], leaky: Sequence[str], fit: Fit, keys: Sequence[str], seed: int = 7
) -> DataFrame:
    """Four errors: with and without the leaking columns, time split and random split.

    ``df`` carries ``split`` (train/val/test). The random split reuses the train and test rows.
    """
    known = df.where(F.col("target").isNotNull())
    timed = known.withColumn("_role", F.col("split"))
    random = known.where(F.col("split").isin("train", "test")).withColumn("_role", random_role(keys, 0.8, seed))
    out = None
    for iron, cols in (("no", list(columns)), ("yes", list(columns) + list(leaky))):
        for kind, rows in (("time", timed), ("random", random)):
            fitted = fit(rows.where(F.col("_role") == "train"), cols)
            line = score(fitted, rows.where(F.col("_role") == "test")).agg(
                F.avg(F.abs(F.col("predicted") - F.col("target"))).alias("mae"), F.count(F.lit(1)).alias("n")
            )
            line = line.select(F.lit(iron).alias("with_iron"), F.lit(kind).alias("split"), "mae", "n")
            out = line if out is None else out.unionByName(line)
    return out


def horizon_study(df: DataFrame, columns: Sequence[str], fit: Fit, horizons: Sequence[int]) -> DataFrame:
    """One model per horizon; test predictions of all, long form."""
    out = None
    for k in horizons:
        rows = df.where(F.col("horizon_h") == k)
        fitted = fit(rows.where(F.col("split") == "train"), columns)
        part = score(fitted, rows.where(F.col("split") == "test"))
        out = part if out is None else out.unionByName(part)
    return out


# ---- storage --------------------------------------------------------------------------------


def save_model(fitted: Fitted, path: str) -> None:
    spark = _session()
    fitted.pipeline.write().overwrite().save(f"{path}/pipeline")
    rows = [(fitted.name, c, float(fitted.means[c]), i, str(fitted.params)) for i, c in enumerate(fitted.columns)]
    schema = "name string, feature string, mean double, position int, params string"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/inputs")


def load_model(path: str) -> Fitted:
    spark = _session()
    rows = spark.read.parquet(f"{path}/inputs").orderBy("position").collect()
    means = {r["feature"]: r["mean"] for r in rows}
    return Fitted(rows[0]["name"], PipelineModel.load(f"{path}/pipeline"), list(means), means)


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
