"""Classifiers by name, each giving ``probability`` (array<double>) and ``prediction``."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    LinearSVC, LogisticRegression, MultilayerPerceptronClassifier, NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import MaxAbsScaler, MinMaxScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkprint.config import FeatureConfig
from inkprint.constants import SEED
from inkprint.functions import probs as pr
from inkprint.operators import evaluate as ev
from inkprint.operators.boosting import Booster, BoostParams, Spec, Table, boosted_probability
from inkprint.operators.features import input_columns, select_features
from inkprint.operators.forest import forest_probability, importances
from inkprint.operators.neighbors import knn_join, knn_votes
from inkprint.operators.network import STEP, TRAIN, VALIDATE, Loss, Network, fit_network, network_probability
from inkprint.operators.randomforest import ForestParams, write_forest
from inkprint.operators.randomtrees import RandomTrees, TreeParams, trees_probability, write_random_trees
from inkprint.operators.sampling import assign_folds, split
from inkprint.session import materialize, path_exists

_ASSEMBLED = "features"
TREE_ALIASES = {"numTrees": "n_estimators", "maxDepth": "max_depth"}  # the customary names in Spark's trees
FOREST_ALIASES = {**TREE_ALIASES, "maxBins": "bins", "minInstancesPerNode": "min_rows", "seed": "seed"}
DRIVER_ROWS = 1 << 20  # rows x trees up to which a random forest, which has up to two nodes for each, is MLlib's and held by the driver


class EachClass:
    """One binary fit per class, all over the same rows.

    The fitted models are plain transformers with columns of their own, so prediction is a
    chain inside the JVM and the whole is saved like any pipeline.
    """

    def __init__(self, make: Callable, classes: Iterable[int], label: str, output: str, threads: int = 4):
        self.make, self.classes, self.label = make, list(classes), label
        self.output, self.threads = output, threads

    def names(self) -> list[str]:
        return [f"{self.output}_{c}" for c in self.classes]

    def fit(self, df: DataFrame) -> list:
        rows = df.select(_ASSEMBLED, self.label).persist()

        def one(c: int):
            binary = rows.withColumn("_is", (F.col(self.label) == c).cast("double"))
            learner = self.make(c)
            return learner.setLabelCol("_is").fit(binary)

        try:
            with ThreadPoolExecutor(self.threads) as pool:
                return list(pool.map(one, self.classes))
        finally:
            rows.unpersist()


def _forest(label: str, **params):
    """Rows keep the node they are in for each tree: deep trees are not walked again in every pass."""
    params = {"numTrees": 100, "maxDepth": 30, "featureSubsetStrategy": "sqrt", "seed": SEED, "cacheNodeIds": True, **params}
    return [RandomForestClassifier(featuresCol=_ASSEMBLED, labelCol=label, **params)]


def _svc(n_classes: int, label: str, **params):
    """Linear margins, one class against the rest, then a logistic fit of the margins."""
    params = {"tol": 1e-3, **params}
    make = lambda c: LinearSVC(
        featuresCol=_ASSEMBLED, predictionCol=f"_side_{c}", rawPredictionCol=f"margin_{c}", **params)
    margins = EachClass(make, range(n_classes) if n_classes > 2 else [1], label, "margin")
    return [margins, VectorAssembler(inputCols=margins.names(), outputCol="margins"),
            LogisticRegression(featuresCol="margins", labelCol=label)]


def _network(n_features: int, n_classes: int, label: str, **params):
    params = {"maxIter": 200, "tol": 1e-4, "seed": SEED, "layers": [n_features, 100, n_classes], **params}
    return [MultilayerPerceptronClassifier(featuresCol=_ASSEMBLED, labelCol=label, **params)]


# name -> factory(n_features, n_classes, label, **params) of the pipeline stages
CLASSIFIERS: dict[str, Callable] = {
    "random_forest": lambda d, k, y, **p: _forest(y, **p),  # larger ones: operators/randomforest.py
    "naive_bayes": lambda d, k, y, **p: [NaiveBayes(modelType="gaussian", featuresCol=_ASSEMBLED, labelCol=y, **p)],
    "svc": lambda d, k, y, **p: _svc(k, y, **p),
    "neural_network": lambda d, k, y, **p: _network(d, k, y, **p),
}
NEIGHBORS = "kneighbors"
BOOSTING = "gradient_boosting"
RANDOM_TREES = "extra_trees"
FOREST, MLLIB_FOREST = "random_forest", CLASSIFIERS["random_forest"]


def register_classifier(name: str, factory: Callable) -> None:
    CLASSIFIERS[name] = factory


def check_classifier(name: str) -> None:
    if name not in (NEIGHBORS, BOOSTING, RANDOM_TREES) and name not in CLASSIFIERS:
        raise ValueError(f"unknown classifier: {name}")


class Fitted:
    """A fitted pipeline and its class count."""

    def __init__(self, model: PipelineModel, n_classes: int, inputs: list[str] | None = None):
        self.model, self.n_classes, self.inputs = model, n_classes, inputs or []

    def predict(self, df: DataFrame) -> DataFrame:
        scored = self.model.transform(df).select(*df.columns, vector_to_array("probability").alias("probability"))
        return scored.withColumn("prediction", pr.argmax("probability").cast("int"))

    def save(self, path: str, overwrite: bool = False) -> None:
        spark = SparkSession.getActiveSession()
        if path_exists(spark, path) and not overwrite:
            raise ValueError(f"model {path} already exists; allow retraining to overwrite it")
        writer = self.model.write()
        (writer.overwrite() if overwrite else writer).save(f"{path}/pipeline")
        meta = json.dumps({"n_classes": self.n_classes, "inputs": self.inputs})
        spark.createDataFrame([(meta,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Fitted | FittedTrees | FittedForest:
        for kind, part in ((FittedTrees, "trees"), (FittedForest, "forest")):
            if path_exists(spark, f"{path}/{part}"):
                return kind.load(spark, path)
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        return cls(PipelineModel.load(f"{path}/pipeline"), meta["n_classes"], meta["inputs"])


class FittedNeighbors:
    """The k-nearest-neighbour classifier: its model is the written base table."""

    def __init__(self, prepare: PipelineModel, base: DataFrame, n_classes: int, k: int = 5,
                 inputs: list[str] | None = None):
        self.prepare, self.base, self.n_classes, self.k, self.inputs = prepare, base, n_classes, k, inputs or []

    def predict(self, df: DataFrame) -> DataFrame:
        queries = self.prepare.transform(df).select(F.col("message_id").alias("id"),
                                                    vector_to_array(_ASSEMBLED).alias("vector"))
        votes = knn_votes(knn_join(queries, self.base, self.k), self.base, self.k)
        share = F.array(*[F.coalesce(F.max(F.when(F.col("label") == c, F.col("probability"))), F.lit(0.0))
                          for c in range(self.n_classes)])
        table = votes.groupBy(F.col("query_id").alias("message_id")).agg(share.alias("probability"))
        return df.join(table, "message_id").withColumn("prediction", pr.argmax("probability").cast("int"))


    def save(self, path: str, overwrite: bool = False) -> None:
        spark = SparkSession.getActiveSession()
        if path_exists(spark, path) and not overwrite:
            raise ValueError(f"model {path} already exists; allow retraining to overwrite it")
        writer = self.prepare.write()
        (writer.overwrite() if overwrite else writer).save(f"{path}/prepare")
        self.base.write.mode("overwrite").parquet(f"{path}/base")
        meta = json.dumps({"n_classes": self.n_classes, "inputs": self.inputs, "k": self.k})
        spark.createDataFrame([(meta,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedNeighbors:
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        return cls(PipelineModel.load(f"{path}/prepare"), spark.read.parquet(f"{path}/base"), meta["n_classes"], meta["k"],
                   meta["inputs"])


class FittedTrees:
    """Boosted or random trees behind the scaler they were fitted with."""

    def __init__(self, prepare: PipelineModel, trees: Booster | RandomTrees, n_classes: int, inputs: list[str] | None = None):
        self.prepare, self.trees, self.n_classes, self.inputs = prepare, trees, n_classes, inputs or []

    def predict(self, df: DataFrame) -> DataFrame:
        probability = boosted_probability if isinstance(self.trees, Booster) else trees_probability
        ready = self.prepare.transform(df).withColumn("probability", probability(self.trees, vector_to_array(_ASSEMBLED)))
        return ready.select(*df.columns, "probability").withColumn("prediction", pr.argmax("probability").cast("int"))

    def importances(self) -> list[tuple[int, float]]:
        """(input, share of all gains), of the inputs that split any node."""
        gains = self.trees.gain if isinstance(self.trees, Booster) else self.trees.fall
        total = sum(gains.values())
        return [(k, v / total) for k, v in sorted(gains.items()) if total]

    def save(self, path: str, overwrite: bool = False) -> None:
        spark = SparkSession.getActiveSession()
        if path_exists(spark, path) and not overwrite:
            raise ValueError(f"model {path} already exists; allow retraining to overwrite it")
        writer = self.prepare.write()
        (writer.overwrite() if overwrite else writer).save(f"{path}/prepare")
        meta = json.dumps({"n_classes": self.n_classes, "inputs": self.inputs, "boosted": isinstance(self.trees, Booster)})
        for part, text in (("trees", self.trees.to_json()), ("meta", meta)):
            spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{part}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedTrees:
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        trees = (Booster if meta["boosted"] else RandomTrees).from_json(spark.read.text(f"{path}/trees").first()[0])
        return cls(PipelineModel.load(f"{path}/prepare"), trees, meta["n_classes"], meta["inputs"])


class FittedForest:
    """A forest whose trees are a table, behind the scaler it was fitted with. ``nan``: what NaN counts as."""

    def __init__(self, prepare: PipelineModel, parts: DataFrame, n_trees: int, n_classes: int, inputs: list[str] | None = None,
                 nan: float | None = None, each: bool = False):
        self.prepare, self.parts, self.n_trees, self.n_classes, self.inputs = prepare, parts, n_trees, n_classes, inputs or []
        self.nan, self.each = nan, each

    def predict(self, df: DataFrame) -> DataFrame:
        ready = self.prepare.transform(df).select(*df.columns, vector_to_array(_ASSEMBLED).alias("_vector"))
        rows = materialize(ready.withColumn("_row", F.monotonically_increasing_id()), "forest-rows")
        found = forest_probability(self.parts, self.n_trees, rows.select(F.col("_row").alias("id"), F.col("_vector").alias("x")), self.n_classes, self.nan)
        scored = rows.join(found.withColumnRenamed("id", "_row"), "_row").select(*df.columns, "probability")
        return scored.withColumn("prediction", pr.argmax("probability").cast("int"))

    def importances(self) -> list[tuple[int, float]]:
        """(input, share of all falls of the impurity), of the inputs that split any node; ``each``: every tree counts the same."""
        return importances(self.parts, self.each)

    def save(self, path: str, overwrite: bool = False) -> None:
        spark = SparkSession.getActiveSession()
        if path_exists(spark, path) and not overwrite:
            raise ValueError(f"model {path} already exists; allow retraining to overwrite it")
        writer = self.prepare.write()
        (writer.overwrite() if overwrite else writer).save(f"{path}/prepare")
        self.parts.write.mode("overwrite").parquet(f"{path}/forest")
        meta = json.dumps({k: getattr(self, k) for k in ("n_trees", "n_classes", "inputs", "nan", "each")})
        spark.createDataFrame([(meta,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedForest:
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        return cls(PipelineModel.load(f"{path}/prepare"), spark.read.parquet(f"{path}/forest"), **meta)


def load_model(spark: SparkSession, path: str) -> Fitted | FittedNeighbors | FittedTrees | FittedForest:
    """A saved classifier of any kind."""
    kind = FittedNeighbors if path_exists(spark, f"{path}/base") else Fitted
    return kind.load(spark, path)


def count_classes(df: DataFrame, label: str = "user") -> int:
    return int(df.agg(F.max(label)).first()[0]) + 1


def assembler(df: DataFrame, inputs: list[str], scale: bool = True) -> list:
    """Stages that make one vector: plain columns scaled to [0, 1], the sparse bag by its largest entry."""
    types = dict(df.dtypes)
    vectors = [c for c in inputs if types[c] == "vector"]
    plain = [c for c in inputs if c not in vectors]
    stages, parts = [], []
    if plain:
        stages.append(VectorAssembler(inputCols=plain, outputCol="_plain", handleInvalid="keep"))
        if scale:
            stages.append(MinMaxScaler(inputCol="_plain", outputCol="_plain01"))
        parts.append("_plain01" if scale else "_plain")
    for c in vectors:
        if scale:
            stages.append(MaxAbsScaler(inputCol=c, outputCol=f"_{c}1"))
        parts.append(f"_{c}1" if scale else c)
    stages.append(VectorAssembler(inputCols=parts, outputCol=_ASSEMBLED))
    return stages


def _count_trees(parts: DataFrame) -> int:
    return parts.filter("part = 0").count()


def _width(model: PipelineModel, df: DataFrame) -> int:
    return model.transform(df.limit(1)).select(vector_to_array(_ASSEMBLED).alias("v")).select(
        F.size("v")).first()[0]


def boosting_table(prepare: PipelineModel, df: DataFrame, label: str, n_classes: int, fold: str | None = None) -> Table:
    """The binned inputs of boosted trees."""
    ready = prepare.transform(df).withColumn("_vector", vector_to_array(_ASSEMBLED))
    return Table(ready, "_vector", label, "message_id" if "message_id" in df.columns else "_vector", n_classes, fold)


def fit_classifier(df: DataFrame, name: str = "random_forest", label: str = "user",
                   inputs: list[str] | None = None, scale: bool = True, n_classes: int | None = None, **params):
    """Fit scaler and classifier together, on the given rows only."""
    check_classifier(name)
    inputs = inputs or input_columns(df, (label, "message_id", "fold", "split"))
    n_classes = n_classes or count_classes(df, label)
    prepare = Pipeline(stages=assembler(df, inputs, scale)).fit(df)
    if name == NEIGHBORS:
        base = prepare.transform(df).select(
            F.col("message_id").alias("id"), vector_to_array(_ASSEMBLED).alias("vector"), F.col(label).alias("label"))
        return FittedNeighbors(prepare, materialize(base, "neighbors"), n_classes, params.get("k", 5), inputs)
    if name == BOOSTING:
        boosters, _ = boosting_table(prepare, df, label, n_classes).fit([Spec(BoostParams.of(**params))])[0]
        return FittedTrees(prepare, boosters[0], n_classes, inputs)
    if name == RANDOM_TREES:
        ready = prepare.transform(df).select(vector_to_array(_ASSEMBLED).alias("vector"), F.col(label).alias("label"))
        trees = write_random_trees(ready, n_classes, TreeParams(**{TREE_ALIASES.get(k, k): v for k, v in params.items()}))
        return FittedForest(prepare, trees, _count_trees(trees), n_classes, inputs, nan=0.0)
    if name == FOREST and CLASSIFIERS[name] is MLLIB_FOREST and not set(params) - {*FOREST_ALIASES, "cacheNodeIds"} and \
            df.count() * params.get("numTrees", ForestParams.n_estimators) > DRIVER_ROWS:
        key = "message_id" if "message_id" in df.columns else None
        ready = prepare.transform(df).select(vector_to_array(_ASSEMBLED).alias("vector"), F.col(label).alias("label"), *([key] if key else []))
        named = {"seed": SEED, **{FOREST_ALIASES[k]: v for k, v in params.items() if k in FOREST_ALIASES}}
        trees = write_forest(ready, n_classes, ForestParams(**named), key=key)
        return FittedForest(prepare, trees, _count_trees(trees), n_classes, inputs, each=True)
    width = _width(prepare, df) if name == "neural_network" else 0
    stages = CLASSIFIERS[name](width, n_classes, label, **params)
    ready = prepare.transform(df.withColumn(label, F.col(label).cast("double")))
    fitted = list(prepare.stages)
    for i, stage in enumerate(stages):
        models = stage.fit(ready) if isinstance(stage, EachClass) else \
            [stage.fit(ready) if hasattr(stage, "fit") else stage]
        fitted += models
        if i + 1 < len(stages):
            ready = PipelineModel(models).transform(ready)
    return Fitted(PipelineModel(fitted), n_classes, inputs)


def cross_validate(df: DataFrame, name: str = "random_forest", k: int = 5, label: str = "user",
                   seed: int = SEED, threads: int = 4, **params) -> DataFrame:
    """fold, metric, value. Folds are fitted side by side; each is a distributed job of its own."""
    folded = materialize(assign_folds(df, k, seed=seed), "folds")
    return validate_folds(folded, name, k, label, count_classes(df, label), threads, **params)


def validate_folds(folded: DataFrame, name: str, k: int, label: str, n_classes: int, threads: int = 4, **params) -> DataFrame:
    """``cross_validate`` of rows that have their ``fold``. Boosted trees of all folds grow together, over one table of bins."""
    together = {}
    if name == BOOSTING:
        inputs = input_columns(folded, (label, "message_id", "fold", "split"))
        prepare = Pipeline(stages=assembler(folded, inputs)).fit(folded)
        boosters, _ = boosting_table(prepare, folded, label, n_classes, "fold").fit([Spec(BoostParams.of(**params), list(range(k)))])[0]
        together = {f: FittedTrees(prepare, b, n_classes, inputs) for f, b in enumerate(boosters)}

    def one(fold: int) -> DataFrame:
        model = together.get(fold) or fit_classifier(folded.filter(F.col("fold") != fold).drop("fold"), name, label,
                                                     n_classes=n_classes, **params)
        scored = model.predict(folded.filter(F.col("fold") == fold).drop("fold"))
        return ev.fold_scores(scored, label).withColumn("fold", F.lit(fold))

    with ThreadPoolExecutor(threads) as pool:
        tables = list(pool.map(one, range(k)))
    return reduce(DataFrame.unionByName, tables).select("fold", "metric", "value")


def feature_importance(model, inputs: Iterable[str] | None = None, n: int = 20) -> DataFrame | None:
    """rank, feature, importance of the n most predictive inputs; None if the model has none."""
    stage = model.model.stages[-1] if isinstance(model, Fitted) else None
    if isinstance(model, FittedTrees | FittedForest):
        weights = model.importances()
    elif hasattr(stage, "featureImportances"):
        found = stage.featureImportances
        weights = list(zip(found.indices.tolist() if hasattr(found, "indices") else range(len(found)), found.values.tolist()))
    else:
        return None
    spark = SparkSession.getActiveSession()
    names = list(inputs or model.inputs)
    # a sparse bag is one input of many columns; the plain columns come first
    named = [c for c in names if c != "bow"] if "bow" in names else names
    rows = [(named[i] if i < len(named) else f"bow_{i - len(named)}", float(w))
            for i, w in weights]
    table = spark.createDataFrame(rows, "feature string, importance double")
    top = table.orderBy(F.desc("importance"), "feature").limit(n)
    return top.select(F.row_number().over(_importance_order()).cast("long").alias("rank"), "feature", "importance")


def _importance_order():
    from pyspark.sql import Window
    return Window.partitionBy(F.lit(0)).orderBy(F.desc("importance"), "feature")


class Trained:
    """Outcome of a training run."""

    def __init__(self, model, scored: DataFrame, n_classes: int, cv: DataFrame | None = None,
                 history: DataFrame | None = None, label: str = "user"):
        self.model, self.scored, self.n_classes = model, scored, n_classes
        self.cv, self.history, self.label = cv, history, label

    def accuracy(self) -> float:
        return ev.accuracy(self.scored, self.label).first()[0]

    def report(self) -> DataFrame:
        return ev.classification_report(self.scored, self.label)

    def confusion(self) -> DataFrame:
        return ev.confusion_matrix(self.scored, self.label)

    def roc(self) -> DataFrame:
        return ev.roc_curve(ev.binarize(self.scored, self.n_classes, self.label))

    def importance(self, n: int = 20) -> DataFrame | None:
        return feature_importance(self.model, n=n)


def train_feature_model(df: DataFrame, name: str = "random_forest", config: FeatureConfig | None = None,
                        kfold: int = 0, test_size: float = 0.2, seed: int = SEED, label: str = "user",
                        **params) -> Trained:
    """Column selection, optional cross-validation, 80/20 split, fit, scored test part.

    The scaler is fitted on the training part and applied wherever the model is.
    """
    check_classifier(name)
    chosen = select_features(df, config) if config else df
    n_classes = count_classes(chosen, label)
    cv = cross_validate(chosen, name, kfold, label, seed, **params) if kfold > 0 else None
    parts = materialize(split(chosen, test_size, seed=seed), "split")
    train, test = (parts.filter(F.col("split") == s).drop("split") for s in ("train", "test"))
    model = fit_classifier(train, name, label, n_classes=n_classes, **params)
    return Trained(model, materialize(model.predict(test), "scored"), n_classes, cv, label=label)


class EmbeddingModel:
    """Network over embedding arrays."""

    def __init__(self, model: Network, n_classes: int):
        self.model, self.n_classes = model, n_classes

    def predict(self, df: DataFrame) -> DataFrame:
        probability = network_probability(self.model, F.col("embedding").cast("array<double>"))
        return df.withColumn("probability", probability).withColumn("prediction", pr.argmax("probability").cast("int"))

    def save(self, path: str, overwrite: bool = False) -> None:
        spark = SparkSession.getActiveSession()
        if path_exists(spark, path) and not overwrite:
            raise ValueError(f"model {path} already exists; allow retraining to overwrite it")
        for part, text in (("network", self.model.to_json()), ("meta", json.dumps({"n_classes": self.n_classes}))):
            spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{part}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> EmbeddingModel:
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        return cls(Network.from_json(spark.read.text(f"{path}/network").first()[0]), meta["n_classes"])


def train_embedding_model(df: DataFrame, epochs: int = 15, batch: int = 32, rate: float = 0.001, hidden: int = 64,
                          test_size: float = 0.2, val_size: float = 0.2, gamma: float | None = 4.0, alpha: float = 0.5,
                          seed: int = SEED, label: str = "user", balance: bool = True,
                          n_classes: int | None = None) -> Trained:
    """Stratified parts, class-balanced training draw, ``epochs`` of mini-batch steps on the chosen loss (focal, or with
    gamma None cross-entropy weighted by inverse class frequency), best epoch by validation accuracy, scored test part."""
    from inkprint.operators.sampling import balanced_resample, train_val_test
    n_classes = n_classes or count_classes(df, label)
    parts = materialize(train_val_test(df.select("message_id", label, "embedding"), label, test_size, val_size,
                                       seed=seed), "parts")
    pick = lambda name: parts.filter(F.col("split") == name).drop("split")
    train, test = pick("train"), pick("test")
    drawn = materialize(balanced_resample(train, label, seed=seed) if balance else train, "drawn")

    def rows(frame: DataFrame, part: int) -> DataFrame:
        return frame.select(F.col("embedding").cast("array<double>").alias("x"), F.col(label).alias("label"), F.lit(part).alias("part"),
                            F.xxhash64("message_id").alias("draw"))

    weights = ()
    if gamma is None:  # as many numbers as classes
        counts = {r[label]: r["count"] for r in drawn.groupBy(label).count().collect()}
        mean = sum(counts.values()) / max(1, len(counts))
        weights = tuple(mean / counts[c] if c in counts else 0.0 for c in range(n_classes))
    everything = rows(drawn, STEP).union(rows(train, TRAIN)).union(rows(pick("val"), VALIDATE))
    network, log = fit_network(everything, n_classes, Loss(gamma, alpha, weights), epochs, batch, rate, hidden, seed)
    history = df.sparkSession.createDataFrame(
        log, "epoch long, train_loss double, val_loss double, train_accuracy double, val_accuracy double")
    model = EmbeddingModel(network, n_classes)
    return Trained(model, materialize(model.predict(test), "scored"), n_classes, history=history, label=label)


def gaussian_parameters(df: DataFrame, dims: int, vector: str = "embedding", label: str = "user") -> DataFrame:
    """label, i, mu, var, n: mean and population variance of each dimension per class."""
    wide = df.groupBy(label).agg(
        F.count("*").alias("n"),
        *[f(F.get(F.col(vector), F.lit(i)).cast("double")).alias(f"{name}{i}") for i in range(dims)
          for name, f in (("mu", F.avg), ("var", F.var_pop))])
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"mu{i}").alias("mu"), F.col(f"var{i}").alias("var"))
                      for i in range(dims)])
    return wide.select(label, "n", F.inline(pairs))


def gaussian_scores(df: DataFrame, parameters: DataFrame, n_rows: int, vector: str = "embedding",
                    label: str = "user", key: str = "message_id", smoothing: float = 1e-9) -> DataFrame:
    """key, class, score (joint log-likelihood). Parameters are classes x dimensions numbers, held by the driver."""
    table: dict[int, list] = {}
    for r in parameters.collect():
        table.setdefault(r[label], []).append((r["i"], r["mu"], r["var"], r["n"]))
    entries = []
    for c, dims in sorted(table.items()):
        dims.sort()
        mu = F.array(*[F.lit(d[1]) for d in dims])
        var = F.array(*[F.lit(d[2] + smoothing) for d in dims])
        gaps = F.zip_with(F.zip_with(F.col(vector).cast("array<double>"), mu, lambda x, m: (x - m) * (x - m)), var,
                          lambda g, v: -0.5 * (F.ln(v * 6.283185307179586) + g / v))
        prior = F.ln(F.lit(dims[0][3] / n_rows))
        entries.append(F.struct(F.lit(c).alias("class"), F.aggregate(gaps, prior, lambda a, x: a + x).alias("score")))
    return df.select(key, F.inline(F.array(*entries)))


