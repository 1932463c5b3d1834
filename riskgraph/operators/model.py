"""Boosted regression trees over the training table."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from riskgraph.functions.columns import numeric_or_zero
from riskgraph.sources.staging import new_path, staged_table

ID_COLUMNS = ("label", "order_id", "apply_time")
# Parameters of the score model.
MODEL_PARAMETERS = dict(maxIter=30, maxDepth=5, maxBins=32, minInstancesPerNode=50,
                        subsamplingRate=0.8)


def feature_columns(df: DataFrame, skip: tuple = ID_COLUMNS) -> list[str]:
    return [c for c in df.columns if c not in skip]


def numeric_features(df: DataFrame, skip: tuple = ID_COLUMNS) -> DataFrame:
    """Double, Long and Int features as double with nulls 0; any other type becomes 0."""
    cols = []
    for f in df.schema.fields:
        if f.name in skip:
            cols.append(F.col(f.name))
        elif isinstance(f.dataType, (DoubleType, LongType, IntegerType)):
            cols.append(numeric_or_zero(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.lit(0.0).alias(f.name))
    return df.select(*cols)


def vectors(df: DataFrame, skip: tuple = ID_COLUMNS) -> DataFrame:
    """The ``skip`` columns and ``features``, one vector of all others in their order.

    One expression for any number of columns; the vector is what a model trains on.
    """
    data = numeric_features(df, skip)
    return data.select(*skip, array_to_vector(F.array(*feature_columns(df, skip)))
                       .alias("features"))


def sparse_vectors(rows: DataFrame, size: int, skip: tuple = ID_COLUMNS) -> DataFrame:
    """The ``skip`` columns and ``features``, sparse vectors of ``indices`` and ``values``.

    A vector is stored as a struct of a kind, a size and two lists; the staged table is read back
    as what it is, so that no row leaves the JVM.
    """
    kind = F.lit(0).cast("tinyint")
    packed = rows.select(*skip, F.struct(
        kind.alias("type"), F.lit(size).alias("size"), F.col("indices"), F.col("values"))
        .alias("features"))
    path = new_path(rows.sparkSession, "vectors")
    packed.write.parquet(path)
    fields = [packed.schema[c] for c in skip]
    return staged_table(rows.sparkSession, path,
                        StructType([*fields, StructField("features", VectorUDT())]))


def train(df: DataFrame, seed: int = 11, skip: tuple = ID_COLUMNS, **overrides) -> PipelineModel:
    """Fit on label 0/1 rows, given as columns or as ``vectors``; ``overrides`` replace single
    model parameters."""
    data = (df if "features" in df.columns else vectors(df, skip)).withColumn(
        "label", F.col("label").cast("double"))
    gbt = GBTRegressor(featuresCol="features", labelCol="label", seed=seed,
                       **{**MODEL_PARAMETERS, **overrides})
    return Pipeline(stages=[gbt]).fit(data)


def score(model: PipelineModel, df: DataFrame, skip: tuple = ID_COLUMNS) -> DataFrame:
    data = (df if "features" in df.columns else vectors(df, skip)).withColumn(
        "label", F.col("label").cast("double"))
    return model.transform(data).select(*skip, F.col("prediction").alias("score"))


def describe_model(model: PipelineModel, names: list[str]) -> dict:
    """Tree dump and feature importances by name; ``names`` are the features in their order."""
    gbt = model.stages[-1]
    weights = gbt.featureImportances
    return {"dump": gbt.toDebugString,
            "importances": {names[i]: float(w) for i, w in zip(weights.indices, weights.values)}}


def tree_nodes(model, folder: str) -> DataFrame:
    """(tree, weight, node, feature, threshold, left, right, value): the boosted trees as rows.

    A fitted ensemble is saved below ``folder`` in the library's own format, whose tables the rows
    come from. A row goes left where its feature is at most the threshold; a leaf has left -1.
    """
    spark = SparkSession.active()
    model.write().overwrite().save(folder)
    node = F.col("nodeData")
    trees = spark.read.parquet(f"{folder}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("node"),
        node["split"]["featureIndex"].alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        node["leftChild"].alias("left"), node["rightChild"].alias("right"),
        node["prediction"].alias("value"))
    weight = F.get(F.array(*map(F.lit, model.treeWeights)), F.col("tree"))
    return trees.select("tree", weight.alias("weight"), *trees.columns[1:])


def score_by_nodes(rows: DataFrame, nodes: DataFrame, trees: int, depth: int,
                   ids: tuple = ("order_id",)) -> DataFrame:
    """``ids`` and ``score`` of sparse ``rows`` (indices, values) by joins on the model's node table.

    A row walks down all trees at once, one join a level. The node table is bounded by the number
    and depth of trees, so it is broadcast; rows are shuffled only as one number for each tree.
    """
    nodes = F.broadcast(nodes)
    held = F.map_from_arrays("indices", "values")
    walk = rows.select(*ids, held.alias("held"),
                       F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"),
                       F.lit(0).alias("node"))
    value = F.coalesce(F.try_element_at("held", F.col("feature")), F.lit(0.0))
    onward = (F.when(F.col("left") < 0, F.col("node"))
              .when(value <= F.col("threshold"), F.col("left")).otherwise(F.col("right")))
    for _ in range(depth):
        walk = walk.join(nodes, ["tree", "node"]).select(*ids, "held", "tree",
                                                         onward.alias("node"))
    return walk.join(nodes, ["tree", "node"]).groupBy(*ids).agg(
        F.sum(F.col("weight") * F.col("value")).alias("score"))
