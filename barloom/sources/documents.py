"""Prediction documents: one JSON object per scored run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.guards import DataCheckError, require_columns

PREDICTION_ITEM = ("struct<ticker:string,last_close:double,pred_close:double,"
                   "pred_return:double,graph_gate:double>")
DOCUMENT_SCHEMA = (
    "checkpoint string, input_npz string, as_of_date string, device string, "
    "model_dims map<string,int>, num_nodes int, "
    f"predictions array<{PREDICTION_ITEM}>")


def read_prediction_documents(spark: SparkSession, path: str) -> DataFrame:
    """Read documents with a declared schema; the list is checked when exploded."""
    return spark.read.schema(DOCUMENT_SCHEMA).option("multiLine", True).json(path) \
        .withColumn("output_json", F.col("_metadata.file_path"))


def document_rows(documents: DataFrame) -> DataFrame:
    """One row per prediction with its position; empty or missing lists are refused."""
    require_columns(documents, ["predictions"], "prediction document")
    empty = F.coalesce(F.size("predictions"), F.lit(0)) <= 0
    if documents.isEmpty() or not documents.filter(empty).isEmpty():
        raise DataCheckError("prediction document has no prediction rows")
    head = [c for c in documents.columns if c not in ("predictions", "model_dims")]
    return documents.select(*head, F.posexplode("predictions").alias("position", "item")) \
        .select(*head, "position", "item.*") \
        .withColumn("as_of_date", F.col("as_of_date").try_cast("date"))
