"""Models trained on indicator candles."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewright.operators.series import series_window, spread

FEATURES = [
    "rsi_14", "macd", "macd_signal", "macd_hist", "ma7", "ma25",
    "bb_upper", "bb_lower", "atr_14", "volume_ratio", "price_change_pct",
]


def labelled(indicator_candles: DataFrame) -> DataFrame:
    """Candles with ``label`` 1 when the next close is higher; last rows and null features dropped.

    Looked at from the next candle: each row after the first carries its predecessor's features, so
    blocks only need to look back.
    """
    row = F.struct(*[c for c in indicator_candles.columns])
    after = spread(indicator_candles, 1).withColumn("_prev", F.lag(row).over(series_window()))
    pairs = after.filter(~F.col("_halo") & F.col("_prev").isNotNull()).select(
        "_prev.*", (F.col("close") > F.col("_prev.close")).cast("double").alias("label")
    )
    return pairs.dropna(subset=FEATURES)


def train_forest(training: DataFrame, trees: int = 20, depth: int = 5, seed: int = 42) -> PipelineModel:
    return Pipeline(stages=[
        VectorAssembler(inputCols=FEATURES, outputCol="features"),
        RandomForestClassifier(labelCol="label", numTrees=trees, maxDepth=depth, seed=seed),
    ]).fit(training)


def train_clusters(candles: DataFrame, k: int = 4, seed: int = 42) -> PipelineModel:
    return Pipeline(stages=[
        VectorAssembler(inputCols=FEATURES, outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="features", withMean=True),
        KMeans(k=k, seed=seed),
    ]).fit(candles.dropna(subset=FEATURES))
