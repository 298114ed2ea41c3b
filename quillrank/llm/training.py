"""What the trained text classifiers share: a bounded labelled sample, and Adam."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrank.llm.shared import bounded_share


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    rows: int,
    max_chars: int,
    key: str = "doc_id",
    text: str = "text",
) -> pd.DataFrame:
    """About ``rows`` labelled documents ``(text, label)`` at most, on the driver, picked by hash of the
    key from the labelled rows; texts of more than ``max_chars`` characters are left out of
    training, so the sample is at most ``rows * max_chars`` large. Rows come in a fixed order."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("id"), F.col(label).cast("double").alias("label")
    )
    size = known.count()
    picked = known.where(bounded_share(F.col("id"), F.lit(min(1.0, rows / max(1, size)))))
    texts = docs.where(F.length(text) <= max_chars).select(
        F.col(key).alias("id"), F.col(text).alias("text")
    )
    found = texts.join(F.broadcast(picked), "id").toPandas()
    return found.sort_values(["id", "text"]).reset_index(drop=True)[["text", "label"]]


class Adam:
    """Adam on a dictionary of float32 arrays, updated in place."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float, decay: float = 0.0):
        self.weights, self.rate, self.decay, self.turn = weights, rate, decay, 0
        self.mean = {name: np.zeros_like(w) for name, w in weights.items()}
        self.square = {name: np.zeros_like(w) for name, w in weights.items()}

    def step(self, gradients: dict[str, np.ndarray]) -> None:
        self.turn += 1
        for name, gradient in gradients.items():
            weight, mean, square = self.weights[name], self.mean[name], self.square[name]
            gradient = gradient + self.decay * weight
            mean += 0.1 * (gradient - mean)
            square += 0.001 * (gradient * gradient - square)
            fixed_mean = mean / (1 - 0.9**self.turn)
            fixed_square = square / (1 - 0.999**self.turn)
            weight -= (self.rate * fixed_mean / (np.sqrt(fixed_square) + 1e-8)).astype(weight.dtype)


def sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5
