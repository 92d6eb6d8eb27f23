"""Texts to vectors: tokens, Word2Vec, arrays of floats."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import Tokenizer, Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame


def embed(df: DataFrame, text: str = "text", out: str = "vector", dim: int = 32, seed: int = 1) -> DataFrame:
    """``df`` with a vector for each text, learnt from the texts themselves. Null texts are left out of the learning
    and have no vector."""
    known = df.where(df[text].isNotNull())
    model = Pipeline(stages=[Tokenizer(inputCol=text, outputCol="_words"), Word2Vec(inputCol="_words", outputCol="_vector", vectorSize=dim, minCount=0, seed=seed)]).fit(known)
    made = model.transform(known).withColumn(out, vector_to_array("_vector", "float32")).drop("_words", "_vector")
    return made.unionByName(df.where(df[text].isNull()), allowMissingColumns=True)
