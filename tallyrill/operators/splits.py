"""Repeatable splits: the draw is a hash of the key, never the row's place in a file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrill.functions.scalars import hash_unit
from tallyrill.operators.ordered import with_position


def random_split(df: DataFrame, key: str, share: float = 0.7, seed: int = 45) -> DataFrame:
    """'train' for about ``share`` of the rows; no shuffle."""
    return df.withColumn("split", F.when(hash_unit(key, seed) < share, "train").otherwise("test"))


def stratified_split(df: DataFrame, key: str, label: str, share: float = 0.8, seed: int = 500) -> DataFrame:
    """Exactly ceil(share * n) rows of every label go to 'train'."""
    drawn = df.withColumn("__u", hash_unit(key, seed))
    placed = with_position(drawn, [label], ["__u", key], "__pos", "__n")
    split = F.when(F.col("__pos") <= F.ceil(F.col("__n") * F.lit(share)), "train").otherwise("test")
    return placed.withColumn("split", split).drop("__u", "__pos", "__n")


def split_by_presence(df: DataFrame, label: str) -> DataFrame:
    return df.withColumn("split", F.when(F.col(label).isNotNull(), "train").otherwise("test"))


def features_and_label(df: DataFrame, keys: Sequence[str], label: str) -> list[str]:
    """Names of the feature columns: everything but keys and label."""
    return [c for c in df.columns if c not in {*keys, label}]


def shuffled_head(df: DataFrame, key: str, n_train: int, seed: int = 1) -> DataFrame:
    """The first ``n_train`` rows of a hash shuffle are 'train', the rest 'test'."""
    placed = with_position(df.withColumn("__u", hash_unit(key, seed)), [], ["__u", key], "__pos", "__n")
    split = F.when(F.col("__pos") <= n_train, "train").otherwise("test")
    return placed.withColumn("split", split).drop("__u", "__pos", "__n")
