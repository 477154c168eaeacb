"""Pairs of similar sets, counted block by block (JOI10, AGG9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.operators.tiles import set_pairs


def similar_sets(members: DataFrame, least: float, by: tuple[str, ...], name: str = "mask", element: str = "pid", apart: str | None = None) -> DataFrame:
    """(*by, a, b, na, nb, common): pairs a < b of sets of a group whose overlap, common / (na + nb - common), is `least` or more, of different values of `apart` if it is given.

    members: (*by, name, element[, apart]), each element of a set once. Blocks of sets meet tile by tile: of no element
    are the sets that hold it paired by a shuffle, so that only pairs that reach `least` leave a task, and no candidates are written. `least` is above 0.
    """
    if least <= 0:
        raise ValueError("pairs that share nothing are not looked for")
    own = members.groupBy(*by, F.col(name).alias("id")).agg(F.count("*").alias("n"), F.collect_list(element).alias("elements"), *([F.first(apart).alias("apart")] if apart else []))
    return set_pairs(own, by, least=least, give=("na", "nb", "common"))


def overlap() -> Column:
    return F.col("common") / (F.col("na") + F.col("nb") - F.col("common"))
