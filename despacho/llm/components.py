"""Connected components of links between integer ids, by alternating star contraction.

Each round points every id at the least of its neighbours, first over the larger
ones, then over the smaller; rounds grow with the logarithm of the ids. A round
is written to the shared folder, so lineage stays short and nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from despacho.llm.arrow import written


def _least_neighbour(links: DataFrame) -> DataFrame:
    return links.groupBy("a").agg(F.min("b").alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least_neighbour(both).select(F.col("a").alias("hub"), F.least("a", "least").alias("least"))
    larger = both.filter("b > a").join(least, F.col("a") == F.col("hub"))
    return larger.select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    # ``links`` point from the larger to the smaller id.
    least = _least_neighbour(links).select(F.col("a").alias("hub"), "least")
    moved = links.join(least, F.col("a") == F.col("hub")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionAll(least.select("hub", "least")).filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every id in links (a, b): the least id that it is connected with."""
    pointed = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pointed = written(pointed, "links")
    while True:
        # Done once every id points at one id that itself points nowhere.
        hubs = pointed.select(F.col("b").alias("hub")).distinct()
        open_ = pointed.groupBy("a").count().filter("count > 1").limit(1).count()
        open_ = open_ or pointed.join(hubs, F.col("a") == F.col("hub"), "left_semi").limit(1).count()
        if not open_:
            break
        pointed = written(_small_star(_large_star(pointed)), "links")
    roots = pointed.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return pointed.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
