"""Connected components of a link table, as repeated joins over staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promoledger.session import stage
from promoledger.sources.storage import delete_folder


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``src, dst``; the root is the component's least node, itself included.

    Links point from the larger to the smaller end. Each round first lifts every
    link's lower end to that end's own least neighbour, then hangs all lower ends
    of a node below the least of them (large star, small star), until every link
    points at a root. Rounds grow with the logarithm of the longest chain. Tables
    are written between steps: that cuts the lineage, outlives lost executors, and
    lets AQE split the joins of a hub, since both sides come fresh from a shuffle.
    """
    spark = edges.sparkSession
    ordered = edges.where(F.col("src") != F.col("dst")).select(F.greatest("src", "dst").alias("hi"), F.least("src", "dst").alias("lo"))
    links, path = stage(ordered.distinct(), "links")
    while True:
        least, least_path = stage(links.groupBy("hi").agg(F.min("lo").alias("least")), "least")
        above = least.select(F.col("hi").alias("lo"), F.col("least").alias("above"))
        lifted, lifted_path = stage(
            links.join(above, "lo", "left").select("hi", F.coalesce("above", "lo").alias("lo"), F.col("above").isNotNull().alias("moved")).distinct(), "lifted"
        )
        stars = least.count() == links.count() and not lifted.where("moved").limit(1).count()
        if stars:
            for used in (path, lifted_path):
                delete_folder(spark, used)
            roots = least.select(F.col("least").alias("node")).distinct().select("node", F.col("node").alias("root"))
            return least.select(F.col("hi").alias("node"), F.col("least").alias("root")).unionByName(roots)
        best, best_path = stage(lifted.groupBy("hi").agg(F.min("lo").alias("least")), "best")
        hung = lifted.join(best, "hi").where(F.col("lo") != F.col("least")).select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
        new_links, new_path = stage(hung.unionByName(best.select("hi", F.col("least").alias("lo"))).distinct(), "links")
        for used in (path, least_path, lifted_path, best_path):
            delete_folder(spark, used)
        links, path = new_links, new_path
