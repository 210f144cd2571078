"""Connected components of a distributed edge table."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from doorstep.llm.tables import settled

#: Links that a task holds before it passes on its forest.
FOREST_LINKS = 1 << 20


def forest(links: DataFrame) -> DataFrame:
    """Fewer links with the same components: each task keeps a link only if it joins two of its trees.

    A dense group's links shrink to about one per member and task before they are shuffled.
    """

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = parent[up]
                x = parent[x]
            return x

        for batch in batches:
            kept = []
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if (ra := root(a)) != (rb := root(b)):
                    parent[max(ra, rb)] = min(ra, rb)
                    kept.append((a, b))
            if kept:
                a, b = zip(*kept)
                yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
            if len(parent) > FOREST_LINKS:
                parent.clear()

    return links.select("a", "b").mapInArrow(thin, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (a long, b long); label is the least node reachable.

    Alternating large-star and small-star rounds: each points nodes at the least neighbour, and their
    number grows with the logarithm of the longest chain. Every round is written to the shared folder.
    The least neighbour is an aggregate and meets the links in a join, so a hub is split like any key.
    """
    edges = settled(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    state = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        edges = settled(small, "links")
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return stars.union(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
