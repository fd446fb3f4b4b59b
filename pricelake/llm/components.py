"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import discard, stage


def components(links: DataFrame) -> DataFrame:
    """node and root for every node of ``links`` (a, b); root is the same within a component.

    Each round sends every node to the least of itself and its neighbours and keeps the
    links between what remains. Nodes that aren't least around them vanish, so rounds are
    few; a round's tables are written out, so the plan stays short.
    """
    links = stage(links.select("a", "b").filter("a <> b").distinct(), "cc-links")
    mapping: DataFrame | None = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = stage(both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("root")), "cc-step")
        to = lambda side: step.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root"))
        before, links = links, stage(
            links.join(to("a"), "a")
            .join(to("b"), "b")
            .select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b"))
            .filter("a <> b")
            .distinct(),
            "cc-links",
        )
        discard(before)
        if mapping is None:
            mapping = step
        else:
            later = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
            mapping = mapping.join(later, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
            mapping = stage(mapping, "cc-map")
    if mapping is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return mapping
