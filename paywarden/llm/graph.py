"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paywarden.llm.common import stash


def components(links: DataFrame) -> DataFrame:
    """Columns id and comp, the smallest id that links (a, b) lead to; only ids that have links.

    Each round takes the smallest label of the neighbours, then the label's own label,
    which halves what is left of long chains. A round is written to the shared folder,
    so a lost executor costs one round. Only the number of changes reaches the driver.
    """
    both = stash(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("comp"))
    labels = stash(labels, "labels")
    while True:
        near = both.join(labels, both["b"] == labels["id"]).groupBy(F.col("a").alias("id")).agg(
            F.min("comp").alias("near"))
        less = labels.join(near, "id").select("id", "comp", F.least("comp", "near").alias("least"))
        over = labels.select(F.col("id").alias("least"), F.col("comp").alias("over"))
        step = stash(less.join(over, "least", "left").select(
            "id", "comp", F.coalesce(F.least("least", "over"), "least").alias("next")), "labels")
        changed = step.filter("next <> comp").limit(1).count()
        labels = step.select("id", F.col("next").alias("comp"))
        if not changed:
            return labels
