"""Pass-through writers to systems outside the lake."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

# Connector name and option names of the public graph connector.
GRAPH_CONNECTOR = "org.neo4j.spark.DataSource"


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
    max_connections: int = 8,
) -> None:
    """Append to a relational table with ``max_connections`` writers.

    The rows are dealt out anew, so the work before the write keeps its own width.
    """
    df.repartition(max_connections).write.jdbc(url, table, mode="append", properties=dict(properties or {}))


def write_graph_nodes(
    nodes: DataFrame, url: str, label: str, key: str, options: Mapping[str, str] | None = None
) -> None:
    """Hand node rows to the graph connector, replacing nodes of equal key."""
    (
        nodes.write.format(GRAPH_CONNECTOR)
        .mode("overwrite")
        .option("url", url)
        .option("labels", label)
        .option("node.keys", key)
        .options(**dict(options or {}))
        .save()
    )
