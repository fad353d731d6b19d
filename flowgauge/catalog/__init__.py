"""Registered queries: a Spark callable and, where SQL can say it, the same query as SQL."""


def registered() -> dict:
    """name -> (callable(spark, folder), SQL text or None)."""
    from . import (
        alert_queries, evaluation_queries, flow_queries, model_queries, response_queries, source_queries, stream_queries,
        table_queries,
    )

    found = {}
    for part in (flow_queries, source_queries, table_queries, alert_queries, response_queries, evaluation_queries,
                 stream_queries, model_queries):
        found.update(part.QUERIES)
    return found
