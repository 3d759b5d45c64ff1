"""Queries over the driver tables, each with an equivalent SQL text."""


def all_queries():
    """(name -> Spark callable, name -> SQL text)."""
    from testbed import q_decisions, q_jobs, q_metrics, q_monitoring, q_offers, q_outcomes, q_sources  # noqa: F401
    from testbed.registry import QUERIES, SQL_TEXTS

    return QUERIES, SQL_TEXTS
