"""Registered queries over the given tables; importing the modules registers them."""

from forumlens.workload import (  # noqa: F401
    frontier_queries,
    lexicon_queries,
    member_queries,
    record_queries,
    similarity_queries,
    stream_queries,
    tree_queries,
)
from forumlens.workload.registry import ORACLES, QUERIES, runner  # noqa: F401


def oracle_texts() -> dict[str, str]:
    return dict(ORACLES)
