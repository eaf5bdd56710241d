"""The registered queries of this subpackage, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestream.llm import canonical, neardup, newtext, packing, splitting, survivor, tokens

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p2_found": newtext.p2_found,
    "p3_found": survivor.p3_found,
    "p3_survivors": survivor.p3_survivors,
    "p5_found": canonical.p5_found,
    "p7_found": neardup.p7_found,
    "p7_documents": neardup.p7_documents,
    "p8_ids": tokens.p8_ids,
    "p9_containers": packing.p9_containers,
    "p10_pieces": splitting.p10_pieces,
}

_SQL: dict[str, str] = {
    "p3_found": survivor.P3_FOUND_SQL,
    "p7_found": neardup.P7_FOUND_SQL,
    "p7_documents": neardup.P7_DOCUMENTS_SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
