"""All queries of the subpackage."""

from __future__ import annotations

from rawgate.llm import (  # noqa: F401
    chat,
    decontamination,
    extraction,
    jaccard,
    langid,
    lexical,
    licenses,
    mixing,
    quality,
    secrets,
    toxicity,
    warc,
    whitening,
)
from rawgate.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
