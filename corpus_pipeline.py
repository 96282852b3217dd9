"""The corpus pipeline: documents through five stages, each written as Parquet and read again.

1. toxicity: documents with a score of 0.5 or more go.
2. ngram_jaccard: of each component of near copies the smallest id stays.
3. decontamination: documents that hold a window of a benchmark item go.
4. secrets: found secrets are masked in the text; all documents stay.
5. mixing: documents are repeated to the target weights of their sources and
   dealt out in random order, with the columns `copy` and `shuffle_key`.

Defined cases, in every stage: a null or empty text is kept by stages 1 to 4, and
adds nothing to its source's size in stage 5; a repeated or null id is passed
through with its own row, except that in stage 2 rows of one id go or stay
together, and rows without an id stay only if no row of their group has one
(ties: the smallest id stays); texts of any length are read whole; columns beyond
those of documents are carried along, whatever their names, except `copy` and
`shuffle_key`, which stage 5 makes anew; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rawgate.llm.common import staged, table
from rawgate.llm.decontamination import drop_contaminated
from rawgate.llm.jaccard import keep_one
from rawgate.llm.mixing import mix_stage
from rawgate.llm.secrets import mask_secrets
from rawgate.llm.toxicity import drop_toxic

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", keep_one),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("mixing", mix_stage),
]

#: The first stage learns its weights from labels, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each reads what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
