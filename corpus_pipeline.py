"""The corpus pipeline: named stages over documents, each written as Parquet and reread.

Cases: null and repeated ids are judged row by row (of exact copies one row stays, under whichever id); null
and empty texts pass the first four stages (of empty ones, a row for each id stays) and are packed as their
end id alone; very long texts are read whole; an empty table gives an empty result; extra columns are kept up to
the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ticketloom.llm.decontamination import drop_contaminated
from ticketloom.llm.near_dedup import keep_one_of_each
from ticketloom.llm.packing import pack_stage
from ticketloom.llm.secrets import redact_secrets
from ticketloom.llm.toxicity import drop_toxic
from ticketloom.session import release, table, written

#: Each takes (spark, docs, sf_dir); all but the last return the columns of documents.
STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack_stage),
]

#: No SQL expresses sketching, learning or tokenizing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        release(before)  # a table of the stage before; the input itself stays
    return docs
