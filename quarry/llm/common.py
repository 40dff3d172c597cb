"""Helpers shared by the training-data operators: scratch tables, stable row keys, source columns."""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

#: White space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
FILE, POS = "__src_file", "__src_pos"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` as Parquet into shared storage and read it back: computed once, lineage cut, and readable
    after any executor is lost."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _is_file_scan(df: DataFrame) -> bool:
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    return plan.nodeName() in ("LogicalRelation", "Relation")


def with_row_key(df: DataFrame) -> DataFrame:
    """Adds ``__src_file`` and ``__src_pos``, the physical place of each row.  The place doesn't depend on how a scan is
    split, so two scans agree, and rows that repeat stay apart.  A frame that isn't a plain file scan is written out
    first; columns of these names are replaced."""
    df = df.drop(FILE, POS)
    if not _is_file_scan(df):
        df = materialize(df, "rows")
    meta = df.metadataColumn("_metadata")
    return df.select("*", meta["file_path"].alias(FILE), meta["row_index"].alias(POS))


def with_plain_names(docs: DataFrame, *names: str) -> tuple:
    """``docs`` with columns c0, c1, ... and the new names of ``names``, so that no column clashes with those added on the way;
    ``toDF(*docs.columns)`` gives the names back."""
    plain = [f"c{j}" for j in range(len(docs.columns))]
    return docs.toDF(*plain), *[plain[docs.columns.index(n)] for n in names]


def text_column(df: DataFrame, text: str) -> Column:
    """The text as a string, null as empty."""
    return F.coalesce(df[text].cast("string"), F.lit(""))


def keep_rows(docs_keyed: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows of ``docs_keyed`` whose key isn't in ``dropped``, without the key columns."""
    return docs_keyed.join(dropped.select(FILE, POS), [FILE, POS], "left_anti").drop(FILE, POS)
