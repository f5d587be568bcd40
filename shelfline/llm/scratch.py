"""Tables written to the folder the cluster shares, so that a lost executor never costs a stage its input."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from shelfline.session import ensure_checkpoint_dir


def table(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet to the shared scratch folder and read back.

    Unlike ``checkpoint()`` the rows are compressed and columns can be pruned when
    they are read. The folder is the cluster's ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clean_documents(docs: DataFrame) -> DataFrame:
    """The columns of ``documents`` an operator may rely on; whatever else is there is left out."""
    return docs.select(*[c for c in ("doc_id", "text", "lang", "source", "n_chars") if c in docs.columns])


def free(docs: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as no column of ``docs`` has."""
    out, taken = [], {c.lower() for c in docs.columns}
    for name in names:
        name = f"_{name}"
        while name in taken:
            name = f"_{name}"
        taken.add(name)
        out.append(name)
    return out
