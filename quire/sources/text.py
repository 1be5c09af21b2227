"""Plain text scan: one row for each line that is not blank."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import strip


def scan_lines(docs: DataFrame) -> DataFrame:
    """doc_id, line_no, ln_pos, text of docs (doc_id, text); ln_pos counts lines that are not blank, from 0.

    Counting stays within a document's own array of lines, so the scan needs no shuffle.
    """
    lines = F.transform(F.split("text", "\n"), lambda x, k: F.struct(k.cast("long").alias("line_no"), strip(x).alias("text")))
    held = F.filter(lines, lambda x: x["text"] != "")
    return docs.select("doc_id", F.posexplode(held).alias("ln_pos", "line")).select("doc_id", "line.line_no", F.col("ln_pos").cast("long").alias("ln_pos"), "line.text")


def in_order(*more: str) -> Window:
    return Window.partitionBy("doc_id", *more).orderBy("ln_pos")
