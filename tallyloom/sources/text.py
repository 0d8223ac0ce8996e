"""Text sources."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.plans.lookups import lookup
from tallyloom.plans.storage import materialize


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row ``line`` per line of the files."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def lines_of(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The lines inside a text column as (key, line_no, line)."""
    return documents.select(
        key, F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line")
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One document per line, as (path, offset, doc_id, text).

    ``offset`` is the byte offset of the line in its file. ``doc_id`` adds the bytes
    of the files that come before it by path, so it is unique over all files and
    equals the offset where there is one file. Spark reads a file in splits; the
    offset is the bytes of the earlier splits, summed once per split, plus the
    bytes of the earlier lines of the same split, summed per Arrow batch where the
    split is read. The text itself is not shuffled.
    """

    def offsets_in_split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Add to every line the bytes of the lines before it in its split."""
        current, reached = None, 0
        for batch in batches:
            path, split, text = batch.columns
            if not batch.num_rows:
                continue
            width = pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64) + 1
            before = np.cumsum(width) - width
            change = pc.not_equal(split[1:], split[:-1]).to_numpy(zero_copy_only=False)
            starts = np.append(0, np.flatnonzero(change) + 1)
            base = before[starts]
            if current == split[0].as_py():
                base[0] -= reached
            at = before - np.repeat(base, np.diff(np.append(starts, batch.num_rows)))
            current, reached = split[-1].as_py(), int(at[-1] + width[-1])
            yield pa.RecordBatch.from_arrays(
                [path, split, text, pa.array(at)], names=["path", "split", "text", "at"]
            )

    start = F.col("_metadata.file_block_start")
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("path"),
        F.concat_ws(" ", start.cast("string"), "_metadata.file_path").alias("split"),
        start.alias("start"),
        F.col("value").alias("text"),
    )
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sizes = lines.groupBy("path", "split", "start").agg(
        F.sum(F.octet_length("text") + 1).alias("bytes"), F.count("*").alias("n")
    )
    sizes = materialize(sizes, "splits")
    # One row per file, ordered once by path.
    files = sizes.groupBy("path").agg(F.sum("bytes").alias("bytes"))
    files_before = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("path", F.coalesce(F.sum("bytes").over(files_before), F.lit(0)).alias("first"))
    bases = materialize(
        sizes.select(
            "path", "split", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("base"), "n"
        ).join(files, "path"),
        "bases",
    )
    placed = lines.select("path", "split", "text").mapInArrow(
        offsets_in_split, "path string, split string, text string, at bigint"
    )
    found = lookup(placed, bases.select("split", "base", "first"), "split", weight=bases)
    offset = F.col("base") + F.col("at")
    return found.select(
        "path",
        offset.alias("offset"),
        (F.col("first") + offset).alias("doc_id"),
        F.regexp_replace("text", "\r$", "").alias("text"),
    )
