"""Parsing that records what went wrong with a row and lets the job go on."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

OK, WARNING, ERROR, MISSING = "ok", "Warning!", "Error!", "missing"


def with_status(
    df: DataFrame, raw: str, parsed: Column, out: str = "value", suspicious: Column | None = None
) -> DataFrame:
    """Add ``out`` with a parsed value and ``status`` with how the parse of ``raw`` went.

    ``parsed`` must be an expression that gives null on failure, such as ``try_cast``. A row whose
    raw value is present but parses to null is an error, one that meets ``suspicious`` (which may
    read ``out``) a warning.
    """
    status = F.when(F.col(raw).isNotNull() & F.col(out).isNull(), ERROR)
    if suspicious is not None:
        status = status.when(suspicious, WARNING)
    return df.withColumn(out, parsed).withColumn("status", status.otherwise(OK))


def split_ok_failed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that parsed cleanly, and the quarantined rest."""
    return df.filter(F.col("status") == OK), df.filter(F.col("status") != OK)


def parsed_rows(df: DataFrame, raw: str, parse: Callable[[str], str], out: str = "value") -> DataFrame:
    """Every row with ``out`` as ``parse`` gives it, ``status`` and ``message``.

    ``parse`` takes the raw text and returns a text; whatever it raises becomes an error with the message, a warning it
    raises keeps the value given as its second argument, and a null is missing. One row's failure does not end the job.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_outcome(parse, text) for text in batch.column(raw).to_pylist()]
            parts = [pa.array(c, pa.string()) for c in (zip(*found, strict=True) if found else ([], [], []))]
            yield pa.record_batch([*batch.columns, *parts], names=[*batch.schema.names, out, "status", "message"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
    return df.mapInArrow(run, ", ".join([*fields, f"`{out}` string, status string, message string"]))


def _outcome(parse: Callable[[str], str], text: str | None) -> tuple[str | None, str, str | None]:
    if text is None:
        return None, MISSING, None
    try:
        return parse(text), OK, None
    except Warning as warning:
        return warning.args[1] if len(warning.args) > 1 else None, WARNING, str(warning.args[0])
    except Exception as error:  # noqa: BLE001
        return None, ERROR, str(error)


def write_by_status(parsed: DataFrame, path: str) -> dict[str, int]:
    """Write good and failed rows apart, below ``path``, in one pass; returns the rows of each status."""
    seen = Observation()
    counts = [F.count_if(F.col("status") == s).alias(s) for s in (OK, WARNING, ERROR, MISSING)]
    parsed.observe(seen, *counts).write.mode("overwrite").partitionBy("status").parquet(path)
    return seen.get
