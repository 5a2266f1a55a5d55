"""CSV with a header row, the entrance to bronze."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from strata.contracts import Column, ddl


def read_csv(
    spark: SparkSession,
    source: str,
    columns: Sequence[Column] | None = None,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Read CSV; an empty field is NULL.

    Without ``columns`` all source columns are kept and their types inferred, which reads the
    source once more. With ``columns`` there is no such pass, every file's header is checked
    against the names, and ``corrupt_column`` (if named) keeps the text of a line that does not
    fit. Quoted line breaks are not allowed, so large files stay splittable.
    """
    reader = spark.read.option("header", True)
    if columns is None:
        return reader.option("inferSchema", True).csv(source)
    schema = ddl(columns)
    if corrupt_column:
        schema += f", `{corrupt_column}` string"
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.option("enforceSchema", False).schema(schema).csv(source)


CORRUPT = "corrupt_record"


def read_csv_text(spark: SparkSession, source: str, multi_line: bool = False) -> DataFrame:
    """All columns of a CSV source as text, and the text of each line that has too few or too many.

    Nothing is parsed, so nothing can be lost. Names and order come from the header; a file with
    another header fails the job. ``multi_line`` allows quoted line breaks, but then one task reads
    a whole file.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line)
    names = [c for c in reader.csv(source).columns if c != CORRUPT]
    columns = [Column(name, "string") for name in (*names, CORRUPT)]
    return (
        reader.option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(ddl(columns))
        .csv(source)
    )
