"""Code lists kept as header CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

RISK_FACTOR_SCHEMA = "ICD10 string, Risk_Factor string"


def read_code_list(spark: SparkSession, path: str, schema: str = RISK_FACTOR_SCHEMA) -> DataFrame:
    """Read a CSV file (or a folder of them), adding ``line_no``, the position of each row.

    A row's position is its place in its piece of a file plus the sizes of the
    pieces before it.  Only one row per piece is gathered to add those up.
    """
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .csv(path)
        .select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_id"),
        )
    )
    in_order = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    pieces = rows.groupBy("_file", "_block").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_id").alias("_first")
    )
    shifts = pieces.select(
        "_file",
        "_block",
        (F.coalesce(F.sum("_rows").over(in_order), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    return rows.join(shifts, ["_file", "_block"]).select(
        *[c for c in rows.columns if not c.startswith("_")],
        (F.col("_id") + F.col("_shift")).alias("line_no"),
    )


def concat_by_code(
    lines: DataFrame, code: str = "ICD10", text: str = "Risk_Factor", line_no: str = "line_no"
) -> DataFrame:
    """One row per code: its texts joined with ', ' in file order.

    Also returns ``contiguous``, false where the lines of a code do not follow
    one another in the file; such a list is rejected by ``check_code_list``.
    """
    return lines.groupBy(F.col(code).alias("icd10")).agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct(F.col(line_no).alias("n"), F.col(text).alias("t")))),
                lambda x: x["t"],
            ),
            ", ",
        ).alias("description"),
        (F.max(line_no) - F.min(line_no) + 1 == F.count(F.lit(1))).alias("contiguous"),
    )


def check_code_list(codes: DataFrame) -> None:
    """Raise if a code comes back later in the list, which would make it a duplicate key."""
    broken = codes.filter(~F.col("contiguous")).select("icd10").head(5)
    if broken:
        raise ValueError(f"codes repeated apart in the list: {[r.icd10 for r in broken]}")
