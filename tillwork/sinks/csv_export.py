"""Export of a report as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame


def export_csv(report: DataFrame, path: str) -> None:
    """Write every row: header, comma, doubled quotes, UTF-8; one file per partition of ``report``.

    NULL and empty text are both written as nothing and read back as NULL.
    """
    (
        report.write.mode("overwrite")
        .options(header=True, sep=",", quote='"', escape='"', nullValue="", emptyValue="", encoding="UTF-8", compression="none")
        .csv(path)
    )
