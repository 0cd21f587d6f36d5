"""Small helpers shared by the tests."""

from datetime import datetime


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def rows(df, *columns):
    """Rows as sorted tuples, nulls first."""
    selected = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in selected.collect()), key=lambda r: tuple((v is not None, v) for v in r))


def plan(df, mode: str = "simple") -> str:
    """Physical plan text."""
    explain = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    return df._jdf.queryExecution().explainString(explain)


def scan_details(df) -> dict[str, str]:
    """Filters and columns of the first file scan, in full."""
    text = plan(df, "formatted")
    scan = text[text.index(") Scan parquet") :].split("\n\n")[0]
    return dict(row.split(": ", 1) for row in scan.splitlines() if ": " in row)
