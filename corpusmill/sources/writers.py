"""Writers: delimited files, record logs, metrics, short reports."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Rows a metrics file may have.
MOST = 10_000


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """Delimited files with a header; quotes are doubled, arrays of addresses are written as a list's text form."""
    flat = [list_text(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name) for f in df.schema]
    df.select(*flat).write.mode(mode).option("header", True).option("escape", '"').option("quoteAll", True).csv(path)


def append_log(df: DataFrame, path: str) -> None:
    """Adds records, one per line."""
    df.write.mode("append").json(path)


def write_unique_log(df: DataFrame, path: str, key: str, order: list[str]) -> None:
    """Records with one row per key, the first by ``order``."""
    rest = [c for c in df.columns if c != key]
    df.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r")).select(key, "r.*").select(df.columns).write.mode("overwrite").json(path)


def list_text(c: Column) -> Column:
    """``['a', 'b']`` of an array of strings; ``[]`` for empty and null."""
    return F.concat(F.lit("["), F.array_join(F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.concat(F.lit("'"), F.replace(x, F.lit("'"), F.lit("\\'")), F.lit("'"))), ", "), F.lit("]"))


def metrics_json(aggregates: DataFrame) -> str:
    """The rows of a small aggregate as a JSON text; more than ``MOST`` rows are no metrics and an error, never cut."""
    rows = aggregates.limit(MOST + 1).collect()
    if len(rows) > MOST:
        raise ValueError(f"more than {MOST} rows: write them as a table")
    return json.dumps([r.asDict(recursive=True) for r in rows], ensure_ascii=False, indent=1, default=str)


def markdown_table(aggregates: DataFrame, most: int = 200) -> str:
    """A short report's table: at most ``most`` rows of an aggregate."""
    rows = aggregates.limit(most).collect()
    cell = lambda v: f"{v:,}" if isinstance(v, int) else f"{v:.4f}" if isinstance(v, float) else str(v).replace("|", "\\|")
    lines = ["| " + " | ".join(aggregates.columns) + " |", "|" + "-|" * len(aggregates.columns)]
    return "\n".join(lines + ["| " + " | ".join(cell(v) for v in r) + " |" for r in rows])
