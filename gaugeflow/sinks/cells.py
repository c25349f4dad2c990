"""Stored rows as cells of a wide-column store: table, row key, family, qualifier, bytes."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.cells import cell_map
from gaugeflow.schema import STORED_COLUMNS, STORED_ROW
from gaugeflow.sinks.changes import IN_WRITE, ONLY, newest_rows

# Fixed value: the one column family.
FAMILY = "M"

#: Cells in the order in which a bulk load takes them.
ORDER = ["table_name", "rowkey", "family", "qualifier"]

#: Rows of a range, about; each is nine cells to sort.
ROWS_PER_RANGE = 100_000


def cell_rows(rows: DataFrame) -> DataFrame:
    """One row per cell of the stored rows: nine each, eight without the column ``seconds``.

    A column that is null in a row has no cell there.
    """
    kinds = {c: STORED_ROW[c].dataType.simpleString() for c in STORED_COLUMNS if c in rows.columns}
    cells = rows.select(
        "table_name", "rowkey", F.lit(FAMILY).alias("family"), F.explode(cell_map(kinds)).alias("qualifier", "value")
    )
    return cells.where(F.col("value").isNotNull())


def sorted_cells(rows: DataFrame) -> DataFrame:
    """The cells in ranges of the salted row key, each range sorted.

    Ranges follow each other, so a store's files are written from them without another shuffle. The
    rows are dealt before they are turned into cells, a ninth as many. There are as many ranges as the
    number of rows asks for, which takes a count, so what a task sorts does not grow with the input.
    """
    ranges = max(1, ceil(rows.count() / ROWS_PER_RANGE))
    dealt = rows.repartitionByRange(ranges, "table_name", "rowkey")
    return cell_rows(dealt).sortWithinPartitions(*ORDER)


def write_cells(rows: DataFrame, root: str, batch_id: int, writer: str = ONLY) -> None:
    """Write the cells of one batch, of the newest row of each key, replacing an earlier attempt."""
    path = f"{root}/cells/writer={writer}/batch_id={batch_id}"
    sorted_cells(newest_rows(rows, IN_WRITE)).write.mode("overwrite").parquet(path)
