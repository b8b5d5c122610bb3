"""K5 — idempotent replacement of one date in a date-partitioned dataset.

Reference semantics: ``DELETE WHERE extract_date = D`` followed by
``INSERT ... SELECT`` of the new rows.  On a Parquet tree the date is one
top-level directory, so the replacement overwrites that directory as a
whole: tuples that no longer receive rows go with it, and nothing else is
listed or touched.  No rows remove the directory.  Running the same replacement
twice gives the same result, and a killed one leaves the date as it was or as it
should be (:mod:`.commit`).  A catalog table at ``path`` does not learn of new dates here:
use :func:`partwright.operators.table.replace_table_date` for it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import paths
from ..functions.dates import date_literal, parse_date
from ..functions.keys import escape_value
from .commit import Replacement
from .export import prepare_export, reads_from, write_prepared


def replace_date(
    rows: DataFrame,
    path: str,
    extract_date,
    *,
    keys: Sequence[str] = ("extract_date",),
    date_column: str = "extract_date",
    sort_within: Sequence[str] = (),
    max_rows_per_file: int | None = None,
    strategy: str | None = None,
    atomic: bool = True,
    on_step: Callable[[str], None] | None = None,
) -> dict:
    """Replace date ``extract_date`` under ``path`` by ``rows``.

    ``rows`` must all carry that date; the check rides on the export's counting
    pass or, without one (``"direct"``), on the write, so the source is read once.  A violation
    raises and leaves the target as it was, as do rows that are read from the target.  ``keys`` are the dataset's partition columns; the date column
    must be the first one.  With the date as the only key each input task writes its
    own rows (``"direct"``, no shuffle); with further keys the rows are co-located per
    tuple as in the export (``"split"``), one file per tuple up to the bound.
    """
    keys = tuple(keys)
    if keys[0] != date_column:
        raise ValueError("the date column must be the first partition key")
    strategy = strategy or ("split" if len(keys) > 1 else "direct")
    if reads_from(rows, path):
        raise ValueError(f"refusing to replace a date of {path!r} by rows read from it: write them elsewhere first")
    day = parse_date(extract_date)
    target_dir = f"{path.rstrip('/')}/{date_column}={escape_value(day)}"
    spark = rows.sparkSession
    try:
        prep = prepare_export(
            rows,
            keys=keys,
            sort_within=sort_within,
            max_rows_per_file=max_rows_per_file,
            require=F.col(date_column).eqNullSafe(date_literal(day)),
            strategy=strategy,
            check_inside=atomic,
        )
        if prep.result.rows == 0:
            prep.release()
            there = paths.exists(spark, target_dir)
            if there and atomic:
                Replacement(spark, path, on_step).commit(arriving=(), leaving=(target_dir.rpartition("/")[2],))
            elif there:
                paths.delete_tree(spark, target_dir)
            return {"rows": 0, "removed_partition": there}
        res = write_prepared(prep, path, overwrite="partitions", below=target_dir, atomic=atomic, on_step=on_step)
    except ValueError as exc:
        if "required condition" in str(exc):
            raise ValueError(f"replacement rows are not all dated {day}: {exc}") from None
        raise
    if not res.rows:
        return {"rows": 0, "removed_partition": res.removed}
    return {"rows": res.rows, "removed_partition": False, "export": res}
