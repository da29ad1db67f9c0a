"""Small builders for hand-checked vectors."""

from __future__ import annotations

import datetime as dt

from posledger.schemas import HISTORY_SCHEMA, PERIODS_SCHEMA, SNAPSHOT_SCHEMA


def day(text):
    return dt.date.fromisoformat(text) if isinstance(text, str) else text


def _frame(spark, schema, rows):
    out = []
    for row in rows:
        unknown = set(row) - set(schema.fieldNames())
        assert not unknown, unknown
        values = []
        for field in schema.fields:
            value = row.get(field.name)
            kind = field.dataType.typeName()
            if value is not None and kind == "date":
                value = day(value)
            if value is not None and kind == "double":
                value = float(value)
            values.append(value)
        out.append(tuple(values))
    return spark.createDataFrame(out, schema)


def snapshots(spark, periods, parent="P"):
    """[(period, filing_date, accession, [row, ...]), ...] -> (rows, periods) frames."""
    rows, grid = [], []
    for period, filed, accession, items in periods:
        head = {"parent_ticker": parent, "period_end": period, "filing_date": filed, "accession_no": accession}
        grid.append(head)
        rows += [{**head, **item} for item in items]
    return _frame(spark, SNAPSHOT_SCHEMA, rows), _frame(spark, PERIODS_SCHEMA, grid)


def history(spark, rows, parent="P"):
    return _frame(spark, HISTORY_SCHEMA, [{"parent_ticker": parent, **r} for r in rows])


def frame(spark, schema, rows):
    return _frame(spark, schema, rows)


def collect(df, *keys):
    rows = [r.asDict(recursive=True) for r in df.collect()]
    return sorted(rows, key=lambda r: tuple(str(r[k]) for k in keys)) if keys else rows
