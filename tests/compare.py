"""Compare a Spark result with the same question answered by DuckDB."""

from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir):
    db = duckdb.connect()
    db.execute("SET threads = 4")
    for path in Path(sf_dir).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return db


def _kind(kind):
    """Arrow type without the details in which the two engines' exports differ."""
    text = str(kind).replace("large_", "")
    return text.split("[")[0] if text.startswith("timestamp") else text


def _rows(table):
    names = sorted(table.column_names)
    columns = [table.column(name).to_pylist() for name in names]
    kinds = [(name, _kind(table.schema.field(name).type)) for name in names]
    return kinds, Counter(zip(*columns))


def differences(df, db, sql):
    """Empty text when both agree on column names and on all rows."""
    kinds, found = _rows(df.toArrow())
    wanted_kinds, wanted = _rows(db.sql(sql).to_arrow_table())
    if kinds != wanted_kinds:
        return f"columns {sorted(set(kinds) ^ set(wanted_kinds))}"
    if found == wanted:
        return ""
    extra, lacking = list((found - wanted).items()), list((wanted - found).items())
    return (
        f"rows {found.total()} vs {wanted.total()}; {len(extra)} extra e.g. {extra[:2]};"
        f" {len(lacking)} lacking e.g. {lacking[:2]}"
    )
