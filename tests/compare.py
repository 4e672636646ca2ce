"""Compare a query with its SQL, value by value."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def run_sql(sf_dir: str, sql: str) -> tuple[list[str], list[str], list[tuple]]:
    base = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            base.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    table = base.sql(sql).to_arrow_table()
    return table.column_names, [str(t) for t in table.schema.types], list(zip(*table.to_pydict().values())) if table.num_rows else []


def normal(rows: list[tuple]) -> list[str]:
    """Rows as sortable text; -0.0 counts as 0.0."""
    return sorted(repr(tuple(v + 0.0 if isinstance(v, float) else v for v in row)) for row in rows)


def difference(frame, sf_dir: str, sql: str) -> str | None:
    table = frame.toArrow()
    names, types, expected = run_sql(sf_dir, sql)
    order = sorted(range(len(names)), key=lambda i: names[i])
    if sorted(table.column_names) != sorted(names):
        return f"columns {sorted(table.column_names)} against {sorted(names)}"
    mine = {n: str(t) for n, t in zip(table.column_names, table.schema.types)}
    theirs = dict(zip(names, types))
    other = {n: (mine[n], theirs[n]) for n in names if mine[n] != theirs[n]}
    if other:
        return f"types {other}"
    got = normal(list(zip(*[table.column(names[i]).to_pylist() for i in order])))
    want = normal([tuple(row[i] for i in order) for row in expected])
    if got == want:
        return None
    only_got = sorted(set(got) - set(want))[:3]
    only_want = sorted(set(want) - set(got))[:3]
    return f"{len(got)} rows against {len(want)}; only here {only_got}; only in SQL {only_want}"
