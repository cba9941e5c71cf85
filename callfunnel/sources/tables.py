"""Readers for the 13 logical tables.

`read_tables(spark, root)` reads `<root>/<table>` Parquet datasets with the static
schema (no inference pass over 100 TB of footers). Only the columns an operator
selects are read: Catalyst prunes the scan's ReadSchema and pushes the
soft-delete / cushion-date filters into it.

`read_jdbc_tables` reads the same tables from a warehouse over many connections. Each table is a
query of the used columns and the run's filters, cut into ranges of its split column. A grouped
count over `STRIDES` equal steps per range asked for comes first, so that ranges hold about the same
number of rows; steps that hold more stay whole ranges. The first range is open below and takes the
rows without a split value, the last is open above: whatever the bounds, every row is in one range.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from callfunnel.config import FunnelConfig
from callfunnel.functions import ladders as L
from callfunnel.sources.schema import SCHEMAS

STRIDES = 16
#: What a table is cut by: its own id, else when a row was made, else the key it hangs on.
SPLIT = {name: next(c for c in ("id", "created_at", "invoice_id") if c in schema.fieldNames()) for name, schema in SCHEMAS.items()}


@dataclass
class Tables:
    appointments: DataFrame
    call_types: DataFrame
    providers: DataFrame
    encounters: DataFrame
    form_answers: DataFrame
    drug_orders_src: DataFrame
    drug_inventory: DataFrame
    lab_orders_src: DataFrame
    therapy_orders_src: DataFrame
    invoices: DataFrame
    invoice_items: DataFrame
    encounter_tags: DataFrame
    preferences: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return dict(self.__dict__)


def read_tables(spark: SparkSession, root: str, fmt: str = "parquet") -> Tables:
    dfs = {}
    for name, schema in SCHEMAS.items():
        dfs[name] = spark.read.format(fmt).schema(schema).load(f"{root.rstrip('/')}/{name}")
    return Tables(**dfs)


# ---------------------------------------------------------------- warehouse
def _sql(v) -> str:
    """A literal that every warehouse reads alike."""
    if isinstance(v, dt.datetime):
        return f"TIMESTAMP '{v:%Y-%m-%d %H:%M:%S}'"
    if isinstance(v, dt.date):
        return f"TIMESTAMP '{v:%Y-%m-%d} 00:00:00'"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def _any_of(column: str, values) -> str:
    return f"{column} IN ({', '.join(map(_sql, values))})"


def run_filters(cfg: FunnelConfig) -> dict[str, list[str]]:
    """Per table the conditions that every use of it in a run shares; the operators apply them again."""
    start = dt.datetime.combine(cfg.appt_start, dt.time()) - dt.timedelta(hours=cfg.shift_hours, minutes=cfg.shift_minutes)
    live, since = "deleted_at IS NULL", f"created_at >= {_sql(cfg.sub_start)}"
    return {
        "appointments": [live, f"start_time >= {_sql(start)}", _any_of("status", L.CALL_STATUSES)],
        "call_types": [live, _any_of("name", L.CALL_TYPE_NAMES)],
        "encounters": [live], "form_answers": [live],  # the latest diagnosis may be older than the cushion
        "drug_orders_src": [live, since], "lab_orders_src": [live, since],
        "therapy_orders_src": [live, since, f"consultation_id = {_sql(cfg.therapy_id)}"],
        "invoices": [live, since], "invoice_items": [live],
        "encounter_tags": [live, since, "tag_category = 'item'"], "preferences": [live, since, "opt_out = 1"],
    }


def table_query(name: str, qualified: str, filters: list[str]) -> str:
    """The used columns of the rows that pass, as a subquery."""
    where = f" WHERE {' AND '.join(filters)}" if filters else ""
    return f"(SELECT {', '.join(SCHEMAS[name].fieldNames())} FROM {qualified}{where}) t"


def cut_points(steps: list[tuple[int, int]], n: int) -> list[int]:
    """Steps (step, rows) at which a new range begins, so that `n` ranges hold about as many rows each."""
    total, held, out, aim = sum(c for _, c in steps), 0, [], 1
    for step, count in sorted(steps):
        if held * n >= aim * total and held:
            out.append(step)
            aim = held * n // total + 1
        held += count
    return out


def ranges(column: str, points: list[str]) -> list[str]:
    """Predicates of the ranges between the points: no overlap, no gap, nulls in the first."""
    if not points:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(points, points[1:])]
    return [f"{column} < {points[0]} OR {column} IS NULL", *inner, f"{column} >= {points[-1]}"]


def split_predicates(spark: SparkSession, url: str, query: str, column: str, kind: T.DataType, n: int, properties: dict[str, str]) -> list[str]:
    """About `n` ranges of `column` with similar row counts, from two small queries: its bounds, and counts by step."""
    ask = lambda q: spark.read.jdbc(url, f"({q}) b", properties=properties).collect()  # noqa: E731  at most STRIDES * n rows
    (low, high), = ask(f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {query}")
    if n < 2 or low is None or low == high:
        return ranges(column, [])
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        width = max(1, -(-int((high - low).total_seconds() + 1) // (STRIDES * n)))
        edges = [low + dt.timedelta(seconds=width * k) for k in range(1, int((high - low).total_seconds()) // width + 1)]
        edges = [e.replace(microsecond=0) for e in edges]
    else:
        low, high = int(low), int(high)
        width = max(1, -(-(high - low + 1) // (STRIDES * n)))
        edges = list(range(low + width, high + 1, width))
    step = "CASE " + " ".join(f"WHEN {column} < {_sql(e)} THEN {k}" for k, e in enumerate(edges)) + f" ELSE {len(edges)} END" if edges else "0"
    counts = ask(f"SELECT s, COUNT(*) AS n FROM (SELECT {step} AS s FROM {query}) q GROUP BY s")
    return ranges(column, [_sql(edges[k - 1]) for k in cut_points([(int(s), int(c)) for s, c in counts], n) if k])


def read_jdbc_tables(spark: SparkSession, url: str, names: dict[str, str], properties: dict[str, str],
                     cfg: FunnelConfig | None = None, partitions: int = 64, split: dict[str, str] | None = None) -> Tables:
    """Same contract over a JDBC warehouse: `names` maps logical -> qualified table.

    Each table is read over up to `partitions` connections, cut by `split` (default SPLIT) columns.
    With `cfg` the run's filters are part of the queries.
    """
    filters, split, dfs = run_filters(cfg) if cfg else {}, {**SPLIT, **(split or {})}, {}
    for name, schema in SCHEMAS.items():
        query, column = table_query(name, names[name], filters.get(name, [])), split[name]
        predicates = split_predicates(spark, url, query, column, schema[column].dataType, partitions, properties)
        df = spark.read.jdbc(url, query, predicates=predicates, properties=properties)
        dfs[name] = df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    return Tables(**dfs)
