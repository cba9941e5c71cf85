"""Production read path: logical tables from Parquet, filters pushed, columns pruned."""

import tempfile
from functools import reduce

import pytest
from pyspark.sql import DataFrame

from callfunnel.operators import calls as C
from callfunnel.sources.adapters import ADAPTER_CONFIG, adapter_tables
from callfunnel.sources.schema import SCHEMAS
from callfunnel.sources.tables import SPLIT, cut_points, ranges, read_jdbc_tables, read_tables, run_filters

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def written(spark):
    root = tempfile.mkdtemp(prefix="callfunnel-tables-")
    for name, df in adapter_tables(spark, SF).as_dict().items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")
    return root


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan(spark, written):
    t = read_tables(spark, written)
    calls = C.calls_with_diagnosis(t, ADAPTER_CONFIG)
    plan = _plan(calls)
    # soft-delete and cushion-date filters are pushed into the Parquet scans
    assert "IsNull(deleted_at), GreaterThanOrEqual(created_at,1995-06-01T00:00)" in plan
    # the shifted local-time bound is pushed in its raw form
    assert "GreaterThanOrEqual(start_time,1995-07-02T18:30)" in plan
    # column pruning: the form-answer scan for reasons reads only what it uses
    assert "ReadSchema: struct<encounter_id:bigint,title:string,value:string," in plan
    assert "ReadSchema: struct<id:bigint,is_verified:int>" in plan
    # top-1 per patient is limited before the shuffle; no sort-based aggregation
    assert "WindowGroupLimit" in plan
    assert "SortAggregate" not in plan


def test_parquet_path_equals_adapter_path(spark, written):
    cfg = ADAPTER_CONFIG
    a = C.calls_with_diagnosis(read_tables(spark, written), cfg)
    b = C.calls_with_diagnosis(adapter_tables(spark, SF), cfg)
    assert sorted(a.collect()) == sorted(b.collect())


def test_call_table_does_without_item_level_payments(spark, written):
    """No paid-item join reaches the call table: invoices are read for the invoice flags only."""
    plan = _plan(C.calls_with_diagnosis(read_tables(spark, written), ADAPTER_CONFIG))
    assert plan.count("/invoices") == plan.count("/invoice_items") == 1


def test_tab_queries_do_not_explode_and_a_patientless_call_skips_the_join(spark, written):
    from callfunnel.operators import status as S
    calls = C.calls_with_diagnosis(read_tables(spark, written), ADAPTER_CONFIG)
    assert "Generate" not in _plan(S.tab_grain(calls, "meds"))
    assert "[_key#" in _plan(calls)


class Warehouse:
    """Stands for the warehouse behind `DataFrameReader.jdbc`: an in-process DuckDB, one query per range."""

    def __init__(self, spark, root):
        import duckdb
        self.spark, self.asked, self.con = spark, [], duckdb.connect()
        self.con.execute("CREATE SCHEMA shop")
        for name in SCHEMAS:
            self.con.execute(f"CREATE VIEW shop.{name} AS SELECT *, 1 AS extra FROM read_parquet('{root}/{name}/*.parquet')")

    def jdbc(self, reader, url, table, properties=None, predicates=None):
        parts = []
        for where in predicates or ["1 = 1"]:
            got = self.con.execute(f"SELECT * FROM {table} WHERE {where}").to_arrow_table()
            parts.append(self.spark.createDataFrame(got) if got.num_rows else None)
        self.asked.append((url, table, predicates, properties, [p.count() if p else 0 for p in parts]))
        found = [p for p in parts if p]
        return reduce(DataFrame.unionByName, found) if found else self.spark.createDataFrame(got.slice(0, 0).to_pandas(), _layout(got))


def _layout(table):
    from pyspark.sql.pandas.types import from_arrow_schema
    return from_arrow_schema(table.schema)


def test_warehouse_scan_is_cut_filtered_and_pruned(spark, written, monkeypatch):
    """Each of the 13 reads has several ranges that hold every row once, the used columns and the run's filters."""
    warehouse = Warehouse(spark, written)
    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameReader.jdbc", lambda self, *a, **k: warehouse.jdbc(self, *a, **k))
    names = {n: f"shop.{n}" for n in SCHEMAS}
    t = read_jdbc_tables(spark, "jdbc:x", names, {"user": "u"}, ADAPTER_CONFIG, partitions=4)
    scans = {a[1].split("shop.")[1].split(" ")[0].rstrip(")"): a for a in warehouse.asked if a[2]}
    assert set(scans) == set(SCHEMAS)
    filters = run_filters(ADAPTER_CONFIG)
    for name, (url, query, predicates, properties, sizes) in scans.items():
        assert (url, properties) == ("jdbc:x", {"user": "u"})
        assert query.startswith("(SELECT " + ", ".join(SCHEMAS[name].fieldNames()) + " FROM ") and "extra" not in query
        assert all(f in query for f in filters.get(name, []))
        whole = warehouse.con.execute(f"SELECT COUNT(*) FROM {query}").fetchone()[0]
        assert sum(sizes) == whole
        if whole > 1000:
            assert 3 <= len(predicates) <= 5 and max(sizes) < 0.6 * whole, (name, sizes)
    for name, df in t.as_dict().items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in SCHEMAS[name]]
    a, b = (C.calls_with_diagnosis(x, ADAPTER_CONFIG) for x in (t, adapter_tables(spark, SF)))
    assert sorted(a.collect()) == sorted(b.collect())


def test_ranges_hold_similar_numbers_of_rows():
    assert cut_points([(k, 10) for k in range(16)], 4) == [4, 8, 12]
    assert cut_points([(0, 1), (1, 1), (2, 96), (3, 1), (4, 1)], 4) == [3]       # one heavy step is a range of its own
    assert cut_points([(5, 3)], 4) == [] and cut_points([], 4) == []
    assert ranges("k", []) == ["1 = 1"]
    assert ranges("k", ["5", "9"]) == ["k < 5 OR k IS NULL", "k >= 5 AND k < 9", "k >= 9"]
    assert set(SPLIT.values()) == {"id", "created_at", "invoice_id"}


def test_a_cluster_without_a_checkpoint_dir_is_refused(spark, monkeypatch):
    from callfunnel import session

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
