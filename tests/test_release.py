"""Publication: whole or not at all, week by week, in key order, one file."""

import json
import os
import tempfile
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from callfunnel.plans.refresh import WEEKLY, publish, refresh
from callfunnel.sources import publish as P
from callfunnel.sources import release as RL
from callfunnel.sources.adapters import ADAPTER_CONFIG, adapter_tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def updated(spark):
    return spark.createDataFrame([("01 Mar 2026, 10:00 IST",)], "updated string")


@pytest.fixture(scope="module")
def tables(spark):
    return adapter_tables(spark, SF)


def content(spark, release):
    """Every published table's rows."""
    return {n: sorted(map(repr, release.table(spark, n).select(sorted(json.loads(s)["name"] for s in map(json.dumps, json.loads(t[0])["fields"]))).collect()))
            for n, t in release.tables.items()}


def test_a_failed_write_leaves_the_release_before(spark, tables, updated, monkeypatch):
    d = tempfile.mkdtemp(prefix="callfunnel-rel-")
    assert RL.current(spark, d) is None
    out = refresh(spark, tables, ADAPTER_CONFIG)
    first = publish(spark, out, d, updated)
    want, count, write = content(spark, first), [], P.write_table

    def broken(df, path, keys=(), weekly=False):
        count.append(path)
        if len(count) == 5:
            raise OSError("disk full")
        write(df.limit(1), path, keys, weekly)

    monkeypatch.setattr(P, "write_table", broken)
    with pytest.raises(OSError, match="disk full"):
        publish(spark, out, d, updated)
    now = RL.current(spark, d)
    assert now.id == first.id and len(os.listdir(f"{d}/releases")) == 2
    assert content(spark, now) == want and all(want.values())
    monkeypatch.setattr(P, "write_table", write)
    third = publish(spark, out, d, updated)
    assert RL.current(spark, d).id == third.id and content(spark, third) == want
    publish(spark, out, d, updated)
    publish(spark, out, d, updated)
    assert len(os.listdir(f"{d}/releases")) <= 3 and not os.path.exists(first.folder())
    out.release()


def test_late_rows_rewrite_their_weeks_only(spark, tables, updated):
    d = tempfile.mkdtemp(prefix="callfunnel-rel-")
    out = refresh(spark, tables, ADAPTER_CONFIG)
    first = publish(spark, out, d, updated)
    # two calls are cancelled late, and one encounter's opt-out arrives
    gone = [r.appt_id for r in out.calls.orderBy("wk", "appt_id").limit(2).collect()]
    late = replace(tables, appointments=tables.appointments.withColumn(
        "status", F.when(F.col("id").isin(gone), F.lit("cancelled")).otherwise(F.col("status"))))
    again = refresh(spark, late, ADAPTER_CONFIG, previous=RL.current(spark, d))
    weeks = {r.wk for r in out.calls.filter(F.col("appt_id").isin(gone)).select("wk").collect()}
    assert weeks and set(again.digests) - set(again.kept) <= weeks and len(again.kept) >= len(first.weeks) - len(weeks)
    second = publish(spark, again, d, updated)
    written = {p[3:] for n in WEEKLY for p in os.listdir(f"{second.folder()}/tables/{n}") if p.startswith("wk=")}
    assert written <= weeks
    full = refresh(spark, late, ADAPTER_CONFIG)
    fresh = publish(spark, full, tempfile.mkdtemp(prefix="callfunnel-rel-"), updated)
    assert content(spark, second) == content(spark, fresh)
    assert open(f"{second.folder()}/document.js").read() == open(f"{fresh.folder()}/document.js").read()
    # nothing changed: no week is written, the release equals the one before
    third = publish(spark, refresh(spark, late, ADAPTER_CONFIG, previous=RL.current(spark, d)), d, updated)
    assert content(spark, third) == content(spark, second)
    assert not any(p.startswith("wk=") for n in WEEKLY for p in os.listdir(f"{third.folder()}/tables/{n}"))


def test_tables_are_in_key_order(spark, tables, updated):
    out = refresh(spark, tables, ADAPTER_CONFIG)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        release = publish(spark, out, tempfile.mkdtemp(prefix="callfunnel-rel-"), updated)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for name in ("rows", "er"):
        folder = f"{release.folder()}/tables/{name}"
        files = sorted(f for f in os.listdir(folder) if f.startswith("part-"))
        assert len(files) > 1
        keys = [tuple(r) for f in files for r in spark.read.parquet(f"{folder}/{f}").select(*P.POSITIONS).collect()]
        assert keys == sorted(keys) and len(keys) == out.tables()[name].count()
    assert len([f for f in os.listdir(f"{release.folder()}/document-parts") if f.startswith("part-")]) > 1
    out.release()


def test_parts_are_joined_in_order(spark):
    d = tempfile.mkdtemp(prefix="callfunnel-join-")
    spark.range(5000).select(F.concat(F.lit("é"), F.col("id").cast("string")).alias("line"), "id").repartitionByRange(7, "id").sortWithinPartitions("id") \
        .select("line").write.text(f"{d}/parts")
    size = RL.join_parts(spark, f"{d}/parts", f"{d}/one.txt")
    assert os.path.getsize(f"{d}/one.txt") == size
    assert open(f"{d}/one.txt").read() == "".join(f"é{i}\n" for i in range(5000))
    assert sorted(os.listdir(d)) == [".one.txt.draft.crc", "one.txt", "parts"] or sorted(os.listdir(d)) == ["one.txt", "parts"]


def test_other_file_systems_concatenate(spark):
    done = []

    class Fs:
        concat = staticmethod(lambda first, rest: done.append(("concat", first.getName(), [p.getName() for p in rest])))
        rename = staticmethod(lambda a, b: done.append(("rename", a.getName(), b.getName())))

    RL._concatenate(spark, Fs, ["x/part-0", "x/part-1", "x/part-2"], "x/one")
    assert done == [("concat", "part-0", ["part-1", "part-2"]), ("rename", "part-0", "one")]
