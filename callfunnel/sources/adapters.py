"""Adapter views: the 13 logical tables derived from the driver's TPC-H-ish tables.

Every view is a lazy DataFrame over `orders`, `customer`, `supplier`, `part`,
`lineitem` and `events`, so work grows with the input scale factor. The mapping
rules are stated in FIXTURES.md §2; `oracle_sql.py` holds the same views in SQL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callfunnel.config import FunnelConfig
from callfunnel.functions.ladders import spark_str
from callfunnel.sources.fixture_text import CALL_TYPES, PHRASES, TITLES
from callfunnel.sources.tables import Tables

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


# the run parameters that fit the driver tables' dates and keys
ADAPTER_CONFIG = FunnelConfig(appt_start=dt.date(1995, 7, 3), sub_start=dt.date(1995, 6, 1),
                              online_locations=(0, 1, 2, 3, 4), therapy_id=1)


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _array_sql(options) -> str:
    return "array(" + ", ".join("CAST(NULL AS STRING)" if o is None else spark_str(o) for o in options) + ")"


def _pick(options, idx_sql: str) -> Column:
    """options[idx] for a 0-based integer SQL expression (NULL entries allowed)."""
    return F.expr(f"element_at({_array_sql(options)}, CAST(({idx_sql}) + 1 AS INT))")


def _null_ts() -> Column:
    return F.lit(None).cast(T.TimestampNTZType())


def _enc(li) -> Column:
    return li.l_orderkey * 2 + F.when(li.l_linestatus == "F", 1).otherwise(0)


def _kind(li) -> Column:
    return (F.when(li.l_returnflag == "A", "drug").when(li.l_returnflag == "R", "lab")
            .when(li.l_returnflag == "N", "consultation"))


def _tier(li) -> Column:
    return (F.when(li.l_discount > 0.065, "Recommended").when(li.l_discount < 0.015, F.lit(None).cast("string"))
            .otherwise("Essentials"))


def _consultation_id(li) -> Column:
    return F.when(li.l_linenumber == 7, F.lit(2)).otherwise(F.lit(1)).cast("bigint")


def _qty(li) -> Column:
    return F.floor(li.l_quantity).cast("bigint")


def adapter_tables(spark: SparkSession, sf_dir: str) -> Tables:
    orders = read_driver(spark, sf_dir, "orders")
    customer = read_driver(spark, sf_dir, "customer")
    supplier = read_driver(spark, sf_dir, "supplier")
    part = read_driver(spark, sf_dir, "part")
    li = read_driver(spark, sf_dir, "lineitem")
    events = read_driver(spark, sf_dir, "events")

    appointments = (
        orders.join(customer.select("c_custkey", "c_nationkey"), orders.o_custkey == customer.c_custkey, "inner")
        .select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("patient_id"),
            F.expr("o_custkey DIV 15").alias("provider_id"),
            F.substring("o_orderpriority", 1, 1).cast("bigint").alias("type_id"),
            F.col("c_nationkey").cast("bigint").alias("location_id"),
            F.when(F.col("o_orderstatus") == "F", "COMPLETED").when(F.col("o_orderstatus") == "O", "RECONSULTED")
             .when(F.col("o_orderstatus") == "P", "CANCELLED").alias("status"),
            (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int")))
            .alias("start_time"),
            F.when(F.col("o_orderkey") % 50 == 7, F.col("o_orderdate")).alias("deleted_at"),
        ))

    call_types = spark.createDataFrame(
        [(k, n, None) for k, n in CALL_TYPES],
        T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                      T.StructField("deleted_at", T.TimestampNTZType())]))

    providers = supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))

    enc_grp = (li.groupBy("l_orderkey", "l_linestatus").agg(F.min("l_shipdate").alias("created_at")))
    encounters = (
        enc_grp.join(orders.select("o_orderkey", "o_custkey"), enc_grp.l_orderkey == orders.o_orderkey, "inner")
        .select(
            (F.col("l_orderkey") * 2 + F.when(F.col("l_linestatus") == "F", 1).otherwise(0)).alias("id"),
            F.col("o_custkey").alias("patient_id"),
            F.col("l_orderkey").alias("appointment_id"),
            F.when(F.col("l_linestatus") == "F", "Merged-RX").otherwise("Standard").alias("type"),
            F.col("created_at"),
            F.when(F.col("l_orderkey") % 40 == 3, F.col("created_at")).alias("deleted_at"),
        ))

    def orders_of(flag: str, item_col: str, item: Column) -> DataFrame:
        return li.filter(li.l_returnflag == flag).select(
            _enc(li).alias("encounter_id"), item.alias(item_col), _tier(li).alias("importance_level"),
            li.l_shipdate.alias("created_at"),
            F.when(li.l_quantity > 49.5, li.l_shipdate).alias("deleted_at"))

    drug_orders_src = orders_of("A", "drug_id", li.l_partkey)
    lab_orders_src = orders_of("R", "lab_test_id", li.l_partkey)
    therapy_orders_src = li.filter(li.l_returnflag == "N").select(
        _enc(li).alias("encounter_id"), _consultation_id(li).alias("consultation_id"),
        _qty(li).alias("quantity"),
        (_qty(li) - F.when(li.l_tax > 0.055, 1).otherwise(0)).alias("remaining_quantity"),
        _tier(li).alias("importance_level"), li.l_shipdate.alias("created_at"),
        F.when(li.l_quantity > 49.5, li.l_shipdate).alias("deleted_at"))

    drug_inventory = part.filter(part.p_partkey % 20 != 0).select(
        part.p_partkey.alias("id"), F.when(part.p_size > 10, 1).otherwise(0).alias("is_verified"))

    inv_id = _enc(li) * 2 + (li.l_linenumber % 2)
    inv_grp = (li.select(inv_id.alias("id"), _enc(li).alias("encounter_id"), "l_shipdate")
               .groupBy("id", "encounter_id").agg(F.min("l_shipdate").alias("created_at")))
    invoices = inv_grp.select(
        "id", "encounter_id",
        F.when(F.col("id") % 35 == 4, F.lit(None).cast("string"))
         .when(F.col("id") % 5 == 0, "cancelled").when(F.col("id") % 5 == 4, "raised")
         .otherwise("paid").alias("status"),
        "created_at",
        F.when(F.col("id") % 60 == 11, F.col("created_at")).alias("deleted_at"))

    invoice_items = li.filter(li.l_tax > 0.035).select(
        inv_id.alias("invoice_id"), _kind(li).alias("type"),
        F.when(li.l_returnflag == "N", _consultation_id(li)).otherwise(li.l_partkey).alias("type_id"),
        _null_ts().alias("deleted_at"))

    title_no = f"l_partkey % {len(TITLES)}"
    title = _pick([t for t, _ in TITLES], title_no)
    arms = " ".join(
        f"WHEN {i} THEN element_at({_array_sql(PHRASES[fam])}, "
        f"CAST(((l_partkey * 7 + l_suppkey) % {len(PHRASES[fam])}) + 1 AS INT))"
        for i, (_, fam) in enumerate(TITLES))
    value = F.expr(f"CASE {title_no} {arms} END")
    form_answers = li.select(
        _enc(li).alias("encounter_id"), title.alias("title"), value.alias("value"),
        li.l_shipdate.alias("created_at"), F.when(li.l_quantity < 1.5, li.l_shipdate).alias("deleted_at"))

    encounter_tags = li.select(
        _enc(li).alias("encounter_id"), _kind(li).alias("item_type"), (_qty(li) % 3).alias("dss_quantity"),
        F.when(li.l_linenumber < 6, "item").otherwise("encounter").alias("tag_category"),
        li.l_shipdate.alias("created_at"), _null_ts().alias("deleted_at"))

    optout_opts = PHRASES["optout"]
    preferences = events.select(
        (events.event_id * 3).alias("encounter_id"),
        F.when(events.event_type.isin("purchase", "error"), "drug").when(events.event_type == "view", "lab_test")
         .when(events.event_type == "click", "consultation").when(events.event_type == "signup", "encounter")
         .alias("preference_type"),
        F.when(events.event_id % 7 == 0, 0).otherwise(1).alias("opt_out"),
        _pick(optout_opts, f"user_id % {len(optout_opts)}").alias("opt_out_reason"),
        events.ts.alias("created_at"), _null_ts().alias("deleted_at"))

    return Tables(appointments=appointments, call_types=call_types, providers=providers, encounters=encounters,
                  form_answers=form_answers, drug_orders_src=drug_orders_src, drug_inventory=drug_inventory,
                  lab_orders_src=lab_orders_src, therapy_orders_src=therapy_orders_src, invoices=invoices,
                  invoice_items=invoice_items, encounter_tags=encounter_tags, preferences=preferences)
