"""Static schemas of the 13 logical source tables (ids as bigint; strings work too)."""

from pyspark.sql import types as T

_TS = T.TimestampNTZType()
_L = T.LongType()
_S = T.StringType()
_I = T.IntegerType()


def _st(*cols):
    return T.StructType([T.StructField(n, t, nullable=True) for n, t in cols])


SCHEMAS = {
    "appointments": _st(("id", _L), ("patient_id", _L), ("provider_id", _L), ("type_id", _L),
                        ("location_id", _L), ("status", _S), ("start_time", _TS), ("deleted_at", _TS)),
    "call_types": _st(("id", _L), ("name", _S), ("deleted_at", _TS)),
    "providers": _st(("id", _L), ("name", _S)),
    "encounters": _st(("id", _L), ("patient_id", _L), ("appointment_id", _L), ("type", _S),
                      ("created_at", _TS), ("deleted_at", _TS)),
    "form_answers": _st(("encounter_id", _L), ("title", _S), ("value", _S), ("created_at", _TS),
                        ("deleted_at", _TS)),
    "drug_orders_src": _st(("encounter_id", _L), ("drug_id", _L), ("importance_level", _S),
                           ("created_at", _TS), ("deleted_at", _TS)),
    "drug_inventory": _st(("id", _L), ("is_verified", _I)),
    "lab_orders_src": _st(("encounter_id", _L), ("lab_test_id", _L), ("importance_level", _S),
                          ("created_at", _TS), ("deleted_at", _TS)),
    "therapy_orders_src": _st(("encounter_id", _L), ("consultation_id", _L), ("quantity", _L),
                              ("remaining_quantity", _L), ("importance_level", _S), ("created_at", _TS),
                              ("deleted_at", _TS)),
    "invoices": _st(("id", _L), ("encounter_id", _L), ("status", _S), ("created_at", _TS), ("deleted_at", _TS)),
    "invoice_items": _st(("invoice_id", _L), ("type", _S), ("type_id", _L), ("deleted_at", _TS)),
    "encounter_tags": _st(("encounter_id", _L), ("item_type", _S), ("dss_quantity", _L), ("tag_category", _S),
                          ("created_at", _TS), ("deleted_at", _TS)),
    "preferences": _st(("encounter_id", _L), ("preference_type", _S), ("opt_out", _I),
                       ("opt_out_reason", _S), ("created_at", _TS), ("deleted_at", _TS)),
}

TABLE_NAMES = tuple(SCHEMAS)
