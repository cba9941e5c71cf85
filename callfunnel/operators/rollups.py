"""Per-encounter rollups of the order, invoice, answer, tag and opt-out tables.

Each rollup collapses its source to one row per `encounter_id` with MIN/MAX
aggregates, so Spark runs a partial (map-side) aggregate before the shuffle and
a hot encounter never reaches a single reducer as raw rows. All outputs are
hash-partitioned on `encounter_id`, which lets the call assembly join them to
the encounter list without re-shuffling them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callfunnel.config import FunnelConfig
from callfunnel.functions import ladders as L
from callfunnel.functions.predicates import flag, live, since

ENC = "encounter_id"
RECOMMENDED = "Recommended"       # FIXED VALUE: the lower importance tier
DEFAULT_TIER = "Essentials"       # FIXED VALUE: NULL importance counts as this


def is_rec(tier: str = "importance_level") -> Column:
    return F.col(tier) == RECOMMENDED


def is_ess(tier: str = "importance_level") -> Column:
    return F.coalesce(F.col(tier), F.lit(DEFAULT_TIER)) != RECOMMENDED


# ---------------------------------------------------------------- paid items
def paid_items(invoices: DataFrame, items: DataFrame, cfg: FunnelConfig,
               item_types=("drug", "lab")) -> DataFrame:
    """DISTINCT (encounter_id, type, type_id) over live paid invoices' live items.

    Items are folded per (invoice, type, item) before the join, so an invoice that
    lists an item very often brings one row.
    """
    inv = (since(live(invoices), cfg.sub_start).filter(F.col("status") == "paid")
           .select(F.col("id").alias("_inv"), F.col(ENC)))
    it = (live(items).filter(F.col("type").isin(*item_types) & F.col("invoice_id").isNotNull())
          .select("invoice_id", "type", "type_id").distinct())
    return (it.join(inv, it.invoice_id == inv._inv, "inner")
            .select(ENC, "type", "type_id").dropDuplicates([ENC, "type", "type_id"]))


# ---------------------------------------------------------------- order rollups
def item_order_rollup(orders: DataFrame, item_col: str, paid: DataFrame | None, cfg: FunnelConfig,
                      inventory: DataFrame | None = None, count_col: str | None = None) -> DataFrame:
    """Drug / lab order rollup per encounter.

    Orders are first pre-aggregated per (encounter, item): the tier flags are
    MAX aggregates and the paid / serviceable lookups depend only on that pair,
    so the result equals the row-level rollup while duplicates of a hot pair are
    combined map-side. The paid-items join then reuses the (encounter, item)
    partitioning, and one more aggregate rolls up to the encounter.
    """
    o = since(live(orders), cfg.sub_start)
    per_item = o.groupBy(ENC, item_col).agg(
        F.max(flag(is_rec())).alias("_rec"),
        F.max(flag(is_ess())).alias("_ess"),
        F.count(F.lit(1)).alias("_n"))
    if inventory is not None:
        inv = inventory.select(F.col("id").alias("_drug"), F.col("is_verified").alias("_verified"))
        per_item = per_item.join(inv, per_item[item_col] == F.col("_drug"), "left")
    if paid is not None:
        p = paid.select(F.col(ENC).alias("_penc"), F.col("type_id").alias("_pitem"), F.lit(1).alias("_paid"))
        per_item = per_item.join(p, (per_item[ENC] == p._penc) & (per_item[item_col] == p._pitem), "left")
        paid_c = F.coalesce(F.col("_paid"), F.lit(0))
    else:
        paid_c = F.lit(0)
    aggs = []
    if inventory is not None:
        aggs.append(F.min(F.coalesce(F.col("_verified"), F.lit(0))).alias("all_svc"))
    if count_col:
        aggs.append(F.sum("_n").alias(count_col))
    aggs += [
        F.max("_rec").alias("has_rec"),
        F.max("_ess").alias("has_ess"),
        F.max(flag((F.col("_rec") == 1) & (paid_c == 1))).alias("rec_paid"),
        F.max(flag((F.col("_ess") == 1) & (paid_c == 1))).alias("ess_paid"),
    ]
    return per_item.groupBy(ENC).agg(*aggs)


def drug_rollup(drug_orders: DataFrame, inventory: DataFrame, paid: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """encounter_id, all_svc, has_rec, has_ess, rec_paid, ess_paid; `paid` from `paid_items`."""
    return item_order_rollup(drug_orders, "drug_id", paid.filter(F.col("type") == "drug"), cfg,
                             inventory=inventory)


def lab_rollup(lab_orders: DataFrame, paid: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """encounter_id, n, has_rec, has_ess, rec_paid, ess_paid; `paid` from `paid_items`."""
    return item_order_rollup(lab_orders, "lab_test_id", paid.filter(F.col("type") == "lab"), cfg, count_col="n")


def therapy_rollup(therapy_orders: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """Therapy orders: purchase = the order was consumed (remaining < quantity)."""
    t = (since(live(therapy_orders), cfg.sub_start)
         .filter(F.col("consultation_id") == F.lit(cfg.therapy_id)))
    consumed = F.col("remaining_quantity") < F.col("quantity")
    return t.groupBy(ENC).agg(
        F.max(flag(consumed)).alias("consumed"),
        F.max(flag(is_rec())).alias("has_rec"),
        F.max(flag(is_ess())).alias("has_ess"),
        F.max(flag(is_rec() & consumed)).alias("rec_paid"),
        F.max(flag(is_ess() & consumed)).alias("ess_paid"))


# ---------------------------------------------------------------- invoices
def invoice_flags(invoices: DataFrame, items: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """Per encounter: raised / paid flags for drug, lab and therapy invoice items.

    Items are first folded to one row per invoice (which kinds it carries), so
    the invoice join sees at most one row per invoice and inherits the
    invoice_id partitioning of that aggregate.
    """
    it = live(items)
    ther = (F.col("type") == "consultation") & (F.col("type_id") == F.lit(cfg.therapy_id))
    per_invoice = it.groupBy("invoice_id").agg(
        F.max(flag(F.col("type") == "drug")).alias("_drug"),
        F.max(flag(F.col("type") == "lab")).alias("_lab"),
        F.max(flag(ther)).alias("_ther"))
    inv = (since(live(invoices), cfg.sub_start).filter(F.col("status") != "cancelled")
           .select(F.col("id").alias("invoice_id"), ENC, (F.col("status") == "paid").alias("_is_paid")))
    j = per_invoice.join(inv, "invoice_id", "inner")
    paid = F.col("_is_paid")
    return j.groupBy(ENC).agg(
        F.max(flag((F.col("_drug") == 1) & paid)).alias("drug_paid"),
        F.max("_drug").alias("drug_inv"),
        F.max(flag((F.col("_lab") == 1) & paid)).alias("lab_paid"),
        F.max("_lab").alias("lab_inv"),
        F.max(flag((F.col("_ther") == 1) & paid)).alias("ther_paid"),
        F.max("_ther").alias("ther_inv"))


# ---------------------------------------------------------------- form answers
# reason column -> (question filter, ladder)
REASON_COLUMNS = {
    "meds_norx": ((L.TITLE_MEDS_SKIP,), L.MEDS_SKIP),
    "meds_norx_fb": (L.TITLES_NO_RX_NEEDED, L.NO_RX_NEEDED),
    "meds_noreq": ((L.TITLE_MEDS_NOT_REQUIRED,), L.MEDS_NOT_REQUIRED),
    "elig_reason": ((L.TITLE_ELIGIBILITY,), L.ELIGIBILITY),
    "tests_norx": ((L.TITLE_TESTS,), L.TESTS),
    "ther_norx": (L.TITLES_THERAPY, L.THERAPY),
}
OPTOUT_COLUMNS = {"opt_drug": "drug", "opt_lab": "lab_test", "opt_ther": "consultation", "opt_enc": "encounter"}
# every text column of the call row and the ladder its labels come from
LABEL_LADDERS = {**{c: lad for c, (_, lad) in REASON_COLUMNS.items()}, **{c: L.OPTOUT for c in OPTOUT_COLUMNS}}


def decode_labels(df: DataFrame, cols) -> DataFrame:
    """Replace integer label codes by their label strings."""
    return df.select(*[L.decode_label(LABEL_LADDERS[c], c).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def reason_pivot(form_answers: DataFrame, cfg: FunnelConfig, coded: bool = False) -> DataFrame:
    """Six reason labels per encounter: MAX(label) over the answers of each question.

    Aggregated as integer codes (hash aggregate); `coded=False` decodes at the end.
    """
    fa = (since(live(form_answers), cfg.sub_start).filter(F.col("title").isin(*L.REASON_TITLES))
          .select(ENC, "title", "value", F.lower(F.col("value")).alias("_lv")))
    t = F.col("title")
    aggs = [F.max(F.when(t.isin(*titles), L.ladder_code_column(lad, "value", "_lv"))).alias(col)
            for col, (titles, lad) in REASON_COLUMNS.items()]
    out = fa.groupBy(ENC).agg(*aggs)
    return out if coded else decode_labels(out, REASON_COLUMNS)


def recommendation_flags(tags: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """Per encounter: did decision support recommend a drug / lab / consultation."""
    tg = since(live(tags), cfg.sub_start).filter(F.col("tag_category") == "item")
    rec = F.col("dss_quantity") > 0

    def kind(k: str) -> Column:
        return F.max(flag((F.col("item_type") == k) & rec))

    return tg.groupBy(ENC).agg(kind("drug").alias("dss_drug"), kind("lab").alias("dss_lab"),
                               kind("consultation").alias("dss_ther"))


def optout_pivot(preferences: DataFrame, cfg: FunnelConfig, coded: bool = False) -> DataFrame:
    """Per encounter: bucketed opt-out reason per preference type (MAX label)."""
    p = (since(live(preferences), cfg.sub_start).filter(F.col("opt_out") == 1)
         .select(ENC, "preference_type", L.ladder_code_column(L.OPTOUT, "opt_out_reason").alias("_bucket")))
    pt = F.col("preference_type")
    out = p.groupBy(ENC).agg(*[F.max(F.when(pt == kind, F.col("_bucket"))).alias(col)
                               for col, kind in OPTOUT_COLUMNS.items()])
    return out if coded else decode_labels(out, OPTOUT_COLUMNS)


# ---------------------------------------------------------------- latest per key
def latest_per_key(df: DataFrame, key, order: list[Column]) -> DataFrame:
    """Top-1 row per key by `order` (ROW_NUMBER = 1).

    Catalyst plans this as a partial WindowGroupLimit before the shuffle, so a
    hot key is cut to one row per map partition before it is exchanged.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def _needles(cond) -> list[str]:
    if isinstance(cond, L.Has):
        return list(cond.needles)
    if isinstance(cond, (L.AnyOf, L.AllOf)):
        return [n for p in cond.parts for n in _needles(p)]
    raise TypeError("flag decomposition supports substring rules only")


def _cond_over_flags(cond, flags: dict[str, Column]) -> Column:
    if isinstance(cond, L.Has):
        out = None
        for n in cond.needles:
            out = flags[n] if out is None else (out | flags[n])
        return out
    parts = [_cond_over_flags(p, flags) for p in cond.parts]
    out = parts[0]
    for p in parts[1:]:
        out = (out & p) if isinstance(cond, L.AllOf) else (out | p)
    return out


def ordered_concat(df: DataFrame, key: str, order, text: str, out: str, sep: str = ",") -> DataFrame:
    """key, `out`: each group's texts that aren't NULL, joined in `order` (columns; NULL where there are none).

    Rows are dealt by key and sorted within their partition, which spills as a sort does; the sorted
    rows are then read as a stream, so a task holds one batch and the text it is joining, not a group's rows.
    """
    names = [order] if isinstance(order, str) else list(order)
    rows = df.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(names)], F.col(text).alias("_t"))
    kind = df.schema[key].dataType.simpleString()

    def join(batches):
        import pyarrow as pa
        held, parts, seen = None, [], False
        for batch in batches:
            keys, texts, done = batch.column(0).to_pylist(), batch.column(1).to_pylist(), ([], [])
            for k, t in zip(keys, texts):
                if seen and k != held:
                    done[0].append(held)
                    done[1].append(sep.join(parts) if parts else None)
                    parts = []
                held, seen = k, True
                if t is not None:
                    parts.append(t)
            if done[0]:
                yield pa.RecordBatch.from_arrays([pa.array(done[0], batch.column(0).type), pa.array(done[1], pa.string())], [key, out])
            last = batch.column(0).type
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([held], last), pa.array([sep.join(parts) if parts else None], pa.string())], [key, out])

    ordered = rows.repartition("_k").sortWithinPartitions("_k", *[F.col(f"_o{i}").asc_nulls_last() for i in range(len(names))])
    return ordered.select("_k", "_t").mapInArrow(join, f"`{key}` {kind}, `{out}` string")


def ladder_over_groups(df: DataFrame, key, text: str, ladder: L.Ladder, out: str) -> DataFrame:
    """Ladder over the comma-joined texts of each group, without building the string.

    The ladder's patterns contain no comma, so a pattern matches the joined text
    iff it matches one member text; the match test is therefore a per-pattern
    MAX of booleans, which is map-side combinable and bounded per group
    regardless of how many texts a group holds. A group of only NULL texts gets
    the ELSE label, as a NULL concatenation would. A ladder with a pattern that holds
    the separator is run on the joined text itself (in text order).
    """
    keys = [key] if isinstance(key, str) else list(key)
    needles = sorted({n for cond, _ in ladder.rungs for n in _needles(cond)})
    if any("," in n for n in needles):
        group = F.struct(*keys).alias("_g")
        joined = ordered_concat(df.select(group, F.col(text).alias("_text")), "_g", "_text", "_text", "_text")
        return joined.select("_g.*", L.ladder_column(ladder, "_text").alias(out))
    low = F.lower(F.col(text))
    aggs = [F.max(low.like(f"%{n}%") if "%" in n else low.contains(n)).alias(f"_f{i}")
            for i, n in enumerate(needles)]
    g = df.groupBy(*keys).agg(*aggs)
    return labels_from_flags(g, keys, needles, ladder, out)


def labels_from_flags(g: DataFrame, keys, needles, ladder: L.Ladder, out: str) -> DataFrame:
    flags = {n: F.col(f"_f{i}") for i, n in enumerate(needles)}
    lab = None
    for cond, label in ladder.rungs:
        c = _cond_over_flags(cond, flags)
        lab = F.when(c, F.lit(label)) if lab is None else lab.when(c, F.lit(label))
    return g.select(*keys, lab.otherwise(F.lit(ladder.otherwise)).alias(out))


def diagnosis_per_encounter(encounters: DataFrame, form_answers: DataFrame) -> DataFrame:
    """encounter_id, patient_id, created_at, diag_cat for live merged-rx encounters.

    Equivalent to bucketing the comma-joined diagnosis answers of each encounter
    (answers joined on the encounter, title containing "diagnosis").
    """
    enc = (live(encounters).filter(F.lower(F.col("type")).contains(L.MERGED_RX_NEEDLE))
           .select(F.col("id").alias(ENC), "patient_id", "created_at"))
    ans = (live(form_answers).filter(F.lower(F.col("title")).contains(L.DIAGNOSIS_TITLE_NEEDLE))
           .select(ENC, "value"))
    lab = ladder_over_groups(ans, ENC, "value", L.DIAGNOSIS, "diag_cat")
    return (enc.join(lab, ENC, "left")
            .select(ENC, "patient_id", "created_at",
                    F.coalesce(F.col("diag_cat"), F.lit(L.DIAGNOSIS.otherwise)).alias("diag_cat")))


def diagnosis_texts(encounters: DataFrame, form_answers: DataFrame) -> DataFrame:
    """encounter_id, diagnosis (its answers joined in text order), diag_cat of every live merged-rx encounter."""
    enc = (live(encounters).filter(F.lower(F.col("type")).contains(L.MERGED_RX_NEEDLE)).select(F.col("id").alias(ENC)))
    ans = (live(form_answers).filter(F.lower(F.col("title")).contains(L.DIAGNOSIS_TITLE_NEEDLE)).select(ENC, "value"))
    return (enc.join(ordered_concat(ans, ENC, "value", "value", "diagnosis"), ENC, "left")
            .select(ENC, "diagnosis", F.lower("diagnosis").alias("_lv"))
            .select(ENC, "diagnosis", L.ladder_column(L.DIAGNOSIS, "diagnosis", "_lv").alias("diag_cat")))


def latest_diagnosis(encounters: DataFrame, form_answers: DataFrame) -> DataFrame:
    """patient_id, diag_cat from each patient's latest live merged-rx encounter.

    "Latest" = created_at DESC with NULL first, then encounter id ascending, and it
    is chosen before looking at answers: a latest encounter without a diagnosis
    answer gives the ELSE label.
    """
    enc = (live(encounters).filter(F.lower(F.col("type")).contains(L.MERGED_RX_NEEDLE))
           .select(F.col("id").alias(ENC), "patient_id", "created_at"))
    latest = latest_per_key(enc, "patient_id",
                            [F.col("created_at").desc_nulls_first(), F.col(ENC).asc_nulls_last()])
    ans = (live(form_answers).filter(F.lower(F.col("title")).contains(L.DIAGNOSIS_TITLE_NEEDLE))
           .select(ENC, "value"))
    # only the answers of latest encounters matter: semi-join before the flag aggregate
    ans = ans.join(latest.select(ENC), ENC, "left_semi")
    lab = ladder_over_groups(ans, ENC, "value", L.DIAGNOSIS, "diag_cat")
    return (latest.join(lab, ENC, "left")
            .select("patient_id", F.coalesce(F.col("diag_cat"), F.lit(L.DIAGNOSIS.otherwise)).alias("diag_cat")))
