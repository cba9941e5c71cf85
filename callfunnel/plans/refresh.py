"""One funnel refresh: the call table computed once, every output derived from it.

The analysed pipeline sends the same 13-table CTE chain to the warehouse four
times (three tabs + the funnel). Here the call table is built once, written as
Parquet under the session's checkpoint directory (a shared folder on a cluster)
and read back: lineage is cut, a lost executor only recomputes from that table,
and the outputs scan a narrow columnar table with pruning. The two grains and
the cells, which several outputs read, are written the same way.

With the release before at hand, grains and cells are computed for the weeks whose
calls changed, and taken from that release for the others. Jobs that don't need
each other's results run side by side.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callfunnel.config import FunnelConfig
from callfunnel.operators import calls as C
from callfunnel.operators import cells as CE
from callfunnel.operators import funnel as FN
from callfunnel.operators import status as S
from callfunnel.operators.status import GRAIN
from callfunnel.session import discard, materialize
from callfunnel.sources import publish as P
from callfunnel.sources import release as RL
from callfunnel.sources.tables import Tables

#: Tables kept week by week, and the keys that their rows are ordered by.
WEEKLY = {"tab_grain": GRAIN, "funnel_grain": GRAIN, "grain_cells": GRAIN, "grain_reason_counts": GRAIN,
          "cell_envelope": GRAIN}
ORDERED = {"rows": P.POSITIONS, "er": P.POSITIONS}


def side_by_side(spark: SparkSession, *jobs):
    """Results of the jobs (functions without arguments), run at the same time; the first failure is raised."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [r.result() for r in running]


@dataclass
class RefreshOutputs:
    calls: DataFrame
    tabs: DataFrame
    funnel: DataFrame
    cells: DataFrame
    reasons: DataFrame
    envelope: DataFrame
    totals: DataFrame
    metrics: DataFrame
    encoded: P.Encoded
    digests: dict[str, str]
    kept: dict[str, str] = field(default_factory=dict)      # unchanged week -> the release that holds it
    stores: list[DataFrame] = field(default_factory=list)

    def tables(self) -> dict[str, DataFrame]:
        return {"tab_grain": self.tabs, "funnel_grain": self.funnel, "grain_cells": self.cells,
                "grain_reason_counts": self.reasons, "cell_envelope": self.envelope,
                "reconcile_totals": self.totals, "weekly_metrics": self.metrics,
                "rows": self.encoded.rows, "er": self.encoded.er, "dim_weeks": self.encoded.weeks,
                "dim_providers": self.encoded.providers, "reasons": self.encoded.reasons}

    def release(self) -> None:
        """Delete the intermediate tables, once the outputs are published or no longer needed."""
        discard(*self.stores, *self.encoded.stored)


def refresh(spark: SparkSession, t: Tables, cfg: FunnelConfig, previous: RL.Release | None = None) -> RefreshOutputs:
    """All outputs; weeks whose calls are those of the `previous` release are read from it."""
    calls = materialize(C.calls_with_diagnosis(t, cfg), "calls")
    digests = RL.week_digests(calls)
    kept = {w: previous.weeks[w][1] for w, d in digests.items() if previous and previous.weeks.get(w, ("", ""))[0] == d}
    new = calls.filter(~F.col("wk").isin(list(kept))) if kept else calls
    tabs, funnel = side_by_side(spark, lambda: materialize(S.tabs_grain(new), "tabs"), lambda: materialize(FN.funnel_grain(new), "funnel"))
    cells, reasons = side_by_side(spark, lambda: materialize(CE.grain_cells(tabs), "cells"), lambda: materialize(CE.grain_reason_counts(tabs), "reasons"))
    stores = [calls, tabs, funnel, cells, reasons]
    if kept:
        whole = lambda name, df: previous.table(spark, name, set(kept)).select(df.columns).unionByName(df)
        tabs, funnel = whole("tab_grain", tabs), whole("funnel_grain", funnel)
        cells, reasons = whole("grain_cells", cells), whole("grain_reason_counts", reasons)
    return RefreshOutputs(
        calls=calls, tabs=tabs, funnel=funnel, cells=cells, reasons=reasons,
        envelope=CE.cell_envelope(cells), totals=CE.reconcile_totals(tabs),
        metrics=CE.weekly_metrics(cells), encoded=P.encode_outputs(cells, reasons, funnel),
        digests=digests, kept=kept, stores=stores)


def check_totals(out: RefreshOutputs) -> str:
    """Fails on drift above tolerance (tabs share one call table, so drift is 0)."""
    row = out.totals.first()
    if row.status == "fail":
        raise AssertionError(f"call totals differ across tabs: {row.asDict()}")
    return row.status


def publish(spark: SparkSession, out: RefreshOutputs, out_root: str, updated: DataFrame,
            prefix: str = P.DOC_PREFIX, secret: str | None = None) -> RL.Release:
    """Write a release: the tables, then the page document built from them; it becomes current at the end.

    Nothing is written if the tabs' totals drift apart, and a failed write leaves the release before
    in place. Of weekly tables only the changed weeks are written. With a `secret` the document is
    written encrypted instead of plain. It reads back `rows`, `er` and the dimension tables, so
    each output is computed exactly once.
    """
    check_totals(out)
    release = RL.begin(spark, out_root)
    folder = release.folder()
    release.weeks = {w: (d, out.kept.get(w, release.id)) for w, d in out.digests.items()}
    changed = [w for w in out.digests if w not in out.kept]
    jobs = []
    for name, df in out.tables().items():
        weekly = name in WEEKLY
        release.tables[name] = (df.schema.json(), weekly)
        some = df.filter(F.col("wk").isin(changed)) if weekly and out.kept else df
        jobs.append(lambda df=some, path=f"{folder}/tables/{name}", keys=WEEKLY.get(name, ORDERED.get(name, ())), weekly=weekly:
                    P.write_table(df, path, keys, weekly))
    side_by_side(spark, *jobs)
    rd = lambda name: release.table(spark, name)
    written = P.Encoded(rows=rd("rows"), er=rd("er"), weeks=rd("dim_weeks"), providers=rd("dim_providers"),
                        reasons=rd("reasons"))
    lines = P.document_lines(written, updated, prefix)
    if secret:
        P.write_protected(lines, f"{folder}/protected", secret)
    else:
        P.write_document(lines, f"{folder}/document")
    RL.switch(spark, release)
    return release
