"""callfunnel: call-level conversion funnel analytics as Spark DataFrame operators.

Layout
------
sources/    logical table schemas, readers, adapters over the test tables, sinks
functions/  Column builders: rule ladders, time buckets, predicates
operators/  DataFrame -> DataFrame operators (rollups, call assembly, status,
            funnel, cells, encoding, checks, sized joins)
plans/      composed refresh plans (one computation of the call table, four outputs)
streaming/  (intentionally empty: the analysed workload is batch only)
"""

from callfunnel.config import FunnelConfig

__all__ = ["FunnelConfig"]
