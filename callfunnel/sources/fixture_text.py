"""Labelled test phrases used by the adapter views (our fixtures, not source data).

`phrases`: per family NULL first (index 0), then one phrase per ladder rung, then order and NULL
traps; the adapter picks one by index arithmetic on the driver tables. `probes`: per ladder the
family's phrases and one text for every alternative pattern of every rung. They are in a JSON file
because the oracle, which imports nothing from this package, reads the same inputs.
"""

import json
import os

with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixture_text.json"), encoding="utf-8") as _f:
    _DATA = json.load(_f)

TITLES: list = _DATA["titles"]            # (title, family) by title number
PHRASES: dict = _DATA["phrases"]
CALL_TYPES: list = [tuple(x) for x in _DATA["call_types"]]
PROBES: dict = _DATA["probes"]
