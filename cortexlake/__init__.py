"""cortexlake: the data work behind an MRI image archive, as Spark jobs.

Catalog cleaning and object keys, orientation selection, distributed volume
decoding into a slice table, central-slice ranges, rotation and min-max
normalisation, per-axis metadata tables with slice links, and named image
cohorts with their JSON shapes and export manifests.
"""

from __future__ import annotations

import sys as _sys

try:
    # Functions shipped to Python workers (mapInPandas decoders) are pickled
    # by value, so executors need not have this package installed.
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

__version__ = "0.1.0"
