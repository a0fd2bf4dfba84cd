"""ledgerlink: match purchase records to an emission-factor catalogue and
account for them, as ordinary Spark DataFrame jobs.

Layout
------
functions/  column expressions (text cleaning, dates, vectors, JSON)
sources/    scans, rate and index tables, catalogues, sinks, stage cache
operators/  relational helpers, money, similarity search, matching,
            clustering, imputation, profiling, translation
plans/      bindings to the test tables, registered queries, oracle SQL
streaming/  incremental (availableNow) enrichment of new purchase files
"""

import sys as _sys


def _pickle_by_value() -> None:
    """Ship this package's code inside task closures (``mapInPandas`` and
    ``applyInPandas`` functions) instead of by import, so Python workers need
    no installed or path-visible copy of the package."""
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(_sys.modules[__name__])
    except Exception:  # pragma: no cover - older pickler: rely on import
        pass


_pickle_by_value()

from ledgerlink.session import build_session, checkpoint_dir  # noqa: E402,F401
from ledgerlink.spec import JobSpec  # noqa: E402,F401

__all__ = ["build_session", "checkpoint_dir", "JobSpec"]
