"""corpusloom: corpus and next-token-model data work as Spark DataFrame jobs.

Layout
------
functions/  Column-level building blocks (cleaning regexes, hashing, scans).
sources/    Readers and writers (text files, Parquet, artifacts, manifests).
operators/  DataFrame -> DataFrame operators (tokenizers, sequences, count
            model, sampling, generation, run analytics).
streaming/  Structured Streaming jobs (generation requests, live monitor).
plans/      Derived inputs built from the driver tables and the registered
            queries with their SQL oracles.
"""

__all__ = ["__version__"]
__version__ = "0.1.0"

# Ship this package's functions with the tasks (pickled by value), so Python
# workers on any executor can run them without the package being installed.
try:  # pragma: no cover - depends on the pyspark build
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
