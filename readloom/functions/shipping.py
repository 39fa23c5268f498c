"""Python code that runs in tasks, sent with the job."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def ship(module: str) -> None:
    """Send the functions of a module by value.

    Executors then need numpy, pandas and pyarrow, but not this package. Such
    functions may use those libraries and their own module, nothing else here.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module])
