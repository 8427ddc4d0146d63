"""For applications that do not install this package on their executors."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def ship_by_value() -> None:
    """Let functions that run in tasks travel with the job, so that workers need no copy.

    An application calls this once. It changes how this process pickles the package's functions;
    with ``--py-files`` or an installed package it is not needed.
    """
    cloudpickle.register_pickle_by_value(sys.modules["millrace"])
