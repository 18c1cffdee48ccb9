"""Telemetry and event analytics on Spark: one library, five domain profiles."""

import sys

from pyspark import cloudpickle

from tidemark.profiles import PROFILES, Profile, resolve_profile
from tidemark.session import build_session, clear_scratch, materialize, scratch_path

# Functions of this package that run in tasks travel with the query, so it need
# not be installed on the executors, nor be on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "PROFILES",
    "Profile",
    "build_session",
    "clear_scratch",
    "materialize",
    "resolve_profile",
    "scratch_path",
]
