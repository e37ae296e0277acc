"""Objects of this package for tasks on executors that have no copy of it."""

from __future__ import annotations

import pickle
from typing import Any

from pyspark import Broadcast, cloudpickle
from pyspark.sql import SparkSession


def ship(spark: SparkSession, value: Any) -> Broadcast:
    """A broadcast of `value` in a form that carries its classes along."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shipped(parcel: Broadcast) -> Any:
    """What `ship` was given; call it once per task."""
    return pickle.loads(parcel.value)
