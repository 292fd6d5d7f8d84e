"""Name resolution of a stream of requests against a static index; nothing is kept between batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def resolve_stream(requests: DataFrame, name: str, index: DataFrame, entity: str) -> DataFrame:
    """Each request with the entities of its exact variant (a stream-static left join)."""
    known = index.filter("variant = 'exact'").select("key", F.col(entity))
    return requests.withColumn("key", T.normalize_name(F.col(name))).join(known, "key", "left")
