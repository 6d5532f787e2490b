"""Topic weights of a word as JSON text, `[{"0":0.5},{"1":0.25}]`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def encode_weights(entries: Column) -> Column:
    """`entries` is array<struct<topic, weight>>, written in its order."""
    return F.to_json(
        F.transform(entries, lambda e: F.create_map(e["topic"].cast("string"), e["weight"]))
    )


def decode_weights(text: Column) -> Column:
    """Back to array<struct<topic int, weight double>>."""
    maps = F.from_json(text, "array<map<string,double>>")
    return F.transform(
        maps,
        lambda m: F.struct(
            F.map_keys(m)[0].cast("int").alias("topic"),
            F.map_values(m)[0].alias("weight"),
        ),
    )
