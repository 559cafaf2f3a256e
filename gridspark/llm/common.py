"""What the operators share: the pattern of words, joins of a checked size, and
the written tables and connected components of the library."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gridspark.operators.components import connected_components
from gridspark.sources.bounded import join_bounded
from gridspark.sources.staging import new_path, written

__all__ = ["SPACE", "WORD", "connected_components", "free", "in_small_batches", "join_bounded", "new_path", "written"]

#: ASCII white space, the only separator of words: 0x20 and 0x09 to 0x0D.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until df has no such column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


#: Bytes that an Arrow batch of texts holds at most (one row may hold more).
BATCH_BYTES = 16 << 20


def in_small_batches(df: DataFrame) -> DataFrame:
    """df, in a session that hands Python at most BATCH_BYTES at once (a lower
    bound that is set already stays), so that long texts don't add up."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = conf.get(key).removesuffix("b")
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))
    return df
