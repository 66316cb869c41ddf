"""Language quotas of a stream as keyed state: ``transformWithState`` with a share of the state per salt."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessorHandle

#: Parts of a language, each with a state of its own.
SALTS = 16
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FirstRows(StatefulProcessor):
    """Passes the first ``quota`` rows of its key on, over all batches; the state is how many it has passed on.

    Of one batch those with the smallest positions are first. At most ``quota`` rows are held, however many arrive.
    """

    def __init__(self, quota: int, pos: str, columns: list[str]):
        self.quota, self.pos, self.columns = quota, pos, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.taken = handle.getValueState("taken", "n bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = self.taken.get()[0] if self.taken.exists() else 0
        left, best = self.quota - before, None
        for part in rows:
            if left > 0:
                both = part if best is None else pd.concat([best, part], ignore_index=True)
                best = both.nsmallest(left, self.pos)
        if best is not None and len(best):
            self.taken.update((before + len(best),))
            yield best[self.columns]

    def close(self) -> None:
        pass


def first_rows_of_languages(stream: DataFrame, quota: int, lang: str, pos: str, salts: int = SALTS) -> DataFrame:
    """The rows of each language in arrival order until its quota is full.

    A language may be most of the stream. Its rows are dealt over ``salts`` states first, each of which lets at most
    ``quota`` rows through in all; the state of the whole language then sees those alone, at most ``salts * quota`` rows
    in the life of the stream, and decides. A row among a language's first is among the first of its salt, so the
    answer is that of one state.
    """
    first, kind = FirstRows(quota, pos, stream.columns), stream.schema
    dealt = stream.withColumn("_salt", F.pmod(F.xxhash64(pos), F.lit(salts)).cast("int"))
    some = dealt.groupBy(lang, "_salt").transformWithStateInPandas(first, kind, "append", "none")
    return some.groupBy(lang).transformWithStateInPandas(first, kind, "append", "none")


def stream_quota_state(
    stream: DataFrame, path: str, checkpoint: str, quota: int, lang: str = "lang", pos: str = "pos", salts: int = SALTS
) -> StreamingQuery:
    """Append the accepted rows to parquet files, a plain append query whose state survives in the checkpoint.

    ``pos`` is a number, unique in its language and never NULL; a NULL language is a language. The state lives in RocksDB,
    which this kind of operator needs; the session's own provider is put back once the query has its copy of the settings.
    """
    spark = stream.sparkSession
    own = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        return (
            first_rows_of_languages(stream, quota, lang, pos, salts)
            .writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        if own is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, own)
