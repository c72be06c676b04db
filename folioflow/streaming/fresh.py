"""Contents computed only when they are new: keyed state with expiry in a stream.

A key's state is the digest it was last computed for and when. A row with that digest within the time to live is
skipped; any other is computed. A timer of event time after the end of the time to live takes the state away, so it holds
no key that is out of date, and what comes later is computed again. State lives in the checkpoint, across batches and
restarts."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..sources.tables import scratch, ship_code

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RETURNS = "key long, digest string, at timestamp, reason string"


#: Keys are held in this many shelves. Each call to the state goes through a socket, so the keys of a shelf are read and
#: written together; the number belongs to a checkpoint.
SHELVES = 1024


class Fresh(StatefulProcessor):
    """Rows (shelf, key, digest, at, us), us the microseconds of at. A shelf has the last (key, digest, us) of each of its
    keys and one timer, for the one that runs out first when it is set; when it goes off, what is out of date is taken
    away and the timer set anew for the rest."""

    def __init__(self, seconds: int):
        self.seconds = seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getListState("last", "key long, digest string, us long")

    def _expires(self, us: int) -> int:
        return -(-us // 1000) + 1000 * self.seconds

    def _timer(self, held: dict[int, tuple]) -> None:
        self.handle.registerTimer(self._expires(min(us for _, us in held.values())))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = {r[0]: (r[1], r[2]) for r in self.last.get()}
        timed, changed = bool(held), False
        for k, digest, us in sorted(((r.key, r.digest, r.us) for r in rows), key=lambda r: (r[2], r[1] is None, r[1] or "")):
            old = held.get(k)
            late = old is not None and us - old[1] >= 1000000 * self.seconds
            if old is None or late or old[0] != digest:
                yield Row(key=k, digest=digest, us=us, reason="new" if old is None else "expired" if late and old[0] == digest else "changed")
                held[k], changed = (digest, us), True
        if changed:
            self.last.put([(k, *v) for k, v in held.items()])
            if not timed:
                self._timer(held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now, held = timerValues.getCurrentWatermarkInMs(), {r[0]: (r[1], r[2]) for r in self.last.get()}
        left = {k: v for k, v in held.items() if self._expires(v[1]) > now}
        if left:
            if len(left) < len(held):
                self.last.put([(k, *v) for k, v in left.items()])
            self._timer(left)
        else:
            self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def computed(stream: DataFrame, seconds: int, delay: str, out: str, checkpoint: str) -> int:
    """Takes all that is new in a stream (key long, digest, at timestamp) through the state and writes what has to be
    computed under out, a folder a batch; the number of keys in the state at the end."""
    spark = stream.sparkSession
    ship_code(spark)
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        rows = stream.select("key", "digest", "at").withWatermark("at", delay).withColumns({"us": F.unix_micros("at"), "shelf": F.pmod(F.xxhash64("key"), F.lit(SHELVES)).cast("int")})
        found = rows.groupBy("shelf").transformWithState(Fresh(seconds), RETURNS.replace("at timestamp", "us long"), "append", "eventTime")
        found = found.select("key", "digest", F.timestamp_micros("us").alias("at"), "reason")
        query = found.writeStream.foreachBatch(lambda df, i: df.write.mode("overwrite").parquet(f"{out}/batch={i}")).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)
    seen = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    return seen[-1] if seen else 0


def results(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(f"{RETURNS}, batch int").parquet(out).drop("batch")


def folders(spark: SparkSession) -> tuple[str, str]:
    """New folders for the results and the checkpoint."""
    return scratch(spark, "fresh"), scratch(spark, "fresh-state")
