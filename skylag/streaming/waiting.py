"""Waiting for the answer to each request, with timers on event time."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from skylag.session import ship

MATCHED = "UUID string, ts timestamp, status string, Prediction double"
# What the processor gives; times are microseconds.
_DECIDED = "UUID string, at long, status string, kind int, Prediction double"
# What is held of a row, requests as kind 0. Predictions have a kind of their own, in
# their order: missing, a number, not a number.
_OPEN = ["UUID", "at", "kind", "Prediction"]
_MISSING, _NUMBER, _NAN = 1, 2, 3
# Ids are dealt over so many groups, each with one value of state.
GROUPS = 2048


class Waiting(StatefulProcessor):
    """What is open for a group of ids: requests not answered yet, and answers later than
    the watermark, the smallest prediction of each time.

    An answer is sure once the watermark has reached its time, for no earlier one can
    come; a request is given up once the watermark has reached the end of its
    wait. One timer stands at the next such time of the group, so an answer goes out as
    soon as it is sure and not at the end of the wait. Event-time state takes no time to
    live; the same timer drops answers nobody asked for.
    """

    def __init__(self, wait: int):
        self.wait = wait

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "rows binary, due long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        held, due = self._held()
        yield from self._decided([*held, *(part[_OPEN] for part in rows)], due, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        held, due = self._held()
        if due is not None and due <= expiredTimerInfo.getExpiryTimeInMs():
            due = None
        yield from self._decided(held, due, timerValues)

    def close(self) -> None:
        pass

    def _held(self) -> tuple[list, int | None]:
        import pyarrow as pa

        found = self.held.get()
        if found is None:
            return [], None
        return [pa.ipc.open_stream(bytes(found[0])).read_pandas()], found[1]

    def _keep(self, rows, due: int) -> None:
        import pyarrow as pa

        table = pa.Table.from_pandas(rows, schema=_arrow_schema(), preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        self.held.update((sink.getvalue().to_pybytes(), due))

    def _decided(self, parts, due, timers) -> Iterator:
        import pandas as pd

        sure = timers.getCurrentWatermarkInMs() * 1000
        rows = pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=_OPEN)
        rows = rows.astype({"at": "int64", "kind": "int64", "Prediction": "float64"})
        rows = rows.sort_values(["at", "kind", "Prediction"])
        asked = rows.loc[rows.kind == 0, ["UUID", "at"]].drop_duplicates()
        answers = rows[(rows.kind > 0) & rows.UUID.notna()].drop_duplicates(["UUID", "at"])
        # The earliest answer from the request's time on, within its wait.
        met = pd.merge_asof(
            asked, answers.assign(answered=answers["at"]), on="at", by="UUID", direction="forward", tolerance=self.wait
        )
        ok = met.answered <= sure
        over = ~ok & (met["at"] + self.wait <= sure)
        done = met[ok | over]
        if len(done):
            yield pd.DataFrame({
                "UUID": done.UUID, "at": done["at"], "status": ok[done.index].map({True: "OK", False: "WAIT"}),
                "kind": done.kind.where(ok, 0).astype("int32"), "Prediction": done.Prediction.where(ok, 0.0),
            })
        waiting = met.loc[~(ok | over), ["UUID", "at"]].assign(kind=0, Prediction=0.0)
        coming = answers.loc[answers["at"] > sure, _OPEN]
        ends = [int(end) for end in ((waiting["at"] + self.wait).min(), coming["at"].min()) if end == end]
        # The first whole millisecond that is not before the time.
        new = -(-min(ends) // 1000) if ends else None
        if due is not None and due != new:
            self.handle.deleteTimer(due)
        if new is None:
            self.held.clear()
            return
        if due != new:
            self.handle.registerTimer(new)
        self._keep(pd.concat([df for df in (waiting, coming) if len(df)])[_OPEN], new)


def _arrow_schema():
    import pyarrow as pa

    return pa.schema([("UUID", pa.string()), ("at", pa.int64()), ("kind", pa.int8()), ("Prediction", pa.float64())])


def wait_stream(
    requests: DataFrame, responses: DataFrame, wait: str = "20 seconds", lateness: str = "10 seconds",
    groups: int = GROUPS,
) -> DataFrame:
    """The rows of ``matching.match_stream``, by keyed state with timers.

    ``OK`` comes out when the watermark reaches the earliest answer, ``WAIT`` when it
    reaches the end of the wait. Rows without time are left out. Ids are dealt by a hash
    over ``groups``, so that state and timers are asked for a group at a time and not for
    each id; the state of a group is one value, as large as what is open for its ids
    within the wait and the lateness. A checkpoint keeps the number it began with.
    """
    spark = requests.sparkSession
    ship(spark)
    length = spark.range(1).select(F.expr(f"INTERVAL {wait}")).first()[0]
    micros = (length.days * 86_400 + length.seconds) * 1_000_000 + length.microseconds
    group = F.pmod(F.xxhash64("UUID"), F.lit(groups)).cast("int").alias("group")
    at = F.unix_micros("ts").alias("at")
    number = F.col("Prediction").cast("double")
    kind = F.when(number.isNull(), _MISSING).when(F.isnan(number), _NAN).otherwise(_NUMBER)
    plain = F.when(kind == _NUMBER, number).otherwise(0.0)
    asked = requests.where("ts is not null").withWatermark("ts", lateness)
    asked = asked.select(group, "UUID", "ts", at, F.lit(0).alias("kind"), F.lit(0.0).alias("Prediction"))
    answers = responses.where("ts is not null").withWatermark("ts", lateness)
    answers = answers.select(group, "UUID", "ts", at, kind.alias("kind"), plain.alias("Prediction"))
    decided = asked.union(answers).groupBy("group").transformWithStateInPandas(
        statefulProcessor=Waiting(micros), outputStructType=_DECIDED, outputMode="append", timeMode="EventTime"
    )
    found = F.when(F.col("kind") == _NUMBER, F.col("Prediction")).when(F.col("kind") == _NAN, F.lit(float("nan")))
    return decided.select("UUID", F.timestamp_micros("at").alias("ts"), "status", found.alias("Prediction"))
