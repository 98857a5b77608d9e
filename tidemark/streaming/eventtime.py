"""Event-time state in Spark's state store, with late rows kept beside it.

A watermark bounds state but drops what comes after it. Here the *intake* decides what
is late before the engine sees it: an epoch's frontier is the highest event time of all
earlier epochs less the allowed lateness. Rows before the frontier (or without a time)
are late and go to a side table; all others carry the frontier as their ``clock``. The
engine's watermark never passes this frontier, so it drops nothing; state is given up
as the watermark moves, because every row that is on time lies after it.

What involves late rows is worked out once, in the epoch that brings the last of the
rows concerned, from the stored rows of the time range it can reach. Results are the
engine's and these: reading them does not depend on how many batches there were.

A *cycle* runs the intake over what is available and then the engine over what the
intake stored, each with its own checkpoint. An epoch that is replayed after a crash
writes the same rows to the same place before the engine reads on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.streaming.flows import start

# Clocks begin here, after the engine's first watermark; rows before it are late.
FIRST = "1970-01-02 00:00:00"


def _read(spark: SparkSession, path: str, base: str | None = None) -> DataFrame | None:
    """The table at ``path``, or None before anything was written there."""
    try:
        reader = spark.read if base is None else spark.read.option("basePath", base)
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


class Intake:
    """Stored rows of one or more event streams, split into on time and late.

    ``at`` is the event time and ``side`` names the stream a row is of, if there are several. ``late_step(session,
    epoch)`` runs once per epoch, after its rows are stored."""

    def __init__(
        self, root: str, schema, at: str, lateness: str, late_step: Callable[[SparkSession, int], None] | None = None
    ):
        self.root, self.schema, self.at, self.lateness, self._late_step = root, schema, at, lateness, late_step

    def _frontier_path(self, epoch: int) -> str:
        return f"{self.root}/frontier/epoch={epoch:09d}"

    def sink(self, batch: DataFrame, epoch: int) -> None:
        """Store a micro-batch; the same epoch again overwrites itself."""
        spark = batch.sparkSession
        before = _read(spark, self._frontier_path(epoch - 1)) if epoch else None
        first = F.lit(FIRST).cast("timestamp")
        frontier = before.first()["frontier"] if before is not None else None
        clock = first if frontier is None else F.greatest(F.lit(frontier).cast("timestamp"), first)
        at = F.col(self.at).cast("timestamp")
        seen = Observation()
        rows = batch.withColumns({"clock": clock, "late": at.isNull() | (at < clock)})
        rows = rows.observe(seen, F.max(at - F.expr(f"INTERVAL {self.lateness}")).alias("reached"), F.count_if("late").alias("late"))
        rows.write.mode("overwrite").partitionBy("late").parquet(f"{self.root}/rows/epoch={epoch:09d}")
        if self._late_step is not None:
            self._late_step(spark, epoch)
        reached = [t for t in (seen.get["reached"], frontier) if t is not None]
        after = spark.createDataFrame([(max(reached, default=None),)], "frontier timestamp")
        after.coalesce(1).write.mode("overwrite").parquet(self._frontier_path(epoch))

    def on_time_stream(self, spark: SparkSession, on_clock: bool = True) -> DataFrame:
        """What is on time, as a stream whose watermark is the clock, or that of its event times in column ``_at``.

        A cycle's engine reads whole epochs, so neither watermark passes a row that is on time."""
        schema = T.StructType([*self.schema.fields, T.StructField("clock", T.TimestampType())])
        stream = spark.readStream.schema(schema).parquet(f"{self.root}/rows/epoch=*/late=false")
        # A row at the watermark would be dropped, hence the millisecond.
        if on_clock:
            return stream.withWatermark("clock", "1 millisecond")
        return stream.withColumn("_at", F.col(self.at).cast("timestamp")).withWatermark("_at", f"{self.lateness} 1 MILLISECOND")

    def rows(self, spark: SparkSession, late: bool | None = None) -> DataFrame | None:
        """Stored rows with ``epoch`` and ``late``."""
        folder = {None: "*", True: "late=true", False: "late=false"}[late]
        rows = _read(spark, f"{self.root}/rows/epoch=*/{folder}", f"{self.root}/rows")
        return None if rows is None else rows.withColumn("late", F.col("late").cast("boolean"))


def cycle(stream: DataFrame, checkpoint: str, intake: Intake, engine: Callable[[SparkSession], DataFrame], path: str) -> StreamingQuery | None:
    """Store what is available, then run the engine over it; state and results carry on from the last cycle.

    Returns the engine's ended query, None before anything was on time."""
    spark = stream.sparkSession
    start(stream, f"{checkpoint}/intake", each=intake.sink).awaitTermination()
    if intake.rows(spark, late=False) is None:
        return None
    query = start(engine(spark), f"{checkpoint}/engine", path=path)
    query.awaitTermination()
    return query


def _span(df: DataFrame, at: Column):
    """Lowest and highest time, both None without rows."""
    return df.agg(F.min(at).alias("low"), F.max(at).alias("high")).first()


def late_pairs(
    spark: SparkSession, intake: Intake, epoch: int, left: Column, right: Column, on: str, bound: str, near: Column | None = None
) -> DataFrame | None:
    """Pairs that ``epoch`` completes and that hold a late row: same key, the right row up to ``bound`` after the left.

    ``left`` and ``right`` say which rows are on which side; the columns of the pairs are ``l`` and ``r``, structs of
    the rows. ``near`` narrows the condition. Stored rows are read in the time range that the new ones reach."""
    stored = intake.rows(spark)
    if stored is None:
        return None
    at, span = F.col(intake.at).cast("timestamp"), F.expr(f"INTERVAL {bound}")
    stored = stored.where((F.col("epoch") <= epoch) & at.isNotNull())
    now, late = F.col("epoch") == epoch, F.col("late")
    condition = F.col(f"l.{on}").eqNullSafe(F.col(f"r.{on}")) if near is None else F.col(f"l.{on}").eqNullSafe(F.col(f"r.{on}")) & near
    l_at, r_at = (F.col(f"{s}.{intake.at}").cast("timestamp") for s in "lr")
    condition = condition & (r_at >= l_at) & (r_at <= l_at + span)

    def meet(new_side: Column, new: Column, new_is_left: bool, other: Column) -> DataFrame | None:
        mine = stored.where(new_side & new)
        low, high = _span(mine, at)
        if low is None:
            return None
        reach = F.lit(low).cast("timestamp") - span, F.lit(high).cast("timestamp") + span
        others = stored.where((right if new_is_left else left) & other & at.between(*reach))
        a, b = (mine, others) if new_is_left else (others, mine)
        return a.select(F.struct("*").alias("l")).join(b.select(F.struct("*").alias("r")), condition)

    if stored.where(late).isEmpty():
        return None
    found = [
        meet(left, now & late, True, F.lit(True)),
        meet(right, now & late, False, ~(now & late)),
        meet(left, now & ~late, True, late & ~now),
        meet(right, now & ~late, False, late & ~now),
    ]
    found = [f for f in found if f is not None]
    return reduce(DataFrame.unionByName, found) if found else None


class StreamJoin:
    """Inner join of two streams in the state store: same key, the right row up to ``bound`` after the left one.

    Rows of both come in one stream with a column ``side`` ('left' or 'right'). They may arrive in any order and at any
    time; pairs with rows later than ``lateness`` are found in the stored rows. ``fields`` names the columns of a pair,
    as (side, column). Null keys do not join."""

    def __init__(self, root: str, schema, on: str, at: str, bound: str, lateness: str, fields: dict[str, tuple[str, str]]):
        self.root, self.on, self.at, self.bound, self.fields = root, on, at, bound, fields
        self.intake = Intake(f"{root}/in", schema, at, lateness, self._late)

    def _pair(self, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f"{'l' if side == 'left' else 'r'}.{c}").alias(name) for name, (side, c) in self.fields.items()])

    def _late(self, spark: SparkSession, epoch: int) -> None:
        is_left, is_right = (F.col("side") == s for s in ("left", "right"))
        found = late_pairs(spark, self.intake, epoch, is_left, is_right, self.on, self.bound, F.col(f"l.{self.on}").isNotNull())
        if found is not None:
            self._pair(found).write.mode("overwrite").parquet(f"{self.root}/late/epoch={epoch:09d}")

    def engine(self, spark: SparkSession) -> DataFrame:
        span = F.expr(f"INTERVAL {self.bound}")

        def one(name: str) -> DataFrame:
            # The state is given up by the column that has the watermark, so here it is the event time.
            stream = self.intake.on_time_stream(spark, on_clock=False).where(F.col("side") == name)
            needed = sorted({c for _, c in self.fields.values()} | {self.on})
            return stream.select(
                F.struct(*needed).alias(name[0]), F.col(self.on).alias(f"_{name}_on"), F.col("_at").alias(f"_{name}_at")
            )

        l_at, r_at = F.col("_left_at"), F.col("_right_at")
        near = (F.col("_left_on") == F.col("_right_on")) & (r_at >= l_at) & (r_at <= l_at + span)
        return self._pair(one("left").join(one("right"), near))

    def cycle(self, stream: DataFrame) -> StreamingQuery | None:
        return cycle(stream, f"{self.root}/state", self.intake, self.engine, f"{self.root}/pairs")

    def read(self, spark: SparkSession) -> DataFrame | None:
        """All pairs so far; nothing is joined here."""
        parts = [_read(spark, f"{self.root}/pairs"), _read(spark, f"{self.root}/late")]
        parts = [p.select(*self.fields) for p in parts if p is not None]
        return reduce(DataFrame.unionByName, parts) if parts else None


def _saved(rows: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema) as writer:
        writer.write_table(rows)
    return out.getvalue().to_pybytes()


def _restored(state: GroupState) -> list[pa.Table]:
    return [pa.ipc.open_stream(state.get[0]).read_all()] if state.exists else []


class FirstPerId:
    """The first event per id in event time, from a stream with repeats.

    Ids in flight are kept in the state store, a hash bucket of them per state, until ``within`` after their first event: the
    span in which repeats may come. Late rows, and what is still in flight, are laid over on reading, so an id is there
    once however its events arrived, unless a repeat follows after ``within``. Equal times go by the other columns;
    events without a time come last."""

    def __init__(self, root: str, schema, id: str, at: str, within: str, lateness: str, buckets: int = 256):
        self.root, self.id, self.at, self.within, self.buckets = root, id, at, within, buckets
        self.columns = schema.names
        self.intake = Intake(f"{root}/in", schema, at, lateness)

    def engine(self, spark: SparkSession) -> DataFrame:
        stream, id, columns = self.intake.on_time_stream(spark), self.id, self.columns
        at = F.col(self.at).cast("timestamp")
        stream = stream.withColumns(
            {
                "_bucket": F.pmod(F.xxhash64(id), F.lit(self.buckets)).cast("int"), "_at": F.unix_micros(at),
                "_until": F.unix_micros(at + F.expr(f"INTERVAL {self.within}")),
            }
        )
        order = ["_at"] + [c for c in columns if c != self.at]

        def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
            known = _restored(state)
            rows = pd.concat([t.to_pandas(timestamp_as_object=False) for t in known] + list(batches), ignore_index=True)
            rows = rows.sort_values(order, na_position="first", kind="stable").drop_duplicates(id)
            done = rows["_until"] <= state.getCurrentWatermarkMs() * 1000
            left = rows[~done]
            if len(left):
                state.update((_saved(pa.Table.from_pandas(left, preserve_index=False)),))
                state.setTimeoutTimestamp(int(-(-int(left["_until"].min()) // 1000)))
            else:
                state.remove()
            yield rows.loc[done, [*columns, "_until"]]

        kept = stream.select("_bucket", *columns, "_at", "_until", "clock")
        out = stream.select(*columns, "_until").schema
        return kept.groupBy("_bucket").applyInPandasWithState(step, out, "rows binary", "append", GroupStateTimeout.EventTimeTimeout)

    def cycle(self, stream: DataFrame) -> StreamingQuery | None:
        return cycle(stream, f"{self.root}/state", self.intake, self.engine, f"{self.root}/first")

    def read(self, spark: SparkSession) -> DataFrame | None:
        """One row per id so far."""
        closed, late = _read(spark, f"{self.root}/first"), self.intake.rows(spark, late=True)
        open_ = self.intake.rows(spark, late=False)
        last = closed.agg(F.max("_until")).first()[0] if closed is not None else None
        if open_ is not None and last is not None:
            at = F.col(self.at).cast("timestamp")
            # Ids close in the order of this time, all of a time together.
            open_ = open_.where(at > F.timestamp_micros(F.lit(last)) - F.expr(f"INTERVAL {self.within}"))
        fresh = [d.select(*self.columns) for d in (open_, late) if d is not None]
        if not fresh:
            return None
        fresh = reduce(DataFrame.unionByName, fresh)
        if closed is not None:
            ids = fresh.select(F.col(self.id).alias("_touched")).distinct()
            same = F.col(self.id).eqNullSafe(F.col("_touched"))
            fresh = fresh.unionByName(closed.join(ids, same, "left_semi").select(*self.columns))
            closed = closed.join(ids, same, "left_anti").select(*self.columns)
        rest = [c for c in self.columns if c != self.at]
        place = F.struct(F.col(self.at).isNull().alias("_untimed"), F.col(self.at), *rest)
        first = fresh.groupBy(F.col(self.id).alias("_id")).agg(F.min(place).alias("_first"))
        first = first.select(*[F.col("_first")[c].alias(c) for c in self.columns])
        return first if closed is None else first.unionByName(closed)


class TrailingSum:
    """For each event the sum of ``amount`` over the events of its key in the ``length`` seconds up to it, on a stream.

    An event at the start of the window's far end is outside, one of equal time is inside up to the own ``id``. State holds
    one time tile of one key, so a hot key is many states; an event also goes to the next tile, which it can reach. A tile is
    summed when the clock has passed it. Sums that late rows change are corrected by what the late rows add, and tiles still
    open are summed on reading. ``amount`` is a whole number."""

    def __init__(self, root: str, schema, key: str, id: str, at: str, amount: str, length: int, lateness: str):
        self.root, self.key, self.id, self.at, self.amount, self.length = root, key, id, at, amount, length
        self.intake = Intake(f"{root}/in", schema, at, lateness, self._late)

    def _reached(self, spark: SparkSession, epoch: int) -> DataFrame | None:
        """The rows of which ``epoch`` completes sums with a late row, with ``_now``; None without any."""
        stored = self.intake.rows(spark)
        if stored is None:
            return None
        at, span = F.col(self.at).cast("timestamp"), F.expr(f"INTERVAL {self.length} SECONDS")
        stored = stored.where((F.col("epoch") <= epoch) & at.isNotNull()).withColumn("_now", F.col("epoch") == epoch)
        now, late = F.col("_now"), F.col("late")
        if stored.where(late).isEmpty():
            return None

        def near(rows: Column) -> Column:
            low, high = _span(stored.where(rows), at)
            if low is None:
                return F.lit(False)
            return at.between(F.lit(low).cast("timestamp") - span, F.lit(high).cast("timestamp") + span)

        # New rows on time matter beside earlier late ones only, and these beside any new row.
        return stored.where((now & late) | near(now & late) | (now & near(late & ~now)) | (late & ~now & near(now & ~late)))

    def _late(self, spark: SparkSession, epoch: int) -> None:
        """What rows add to each other where one of the two is late and one new, as differences of running sums per tile."""
        reached = self._reached(spark, epoch)
        if reached is None:
            return
        width = self.length * 1_000_000

        def added(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
            rows = rows.sort_by([("_t", "ascending"), ("_id", "ascending")])  # null ids last
            t, tile = rows["_t"].to_numpy(), key[1].as_py()
            own, now, late = (rows[c].to_numpy(zero_copy_only=False).astype(bool) for c in ("_mine", "_now", "late"))
            known = rows["_amount"].is_valid().to_numpy(zero_copy_only=False)
            amount = rows["_amount"].fill_null(0).to_numpy()
            named = rows["_id"].is_valid().to_numpy(zero_copy_only=False)
            code = rows["_id"].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            # A row's sum ends with the last of its time and id; one without an id takes earlier times only.
            start = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (code[1:] != code[:-1])])
            run_end = np.r_[start[1:], len(t)]
            last = np.where(named, np.repeat(run_end, np.diff(np.r_[start, len(t)])), np.searchsorted(t, t, "left"))
            first = np.minimum(np.searchsorted(t, t - width, "right"), last)
            total, pairs, values = (np.zeros(len(t), np.int64) for _ in range(3))
            every = np.ones(len(t), bool)
            for mine, others in ((now & late, every), (now & ~late, late), (~now & late, now), (~now & ~late, now & late)):
                for out, value in ((total, amount * others), (pairs, others), (values, others & known)):
                    sums = np.concatenate([[0], np.cumsum(value, dtype=np.int64)])
                    out[mine] = (sums[last] - sums[first])[mine]
            kept = own & (pairs > 0)
            trailing = pa.array(total[kept], pa.int64(), mask=values[kept] == 0)
            return pa.table({"id": rows["_id"].filter(pa.array(kept)), "trailing": trailing})

        tiled = self._tiled(reached).select("_key", "_tile", (F.col("_own") == F.col("_tile")).alias("_mine"), "_t", "_id", "_amount", "_now", "late")
        schema = f"id {dict(tiled.dtypes)['_id']}, trailing long"
        found = tiled.groupBy("_key", "_tile").applyInArrow(added, schema).groupBy("id").agg(F.sum("trailing").alias("trailing"))
        found.write.mode("overwrite").parquet(f"{self.root}/late/epoch={epoch:09d}")

    def _tiled(self, rows: DataFrame) -> DataFrame:
        micros, width = F.unix_micros(F.col(self.at).cast("timestamp")), self.length * 1_000_000
        own = F.floor(micros / width)
        rows = rows.withColumns({"_key": F.col(self.key), "_own": own, "_t": micros, "_id": F.col(self.id), "_amount": F.col(self.amount).cast("long")})
        return rows.withColumn("_tile", F.explode(F.array("_own", F.col("_own") + 1)))

    def engine(self, spark: SparkSession) -> DataFrame:
        width = self.length * 1_000_000

        def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
            tile = int(key[1])
            columns = ["_own", "_t", "_id", "_amount"]
            rows = pd.concat([t.to_pandas() for t in _restored(state)] + [b[columns] for b in batches], ignore_index=True)
            closes = (tile + 1) * width
            if closes > state.getCurrentWatermarkMs() * 1000:
                state.update((_saved(pa.Table.from_pandas(rows, preserve_index=False)),))
                state.setTimeoutTimestamp(-(-closes // 1000))
                return
            state.remove()
            rows = rows.sort_values(["_t", "_id"], ignore_index=True)
            t, total = rows["_t"].to_numpy(), np.concatenate([[0], np.cumsum(rows["_amount"].to_numpy())])
            sums = total[1:] - total[np.searchsorted(t, t - width, "right")]
            own = (rows["_own"] == tile).to_numpy()
            yield pd.DataFrame({"id": rows["_id"][own], "trailing": sums[own], "_closes": closes})

        tiled = self._tiled(self.intake.on_time_stream(spark)).select("_key", "_tile", "_own", "_t", "_id", "_amount", "clock")
        schema = f"id {dict(tiled.dtypes)['_id']}, trailing long, _closes long"
        return tiled.groupBy("_key", "_tile").applyInPandasWithState(step, schema, "rows binary", "append", GroupStateTimeout.EventTimeTimeout)

    def cycle(self, stream: DataFrame) -> StreamingQuery | None:
        return cycle(stream, f"{self.root}/state", self.intake, self.engine, f"{self.root}/sums")

    def read(self, spark: SparkSession, sums: Callable[[DataFrame], DataFrame]) -> DataFrame | None:
        """``id`` and ``trailing`` of all events so far that have a time.

        ``sums`` gives ``id`` and ``trailing`` for a batch of stored rows: it is applied to the tiles still open."""
        closed, late = _read(spark, f"{self.root}/sums"), _read(spark, f"{self.root}/late")
        rows = self.intake.rows(spark, late=False)
        last = closed.agg(F.max("_closes")).first()[0] if closed is not None else None
        parts = [closed.select("id", "trailing")] if closed is not None else []
        if rows is not None:
            micros = F.unix_micros(F.col(self.at).cast("timestamp"))
            recent = rows if last is None else rows.where(micros > last - self.length * 1_000_000)
            tail = sums(recent)
            if last is not None:
                tail = tail.join(recent.where(micros >= last).select(F.col(self.id).alias("id")), "id", "left_semi")
            parts.append(tail)
        if late is not None:
            parts.append(late.select("id", "trailing"))
        if not parts:
            return None
        # Only events that late rows reach have more than one part.
        return reduce(DataFrame.unionByName, parts).groupBy("id").agg(F.sum("trailing").alias("trailing"))
