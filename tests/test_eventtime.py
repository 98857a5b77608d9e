"""Event-time flows: any order, restarts and replays lose nothing, and state is given up."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import windows
from tidemark.streaming import eventtime

START = dt.datetime(2024, 1, 1)


def deliver(spark, rows, schema, source):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)


def minutes(n):
    return START + dt.timedelta(minutes=n)


def state_rows(query):
    return sum(o["numRowsTotal"] for o in query.lastProgress["stateOperators"])


JOIN = "k long, id long, at timestamp, side string"


def plain_pairs(rows, bound):
    lefts, rights = ([r for r in rows if r[3] == s and r[2] is not None and r[0] is not None] for s in ("left", "right"))
    return sorted((a[1], b[1]) for a in lefts for b in rights if a[0] == b[0] and a[2] <= b[2] <= a[2] + dt.timedelta(minutes=bound))


@pytest.mark.parametrize("ordered", [True, False])
def test_join_finds_every_pair_once(spark, tmp_path, ordered):
    rng = random.Random(5)
    rows = [
        (rng.randrange(4) if i % 50 else None, i, minutes(rng.randrange(3000)) if i % 60 else None, rng.choice(["left", "right"])) for i in range(500)
    ]
    rows += [(1, 900, minutes(10), "left"), (1, 901, minutes(10), "right"), (1, 902, minutes(10), "right")]
    rows.sort(key=lambda r: (r[2] or START) if ordered else rng.random())
    source, root = str(tmp_path / "in"), str(tmp_path / "flow")
    fields = {"a": ("left", "id"), "b": ("right", "id")}
    states = []
    for part in range(6):
        # A new object each time: all there is lies under the root.
        join = eventtime.StreamJoin(root, spark.createDataFrame([], JOIN).schema, "k", "at", "30 MINUTES", "2 HOURS", fields)
        stream = deliver(spark, rows[part::6] if not ordered else rows[part * 84 : part * 84 + 84], JOIN, source)
        states.append(state_rows(join.cycle(stream)))
    assert sorted(map(tuple, join.read(spark).collect())) == plain_pairs(rows, 30)
    if ordered:  # state holds the last hours, not the history
        assert max(states[3:]) < 250


def test_join_replays_an_epoch_and_reads_without_joining(spark, tmp_path):
    rows = [(1, i, minutes(i * 100 % 997), "left" if i % 2 else "right") for i in range(60)]
    source, root = str(tmp_path / "in"), str(tmp_path / "flow")
    join = eventtime.StreamJoin(root, spark.createDataFrame([], JOIN).schema, "k", "at", "2 HOURS", "1 HOUR", {"a": ("left", "id"), "b": ("right", "id")})
    assert join.read(spark) is None
    for part in range(3):
        stream = deliver(spark, rows[part * 20 : part * 20 + 20], JOIN, source)
        join.cycle(stream)
        if part == 1:  # the sink sees its last epoch once more
            join.intake.sink(spark.createDataFrame(rows[20:40], JOIN), 1)
    found = join.read(spark)
    assert sorted(map(tuple, found.collect())) == plain_pairs(rows, 120)
    plan = found._jdf.queryExecution().toString()
    assert "Join" not in plan and "/rows/" not in plan


FIRST = "id string, at timestamp, n long"


def test_first_per_id(spark, tmp_path):
    rng = random.Random(6)
    rows = [(str(i % 90), minutes(i % 90 * 40 + rng.randrange(50)), i) for i in range(270)]
    rows += [(None, minutes(5), 1), (None, None, 2), ("untimed", None, 3), ("untimed", None, 2), ("0", None, 9)]
    rng.shuffle(rows)
    source, root = str(tmp_path / "in"), str(tmp_path / "flow")
    flow = eventtime.FirstPerId(root, spark.createDataFrame([], FIRST).schema, "id", "at", "2 HOURS", "6 HOURS", 4)
    assert flow.read(spark) is None
    far, want = dt.datetime(9999, 1, 1), {}
    for part in range(4):
        some = rows[part::4]
        if part == 3:
            some = some + [("last", minutes(90 * 40 + 2000), 0)]
        flow.cycle(deliver(spark, some, FIRST, source))
        for id, at, n in some:
            want[id] = min(want.get(id, (far, 10**9)), (at or far, n))
        got = flow.read(spark).collect()
        assert len(got) == len(want)
        assert {r.id: (r.at or far, r.n) for r in got} == want
    assert spark.read.parquet(f"{root}/first").count() > 30  # most are settled in the state store


EVENTS = "key string, id long, t long, amount long, at timestamp"


def test_trailing_sums_with_late_events(spark, tmp_path):
    rng = random.Random(7)
    epoch = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp())
    rows = []
    for i in range(400):
        t = i + rng.randrange(-15, 15) + epoch
        rows.append((None if i % 37 == 0 else "ab"[i % 3 == 0], i, t, rng.randrange(-5, 100), dt.datetime.fromtimestamp(t, dt.timezone.utc)))
    parts = [[r for r in rows if (3 if r[1] % 20 == 0 else r[1] // 101) == p] for p in range(4)]
    source, root = str(tmp_path / "in"), str(tmp_path / "flow")
    flow = eventtime.TrailingSum(root, spark.createDataFrame([], EVENTS).schema, "key", "id", "at", "amount", 25, "20 SECONDS")

    def sums(df):
        out = windows.trailing_agg(df, "t", "amount", 25, "id", key=["key"], name="trailing")
        return out.select("id", F.col("trailing").cast("long").alias("trailing"))

    seen = []
    for part in parts:
        flow.cycle(deliver(spark, part, EVENTS, source))
        seen += part
        want = {
            r[1]: sum(x[3] for x in seen if x[0] == r[0] and r[2] - 25 < x[2] and (x[2], x[1]) <= (r[2], r[1])) for r in seen
        }
        got = flow.read(spark, sums).collect()
        assert len(got) == len(want) and {r.id: r.trailing for r in got} == want
    assert spark.read.parquet(f"{root}/sums").count() > 100
    assert flow.intake.rows(spark, late=True).count() > 5


def test_late_sums_without_pairs_of_events(spark, tmp_path, monkeypatch):
    schema = spark.createDataFrame([], EVENTS).schema
    rng = random.Random(8)
    rows = []
    for i in range(900):
        t, id, amount = rng.randrange(60), None if i % 13 == 0 else i, None if i % 11 == 0 else rng.randrange(-5, 100)
        rows.append((None if i % 17 == 0 else "a", id, t, amount, START + dt.timedelta(seconds=t)))
    far = ("a", 5000, 99, 1, START + dt.timedelta(seconds=99))
    # All of the second and third delivery is late, repeated rows among them, but for its last row.
    batches = [rows[:500] + [far], rows[500:700] + rows[:20], rows[700:] + [("a", 5001, 105, None, START + dt.timedelta(seconds=105))]]
    monkeypatch.setattr(eventtime, "late_pairs", lambda *a, **k: pytest.fail("pairs of events"))
    flow = eventtime.TrailingSum(str(tmp_path / "flow"), schema, "key", "id", "at", "amount", 15, "20 SECONDS")
    # The frontier after the first delivery is 79 s, after the third 85 s.
    is_late = [lambda r: False, lambda r: r[2] < 79, lambda r: r[2] < 79]
    stored = []
    for epoch, batch in enumerate(batches):
        flow.intake.sink(spark.createDataFrame(batch, schema), epoch)
        stored += [(r, epoch, is_late[epoch](r)) for r in batch]
        want = {}
        for r, r_epoch, r_late in stored:
            inside = [
                x[3] for x, x_epoch, x_late in stored
                if x[0] == r[0] and r[2] - 15 < x[2] <= r[2] and (r_late or x_late) and epoch in (r_epoch, x_epoch)
                and (x[2] < r[2] or (x[1] is not None and r[1] is not None and x[1] <= r[1]))
            ]
            if inside:
                want.setdefault(r[1], []).extend(x for x in inside if x is not None)
        path = tmp_path / "flow" / "late" / f"epoch={epoch:09d}"
        got = {r.id: r.trailing for r in spark.read.parquet(str(path)).collect()} if path.exists() else {}
        assert got == {k: sum(v) if v else None for k, v in want.items()}
    assert len(got) > 300
