from datetime import datetime, timedelta

import pytest

from shelfline.streaming.basket import latest_totals, live_totals, run_available, stream_itb_summary, stream_live_basket

DDL = "productId string, session_id string, quantity int, added_at timestamp, expires_at timestamp, status string"
T0 = datetime(2025, 7, 14, 8)


def basket_rows(spark, *items):
    return spark.createDataFrame([(p, s, q, T0 + timedelta(hours=h), None if e is None else T0 + timedelta(hours=e), st) for p, s, q, h, e, st in items], DDL)


def test_late_expired_and_inactive_rows_are_left_out(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    first = [("A", "s1", 2, 0, None, "ACTIVE"), ("A", "s1", 1, 1, 2, "ACTIVE"), ("A", "s2", 5, 1, None, "EXPIRED"), ("A", "s3", 1, 40, None, "ACTIVE")]
    now = T0 + timedelta(hours=3)
    for batch in (first, [("A", "s9", 100, 1, None, "ACTIVE"), ("A", "s4", 4, 41, None, "ACTIVE")]):
        basket_rows(spark, *batch).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(source)
        run_available(stream_itb_summary(stream, now), sink, state).awaitTermination()
    totals = {str(r["basket_day"]): (r["total_quantity"], r["basket_rows"]) for r in latest_totals(spark.read.parquet(sink)).collect()}
    # the 100 units came a day and a half late; s1's second row had expired
    assert totals == {"2025-07-14": (2, 1), "2025-07-16": (5, 2)}


def test_batch_use(spark):
    got = stream_itb_summary(basket_rows(spark, ("A", "x", 1, 0, None, "ACTIVE"), ("A", "x", 2, 1, None, "ACTIVE"), ("B", "y", 3, 0, None, "ACTIVE"))).collect()
    assert {(r["productId"], r["active_sessions"], r["total_quantity"]) for r in got} == {("A", 1, 3), ("B", 1, 3)}


@pytest.mark.parametrize("zone", ["UTC", "Europe/London", "America/New_York"])
def test_days_are_those_of_the_session(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        clock = ["2025-07-13 23:59:59", "2025-07-14 00:00:00", "2025-07-14 12:00:00", "2025-07-14 23:30:00", "2025-07-15 00:30:00"]
        rows = spark.createDataFrame([(t,) for t in clock], "t string").selectExpr(
            "'A' as productId", "'s' as session_id", "1 as quantity", "t::timestamp as added_at", "null::timestamp as expires_at", "'ACTIVE' as status"
        )
        days = {str(r["basket_day"]): r["basket_rows"] for r in stream_itb_summary(rows).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert days == {"2025-07-13": 1, "2025-07-14": 3, "2025-07-15": 1}


def test_each_sink_has_its_own_checkpoint(spark, tmp_path):
    source = str(tmp_path / "in")
    basket_rows(spark, ("A", "s1", 2, 0, None, "ACTIVE")).write.parquet(source)
    for name in ("one", "two"):
        stream = spark.readStream.schema(DDL).parquet(source)
        run_available(stream_itb_summary(stream), str(tmp_path / name)).awaitTermination()
        assert [r["total_quantity"] for r in latest_totals(spark.read.parquet(str(tmp_path / name))).collect()] == [2]


def test_rows_leave_when_their_time_comes(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    ddl = "basket_id long, " + DDL
    seen = []
    batches = [
        # id, product, session, units, hour added, hour of expiry, status
        [(1, "A", "s1", 2, 0, 3, "ACTIVE"), (2, "A", "s1", 1, 1, None, "ACTIVE"), (3, "A", "s2", 5, 1, 4, "ACTIVE"), (4, "A", "s3", 9, 1, None, "EXPIRED"), (5, "B", "s1", 7, 1, 30, "ACTIVE")],
        [(1, "A", "s1", 2, 0, 3, "ACTIVE"), (3, "A", "s2", 5, 1, 4, "ACTIVE"), (6, "B", "s4", 1, 4, 90, "ACTIVE")],  # repeats, and the clock moves to hour 3
        [(7, "C", "s5", 1, 6, 90, "ACTIVE")],  # clock at 5: rows 1 and 3 are out, though no row of product A arrives
        [(8, "A", "s6", 50, 2, 90, "ACTIVE"), (9, "C", "s5", 3, 32, 90, "ACTIVE")],  # late; then the clock passes row 5's expiry
    ]
    for batch in batches:
        rows = [(i, p, s, q, T0 + timedelta(hours=h), None if e is None else T0 + timedelta(hours=e), st) for i, p, s, q, h, e, st in batch]
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(source)
        run_available(stream_live_basket(stream, late="1 hour"), sink, state).awaitTermination()
        totals = live_totals(spark.read.parquet(sink)).collect()
        seen.append({(str(r["basket_day"])[8:], r["productId"]): (r["active_sessions"], r["total_quantity"], r["basket_rows"]) for r in totals})
    assert seen[0] == {("14", "A"): (2, 8, 3), ("14", "B"): (1, 7, 1)}
    assert seen[1] == {("14", "A"): (2, 8, 3), ("14", "B"): (2, 8, 2)}
    assert seen[2] == {("14", "A"): (1, 1, 1), ("14", "B"): (2, 8, 2), ("14", "C"): (1, 1, 1)}
    assert seen[3] == {("14", "A"): (1, 1, 1), ("14", "B"): (1, 1, 1), ("14", "C"): (1, 1, 1), ("15", "C"): (1, 3, 1)}


def test_sessions_of_a_bucket_stay_apart(spark, tmp_path):
    """With one bucket all sessions of a day share a state; null sessions and repeats are told apart as in many."""
    ddl = "basket_id long, " + DDL
    at = lambda h: T0 + timedelta(hours=h)
    batches = [
        [(1, "A", "s1", 2, at(0), at(3), "ACTIVE"), (2, "A", None, 1, at(0), None, "ACTIVE"), (3, "A", "s1", 4, at(1), None, "ACTIVE"), (1, "B", "s1", 7, at(1), at(9), "ACTIVE")],
        [(4, "C", "s1", 1, at(5), at(20), "ACTIVE")],  # the clock moves to hour 4: row 1 of product A leaves, row 3 is still held
        [(3, "A", "s1", 4, at(6), None, "ACTIVE"), (5, "A", "s1", 8, at(6), None, "ACTIVE")],  # a repeat and a new one
    ]
    got = []
    for buckets in (1, 64):
        source, sink, state = (str(tmp_path / f"{n}{buckets}") for n in ("in", "out", "state"))
        for batch in batches:
            spark.createDataFrame(batch, ddl).coalesce(1).write.mode("append").parquet(source)
            stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(source)
            run_available(stream_live_basket(stream, "1 hour", buckets), sink, state).awaitTermination()
        got.append({r["productId"]: tuple(r)[2:] for r in live_totals(spark.read.parquet(sink)).collect()})
    assert got[0] == got[1]
    assert got[0]["A"][1:3] == (13, 3) and got[0]["B"][:3] == (1, 7, 1) and got[0]["C"][:3] == (1, 1, 1)


def test_python_is_called_for_a_bucket(spark, tmp_path):
    """2,000 sessions of a day are a call for each of four buckets, not for each session."""
    rows = [(i, str(i % 7), f"s{i}", 1, T0, None, "ACTIVE") for i in range(2000)]
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.createDataFrame(rows, "basket_id long, " + DDL).coalesce(1).write.parquet(source)
    run = run_available(stream_live_basket(spark.readStream.schema("basket_id long, " + DDL).parquet(source), buckets=4), sink, state)
    run.awaitTermination()
    assert max(op.numRowsTotal for p in run.recentProgress for op in p.stateOperators) <= 4
    assert sum(r["basket_rows"] for r in live_totals(spark.read.parquet(sink)).collect()) == 2000
