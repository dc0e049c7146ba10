"""Rules of the bar engine on small frames, one edge a test."""

import datetime as dt
import hashlib
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.functions import codec, codes
from barloom.operators import calendar, master, quality, runs, series, store, universe
from barloom.operators.store import Conflict, Refused, Store
from barloom.plans import flows, status
from barloom.schemas import BARS
from barloom.sources import bars as sources
from barloom import cli, session
from barloom.config import Horizon, Retry, from_environment
from barloom.sources import listings, vendor

D = dt.date


def rows(spark, *bars):
    """Bars from (ticker, date, close, extra dict)."""
    out = []
    for k, (ticker, date, close, extra) in enumerate(bars):
        base = dict(ticker=ticker, board="main", date=date, open=close, high=close, low=close, close=close, adj_close=close, volume=1.0, dividends=0.0, splits=0.0, seq=k) | extra
        out.append(base)
    schema = "ticker string, board string, date date, open double, high double, low double, close double, adj_close double, volume double, dividends double, splits double, seq bigint"
    return spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in out], schema)


def test_last_invalid_duplicate_removes_its_date(spark):
    raw = rows(spark, ("a", D(2024, 1, 1), 10.0, {}), ("a", D(2024, 1, 1), None, {}), ("a", D(2024, 1, 2), 11.0, {}))
    clean = quality.sanitize(raw)
    assert [r["date"] for r in clean.collect()] == [D(2024, 1, 2)]
    assert quality.drop_counts(raw).first().asDict() == {"ticker": "a", "n_input": 3, "n_output": 1, "n_dropped": 2}


def test_sanitize_is_idempotent_and_leaves_no_error(spark):
    raw = rows(spark, ("a", D(2024, 1, 1), 10.0, {"high": 9.0}), ("a", D(2024, 1, 2), 5.0, {"volume": -1.0}), ("a", D(2024, 1, 3), 7.0, {"open": float("inf"), "high": float("inf")}))
    once = quality.sanitize(raw)
    again = quality.sanitize(once.withColumn("seq", F.lit(1)))
    assert sorted(map(str, once.collect())) == sorted(map(str, again.collect()))
    assert flows.invariant(raw).isEmpty()


def test_limit_does_not_look_past_a_missing_close(spark):
    raw = rows(spark, ("a", D(2024, 1, 1), 10.0, {}), ("a", D(2024, 1, 2), None, {}), ("a", D(2024, 1, 3), 20.0, {}), ("a", D(2024, 1, 4), 30.0, {"splits": 2.0}), ("a", D(2024, 1, 5), 60.0, {}))
    assert [r["date"] for r in quality.price_limit_breaks(raw).collect()] == [D(2024, 1, 5)]


def test_zero_close_before_flags_without_division(spark):
    raw = rows(spark, ("a", D(2024, 1, 1), 0.0, {}), ("a", D(2024, 1, 2), 0.0, {}), ("a", D(2024, 1, 3), 1.0, {}))
    assert [r["date"] for r in quality.price_limit_breaks(raw).collect()] == [D(2024, 1, 3)]


def test_gap_of_exactly_thirty_days(spark):
    raw = rows(spark, ("a", D(2024, 1, 1), 1.0, {}), ("a", D(2024, 1, 31), 1.0, {}), ("a", D(2024, 2, 29), 1.0, {}))
    assert [r["label"] for r in quality.calendar_gaps(raw).collect()] == ["2024-01-01..2024-01-31 (30d)"]


def test_fixed_point_rounds_half_to_even_and_guards(spark):
    df = spark.createDataFrame([(0.00005,), (0.00025,), (float("nan"),), (None,)], "x double")
    assert [r[0] for r in df.select(codec.pack_price(F.col("x"))).collect()] == [0, 2, None, None]


def test_checksum_matches_numpy_rendering(spark):
    raw = rows(spark, ("a", D(2024, 1, 3), 11.5, {"dividends": 0.25}), ("a", D(2024, 1, 2), 10.0, {"adj_close": None}))
    days = np.array([19724, 19725], "<i4")
    price = lambda *v: np.array([-(2**31) if x is None else round(x * 10000) for x in v], "<i4").tobytes()
    buffers = [("date", days.tobytes()), *((c, price(10.0, 11.5)) for c in ("open", "high", "low", "close")), ("adj_close", price(None, 11.5)), ("volume", np.array([1, 1], "<i8").tobytes()), ("dividends.i", np.array([1], "<i4").tobytes()), ("dividends.v", np.array([2500], "<i4").tobytes())]
    want = hashlib.sha256(b"".join(n.encode() + struct.pack("<I", len(b)) + b for n, b in buffers)).hexdigest()
    assert codec.chunk_checksums(raw).first()["sha256"] == want
    assert codec.chunk_checksums(raw.orderBy(F.rand(1))).first()["sha256"] == want


def test_merge_replaces_whole_rows_and_settles(spark):
    old = rows(spark, ("a", D(2024, 1, 1), 1.0, {}), ("a", D(2024, 1, 2), 2.0, {})).drop("seq", "board")
    new = rows(spark, ("a", D(2024, 1, 2), 5.0, {"volume": None}), ("a", D(2024, 1, 3), 6.0, {})).drop("seq", "board")
    once = store.merge(old, new)
    got = {r["date"]: (r["close"], r["volume"]) for r in once.collect()}
    assert got == {D(2024, 1, 1): (1.0, 1.0), D(2024, 1, 2): (5.0, None), D(2024, 1, 3): (6.0, 1.0)}
    assert sorted(map(str, store.merge(once, new).collect())) == sorted(map(str, once.collect()))


def held(st):
    return {(r["ticker"], r["date"], r["close"]) for r in st.bars().collect()}


def test_store_round_trip(spark, tmp_path):
    st = Store(spark, f"{tmp_path}/bars")
    assert st.bars().isEmpty() and st.manifest().isEmpty() and st.create() and not st.create()
    raw = rows(spark, ("a", D(2023, 12, 29), 1.0, {}), ("a", D(2024, 1, 2), 1.05, {}), ("b", D(2024, 1, 2), 3.0, {}))
    flows.bulk_load(raw, st)
    more = rows(spark, ("a", D(2024, 1, 2), 1.06, {}), ("a", D(2024, 1, 3), 1.07, {}))
    assert [tuple(r) for r in flows.update(more, st).collect()] == [("updated", 1, 2)]
    assert [tuple(r) for r in flows.update(more, st).collect()] == [("unchanged", 1, 2)]
    assert held(st) == {("a", D(2023, 12, 29), 1.0), ("a", D(2024, 1, 2), 1.06), ("a", D(2024, 1, 3), 1.07), ("b", D(2024, 1, 2), 3.0)}
    stats = store.storage_stats(st.bars()).first()
    assert stats["used_bytes"] > 0 and not stats["over_threshold"]
    st.delete("b")
    assert [r[0] for r in series.tickers(st.bars()).collect()] == ["a"]
    assert st.vacuum() > 0 and st.vacuum() == 0 and len(held(st)) == 3


def test_a_merge_leaves_other_years_as_they_are(spark, tmp_path):
    """A year merged before, then loaded anew, keeps what was loaded when another year is merged."""
    st = Store(spark, f"{tmp_path}/bars")
    bar = lambda day, close: rows(spark, ("a", day, close, {})).drop("seq", "board")
    st.merge(bar(D(2024, 1, 2), 2.0))
    st.replace(bar(D(2024, 1, 2), 3.0))
    st.merge(bar(D(2023, 1, 2), 1.0))
    assert held(st) == {("a", D(2024, 1, 2), 3.0), ("a", D(2023, 1, 2), 1.0)}


def test_a_ticker_alone_in_its_years_can_be_deleted(spark, tmp_path):
    st = Store(spark, f"{tmp_path}/bars")
    st.replace(rows(spark, ("a", D(2023, 1, 2), 1.0, {}), ("a", D(2024, 1, 2), 1.0, {}), ("b", D(2024, 1, 2), 2.0, {})).drop("seq", "board"))
    st.delete("a")
    assert held(st) == {("b", D(2024, 1, 2), 2.0)} and sorted(st.entry()[1]) == [2024]
    st.delete("none-such")
    st.delete("b")
    assert held(st) == set() and st.entry()[1] == {}


def test_writers_conflict_and_failed_writes_show_nothing(spark, tmp_path):
    st = Store(spark, f"{tmp_path}/bars")
    one = rows(spark, ("a", D(2024, 1, 2), 1.0, {})).drop("seq", "board")
    st.replace(one)
    late = Store(spark, st.path)
    seen = late.entry()
    st.replace(one.withColumn("close", F.lit(2.0)))
    late.entry = lambda: seen  # a writer that read the log before the other one wrote
    with pytest.raises(Conflict):
        late.commit(one.withColumn("close", F.lit(9.0)), [2024])
    assert held(st) == {("a", D(2024, 1, 2), 2.0)}
    with pytest.raises(Refused, match="do not increase"):
        st.replace(one.union(one))
    with pytest.raises(Refused, match="missing date"):
        st.replace(one.union(one.withColumn("date", F.lit(None).cast("date"))))
    with pytest.raises(Exception, match="boom"):
        st.replace(one.withColumn("close", F.raise_error(F.lit("boom")).cast("double")))
    assert held(st) == {("a", D(2024, 1, 2), 2.0)}
    assert st.vacuum() >= 3 and held(st) == {("a", D(2024, 1, 2), 2.0)}
    assert st.hold("x") and st.hold("x") and not st.hold("y")
    st.release("y")
    assert not st.hold("y")
    st.release("x")
    assert st.hold("y")


def test_unchanged_chunks_keep_their_stamp(spark, tmp_path):
    st = Store(spark, f"{tmp_path}/bars")
    two = rows(spark, ("a", D(2024, 1, 2), 1.0, {}), ("b", D(2024, 1, 2), 2.0, {})).drop("seq", "board")
    st.commit(two, [2024], dt.datetime(2024, 5, 1))
    st.commit(two.withColumn("close", F.when(F.col("ticker") == "b", 3.0).otherwise(F.col("close"))), [2024], dt.datetime(2024, 6, 1))
    assert {r["ticker"]: r["updated_at"].month for r in st.manifest().collect()} == {"a": 5, "b": 6}


def test_manifests_follow_every_kind_of_write(spark, tmp_path):
    """After merges, upserts and deletions the manifest is that of the rows, though only changed chunks are digested."""
    st = Store(spark, f"{tmp_path}/bars")
    bars = [rows(spark, *((t, D(y, 1, d), float(d + y % 7), {}) for t in ts for y in (2023, 2024) for d in range(2, 2 + n))).drop("seq", "board") for ts, n in (("abc", 4), ("bd", 6), ("cd", 2))]
    for write, frame in ((st.replace, bars[0]), (st.merge, bars[1].withColumn("close", F.col("close") + 1)), (st.upsert, bars[2]), (st.delete, "b"), (st.delete, "a")):
        write(frame)
        want = {(r["ticker"], r["year"]): (r["n"], r["sha256"]) for r in codec.chunk_checksums(st.bars().drop("year")).collect()}
        assert {(r["ticker"], r["year"]): (r["n"], r["sha256"]) for r in st.manifest().collect()} == want


def test_a_store_reads_only_the_years_asked_for(spark, tmp_path):
    st = Store(spark, f"{tmp_path}/bars")
    st.replace(rows(spark, ("a", D(2022, 1, 2), 1.0, {}), ("a", D(2023, 1, 2), 1.0, {}), ("a", D(2024, 1, 2), 1.0, {})).drop("seq", "board"))
    some = series.slice_dates(st.bars(), D(2023, 1, 1), D(2023, 12, 31))
    assert "PartitionFilters: [isnotnull(year" in some._jdf.queryExecution().toString()
    assert some.select(F.input_file_name().alias("f")).distinct().count() == 1


def test_encoded_chunks(spark):
    raw = rows(spark, ("a", D(2024, 1, 3), 11.5, {"dividends": 0.25}), ("a", D(2024, 1, 2), 10.0, {"adj_close": None, "volume": None}), ("a", D(1969, 12, 31), 0.0001, {"splits": 2.0, "volume": 2.0**60}))
    chunks = codec.encode_chunks(raw)
    got = codec.decode_chunks(chunks, verify=True).orderBy("date").collect()
    want = raw.drop("seq", "board").orderBy("date").collect()
    assert [tuple(r[c] for c in raw.drop("seq", "board").columns) for r in got] == [tuple(r) for r in want]
    assert codec.decode_chunks(chunks, ["close", "nonsense"]).columns == ["ticker", "date", "close"]
    assert codec.decode_chunks(chunks.limit(0)).isEmpty()
    for wrong in (chunks.withColumn("codec", F.lit("x")), chunks.withColumn("n", F.col("n") + 1), chunks.withColumn("sha256", F.lit("0")), chunks.withColumn("sha256", F.lit(None).cast("string"))):
        with pytest.raises(Exception, match="unknown codec|count differs|digest differs"):
            codec.decode_chunks(wrong, verify=True).collect()
    with pytest.raises(Exception, match="repeats a date"):
        codec.encode_chunks(raw.union(raw)).collect()


def test_verification_can_fail(spark):
    raw = rows(spark, ("a", D(2023, 1, 3), 1.0, {}), ("a", D(2024, 1, 3), 1.0, {}), ("b", D(2024, 1, 3), 1.0, {}), ("c", D(2024, 1, 3), 1.0, {}), ("d", D(2024, 1, 3), 1.0, {}))
    manifest = codec.chunk_checksums(raw).where("ticker <> 'd'")
    seen = raw.where("NOT (ticker = 'a' AND date < '2024-01-01')").withColumn("close", F.when(F.col("ticker") == "b", 1.0001).otherwise(F.col("close")))
    got = {(r["ticker"], r["year"]): r["state"] for r in codec.verify_chunks(seen, manifest).collect()}
    assert got == {("a", 2023): "missing", ("a", 2024): "ok", ("b", 2024): "corrupt", ("c", 2024): "ok", ("d", 2024): "extra"}
    got = {r["ticker"]: r["state"] for r in codec.verify_chunks(seen.union(seen.where("ticker = 'c'")), manifest.withColumn("sha256", F.when(F.col("ticker") == "a", None).otherwise(F.col("sha256")))).where("year = 2024").collect()}
    assert got == {"a": "corrupt", "b": "corrupt", "c": "corrupt", "d": "extra"}


def test_a_fetch_goes_on_past_failures(spark):
    class Flaky:
        """Fails a few times for x, always for y; z has a row beyond the range."""

        def __init__(self):
            self.calls = 0

        def fetch(self, ticker, start, end):
            self.calls += 1
            if ticker == "y" or (ticker == "x" and self.calls < 4):
                raise TimeoutError("timed out" * 100)
            extra = (1.0, 1.0, 1.0, 1.0, 1.0, 5.0, 0.0, 0.0)
            return [(start, *extra), (end, *extra), (end + dt.timedelta(days=1), *extra)]

    def no_wait(seconds):
        assert 0 < seconds <= 90

    wanted = spark.createDataFrame([("x",), ("y",), ("z",), ("z",)], "ticker string")
    got = vendor.fetch_many(wanted, Flaky(), D(2024, 1, 2), D(2024, 1, 3), Retry(attempts=5), tasks=2, sleep=no_wait)
    results = {r["ticker"]: (r["n_bars"], r["ok"], r["error"] and len(r["error"])) for r in vendor.fetch_results(wanted, got).collect()}
    assert results == {"x": (2, True, None), "y": (0, False, 500), "z": (2, True, None)}


def test_probes_have_three_outcomes(spark):
    def no_wait(seconds):
        assert 0 < seconds <= 90

    def prober(code):
        if code == "000003":
            raise RuntimeError("404 no data found")
        if code == "000004":
            raise RuntimeError("HTTP 503")
        return code == "000001"

    codes_ = spark.createDataFrame([(f"00000{i}",) for i in range(1, 6)], "code string")
    skip = codes_.where("code = '000005'")
    answers = vendor.probe_many(codes_, prober, skip, Retry(attempts=3), tasks=2, sleep=no_wait)
    assert {r["code"]: r["outcome"] for r in universe.probe_outcomes(codes_, answers, skip).collect()} == {"000001": "present", "000002": "absent", "000003": "absent", "000004": "unknown"}


def test_pace_holds_over_threads():
    import threading

    slept, made = [], []
    pace = vendor.Pace(5, clock=lambda: 7.0, sleep=slept.append)  # a clock that stands still
    threads = [threading.Thread(target=lambda: made.extend(pace.take() for _ in range(4))) for _ in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(made) == [7.0] * 5 + [67.0] * 5 + [127.0] * 2 and sorted(slept) == [60.0] * 5 + [120.0] * 2


def test_settings_from_the_environment():
    got = from_environment(Horizon(), {"BARLOOM_HORIZON_FIRST_DAY": "2020-02-03", "BARLOOM_HORIZON_OVERLAP_DAYS": "3", "OTHER": "x"})
    assert got == Horizon(D(2020, 2, 3), 3) and from_environment(Retry(), {}) == Retry()
    with pytest.raises(ValueError):
        from_environment(Retry(), {"BARLOOM_RETRY_ATTEMPTS": "many"})


def test_logs_show_no_passwords(capsys):
    import logging

    record = logging.LogRecord("x", logging.INFO, "f", 1, "open %s", ("mongodb://me:secret@host/db",), None)
    session.logger("barloom.test").handlers[0].filters[0].filter(record)
    assert record.getMessage() == "open mongodb://me:***@host/db"
    assert len(session.logger("barloom.test").handlers) == 1


def test_commands(spark, tmp_path, capsys):
    def run(*args):
        return cli.main([*args, "--root", f"{tmp_path}/root"], spark)

    raw = rows(spark, *((t, D(2024, 1, 1 + d), 10.0 + d / 10, {}) for t in ("600000.SS", "600001.SS", "688001.SS") for d in range(8)))
    raw.write.parquet(f"{tmp_path}/raw")
    assert run("status") == cli.WRONG and run("init") == cli.DONE and run("init") == cli.DONE and run("info") == cli.DONE
    assert run("load", "--source", f"{tmp_path}/raw", "--limit", "2") == cli.DONE
    assert run("load", "--source", f"{tmp_path}/raw", "--missing-only") == cli.DONE
    st = Store(spark, f"{tmp_path}/root/store")
    assert st.bars().count() == 24
    assert run("verify") == cli.DONE
    raw.withColumn("close", F.col("close") + 0.01).withColumn("high", F.col("high") + 1).write.parquet(f"{tmp_path}/next")
    assert run("update", "--source", f"{tmp_path}/next") == cli.DONE
    assert st.bars().where("close = 10.01").count() == 3
    listed = spark.createDataFrame([("600000", "A", True, True, False), ("600001", "B", True, True, False), ("600002", "C", True, True, False)], "code string, name string, in_screener boolean, in_probe boolean, failed boolean")
    listed.write.parquet(f"{tmp_path}/listed")
    assert run("discover", "--source", f"{tmp_path}/listed", "--complete") == cli.DONE
    root = cli.Root(spark, f"{tmp_path}/root")
    assert {r["ticker"]: r["status"] for r in root.master().collect()} == {"600000.SS": "active", "600001.SS": "active", "600002.SS": "active"}
    listed.withColumns({"in_probe": F.lit(False), "failed": F.lit(True)}).write.parquet(f"{tmp_path}/unsure")
    assert run("discover", "--source", f"{tmp_path}/unsure") == cli.STOPPED
    assert run("load", "--source", f"{tmp_path}/raw") == cli.DONE
    last = runs.recent(root.runs(), 1).first()
    assert last["status"] == "ok" and root.master().where("ingest.state = 'ok'").count() == 2
    assert run("load", "--source", f"{tmp_path}/raw", "--resume", last["id"]) == cli.DONE
    assert run("load", "--source", f"{tmp_path}/none") == cli.UNREACHABLE
    st.hold("someone")
    assert run("load", "--source", f"{tmp_path}/raw") == cli.BUSY
    st.release("someone")
    assert run("guard") == cli.DONE
    root.note("busy", "start", kind="update", status="running")
    assert run("guard") == cli.BUSY
    (tmp_path / "README").write_text("# Title\n")
    assert run("status", "--into", f"{tmp_path}/README") == cli.DONE
    once = (tmp_path / "README").read_text()
    assert run("status", "--into", f"{tmp_path}/README") == cli.DONE
    assert (tmp_path / "README").read_text().count(status.OPENS) == once.count(status.OPENS) == 1 and "**Data stale** through 2024-01-08" in once


def test_sweep_equals_nested_loop(spark):
    rng = np.random.default_rng(1)
    data = [(str(t), D(2024, 1, 1) + dt.timedelta(int(d)), 1.0, {}) for t in range(12) for d in rng.choice(60, 12, replace=False)]
    bars = rows(spark, *data)
    got = {r["date"]: (r["prints"], r["live"]) for r in calendar.live_counts(bars).where("prints > 0").collect()}
    span = {t: [d for x, d, *_ in data if x == t] for t, *_ in data}
    want = {d: (sum(d in s for s in span.values()), sum(min(s) <= d <= max(s) for s in span.values())) for _, d, *_ in data}
    assert got == want


def test_quorum_exactly_met_is_a_session(spark):
    bars = rows(spark, ("a", D(2024, 1, 1), 1.0, {}), ("a", D(2024, 1, 3), 1.0, {}), ("b", D(2024, 1, 1), 1.0, {}), ("b", D(2024, 1, 2), 1.0, {}), ("b", D(2024, 1, 3), 1.0, {}))
    sessions = calendar.infer_sessions(bars, 0.5)
    assert sessions.count() == 3
    assert [tuple(r) for r in calendar.missing_sessions(bars, sessions).collect()] == [("a", D(2024, 1, 2))]
    assert calendar.infer_sessions(sources.empty(spark)).count() == 0


def test_weekdays_hold_fridays(spark):
    assert [r[0].weekday() for r in calendar.weekdays_between(spark, D(2024, 1, 1), D(2024, 1, 7)).collect()] == [0, 1, 2, 3, 4]


def test_codes(spark):
    df = spark.createDataFrame([("600000",), ("19",), ("688123",), ("777000",)], "code string")
    got = [tuple(r) for r in df.select(codes.instrument(F.col("code")), codes.board(F.col("code")), codes.symbol(F.col("code"))).collect()]
    assert got == [("equity_main", "main", "600000.SS"), ("index", "other", "000019.SS"), ("equity_star", "star", "688123.SS"), ("unknown", "other", "777000.SS")]


def test_quotes_of_any_shape(spark):
    q = '{"symbol":" 600000.ss ","longName":"","shortName":"Bank","marketCap":5}'
    payloads = spark.createDataFrame([(f'{{"quotes":[{q}]}}',), (f'{{"finance":{{"result":[{{"quotes":[{q}]}}]}}}}',), ('{"total":3}',)], "payload string")
    got = listings.normalise_quotes(listings.quotes(payloads)).select("ticker", "name").collect()
    assert [tuple(r) for r in got] == [("600000.SS", "Bank")] * 2


def test_transient_messages(spark):
    df = spark.createDataFrame([("Read TIMED OUT",), ("404: connection says no data found",), (None,), ("odd",)], "m string")
    assert [r[0] for r in df.select(codes.is_transient(F.col("m"))).collect()] == [True, False, False, False]


def test_bands_equal_halving_with_a_count_each(spark):
    rng = np.random.default_rng(5)
    edges = universe.band_edges()
    caps = [float(x) for x in np.exp(rng.uniform(0, 30, 400))] + [0.0, 0.5, 1.0, 5e12, 6e12, -1.0] + [edges[k] for k in (1, 7, 512, 2048, 4095)] * 3 + [2.5e9] * 60 + [10.0] * 70
    df = spark.createDataFrame([(c,) for c in [*caps, None]], "market_cap double")

    def leaves(low, high, depth):
        top = 5e12 if high is None else high
        n = sum(low <= c <= top for c in caps)
        why = None
        if n >= 50 and high is not None:
            why = "no_reported_market_cap" if high <= 1e6 else "interval_exhausted" if low > 0 and high / low < 1.01 else None
        if n < 50 or why or depth == 12:
            return [(low, high, depth, min(n, 50), n >= 50, why or ("max_depth" if n >= 50 else None))]
        middle = (max(low, 1.0) * top) ** 0.5
        return leaves(low, middle, depth + 1) + leaves(middle, high, depth + 1)

    assert universe.screen_bands(df, ceiling=50) == leaves(0.0, None, 0)
    assert universe.screen_bands(df.limit(0)) == [(0.0, None, 0, 0, False, None)]


def test_master_soft_deletes_only_after_complete_discoveries(spark):
    none = spark.createDataFrame([], "ticker string, name string")
    first = spark.createDataFrame([("x", "X"), ("y", None)], "ticker string, name string")
    known = master.upsert(none, first, "s", dt.datetime(2024, 1, 1))
    found = spark.createDataFrame([("x", None)], "ticker string, name string")
    unknown = spark.createDataFrame([], "ticker string")
    after = flows.persist(known, found, unknown, "p", dt.datetime(2024, 1, 2), complete=True)
    assert {(r["ticker"], r["name"], r["status"]) for r in after.collect()} == {("x", "X", "active"), ("y", None, "inactive")}
    spared = flows.persist(known, found, unknown, "p", dt.datetime(2024, 1, 2), complete=False)
    assert {r["status"] for r in spared.collect()} == {"active"}


def test_run_events_fold(spark):
    at = dt.datetime(2024, 1, 1)
    events = runs.event(spark, "r", "start", at, kind="update", status="running").union(runs.event(spark, "r", "finish", at + dt.timedelta(hours=1), status="ok", errors=[str(i) for i in range(300)]))
    row = runs.current(events).first()
    assert (row["kind"], row["status"], row["error_count"], len(row["errors"])) == ("update", "ok", 300, 200)


def test_get_many_keeps_unknown_tickers(spark):
    bars = rows(spark, ("a", D(2024, 1, 1), 1.0, {}))
    wanted = spark.createDataFrame([("a",), ("zz",), ("a",)], "ticker string")
    assert {(r["ticker"], r["close"]) for r in series.get_many(bars, wanted, fields=["close"]).collect()} == {("a", 1.0), ("zz", None)}


def test_normalise_folds_names_and_nan(spark):
    vendor = spark.createDataFrame([("a", "2024-01-02", float("nan"), 2.0)], "ticker string, `Date` string, `Close` double, `Adj Close` double")
    row = sources.normalise(vendor).first()
    assert (row["date"], row["close"], row["adj_close"], row["splits"]) == (D(2024, 1, 2), None, 2.0, 0.0)
    assert sources.empty(spark).schema == BARS


def test_examples_are_the_first_few(spark):
    raw = rows(spark, *(("a", D(2024, 1, 1) + dt.timedelta(days=40 * k), 1.0, {}) for k in range(9)))
    got = quality.examples(raw, 3).first()
    assert (got["check"], got["n"], got["shown"]) == ("long_gaps", 8, ["2024-01-01..2024-02-10", "2024-02-10..2024-03-21", "2024-03-21..2024-04-30"])


def test_status_text():
    text = status.block({"state": "fresh", "last": "2024-01-08"})
    assert "**Data fresh** through 2024-01-08" in text and "unknown bars" in text
    assert status.placed("a\n", text) == f"a\n\n{text}\n"
    assert status.placed(f"a\n{status.OPENS}old\\1{status.CLOSES}\nb\n", text) == f"a\n{text}\nb\n"
    assert status.placed("", text) == f"{text}\n"


def test_storage_text(spark):
    df = spark.createDataFrame([(212_650_000, 202_000_000, 1)], "used_bytes bigint, data_bytes bigint, objects bigint")
    row = status.storage_text(store.storage_facts(df).withColumn("most_bytes", F.lit(512 << 20))).first()
    assert row["storage"] == "202.8 of 512 MiB (39.6 %), encoded 192.6 MiB, ratio 0.95"
    assert store.storage_facts(df.withColumn("used_bytes", F.lit(0))).first()["compression_ratio"] == 0.0
