"""The engine's commands: ``python -m barloom.cli COMMAND --root PATH``.

A root holds ``store`` (bars), ``master``, ``runs``, ``snapshots`` and ``reports``.
Raw rows come from files (``--source PATH``, ``--format parquet|orc|csv|json``).
Exit codes: 0 done, 1 something failed or was found wrong, 2 stopped by storage
or by the discovery gate, 3 the engine or the root cannot be reached, 75 another
run holds the root.
"""

from __future__ import annotations

import argparse
import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom import session
from barloom.config import Capacity, Horizon, from_environment
from barloom.operators import calendar, quality, runs, store, universe
from barloom.operators.store import Conflict, Refused, Store, _Files
from barloom.plans import flows, status
from barloom.schemas import MASTER, RUN_EVENTS
from barloom.sources import bars as sources

DONE, WRONG, STOPPED, UNREACHABLE, BUSY = 0, 1, 2, 3, 75
log = session.logger("barloom.cli")


class Root:
    """The tables under one path."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.files = _Files(spark, self.path)
        self.store = Store(spark, f"{self.path}/store")

    def _table(self, name: str, schema) -> DataFrame:  # noqa: ANN001
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}") if self.files.names(f"{self.path}/{name}") else self.spark.createDataFrame([], schema)

    def master(self) -> DataFrame:
        """The newest version; every save is a folder of its own, and a later one never touches what a reader reads."""
        held = [n for n in self.files.names(f"{self.path}/master") if n.startswith("v")]
        return self.spark.read.schema(MASTER).parquet(f"{self.path}/master/{held[-1]}") if held else self.spark.createDataFrame([], MASTER)

    def save_master(self, rows: DataFrame) -> None:
        held = [n for n in self.files.names(f"{self.path}/master") if n.startswith("v")]
        at = int(held[-1][1:]) + 1 if held else 1
        rows.select(*(F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in MASTER.fields)).write.parquet(f"{self.path}/master/v{at:09d}")

    def runs(self) -> DataFrame:
        return runs.current(self._table("runs", RUN_EVENTS))

    def note(self, run_id: str, event: str, **what: object) -> None:
        runs.event(self.spark, run_id, event, now(), **what).write.mode("append").parquet(f"{self.path}/runs")


def now() -> dt.datetime:
    return dt.datetime.now(dt.UTC).replace(tzinfo=None)


def _raw(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    reader = spark.read.format(args.format)
    rows = sources.normalise((reader.option("header", True).option("inferSchema", True) if args.format == "csv" else reader).load(args.source))
    extra = {"board": F.lit("other"), "seq": F.lit(0).cast("bigint")}
    return rows.withColumns({c: v for c, v in extra.items() if c not in rows.columns})


def init(root: Root, args: argparse.Namespace) -> int:
    """Makes an empty root; an existing one stays as it is."""
    print("made" if root.store.create() else "there already")
    return DONE


def info(root: Root, args: argparse.Namespace) -> int:
    for k, v in session.info(root.spark).items():
        print(f"{k}: {v}")
    return DONE if session.ping(root.spark) else UNREACHABLE


def _written(root: Root, kind: str, args: argparse.Namespace, rows: DataFrame, write) -> int:  # noqa: ANN001
    """A run around a write: noted, refused at the halting size, and reported."""
    if flows.over_capacity(root.store, from_environment(Capacity())):
        log.error("the store is at its halting size")
        return STOPPED
    run_id = args.resume or f"{kind}-{now():%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:6]}"
    root.note(run_id, "start", kind=kind, status="running")
    try:
        result = [r.asDict() for r in write(rows).collect()]
    except (Refused, Conflict) as e:
        root.note(run_id, "finish", status="failed", errors=[str(e)[:500]])
        log.error("%s", e)
        return WRONG
    census = quality.census(rows).first().asDict()
    done = rows.select("ticker").distinct()
    known = root.master()
    state = F.when(F.col("hit"), F.struct(F.lit("ok").alias("state"), F.lit(run_id).alias("run_id"), F.lit(now()).cast("timestamp_ntz").alias("updated_at"))).otherwise(F.col("ingest"))
    root.save_master(known.join(done.withColumn("hit", F.lit(True)), "ticker", "left").withColumn("ingest", state))
    root.note(run_id, "finish", status="ok", counters={k: int(v or 0) for k, v in census.items()})
    sources.write_report(root.spark.createDataFrame([(run_id, kind, str(result), str(census))], "run_id string, kind string, chunks string, census string"), f"{root.path}/reports/{run_id}")
    print(run_id, result, census)
    return WRONG if census["with_errors"] else DONE


def _chosen(root: Root, args: argparse.Namespace, rows: DataFrame) -> DataFrame:
    """Rows of the tickers that the options leave; names that the master lacks count as active."""
    names = rows.select("ticker").distinct().join(root.master(), "ticker", "left").withColumn("status", F.coalesce("status", F.lit("active")))
    names = names.select("ticker", "status", F.col("ingest.run_id").alias("run_id"), F.col("ingest.state").alias("ingest_state"))
    return rows.join(flows.todo(names, root.store.bars(), args.resume, args.missing_only, args.limit), "ticker", "left_semi")


def load(root: Root, args: argparse.Namespace) -> int:
    """Full replacement of the ticker-years that the raw rows have."""

    def write(rows: DataFrame) -> DataFrame:
        clean = quality.sanitize(rows)
        found = store.outcomes(root.store.manifest(), clean.drop("board"))
        root.store.upsert(clean.drop("board"))
        return found.groupBy("outcome").agg(F.count("*").alias("chunks"))

    return _written(root, "backfill", args, _chosen(root, args, _raw(root.spark, args)), write)


def update(root: Root, args: argparse.Namespace) -> int:
    """Merges raw rows from each ticker's overlap on; with ``--full`` all of them."""
    horizon = from_environment(Horizon())
    return _written(root, "update", args, _chosen(root, args, _raw(root.spark, args)), lambda rows: flows.update(rows, root.store, horizon, args.full))


def discover(root: Root, args: argparse.Namespace) -> int:
    """Reconciles listings (code, name, in_screener, in_probe, and failed where a probe had no answer) into the master."""
    rows = root.spark.read.format(args.format).load(args.source)
    failed = F.coalesce(F.col("failed"), F.lit(False)) if "failed" in rows.columns else F.lit(False)
    answers = rows.select("code", F.col("in_probe").alias("found"), failed.alias("failed"))
    unresolved = answers.where("failed AND NOT found").count()
    gated = universe.gate(universe.reconcile(rows), unresolved).first()
    if not gated["passes"] and not args.force:
        log.error("the methods disagree: %s, %d probes without an answer", round(gated["disagreement_fraction"], 4), unresolved)
        return STOPPED
    found = universe.discover(rows.where("in_screener"), answers).select("ticker", "code", "name", "board")
    unknown = answers.where("failed AND NOT found").select(F.concat("code", F.lit(".SS")).alias("ticker"))
    run_id = f"discover-{now():%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:6]}"
    root.save_master(flows.persist(root.master(), found, unknown, "discovery", now(), complete=args.complete))
    flows.persist_snapshot(found, run_id, "discovery", now(), f"{root.path}/snapshots")
    print(run_id, gated.asDict())
    return DONE


def verify(root: Root, args: argparse.Namespace) -> int:
    """Digests against the manifest, and sessions on days without trade."""
    states = {r["state"]: r["chunks"] for r in flows.verify(root.store.bars().drop("year"), root.store.manifest()).collect()}
    odd = calendar.calendar_sanity(calendar.infer_sessions(root.store.bars())).count()
    print(states, f"sessions on odd days: {odd}")
    return DONE if set(states) <= {"ok"} else WRONG


def show(root: Root, args: argparse.Namespace) -> int:
    """Prints the status block, or puts it into a file of the driver (``--into``)."""
    facts = status.live_facts(root.store.manifest(), root.master())
    values = status.record(facts, F.current_date()).first().asDict()
    if values["state"] == "absent":
        log.error("nothing is stored")
        return WRONG
    capacity = from_environment(Capacity())
    sizes = store.storage_stats(root.store.bars(), capacity).withColumn("most_bytes", F.lit(capacity.most_bytes))
    values["storage"] = status.storage_text(sizes).first()["storage"]
    for r in runs.recent(root.runs(), 1).collect():
        values["run"] = status.run_text(root.runs().where(F.col("id") == r["id"]), F.lit(now())).first()["run"]
        values["census"] = ", ".join(f"{v:,} {k}" for k, v in sorted((r["counters"] or {}).items()))
    text = status.block(values)
    if args.into:
        with open(args.into, encoding="utf-8") as f:
            document = f.read()
        with open(args.into, "w", encoding="utf-8") as f:
            f.write(status.placed(document, text))
    else:
        print(text)
    return DONE


def guard(root: Root, args: argparse.Namespace) -> int:
    """Whether a run may start: no other run was heard of lately."""
    busy = runs.active(root.runs(), now() - dt.timedelta(minutes=args.stale_minutes)).limit(1).collect()
    if busy:
        print("busy:", busy[0]["id"])
    return BUSY if busy else DONE


COMMANDS = {"init": init, "info": info, "load": load, "update": update, "discover": discover, "verify": verify, "status": show, "guard": guard}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    out.add_argument("command", choices=COMMANDS)
    out.add_argument("--root", required=True)
    out.add_argument("--source", help="files of raw rows or listings")
    out.add_argument("--format", default="parquet")
    out.add_argument("--resume", metavar="RUN", help="only what this run has not finished")
    out.add_argument("--missing-only", action="store_true", help="only tickers without bars")
    out.add_argument("--limit", type=int, help="only the first tickers by name")
    out.add_argument("--full", action="store_true", help="no overlap: all raw rows")
    out.add_argument("--complete", action="store_true", help="this discovery saw everything: names it lacks become inactive")
    out.add_argument("--force", action="store_true", help="go on although the gate fails")
    out.add_argument("--into", help="a text file whose status block is replaced")
    out.add_argument("--stale-minutes", type=int, default=180)
    return out


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        root = Root(spark or session.build(), args.root)
        writes = args.command in ("load", "update", "discover")
        owner = f"{args.command}-{uuid.uuid4().hex}"
        if writes and not root.store.hold(owner):
            log.error("another run holds %s", args.root)
            return BUSY
        try:
            return COMMANDS[args.command](root, args)
        finally:
            if writes:
                root.store.release(owner)
    except Exception as e:  # noqa: BLE001  a command ends with a code, not a trace
        log.error("%s: %s", type(e).__name__, str(e).splitlines()[0] if str(e) else "")
        return UNREACHABLE


if __name__ == "__main__":
    raise SystemExit(main())
