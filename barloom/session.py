"""Sessions for the engine, and the folder that driver and executors share."""

from __future__ import annotations

import logging
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build(name: str = "barloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session; on a cluster leave ``master`` to the launcher, in tests pass local[n]."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
    }
    return builder.config(map=defaults | conf).getOrCreate()


def info(spark: SparkSession) -> dict[str, str]:
    """What an operator wants to know of a running engine."""
    return {"version": spark.version, "master": spark.sparkContext.master, "app": spark.sparkContext.applicationId}


def ping(spark: SparkSession) -> bool:
    """Whether executors answer."""
    return spark.range(1).count() == 1


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path in ``spark.checkpoint.dir``, the folder that driver and executors share. Only a session of one process may leave it unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if held.isDefined():
            base = held.get()
        elif spark.sparkContext.master.split("[")[0] == "local":
            base = f"file://{tempfile.mkdtemp(prefix='barloom-')}"
            spark.sparkContext.setCheckpointDir(base)
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{base}/barloom-{label}-{uuid.uuid4().hex}"


class _Masked(logging.Filter):
    """Masks the password of any connection string in a record."""

    def filter(self, record: logging.LogRecord) -> bool:
        record.msg, record.args = re.sub(r"(?<=://)([^:/@\s]+):[^@/\s]+(?=@)", r"\1:***", record.getMessage()), None
        return True


def logger(name: str = "barloom", level: int = logging.INFO) -> logging.Logger:
    """A logger to standard error whose records show no passwords; asking again adds no second handler."""
    out = logging.getLogger(name)
    if not out.handlers:
        handler = logging.StreamHandler()
        handler.addFilter(_Masked())
        handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s %(message)s"))
        out.addHandler(handler)
    out.setLevel(level)
    return out
