"""Streaming forms, run over the given tables with a file source until they are read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.catalog.model_queries import (
    CUTS,
    GATE_SQL,
    flat_record,
    positive_of,
    with_probabilities,
)
from starsift.catalog.registry import query, rounded
from starsift.catalog.sql import rnd
from starsift.catalog.tables import Tables
from starsift.session import shared_folder
from starsift.streaming import jobs as S

KINDS = {"view": r"\bview\b", "error": r"\berror\b", "purchase": r"\bpurchase\b"}


def _stream(t: Tables, name: str) -> DataFrame:
    # a pattern, so that the table may be one file or a folder
    path = f"{t.sf_dir}/{name}.parque[t]"
    return t.spark.readStream.schema(t.read(name).schema).parquet(path)


def _events(t: Tables) -> DataFrame:
    """Events with their zone-less times taken as UTC, whatever the session's zone."""
    at = F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone())
    return _stream(t, "events").withColumn("ts", at)


def _run(t: Tables, stream: DataFrame) -> DataFrame:
    """Write what the stream gives, then read it; folders lie in the cluster's shared folder. The state goes at the end."""
    base = f"{shared_folder(t.spark)}/stream-{uuid.uuid4().hex}"
    S.run_available(stream, f"{base}/out", f"{base}/state").awaitTermination()
    state = t.spark._jvm.org.apache.hadoop.fs.Path(f"{base}/state")
    state.getFileSystem(t.spark._jsc.hadoopConfiguration()).delete(state, True)
    return t.spark.read.schema(stream.schema).parquet(f"{base}/out")


@query("x01_score_stream", GATE_SQL)
def _(t: Tables):
    docs = with_probabilities(_stream(t, "documents").select("doc_id", "text"))
    return _run(t, flat_record(S.scored_stream(docs, ["doc_id"], "text", CUTS, positive_of)))


@query(
    "x02_first_arrivals",
    "SELECT DISTINCT user_id, event_type FROM events",
)
def _(t: Tables):
    arrived = S.first_arrivals(_events(t), ["user_id", "event_type"], "ts", "40 days")
    return _run(t, arrived.select("user_id", "event_type"))


@query(
    "x02_runs_of_arrivals",
    """WITH e AS (
      SELECT user_id, event_type, ts, CAST(coalesce(ts - lag(ts) OVER w > INTERVAL 2 DAY, true) AS INTEGER) AS fresh
      FROM events WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts)),
    r AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id, event_type ORDER BY ts) AS run FROM e)
    SELECT user_id, event_type, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_at, count(*) AS n
    FROM r GROUP BY user_id, event_type, run HAVING max(ts) + INTERVAL 2 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
)
def _(t: Tables):
    out = _run(t, S.runs_of_arrivals(_events(t), ["user_id", "event_type"], "ts"))
    first = F.date_format(F.to_utc_timestamp("first_at", F.current_timezone()), "yyyy-MM-dd HH:mm:ss")
    return out.withColumn("first_at", first)


@query(
    "x03_keyword_windows",
    " UNION ALL ".join(
        f"""SELECT strftime(d, '%Y-%m-%d') AS day, '{k}' AS keyword, count(*) AS n,
        {rnd(f"avg(CAST(event_type = '{k}' AS INTEGER)) * 100")} AS pct
        FROM (SELECT *, CAST(ts AS DATE) AS d FROM events) WHERE d + 1 <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY d"""
        for k in KINDS
    ),
)
def _(t: Tables):
    out = S.keyword_windows(_events(t), "ts", "event_type", KINDS)
    day = F.date_format(F.to_utc_timestamp("window_start", F.current_timezone()), "yyyy-MM-dd")
    return rounded(_run(t, out).select(day.alias("day"), "keyword", "n", "pct"), "pct")
