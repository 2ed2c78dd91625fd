"""Task and query dimension (inventory S1).

A task is a named list of boolean keyword queries plus three caps.  A query is
stored already structured (no query-language parser): ``alternatives`` is an
OR of alternatives, each an AND of clauses, each an OR of phrases; phrases are
lowercased.  ``exclude_hosts`` carries ``-site:`` exclusions.  ``primary_fails``
marks queries whose primary provider raised, so the fallback provider answers
them (S5).

The dimension is configuration: its size is known on the driver before any job
runs, which is what lets joins broadcast it behind an explicit size check.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import constants as K

@dataclass(frozen=True)
class Query:
    text: str
    alternatives: tuple  # tuple[tuple[tuple[str, ...], ...], ...]
    exclude_hosts: tuple = ()
    primary_fails: bool = False


@dataclass(frozen=True)
class Task:
    name: str
    queries: tuple
    top_k: int = K.DEFAULT_TOP_K
    final_event_cap: int = K.DEFAULT_EVENT_CAP
    max_content_chars: int = K.DEFAULT_MAX_CONTENT_CHARS


@dataclass(frozen=True)
class TaskConfig:
    """Tasks of a run.  run_id and run_ts (ISO time with offset) identify the
    run; where they are not given, the clock sets them once, when the
    configuration is made."""

    tasks: tuple
    blocked_host_tokens: tuple = ()
    run_id: str | None = None
    run_ts: str | None = None

    def __post_init__(self) -> None:
        now = datetime.now().astimezone()
        if self.run_ts is None:
            object.__setattr__(self, "run_ts", now.isoformat(timespec="seconds"))
        if self.run_id is None:
            object.__setattr__(self, "run_id", f"run_{now:%Y_%m_%d_%H%M%S}_{uuid.uuid4().hex[:8]}")

    @property
    def n_queries(self) -> int:
        return sum(len(t.queries) for t in self.tasks)

    @property
    def max_top_k(self) -> int:
        return max((t.top_k for t in self.tasks), default=0)

    @property
    def hit_bound(self) -> int:
        """Upper bound of ranked hits over all tasks (sum of queries x top_k)."""
        return sum(len(t.queries) * t.top_k for t in self.tasks)


TASK_SCHEMA = T.StructType(
    [
        T.StructField("task_name", T.StringType(), False),
        T.StructField("top_k", T.IntegerType(), False),
        T.StructField("final_event_cap", T.IntegerType(), False),
        T.StructField("max_content_chars", T.IntegerType(), False),
    ]
)

QUERY_SCHEMA = T.StructType(
    [
        T.StructField("task_name", T.StringType(), False),
        T.StructField("query_idx", T.IntegerType(), False),
        T.StructField("query_text", T.StringType(), False),
        T.StructField(
            "alternatives",
            T.ArrayType(T.ArrayType(T.ArrayType(T.StringType(), False), False), False),
            False,
        ),
        T.StructField("exclude_hosts", T.ArrayType(T.StringType(), False), False),
        T.StructField("primary_fails", T.BooleanType(), False),
    ]
)


def tasks_df(spark: SparkSession, cfg: TaskConfig) -> DataFrame:
    rows = [(t.name, t.top_k, t.final_event_cap, t.max_content_chars) for t in cfg.tasks]
    return spark.createDataFrame(rows, TASK_SCHEMA)


def queries_df(spark: SparkSession, cfg: TaskConfig) -> DataFrame:
    rows = []
    for t in cfg.tasks:
        for i, q in enumerate(t.queries):
            alts = [[[p.lower() for p in clause] for clause in alt] for alt in q.alternatives]
            rows.append((t.name, i, q.text, alts, [h.lower() for h in q.exclude_hosts], q.primary_fails))
    return spark.createDataFrame(rows, QUERY_SCHEMA)


#: Schema of a configuration file: one row per task.
CONFIG_SCHEMA = (
    "name string, top_k int, final_event_cap int, max_content_chars int, queries array<struct<text: string, "
    "alternatives: array<array<array<string>>>, exclude_hosts: array<string>, primary_fails: boolean>>"
)


def read_config(spark: SparkSession, path: str, format: str = "json", **run) -> TaskConfig:
    """Tasks from JSON lines or Parquet (``CONFIG_SCHEMA``), in the order of
    their names; missing caps take the defaults.  ``run``: the further fields
    of ``TaskConfig``."""
    rows = spark.read.schema(CONFIG_SCHEMA).format(format).load(path).orderBy("name").collect()  # configuration
    tasks = []
    for r in rows:
        queries = tuple(
            Query(
                q["text"],
                tuple(tuple(tuple(c) for c in alternative) for alternative in q["alternatives"] or ()),
                tuple(q["exclude_hosts"] or ()),
                bool(q["primary_fails"]),
            )
            for q in r["queries"] or ()
        )
        caps = {c: r[c] for c in ("top_k", "final_event_cap", "max_content_chars") if r[c] is not None}
        tasks.append(Task(r["name"], queries, **caps))
    return TaskConfig(tuple(tasks), **run)


def _q(text: str, *alternatives, exclude=(), fails=False) -> Query:
    return Query(text, tuple(tuple(tuple(c) for c in alt) for alt in alternatives), tuple(exclude), fails)


# Queries over the words of the driver's invented prose (English, French,
# German), used by the registered queries, the tests and the benchmark.
PROSE_CONFIG = TaskConfig(
    tasks=(
        Task(
            "prose_en",
            (
                _q('(the) (and OR attion)', [["the"], ["and", "attion"]]),
                _q('"of the" (with OR from)', [["of the"], ["with", "from"]]),
                _q('(que) (des) -site:blog.ththan.example.net',
                   [["que"], ["des"]], exclude=("blog.ththan.example.net",)),
                _q('(und) (der)', [["und"], ["der"]], fails=True),
            ),
            top_k=10,
            final_event_cap=20,
            max_content_chars=4000,
        ),
        Task(
            "prose_mixed",
            (
                _q('((que) (des)) OR ((und) (der))', [["que"], ["des"]], [["und"], ["der"]]),
                _q('(attion OR tion) (ing)', [["attion", "tion"], ["ing"]]),
                _q('(été OR über) -site:example.org', [["été", "über"]], exclude=("example.org",)),
            ),
            top_k=5,
            final_event_cap=12,
            max_content_chars=3500,
        ),
    ),
    blocked_host_tokens=("spam-farm", "cheap-pills"),
    run_id=K.DEFAULT_RUN_ID,
    run_ts=K.DEFAULT_RUN_TS,
)
