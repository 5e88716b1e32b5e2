"""The training state as tables: two slots that batches write by turns, and the rows in parts.

Batch N starts from the newest state of the batches before it and writes the
other slot, so the state it starts from stays until batch N + 1 is done. A
replayed batch finds the same start and writes the same state again. A slot
counts once its ``meta`` row is written, which comes last; every row of
``samples`` and ``values`` carries the batch it belongs to, so a slot that a
crash left half written is not mistaken for a whole one.

The rows of all batches lie beside the slots, in parts that are written once
and never changed; ``meta`` names those of its state. A batch adds one part,
into which it takes the last ones before it that are no larger, up to
``PART_ROWS``: a row is rewritten a logarithmic number of times at most, and the
parts stay few. Parts that neither slot names are removed after each commit.
A slot without that column, written when a state kept no rows, does not count:
its state is built again from the history.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.operators.training import TrainingState
from obsflow.sources.history import missing
from obsflow.sources.tables import local_table

SLOTS = (0, 1)
#: A part with at least this many rows is not rewritten.
PART_ROWS = 1_000_000


def _metas(spark: SparkSession, root: str) -> list[dict]:
    found = []
    for slot in SLOTS:
        try:
            found += [r.asDict() | {"slot": slot} for r in spark.read.parquet(f"{root}/slot{slot}/meta").limit(1).collect()]
        except AnalysisException as exc:
            if not missing(exc):
                raise
    return [m for m in found if "parts" in m]


def _meta(spark: SparkSession, root: str, before: int) -> dict | None:
    """The newest slot whose state holds only batches below ``before``."""
    return max((m for m in _metas(spark, root) if m["upto"] < before), key=lambda m: m["upto"], default=None)


def _parts(meta: dict) -> dict[str, int]:
    """The parts that a state names, oldest first, and how many rows each has."""
    return {name: int(n) for name, n in (p.split(":") for p in (meta["parts"] or "").split(",") if p)}


def _rows(spark: SparkSession, root: str, parts: list[str], feats: list[str]) -> DataFrame:
    schema = ", ".join(f"`{f}` double" for f in feats)
    if not parts:
        return local_table(spark, [], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/rows/{p}" for p in parts])


def load_state(spark: SparkSession, root: str, before: int) -> tuple[TrainingState | None, int | None]:
    """(state, its last batch): the newest state of batches below ``before``; (None, None) while there is none."""
    root = root.rstrip("/")
    m = _meta(spark, root, before)
    if m is None:
        return None, None

    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{root}/slot{m['slot']}/{name}").where(F.col("upto") == m["upto"]).drop("upto")
    feats = m["features"].split(",") if m["features"] else []
    parts = _parts(m)
    rows = None if m["parts"] is None else _rows(spark, root, list(parts), feats)
    return TrainingState(read("samples"), read("values"), m["n_rows"], feats, rows, None, parts), m["upto"]


def _stored(spark: SparkSession, state: TrainingState, root: str) -> dict[str, int]:
    """The parts of all rows of the state: those it has, and a new one with its fresh rows and the smaller parts before it."""
    parts = dict(state.parts)
    n = state.n_rows - sum(parts.values())
    if not n:
        return parts
    joined = []
    for name, have in reversed(state.parts.items()):
        if have >= PART_ROWS or have > n:
            break
        joined.append(name)
        n += parts.pop(name)
    rows = state.fresh.unionByName(_rows(spark, root, joined, state.features)) if joined else state.fresh
    name = uuid.uuid4().hex[:12]
    rows.write.parquet(f"{root}/rows/{name}")
    return parts | {name: n}


def _drop_unnamed(spark: SparkSession, root: str) -> None:
    """Remove the parts that neither slot names."""
    named = {p for m in _metas(spark, root) for p in _parts(m)}
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/rows")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for f in fs.listStatus(folder) if fs.exists(folder) else []:
        if f.getPath().getName() not in named:
            fs.delete(f.getPath(), True)


def save_state(spark: SparkSession, state: TrainingState, root: str, upto: int) -> TrainingState:
    """Write the state of all batches up to ``upto`` into the slot that it did not start from; returns it as read back."""
    root = root.rstrip("/")
    base = _meta(spark, root, upto)
    slot = 1 - base["slot"] if base else 0
    parts = None if state.rows is None else ",".join(f"{p}:{n}" for p, n in _stored(spark, state, root).items())
    mark = F.lit(int(upto)).cast("long").alias("upto")
    for name, df in (("samples", state.drawn), ("values", state.values),
                     ("meta", local_table(spark, [(int(state.n_rows), ",".join(state.features), parts)],
                                          "n_rows long, features string, parts string"))):
        df.select("*", mark).write.mode("overwrite").parquet(f"{root}/slot{slot}/{name}")
    state.drawn.unpersist()
    _drop_unnamed(spark, root)
    return load_state(spark, root, upto + 1)[0]
