"""Registry that pairs each Spark query with its SQL counterpart.

Input frames are bound to the given tables by SQL text both engines accept
(see ``frames``); a query works on the frames with the DataFrame library, its
SQL counterpart restates the operator on the same frames.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkgauge.catalog.frames import FRAMES
from sparkgauge.session import configure

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

QUERIES: dict[str, Callable[["Bound"], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under its inventory name, with its SQL when SQL can say it."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_frames(sql)
        return fn

    return add


def _needed(sql: str) -> list[str]:
    """Frames the text mentions, dependencies first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"[a-z_][a-z0-9_]*", text):
            if word in FRAMES and word not in order:
                visit(FRAMES[word])
                if word not in order:
                    order.append(word)

    visit(sql)
    return order


def with_frames(sql: str) -> str:
    """Put the input frames the text uses in front of it as common table expressions."""
    body = sql.strip()
    parts = [f"{name} AS ({FRAMES[name].strip()})" for name in _needed(body)]
    own = re.match(r"(?is)^with\s+(recursive\s+)?", body)
    if own:
        body = body[own.end() :]
        return "WITH RECURSIVE " + ",\n".join(parts + [body])
    return ("WITH RECURSIVE " + ",\n".join(parts) + "\n" if parts else "") + body


class Bound:
    """Frames of one data folder, as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._frames:
            if name in TABLES:
                self._frames[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            elif name in FRAMES:
                self._frames[name] = self._from_sql(FRAMES[name])
            else:
                raise AttributeError(name)
        return self._frames[name]

    def _from_sql(self, text: str) -> DataFrame:
        """Run frame text with every table or frame it names passed in as a DataFrame."""
        used = [w for w in dict.fromkeys(re.findall(r"[a-z_][a-z0-9_]*", text)) if w in TABLES or w in FRAMES]
        escaped = text.replace("{", "{{").replace("}", "}}")
        marked = re.sub(
            r"\b(FROM|JOIN)\s+(" + "|".join(used) + r")\b(\s+AS\s+\w+)?",
            lambda m: f"{m[1]} {{{m[2]}}}{m[3] or ' AS ' + m[2]}",
            escaped,
        )
        named = {w: getattr(self, w) for w in used if "{" + w + "}" in marked}
        return self.spark.sql(marked, **named)


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES[name](Bound(spark, sf_dir))
