"""Mixing to target weights by iterative proportional fitting.

Tokens are summed by cell (source, language, topic). The cells' probabilities are raked: scaled in turn so that
the expected tokens of each source, language and topic meet their target, which is its share of the tokens to keep
(KEEP of all), and held at 1 at most, until all targets are met. A document is kept with its cell's probability, by
a hash of its id and text; so the kept tokens have the target shares in expectation, and a rerun keeps the same.

Up to DRIVER_CELLS cells are raked in arrays at the driver; more stay in Spark, where each sweep is written and the
driver sees one number of it. Both do the same arithmetic, zero and unmet targets included. Targets of a margin are given as
shares, or by default its observed shares to the power SOFTEN, made to sum to 1; values without a given target share
what is left of 1 as they were observed. A target of zero keeps nothing of its value, and a margin whose targets are
all zero nothing at all. Margins that no probabilities up to 1 can meet end after SWEEPS with the nearest that raking
came to: their cells are kept whole.

Nulls: a null source, language or topic is a value of its own, shown as NONE; a null text has no tokens and the
probability of its cell. A cell without tokens is kept as KEEP says. Equal rows meet one fate. Extra
columns are kept by ``sample``; a column `topic` is used where there is one."""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tollway.llm.common import row_key, small_batches, step, written

MARGINS = ("source", "lang", "topic")
NONE = "(none)"
SOFTEN = 0.85
KEEP = 0.6
SWEEPS = 20
TOLERANCE = 1e-4
SEED = 20
#: A probability that moves are measured against at least; cells of a zero target have none.
TINY = 1e-300
#: Cells that the driver takes at most: some 10 MB.
DRIVER_CELLS = 100_000

# Frequent English words of a few fields, the fields in the order that settles ties.
TOPICS = {
    "science": "science scientists research theory experiment species energy physics biology chemistry climate planet cells data species evidence laboratory",
    "technology": "software computer internet code programming server network database algorithm device app users digital online website version",
    "business": "market company business investors economy bank trade sales price revenue profit stock industry customers financial growth",
    "politics": "government president election minister party parliament policy vote senate campaign political congress state leader democratic republican",
    "law": "court law judge legal lawyer license copyright trial police crime rights contract justice attorney liability plaintiff",
    "health": "health hospital patient patients doctor doctors disease medical vaccine treatment drug symptoms virus surgery diet clinical",
    "sport": "team match league season player players coach goal football championship tournament race olympic cup score stadium",
    "arts": "music film book art novel album song theatre artist movie museum poem stage painting author band",
}


FIELDS = {name: frozenset(own.encode().split()) for name, own in TOPICS.items()}
KNOWN = frozenset().union(*FIELDS.values())


def read(text: bytes) -> tuple[int, str]:
    """Tokens of a text (runs of bytes that are not ASCII white space), and the field with most of its words among them; `general` if there is none."""
    words = text.lower().split()
    some = KNOWN.intersection(words)
    return len(words), max(FIELDS, key=lambda name: len(FIELDS[name] & some)) if some else "general"


@F.arrow_udf(StructType([StructField("n", LongType()), StructField("topic", StringType())]))
def reading(texts: pa.Array) -> pa.Array:
    found = [read(x or b"") for x in texts.cast(pa.binary()).to_pylist()]
    return pa.StructArray.from_arrays([pa.array([n for n, _ in found], pa.int64()), pa.array([t for _, t in found], pa.string())], names=["n", "topic"])


def targets(cells: DataFrame, margin: str, given: dict[str, float] | None) -> DataFrame:
    """(value, target) of each value of a margin that has tokens; targets sum to 1."""
    seen = cells.groupBy(F.col(margin).alias("value")).agg(F.sum("tokens").alias("t"))
    if given is None:
        seen = seen.withColumn("raw", F.pow(F.col("t").cast("double"), F.lit(SOFTEN)))
    else:
        share = F.coalesce(*[F.when(F.col("value") == k, F.lit(float(v))) for k, v in given.items()], F.lit(None).cast("double"))
        rest = max(0.0, 1.0 - sum(given.values()))
        seen = seen.withColumn("given", share)
        free = seen.where("given is null").agg(F.sum("t")).first()[0] or 1
        seen = seen.withColumn("raw", F.coalesce("given", F.lit(float(rest)) * F.col("t") / F.lit(float(free))))
    total = seen.agg(F.sum("raw")).first()[0] or 1.0
    return seen.select("value", (F.col("raw") / F.lit(total)).alias("target"))


def _rake_in_spark(cells: DataFrame, given: dict[str, dict[str, float]], keep: float, sweeps: int, tolerance: float) -> DataFrame:
    cells = cells.withColumn("probability", F.lit(float(keep)))
    full = cells.where("tokens > 0")
    budget = keep * (full.agg(F.sum("tokens")).first()[0] or 0)
    wanted = {m: written(targets(full, m, given.get(m)), "targets") for m in MARGINS}
    for _ in range(sweeps):
        now = cells
        for m in MARGINS:
            mass = now.groupBy(m).agg(F.sum(F.col("probability") * F.col("tokens")).alias("mass"))
            scale = mass.join(wanted[m].withColumnRenamed("value", m), m, "left").select(m, F.when(F.col("mass") > 0, F.col("target") * budget / F.col("mass")).alias("scale"))
            moved = F.least(F.lit(1.0), F.col("probability") * F.coalesce("scale", F.lit(1.0)))
            off = F.abs(moved / F.greatest("probability", F.lit(TINY)) - 1)
            now = now.join(scale, m).select(*MARGINS, "tokens", moved.alias("probability"), off.alias(f"off_{m}"), *[c for c in now.columns if c.startswith("off_")])
        now = written(now, "cells")
        off = now.where("tokens > 0").agg(F.max(F.greatest(*[f"off_{m}" for m in MARGINS]))).first()[0]
        cells = now.select(*MARGINS, "tokens", "probability")
        if off is None or off < tolerance:
            break
    return written(cells, "cells")


def shares(tokens: dict[str, float], given: dict[str, float] | None) -> dict[str, float]:
    """Target of each value of a margin, by its tokens; targets sum to 1."""
    if given is None:
        raw = {v: t**SOFTEN for v, t in tokens.items()}
    else:
        free, rest = sum(t for v, t in tokens.items() if v not in given) or 1, max(0.0, 1.0 - sum(given.values()))
        raw = {v: float(given[v]) if v in given else rest * t / free for v, t in tokens.items()}
    total = sum(raw.values()) or 1.0
    return {v: x / total for v, x in raw.items()}


def _rake_at_driver(rows: list, given: dict[str, dict[str, float]], keep: float, sweeps: int, tolerance: float) -> list[float]:
    tokens = np.array([r["tokens"] for r in rows], float)
    budget = keep * tokens.sum()
    margins = []
    for m in MARGINS:
        values, code = np.unique([r[m] for r in rows], return_inverse=True)
        mass = np.bincount(code, tokens, len(values))
        target = shares({v: t for v, t in zip(values.tolist(), mass.tolist(), strict=True) if t > 0}, given.get(m))
        margins.append((code, np.array([target.get(v, 0.0) * budget for v in values.tolist()])))
    p = np.full(len(rows), float(keep))
    for _ in range(sweeps):
        off = 0.0
        for code, target in margins:
            mass = np.bincount(code, p * tokens, len(target))
            scale = np.divide(target, mass, out=np.ones_like(target), where=mass > 0)[code]
            moved = np.minimum(1.0, p * scale)
            if (some := tokens > 0).any():
                off = max(off, float(np.abs(moved[some] / np.maximum(p[some], TINY) - 1).max()))
            p = moved
        if off < tolerance:
            break
    return p.tolist()


def rake(cells: DataFrame, given: dict[str, dict[str, float]] | None = None, keep_share: float = KEEP, sweeps: int = SWEEPS, tolerance: float = TOLERANCE, driver_cells: int = DRIVER_CELLS) -> DataFrame:
    """cells (margins, tokens) with probability."""
    with step(cells.sparkSession) as keep:
        cells = written(cells, "cells")
        if cells.count() > driver_cells:
            return keep(_rake_in_spark(cells, given or {}, keep_share, sweeps, tolerance))
        rows = sorted(cells.collect())
        found = _rake_at_driver(rows, given or {}, keep_share, sweeps, tolerance) if rows else []
        out = cells.sparkSession.createDataFrame([(*r, p) for r, p in zip(rows, found, strict=True)], "source string, lang string, topic string, tokens long, probability double")
        return keep(written(out, "cells"))  # a table's size is known, so that a small one is broadcast


def chance() -> Column:
    """A number in [0, 1) by doc_id and text."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "doc_id", *row_key(F.col("text"))), 11) / F.lit(float(1 << 53))


def tagged(docs: DataFrame) -> DataFrame:
    """The documents as `_row`, with the id, cell, tokens and chance of each."""
    small_batches(docs.sparkSession)
    value = lambda c: (F.coalesce(F.col(c).cast("string"), F.lit(NONE)) if c in docs.columns else F.lit(NONE)).alias(c)
    rows = docs.select(F.struct("*").alias("_row"), "doc_id", *map(value, MARGINS), chance().alias("chance"), reading(F.coalesce("text", F.lit(""))).alias("_read"))
    topic = F.col("topic" if "topic" in docs.columns else "_read.topic").alias("topic")
    return rows.select("_row", "doc_id", "source", "lang", topic, F.col("_read.n").alias("n_tokens"), "chance")


def cells_of(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens"))


def mix(docs: DataFrame, given: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """One row per document: doc_id, source, lang, topic, n_tokens, probability, kept."""
    rows = written(tagged(docs).drop("_row"), "rows")
    found = rows.join(rake(cells_of(rows), given), list(MARGINS))
    return found.select("doc_id", *MARGINS, "n_tokens", "probability", (F.col("chance") < F.col("probability")).alias("kept"))


def sample(docs: DataFrame, given: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """The documents that are kept, with their own columns."""
    rows = tagged(docs)
    cells = rake(cells_of(rows), given).select(*MARGINS, "probability")
    return rows.join(cells, list(MARGINS)).where("chance < probability").select("_row.*")
