"""Mixing sources to target weights by iterative proportional fitting (operator 9).

Documents fall into cells of source, language and topic; Spark sums the tokens of
each cell.  Raking then scales the cells' token weights to each target margin in
turn, again and again, never above what a cell holds, until all margins fit a total
of ``keep`` times the tokens.  A cell's fitted weight over its tokens is the
probability with which its documents are kept.

Values without a target share the cell ``other``, so there are at most
(sources + 1) (languages + 1) (topics + 1) cells whatever the data hold: that bound,
set by the parameters, is why raking may run on the driver and its result be
broadcast.  Documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SOURCES = {f"src{i}": 1 / 20 for i in range(20)}
LANGUAGES = {"en": 0.55, "de": 0.16, "fr": 0.15, "es": 0.14}
TOPICS = {"prose": 0.93, "contact": 0.02, "legal": 0.03, "table": 0.02}
KEEP = 0.5          # share of all tokens to keep
SWEEPS = 60
SEED = "mix-1"
MAX_TARGETS = 4096  # rows of a target table
OTHER = "other"


def topic_of(text: Column) -> Column:
    """A coarse topic from marks in the text; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    return (F.when(text.contains("icense"), "legal").when(text.contains("@"), "contact")
            .when(text.contains(" | "), "table").otherwise("prose"))


def tokens_of(text: Column) -> Column:
    """Tokens of a text, about: a quarter of its characters, rounded up; null has none."""
    return F.ceil(F.length(F.coalesce(text, F.lit(""))) / 4).cast("long")


def rake(tokens: np.ndarray, cells: list[tuple], targets: list[Mapping[str, float]],
         keep: float = KEEP, sweeps: int = SWEEPS) -> np.ndarray:
    """Probability of each cell: fitted token weight over tokens.

    ``cells[i][j]`` is the value of margin j in cell i.  Shares of a margin are scaled to
    those values that have tokens; values without a target keep their present share.
    """
    tokens = np.asarray(tokens, dtype=np.float64)
    total = tokens.sum()
    mass = tokens * keep
    margins = []
    for j, target in enumerate(targets):
        values = sorted({c[j] for c in cells})
        index = np.array([values.index(c[j]) for c in cells], dtype=np.int64)
        held = np.bincount(index, weights=tokens, minlength=len(values))
        share = np.array([target.get(v, h / total if total else 0.0) for v, h in zip(values, held)])
        share = np.where(held > 0, share, 0.0)
        margins.append((index, share / share.sum() * keep * total if share.sum() else share))
    for _ in range(sweeps):
        for index, want in margins:
            have = np.bincount(index, weights=mass, minlength=len(want))
            factor = np.divide(want, have, out=np.zeros_like(want), where=have > 0)
            mass = np.minimum(mass * factor[index], tokens)
    return np.divide(mass, tokens, out=np.zeros_like(mass), where=tokens > 0)


def read_targets(table: DataFrame, limit: int = MAX_TARGETS) -> dict[str, dict[str, float]]:
    """Targets from a table (margin, value, share), as keyword arguments of ``mixing_probabilities``.

    ``margin`` is ``sources``, ``languages`` or ``topics``; the shares of a margin need not sum to
    one.  A margin without rows has no targets: all its values are ``other`` and it moves nothing.
    Other columns are ignored.  More than ``limit`` rows, another margin, a null, a repeated value
    and a share that is not a number of zero or more are errors.
    """
    rows = table.select("margin", F.col("value").cast("string").alias("value"),
                        F.col("share").cast("double").alias("share")).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} targets")
    out: dict[str, dict[str, float]] = {"sources": {}, "languages": {}, "topics": {}}
    for margin, value, share in rows:
        if margin not in out:
            raise ValueError(f"unknown margin: {margin}")
        if value is None or share is None or not 0 <= share < float("inf"):
            raise ValueError(f"no target: {margin} {value} {share}")
        if value in out[margin]:
            raise ValueError(f"two targets: {margin} {value}")
        out[margin][value] = share
    return out


def _value(column: Column, target: Mapping[str, float]) -> Column:
    text = column.cast("string")
    return F.when(text.isin(*target), text).otherwise(OTHER)


def mixing_probabilities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         source_col: str = "source", lang_col: str = "lang", topic: Column | None = None,
                         sources: Mapping[str, float] = SOURCES, languages: Mapping[str, float] = LANGUAGES,
                         topics: Mapping[str, float] = TOPICS, keep: float = KEEP,
                         sweeps: int = SWEEPS, seed: str = SEED) -> DataFrame:
    """(_row, _cell_source, _cell_lang, _cell_topic, _tokens, _p, _kept) per document.

    A document is kept if a uniform number drawn from the seed and its id (its text where the
    id is null) is below its cell's probability, so a row that is repeated is kept or left as
    often as it occurs.  Null and unlisted values fall into the cell ``other``; documents
    without text have no tokens and probability 0; an empty table gives an empty result.
    """
    topic = topic_of(F.col(text_col)) if topic is None else topic
    key = F.coalesce(F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(seed), key)), 1, 8), 16, 10).cast("double") / float(1 << 32)
    x = docs.select(F.struct("*").alias("_row"), _value(F.col(source_col), sources).alias("_cell_source"),
                    _value(F.col(lang_col), languages).alias("_cell_lang"), _value(topic, topics).alias("_cell_topic"),
                    tokens_of(F.col(text_col)).alias("_tokens"), draw.alias("_draw"))
    names = ["_cell_source", "_cell_lang", "_cell_topic"]
    cells = sorted(x.groupBy(*names).agg(F.sum("_tokens").alias("tokens")).collect())
    p = rake([c["tokens"] for c in cells], [tuple(c[:3]) for c in cells], [sources, languages, topics], keep, sweeps)
    table = docs.sparkSession.createDataFrame(
        [(*c[:3], float(v)) for c, v in zip(cells, p)], ", ".join(f"{n} string" for n in names) + ", _p double")
    return x.join(F.broadcast(table), names).withColumn("_kept", F.col("_draw") < F.col("_p")).drop("_draw")


def sample_to_targets(docs: DataFrame, **parameters) -> DataFrame:
    """The kept rows of ``docs``, all columns unchanged (see ``mixing_probabilities``)."""
    return mixing_probabilities(docs, **parameters).where("_kept").select("_row.*")


def mixing_sql(sources: Mapping[str, float] = SOURCES, languages: Mapping[str, float] = LANGUAGES,
               topics: Mapping[str, float] = TOPICS, keep: float = KEEP, sweeps: int = SWEEPS, seed: str = SEED) -> str:
    """DuckDB twin: doc_id, cell_source, cell_lang, cell_topic, tokens, p, kept."""
    def pairs(name, target):
        return f"SELECT '{name}' AS margin, * FROM (VALUES " + ", ".join(f"('{k}', CAST({v!r} AS DOUBLE))" for k, v in target.items()) + ") AS x(v, share)"

    def value(column, target):
        return f"CASE WHEN {column} IN ({', '.join(repr(k) for k in target)}) THEN {column} ELSE '{OTHER}' END"

    def fit(inner, column):
        return (f"SELECT s, l, t, tokens, it, ws, wl, wt, CASE WHEN sum(m) OVER (PARTITION BY {column}) > 0 THEN "
                f"least(m * (w{column} / sum(m) OVER (PARTITION BY {column})), tokens) ELSE 0 END AS m FROM ({inner})")

    step = fit(fit(fit(f"SELECT s, l, t, tokens, it + 1 AS it, ws, wl, wt, m FROM r WHERE it < {sweeps}", "s"), "l"), "t")
    margin = " UNION ALL ".join(
        f"SELECT '{c}' AS margin, {c} AS v, sum(tokens) AS held, sum(sum(tokens)) OVER () AS total FROM cell GROUP BY {c}" for c in "slt")
    return f"""
WITH RECURSIVE target AS ({pairs('s', sources)} UNION ALL {pairs('l', languages)} UNION ALL {pairs('t', topics)}),
doc AS (
  SELECT doc_id, {value('source', sources)} AS s, {value('lang', languages)} AS l,
         CASE WHEN coalesce(text, '') LIKE '%icense%' THEN 'legal' WHEN coalesce(text, '') LIKE '%@%' THEN 'contact'
              WHEN coalesce(text, '') LIKE '% | %' THEN 'table' ELSE 'prose' END AS t,
         CAST(ceil(length(coalesce(text, '')) / 4.0) AS BIGINT) AS tokens,
         CAST(('0x' || substr(md5('{seed}' || coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))), 1, 8)) AS BIGINT) / 4294967296.0 AS draw
  FROM documents),
cell AS (SELECT s, l, t, CAST(sum(tokens) AS DOUBLE) AS tokens FROM doc GROUP BY 1, 2, 3),
margin AS ({margin}),
wanted AS (
  SELECT m.margin, m.v, CASE WHEN held > 0 THEN coalesce(share, held / total) ELSE 0 END AS share, total
  FROM margin m LEFT JOIN target USING (margin, v)),
want AS (SELECT margin, v, share / sum(share) OVER (PARTITION BY margin) * {keep} * total AS w FROM wanted),
r AS (
  SELECT cell.s, cell.l, cell.t, tokens, 0 AS it, a.w AS ws, b.w AS wl, c.w AS wt, tokens * {keep} AS m
  FROM cell JOIN want a ON a.margin = 's' AND a.v = s JOIN want b ON b.margin = 'l' AND b.v = l
  JOIN want c ON c.margin = 't' AND c.v = t
  UNION ALL SELECT s, l, t, tokens, it, ws, wl, wt, m FROM ({step})),
fitted AS (SELECT s, l, t, CASE WHEN tokens > 0 THEN m / tokens ELSE 0 END AS p FROM r WHERE it = {sweeps})
SELECT doc_id, s AS cell_source, l AS cell_lang, t AS cell_topic, tokens, round(p, 6) AS p, draw < p AS kept
FROM doc JOIN fitted USING (s, l, t)
"""
