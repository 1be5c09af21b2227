"""Mixing sources to target weights: iterative proportional fitting, then sampling by calibrated probabilities.

Token counts are summed by cell (source, language, topic). Fitting scales the cells' wanted tokens to the targets of each
margin in turn, within what a cell holds (Dykstra's correction for that bound), so a document's probability, wanted
over held tokens of its cell, never exceeds 1 and the expected tokens meet the margins. Values that the targets do not
name share one value, "other", so there are at most the product of the numbers of targets of cells, however
large the corpus is; only these sums reach the driver. A target above what a value holds is lowered to it and its rest is
dealt to the others.

A document is sampled if the hash of its doc_id falls below its probability, so equal ids fare alike at any size and order.

Cases: a null text or an empty one has no tokens; a null source or language counts as "other"; repeated rows fare alike; an
empty table gives no rows; only doc_id, text, source and lang are read, whatever other columns there are; a null doc_id
is hashed as an empty string.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOPICS = ("table", "legal", "brief", "article", "long")
OTHER = "other"
#: Cells up to which the fitted probabilities are broadcast; beyond, Spark chooses the join.
BROADCAST_CELLS = 100_000


@dataclass(frozen=True)
class Targets:
    """Shares of tokens by margin; they need not sum to 1. keep: the share of all tokens to sample."""

    source: dict[str, float] = field(default_factory=lambda: {"src0": 0.10, **{f"src{k}": 0.045 for k in range(1, 20)}})
    lang: dict[str, float] = field(default_factory=lambda: {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15})
    topic: dict[str, float] = field(default_factory=lambda: {"table": 0.05, "legal": 0.05, "brief": 0.15, "article": 0.55, "long": 0.20})
    other: float = 0.01
    keep: float = 0.5
    rounds: int = 200
    seed: str = "mix"


def token_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def topic_of(text: Column, n_tokens: Column) -> Column:
    """A topic by form: rows of cells, licence text, else by length."""
    return F.when(F.contains(text, F.lit(" | ")), "table").when(F.contains(text, F.lit("icense")), "legal").when(n_tokens < 100, "brief").when(n_tokens < 1000, "article").otherwise("long")


def in_targets(value: Column, shares: dict[str, float]) -> Column:
    return F.when(value.isin(list(shares)), value).otherwise(OTHER)


def dealt_targets(held: dict[str, float], shares: dict[str, float], total: float, other: float) -> dict[str, float]:
    """Wanted tokens by value: total by share, at most what is held; what is cut off goes to the other values by share."""
    shares = {v: shares.get(v, other) for v in held}
    wanted = dict.fromkeys(held, 0.0)
    open_values, left = {v for v in held if held[v] > 0 and shares[v] > 0}, total
    while open_values and left > 0:
        unit = left / sum(shares[v] for v in open_values)
        full = {v for v in open_values if shares[v] * unit >= held[v]}
        if not full:
            wanted |= {v: shares[v] * unit for v in open_values}
            break
        wanted |= {v: float(held[v]) for v in full}
        left -= sum(held[v] for v in full)
        open_values -= full
    return wanted


def fit(cells: list[tuple[str, str, str, int]], targets: Targets) -> np.ndarray:
    """The probability of each cell (source, lang, topic, tokens)."""
    if not cells:
        return np.zeros(0)
    held = np.array([c[3] for c in cells], float)
    margins = []
    for k, shares in enumerate((targets.source, targets.lang, targets.topic)):
        values = sorted({c[k] for c in cells})
        at = np.array([values.index(c[k]) for c in cells], int)
        sums = np.bincount(at, held, len(values))
        wanted = dealt_targets(dict(zip(values, sums, strict=True)), shares, targets.keep * held.sum(), targets.other)
        margins.append((at, np.array([wanted[v] for v in values], float)))
    now, correction = held * targets.keep, np.ones(len(cells))
    for _ in range(targets.rounds):
        for at, wanted in margins:
            sums = np.bincount(at, now, len(wanted))
            now = now * np.divide(wanted, sums, out=np.zeros_like(sums), where=sums > 0)[at]
        free = now * correction
        now = np.minimum(free, held)
        correction = np.divide(free, now, out=np.ones_like(now), where=now > 0)
    return np.round(np.divide(now, held, out=np.zeros_like(now), where=held > 0), 9)


def weighted(docs: DataFrame, targets: Targets, carry: tuple[str, ...] = ()) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), in_targets(F.col("source"), targets.source).alias("source"), in_targets(F.col("lang"), targets.lang).alias("lang"), token_count(text).alias("n_tokens"), text.alias("text"), *carry)
    return counted.select("doc_id", "source", "lang", topic_of(F.col("text"), F.col("n_tokens")).alias("topic"), "n_tokens", *carry)


def mix(spark: SparkSession, docs: DataFrame, targets: Targets | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, probability and sampled of every row of docs, and its columns named in carry."""
    targets = targets or Targets()
    rows = weighted(docs, targets, carry)
    keys = ["source", "lang", "topic"]
    cells = sorted(tuple(r) for r in rows.groupBy(*keys).agg(F.sum("n_tokens").alias("n")).collect())
    chances = fit(cells, targets)
    table = spark.createDataFrame([(*c[:3], float(p)) for c, p in zip(cells, chances, strict=True)], "source string, lang string, topic string, probability double")
    chosen = rows.join(F.broadcast(table) if len(cells) <= BROADCAST_CELLS else table, keys)
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(targets.seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))
    return chosen.select("doc_id", *keys, "n_tokens", "probability", (draw < F.col("probability")).alias("sampled"), *carry)


def oracle(targets: Targets | None = None) -> str:
    """The same in DuckDB's SQL; fitting is a recursion over the cells."""
    t = targets or Targets()

    def shares(name: str, values: dict[str, float]) -> str:
        return f"SELECT * FROM (VALUES {', '.join(f'({v!r}, CAST({s!r} AS DOUBLE))' for v, s in values.items())}, ('{OTHER}', CAST({t.other!r} AS DOUBLE))) AS s({name}, share)"

    def known(name: str, values: dict[str, float]) -> str:
        return f"CASE WHEN {name} IN ({', '.join(repr(v) for v in values)}) THEN {name} ELSE '{OTHER}' END"

    margins = []
    for name, values in (("source", t.source), ("lang", t.lang), ("topic", t.topic)):
        margins.append(f"""share_{name} AS ({shares(name, values)}),
held_{name} AS MATERIALIZED (SELECT {name}, held, share, row_number() OVER (ORDER BY held / share, {name}) AS rank FROM (SELECT {name}, sum(held) AS held FROM cells GROUP BY {name}) JOIN share_{name} USING ({name}) WHERE held > 0),
before_{name} AS (SELECT *, coalesce(sum(held) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before, sum(share) OVER (ORDER BY rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share_left FROM held_{name}),
cut_{name} AS (SELECT *, (SELECT {t.keep!r} * sum(held) FROM cells) - full_before AS remaining FROM before_{name}),
unit_{name} AS (SELECT min_by(remaining / share_left, rank) AS unit, min(rank) AS rank FROM cut_{name} WHERE share * remaining / share_left < held),
want_{name} AS MATERIALIZED (SELECT {name}, CASE WHEN c.rank < u.rank OR u.rank IS NULL THEN held ELSE share * unit END AS want FROM cut_{name} c CROSS JOIN unit_{name} u)""")
    step = lambda name, below: f"SELECT * REPLACE (coalesce(now * want_{name} / nullif(sum(now) OVER (PARTITION BY {name}), 0), 0) AS now) FROM ({below})"
    inner = step("topic", step("lang", step("source", f"SELECT * FROM fitted WHERE round < {t.rounds}")))
    return f"""WITH RECURSIVE counted AS (SELECT doc_id, {known('source', t.source)} AS source, {known('lang', t.lang)} AS lang, coalesce(text, '') AS text, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM documents),
docs AS MATERIALIZED (SELECT doc_id, source, lang, CASE WHEN contains(text, ' | ') THEN 'table' WHEN contains(text, 'icense') THEN 'legal' WHEN n_tokens < 100 THEN 'brief' WHEN n_tokens < 1000 THEN 'article' ELSE 'long' END AS topic, n_tokens FROM counted),
cells AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS held FROM docs GROUP BY ALL),
{(',' + chr(10)).join(margins)},
fitted AS (SELECT source, lang, topic, held, coalesce(s.want, 0) AS want_source, coalesce(l.want, 0) AS want_lang, coalesce(p.want, 0) AS want_topic, held * {t.keep!r} AS now, CAST(1 AS DOUBLE) AS correction, 0 AS round
  FROM cells LEFT JOIN want_source s USING (source) LEFT JOIN want_lang l USING (lang) LEFT JOIN want_topic p USING (topic)
UNION ALL SELECT source, lang, topic, held, want_source, want_lang, want_topic, least(now * correction, held), CASE WHEN least(now * correction, held) > 0 THEN now * correction / least(now * correction, held) ELSE 1 END, round + 1 FROM ({inner})),
chances AS (SELECT source, lang, topic, round(CASE WHEN held > 0 THEN now / held ELSE 0 END, 9) AS probability FROM fitted WHERE fitted.round = {t.rounds})
SELECT doc_id, source, lang, topic, n_tokens, probability, CAST(CAST('0x' || substr(md5('{t.seed}' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) AS DOUBLE) / {float(1 << 48)!r} < probability AS sampled FROM docs JOIN chances USING (source, lang, topic)"""
