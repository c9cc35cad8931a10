"""Mixing sources to target weights by iterative proportional fitting.

Token counts are summed by cell (source, language, topic). Fitting rakes the cells' weights to one set of marginals
after the other until all hold within TOLERANCE. A cell's weight over its tokens is how much more or less of it is wanted.
Scaled, that is the probability with which its documents are sampled, and the expected mixture has the target marginals.

The scale must not hang on a few rows: the cells that are wanted most, up to SPARED of all tokens, are kept whole, and the
scale is where the others begin. So a stray row of a cell of its own changes nobody else's probability.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

DIMENSIONS = ("source", "lang", "topic")
#: Where no target shares are given: a value's share is its share of tokens to this power, rescaled.
TEMPER = {"source": 0.8, "lang": 0.9, "topic": 1.0}
BYTES_A_TOKEN = 4
#: The largest error of a marginal share after fitting, and the rounds after which targets count as out of reach.
TOLERANCE, ROUNDS = 1e-12, 30
#: Rounds between two writings of the cells, which keep the plan short.
WRITTEN_EVERY = 3
#: The share of all tokens in cells that may be wanted more than the scale allows.
SPARED = 0.01
#: Ratios are told apart by so many steps from a power of two to the next.
STEPS = 256
SEED = "mix-1"
#: The label of a null source or language.
NONE = "(none)"
# What tells a topic, by the first that holds.
LICENCE, MAIL = "(?i)(licen[sc]e|copyright)", "[A-Za-z0-9._%+-]@[A-Za-z0-9-]+[.][A-Za-z]"


def n_tokens(text: Column) -> Column:
    """Tokens of a text as its bytes tell; a null text has none."""
    return F.floor((F.octet_length(F.coalesce(text, F.lit(""))) + BYTES_A_TOKEN - 1) / F.lit(BYTES_A_TOKEN)).cast("long")


def topic(text: Column) -> Column:
    return (
        F.when(F.coalesce(text, F.lit("")) == "", "empty")
        .when(text.rlike(LICENCE), "licence")
        .when(F.contains(text, F.lit("@")) & text.rlike(MAIL), "contact")
        .otherwise("prose")
    )


def _labels(docs: DataFrame) -> dict[str, Column]:
    return {
        "source": F.coalesce(docs["source"], F.lit(NONE)),
        "lang": F.coalesce(docs["lang"], F.lit(NONE)),
        "topic": topic(docs["text"]),
    }


def uniform(docs: DataFrame, seed: str) -> Column:
    """A number in [0, 1) that the doc_id decides (of a row without one, the text)."""
    key = F.coalesce(docs["doc_id"].cast("string"), F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary")))
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), key).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**13))


def targets(cells: DataFrame, dimension: str, shares: dict[str, float] | None) -> DataFrame:
    """(dimension, target): target shares that sum to 1. Values that ``shares`` leaves out get none."""
    own = cells.groupBy(dimension).agg(F.sum("tokens").alias("tokens"))
    if shares is None:
        own = own.withColumn("raw", F.pow(F.col("tokens").cast("double"), F.lit(TEMPER[dimension])))
    else:
        given = F.create_map(*[F.lit(x) for value in shares.items() for x in value])
        own = own.withColumn("raw", F.coalesce(F.element_at(given, F.col(dimension)), F.lit(0.0)))
    total = own.agg(F.sum("raw")).first()[0] or 1.0
    return own.select(dimension, (F.col("raw") / F.lit(float(total))).alias(f"target_{dimension}"))


def rake(cells: DataFrame, shares: dict[str, dict[str, float]] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with ``weight`` fitted to the targets of all three dimensions.

    Rounds go on until the largest error of a marginal is below TOLERANCE; targets that ``rounds`` rounds do not reach
    (there may be no cell to carry them) are warned of. The rows of this table are the distinct cells, so a
    value's rows are few even if it holds most of the corpus.
    """
    out = cells.withColumn("weight", F.col("tokens").cast("double"))
    for dimension in DIMENSIONS:
        out = out.join(targets(cells, dimension, (shares or {}).get(dimension)), dimension)
    margins = {d: F.sum("weight").over(Window.partitionBy(d)) for d in DIMENSIONS}
    for k in range(1, rounds + 1):
        for dimension, margin in margins.items():
            out = out.withColumn("weight", F.when(margin > 0, F.col("weight") * F.col(f"target_{dimension}") / margin).otherwise(0.0))
        if k % WRITTEN_EVERY == 0 or k == rounds:
            out = materialize(out, "cells")
            gaps = out.select(F.greatest(*[F.abs(margin - F.col(f"target_{d}")) for d, margin in margins.items()]).alias("gap"))
            worst = gaps.agg(F.max("gap")).first()[0] or 0.0
            if worst <= TOLERANCE:
                return out
    warnings.warn(f"after {rounds} rounds a marginal share is still off by {worst:.2g}", stacklevel=2)
    return out


def _step(ratio: Column) -> Column:
    return F.floor(F.log2(ratio) * STEPS)


def scale(fitted: DataFrame) -> float:
    """The ratio that becomes probability 1: cells with a larger one hold SPARED of all tokens at most.

    Tokens are summed by steps of the ratio, of which there are few however many cells there are; the scale is the
    largest ratio of its step.
    """
    own = fitted.filter("ratio > 0").groupBy(_step(F.col("ratio")).alias("step"))
    steps = own.agg(F.sum("tokens").alias("tokens"), F.max("ratio").alias("ratio"))
    above = F.sum("tokens").over(Window.orderBy(F.desc("step")))  # at most 2048 * STEPS rows
    whole = steps.agg(F.sum("tokens")).scalar()
    spared = F.col("above") <= whole * SPARED
    first = steps.withColumn("above", above).filter(~spared).agg(F.max_by("ratio", "step")).first()[0]
    return 1.0 if first is None else first


def probabilities(docs: DataFrame, shares: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """(source, lang, topic, probability) of each cell."""
    cells = docs.select(*[c.alias(k) for k, c in _labels(docs).items()], n_tokens(docs["text"]).alias("tokens"))
    cells = materialize(cells.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "cells")
    fitted = rake(cells, shares).withColumn("ratio", F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")))
    # a cell without tokens weighs nothing in any marginal: its documents are kept
    wanted = F.least(F.col("ratio") / F.lit(scale(fitted)), F.lit(1.0))
    return fitted.select(*DIMENSIONS, F.coalesce(wanted, F.lit(1.0)).alias("probability"))


def _with_probability(docs: DataFrame, shares: dict[str, dict[str, float]] | None) -> DataFrame:
    """(row, source, lang, topic, draw, probability), where ``row`` holds the columns of ``docs`` whatever their names."""
    chances = probabilities(docs, shares)
    own = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        *[c.alias(k) for k, c in _labels(docs).items()],
        uniform(docs, SEED).alias("draw"),
    )
    return own.join(chances, list(DIMENSIONS))


def mix(docs: DataFrame, shares: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """One row for each row of ``docs``: doc_id, source, lang, topic, n_tokens, probability (9 digits), sampled.

    ``docs`` needs doc_id, text, lang and source. ``shares`` gives target shares of tokens by dimension and value; a
    dimension that it leaves out is tempered. A null source or language is the value ``(none)``, a null text is empty
    (topic ``empty``, no tokens, probability 1). The doc_id decides a draw, so a repeated row shares its fate; that of
    a row without doc_id is decided by its text. Extra columns play no part. An empty table gives an empty one.
    """
    drawn = _with_probability(docs.select("doc_id", "text", "lang", "source"), shares)
    return drawn.select(
        "row.doc_id",
        *DIMENSIONS,
        n_tokens(F.col("row.text")).alias("n_tokens"),
        F.round("probability", 9).alias("probability"),
        (F.col("draw") < F.col("probability")).alias("sampled"),
    )


def sample(docs: DataFrame, shares: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """The sampled rows of ``docs``, with all their columns."""
    return _with_probability(docs, shares).filter(F.col("draw") < F.col("probability")).select("row.*")


def sql() -> str:
    """The same in SQL: the rounds of fitting written out one after the other."""
    steps = [
        f"""labelled AS (
  SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang,
    CASE WHEN coalesce(text, '') = '' THEN 'empty' WHEN regexp_matches(text, '{LICENCE}') THEN 'licence'
      WHEN regexp_matches(text, '{MAIL}') THEN 'contact' ELSE 'prose' END AS topic,
    (strlen(coalesce(text, '')) + {BYTES_A_TOKEN - 1}) // {BYTES_A_TOKEN} AS n_tokens,
    CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))), 1, 13) AS BIGINT)
      / CAST({16**13} AS DOUBLE) AS draw
  FROM documents)""",
        "cells AS (SELECT source, lang, topic, sum(n_tokens) AS tokens FROM labelled GROUP BY ALL)",
    ]
    for d in DIMENSIONS:
        steps.append(
            f"t_{d} AS (SELECT {d}, raw / sum(raw) OVER () AS target_{d} FROM "
            f"(SELECT {d}, pow(CAST(sum(tokens) AS DOUBLE), {TEMPER[d]}) AS raw FROM cells GROUP BY {d}))"
        )
    joins = " ".join(f"JOIN t_{d} USING ({d})" for d in DIMENSIONS)
    steps.append(f"r_0 AS (SELECT cells.*, CAST(tokens AS DOUBLE) AS weight, target_source, target_lang, target_topic FROM cells {joins})")
    k = 0
    for _ in range(ROUNDS):
        for d in DIMENSIONS:
            margin = f"sum(weight) OVER (PARTITION BY {d})"
            steps.append(
                f"r_{k + 1} AS (SELECT * REPLACE (CASE WHEN {margin} > 0 THEN weight * target_{d} / {margin} ELSE 0 END AS weight) FROM r_{k})"
            )
            k += 1
    steps.append(f"ratios AS (SELECT source, lang, topic, tokens, CASE WHEN tokens > 0 THEN weight / tokens END AS ratio FROM r_{k})")
    steps.append(
        f"steps AS (SELECT floor(log2(ratio) * {STEPS}) AS step, sum(tokens) AS tokens, max(ratio) AS ratio FROM ratios WHERE ratio > 0 GROUP BY 1)"
    )
    steps.append(
        f"scales AS (SELECT coalesce(max_by(ratio, step), 1) AS scale FROM (SELECT step, ratio, "
        f"sum(tokens) OVER (ORDER BY step DESC) AS above, sum(tokens) OVER () AS whole FROM steps) WHERE above > whole * {SPARED})"
    )
    steps.append("chances AS (SELECT source, lang, topic, coalesce(least(ratio / scale, 1), 1) AS probability FROM ratios, scales)")
    return (
        "WITH " + ",\n".join(steps) + "\nSELECT doc_id, source, lang, topic, n_tokens, round(probability, 9) AS probability, "
        "draw < probability AS sampled FROM labelled JOIN chances USING (source, lang, topic)"
    )
