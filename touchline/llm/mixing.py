"""Mixing sources to target weights by iterative proportional fitting.

Token counts of (source, language, topic) cells are raked until the marginals
of all three meet their targets. The mixture's total is the largest for which the
cells have all but ``shortfall`` of the tokens they are to give, so a rare cell that
cannot give its share does not lower what is kept of the others. Cells short of
tokens give all they have, and raking goes on with that bound, so that others
of their margins make up for them. A cell's weight times the total over its
counted tokens is the probability with which its documents are kept. A hash of
the id decides, so the same document is always kept or not.

Cells, not documents, are raked: one aggregate with map-side sums makes them.
They are dealt over as many partitions as their number asks for, so a few
thousand cells are raked in one task without any exchange and millions of them
by three exchanges a round; the code is the same.

Defined cases: NULL in a margin column is a value of its own, shown as
``<missing>``; a NULL or empty text has one token; a NULL id is hashed as the text
``null``; repeated rows share their fate; an empty table gives no rows; extra
columns are kept; one with the name of a column that ``mix`` adds is an error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.registry import query, table
from touchline.operators.windows import Trailing, trailing
from touchline.session import written

MISSING = "<missing>"
ROUNDS = 24
ROUNDS_PER_PLAN = 6
# Rounds after the total is known, in which no cell exceeds what it has.
BOUNDED_ROUNDS = 6
# Share of the mixture's total that cells may lack before raking goes on within bounds.
SHORTFALL = 0.01
CELLS_PER_TASK = 100_000
SEED = "mix-1"

# A document's topic is the first with a marker in the text, else the last one.
TOPICS = [
    ("legal", ["License", "Copyright"]),
    ("credentials", ["AKIA", "password", "secret", "token"]),
    ("contact", ["@"]),
    ("tabular", [" | "]),
]
OTHER_TOPIC = "prose"
# Target share of a value: its share of all tokens to this power, scaled to sum to 1.
POWERS = {"source": 0.7, "lang": 0.8, "topic": 0.9}


def token_count(text: str) -> Column:
    """Blanks and line breaks plus one, a cheap stand-in for the number of tokens."""
    value = F.coalesce(F.col(text), F.lit(""))
    separators = [F.length(value) - F.length(F.replace(value, F.lit(c))) for c in (" ", "\n")]
    return (separators[0] + separators[1] + 1).cast("long")


def topic_of(text: str) -> Column:
    value = F.coalesce(F.col(text), F.lit(""))
    result = None
    for topic, markers in TOPICS:
        found = F.lit(False)
        for marker in markers:
            found = found | F.contains(value, F.lit(marker))
        result = F.when(found, topic) if result is None else result.when(found, topic)
    return result.otherwise(OTHER_TOPIC)


def power_targets(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """(margin, target): shares of tokens raised to ``power``, summing to 1; one row per value."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("_sum"))
    raised = sums.select(margin, F.pow("_sum", F.lit(power)).alias("_raised"))
    total = raised.agg(F.sum("_raised")).first()[0]
    return raised.select(margin, (F.col("_raised") / F.lit(total)).alias("target"))


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """Cells with ``weight``: token counts fitted to the target share of every margin in turn.

    ``cells`` has one row per combination of margin values with ``tokens``. A
    value without a target keeps its share of the counted tokens.
    """
    for margin, target in targets.items():
        cells = cells.join(target.withColumnRenamed("target", f"_target_{margin}"), margin, "left")
    cells = written(cells, "cells")
    rows, total = cells.agg(F.count(F.lit(1)), F.sum("tokens")).first()
    if not rows:
        return cells.withColumn("weight", F.col("tokens").cast("double"))
    state = cells.withColumn("weight", F.col("tokens") / F.lit(float(total)))
    return _rounds(state, list(targets), -(-rows // CELLS_PER_TASK), rounds)


def _rounds(state: DataFrame, margins: list[str], tasks: int, rounds: int, bound: Column | None = None) -> DataFrame:
    """``weight`` fitted to every margin in turn, some rounds a plan; none exceeds ``bound``."""
    done = 0
    while done < rounds:
        state = state.repartition(tasks)
        for _ in range(min(ROUNDS_PER_PLAN, rounds - done)):
            for margin in margins:
                share = F.sum("weight").over(Window.partitionBy(margin))
                fitted = F.col("weight") * F.coalesce(f"_target_{margin}", share) / share
                fitted = fitted if bound is None else F.least(fitted, bound)
                state = state.withColumn("weight", F.when(share > 0, fitted).otherwise(0.0))
        done += ROUNDS_PER_PLAN
        state = written(state, "raked")
    return state


def mixture_total(raked: DataFrame, shortfall: float = SHORTFALL) -> float:
    """The largest total for which cells lack no more than ``shortfall`` of it, and never more than all tokens.

    At a total t the cells lack the sum of weight - tokens / t over those where this
    is positive: the largest of all sums over the cells with the least tokens per
    weight. So t is the least of tokens / (weight - shortfall) over these sums.
    """
    ordered = raked.where("weight > 0").select("weight", F.col("tokens").cast("double").alias("tokens"), (F.col("tokens") / F.col("weight")).alias("_ratio"))
    sums = [Trailing(c, f"_{c}", None, True) for c in ("tokens", "weight")]
    through = trailing(ordered, sums, [], ["_ratio", "weight"], any_size=True)
    least = through.agg(F.min(F.when(F.col("_weight") > shortfall, F.col("_tokens") / (F.col("_weight") - shortfall)))).first()[0]
    total = ordered.agg(F.sum("tokens")).first()[0] or 0.0
    return min(total, least or total)


def planned(cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = ROUNDS, shortfall: float = SHORTFALL) -> DataFrame:
    """``cells`` with ``probability``: that with which the tokens of a cell are kept."""
    raked = rake(cells, targets, rounds)
    total = mixture_total(raked, shortfall)
    if not total:
        return raked.withColumn("probability", F.lit(1.0))
    bound = F.col("tokens") / F.lit(total)
    state = raked.withColumn("weight", F.least("weight", bound))
    tasks = -(-raked.count() // CELLS_PER_TASK)
    state = _rounds(state, list(targets), tasks, BOUNDED_ROUNDS, bound)
    return state.withColumn("probability", F.least(F.col("weight") * F.lit(total) / F.col("tokens"), F.lit(1.0)))


def residuals(plan: DataFrame, margins: Sequence[str]) -> DataFrame:
    """(margin, value, target, reached): shares of the kept tokens against the targets of ``planned`` cells."""
    kept = F.sum(F.col("probability") * F.col("tokens"))
    total = plan.agg(kept).first()[0] or 1.0
    return reduce(
        DataFrame.unionByName,
        [
            plan.groupBy(F.col(m).alias("value"))
            .agg(F.max(f"_target_{m}").alias("target"), (kept / F.lit(total)).alias("reached"))
            .select(F.lit(m).alias("margin"), "value", "target", "reached")
            for m in margins
        ],
    )


def mix(
    docs: DataFrame,
    margins: Mapping[str, Column],
    tokens: Column,
    powers: Mapping[str, float] | None = None,
    targets: Mapping[str, DataFrame] | None = None,
    id_col: str = "doc_id",
    seed: str = SEED,
    rounds: int = ROUNDS,
    shortfall: float = SHORTFALL,
) -> DataFrame:
    """``docs`` with ``mix_<margin>`` of every margin, ``mix_tokens``, ``probability`` and ``kept``.

    ``targets`` gives (margin, target) per margin; margins without one get their
    counted shares to the power in ``powers``.
    """
    named = {f"mix_{name}": F.coalesce(value.cast("string"), F.lit(MISSING)) for name, value in margins.items()}
    taken = {c.lower() for c in docs.columns} & {*named, "mix_tokens", "probability", "kept"}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are added by mixing")
    rows = docs.withColumns({**named, "mix_tokens": tokens})
    cells = rows.groupBy(*named).agg(F.sum("mix_tokens").alias("tokens"))
    cells = written(cells, "counted")
    goal = {}
    for name in margins:
        own = (targets or {}).get(name)
        margin = f"mix_{name}"
        goal[margin] = own.toDF(margin, "target") if own else power_targets(cells, margin, (powers or {}).get(name, 1.0))
    odds = planned(cells, goal, rounds, shortfall).select(*named, "probability")
    return rows.join(written(odds, "odds"), [*named], "left").withColumn(
        "kept", hash_share(id_col, seed) < F.col("probability")
    )


def hash_share(id_col: str, seed: str) -> Column:
    """A number in [0, 1) from the id alone."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def mix_documents(docs: DataFrame) -> DataFrame:
    """``mix`` with production parameters over the columns of ``documents``."""
    margins = {"source": F.col("source"), "lang": F.col("lang"), "topic": topic_of("text")}
    return mix(docs, margins, token_count("text"), POWERS)


def _sql() -> str:
    cases = " ".join(
        f"WHEN {' OR '.join(f'''contains(coalesce(text, ''), '{m}')''' for m in markers)} THEN '{topic}'"
        for topic, markers in TOPICS
    )
    steps = []
    last = "started"
    for i in range(ROUNDS):
        for margin in POWERS:
            name = f"fit{i}_{margin}"
            steps.append(
                f"{name} AS MATERIALIZED (SELECT * REPLACE (weight * t_{margin} / sum(weight) OVER (PARTITION BY {margin})"
                f" AS weight) FROM {last})"
            )
            last = name
    raked = last
    last = "bounded"
    for i in range(BOUNDED_ROUNDS):
        for margin in POWERS:
            name = f"bound{i}_{margin}"
            steps.append(
                f"{name} AS MATERIALIZED (SELECT * REPLACE (least(weight * t_{margin} / sum(weight) OVER (PARTITION BY {margin}),"
                f" tokens / total) AS weight) FROM {last})"
            )
            last = name
    at = len(POWERS) * ROUNDS
    steps[at:at] = [
        f"through AS (SELECT sum(tokens::DOUBLE) OVER least_first AS n, sum(weight) OVER least_first AS w FROM {raked}"
        " WINDOW least_first AS (ORDER BY tokens / weight, weight ROWS UNBOUNDED PRECEDING))",
        f"total AS (SELECT least((SELECT sum(tokens::DOUBLE) FROM cells), min(n / (w - {SHORTFALL}))) AS total FROM through WHERE w > {SHORTFALL})",
        f"bounded AS MATERIALIZED (SELECT {raked}.* REPLACE (least(weight, tokens / total) AS weight), total FROM {raked}, total)",
    ]
    goals = ", ".join(
        f"goal_{m} AS (SELECT {m}, pow(sum(tokens)::DOUBLE, {p}) / sum(pow(sum(tokens)::DOUBLE, {p})) OVER () AS t_{m}"
        f" FROM cells GROUP BY {m})"
        for m, p in POWERS.items()
    )
    joins = " ".join(f"JOIN goal_{m} USING ({m})" for m in POWERS)
    return f"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '{MISSING}') AS source, coalesce(lang, '{MISSING}') AS lang,
    CASE {cases} ELSE '{OTHER_TOPIC}' END AS topic,
    (length(coalesce(text, '')) - length(replace(coalesce(text, ''), ' ', ''))
      + length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), '')) + 1)::BIGINT AS tokens
  FROM documents
), cells AS (SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens FROM docs GROUP BY ALL),
{goals},
started AS MATERIALIZED (SELECT *, tokens::DOUBLE / sum(tokens) OVER () AS weight FROM cells {joins}),
{", ".join(steps)},
odds AS (SELECT source, lang, topic, least(weight * total / tokens, 1.0) AS probability FROM {last})
SELECT doc_id, topic, tokens AS n_tokens, round(probability, 6) AS probability,
  ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT / 4294967296.0 < probability AS kept
FROM docs JOIN odds USING (source, lang, topic)
"""


@query("op9_source_mix", _sql())
def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_documents(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id",
        F.col("mix_topic").alias("topic"),
        F.col("mix_tokens").alias("n_tokens"),
        F.round("probability", 6).alias("probability"),
        "kept",
    )
