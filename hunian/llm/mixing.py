"""Mixing sources to target weights: raking under upper bounds, then sampling by calibrated probabilities.

Documents are folded to cells, one for each combination of the dimensions' values, with the sum of tokens.
A dimension's targets share out ``share`` of all tokens among its values. No value can give more tokens than it
has: a target above that stops there, and what is missing goes to the other values in proportion (water filling), so a
rare value costs the others nothing but its shortfall; ``margins`` reports it. Iterative proportional fitting then scales the cells
to the targets of one dimension after the other, a fixed number of rounds. A cell counts for at most its own tokens, and the factor of a
value is worked out with its full cells held, so the expected sample meets the targets. A document is kept with the probability that its
cell's fitted tokens are of its tokens, at most one; the weight is that over ``share``. Chance comes from a hash of the id, so a
document's draw does not depend on the others, and repeated ids are kept or left together.

The share kept does not change with the input's size or with rare values. Targets of several dimensions that no sample can meet together
(a value wholly inside another one whose target is smaller) are met for the last dimension and come near for the others.

The cells stay distributed and are cut to the shared folder after each round; the driver sees a few sums. A null value
is a value of its own, "(none)". Texts without tokens add nothing to a cell and are kept like the
others of it; a cell without any tokens keeps weight 1. Null ids share one draw. An empty table gives no rows. The
input's rows travel as one struct, so its column names cannot clash with others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import cut

ROUNDS, SHARE, SEED = 8, 0.5, 17
#: Up to this many cells go to the documents by broadcast; more are joined by a shuffle.
BROADCAST_CELLS = 100_000

#: Forms by which a document gets a topic: the one that occurs most often in it, the first on ties.
TOPICS = (
    ("tables", r"\|"),
    ("notices", r"[Ll]icen[cs]e|[Cc]opyright|[Ww]arrant"),
    ("figures", r"[0-9][0-9]+"),
    ("questions", r"\?"),
)
OTHER = "prose"
TOKEN = r"[^ \t\r\n]+"


def tokens(text: Column) -> Column:
    """Runs without blanks; a null text has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(TOKEN)).cast("long")


def topic(text: Column, topics: tuple[tuple[str, str], ...] = TOPICS) -> Column:
    """Name of the form that occurs most often in the whole text."""
    text = F.coalesce(text, F.lit(""))
    counts = F.array(*[F.struct(
        F.regexp_count(text, F.lit(pattern)).alias("n"), F.lit(-i).alias("order"), F.lit(name).alias("name"),
    ) for i, (name, pattern) in enumerate(topics)])
    best = F.array_max(counts)
    return F.when(best["n"] > 0, best["name"]).otherwise(OTHER)


def tempered(power: float) -> Callable[[Column], Column]:
    """Targets that grow as a power of a value's tokens: below 1 large values shrink, small ones grow."""
    return lambda total: F.pow(total, F.lit(power))


Targets = dict[str, Callable[[Column], Column] | dict[str, float]]


def rate(rows: DataFrame, kept: float) -> float:
    """The factor at which rows of ``_tokens`` and ``_fitted`` give ``kept`` tokens, none more than it has.

    Rows that are full at a factor still are at the larger one that makes up for them, so it only grows and at last stays.
    """
    rows = rows.filter("_tokens > 0 and _fitted > 0")
    found, full = 0.0, -1
    while True:
        capped = F.col("_fitted") * found >= F.col("_tokens")
        row = rows.agg(
            F.sum(F.when(capped, F.col("_tokens")).otherwise(0)).alias("held"),
            F.sum(F.when(capped, 0.0).otherwise(F.col("_fitted"))).alias("open"),
            F.sum(F.when(capped, 1).otherwise(0)).alias("full")).first()
        if row["full"] == full or not row["open"]:
            return found
        full, found = row["full"], max(found, (kept - row["held"]) / row["open"])


def targets_of(cells: DataFrame, targets: Targets, share: float) -> dict[str, DataFrame]:
    """For each dimension its values with ``_tokens``, ``_wanted`` by the rule, and ``_target`` after water filling.

    A rule works on a value's tokens, or names shares by value; a value that is not named gets no tokens. The dimensions share out
    the same sum: ``share`` of the tokens that have a target in each.
    """
    margins, totals = {}, []
    for name, rule in targets.items():
        margin = cells.groupBy(name).agg(F.sum("_tokens").alias("_tokens")).filter("_tokens > 0")
        if callable(rule):
            wanted = rule(F.col("_tokens").cast("double"))
        else:
            pairs = [x for value, part in rule.items() for x in (F.lit(value), F.lit(float(part)))]
            wanted = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(name)), F.lit(0.0))
        margins[name] = cut(margin.select(name, "_tokens", wanted.alias("_fitted")), small=True)
        totals.append(margins[name].filter("_fitted > 0").agg(F.sum("_tokens"), F.sum("_fitted")).first())
    kept = share * min((t[0] or 0 for t in totals), default=0)
    return {name: margin.select(
        name, "_tokens", (F.col("_fitted") / F.lit(float(whole or 1)) * kept).alias("_wanted"),
        F.least(F.col("_tokens").cast("double"), F.col("_fitted") * rate(margin, kept)).alias("_target"),
    ) for (name, margin), (_, whole) in zip(margins.items(), totals)}


def rake(cells: DataFrame, targets: Targets, share: float = SHARE, rounds: int = ROUNDS) -> DataFrame:
    """Cells that have tokens with ``_fitted``: as many as the expected sample holds of them.

    ``cells`` has the dimensions of ``targets`` and ``_tokens``. Of a value's cells in the order in which they are full, the factor that
    takes the first n as full and scales the others to what is left is too small for any wrong n, so the largest one is right.
    """
    names = list(targets)
    cells = cut(cells.filter("_tokens > 0"), small=True)
    for name, margin in targets_of(cells, targets, share).items():
        cells = cells.join(margin.select(name, F.col("_target").alias(f"_target_{name}")), name, "left")
    cells = cells.withColumn("_raw", F.col("_tokens").cast("double"))
    for _ in range(rounds):
        for name in names:
            order = Window.partitionBy(name).orderBy(F.desc(F.col("_raw") / F.col("_tokens")), *names)
            cells = cells.withColumns({
                "_held": F.coalesce(F.sum("_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
                "_open": F.sum("_raw").over(order.rowsBetween(0, Window.unboundedFollowing))})
            factor = F.max(F.try_divide(F.col(f"_target_{name}") - F.col("_held"), F.col("_open"))).over(Window.partitionBy(name))
            cells = cells.withColumn("_raw", F.col("_raw") * F.greatest(F.coalesce(factor, F.lit(0.0)), F.lit(0.0))).drop("_held", "_open")
        cells = cut(cells, small=True)
    return cells.withColumn("_fitted", F.least(F.col("_tokens").cast("double"), F.col("_raw")))


def draw(doc_id: Column, seed: int = SEED) -> Column:
    """A number from 0 to below 1 out of the id."""
    digits = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digits, 1, 13), 16, 10).cast("double") / float(1 << 52)


def _valued(docs: DataFrame, dimensions: dict[str, Column], counted: Column) -> DataFrame:
    values = [F.coalesce(c.cast("string"), F.lit("(none)")).alias(f"_{n}") for n, c in dimensions.items()]
    return docs.select(F.struct("*").alias("row"), counted.alias("_tokens"), *values)


def calibrated(
    docs: DataFrame, dimensions: dict[str, Column], counted: Column, targets: Targets, share: float = SHARE, rounds: int = ROUNDS,
) -> DataFrame:
    """Each row of ``docs`` as a struct ``row``, its dimensions, ``tokens``, ``weight``, ``probability`` and ``kept``."""
    rows = _valued(docs, dimensions, counted)
    inner = {f"_{n}": targets[n] for n in dimensions}
    cells = rake(rows.groupBy(*inner).agg(F.sum("_tokens").alias("_tokens")), inner, share, rounds)
    chances = cut(cells.select(*inner, (F.col("_fitted") / F.col("_tokens")).alias("_chance")), small=True)
    if chances.count() <= BROADCAST_CELLS:
        chances = F.broadcast(chances)
    return rows.join(chances, list(inner), "left").withColumn("probability", F.coalesce("_chance", F.lit(share))).drop("_chance").withColumn(
        "weight", F.col("probability") / share).withColumn(
        "kept", draw(F.col("row.doc_id")) < F.col("probability")).withColumnRenamed("_tokens", "tokens")


def margins(
    docs: DataFrame, dimensions: dict[str, Column], counted: Column, targets: Targets, share: float = SHARE, rounds: int = ROUNDS,
) -> DataFrame:
    """Of every value: ``tokens``, those ``wanted`` by its rule, the ``target`` it can reach, and what is ``expected`` of the sample.

    ``wanted`` above ``target`` is a shortfall.
    """
    inner = {f"_{n}": targets[n] for n in dimensions}
    cells = cut(_valued(docs, dimensions, counted).groupBy(*inner).agg(F.sum("_tokens").alias("_tokens")), small=True)
    found, parts = rake(cells, inner, share, rounds), None
    for name, margin in targets_of(cells, inner, share).items():
        part = margin.join(found.groupBy(name).agg(F.sum("_fitted").alias("expected")), name).select(
            F.lit(name[1:]).alias("dimension"), F.col(name).alias("value"), F.col("_tokens").alias("tokens"),
            F.col("_wanted").alias("wanted"), F.col("_target").alias("target"), "expected")
        parts = part if parts is None else parts.union(part)
    return parts


#: Production targets: large sources, languages and topics shrink.
TARGETS = {"source": tempered(0.5), "lang": tempered(0.7), "topic": tempered(0.7)}


def production() -> dict:
    """Arguments of ``calibrated`` and ``margins`` for documents."""
    text = F.col("text")
    return {"dimensions": {"source": F.col("source"), "lang": F.col("lang"), "topic": topic(text)}, "counted": tokens(text), "targets": TARGETS}


def report(docs: DataFrame) -> DataFrame:
    """Dimensions, tokens, weight, probability and decision of every document."""
    # The topic needs the text, the rows that are joined do not.
    return calibrated(docs.select("doc_id", "source", "lang", "text"), **production()).select(
        "row.doc_id", "row.source", "row.lang", F.col("_topic").alias("topic"), "tokens",
        F.round("weight", 6).alias("weight"), F.round("probability", 6).alias("probability"), "kept")


def sample(docs: DataFrame) -> DataFrame:
    """The documents that ``report`` keeps, with the columns of ``docs``."""
    return calibrated(docs, **production()).filter("kept").select("row.*")
