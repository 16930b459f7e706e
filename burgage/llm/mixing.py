"""Mixing sources to target weights: temperature, bisection, budgeted block permutations.

A source with share p of all tokens gets a weight in proportion to p ** exponent. Smaller
exponents level the sources: entropy rises, and small sources are repeated more often. The
exponent is bisected to the largest one that reaches the target entropy, or, if that would repeat
a source more often than allowed, to the smallest one that does not.

A source's budget is read in passes over its documents. Each pass is a permutation of the source's
blocks, and of the documents within a block, by hashes; the last pass stops where the budget ends.
Where that is, is found by the token sums of blocks, and then within one block of each source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

ENTROPY = 0.95      # of the entropy of equal weights
MAX_PASSES = 4.0    # most times a source may be read
BUDGET = 1.0        # tokens to draw, as a share of all tokens
BLOCKS = 1_024      # per source
SEED = 17
TOKEN = r"[^\x20\x09-\x0D]+"

ROUNDING = 1e-9     # relative
STEPS, PASSES = 5, 8  # bisection steps per pass over the sources, and passes: 40 bits


def exponent(sources: DataFrame, total: int, entropy: float, max_passes: float,
             budget: float) -> float:
    """The exponent for a table of source totals (`tokens` > 0).

    Each pass evaluates both conditions at all points that its bisection steps can reach, in one
    aggregation, so the sources stay where they are, however many there are.
    """
    p = F.col("tokens") / F.lit(float(total))
    parts = 1 << STEPS
    # [even enough, repeated too often]: each holds up to some exponent and not beyond.
    low, high = [0.0, 0.0], [1.0, 1.0]
    sums = lambda a: [F.sum(F.pow(p, F.lit(a))), F.sum(F.pow(p, F.lit(a)) * F.log(p))]
    n, least, *one = sources.agg(F.count("*"), F.min(p), *sums(1.0)).first()

    def holds(which: int, a: float, z: float, zl: float) -> bool:
        if which == 0:
            return math.log(z) - a * zl / z >= entropy * math.log(n) - 1e-12
        return budget * least ** (a - 1) / z > max_passes

    if holds(1, 1.0, *one):
        raise ValueError("the budget repeats every source more often than allowed")
    done = [holds(0, 1.0, *one), not holds(1, 0.0, float(n), 0.0)]
    for _ in range(PASSES):
        at = [[lo + (hi - lo) * i / parts for i in range(1, parts)] for lo, hi in zip(low, high)]
        row = sources.agg(*(s for points in at for a in points for s in sums(a))).first()
        for which in (0, 1):
            values = row[which * 2 * (parts - 1):]
            good = sum(holds(which, a, values[2 * i], values[2 * i + 1])
                       for i, a in enumerate(at[which]))
            step = (high[which] - low[which]) / parts
            low[which], high[which] = low[which] + good * step, low[which] + (good + 1) * step
    levelled = 1.0 if done[0] else low[0]
    bounded = 0.0 if done[1] else high[1]
    return max(levelled, bounded)


def _hash(*parts: Column | str) -> Column:
    return F.md5(F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("")) if isinstance(p, Column)
                                    else F.lit(p) for p in parts)).cast("binary"))


def _placed(docs: DataFrame, id_col: str, text_col: str, source_col: str, blocks: int,
            seed: int) -> DataFrame:
    """(row, id, source, tokens, block): whole rows packed away, so that no names can clash."""
    number = F.conv(F.substring(_hash(F.lit(seed), F.col(id_col)), 1, 8), 16, 10).cast("long")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        F.regexp_count(text, F.lit(TOKEN)).cast("long").alias("tokens"),
        (number % blocks).cast("int").alias("block"))


def _doc_key(number: Column, seed: int) -> Column:
    return F.substring(_hash(F.lit(seed), F.col("id"), number, F.col("tokens")), 1, 16)


def _block_key(number: Column, seed: int) -> Column:
    return F.substring(_hash(F.lit(seed), F.col("source"), F.col("block"), number), 1, 8)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        entropy: float = ENTROPY, max_passes: float = MAX_PASSES, budget: float = BUDGET,
        blocks: int = BLOCKS, seed: int = SEED) -> DataFrame:
    """`docs` once per time it is drawn, with n_tokens, pass, block, block_key and doc_key.

    Columns of those names are replaced. Reading each pass by block_key, then doc_key, gives the
    permutation. A null source is the source ''. A null or empty text has no tokens; sources
    without tokens are not drawn. In the last pass documents are drawn while the tokens up to and
    with them fit the budget; documents with the same key (repeated rows) fit together or not at
    all. A source's last pass is empty where its budget is a whole number of passes.

    Every row is joined by (source, block), so a large source is spread over its blocks. Windows
    run over the blocks of a source and over the documents of one block.
    """
    added = ["n_tokens", "pass", "block", "block_key", "doc_key"]
    names = [c for c in docs.columns if c not in added]
    rows = _placed(docs.select(names), id_col, text_col, source_col, blocks, seed)
    sums = written(rows.groupBy("source", "block").agg(F.sum("tokens").alias("tokens")), "blocks")
    sources = written(sums.groupBy("source").agg(F.sum("tokens").alias("tokens"))
                      .where("tokens > 0"), "sources")
    total = sources.agg(F.sum("tokens")).first()[0]
    if total is None:
        return rows.limit(0).select(
            "row.*", F.col("tokens").alias("n_tokens"), F.lit(0).alias("pass"), "block",
            F.lit("").alias("block_key"), F.lit("").alias("doc_key"))
    a = exponent(sources, total, entropy, max_passes, budget)
    power = F.pow(F.col("tokens") / F.lit(float(total)), F.lit(a))
    z = sources.agg(F.sum(power)).first()[0]
    # A budget that is a whole number of passes must not lose a token to rounding.
    share = F.floor(power / F.lit(z) * F.lit(budget * total * (1 + ROUNDING))).cast("long")
    plan = sources.select("source", F.floor(share / F.col("tokens")).cast("int").alias("full"),
                          (share % F.col("tokens")).alias("rest"))
    order = Window.partitionBy("source").orderBy(_block_key(F.col("full"), seed), "block")
    upto = sums.join(plan, "source").withColumn("upto", F.sum("tokens").over(order.rowsBetween(
        Window.unboundedPreceding, 0)))
    planned = written(upto.select(
        "source", "block", "full", (F.col("upto") <= F.col("rest")).alias("inside"),
        F.when((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("tokens") < F.col("rest")),
               F.col("rest") - F.col("upto") + F.col("tokens")).alias("left")), "plan")
    edge = (rows.drop("row").join(planned.where("left is not null"), ["source", "block"])
            .select("source", "block", "left", "tokens", _doc_key(F.col("full"), seed).alias("key")))
    running = F.sum("tokens").over(Window.partitionBy("source", "block").orderBy("key"))
    cut = (edge.withColumn("upto", running).where(F.col("upto") <= F.col("left"))
           .groupBy("source", "block").agg(F.max("key").alias("cut")))
    steps = written(planned.join(cut, ["source", "block"], "left"), "steps")
    last = F.col("inside") | F.coalesce(_doc_key(F.col("full"), seed) <= F.col("cut"), F.lit(False))
    drawn = rows.join(steps, ["source", "block"]).withColumn(
        "times", F.col("full") + last.cast("int")).where("times > 0")
    out = drawn.withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))
    return out.select("row.*", F.col("tokens").alias("n_tokens"), "pass", "block",
                      _block_key(F.col("pass"), seed).alias("block_key"),
                      _doc_key(F.col("pass"), seed).alias("doc_key"))
