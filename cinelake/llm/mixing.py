"""Mixing sources to target weights by hierarchical budgeting.

Leaves form a tree of domain, language and source. A budget of tokens goes down the tree: each
node's share follows the weights of its children, no child gets more than it can supply, and what
a child lacks goes to its siblings. As a node is never given more than its subtree supplies, a
shortage reaches the node's own siblings only where the whole node is short. A leaf fills its budget from epochs: each
epoch is the leaf's documents in an order drawn from a seed, the last one cut where the budget ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinelake.llm.store import stored
from cinelake.llm.text import BLANK_CHARACTERS, BLANKS

LEVELS = ("domain", "lang", "source")
#: Documents may be repeated so many times at most; a leaf supplies its tokens so many times.
EPOCHS = 4
#: Slices of an epoch's order; only the slice where a budget ends is sorted by row.
SLICES = 4096
SEED = "mix-1"


def default_domain(source: Column) -> Column:
    """One of four domains by the checksum of the source, where no domain is declared."""
    return F.concat(F.lit("domain"), (F.crc32(F.coalesce(source, F.lit("")).cast("binary")) % 4).cast("string"))


def word_tokens(text: Column) -> Column:
    """Words of a text, by the gaps between them; a null text has none."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANK_CHARACTERS))
    return F.when(body == "", F.lit(0)).otherwise(F.regexp_count(body, F.lit(BLANKS)) + 1).cast("long")


def budgets(leaves: DataFrame, total: Column, weights: DataFrame | None = None, levels: tuple[str, ...] = LEVELS,
            epochs: int = EPOCHS) -> DataFrame:
    """``leaves`` (levels..., ``tokens``) with a ``budget`` each, down from ``total`` tokens.

    ``weights`` has one row per leaf with a column ``<level>_weight`` per level; siblings weigh
    alike without it, and a leaf without a row weighs 1. All rows here are per leaf, few beside the documents; siblings are
    filled in the order of supply per weight, the closed form of raising a common level until the budget is used. Budgets
    are whole tokens and add up to the total, or to all there is to supply.
    """
    own = leaves.withColumn("supply", F.col("tokens") * epochs)
    if weights is not None:
        own = own.join(weights, list(levels), "left")
    for level in levels:
        given = F.coalesce(F.col(f"{level}_weight"), F.lit(1.0)) if weights is not None else F.lit(1.0)
        own = own.withColumn(f"_w_{level}", given.cast("double"))
    nodes = own
    for depth, level in enumerate(levels):
        path = list(levels[:depth + 1])
        parent = path[:-1]
        children = nodes.groupBy(*path).agg(F.sum("supply").alias("supply"), F.max(f"_w_{level}").alias("w"))
        grant = total.cast("double") if depth == 0 else F.col("granted")
        if depth:
            children = children.join(granted, parent)
        over = Window.partitionBy(*[F.col(c) for c in parent] or [F.lit(0)]).orderBy(F.col("supply") / F.col("w"), level)
        before = over.rowsBetween(Window.unboundedPreceding, -1)
        every = Window.partitionBy(*[F.col(c) for c in parent] or [F.lit(0)])
        positive = children.withColumn("w", F.greatest("w", F.lit(1e-12)))
        raised = positive.withColumn("_level", (grant - F.coalesce(F.sum("supply").over(before), F.lit(0))) /
                                     (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
        # Up to the first child that its supply does not limit, each child takes its whole supply.
        raised = raised.withColumn("_limited", F.col("supply") <= F.col("_level") * F.col("w"))
        raised = raised.withColumn("_common", F.min(F.when(~F.col("_limited"), F.struct(F.col("supply") / F.col("w"), F.col(level), F.col("_level").alias("at")))).over(every).getField("at"))
        granted = raised.select(*path, F.when(F.col("_common").isNull(), F.col("supply").cast("double")).otherwise(
            F.least(F.col("supply").cast("double"), F.col("_common") * F.col("w"))).alias("granted"))
    # Whole tokens first; those that the fractions add up to go to the largest fractions, one each. One task ranks all
    # leaves here, as one takes all siblings of a node above: both are bounded by leaves, never by documents.
    cut = leaves.join(granted, list(levels)).withColumn("_floor", F.floor(F.col("granted") + 1e-6).cast("long"))
    every = Window.partitionBy(F.lit(0))
    goal = F.least(total.cast("long"), F.sum(F.col("tokens") * epochs).over(every))
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy((F.col("granted") - F.col("_floor")).desc(), *levels))
    cut = cut.withColumn("_left", goal - F.sum("_floor").over(every)).withColumn("_place", place)
    more = (F.col("_place") <= F.col("_left")) & (F.col("_floor") < F.col("tokens") * epochs)
    return cut.select(*leaves.columns, (F.col("_floor") + more.cast("long")).alias("budget"))


def tempered(leaves: DataFrame, alpha: float, levels: tuple[str, ...] = LEVELS) -> DataFrame:
    """Target weights of every node: its tokens to the power of ``alpha``.

    At 1 every node keeps its share, at 0 siblings weigh alike; between, small ones are raised.
    """
    out = leaves.select(*levels, "tokens")
    for depth, level in enumerate(levels):
        own = F.sum("tokens").over(Window.partitionBy(*levels[:depth + 1]))
        out = out.withColumn(f"{level}_weight", F.pow(own.cast("double"), F.lit(alpha)))
    return out.drop("tokens")


def mix(docs: DataFrame, total: int | None = None, weights: DataFrame | None = None, domain: Column | None = None,
        tokens: Column | None = None, id: str = "doc_id", text: str = "text", lang: str = "lang",
        source: str = "source", epochs: int = EPOCHS, seed: str = SEED, alpha: float | None = None) -> DataFrame:
    """(doc_id, epoch, domain, lang, source, content, n_tokens, taken): every document and epoch that is chosen.

    ``content`` is a hash of the text, which tells texts under one id apart.
    ``total`` is the token budget, all tokens there are by default. ``weights`` are target weights as in ``budgets``;
    without them ``alpha`` derives some by ``tempered``. ``taken`` tokens of the document
    count for the budget, fewer than it has for the one document per leaf that the budget cuts.
    Null languages and sources form leaves of their own, under the empty name. A text without
    tokens is not chosen. Repeated rows are chosen independently of their number of copies: rows equal in id and text
    share a place in the order and are taken one after the other. An empty table gives no rows.
    """
    rows = docs.select(
        docs[id].cast("long").alias("doc_id"), F.coalesce(docs[lang], F.lit("")).alias("lang"),
        F.coalesce(docs[source], F.lit("")).alias("source"),
        (domain if domain is not None else default_domain(docs[source])).alias("domain"),
        (tokens if tokens is not None else word_tokens(docs[text])).alias("n_tokens"),
        F.xxhash64(docs[text]).alias("content")).where("n_tokens > 0")
    rows = stored(rows, "mix")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    goal = F.lit(total if total is not None else (leaves.agg(F.sum("tokens")).first()[0] or 0))
    if weights is None and alpha is not None:
        weights = tempered(leaves, alpha)
    plan = stored(budgets(leaves, goal, weights, LEVELS, epochs), "budgets").withColumn(
        "whole", F.least(F.floor(F.col("budget") / F.col("tokens")), F.lit(epochs)).cast("int"))
    plan = plan.withColumn("rest", F.when(F.col("whole") < epochs, F.col("budget") - F.col("whole") * F.col("tokens")).otherwise(0))
    drawn = rows.join(plan.select(*LEVELS, "whole", "rest"), list(LEVELS))
    full = drawn.where("whole > 0").select("*", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)).alias("epoch"))
    full = full.select("doc_id", "epoch", *LEVELS, "content", "n_tokens", F.col("n_tokens").alias("taken"))
    place = F.md5(F.concat_ws("|", F.lit(seed), F.col("whole"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("content")).cast("binary"))
    last = drawn.where("rest > 0").withColumn("place", place).withColumn(
        "slice", (F.conv(F.substring("place", 1, 8), 16, 10).cast("long") % SLICES).cast("int"))
    # Tokens per slice, added up in order, show which slices are taken whole and which one is cut.
    slices = last.groupBy(*LEVELS, "slice").agg(F.sum("n_tokens").alias("t"), F.max("rest").alias("r"))
    so_far = Window.partitionBy(*LEVELS).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("ahead", F.coalesce(F.sum("t").over(so_far), F.lit(0))).where("ahead < r").select(*LEVELS, "slice", "ahead", "t")
    chosen = last.join(slices, [*LEVELS, "slice"])
    inside = chosen.where("ahead + t <= rest").select("doc_id", F.col("whole").alias("epoch"), *LEVELS, "content", "n_tokens", F.col("n_tokens").alias("taken"))
    in_slice = Window.partitionBy(*LEVELS, "slice").orderBy("place", "doc_id", "content").rowsBetween(Window.unboundedPreceding, -1)
    cut = chosen.where("ahead + t > rest").withColumn("start", F.col("ahead") + F.coalesce(F.sum("n_tokens").over(in_slice), F.lit(0)))
    cut = cut.where("start < rest").select("doc_id", F.col("whole").alias("epoch"), *LEVELS, "content", "n_tokens",
                                           F.least("n_tokens", F.col("rest") - F.col("start")).alias("taken"))
    return full.unionAll(inside).unionAll(cut)
