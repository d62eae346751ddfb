"""Mixing sources to target weights: hierarchical budgets, then seeded token prefixes.

Leaves are the distinct values of the level columns (domain, language, source). Their tokens
are counted once; everything up to the selection works on the table of leaves. A node's budget
goes to its children in proportion to their weights, but no child gets more than its subtree
can give (its tokens times ``max_epochs``): what a child cannot take goes to its siblings first,
and because a node's own budget was limited by its subtree in the same way, only what all
siblings together cannot take is left to the ancestors. Budgets are whole tokens and sum up
exactly.

Each leaf then reads its budget from epochs: in every epoch its documents stand in the order of
a seeded hash, whole epochs are taken while the budget lasts, and the last epoch gives a prefix
of its token stream. The cut is found without bringing a leaf into one task: the hash order is
split into slices of about ``slice_rows`` documents by the hash itself, slices are summed and
accumulated per leaf, and only the slice that holds the cut is ordered row by row.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editflow.llm.common import SPACE_CLASS, saved, text_id


def count_words(text: Column) -> Column:
    """Words between ASCII white space, as long; 0 for null and blank texts."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, f"[{SPACE_CLASS}]+", -1))).cast("long")


def first_words(text: Column, n: Column) -> Column:
    """The text up to and including its ``n``-th word, white space in between as it is."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    pieces = F.split(trimmed, f"(?<=[{SPACE_CLASS}])(?=[^{SPACE_CLASS}])", -1)
    return F.btrim(F.array_join(F.slice(pieces, F.lit(1), n.cast("int")), ""), F.lit(" \t\n\x0b\x0c\r"))


def budgets(leaves: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], total: Column,
            max_epochs: int) -> DataFrame:
    """``leaves`` (level columns, ``tokens``) plus ``budget``: whole tokens for each leaf.

    ``weights[level][value]`` are whole numbers relative to the siblings, 1 where none is given;
    0 excludes a node. ``total`` is an expression over the whole corpus's token count ``corpus``.
    """
    out = leaves.withColumn("capacity", F.col("tokens") * F.lit(max_epochs))
    # A weight of 0 anywhere above a leaf takes its capacity away before it is summed up.
    for level in levels:
        out = out.withColumn(f"__w_{level}", _weight(F.col(level), weights.get(level, {})))
        out = out.withColumn("capacity", F.when(F.col(f"__w_{level}") > 0, F.col("capacity")).otherwise(0))
    out = out.withColumn("__root", F.lit(0))
    nodes = out.groupBy("__root").agg(F.sum("tokens").alias("corpus"), F.sum("capacity").alias("room"))
    parents = nodes.select("__root", F.least(total.cast("long"), F.col("room")).alias("budget"))
    above = ["__root"]
    for level in levels:
        own = [*above, level]
        children = out.groupBy(*own).agg(F.sum("capacity").alias("capacity"), F.max(f"__w_{level}").alias("w"))
        parents = _filled(children.join(parents, above).where("capacity > 0"), above, level)
        above = own
    return out.select(*levels, "tokens").join(parents.drop("__root"), levels, "left").withColumn(
        "budget", F.coalesce("budget", F.lit(0)).cast("long"))


def _weight(value: Column, given: dict[str, int]) -> Column:
    pairs = [x for k, v in sorted(given.items()) for x in (F.lit(k), F.lit(int(v)))]
    found = F.try_element_at(F.create_map(*pairs), value) if pairs else F.lit(None)
    return F.coalesce(found, F.lit(1)).cast("long")


def _filled(children: DataFrame, above: list[str], level: str) -> DataFrame:
    """Share ``budget`` among siblings by weight, none beyond its capacity, to the last token."""
    # decimal: products of two token counts pass the range of long
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    # Exact order for weights up to 100,000: distinct ratios differ in the first ten digits.
    ratio = F.col("capacity").cast("decimal(20,0)") / F.col("w").cast("decimal(10,0)")
    by_ratio = Window.partitionBy(*above).orderBy(ratio, level)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    siblings = Window.partitionBy(*above)
    x = children.withColumns({
        "full_before": F.coalesce(F.sum("capacity").over(before), F.lit(0)),
        "w_rest": F.sum("w").over(rest),
    })
    left = F.col("budget") - F.col("full_before")
    # Siblings stand by capacity per weight: the first ones fill up, from one on none does.
    x = x.withColumn("full", wide("capacity") * wide("w_rest") <= left.cast("decimal(38,0)") * wide("w"))
    x = x.withColumns({
        "full_sum": F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(siblings), F.lit(0)),
        "w_open": F.sum(F.when(~F.col("full"), F.col("w"))).over(siblings),
    })
    x = x.withColumn("part", F.when(F.col("full"), F.col("capacity")).otherwise(
        F.expr("(cast(budget - full_sum as decimal(38,0)) * cast(w as decimal(38,0))) div cast(w_open as decimal(38,0))")
    ).cast("long"))
    x = x.withColumns({
        "over": F.col("budget") - F.sum("part").over(siblings),
        "nth": F.sum(F.when(~F.col("full"), 1).otherwise(0)).over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)),
    })
    part = F.col("part") + F.when(~F.col("full") & (F.col("nth") <= F.col("over")), 1).otherwise(0)
    return x.select(*above, level, part.cast("long").alias("budget"))


def select(docs: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], total: Column,
           max_epochs: int = 2, seed: int = 1, id_col: str = "doc_id", text_col: str = "text",
           slice_rows: int = 4096) -> DataFrame:
    """Which tokens of which document the mix takes: one row per document and epoch taken.

    Columns: the id, ``text_id``, the levels, ``n_tokens``, ``epoch`` (from 0) and
    ``taken`` (leading tokens of the document). Null level values are the value ``''``. Texts
    without a token are never taken. Rows that share the id are ordered by their texts; equal
    rows are taken separately.
    """
    rows = docs.select(
        docs[id_col].alias("__id"), text_id(docs[text_col]).alias("text_id"),
        *(F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in levels),
        count_words(docs[text_col]).alias("n_tokens"),
    )
    rows = saved(rows, "mix-rows")
    leaves = rows.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_docs"))
    leaves = saved(leaves, "mix-leaves")
    planned = budgets(leaves, levels, weights, total, max_epochs).drop("tokens")
    plan = planned.join(leaves, levels).where("tokens > 0 AND budget > 0").select(
        *levels, "budget", "tokens", "n_docs", F.expr("budget div tokens").alias("epochs"),
        F.expr("budget % tokens").alias("extra"))
    plan = saved(plan, "mix-plan")

    taken = rows.where("n_tokens > 0").join(plan, levels)
    whole = taken.where("epochs > 0").select(
        "__id", "text_id", *levels, "n_tokens",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs") - 1)).alias("epoch"), F.col("n_tokens").alias("taken"))

    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("epochs").cast("string"), F.col("__id").cast("string")))
    # The first 32 bits of the hash choose the slice; slices follow the hash order.
    high = F.conv(F.substring(order, 1, 8), 16, 10).cast("long")
    last = taken.where("extra > 0").withColumn("order", order)
    n_slices = F.expr(f"(n_docs div {int(slice_rows)}) + 1")
    last = last.withColumn("slice", F.shiftright(high * n_slices, 32))
    sums = last.groupBy(*levels, "slice").agg(F.sum("n_tokens").alias("slice_tokens"))
    so_far = Window.partitionBy(*levels).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*levels, "slice", F.coalesce(F.sum("slice_tokens").over(so_far), F.lit(0)).alias("start"),
                         "slice_tokens")
    placed = last.join(starts, [*levels, "slice"]).where("start < extra")
    inside = placed.where("start + slice_tokens <= extra").withColumn("taken", F.col("n_tokens"))
    cut = placed.where("start + slice_tokens > extra")
    within = Window.partitionBy(*levels, "slice").orderBy("order", "__id", "text_id").rowsBetween(
        Window.unboundedPreceding, -1)
    cut = cut.withColumn("at", F.col("start") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    cut = cut.where("at < extra").withColumn("taken", F.least(F.col("n_tokens"), F.col("extra") - F.col("at")))
    columns = ["__id", "text_id", *levels, "n_tokens", F.col("epochs").alias("epoch"), "taken"]
    return whole.unionByName(inside.select(*columns)).unionByName(cut.select(*columns)).withColumnRenamed("__id", id_col)
