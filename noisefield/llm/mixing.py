"""Mixing sources to target weights by hierarchical budgets.

The token budget flows down a tree (domain, language, source by default). Each node splits its budget among its
children in proportion to their weights; a child that holds too few tokens (all its documents, `max_epochs`
times) takes what it has and its shortage goes to its siblings by the same rule. A node never gets more than
its subtree holds, so shortages are settled among siblings before they reach an ancestor. A leaf reads whole
epochs while its budget lasts, then a prefix of one more epoch whose order is a seeded digest; the last document
of the prefix is taken in part. Only DataFrame operations are used.

Scale: the tree is aggregated first, so the budget windows see nodes, never documents. The leaves' budgets reach the rows by
broadcast, all of them if they are few, else those of large leaves, so no task gets a whole leaf. A leaf's prefix is found
from token sums over 4096 ranges of the digest; only the range where the prefix ends is sorted, so a source
with a third of all rows is not gathered in a task.

Edge cases: a null level is the node `(none)`; a null or empty text has no tokens, is never in a prefix and
takes part in whole epochs; a very long text may be taken in part. Rows without an id are ordered by the hash of their text, rows
with equal ids by their token counts, then by the hash of the text; a leaf or weight of 0 gets
nothing; an empty table gives no rows; extra columns play no part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ._store import attach, keep

LEVELS = ("domain", "lang", "source")
NONE = "(none)"


def words_in(text: Column) -> Column:
    """Words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weight(path: list[str], weights: dict[tuple[str, ...], float]) -> Column:
    own = {k: v for k, v in weights.items() if len(k) == len(path)}
    w = F.lit(1.0)
    for key, value in own.items():
        w = F.when(F.concat_ws("\u0001", *path) == "\u0001".join(key), float(value)).otherwise(w)
    return w


def split_budget(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Adds `budget` to children that carry `parent_budget`, `tokens`, `cap` and `weight`."""
    family = Window.partitionBy(*(parent or [F.lit(0)]))
    up = family.orderBy("ratio", name)
    c = children.withColumn("cap", F.when(F.col("weight") > 0, F.col("cap")).otherwise(0.0)).withColumn("weight", F.when(F.col("weight") > 0, F.col("weight")).otherwise(1.0))
    c = c.withColumn("ratio", F.col("cap") / F.col("weight"))
    c = c.withColumn("before", F.coalesce(F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    c = c.withColumn("level", (F.col("parent_budget") - F.col("before")) / F.sum("weight").over(up.rowsBetween(0, Window.unboundedFollowing)))
    c = c.withColumn("level", F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(family))
    c = c.withColumn("share", F.when(F.col("level").isNull() | (F.col("ratio") <= F.col("level")), F.col("cap")).otherwise(F.col("level") * F.col("weight")))
    c = c.withColumn("base", F.floor("share").cast("double"))
    rest = F.least(F.col("parent_budget"), F.sum("cap").over(family)) - F.sum("base").over(family)
    turn = F.row_number().over(family.orderBy((F.col("base") >= F.col("cap")).cast("int"), F.desc(F.col("share") - F.col("base")), name))
    return c.withColumn("budget", F.col("base") + F.when((turn <= rest) & (F.col("base") < F.col("cap")), 1.0).otherwise(0.0))


def leaf_budgets(leaves: DataFrame, levels: list[str], budget_share: float, weights: dict[tuple[str, ...], float], max_epochs: int) -> DataFrame:
    """One row a leaf: its path, tokens and budget (a whole number of tokens)."""
    out = None
    for depth in range(1, len(levels) + 1):
        path = levels[:depth]
        nodes = leaves.groupBy(*path).agg(F.sum("tokens").cast("double").alias("tokens")).withColumn("cap", F.col("tokens") * max_epochs).withColumn("weight", _weight(path, weights))
        if out is None:
            nodes = nodes.withColumn("parent_budget", F.floor(F.sum("tokens").over(Window.partitionBy(F.lit(0))) * budget_share).cast("double"))
        else:
            nodes = nodes.join(out.select(*levels[: depth - 1], F.col("budget").alias("parent_budget")), levels[: depth - 1])
        out = split_budget(nodes, path[:-1], path[-1]).select(*path, "tokens", "budget")
    return out


def mix(
    docs: DataFrame,
    budget_share: float,
    weights: dict[tuple[str, ...], float] | None = None,
    max_epochs: int = 4,
    seed: int = 7,
    levels: dict[str, Column] | None = None,
    tokens: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Id, levels, n_tokens, epochs (whole ones), last_tokens (of the next epoch's prefix) and tokens_taken of each document."""
    out = _mix(docs, budget_share, weights, max_epochs, seed, levels, tokens, id_col, text_col)
    return out.drop(*_ROW_KEY).withColumnRenamed("id", id_col)


_ROW_KEY = ("key_1", "key_2")


def _row_keys(docs: DataFrame, id_col: str, text_col: str) -> dict[str, Column]:
    return {k: F.xxhash64(F.lit(n), F.col(id_col), F.col(text_col)) for n, k in enumerate(_ROW_KEY, 1)}


def _mix(docs, budget_share, weights, max_epochs, seed, levels, tokens, id_col, text_col) -> DataFrame:
    """The columns of `mix` with the id as `id`, and two hashes of id and text that find a row again."""
    levels = levels or {k: F.col(k) for k in LEVELS}
    names = list(levels)
    doc = F.col(id_col)
    rows = docs.select(doc.alias("id"), *(v.alias(k) for k, v in _row_keys(docs, id_col, text_col).items()), F.coalesce(doc.cast("string"), F.concat(F.lit("null"), F.xxhash64(text_col).cast("string"))).alias("draw"), *(F.coalesce(c.cast("string"), F.lit(NONE)).alias(k) for k, c in levels.items()), (words_in(F.col(text_col)) if tokens is None else tokens.cast("long")).alias("n_tokens"))
    rows = keep(rows)
    leaves = keep(rows.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("leaf_rows")))
    plan = leaf_budgets(leaves.drop("leaf_rows"), names, budget_share, weights or {}, max_epochs)
    plan = plan.withColumn("epochs", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("long"))
    plan = plan.withColumn("rest", (F.col("budget") - F.col("epochs") * F.col("tokens")).cast("long")).select(*names, "epochs", "rest")
    plan = keep(plan.join(leaves.select(*names, "leaf_rows"), names))
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), F.col("draw")))
    rows = attach(rows, plan, names, "leaf_rows").drop("leaf_rows").withColumn("order_key", order).withColumn("range", F.substring("order_key", 1, 3))
    run = Window.partitionBy(*names).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy(*names, "range", "rest").agg(F.sum("n_tokens").alias("held")).withColumn("before", F.coalesce(F.sum("held").over(run), F.lit(0)))
    last = ranges.where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("held") >= F.col("rest"))).select(*names, F.col("range").alias("last_range"), "before")
    last = keep(leaves.select(*names, "leaf_rows").join(last, names, "left"))
    rows = attach(rows, last, names, "leaf_rows")
    inside = Window.partitionBy(*names).orderBy("order_key", "n_tokens", *_ROW_KEY).rowsBetween(Window.unboundedPreceding, -1)
    here = F.col("range") == F.col("last_range")
    edge = rows.where(here).withColumn("ahead", F.col("before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    edge = edge.withColumn("last_tokens", F.greatest(F.lit(0), F.least(F.col("n_tokens"), F.col("rest") - F.col("ahead")))).drop("ahead")
    rest = rows.where(~F.coalesce(here, F.lit(False))).withColumn("last_tokens", F.when(F.col("range") < F.col("last_range"), F.col("n_tokens")).otherwise(0))
    both = edge.unionByName(rest)
    return both.select("id", *_ROW_KEY, *names, "n_tokens", "epochs", "last_tokens", (F.col("epochs") * F.col("n_tokens") + F.col("last_tokens")).alias("tokens_taken"))


def keep_mixed(docs: DataFrame, budget_share: float, weights: dict[tuple[str, ...], float] | None = None, seed: int = 7, levels: dict[str, Column] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, that a mix of one epoch reads in whole or in part, or that have no words.

    Rows equal in id and text stay together if one is read."""
    taken = _mix(docs, budget_share, weights, 1, seed, levels, None, id_col, text_col).where("tokens_taken > 0 or n_tokens = 0")
    names = {k: f"_mix_{k}" for k in _ROW_KEY}
    keys = taken.select(*(F.col(k).alias(v) for k, v in names.items())).distinct()
    return docs.withColumns({names[k]: v for k, v in _row_keys(docs, id_col, text_col).items()}).join(keys, list(names.values()), "left_semi").drop(*names.values())


def source_domain(source: Column, domains: int = 4) -> Column:
    """The domain of a numbered source: its number modulo `domains`; sources without a number share one."""
    number = F.regexp_extract(source, r"(\d+)$", 1)
    return F.when(number != "", F.concat(F.lit("domain"), F.pmod(number.cast("long"), F.lit(domains)).cast("string")))
