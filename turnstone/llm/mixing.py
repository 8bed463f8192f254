"""Mixing sources to target weights by hierarchical budgets (operator 3).

Leaves are (domain, language, source).  A token budget flows from the root to
domains, languages and sources in proportion to their weights.  A node that
holds fewer tokens than its share takes what it holds, and its shortage goes
to its siblings first; only what a whole family cannot hold goes back to the
family's own siblings.  Each leaf then takes a token prefix: documents in
a seeded order, whole epochs first and the last one up to the budget.

Only DataFrame functions run here.  Budgets are exact integers.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, free_name, split_words

LEVELS = ("domain", "lang", "source")
#: Hex digits of the order key that name a bucket, step by step: running sums
#: go over the totals of buckets in the bucket in which the budget ends, and
#: only the last one is sorted by document.
BUCKET_DIGITS = (2, 4, 6)


def weight_of(name: Column, weights: Mapping[str, int], default: int = 1) -> Column:
    """The weight of a node by its name; *default* for names not listed."""
    out = F.lit(default)
    for key, value in weights.items():
        out = F.when(name == key, F.lit(value)).otherwise(out)
    return out.cast("decimal(38,0)")


def share_out(nodes: DataFrame, family: list[str]) -> DataFrame:
    """Add ``budget`` to nodes that have ``parent_budget``, ``capacity`` and ``weight``.

    Within a family the nodes are ordered by capacity per weight.  A node is
    full if the rate at which the remaining budget would be dealt out reaches
    that ratio; the others share what the full ones leave, rounded down.  A
    node of weight zero gets nothing.
    """
    zero = F.col("weight") <= 0
    nodes = nodes.withColumn("_cap", F.when(zero, F.lit(0)).otherwise(F.col("capacity")).cast("decimal(38,0)")).withColumn("_weight", F.when(zero, F.lit(1)).otherwise(F.col("weight")).cast("decimal(38,0)"))
    names = [c for c in LEVELS if c in nodes.columns]
    order = Window.partitionBy(*family).orderBy(F.col("_cap").cast("double") / F.col("_weight").cast("double"), *names)
    before = F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weights = F.sum("_weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    nodes = nodes.withColumn("_left", (F.col("parent_budget") - before).cast("decimal(38,0)")).withColumn("_weights", weights.cast("decimal(38,0)"))
    nodes = nodes.withColumn("_full", (F.col("_left") * F.col("_weight")) >= (F.col("_cap") * F.col("_weights")))
    span = Window.partitionBy(*family)
    taken = F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(span), F.lit(0))
    open_weight = F.sum(F.when(~F.col("_full"), F.col("_weight"))).over(span)
    nodes = nodes.withColumn("_rest", (F.col("parent_budget") - taken).cast("decimal(20,0)")).withColumn("_open", open_weight.cast("decimal(18,0)"))
    share = F.expr("cast((_rest * cast(_weight as decimal(18,0))) div _open as bigint)")
    budget = F.when(F.col("_full"), F.col("_cap").cast("long")).otherwise(share)
    return nodes.withColumn("budget", budget).drop("_cap", "_weight", "_left", "_weights", "_full", "_rest", "_open")


def leaf_budgets(leaves: DataFrame, total: Column, weights: Mapping[str, Mapping[str, int]], epochs: int) -> DataFrame:
    """(domain, lang, source, tokens, budget) from one row per leaf with ``tokens``.

    *total* is the budget as an expression over ``all_tokens``.  The windows
    go over one row per node.
    """
    leaves = leaves.withColumn("capacity", F.col("tokens") * epochs)
    for name in LEVELS:
        leaves = leaves.withColumn(f"{name}_weight", weight_of(F.col(name), weights.get(name, {})))
    usable = F.when((F.col("source_weight") > 0) & (F.col("lang_weight") > 0) & (F.col("domain_weight") > 0), F.col("capacity")).otherwise(F.lit(0))
    languages = leaves.groupBy("domain", "lang").agg(F.sum(usable).alias("capacity"), F.max("lang_weight").alias("weight"), F.sum("tokens").alias("tokens"), F.max("domain_weight").alias("domain_weight"))
    domains = languages.groupBy("domain").agg(F.sum("capacity").alias("capacity"), F.max("domain_weight").alias("weight"), F.sum("tokens").alias("tokens"))
    root = domains.agg(F.sum("tokens").alias("all_tokens")).select(total.cast("long").alias("parent_budget"))
    domains = share_out(domains.join(F.broadcast(root), F.lit(True)), []).select("domain", F.col("budget").alias("parent_budget"))
    languages = share_out(languages.join(domains, "domain"), ["domain"]).select("domain", "lang", F.col("budget").alias("parent_budget"))
    sources = share_out(leaves.withColumn("weight", F.col("source_weight")).join(languages, ["domain", "lang"]), ["domain", "lang"])
    return sources.select(*LEVELS, "tokens", "budget")


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    """A document's place in an epoch's seeded order, as 32 hex digits."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def mix_sources(
    docs: DataFrame,
    domain: Column,
    weights: Mapping[str, Mapping[str, int]],
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    budget_permille: int = 600,
    epochs: int = 2,
    seed: int = 3,
    into: str = "mix",
    broadcast_rows: int = 100_000,
) -> DataFrame:
    """*docs*, every row and column, with the struct column *into*.

    Its fields are ``domain``, ``tokens`` (words), and ``copies``, the number
    of epochs that take the document, zero for those left out.  The budget is
    *budget_permille* thousandths of all tokens.  *weights* maps "domain",
    "lang" and "source" to weights by name, 1 where a name isn't listed.

    A document is in its leaf's last epoch if the tokens of the documents
    before it there are fewer than what whole epochs leave of the budget;
    documents with the same id tie and are taken together.  Null domains,
    languages and sources count as empty strings, null texts as no tokens, and
    a null id as its text's hash.  An empty table gives an empty one.

    Running sums go over bucket totals of the order key, so a leaf of any size
    is spread over all tasks; of 16 ** 6 buckets only the one in which its
    budget ends is ordered by document.  The cut table has one row per leaf and is broadcast
    up to *broadcast_rows* leaves.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    into = free_name(docs, into)
    own = free_name(docs, "_mix")
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    parts = F.struct(text(domain).alias("domain"), text(F.col(lang_col)).alias("lang"), text(F.col(source_col)).alias("source"), F.size(split_words(F.col(text_col))).cast("long").alias("tokens"), F.coalesce(F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")))).alias("id"))
    rows = docs.withColumn(own, parts)
    sizes = scratch.keep(rows.select(f"{own}.*"), "sizes")

    leaves = sizes.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    budgets = leaf_budgets(leaves, F.expr(f"all_tokens * {int(budget_permille)} div 1000"), weights, epochs)
    whole = F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(0).cast("long"))
    budgets = scratch.keep(budgets.withColumn("epoch", whole).withColumn("rest", F.col("budget") - F.col("epoch") * F.col("tokens")).drop("tokens", "budget"), "budgets")
    few = budgets.count() <= broadcast_rows
    small = lambda df: F.broadcast(df) if few else df

    keyed = sizes.join(small(budgets), [*LEVELS]).where("rest > 0").withColumn("key", order_key(seed, F.col("epoch"), F.col("id")))
    # The documents of the bucket in which the budget ends, and the tokens before it.
    inside = keyed.withColumn("before", F.lit(0).cast("long"))
    for digits in BUCKET_DIGITS:
        inside = inside.withColumn("bucket", F.substring("key", 1, digits))
        totals = inside.groupBy(*LEVELS, "bucket").agg(F.sum("tokens").alias("tokens"), F.max("rest").alias("rest"), F.max("before").alias("before"))
        upto = F.sum("tokens").over(Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
        ends = totals.withColumn("before", F.col("before") + upto - F.col("tokens")).where("before < rest").groupBy(*LEVELS).agg(F.max(F.struct("bucket", "before")).alias("last"))
        ends = scratch.keep(ends.select(*LEVELS, F.col("last.bucket").alias("bucket"), F.col("last.before").alias("before")), "ends")
        inside = keyed.withColumn("bucket", F.substring("key", 1, digits)).join(small(ends), [*LEVELS, "bucket"]).drop("bucket")
    inside = inside.groupBy(*LEVELS, "key").agg(F.sum("tokens").alias("tokens"), F.max("before").alias("before"), F.max("rest").alias("rest"))
    upto = F.sum("tokens").over(Window.partitionBy(*LEVELS).orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
    cuts = inside.withColumn("start", F.col("before") + upto - F.col("tokens")).where("start < rest").groupBy(*LEVELS).agg(F.max("key").alias("cut"))
    cuts = scratch.keep(budgets.join(cuts, [*LEVELS], "left").select(*LEVELS, "epoch", "cut"), "cuts")

    cut = free_name(docs, "_cut")
    named = cuts.select(F.struct(*LEVELS).alias(cut + "_leaf"), F.struct("epoch", "cut").alias(cut))
    joined = rows.join(small(named), F.struct(*(F.col(f"{own}.{c}") for c in LEVELS)) == F.col(cut + "_leaf"), "left")
    taken = order_key(seed, F.col(f"{cut}.epoch"), F.col(f"{own}.id")) <= F.col(f"{cut}.cut")
    copies = F.col(f"{cut}.epoch") + F.when(taken, 1).otherwise(0)
    return joined.select(*docs.columns, F.struct(F.col(f"{own}.domain").alias("domain"), F.col(f"{own}.tokens").alias("tokens"), copies.alias("copies")).alias(into))
