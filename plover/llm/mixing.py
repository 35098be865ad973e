"""Mixing sources to target weights by hierarchical budgeting.

Weights are propagated down a tree (domain, language, source). A node that holds
less than its share gives the shortage to its siblings; because a node's own
share never exceeds what lies below it, a shortage reaches other branches only
when every sibling is used up. Each leaf then takes the prefix of its seeded
order that fits its budget; a budget above the supply runs through whole epochs
first.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, written

LEVELS = ("domain", "lang", "source")
#: Production weights; a value that is not named weighs 1.
WEIGHTS: dict[str, dict[str, int]] = {"domain": {"d0": 3, "d1": 2, "d2": 2, "d3": 1},
                                      "lang": {"en": 4, "de": 2, "fr": 2, "es": 1}}
#: The mix holds as many tokens as the corpus; a document is seen at most MAX_EPOCHS times.
SHARE_PERCENT, MAX_EPOCHS, SEED, SALTS = 100, 4, "mix-1", 64
_BEFORE = (Window.unboundedPreceding, -1)


def domain_of(source: Column) -> Column:
    """The domain of a source: its trailing number modulo 4 (none: 0)."""
    return F.concat(F.lit("d"), (F.coalesce(F.regexp_extract(source, "([0-9]{1,9})$", 1).try_cast("long"), F.lit(0)) % 4).cast("string"))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    out = F.lit(1)
    for value, w in weights.get(level, {}).items():
        out = F.when(F.col(level) == value, F.lit(int(w))).otherwise(out)
    return out.cast("double")


def _water_fill(nodes: DataFrame, parents: list[str], own: str) -> DataFrame:
    """``allot`` of each node from its parent's ``budget``: proportional to ``w``, at most ``cap``.

    Nodes are taken in order of cap per weight: those below the common level are
    filled, the rest share what is left by weight, rounded so that it adds up.
    """
    live = nodes.filter("w > 0 and cap > 0")
    order = Window.partitionBy(*parents).orderBy((F.col("cap") / F.col("w")), own)
    upto = F.coalesce(F.sum("cap").over(order.rowsBetween(*_BEFORE)), F.lit(0))
    rest = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = live.withColumn("c_before", upto).withColumn("w_rest", rest)
    full = level.withColumn("full", F.col("cap").cast("double") * F.col("w_rest") <= F.col("w") * (F.col("budget") - F.col("c_before")).cast("double"))
    everyone = Window.partitionBy(*parents)
    shared = (full.withColumn("left", F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everyone), F.lit(0)))
              .withColumn("w_open", F.sum(F.when(~F.col("full"), F.col("w")).otherwise(0.0)).over(everyone)))
    running = Window.partitionBy(*parents).orderBy("full", own)
    run = F.sum(F.when(~F.col("full"), F.col("w")).otherwise(0.0))
    cut = lambda w: F.floor(w * F.col("left").cast("double") / F.col("w_open"))
    part = cut(run.over(running.rowsBetween(Window.unboundedPreceding, 0))) - cut(F.coalesce(run.over(running.rowsBetween(*_BEFORE)), F.lit(0.0)))
    return shared.withColumn("allot", F.when(F.col("full"), F.col("cap")).otherwise(part).cast("long"))


def budgets(supply: DataFrame, total: Column, levels: tuple[str, ...] = LEVELS,
            weights: dict[str, dict[str, int]] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``levels..., supply, budget`` per leaf from ``levels..., supply`` (tokens, one row per leaf).

    ``total`` is a column over the whole supply (``all_supply``). Work is on one
    row per leaf; each window spans the children of one node.
    """
    leaves = supply.withColumn("cap", (F.col("supply") * max_epochs).cast("long"))
    level = None
    for k, own in enumerate(levels):
        parents = list(levels[:k])
        nodes = (leaves.groupBy(*levels[:k + 1]).agg(F.sum("cap").alias("cap"), F.sum("supply").alias("own_supply"))
                 .withColumn("w", _weight(own, weights)))
        if level is None:  # the root's children: one row per domain
            everything = Window.partitionBy()
            nodes = nodes.withColumn("all_supply", F.sum("own_supply").over(everything)).withColumn(
                "budget", F.least(total.cast("long"), F.sum("cap").over(everything)))
        else:
            nodes = nodes.join(level, parents)
        level = _water_fill(nodes, parents, own).select(*levels[:k + 1], F.col("allot").alias("budget"))
    return (supply.join(level, list(levels), "left")
            .select(*levels, "supply", F.coalesce("budget", F.lit(0).cast("long")).alias("budget")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
        share_percent: int = SHARE_PERCENT, weights: dict[str, dict[str, int]] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
        seed: str = SEED) -> DataFrame:
    """``doc_id, domain, lang, source, tokens, budget, copies`` for every row of ``docs``.

    Tokens are words (a packer's token ids are another unit: shares hold in words). The budget is ``share_percent`` of all tokens, at most
    what ``max_epochs`` passes supply. ``copies`` counts the epochs that hold
    the document: all whole epochs, and the last one if the running total of its
    leaf's order (md5 of seed, epoch and id, then id, then tokens) up to and with
    it stays within the budget. Null ids, languages and sources read as ''; a null or
    empty text has no tokens and costs nothing. Repeated rows count each. Other columns are
    ignored; empty table: empty result. Texts are read once: the narrow rows are
    written to the shared folder.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       domain_of(F.coalesce(F.col(source_col).cast("string"), F.lit(""))).alias("domain"),
                       F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
                       F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
                       word_count(F.col(text_col)).alias("tokens"))
    rows = written(rows, "mix")
    supply = rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("supply"))
    plan = budgets(supply, F.floor(F.col("all_supply") * share_percent / 100), LEVELS, weights, max_epochs)
    plan = plan.withColumn("whole", F.when(F.col("supply") > 0, F.floor(F.col("budget") / F.greatest("supply", F.lit(1)))).otherwise(0).cast("long"))
    plan = plan.withColumn("rest", F.col("budget") - F.col("whole") * F.col("supply"))
    # A leaf may hold a third of all rows: its plan row is repeated per salt.
    salt = F.pmod(F.xxhash64("doc_id", "tokens"), F.lit(SALTS)).cast("int")
    plan = plan.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    placed = rows.withColumn("salt", salt).join(plan, [*LEVELS, "salt"])
    key = F.md5(F.concat_ws(":", F.lit(seed), F.col("whole").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    placed = placed.withColumn("place", key).withColumn("bin", F.substring("place", 1, 3))
    # The running total: over at most 4,096 bins of a leaf, then inside a bin.
    bins = placed.groupBy(*LEVELS, "bin").agg(F.sum("tokens").alias("n"))
    bins = bins.select(*LEVELS, "bin", F.coalesce(F.sum("n").over(Window.partitionBy(*LEVELS).orderBy("bin").rowsBetween(*_BEFORE)), F.lit(0)).alias("before"))
    inside = F.sum("tokens").over(Window.partitionBy(*LEVELS, "bin").orderBy("place", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, 0))
    done = placed.withColumn("inside", inside).join(bins, [*LEVELS, "bin"])
    last = F.when(F.col("before") + F.col("inside") <= F.col("rest"), 1).otherwise(0)
    return done.select("doc_id", "domain", "lang", "source", "tokens", "budget", (F.col("whole") + last).cast("long").alias("copies"))


def shares(mixed: DataFrame) -> DataFrame:
    """``domain, supply, taken, share``: what each domain holds and its part of the mix, from :func:`mix`."""
    taken = F.col("tokens") * F.col("copies")
    by = mixed.groupBy("domain").agg(F.sum("tokens").alias("supply"), F.sum(taken).alias("taken"))
    return by.withColumn("share", F.col("taken") / F.greatest(F.sum("taken").over(Window.partitionBy()), F.lit(1)))


def take_mix(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of the mix, all columns unchanged: a document that ``n`` epochs hold stands ``n`` times.

    Each copy keeps the id of its document, so ids still name the corpus; whoever
    needs one row per document takes the distinct rows. A document that no epoch
    holds goes. Rows that share an id are taken as often as the one taken most.
    Column names of the input may be any.
    """
    keep, times = fresh(docs, "_keep", "_times")
    stay = (mix(docs, id_col, **options).filter("copies > 0").groupBy(F.col("doc_id").alias(keep))
            .agg(F.max("copies").alias(times)))
    met = docs.join(stay, F.col(id_col).cast("long").eqNullSafe(F.col(keep)))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col(times)))
    return met.withColumn(keep, copies).select(*[F.col(f"`{c}`") for c in docs.columns])
