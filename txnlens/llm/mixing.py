"""Mixing sources to target weights by hierarchical budgets.

The corpus is a tree of domains, languages and sources. A token budget flows down from the root in
proportion to the weights of the children. No node gets more than its leaves can give, that is their
tokens times the number of epochs; what a node cannot take is shared out among its siblings by
weight, again up to what they can take, and only what all siblings together cannot take is
missing at their parent, whose own siblings then get it. As every node's capacity is the sum of its
leaves', but for those without a budget, doing this level by level from the root gives exactly that order.

A leaf then takes whole epochs and a prefix of the next one: in each epoch its documents stand in
another seeded order, and they are taken as long as the running token count stays within what is
left of the budget.

Leaves are counted first, so the tree has one row per source. Shortages are settled in rounds of
grouped sums over the siblings; only whether a round changed anything comes to the driver. Running
counts are taken in buckets of a bounded number of documents, so a leaf that holds a third of all rows
is not ordered in one task.

Edge cases: null domain, language and source are nodes of their own. Null and blank texts have no tokens; they
are taken with every whole epoch and with the prefix; a leaf without any tokens gives nothing. Weights default to 1; a weight of null, zero or
less gives a node no budget. Repeated rows are separate documents; those equal in id and text stand at
the same place of the order, and share its running count in any order. An empty table gives an empty
result; columns other than ``doc_id``, ``text`` and those of the levels are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txnlens.llm.common import BLANKS, split_by_filter, table, whole_text, written

DOMAINS = 4
#: Share of all tokens that the mix has.
BUDGET = 0.5
EPOCHS = 2
SEED = 20
#: Documents whose running count is taken together.
BUCKET_ROWS = 4096
_SPAN = 1 << 40


#: The levels from the root as SQL over the documents. They have no domains: sources are dealt to them by a hash.
DOCUMENT_LEVELS = {"domain": f"concat('domain', crc32(coalesce(source, '')) % {DOMAINS})", "lang": "lang", "source": "source"}
#: Weights of the registered mix: the first domain counts twice, English three times.
WEIGHTS = {"domain": "CASE WHEN domain = 'domain0' THEN 2.0D ELSE 1.0D END", "lang": "CASE WHEN lang = 'en' THEN 3.0D ELSE 1.0D END"}


def token_count(text: Column) -> Column:
    """Words of a text, split at ASCII white space."""
    inner = F.regexp_replace(text, rf"^{BLANKS}|{BLANKS}$", "")
    return F.when(inner == "", 0).otherwise(F.size(F.split(inner, BLANKS))).cast("bigint")


def shares(children: DataFrame, parents: list[str], node: str) -> DataFrame:
    """Divide ``_given`` of the parent among the children by ``_weight``, up to ``_capacity``: adds ``_budget``.

    Each round gives every child that is not yet full its part of what is left; children that
    cannot take it are filled up and leave the rounds. What remains of the last round is final.
    """
    key = F.struct(*parents) if parents else F.lit(0)
    state = children.withColumn("_parent", key).withColumn("_full", F.col("_weight") <= 0).withColumn("_budget", F.lit(0.0))
    state = written(state, f"budget-{node}")
    while True:
        rest = state.groupBy("_parent").agg(
            (F.first("_given") - F.sum(F.when(F.col("_full"), F.col("_budget")).otherwise(0.0))).alias("_rest"),
            F.sum(F.when(F.col("_full"), 0.0).otherwise(F.col("_weight"))).alias("_open"),
        )
        part = F.when(F.col("_open") > 0, F.col("_rest") * F.col("_weight") / F.col("_open")).otherwise(0.0)
        told = state.join(written(rest, f"rest-{node}"), "_parent").withColumn("_part", F.greatest(part, F.lit(0.0)))
        fills = ~F.col("_full") & (F.col("_part") >= F.col("_capacity"))
        budget = F.when(F.col("_full"), F.col("_budget")).when(fills, F.col("_capacity")).otherwise(F.col("_part"))
        told = told.select(
            *(c for c in state.columns if c not in ("_full", "_budget")),
            (F.col("_full") | fills).alias("_full"), budget.alias("_budget"), fills.alias("_filled"),
        )
        told = written(told, f"budget-{node}")
        state = told.drop("_filled")
        if told.where("_filled").isEmpty():
            return state.drop("_parent", "_full")


def leaf_budgets(leaves: DataFrame, levels: tuple[str, ...], weights: dict[str, str], budget: float, epochs: int) -> DataFrame:
    """``leaves`` (the levels, ``_tokens``) with ``_budget``: the tokens that each leaf gives."""
    # What lies below a node without a budget takes nothing, so it is no capacity of the nodes above.
    open_ = F.lit(True)
    for node in levels:
        open_ = open_ & F.coalesce(F.expr(weights.get(node, "1.0D")).cast("double") > 0, F.lit(False))
    nodes = leaves.withColumn("_capacity", F.when(open_, F.col("_tokens").cast("double") * epochs).otherwise(0.0))
    given = None
    for depth, node in enumerate(levels, 1):
        path = list(levels[:depth])
        children = nodes.groupBy(*path).agg(F.sum("_capacity").alias("_capacity"))
        weight = F.expr(weights.get(node, "1.0D")).cast("double")
        children = children.withColumn("_weight", F.greatest(F.coalesce(weight, F.lit(0.0)), F.lit(0.0)))
        if given is None:
            children = children.withColumn("_given", F.lit(float(budget)))
        else:
            above = given.select(F.struct(*path[:-1]).alias("_above"), F.col("_budget").alias("_given"))
            children = children.withColumn("_above", F.struct(*path[:-1])).join(above, "_above").drop("_above")
        given = shares(children, path[:-1], node)
    return given.select(F.struct(*levels).alias("_leaf"), "_budget")


def draw(seed: int, epoch: Column) -> Column:
    """A repeatable number in [0, 2^40) for each document and epoch."""
    return F.pmod(F.xxhash64(F.lit(seed), epoch, F.col("doc_id"), F.col("_text_hash")), F.lit(_SPAN))


def selected(rows: DataFrame, leaves: DataFrame, seed: int, epochs: int) -> DataFrame:
    """Adds ``copies`` to ``rows`` (``_leaf``, ``doc_id``, ``_text_hash``, ``tokens``) from the budget of their leaf.

    ``leaves`` has ``_leaf, _tokens, _documents, _budget``.
    """
    whole = F.when(F.col("_tokens") > 0, F.floor(F.col("_budget") / F.col("_tokens"))).otherwise(F.lit(0)).cast("bigint")
    told = leaves.withColumn("_whole", whole).withColumn("_left", F.floor(F.col("_budget") - F.col("_whole") * F.col("_tokens")).cast("bigint"))
    told = told.withColumn("_buckets", F.ceil(F.col("_documents") / F.lit(BUCKET_ROWS)))
    told = written(told.select("_leaf", "_whole", "_left", "_buckets", F.col("_budget").alias("leaf_budget")), "leaf-plan")
    placed = rows.join(told, "_leaf").withColumn("_draw", draw(seed, F.col("_whole")))
    placed = placed.withColumn("_bucket", F.floor(F.col("_draw") * F.col("_buckets") / F.lit(_SPAN)).cast("bigint"))
    sums = placed.groupBy("_leaf", "_bucket").agg(F.sum("tokens").alias("_sum"))
    before = W.partitionBy("_leaf").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = written(sums.select("_leaf", "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before")), "bucket-sums")
    # Only the bucket where the prefix ends has to be ordered; those before are in, those after are out.
    placed = placed.join(sums, ["_leaf", "_bucket"])
    within = W.partitionBy("_leaf", "_bucket").orderBy("_draw", "doc_id", "_row").rowsBetween(W.unboundedPreceding, W.currentRow)
    # After the last epoch there is no prefix, in which texts without tokens would still have room.
    taken = (F.col("_before") + F.sum("tokens").over(within) <= F.col("_left")) & (F.col("_whole") < epochs)
    # A leaf without budget gives nothing, not even texts without tokens.
    some = (F.col("leaf_budget") > 0).cast("bigint")
    return placed.withColumn("copies", (F.col("_whole") + taken.cast("bigint")) * some)


def mixture(
    docs: DataFrame,
    levels: dict[str, str],
    weights: dict[str, str] | None = None,
    budget: float = BUDGET,
    epochs: int = EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """Per row: ``doc_id``, the levels, ``tokens``, the leaf's ``leaf_tokens`` and ``leaf_budget``, ``copies``, ``_text_hash``.

    ``levels`` and ``weights`` are SQL, over the documents and over the levels. ``budget`` is a share of all tokens.
    """
    names = tuple(levels)
    text = docs.select("doc_id", *(F.expr(e).alias(n) for n, e in levels.items()), whole_text().alias("_text"))
    rows = text.select(
        "doc_id", F.struct(*names).alias("_leaf"), token_count(F.col("_text")).alias("tokens"),
        F.xxhash64("_text").alias("_text_hash"), F.monotonically_increasing_id().alias("_row"),
    )
    rows = written(rows, "mix-rows")
    leaves = written(rows.groupBy("_leaf").agg(F.sum("tokens").alias("_tokens"), F.count("*").alias("_documents")), "leaves")
    total = leaves.agg(F.coalesce(F.sum("_tokens"), F.lit(0))).first()[0]
    tree = leaves.select("_leaf.*", "_tokens")
    given = leaf_budgets(tree, names, weights or {}, budget * total, epochs)
    given = written(given, "leaf-budgets")
    found = selected(rows, leaves.join(given, "_leaf"), seed, epochs)
    return found.join(leaves.select("_leaf", F.col("_tokens").alias("leaf_tokens")), "_leaf").select(
        "doc_id", "_leaf.*", "tokens", "leaf_tokens", F.floor("leaf_budget").cast("bigint").alias("leaf_budget"), "copies", "_text_hash"
    )


def mix_once(docs: DataFrame, budget: float, weights: dict[str, str] | None = None, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` that a mix of one epoch takes, all columns as they were.

    Rows are found again by id and text; those that repeat both are taken together or not at all.
    """
    found = mixture(docs, DOCUMENT_LEVELS, weights, budget, epochs=1, seed=seed)
    # As a struct, a null id equals a null id.
    taken = found.groupBy(F.struct("doc_id", "_text_hash").alias("_key")).agg(F.max("copies").alias("_copies"))
    out = written(taken.where("_copies = 0").select("_key"), "not-mixed")
    key = F.struct(F.col("doc_id"), F.xxhash64(whole_text()).alias("_text_hash"))
    likely, rest = split_by_filter(docs.select(F.struct("*").alias("_doc"), key.alias("_key")), "_key", out)
    return rest.select("_doc").unionByName(likely.join(out, "_key", "left_anti").select("_doc")).select("_doc.*")


def op10_hierarchical_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixture(docs, DOCUMENT_LEVELS, WEIGHTS).drop("_text_hash")


ENTRIES = {"op10_hierarchical_mix": (op10_hierarchical_mix, None)}
