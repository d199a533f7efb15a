"""Sources mixed to target shares of the total size in tokens.

Hierarchical budgeting: the weights of the sources go down a tree (domain, language, source) by what each leaf holds;
a leaf that is short even when repeated as often as allowed passes the rest to its siblings first, and only what
they can't take to the siblings of its ancestors. Each leaf then takes whole epochs of its documents and the
token-prefix of one more epoch in a seeded order. The prefix is found with a histogram over the order's hash, so no
leaf, however large, is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.tokens import VOCABULARY, count_tokens
from ordermill.session import cut

#: Bits of the order's hash that a histogram tells apart.
BITS = 12
#: Leaves that the driver plans for; more categories than that are a mistake in the levels.
MOST_LEAVES = 200_000


def fill(budget: float, weights: list[float], room: list[float]) -> list[float]:
    """Budget over siblings by weight, none above its room; what one can't take goes to the others by weight."""
    given = [0.0] * len(weights)
    active = [i for i in range(len(weights)) if weights[i] > 0 and room[i] > 0]
    left = min(budget, sum(room[i] for i in active))
    while active and left > 1e-9:
        total = sum(weights[i] for i in active)
        full = [i for i in active if given[i] + left * weights[i] / total >= room[i] - 1e-9]
        if not full:
            for i in active:
                given[i] += left * weights[i] / total
            break
        for i in full:
            left -= room[i] - given[i]
            given[i] = room[i]
        active = [i for i in active if i not in full]
    return given


def plan_budgets(leaves: dict[tuple, tuple[float, float]], budget: float) -> dict[tuple, float]:
    """Tokens for each leaf, a path of names -> (weight, most tokens it can give)."""

    def down(paths: list[tuple], depth: int, budget: float) -> dict[tuple, float]:
        if len(paths) == 1 or depth == len(paths[0]):
            return {p: min(budget, leaves[p][1]) for p in paths[:1]}
        groups: dict = {}
        for p in paths:
            groups.setdefault(p[depth], []).append(p)
        names = sorted(groups)
        shares = fill(budget, [sum(leaves[p][0] for p in groups[g]) for g in names], [sum(leaves[p][1] for p in groups[g] if leaves[p][0] > 0) for g in names])
        found: dict[tuple, float] = {}
        for g, share in zip(names, shares):
            found |= down(groups[g], depth + 1, share)
        return found

    return down(sorted(leaves), 0, budget) if leaves else {}


def mix_sources(documents: DataFrame, targets: DataFrame, budget: int | None = None, seed: int = 17, vocabulary: str = VOCABULARY, domain: str = "doc_type", language: str = "lang") -> DataFrame:
    """doc_id, source, epoch, tokens: every use of a document in the mix of budget tokens (default: the corpus' size).

    Sources without a target, NULL sources and texts without tokens are left out; a NULL domain or language is a
    category of its own. A document appears at most max_repeats times, once per epoch. The mix is the same for the
    same seed, however the data are partitioned.
    """
    sizes = cut(count_tokens(documents, "doc_id", "source", domain, language, vocabulary=vocabulary).filter("tokens > 0").join(targets.select("source").distinct(), "source", "left_semi").select("doc_id", "source", F.coalesce(domain, F.lit("?")).alias("_domain"), F.coalesce(language, F.lit("?")).alias("_language"), "tokens"))
    path = ["_domain", "_language", "source"]
    wish = {r["source"]: (r["target_share"], r["max_repeats"]) for r in targets.filter("target_share > 0 and max_repeats > 0").toLocalIterator()}
    held = [tuple(r) for r in sizes.groupBy(*path).agg(F.sum("tokens")).limit(MOST_LEAVES + 1).toLocalIterator()]
    if len(held) > MOST_LEAVES:
        raise ValueError(f"more than {MOST_LEAVES} leaves")
    by_source: dict[str, int] = {}
    for *_, source, n in held:
        by_source[source] = by_source.get(source, 0) + n
    leaves = {(d, l, s): (wish[s][0] * n / by_source[s], float(n * wish[s][1])) for d, l, s, n in held if s in wish}
    size = {(d, l, s): n for d, l, s, n in held}
    budgets = plan_budgets(leaves, budget if budget is not None else sum(by_source.values()))
    spark = documents.sparkSession
    plan = [(*p, int(b // size[p]), int(round(b - (b // size[p]) * size[p]))) for p, b in budgets.items() if b >= 1]
    plan_df = spark.createDataFrame(plan, "_domain string, _language string, source string, whole int, rest long")
    docs = sizes.join(F.broadcast(plan_df), path)
    whole = docs.filter("whole > 0").select("doc_id", "source", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)).alias("epoch"), "tokens")
    # the last epoch: its order is a hash of seed, epoch and document
    last = docs.filter("rest > 0").withColumn("_at", F.xxhash64(F.lit(seed), "whole", "doc_id")).withColumn("_bucket", F.shiftrightunsigned("_at", 64 - BITS))
    filled = last.groupBy(*path, "rest", "_bucket").agg(F.sum("tokens").alias("n"))
    before = filled.withColumn("_before", F.sum("n").over(Window.partitionBy(*path).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))).select(*path, "_bucket", F.coalesce("_before", F.lit(0)).alias("_before"), (F.coalesce("_before", F.lit(0)) + F.col("n")).alias("_after"))
    placed = last.join(before, [*path, "_bucket"])
    inside = placed.filter(F.col("_after") <= F.col("rest"))
    edge = placed.filter((F.col("_before") < F.col("rest")) & (F.col("_after") > F.col("rest")))
    order = Window.partitionBy(*path).orderBy("_at", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    edge = edge.withColumn("_upto", F.col("_before") + F.sum("tokens").over(order)).filter(F.col("_upto") <= F.col("rest"))
    part = inside.select("doc_id", "source", F.col("whole").alias("epoch"), "tokens").unionByName(edge.select("doc_id", "source", F.col("whole").alias("epoch"), "tokens"))
    return whole.unionByName(part)


def mix_shares(selection: DataFrame, targets: DataFrame) -> DataFrame:
    """source, target_share, documents, uses, tokens, share, most_uses: what the mix came to; sources without a use have 0."""
    per_doc = selection.groupBy("source", "doc_id").agg(F.count("*").alias("uses"), F.sum("tokens").alias("tokens"))
    per_source = per_doc.groupBy("source").agg(F.count("*").alias("documents"), F.sum("uses").alias("uses"), F.sum("tokens").alias("tokens"), F.max("uses").alias("most_uses"))
    all_ = targets.join(per_source, "source", "left").na.fill(0, ["documents", "uses", "tokens", "most_uses"])
    total = F.sum("tokens").over(Window.partitionBy())
    return all_.select("source", "target_share", "documents", "uses", "tokens", F.when(total > 0, F.col("tokens") / total).otherwise(0.0).alias("share"), "most_uses")
