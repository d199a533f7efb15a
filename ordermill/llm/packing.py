"""Documents packed into containers of fixed capacity.

Sum-of-squares online packing: N(h) counts the open containers filled to level h. A document of size s goes to the
level h (an open container's, or 0 for a new one) that makes the sum of N(h) squared least, so no level piles up and
containers close full. Documents are dealt at random to shards of bounded size; each shard packs its own in one pass
with one level array for each capacity.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.tokens import VOCABULARY, count_tokens

#: Documents a shard holds on average; a shard leaves at most a few containers partly filled.
SHARD = 20_000


def pack(sizes: list[int], capacity: int) -> list[tuple[int, int, int]]:
    """Container and offset of each size, in order: (container, offset, size). Sizes are 1 to capacity."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    placed, containers = [], 0
    for s in sizes:
        # gain of taking a container from level h, and of putting one on level h + s
        reach = capacity - s + 1
        change = 1 - 2 * counts[:reach]
        change[counts[:reach] == 0] = 1 << 40
        change[0] = 0
        to = 2 * counts[s : capacity + 1] + 1
        to[-1] = 0
        change += to
        best = int(change.min())
        h = int(np.flatnonzero(change == best)[-1])  # the fullest of equals
        if h:
            c = open_[h].pop()
            counts[h] -= 1
        else:
            c, containers = containers, containers + 1
        placed.append((c, h, s))
        if h + s < capacity:
            open_[h + s].append(c)
            counts[h + s] += 1
    return placed


def pack_documents(documents: DataFrame, capacities: DataFrame, vocabulary: str = VOCABULARY, shard: int = SHARD) -> DataFrame:
    """capacity_id, container, doc_id, piece, tokens, position, filled, fill: one row per document (or piece) and capacity.

    A document stays whole unless it is longer than the container; then it is cut into full pieces and a rest. filled
    counts the tokens of its container, fill is their share of the capacity. NULL and empty texts have no size and
    give no row; repeated doc_ids are packed one by one; capacities below 1 are left out. capacities is a short list.
    """
    sizes = count_tokens(documents, "doc_id", vocabulary=vocabulary).filter("tokens > 0")
    n = max(1, -(-documents.count() // shard))
    wanted = sorted({(r["capacity_id"], r["capacity_tokens"]) for r in capacities.filter("capacity_tokens >= 1").select("capacity_id", "capacity_tokens").distinct().toLocalIterator()})
    columns = ["capacity_id", "container", "doc_id", "piece", "tokens", "position", "filled", "fill"]

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_at", "doc_id"])
        parts = []
        for capacity_id, capacity in wanted:
            ids, pieces, lengths = [], [], []
            for d, t in zip(pdf["doc_id"], pdf["tokens"]):
                for piece in range(-(-t // capacity)):
                    ids.append(d)
                    pieces.append(piece)
                    lengths.append(min(capacity, t - piece * capacity))
            placed = pack(lengths, capacity)
            out = pd.DataFrame({"capacity_id": capacity_id, "c": [c for c, _, _ in placed], "doc_id": ids, "piece": pieces, "tokens": lengths, "position": [h for _, h, _ in placed]})
            out["filled"] = out.groupby("c")["tokens"].transform("sum")
            out["fill"] = out["filled"] / capacity
            out["container"] = f"{key[0]}-" + out["c"].astype(str)
            parts.append(out[columns])
        return pd.concat(parts) if parts else pd.DataFrame(columns=columns)

    kind = documents.schema["doc_id"].dataType.simpleString()
    dealt = sizes.withColumn("_at", F.xxhash64("doc_id")).withColumn("_shard", F.pmod("_at", F.lit(n)))
    # one partition for each shard on average; adaptive execution would put small ones into a single task
    return dealt.repartition(n, "_shard").groupBy("_shard").applyInPandas(run, f"capacity_id int, container string, doc_id {kind}, piece int, tokens long, position long, filled long, fill double")
