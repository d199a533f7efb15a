"""Entities matched across sources without a common key.

Attribute values (typed names, ship-to names, cities, countries) and their tokens (words and letter trigrams) form a
graph with the records that hold them. Random walks over it give token sequences, skip-gram training turns those into
token vectors, and a value's vector is the weighted sum of its tokens'. Values are blocked by hyperplane hashing in
several tables, candidates are reranked by the exact cosine, an exact check of names and places decides, and the
cosine of the names, calibrated on accepted and rejected pairs, is the confidence. Hashing loses more pairs the larger
the index is; for values that it leaves without a firm partner, names that share enough rare trigrams are candidates
besides, at any size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.addresses import _COUNTRY_OF, parse_address, town_form
from ordermill.llm.addresses import folded as folded_place
from ordermill.llm.names import MARGIN, NAME, TOKEN, Weights, _contradict, _edits, agree, gram_candidates, grams, parse_name, parsed_names, token_similarity, with_grams
from ordermill.session import cut

#: Rows of the vector table (tokens are hashed to them) and their length: the model's size, whatever the data's.
ROWS, DIM = 1 << 14, 96
#: Hash tables, and entries a bucket should hold; the number of bits follows the size of the index.
TABLES, LOAD = 16, 24
#: Bits whose flips are looked up too: those nearest to their hyperplane.
FLIPS = 4
#: Least cosine of a candidate.
CANDIDATE = 0.38
#: Bits of a code that a group of the search holds: it has LOAD * 2 ** FINE entries of the index on average, at any size.
FINE = 7
#: Partitions whose vectors are summed in one group, as a fraction of all: the first of two levels.
FAN = 64
#: A value with a pair of this score has its organisation; the others are looked up by trigrams besides.
FIRM = 0.9
#: Numbers of a product that are held at once.
PIECE = 2_000_000
#: Values that a token keeps as neighbours for walks (the search doesn't use them).
NEIGHBOURS = 16
WALKS, STEPS, WINDOW, NEGATIVE, RATE = 2, 3, 4, 4, 0.03
#: Pairs on which the confidence is calibrated, at most; of the pairs that the exact check rejects one in REJECTED is kept
#: for it and counts so many times.
SAMPLE, REJECTED = 20_000, 64


def _bucket(token: str) -> int:
    return xxhash.xxh32_intdigest(token) % ROWS


def value_tokens(field: str, value: str) -> list[str]:
    """Tokens of an attribute value: trigrams of the words of a name (words too short for them as they are), forms of places."""
    if field == "name":
        words, _ = parse_name(value)
        return [f"g:{g}" for g in grams(tuple(words))] or [f"w:{w}" for w in words]
    if field == "city":
        t = town_form(value)
        return [f"c:{t}", *(f"t:{t[i : i + 3]}" for i in range(len(t) - 2))] if t else []
    k = _COUNTRY_OF.get(folded_place(value).strip(), folded_place(value).strip())
    return [f"l:{k}"] if k else []


def tokenised(values: DataFrame) -> DataFrame:
    """field, value -> field, value, buckets (hashed tokens); distinct values with tokens."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            b = [sorted({_bucket(t) for t in value_tokens(f, v)}) for f, v in zip(pdf["field"], pdf["value"])]
            yield pdf.assign(buckets=b)[[bool(x) for x in b]]

    return values.filter("value is not null").distinct().mapInPandas(run, "field string, value string, buckets array<int>")


def random_walks(records: DataFrame, tokens: DataFrame, seed: int = 5) -> DataFrame:
    """Sequences of buckets from walks value -> token -> value ..., and through records to their other values.

    records: r, field, value. Every value starts WALKS walks of STEPS steps; every record gives one sequence of tokens of
    its values.
    """
    pick = lambda a, salt: F.element_at(a, (F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), "walk"), F.size(a)) + 1).cast("int"))
    value = tokens.select(F.xxhash64("field", "value").alias("v"), "buckets")
    edges = value.select("v", F.explode("buckets").alias("b"))
    # a sample of each token's values: the smallest hashes, kept within partitions first
    near = cut(edges.withColumn("h", F.xxhash64(F.lit(seed), "v", "b")).groupBy("b", F.pmod("h", F.lit(NEIGHBOURS)).alias("slot")).agg(F.min_by("v", "h").alias("v")).groupBy("b").agg(F.array_sort(F.collect_list("v")).alias("vs")))
    start = value.withColumn("walk", F.explode(F.array(*[F.lit(i) for i in range(WALKS)]))).select(F.xxhash64("v", "walk").alias("walk"), "buckets")
    walk = start.select("walk", pick(F.col("buckets"), "a").alias("b"), F.array(pick(F.col("buckets"), "x"), pick(F.col("buckets"), "a")).alias("path"))
    for step in range(STEPS):
        walk = walk.join(near, "b").select("walk", pick(F.col("vs"), f"v{step}").alias("v"), "path").join(value, "v")
        nxt = pick(F.col("buckets"), f"n{step}")
        walk = walk.select("walk", nxt.alias("b"), F.concat("path", F.array(pick(F.col("buckets"), f"m{step}"), nxt)).alias("path"))
    # records: one token of each of their values, so that what occurs together comes together
    held = records.join(tokens, ["field", "value"]).select("r", "field", "buckets")
    for_record = held.withColumn("walk", F.xxhash64("r", "field")).select("r", "field", F.array(pick(F.col("buckets"), "r1"), pick(F.col("buckets"), "r2")).alias("p")).groupBy("r").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("field", "p"))), lambda x: x["p"])).alias("path"))
    return walk.select("path").unionByName(for_record.select("path"))


def _add_rows(table: np.ndarray, rows: np.ndarray, what: np.ndarray) -> None:
    """table[rows] += what, repeated rows summed: sorted sums are several times as fast as np.add.at."""
    order = np.argsort(rows, kind="stable")
    sorted_ = rows[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
    table[sorted_[first]] += np.add.reduceat(what[order], first, axis=0)


def skip_gram(walks: DataFrame, seed: int = 5) -> np.ndarray:
    """Vectors by skip-gram with negative sampling: every partition trains on its walks from the same start, the
    results are averaged by how often each row was trained. What returns is ROWS x DIM numbers at most."""

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rng = np.random.default_rng(seed)
        inner = rng.normal(0, 1 / math.sqrt(DIM), (ROWS, DIM)).astype("float32")
        outer = inner.copy()
        seen = np.zeros(ROWS, "int64")
        for pdf in batches:
            left, right = [], []
            for path in pdf["path"]:
                p = np.asarray(path)
                for k in range(1, min(WINDOW, len(p) - 1) + 1):
                    left.append(p[:-k])
                    right.append(p[k:])
            if not left:
                continue
            a, b = np.concatenate(left), np.concatenate(right)
            keep = a != b
            a, b = a[keep], b[keep]
            order = rng.permutation(len(a))
            for at in range(0, len(order), 4096):
                i = order[at : at + 4096]
                x, y = a[i], b[i]
                n = rng.choice(b, (len(i), NEGATIVE))
                vx = inner[x]
                pull = 1 - 1 / (1 + np.exp(-np.clip((vx * outer[y]).sum(1), -8, 8)))
                push = -1 / (1 + np.exp(-np.clip(np.einsum("id,ind->in", vx, outer[n]), -8, 8)))
                gx = pull[:, None] * outer[y] + np.einsum("in,ind->id", push, outer[n])
                _add_rows(outer, np.concatenate([y, n.ravel()]), np.concatenate([RATE * pull[:, None] * vx, (RATE * push[:, :, None] * vx[:, None, :]).reshape(-1, DIM)]))
                _add_rows(inner, x, RATE * gx)
                seen += np.bincount(x, minlength=ROWS)
        rows = np.flatnonzero(seen)
        yield pd.DataFrame({"row": rows.astype("int32"), "n": seen[rows], "vector": [x.tobytes() for x in inner[rows] * seen[rows, None].astype("float32")]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return pd.DataFrame({"row": pd.Series(dtype="int32"), "n": pd.Series(dtype="int64"), "vector": pd.Series(dtype="object")})
        v = np.frombuffer(b"".join(pdf["vector"]), "float32").reshape(-1, DIM)
        rows, at = np.unique(pdf["row"], return_inverse=True)
        total, n = np.zeros((len(rows), DIM), "float32"), np.zeros(len(rows), "int64")
        np.add.at(total, at, v)
        np.add.at(n, at, pdf["n"].to_numpy())
        return pd.DataFrame({"row": rows.astype("int32"), "n": n, "vector": [x.tobytes() for x in total]})

    fields = "row int, n long, vector binary"
    parts = walks.mapInPandas(train, fields).withColumn("_of", F.spark_partition_id() % FAN)
    # summed in two levels, so that a group holds a FAN-th of the partitions' vectors, then FAN sums
    some = parts.groupBy(F.col("row") % 64, "_of").applyInPandas(lambda pdf: add(pdf.drop(columns="_of")), fields)
    mean = some.groupBy(F.col("row") % 64).applyInPandas(add, fields).toPandas()
    vectors = np.random.default_rng(seed).normal(0, 1 / math.sqrt(DIM), (ROWS, DIM)).astype("float32")
    if len(mean):
        vectors[mean["row"].to_numpy()] = np.frombuffer(b"".join(mean["vector"]), "float32").reshape(-1, DIM) / np.maximum(mean["n"].to_numpy(), 1)[:, None]
    return vectors - vectors.mean(0)


def _sums(buckets: pd.Series, table: np.ndarray, weight: np.ndarray) -> np.ndarray:
    out = np.zeros((len(buckets), DIM), "float32")
    for i, b in enumerate(buckets):
        b = np.asarray(b)
        out[i] = (table[b] * weight[b, None]).sum(0)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def _vectors(buckets: pd.Series, table: np.ndarray, weight: np.ndarray, mean: np.ndarray) -> np.ndarray:
    out = _sums(buckets, table, weight) - mean
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def isotropic(values: DataFrame, table: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The table turned so that the values' vectors have no favoured direction, and their mean.

    Skip-gram vectors share a few strong directions; without this all cosines are high and hyperplanes don't divide.
    Moments are summed over all values, within partitions first. The fewer values, the more their covariance is shrunk
    towards that of a round cloud, so that a few values are treated like many.
    """

    def moments(table: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        shared = values.sparkSession.sparkContext.broadcast((table, weight))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total, outer, n = np.zeros(DIM), np.zeros((DIM, DIM)), 0
            for pdf in batches:
                v = _sums(pdf["buckets"], *shared.value).astype("float64")
                total, outer, n = total + v.sum(0), outer + v.T @ v, n + len(v)
            flat = np.concatenate([[n], total, outer.ravel()])
            yield pd.DataFrame({"at": np.arange(len(flat)), "x": flat})

        x = values.select("buckets").mapInPandas(run, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).toPandas().sort_values("at")["x"].to_numpy()
        if not len(x) or x[0] < 2:
            return 0, np.zeros(DIM), np.eye(DIM)
        return x[0], x[1 : DIM + 1] / x[0], x[DIM + 1 :].reshape(DIM, DIM) / x[0]

    n, mean, outer = moments(table)
    spread = outer - np.outer(mean, mean)
    own = n / (n + 2 * DIM)
    spread = own * spread + (1 - own) * max(np.trace(spread) / DIM, 1e-6) * np.eye(DIM)
    e, u = np.linalg.eigh(spread)
    turned = (table @ (u @ np.diag((np.maximum(e, 0) + 1e-6) ** -0.5) @ u.T)).astype("float32")
    return turned, moments(turned)[1].astype("float32")


def _planes(bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(TABLES, bits, DIM)).astype("float32")


def _sides(v: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Signed distances of vectors to the planes of some tables: vectors x tables x bits."""
    tables, bits, _ = planes.shape
    return (v @ planes.reshape(tables * bits, DIM).T).reshape(len(v), tables, bits)


def block(left: DataFrame, right: DataFrame, model, bits: int, seed: int = 11, check=None, fields: str = "a string, b string, cosine float") -> DataFrame:
    """a, b, cosine: values of left and right (value, buckets) that share a bucket in one of the tables and whose
    cosine is CANDIDATE at least.

    Vectors travel as bytes with the first bits of their code as key, all but FINE; inside a group the full codes, and
    those with one of the FLIPS least certain bits turned, meet the index; each pair comes from the first table it meets
    in. bits grows with the index, so buckets and groups keep their size and groups grow in number. Left values are
    dealt to salted groups, so a frequent code doesn't fill one task. check takes a batch of these rows and gives those
    of `fields` instead: it runs where the pairs are found, which spares sending them.
    """
    coarse = max(0, bits - FINE)
    check = check or (lambda pdf: pdf)

    def hashed(side: str):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            planes = _planes(bits, seed)
            for pdf in batches:
                v = _vectors(pdf["buckets"], *model.value)
                q = np.clip(np.round(v * 300), -127, 127).astype("int8")
                v = q.astype("float32") / (np.linalg.norm(q.astype("float32"), axis=1, keepdims=True) + 1e-9)
                first = (_sides(v, planes[:, :coarse]) > 0) @ (1 << np.arange(coarse)) if coarse else np.zeros((len(v), TABLES), "int64")
                salt = pdf["value"].map(lambda s: xxhash.xxh32_intdigest(s) % 2).to_numpy()
                for t in range(TABLES):
                    for s in (0, 1) if side == "right" else (None,):
                        yield pd.DataFrame({"key": ((first[:, t] * TABLES + t) * 2 + (salt if s is None else s)).astype("int64"), "value": pdf["value"], "vector": [x.tobytes() for x in q]})

        return run

    sent = "key long, value string, vector binary"
    a = left.select("value", "buckets").mapInPandas(hashed("left"), sent)
    b = right.select("value", "buckets").mapInPandas(hashed("right"), sent)

    def meet(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"a": pd.Series(dtype="object"), "b": pd.Series(dtype="object"), "cosine": pd.Series(dtype="float32")})
        if not len(x) or not len(y):
            return check(none)
        number = int(x["key"].iloc[0]) // 2 % TABLES
        planes = _planes(bits, seed)[: number + 1]
        power = 1 << np.arange(bits)

        def unit(raw: pd.Series) -> np.ndarray:
            v = np.frombuffer(b"".join(raw), "int8").reshape(-1, DIM).astype("float32")
            return v / (np.linalg.norm(v, axis=1, keepdims=True) + 1e-9)

        names, vy = y["value"].to_numpy(), unit(y["vector"])
        # codes in this table and the ones before it: a pair that meets there already isn't reported again
        codes = (_sides(vy, planes) > 0) @ power
        order = np.argsort(codes[:, -1], kind="stable")
        sorted_code = codes[order, -1]
        found = []
        for at in range(0, len(x), 2048):
            part = x["value"].to_numpy()[at : at + 2048]
            vx = unit(x["vector"].iloc[at : at + 2048])
            far = _sides(vx, planes)
            own = (far > 0) @ power
            weak = np.argsort(np.abs(far[:, :, coarse:]), axis=2)[:, :, :FLIPS] + coarse
            asked = np.concatenate([own[:, :, None], own[:, :, None] ^ (1 << weak)], axis=2)
            now = asked[:, -1].ravel()
            rows = np.argsort(now, kind="stable")
            wanted, first = np.unique(now[rows], return_index=True)
            lo, hi = np.searchsorted(sorted_code, wanted, "left"), np.searchsorted(sorted_code, wanted, "right")
            # one product of matrices per code, in pieces that stay small
            for c, begin, end in zip(range(len(wanted)), first, [*first[1:], len(rows)]):
                index = order[lo[c] : hi[c]]
                if not len(index):
                    continue
                step = max(1, PIECE // len(index))
                for r in range(begin, end, step):
                    own_rows = rows[r : min(r + step, end)] // asked.shape[2]
                    cos = vx[own_rows] @ vy[index].T
                    i, j = np.nonzero(cos >= CANDIDATE)
                    if not len(i):
                        continue
                    ii, jj = own_rows[i], index[j]
                    before = (asked[ii, :-1] == codes[jj, :-1, None]).any((1, 2))
                    found.append((part[ii[~before]], names[jj[~before]], cos[i, j][~before]))
        if not found:
            return check(none)
        return check(pd.DataFrame({"a": np.concatenate([f[0] for f in found]), "b": np.concatenate([f[1] for f in found]), "cosine": np.concatenate([f[2] for f in found])}))

    return a.groupBy("key").cogroup(b.groupBy("key")).applyInPandas(meet, fields)


def shared_grams(left: DataFrame, owners: DataFrame, common: dict[str, float]) -> DataFrame:
    """a, b: values of left and names of owners that share many of the trigrams that few customers have.

    Both ways: a typed name may go on with words for the place, a master name may be typed short.
    """
    words = left.sparkSession.createDataFrame([(t,) for t in common], "token string")
    typed = cut(with_grams(parsed_names(left.select(F.col("value").alias("name"))), words))
    known = cut(with_grams(parsed_names(owners.select(F.col("b").alias("name"))), words))
    # each direction is written, so that no plan holds both
    there = cut(gram_candidates(typed, known).select(F.col("name").alias("a"), F.col("m").alias("b")))
    back = cut(gram_candidates(known, typed).select(F.col("m").alias("a"), F.col("name").alias("b")))
    return there.unionByName(back).distinct()


def with_cosine(pairs: DataFrame, left: DataFrame, right: DataFrame, model) -> DataFrame:
    """a, b, cosine: the pairs whose exact cosine is CANDIDATE at least, from the buckets of left and right (value, buckets)."""

    def side(names: pd.Series, buckets: pd.Series) -> np.ndarray:
        at = pd.factorize(names)[0]
        first = np.unique(at, return_index=True)[1]
        return _vectors(buckets.iloc[first], *model.value)[at]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                cos = (side(pdf["a"], pdf["x"]) * side(pdf["b"], pdf["y"])).sum(1)
                yield pdf[["a", "b"]].assign(cosine=cos.astype("float32"))[cos >= CANDIDATE]

    both = pairs.join(left.select(F.col("value").alias("a"), F.col("buckets").alias("x")), "a").join(right.select(F.col("value").alias("b"), F.col("buckets").alias("y")), "b")
    return both.mapInPandas(run, "a string, b string, cosine float")


def _weights(tokens: DataFrame) -> tuple[np.ndarray, int]:
    """Weight of each row: the rarer among the master's values, the more."""
    n = tokens.count()
    counts = np.zeros(ROWS)
    for r in tokens.select(F.explode("buckets").alias("b")).groupBy("b").count().toLocalIterator():
        counts[r["b"]] = r["count"]
    return np.log(1 + max(n, 1) / (1 + counts)).astype("float32"), n


def _near_town(x: str, y: str) -> bool:
    if x == y:
        return True
    n = min(len(x), len(y))
    if n >= 7 and x[0] == y[0] and (y.endswith(x[1:]) or x.endswith(y[1:])):
        return True  # 'e vandermeer'
    if n >= 5 and _edits(x, y, 2) <= (2 if n >= 8 else 1):
        return True
    return n >= 6 and 2 * n >= max(len(x), len(y)) and (x.startswith(y) or y.startswith(x))


#: How a row's customer was found: by vectors of the name or of the ship-to name, by a number that a short name stands
#: for, or by what the sender's other records agree on. The last two have the confidence of the least cosine.
ROUTES = ("name", "ship_to_name", "number", "sender")


def match_entities(headers: DataFrame, vendors: DataFrame, alias: DataFrame) -> DataFrame:
    """record_id, vendor_id, confidence, route: the vendors rows of the record's organisation at the place the record names.

    The organisation is read from customer_id_or_name (known short names of alias stand for theirs), else from the ship-to name, else from what the sender's other
    records agree on. A record that names no place means the customer's only one. Error records, unknown customers
    and places the master doesn't list give no row; NULLs in any field and empty tables are fine.
    """
    spark = headers.sparkSession
    blank = lambda c: F.when(~F.lower(F.trim(c)).isin("", "n/a", "none", "null", "nan", "-", "#n/a", "tbd", "see letterhead"), F.trim(c))
    rec = headers.filter("error is null").select("record_id", "sender_email", blank("customer_id_or_name").alias("name"), blank("ship_to_name").alias("ship_name"), blank("ship_to_city").alias("city"), blank("ship_to_address").alias("address"), blank("ship_to_postcode").alias("postcode"))
    # names that are short names: one canonical name or number each
    lower = F.regexp_replace(F.lower(F.col("name")), r"( / \d+| [a-z]{2})$", "")
    short = alias.filter("alias is not null and canonical is not null").groupBy(F.lower(F.trim("alias")).alias("short")).agg(F.max(F.when(F.col("kind") == "name", F.col("canonical"))).alias("full"), F.max(F.when(F.col("kind") == "id", F.col("canonical"))).alias("number"))
    known_short = rec.select("name").filter("name is not null").distinct().withColumn("short", F.explode(F.array_distinct(F.array(F.lower("name"), lower, F.regexp_replace(lower, r" [a-z]{2}$", ""))))).join(short, "short").groupBy("name").agg(F.max("full").alias("full"), F.max("number").alias("number"))
    # a number stands for its fullest name, so the organisation's other numbers are found too
    fullest = vendors.select("customer_number", blank("name").alias("n")).filter("n is not null").groupBy(F.col("customer_number").alias("number")).agg(F.max_by("n", F.struct(F.length("n"), "n")).alias("fullest"))
    known_short = known_short.join(fullest, "number", "left").select("name", F.coalesce("full", "fullest").alias("full"), "number")
    # read by many steps: written once, so that their plans stay short
    rec = cut(rec.join(known_short, "name", "left").withColumn("name", F.coalesce("full", "name")).drop("full"))
    ven = vendors.select("vendor_id", "customer_number", blank("name").alias("name"), "ship_to", blank("ship_to_name").alias("ship_name"), blank("city").alias("city"), blank("country").alias("country"))

    pair = lambda f, c: F.struct(F.lit(f).alias("field"), F.col(c).alias("value"))
    left_values = rec.select(F.col("record_id").alias("r"), F.inline(F.array(pair("name", "name"), pair("name", "ship_name"), pair("city", "city"))))
    right_values = ven.select((-F.col("vendor_id") - 1).alias("r"), F.inline(F.array(pair("name", "name"), pair("name", "ship_name"), pair("city", "city"), pair("country", "country"))))
    both = left_values.unionByName(right_values).filter("value is not null")
    tokens = cut(tokenised(both.select("field", "value")))
    table = skip_gram(random_walks(both, tokens))

    master_values = ven.select(F.inline(F.array(F.struct("name"), F.struct(F.col("ship_name").alias("name"))))).filter("name is not null").distinct()
    names = tokens.filter("field = 'name'").select("value", "buckets")
    right = names.join(master_values.withColumnRenamed("name", "value"), "value", "left_semi")
    weight, n = _weights(right)
    table, mean = isotropic(right, table, weight)
    model = spark.sparkContext.broadcast((table, weight, mean))
    typed = rec.select(F.inline(F.array(F.struct("name"), F.struct(F.col("ship_name").alias("name"))))).filter("name is not null").distinct()
    left = cut(names.join(typed.withColumnRenamed("name", "value"), "value", "left_semi"))
    # the index holds the names of customers
    owners = ven.filter("name is not null").select("customer_number", F.col("name").alias("b")).distinct()
    index = cut(names.join(owners.select(F.col("b").alias("value")).distinct(), "value", "left_semi"))
    bits = max(4, math.ceil(math.log2(max(index.count(), 2) / LOAD)))

    # the exact check of names: as for spellings, with words that many customers share counting little
    shared_words = _common_words(owners)
    shared = spark.sparkContext.broadcast(shared_words)

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        """Pairs that the check accepts, and one in REJECTED of the others with a score of 0."""
        weight, rare = shared.value
        s, loose = [], []
        for a, b in zip(pdf["a"], pdf["b"]):
            (ta, fa), (tb, fb) = parse_name(a), parse_name(b)
            v = agree(ta, tb, weight, rare)
            loose.append(v < NAME)
            if v < NAME and len(ta) > 1:
                # a ship-to name may go on with words for the place: they count only where they fit, the first word always
                like = lambda t, tb=tb: any(token_similarity(t, x) >= TOKEN for x in tb)
                v = agree((ta[0], *filter(like, ta[1:])), tb, weight, rare) if like(ta[0]) else 0.0
            v = v + (0.04 if fa == fb else -0.06) if v and fa and fb else v
            s.append(v if v >= NAME else 0.0 if xxhash.xxh32_intdigest(f"{a}\0{b}") % REJECTED == 0 else None)
        out = pdf.assign(score=pd.Series(s, index=pdf.index, dtype="float64"), loose=pd.Series(loose, index=pdf.index, dtype="bool"))
        return out[out["score"].notna()]

    checked = "a string, b string, cosine float, score double, loose boolean"
    hashed = cut(block(left, index, model, bits, check=verify, fields=checked))
    # values without a firm partner are looked up by rare trigrams too, so that no length of codes loses them
    open_ = cut(left.join(hashed.filter(F.col("score") >= FIRM).select(F.col("a").alias("value")).distinct(), "value", "left_anti"))
    by_grams = cut(with_cosine(shared_grams(open_, owners, shared_words[0]), open_, index, model))
    more = by_grams.join(hashed.select("a", "b"), ["a", "b"], "left_anti").mapInPandas(lambda batches: map(verify, batches), checked)
    judged_pairs = cut(hashed.unionByName(more))
    verified = judged_pairs.filter(F.col("score") >= NAME)
    lists = verified.groupBy("a", "loose").agg(F.collect_list(F.struct("score", "b", "cosine")).alias("c"))

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weight, rare = shared.value
        for pdf in batches:
            rows = []
            for a, loose, c in zip(pdf["a"], pdf["loose"], pdf["c"]):
                c = sorted(((x["score"], x["b"], x["cosine"], *parse_name(x["b"])) for x in c), key=lambda x: (-x[0], -len(x[3]), x[1]))
                near = [x for x in c if x[0] >= c[0][0] - MARGIN]
                head = max((x for x in near if x[0] >= c[0][0] - 0.03), key=lambda x: (len(x[3]), x[0], x[1]))
                same = [x for x in near if not _contradict(head[3], x[3], head[4], x[4], weight, rare)]
                group = [(a, loose, x[1], float(x[2])) for x in same]
                unsure = any(x not in same and x[0] >= c[0][0] - 0.03 for x in near)
                rows += [(*g, unsure) for g in group]
                if unsure:
                    rows += [(a, loose, x[1], float(x[2]), True) for x in near if x not in same and x[0] >= c[0][0] - 0.03]
            yield pd.DataFrame(rows, columns=["a", "loose", "b", "cosine", "unsure"])

    decided = lists.mapInPandas(decide, "a string, loose boolean, b string, cosine double, unsure boolean")
    orgs = cut(decided.join(owners, "b").groupBy("a", "loose", "customer_number").agg(F.max("cosine").alias("cosine"), F.max("unsure").alias("unsure")))

    # customers of each record: by its name, else by the ship-to name, else by the sender's habit; each step is written,
    # since the next ones read it several times and one plan of them all has over 500 nodes
    strict = orgs.filter("not loose").drop("loose")
    in_ship = strict.unionByName(orgs.filter("loose").drop("loose").join(strict.select("a").distinct(), "a", "left_anti"))
    named = cut(rec.join(strict.withColumnRenamed("a", "name"), "name").select("record_id", "customer_number", "cosine", "unsure", F.lit(0).alias("route")))
    no_name = cut(rec.join(named.select("record_id").distinct(), "record_id", "left_anti").filter(_says_nothing("name")).select("record_id", "sender_email", "ship_name"))
    shipped = cut(no_name.join(in_ship.withColumnRenamed("a", "ship_name"), "ship_name").select("record_id", "customer_number", "cosine", "unsure", F.lit(1).alias("route")))
    numbered = rec.filter("number is not null").select("record_id", F.col("number").alias("customer_number"), F.lit(CANDIDATE).alias("cosine"), F.lit(False).alias("unsure"), F.lit(2).alias("route"))
    # a number whose names were found too comes from these
    numbered = numbered.join(named.select("record_id", "customer_number"), ["record_id", "customer_number"], "left_anti")
    known = cut(named.unionByName(shipped).unionByName(numbered))
    still = no_name.join(shipped.select("record_id").distinct(), "record_id", "left_anti")
    sure = known.filter("not unsure").join(rec.select("record_id", "sender_email"), "record_id").groupBy("record_id", "sender_email").agg(F.array_sort(F.collect_set("customer_number")).alias("cs"))
    habit = sure.groupBy("sender_email", "cs").agg(F.count("*").alias("n")).groupBy("sender_email").agg(F.max_by("cs", "n").alias("cs"), F.max("n").alias("n"), F.sum("n").alias("all")).filter("n >= 3 and n >= 0.95 * all")
    by_sender = still.join(habit.select("sender_email", "cs"), "sender_email").select("record_id", F.explode("cs").alias("customer_number"), F.lit(CANDIDATE).alias("cosine"), F.lit(False).alias("unsure"), F.lit(3).alias("route"))
    customers = cut(known.unionByName(by_sender))

    # places: towns a record names against the towns of the customer's rows
    place = rec.select("record_id", F.md5(F.to_json(F.struct("ship_name", "city", "address", "postcode"))).alias("p"), "ship_name", "city", "address", "postcode")
    towns = cut(_towns(place.dropDuplicates(["p"]).drop("record_id")))
    spelled = _master_towns(ven)
    rows = ven.select("vendor_id", "customer_number", "ship_to", F.col("ship_name").alias("v_ship")).join(spelled, "ship_to", "left")
    per_customer = rows.groupBy("customer_number").agg(F.collect_list(F.struct("vendor_id", "ship_to", "v_ship", "town")).alias("rows"))
    gazetteer = spelled.select(F.col("town").alias("t")).filter("t is not null").distinct()
    names_town = towns.select("p", F.explode("towns").alias("t")).join(gazetteer, "t", "left_semi").select("p").distinct().withColumn("named", F.lit(True))
    towns = towns.join(names_town, "p", "left")
    judged = customers.join(place.select("record_id", "p", "ship_name", "city", "address"), "record_id").join(towns, "p").join(per_customer, "customer_number").withColumn("any", F.coalesce("ship_name", "city", "address").isNotNull())

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weight, rare = shared.value
        for pdf in batches:
            out = []
            for r, cos, unsure, route, towns, named, any_, ship, rows in zip(pdf["record_id"], pdf["cosine"], pdf["unsure"], pdf["route"], pdf["towns"], pdf["named"], pdf["any"], pdf["ship_name"], pdf["rows"]):
                # a row without a town may name it in the ship-to name
                hit = [x for x in rows if (any(_near_town(t, x["town"]) for t in towns) if x["town"] else bool(x["v_ship"]) and any(len(t) >= 6 and t in town_form(x["v_ship"]) for t in towns))]
                strength = 1.0
                if not hit and ship:
                    st, _ = parse_name(ship)
                    hit = [x for x in rows if not (x["town"] and named) and x["v_ship"] and st and agree(st, parse_name(x["v_ship"])[0], weight, rare) >= 0.9 and len(st) >= 2]
                    strength = 0.8
                    if len({x["ship_to"] for x in hit}) > 1:
                        hit = []
                if not hit and named is not True and len({x["ship_to"] for x in rows}) == 1:
                    hit, strength = list(rows), (0.7 if not any_ else 0.6)
                out += [(r, x["vendor_id"], cos, strength, unsure, route, x["ship_to"]) for x in hit]
            yield pd.DataFrame(out, columns=["record_id", "vendor_id", "cosine", "strength", "unsure", "route", "ship_to"])

    kind = {c: vendors.schema[c].dataType.simpleString() for c in ("vendor_id", "ship_to")} | {"record_id": headers.schema["record_id"].dataType.simpleString()}
    chosen = judged.select("record_id", "cosine", "unsure", "route", "towns", "named", "any", "ship_name", "rows").mapInPandas(choose, f"record_id {kind['record_id']}, vendor_id {kind['vendor_id']}, cosine double, strength double, unsure boolean, route int, ship_to {kind['ship_to']}")
    chosen = cut(chosen)
    # a name that fits several organisations counts where only one of them has the place
    one = chosen.filter("unsure").groupBy("record_id").agg(F.count_distinct("ship_to").alias("n")).filter("n = 1").select("record_id")
    kept = chosen.filter("not unsure").unionByName(chosen.filter("unsure").join(one, "record_id", "left_semi"))
    slope, level = _calibrate(judged_pairs)
    score = (F.lit(1.0) / (1.0 + F.exp(-(F.col("cosine") * slope + level)))) * F.col("strength")
    best = kept.groupBy("record_id", "vendor_id").agg(F.max(score).alias("confidence"), F.min("route").alias("_route"))
    return best.select("record_id", "vendor_id", "confidence", F.get(F.array(*[F.lit(r) for r in ROUTES]), F.col("_route")).alias("route"))


def _says_nothing(c: str):
    """A name field that names nobody: NULL or a bare number."""
    return F.col(c).isNull() | F.col(c).rlike(r"(?i)^[\W\d_]*(?:[a-z]{1,2}[- ]?)?\d[\d\W]*$")


def _common_words(owners: DataFrame) -> tuple[Weights, float]:
    """Weights of the words that many customers share, and the weight of all others; see names.link_names."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(c, t) for c, b in zip(pdf["customer_number"], pdf["b"]) for t in parse_name(b)[0]]
            yield pd.DataFrame(rows, columns=["customer_number", "token"])

    n = owners.select("customer_number").distinct().count()
    kind = owners.schema["customer_number"].dataType.simpleString()
    counts = owners.mapInPandas(run, f"customer_number {kind}, token string").groupBy("token").agg(F.count_distinct("customer_number").alias("n")).filter(F.col("n") > 5 + 0.0005 * n)
    return Weights({r["token"]: max(0.3, math.log(1 + n / r["n"]) * 0.45) for r in counts.toLocalIterator()}), math.log(1 + n / 2)


def _towns(places: DataFrame) -> DataFrame:
    """p, towns: forms of the towns that may be named in the ship-to fields."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for ship, city, address, postcode in zip(pdf["ship_name"], pdf["city"], pdf["address"], pdf["postcode"]):
                found = [town_form(city)] if city else []
                p = parse_address(address, postcode, city)
                if p:
                    found += p.towns
                elif address:
                    found += _grams_of(address)
                if ship:
                    found += _grams_of(ship)
                out.append(list(dict.fromkeys(t for t in found if len(t) >= 4)))
            yield pd.DataFrame({"p": pdf["p"], "towns": out})

    return places.mapInPandas(run, "p string, towns array<string>")


def _grams_of(text: str) -> list[str]:
    words = [w for w in folded_place(text).replace(",", " ").replace(";", " ").replace("/", " ").split() if w]
    return [t for n in (3, 2, 1) for i in range(len(words) - n + 1) if len(t := town_form(" ".join(words[i : i + n]))) >= 5]


def _master_towns(ven: DataFrame) -> DataFrame:
    """ship_to, town: the town form of each place; from its other rows where a row lacks it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(town=[town_form(c) or None for c in pdf["city"]])[["ship_to", "town"]]

    kind = ven.schema["ship_to"].dataType.simpleString()
    towns = ven.filter("city is not null").select("ship_to", "city").mapInPandas(run, f"ship_to {kind}, town string")
    return towns.filter("town is not null").groupBy("ship_to").agg(F.mode("town", True).alias("town"))


def _calibrate(judged: DataFrame) -> tuple[float, float]:
    """Slope and level of a logistic curve from cosine to the share of pairs that the exact check accepts.

    Fitted on accepted and rejected pairs, SAMPLE of them at most: those of the lowest hashes, the same however the
    pairs are partitioned. A pair found twice counts once.
    """
    one = judged.groupBy("a", "b").agg(F.max("cosine").alias("cosine"), F.max("score").alias("score"))
    # written, so that each partition's lowest hashes meet in a task: at the end of a plan they would meet in the driver
    sample = cut(one.orderBy(F.xxhash64("a", "b"), "a", "b").limit(SAMPLE).select("cosine", "score")).toPandas()
    x, y = sample["cosine"].to_numpy(float), (sample["score"].to_numpy(float) >= NAME).astype(float)
    n = np.where(y > 0, 1.0, REJECTED)
    start = np.array([8.0, -4.0])
    w, design = start.copy(), np.stack([x, np.ones_like(x)], 1)

    def loss(w: np.ndarray) -> float:
        z = design @ w
        # a slight pull to the start, so that separable pairs have a finite curve
        return float((n * (np.logaddexp(0, z) - y * z)).sum() + 5e-3 * ((w - start) ** 2).sum())

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (n * (p - y)) + 1e-2 * (w - start)
        step = np.linalg.solve((design * (n * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2), gradient)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        if size <= 1e-6 or np.abs(size * step).max() < 1e-6:
            break
        w = w - size * step
    return float(max(w[0], 0.0)), float(w[1])
