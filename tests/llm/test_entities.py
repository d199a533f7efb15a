import numpy as np
from pyspark.sql import functions as F

from ordermill.llm import entities as E

VENDORS = [(1, "c1", "Preixdicherk Automotive LLC", "s1", "Preixdicherk Warehouse", "Saint Coralie", "US"), (2, "c1", "PREIXDICHERK AUTOMOTIVE", "s2", "Preixdicherk Plant", "Port Merrion", "US"), (3, "c1", "Preixdicherk Autom. LLC", "s1", "Preixdicherk Whs.", None, "USA"), (4, "c2", "Tebiaskeilt Moulding Co., Ltd.", "s3", "Tebiaskeilt Lager Gyeonduk-ri", "Gyeonduk-ri", "KR"), (5, "c3", "Jevabox Packaging Inc.", "s4", "Jevabox", "Velmünde", "DE"), (6, "c3b", "Jevabox Packaging", "s4", "Jevabox", "Velmünde", "DE"), (7, None, None, None, None, None, None)]
OTHERS = [(100 + i, f"o{i}", f"{a}{b}kro {k}", f"t{i}", f"{a}{b}kro Werk", c, "DE") for i, (a, b, k, c) in enumerate((a, b, k, c) for a in ("Blan", "Dro", "Stir", "Mel", "Vort", "Quin", "Zast") for b in ("dusk", "feld", "garn", "helz", "jork") for k, c in (("Folien AG", "Brakenau"), ("Moulding SA", "Tessendorn"), ("Packaging Ltd", "Brakenau"), ("Automotive AG", "Tessendorn")))]
HEADERS = [
    (1, "a@x", "Preixdicherk Automotive", None, "St. Coralie", None, None, None, {1, 3}), (2, "a@x", "Preixdicherk Autmotive LLC / 99006", "Preixdicherk Plant", None, "61 Gliakihous Blvd, Port Merrion 15820", None, None, {2}),
    (3, "a@x", "Preixdicherk LLC", None, "Kelsbury", None, None, None, set()), (4, "b@x", "Tebiaskeilt Moulding", None, None, None, None, None, {4}), (5, "b@x", "K-1234", "Tebiaskeilt Lager Gyeonduk-ri", None, None, None, None, {4}),
    (6, "c@x", "Jevabox Packaging Inc.", None, None, None, None, None, {5, 6}), (7, "c@x", None, None, None, None, None, "json parse error", set()), (8, "d@x", "Unknown Werke GmbH", None, "Velmünde", None, None, None, set()), (9, "e@x", "PXAL", None, "Port Merrion", None, None, None, {2}), (10, None, "", "", "", "", "", None, set()), (11, None, "y" * 9000, None, None, None, None, None, set()),
]
SCHEMA = "record_id long, sender_email string, customer_id_or_name string, ship_to_name string, ship_to_city string, ship_to_address string, ship_to_postcode string, error string"


def frames(spark):
    v = spark.createDataFrame(VENDORS + OTHERS, "vendor_id long, customer_number string, name string, ship_to string, ship_to_name string, city string, country string")
    h = spark.createDataFrame([r[:-1] for r in HEADERS], SCHEMA)
    a = spark.createDataFrame([("pxal", "Preixdicherk Automotive LLC", "name")], "alias string, canonical string, kind string")
    return h, v, a


def test_matches(spark):
    h, v, a = frames(spark)
    got = E.match_entities(h, v, a).collect()
    for r in HEADERS:
        assert {x["vendor_id"] for x in got if x["record_id"] == r[0]} == r[-1], r
    assert all(0 < x["confidence"] <= 1 for x in got)


def test_plans_stay_short(spark):
    """No step's plan holds all those before it: the driver plans each again after every stage and keeps the texts."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    # plans as they are made first: adaptive execution leaves out what turns out to be empty here
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        E.match_entities(*frames(spark)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    runs = store.executionsList()
    sizes = [store.planGraph(runs.apply(i).executionId()).allNodes().size() for i in range(before, runs.size())]
    assert len(sizes) > 10 and max(sizes) <= 150, sizes


def test_empty(spark):
    h, v, a = frames(spark)
    assert E.match_entities(h.limit(0), v, a).count() == 0
    assert E.match_entities(h.withColumns({"number": F.lit("c2"), "cosine": F.lit(1)}), v.limit(0), a.limit(0)).count() == 0


def test_blocking_against_brute_force(spark):
    """Recall of the hash tables over all pairs above the candidates' least cosine."""
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), 9)) for _ in range(400)]
    typed = [w[:i] + w[i + 1 :] for w in words for i in (2, 6)]
    frame = lambda ws: E.tokenised(spark.createDataFrame([("name", w) for w in ws], "field string, value string"))
    left, right = frame(typed), frame(words)
    weight, n = E._weights(right)
    table = np.random.default_rng(5).normal(0, 1 / np.sqrt(E.DIM), (E.ROWS, E.DIM)).astype("float32")
    table, mean = E.isotropic(right, table, weight)
    model = spark.sparkContext.broadcast((table, weight, mean))
    found = {(r["a"], r["b"]) for r in E.block(left, right, model, 5).collect()}
    l, r = left.toPandas(), right.toPandas()
    cos = E._vectors(l["buckets"], *model.value) @ E._vectors(r["buckets"], *model.value).T
    i, j = np.where(cos >= 0.45)
    want = {(l["value"][x], r["value"][y]) for x, y in zip(i, j)}
    assert len(want) > 300 and len(want & found) >= 0.9 * len(want)


def test_spellings_are_found_at_the_code_length_of_a_large_index(spark, monkeypatch):
    """With codes as long as those of a master of 1.6 billion names, hashing finds hardly more than equal values."""
    monkeypatch.setattr(E, "LOAD", 2.0**-20)
    h, v, a = frames(spark)
    got = E.match_entities(h, v, a).collect()
    for r in HEADERS:
        assert {x["vendor_id"] for x in got if x["record_id"] == r[0]} == r[-1], r
    assert all(0 < x["confidence"] <= 1 for x in got)


def test_confidence_is_the_share_of_accepted_pairs(spark):
    """The curve against the share of pairs that were accepted, in bands of the cosine."""
    rng = np.random.default_rng(4)
    cos = rng.uniform(0.38, 1.0, 6000)
    accepted = rng.uniform(size=6000) < 1 / (1 + np.exp(-(20 * cos - 12)))
    # of the rejected pairs one in REJECTED is kept
    kept = [(f"a{i}", "b", float(c), 0.9 if y else 0.0) for i, (c, y) in enumerate(zip(cos, accepted)) if y or i % E.REJECTED == 0]
    slope, level = E._calibrate(spark.createDataFrame(kept, "a string, b string, cosine double, score double"))
    for lo, hi in ((0.4, 0.5), (0.55, 0.65), (0.7, 0.8), (0.9, 1.0)):
        band = (cos >= lo) & (cos < hi)
        assert abs((1 / (1 + np.exp(-(slope * cos[band] + level)))).mean() - accepted[band].mean()) < 0.08, (lo, slope, level)
    assert E._calibrate(spark.createDataFrame([], "a string, b string, cosine double, score double"))[0] > 0


def test_calibration_sends_the_driver_its_sample_only(spark, monkeypatch):
    """Every partition has a full sample of low hashes; they meet in a task, not in the driver."""
    context = spark.sparkContext._jsc.sc()
    stages = lambda: context.statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    monkeypatch.setattr(E, "SAMPLE", 2000)
    pairs = E.cut(spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("a"), F.lit("b").alias("b"), (F.col("id") % 100 / 100).alias("cosine"), F.when(F.col("id") % 2 == 0, 0.9).otherwise(0.0).alias("score")))
    context.listenerBus().waitUntilEmpty()
    last = max(stages().apply(i).stageId() for i in range(stages().size()))
    # several partitions, and Spark's default way of fetching rows
    options = ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.execution.arrow.pyspark.enabled")
    for o in options:
        spark.conf.set(o, "false")
    try:
        E._calibrate(pairs)
    finally:
        for o in options:
            spark.conf.set(o, "true")
    context.listenerBus().waitUntilEmpty()
    sent = [(s.stageId(), s.numTasks(), s.resultSize()) for s in (stages().apply(i) for i in range(stages().size())) if s.stageId() > last]
    assert sent and sum(x for _, _, x in sent) < 300_000, sent
