"""Hot-key inputs (one user holds most rows): the bucketed exact ranks
still give the brute-force answers."""

import hashlib
import random

from pyspark.sql import functions as F

from browsekit.operators import sequences
from browsekit.operators.ranking import hash_sample


def test_sequences_with_a_hot_user(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):                       # hot user: many rows, many per minute
        rows.append(("hot", "pid", f"s{i % 5}", f"a{i}", rnd.randint(1, 50), 1_700_000_000 + i // 3))
    for u in range(20):
        for i in range(rnd.randint(1, 25)):
            rows.append((f"u{u}", "pid", "s", f"b{i}", rnd.randint(1, 50), 1_700_000_000 + 60 * i))
    df = (spark.createDataFrame(rows, "email string, activity_type string, session_id string, "
                                      "activity string, item int, sec long")
          .withColumn("activity_dt", F.timestamp_seconds("sec")))
    got = {(r.email, r.chunk): list(r["items"]) for r in sequences.to_sequences(df).collect()}
    for user in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == user), key=lambda r: (r[5], r[2], r[3]))
        items = [r[4] for r in mine]
        for k in range((len(items) + 9) // 10):
            end = len(items) - 10 * k
            window = items[max(0, end - 10):end]
            assert got[(user, k)] == [0] * (10 - len(window)) + window


def test_hash_sample_with_a_hot_group(spark):
    rows = [("hot", f"k{i}") for i in range(5000)] + [(f"g{j}", f"x{j}_{i}")
                                                       for j in range(10) for i in range(j + 1)]
    df = spark.createDataFrame(rows, "g string, key string")
    got = {(r.g, r.key) for r in hash_sample(df, "key", "seed", lambda n: F.bround(F.lit(0.3) * n),
                                             group_cols=("g",)).collect()}
    for g in {r[0] for r in rows}:
        keys = sorted((hashlib.md5(("seed" + k).encode()).hexdigest(), k) for gg, k in rows if gg == g)
        n = len(keys)
        take = round(0.3 * n)                    # Python rounds half to even, as bround
        assert {(g, k) for _, k in keys[:take]} == {x for x in got if x[0] == g}
