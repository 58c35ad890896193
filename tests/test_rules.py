"""Unit tests on the null, order and rounding rules and the
small predicates, on literal frames."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from browsekit import config
from browsekit.functions import parse
from browsekit.operators import inventory, recommend, recipients, sequences


def test_first_match_replace(spark):
    df = spark.createDataFrame([("a1b2",), ("1b2c",), ("12",), ("",), (None,), ("01x7y",)], "s string")
    got = [r[0] for r in df.select(parse.first_match_drop_nondigits(F.col("s"))).collect()]
    assert got == ["1b2", "12c", "12", "", None, "017y"]


def test_regex_no_match_is_null(spark):
    df = spark.createDataFrame([("pid=123_45",), ("x",)], "s string")
    got = [r[0] for r in df.select(parse.regex_group_or_null("s", r"pid=([0-9_]+)")).collect()]
    assert got == ["123_45", None]


def test_activity_parse_category_wins(spark):
    df = spark.createDataFrame([("cgid=boots&pid=0000001_01",), ("pid=0000002_02?q=1",),
                                ("xpid=7&y",), ("src=home",)], "query_string string")
    got = df.select(parse.activity().alias("a"), parse.activity_type().alias("t"),
                    parse.has_activity().alias("h")).collect()
    assert [tuple(r) for r in got] == [("boots", "cgid", True), ("0000002_02", "pid", True),
                                       ("7", "pid", True), ("", "pid", False)]


def test_group_key_null_propagates(spark):
    df = spark.createDataFrame([("0000001", "01"), ("0000001", None)], "a string, b string")
    got = [r[0] for r in df.select(parse.group_key("a", "b")).collect()]
    assert got == ["0000001_01", None]


def test_latest_size_null_date_first_and_greatest_sku(spark):
    orders = spark.createDataFrame(
        [("e", 1, None, "000000000005"), ("e", 2, "2024-01-01", "000000000006"),
         ("f", 3, "2024-01-02", "000000000005"), ("f", 4, "2024-01-02", "000000000006")],
        "billing_email string, order_id long, order_date string, sales_order_sku string",
    ).withColumn("order_date", F.col("order_date").cast("timestamp"))
    variants = spark.createDataFrame([(1, "Shoes")], "id long, category string")
    skus = spark.createDataFrame([(1, "000000000005", "35"), (1, "000000000006", "36")],
                                 "product_variant_id long, upc string, identifier string")
    got = {r.email: r.identifier for r in inventory.latest_sizes(orders, variants, skus).collect()}
    assert got == {"e": "35", "f": "36"}


def test_best_per_user_nan_last(spark):
    df = spark.createDataFrame([("u", "a", float("nan"), None), ("u", "b", 0.2, None),
                                ("v", "c", None, None), ("v", "d", 0.1, None)],
                               "email string, activity string, pred double, upc string")
    got = {r.email: r.activity for r in recommend.best_per_user(df).collect()}
    assert got == {"u": "b", "v": "d"}


def test_color_predicate_four_cases(spark):
    df = spark.createDataFrame(
        [(None, "01", "active"), (None, "01", "inactive"), (["01"], "01", "inactive"),
         (["02"], "01", "active"), ([], "01", "active")],
        "color_code array<string>, sksz_color_code string, active_flag string")
    got = [r[0] for r in df.select(inventory.color_ok()).collect()]
    assert got == [True, False, True, False, False]


def test_inventory_duplicates_and_missing_qty(spark):
    doc = ('[{"sku":"a","qty":2},{"sku":"b"},{"sku":"c","qty":0},{"sku":"a","qty":5},'
           '{"sku":"d","qty":3},{"sku":"d","qty":0}]')
    ev = spark.createDataFrame([(1, "inventory.publish", '[{"sku":"z","qty":9}]'),
                                (2, "inventory.publish", doc), (3, "other", "[]")],
                               "id long, type string, event string")
    got = {r.sku: r.qty for r in inventory.inventory_from_events(ev).collect()}
    assert got == {"a": 5, "d": 3}
    capped = {r.sku: r.qty for r in inventory.inventory_from_events(ev, upper_limit=4).collect()}
    assert capped == {"a": 2, "d": 3}


def test_stock_share_counts_rows(spark):
    # a SKU wanted twice counts twice: p has 3 of 4 rows in stock (0.75),
    # but only 1 of its 2 distinct SKUs
    prods = spark.createDataFrame([("p", "01", "s1"), ("p", "01", "s1"), ("p", "01", "s1"),
                                   ("p", "01", "s2"), ("q", "01", "s3")],
                                  "activity string, sksz_color_code string, upc string")
    stocked = spark.createDataFrame([("s1",), ("s3",)], "sku string")
    rows = {r.activity: r.frac_of_color
            for r in inventory.color_stock_share(prods, stocked).collect()}
    assert rows == {"p": 0.75, "q": 1.0}
    distinct = {r.activity for r in
                inventory.color_stock_share(prods, stocked, distinct_skus=True).collect()}
    assert distinct == {"q"}


def test_half_even_sample_sizes(spark):
    for n, expect in ((5, 2), (7, 4), (1, 0), (3, 2), (9, 4)):
        df = spark.createDataFrame([(f"e{i}",) for i in range(n)], "email string")
        assert recipients.fraction_sample(df, 0.5).count() == expect


def test_sequence_padding_lengths(spark):
    for n in (1, 9, 10, 11, 20, 23):
        rows = [("u", "pid", f"s{i}", f"a{i}", i + 1, i) for i in range(n)]
        df = (spark.createDataFrame(rows, "email string, activity_type string, session_id string, "
                                          "activity string, item int, sec long")
              .withColumn("activity_dt", F.timestamp_seconds("sec")))
        seqs = sorted(sequences.to_sequences(df).collect(), key=lambda r: r.chunk)
        assert len(seqs) == math.ceil(n / 10)
        assert all(len(r["items"]) == 10 for r in seqs)
        flat = [x for r in reversed(seqs) for x in r["items"] if x != 0]
        assert flat == list(range(1, n + 1))
        assert seqs[0]["items"][-1] == n


def test_sequence_overlapping_windows(spark):
    rows = [("u", "pid", "s", f"a{i}", i + 1, i) for i in range(7)]
    df = (spark.createDataFrame(rows, "email string, activity_type string, session_id string, "
                                      "activity string, item int, sec long")
          .withColumn("activity_dt", F.timestamp_seconds("sec")))
    got = {r.chunk: list(r["items"]) for r in sequences.to_sequences(df, length=4, step=2).collect()}
    assert got == {0: [4, 5, 6, 7], 1: [2, 3, 4, 5], 2: [0, 1, 2, 3], 3: [0, 0, 0, 1]}


def test_dense_index_sorted(spark):
    df = spark.createDataFrame([(x,) for x in ["b", "a", "c", "a", "e", "d"]], "activity string")
    got = sorted((r.activity, r.idx) for r in sequences.fit_vocabulary(df).collect())
    assert got == [("a", 0), ("b", 1), ("c", 2), ("d", 3), ("e", 4)]


def test_null_color_filter_keeps_null(spark):
    df = spark.createDataFrame([("u", "p", ""), ("u", "p", None), ("u", "q", "01")],
                               T.StructType([T.StructField("email", T.StringType()),
                                             T.StructField("activity", T.StringType()),
                                             T.StructField("color_code", T.StringType())]))
    got = {r.activity: list(r.color_code) for r in recommend.color_lists(df).collect()}
    assert got == {"p": [], "q": ["01"]}


def test_dense_index_many_partitions(spark):
    from browsekit.operators.ranking import dense_index
    import random
    vals = [f"v{random.Random(3).randint(0, 10**9) + i * 7919:012d}" for i in range(3000)]
    df = spark.createDataFrame([(v,) for v in vals + vals[:500]], "activity string")
    got = dense_index(df, "activity", partitions=7)
    assert got.select("activity").distinct().count() == 3000
    rows = sorted((r.activity, r.idx) for r in got.collect())
    assert [i for _, i in rows] == list(range(3000))


def test_null_safe_department_join(spark):
    preds = spark.createDataFrame([("e", "x_01")], "email string, activity string")
    variants = spark.createDataFrame([(1, "x", "01", "Bags")],
                                     "id long, product_style_code string, group_code string, "
                                     "category string")
    latest = spark.createDataFrame([("e", None, "37")], "email string, dept string, identifier string")
    plain = inventory.user_sizes(preds, variants, latest).collect()
    safe = inventory.user_sizes(preds, variants, latest, null_safe=True).collect()
    assert plain[0].identifier is None and safe[0].identifier == "37"


def test_approximate_sample_is_repeatable(spark):
    df = spark.createDataFrame([(f"e{i}",) for i in range(2000)], "email string")
    a = {r.email for r in recipients.fraction_sample(df, 0.45, exact=False).collect()}
    b = {r.email for r in recipients.fraction_sample(df, 0.45, exact=False).collect()}
    assert a == b and 700 < len(a) < 1100


def test_sequence_windows_with_gaps(spark):
    rows = [("u", "pid", "s", f"a{i}", i + 1, i) for i in range(11)]
    df = (spark.createDataFrame(rows, "email string, activity_type string, session_id string, "
                                      "activity string, item int, sec long")
          .withColumn("activity_dt", F.timestamp_seconds("sec")))
    got = {r.chunk: list(r["items"]) for r in sequences.to_sequences(df, length=3, step=5).collect()}
    # windows end at 11, 6, 1 (newest first) and hold the 3 items before each end
    assert got == {0: [9, 10, 11], 1: [4, 5, 6], 2: [0, 0, 1]}


def test_send_probability_from_spark_ml_model(spark):
    import math as m
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors
    from browsekit.operators import features
    from browsekit import config
    train = spark.createDataFrame([(float(i % 2), Vectors.dense([i * 0.1, -i * 0.05, 1.0, 0.5 * i, 0.0, 1.0]))
                                   for i in range(40)], ["label", "features"])
    model = LogisticRegression(maxIter=20).fit(train)
    rows = [(f"e{i}", *[float(i * (j + 1)) / 10 for j in range(6)]) for i in range(5)]
    scaled = spark.createDataFrame(rows, "email string, " + ", ".join(f"`{n}` double" for n in config.SEND_FEATURES))
    got = {r.email: r.send_pred for r in features.send_probability_from_model(scaled, model).collect()}
    w, b = model.coefficients.toArray(), model.intercept
    for e, *x in rows:
        z = b + sum(wi * xi for wi, xi in zip(w, x))
        assert m.isclose(got[e], 1 / (1 + m.exp(-z)), rel_tol=1e-9)


def test_transform_refuses_unseen_labels_and_growth_keeps_old_ids(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "activity string")
    vocab = sequences.fit_vocabulary(df)
    assert sorted((r.activity, r.item) for r in sequences.transform(df, vocab).collect()) == [("a", 1), ("b", 2), ("c", 3)]
    for bad in ("d", None):
        with pytest.raises(Exception, match="label outside the vocabulary: " + (bad or "null")):
            sequences.transform(spark.createDataFrame([("a",), (bad,)], "activity string"), vocab).collect()
    more = spark.createDataFrame([("c",), ("aa",), ("A",), ("aa",), (None,)], "activity string")
    grown = sequences.grow_vocabulary(vocab, more)
    assert sorted((r.idx, r.activity) for r in grown.collect()) == [(0, "a"), (1, "b"), (2, "c"), (3, "A"), (4, "aa")]
    assert dict(grown.dtypes) == dict(vocab.dtypes)
    fresh = sequences.grow_vocabulary(vocab.limit(0), more)
    assert sorted((r.idx, r.activity) for r in fresh.collect()) == [(0, "A"), (1, "aa"), (2, "c")]


def test_newest_publish_is_read_by_its_id(spark, tmp_path):
    """The documents of earlier publishes are not read: the newest id reaches the scan as a literal."""
    kind = config.INVENTORY_EVENT_TYPE
    rows = [(i, p, kind, f'[{{"sku": "s{p}", "qty": {i}}}]') for i in (1, 2, 7) for p in range(2)] + [(9, 0, "other", "[]")]
    path = str(tmp_path / "events")
    spark.createDataFrame(rows, "id long, part long, type string, event string").write.parquet(path)
    events = spark.read.parquet(path)
    stock = inventory.inventory_from_events(events)
    assert sorted(map(tuple, stock.collect())) == [("s0", 7), ("s1", 7)]
    assert "EqualTo(id,7)" in stock._jdf.queryExecution().executedPlan().toString()
    none = spark.createDataFrame([(None, 0, kind, '[{"sku": "n", "qty": 3}]')], events.schema)
    assert [tuple(r) for r in inventory.inventory_from_events(events.unionByName(none)).collect()] == [("n", 3)]
    assert inventory.inventory_from_events(events.limit(0)).count() == 0


def test_broken_replies_are_kept_and_counted(spark, tmp_path):
    good = ['{"a": {"stock_level": 3}, "b": {"stock_level": 0}}', '{"c": {"stock_level": 5}}']
    reply = spark.createDataFrame([(good[0],), ('{"x": {"stock_le',), (good[1],)], "reply string")
    stock, broken = inventory.read_replies(reply, str(tmp_path / "quarantine"))
    assert sorted(map(tuple, stock.collect())) == [("a", 3), ("c", 5)] and broken == 1
    assert [r.reply for r in spark.read.parquet(str(tmp_path / "quarantine")).collect()] == ['{"x": {"stock_le']
    assert inventory.read_replies(reply.limit(0), str(tmp_path / "quarantine"))[1] == 0
