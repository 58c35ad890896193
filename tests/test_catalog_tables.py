"""The production input interface: the same jobs over catalog tables."""

from conftest import SF_SMALL

from browsekit.config import RunWindow
from browsekit.operators import features
from browsekit.sources.fixtures import CatalogTables, FixtureTables

INPUTS = ("variants", "skus", "active_products", "category_map", "email_uuids", "orders_fact",
          "inventory_events", "inventory_reply", "score_history", "send_params", "page_views")


def test_send_features_from_catalog_tables(spark):
    fx = FixtureTables(spark, SF_SMALL)
    names = {}
    for name in INPUTS:
        view = f"bk_{name}"
        getattr(fx, name)().createOrReplaceTempView(view)
        names[name] = view
    names["score_log"] = names.pop("score_history")
    cat = CatalogTables(spark, names)
    win = RunWindow()
    a = sorted(map(tuple, features.send_features(cat, win).collect()))
    b = sorted(map(tuple, features.send_features(fx, win).collect()))
    assert a == b and len(a) > 0
