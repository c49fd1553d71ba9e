"""The Spark views and their SQL twins (used by every oracle) must hold the same rows."""

import pytest

from conftest import SF_SMALL
from oracle_harness import compare

from bramble.sources.fixtures import with_views
from bramble.sources.tables import Tables

VIEWS = ["sales", "product_details", "product_hierarchy", "product_prices", "clicks", "users",
         "event_identifier", "page_hierarchy", "campaign_identifier", "plans", "subscriptions"]


@pytest.mark.parametrize("name", VIEWS)
def test_view_matches_sql(spark, duck_small, name):
    df = getattr(Tables(spark, SF_SMALL).fixtures, name)
    cols = df.columns
    rel = duck_small.execute(with_views(f"SELECT {', '.join(cols)} FROM {name}"))
    dcols = [d[0] for d in rel.description]
    ok, msg = compare([r.asDict() for r in df.collect()], cols,
                      [dict(zip(dcols, r)) for r in rel.fetchall()], dcols)
    assert ok, msg
