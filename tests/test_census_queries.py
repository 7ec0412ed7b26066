"""The census queries over a few places whose answers are known."""

import pytest

from tallyframe.plans import catalogue


@pytest.fixture(scope="module")
def few(spark, tmp_path_factory):
    """Nations 3, 4, 13 and 22: votes at 3 (table 2) and 13 (table 5), none at 4; 22 has no tables."""
    d = str(tmp_path_factory.mktemp("few"))
    nations = spark.createDataFrame([(k, f"n{k}", k % 5) for k in (3, 4, 13, 22)], "n_nationkey int, n_name string, n_regionkey int")
    customers = spark.createDataFrame([(2, 3), (3, 3), (4, 4), (61, 4), (5, 13)], "c_custkey bigint, c_nationkey int")
    orders = spark.createDataFrame([(1, 2), (2, 2), (3, 5)], "o_orderkey bigint, o_custkey bigint")
    for name, df in (("nation", nations), ("customer", customers), ("orders", orders)):
        df.write.parquet(f"{d}/{name}.parquet")
    return d


def test_only_places_without_any_votes_are_reported(spark, few):
    got = catalogue.queries()["places_without_votes"](spark, few).collect()
    assert [(r.dep, r.muni, r.total, r.mesas) for r in got] == [(4, 4, 20, 2)]


def test_the_census_has_every_place_with_tables(spark, few):
    row = catalogue.queries()["census_summary"](spark, few).first()
    assert (row.puestos, row.habilitados, row.mesas) == (3, 50, 5)
    got = catalogue.queries()["census_participation"](spark, few).collect()
    assert {r.muni: (r.votos, r.habilitados, r.bandera) for r in got} == {3: (2, 20, ""), 13: (1, 10, "")}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_no_place_of_the_drivers_tables_is_without_votes(spark, sf):
    assert catalogue.queries()["places_without_votes"](spark, f"/root/testdata/{sf}").count() == 0
    assert catalogue.queries()["census_summary"](spark, f"/root/testdata/{sf}").first().puestos == 25
