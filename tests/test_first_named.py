"""The first rows of a dataset with their customers' names."""

import pytest

from lendscope.plans.advisor import first_named


@pytest.mark.parametrize("missing", [0, 1, 7, 20])
def test_first_rows_are_those_of_the_whole_join(spark, missing):
    loans = spark.range(20).selectExpr("id AS customer_id", "id * 7 % 5 AS _falling", "nullif(id, 9) AS loan_id")
    names = spark.range(missing, 20).selectExpr("id AS customer_id", "concat('N', id) AS company_name")
    order = ["_falling", "loan_id"]
    first = lambda df: df.orderBy(*order).limit(3).collect()
    found = first_named(loans, names, order, 3)
    assert first(found.select(*order, "company_name")) == first(loans.join(names, "customer_id").select(*order, "company_name"))
    if not missing:  # only rows of the first keys meet the names
        assert found.count() == 6
