"""Every registered query of the reference's operators runs; those with SQL return the same rows as DuckDB."""

import pytest

from lociframe.plans import registry

from .compare import rows

registry.load()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, sf_dir, name):
    got = registry.QUERIES[name](spark, sf_dir).toPandas()
    if name in registry.ORACLES:
        want = duck.execute(registry.ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got.columns)
