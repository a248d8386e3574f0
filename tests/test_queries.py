"""Every registered query against its SQL, and the matrix of variants that must have one."""

import pytest

from tests.oracle import compare
from tidemark.plans import checks, loads, registry, syncs  # noqa: F401


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, sf_dir, name):
    compare(registry.QUERIES[name](spark, sf_dir), registry.ORACLE_SQL[name], sf_dir)


def test_variants_are_covered():
    from tidemark.operators import delta

    names = " ".join(registry.QUERIES)
    for kind in delta.KINDS:
        assert f"_{kind.lower()}" in names
    for mode in ("cdc_delete", "cdc_image", "cdc_keys", "portions_histogram", "portions_width", "portions_size", "portions_time", "portions_fiscal", "portions_list", "publish_parquet", "publish_table", "apply_insert", "apply_upsert", "apply_merge", "snapshot_merge"):
        assert mode in names
    for kind in delta.LOAD_TYPES:
        assert delta.load_plan(kind)


def test_entry(spark):
    import __spark_entry__

    assert set(__spark_entry__.entry(spark).columns) == {"_op", "n", "price"}
