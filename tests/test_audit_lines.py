"""Id lists hold every order line of every customer."""

from __future__ import annotations

import duckdb
import pytest

from ledgermend.checks.registry import QUERIES
from ledgermend.checks.roles import Tables, audit_lines

LIST = "array_to_string(list_transform(list_sort(list({}), 'ASC', 'NULLS LAST'), lambda x: coalesce(x, 'NULL')), ',')"


@pytest.fixture(scope="module")
def whole(data_root):
    """Per customer, the lists of all lines: with repeats, and distinct."""
    where = data_root / "sf0.01"
    columns = {"reference_number": "CAST(l_suppkey AS VARCHAR)", "contract_id": "CAST(nullif(l_linenumber, 7) AS VARCHAR)"}
    lists = [LIST.format(f"{kind}{column}") for kind in ("", "DISTINCT ") for column in columns.values()]
    rows = duckdb.sql(
        f"""SELECT CAST(o_custkey AS VARCHAR), {", ".join(lists)}
        FROM '{where}/lineitem.parquet' JOIN '{where}/orders.parquet' ON l_orderkey = o_orderkey GROUP BY ALL"""
    ).fetchall()
    return {row[0]: (row[1:3], row[3:5]) for row in rows}


def test_audit_lines_are_all_order_lines(spark, data_root):
    source = Tables(spark, str(data_root / "sf0.01"))
    lines = audit_lines(source)
    assert lines.count() == source.lineitem.count()
    assert lines.select("customer_id").distinct().count() == source.orders.select("o_custkey").distinct().count()


@pytest.mark.parametrize(("name", "kind"), [("id_list_text", 0), ("id_list_distinct_text", 1), ("attach_audit_refs", 1)])
def test_lists_of_all_lines(name, kind, spark, data_root, whole):
    found = QUERIES[name](spark, str(data_root / "sf0.01")).select("customer_id", "reference_number", "contract_id").collect()
    assert len(found) > 0 and any(row.customer_id.endswith("3") for row in found)
    if name != "attach_audit_refs":
        assert {row.customer_id for row in found} == set(whole)
    for row in found:
        assert (row.reference_number, row.contract_id) == whole[row.customer_id][kind]
