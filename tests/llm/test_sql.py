"""The queries are run, and compared with their SQL, by tests/test_oracles.py as long as this package is present."""

from reportgrid.llm.queries import QUERIES, SQL


def test_every_operator_has_a_query():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(SQL) <= set(QUERIES)
