"""The driver's contract for the queries of this subpackage."""

import __spark_entry__ as entry


def test_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)
