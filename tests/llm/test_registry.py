import re

import __spark_entry__ as E
from vaultline.llm import registry


def test_every_operator_has_one_query():
    names = registry.queries()
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names if n != "pipeline") == list(range(1, 14))
    assert "pipeline" in names and set(registry.oracle_sql()) <= set(names)
    assert set(names) <= set(E.queries()) and set(registry.oracle_sql()) <= set(E.oracle_sql())
