import re

import __spark_entry__ as contract


def test_every_operator_is_registered_once():
    numbers = [int(m[1]) for n in contract.queries() if (m := re.match(r"op(\d+)_", n))]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in contract.queries()
