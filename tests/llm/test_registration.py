import re

import __spark_entry__
import corpus_pipeline
from reelsieve.llm import queries


def test_all_operators_and_the_pipeline_are_registered():
    names = list(__spark_entry__.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5
    assert set(queries.oracle_sql()) <= set(queries.queries())
    assert all(re.match(r"op\d+_\w+$", n) for n in queries.queries())
