import os
import re
from pathlib import Path

import __spark_entry__ as contract
from conftest import ROOT

from workload.oracles import oracles
from workload.queries import registered


def test_entry_answers_every_question(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["query_id", "question", "answer"] and frame.count() == 40


def test_every_oracle_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(oracles()) == set(registered()) <= set(contract.queries())


def test_package_keeps_to_distributed_operations():
    banned = re.compile(r"crossJoin|localCheckpoint|\.rdd\b|F\.udf\(|\.cache\(\)|\.persist\(")
    for path in Path(ROOT, "gleaner").rglob("*.py"):
        assert not banned.search(path.read_text()), path


def test_repository_is_small():
    size = sum(os.path.getsize(p) for p in Path(ROOT).rglob("*") if p.is_file())
    assert size < 30 << 20
