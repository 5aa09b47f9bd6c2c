import hashlib

import pytest
from llm_cases import EDGE, edge, empty, table

from martlake.llm.dedup_exact import dedup_report, drop_exact_duplicates


def brute(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(d, keep, len(ids), d == keep, hashlib.sha256(t.encode()).hexdigest()) for d in ids]
    return sorted(out, key=str)


HOT = [(i, "hot text" if i % 3 else f"text {i // 6}") for i in range(600)]


@pytest.mark.parametrize("support", [0.001, 0.2, 1.0])
@pytest.mark.parametrize("rows", [EDGE, HOT], ids=["edge", "hot"])
def test_report(spark, rows, support):
    got = [tuple(r) for r in dedup_report(table(spark, rows).repartition(5), support=support).collect()]
    assert sorted(got, key=str) == brute(rows)


@pytest.mark.parametrize("rows", [EDGE, HOT], ids=["edge", "hot"])
def test_drop(spark, rows):
    docs = table(spark, rows).repartition(5)
    out = drop_exact_duplicates(docs, support=0.1)
    assert out.columns == docs.columns
    want = {(k[1], k[4]) for k in brute(rows)}
    got = [(r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in out.collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_empty(spark):
    assert dedup_report(empty(spark)).collect() == []
    assert drop_exact_duplicates(empty(spark)).collect() == []


def test_no_python_in_the_plans(spark, monkeypatch):
    from pyspark.sql import DataFrame
    from pyspark.sql.readwriter import DataFrameWriter
    plans, write = [], DataFrameWriter.parquet

    def seen(self, path, *a, **b):
        plans.append(self._df)
        return write(self, path, *a, **b)
    monkeypatch.setattr(DataFrameWriter, "parquet", seen)
    plans += [dedup_report(edge(spark)), drop_exact_duplicates(edge(spark))]
    assert len(plans) == 3 and all(isinstance(p, DataFrame) for p in plans)
    for p in plans:
        plan = p._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
