import json

from newsledger import schema as S
from newsledger.operators.items import to_items
from newsledger.operators.quality import ContractCounts, contract_check
from newsledger.plans.store import write_items
from newsledger.sources.item_table import ItemTable


def analyst():
    return lambda texts: [json.dumps({"summary": "s" * (400 if "t1" in t else 4)}) for t in texts]


def vectors():
    return lambda texts: [[1.0, 2.0] * (S.EMBEDDING_DIM // 2) for _ in texts]


def entries(spark, ids):
    rows = [(f"t{i}", f"https://e.org/{i}", "long body " * 40 * (i % 2) + "身分證 A123456789", "s") for i in ids]
    return to_items(spark.createDataFrame(rows, "title string, url string, body string, source string"))


def as_dict(rows):
    return {r.rule: (r.n_rows, r.n_failed) for r in rows.collect()}


def test_counts_of_the_writing_job_equal_the_check(spark, tmp_path):
    for policy in ("mask", "quarantine"):
        table, counts = ItemTable(spark, f"{tmp_path}/{policy}"), ContractCounts()
        write_items(table, entries(spark, range(9)), analyst, vectors, policy=policy, counts=counts)
        assert as_dict(counts.rows(spark)) == as_dict(contract_check(table.read()))
    assert as_dict(counts.rows(spark))["pii_free"] == (9, 9)


def test_an_update_counts_the_rows_it_writes(spark, tmp_path):
    table = ItemTable(spark, str(tmp_path / "t"))
    write_items(table, entries(spark, range(20)), analyst, vectors, policy="mask")
    known, counts = [f"https://e.org/{i}" for i in range(18, 20)], ContractCounts()
    write_items(table, entries(spark, range(18, 24)), analyst, vectors, policy="mask", counts=counts)
    rows = table.rows()
    rewritten = [r.part for r in rows.filter(rows.url.isin(known)).select("part").distinct().collect()]
    written = rows.filter(rows.part.isin(rewritten) | rows.title.isin([f"t{i}" for i in range(20, 24)]))
    assert as_dict(counts.rows(spark)) == as_dict(contract_check(written))


def test_nothing_written(spark, tmp_path):
    table, counts = ItemTable(spark, str(tmp_path / "t")), ContractCounts()
    write_items(table, entries(spark, range(1)).limit(0), analyst, vectors, counts=counts)
    assert set(as_dict(counts.rows(spark)).values()) == {(0, 0)}
    assert set(as_dict(ContractCounts().rows(spark)).values()) == {(0, 0)}
