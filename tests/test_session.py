import importlib
import sys

from pyspark.sql import functions as F

from newsledger.session import ship_packages


def package(folder, name, **modules):
    (folder / name).mkdir()
    for module, source in {"__init__": "", **modules}.items():
        (folder / name / f"{module}.py").write_text(source)
    return folder / name


def test_sets_of_packages_shipped_one_after_another(spark, tmp_path):
    one = package(tmp_path, "shipped_one", a="VALUE = 1\n")
    two = package(tmp_path, "shipped_two", a="VALUE = 2\n")
    files = set(spark.sparkContext.listFiles)
    ship_packages(spark, one, two)
    ship_packages(spark, one)
    ship_packages(spark, two, one)
    assert len(set(spark.sparkContext.listFiles) - files) == 2  # nothing is sent twice
    (one / "b.py").write_text("VALUE = 3\n")
    ship_packages(spark, one)  # other contents under the same name of a package
    assert len(set(spark.sparkContext.listFiles) - files) == 3

    def values(batches):
        for batch in batches:
            batch["v"] = importlib.import_module("shipped_one.a").VALUE + importlib.import_module("shipped_two.a").VALUE
            yield batch

    assert [r.v for r in spark.range(1).select(F.lit(0).alias("v")).mapInPandas(values, "v long").collect()] == [3]
    assert spark.range(100).filter("id > 50").count() == 49  # tasks that follow still run
    sys.modules.pop("shipped_one", None)
