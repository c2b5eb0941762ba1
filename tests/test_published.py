import pytest
from pyspark.sql import functions as F

from tariffa.sources import published


def tables(spark, n, odd=0):
    codes = spark.range(3).select(F.col("id").alias("code_id"), F.lit("c").alias("code"))
    fact = spark.range(n).select((F.col("id") % 3 + F.when(F.col("id") < odd, 100).otherwise(0)).alias("code_id"), F.col("id").cast("double").alias("gross"))
    return {"codes": codes, "fact": fact}


def checks(found):
    return {"codes: code_id repeated": published.repeated(found["codes"], "code_id"), "fact: code_id unknown": published.orphans(found["fact"], found["codes"], "code_id")}


def test_publish(spark, tmp_path):
    root = str(tmp_path / "store")
    with pytest.raises(ValueError):
        published.read(spark, root)
    plans = published.publish(spark, root, tables(spark, 10), checks, {"fact": ["code_id"]}, dry_run=True)
    assert set(plans) == {"codes", "fact"} and "Exchange" in plans["fact"] and not (tmp_path / "store").exists()
    first = published.publish(spark, root, tables(spark, 10), checks, {"fact": ["code_id", "gross"]})
    before = published.read(spark, root)
    with pytest.raises(published.Refused, match=r"fact: code_id unknown \(2 rows\)"):
        published.publish(spark, root, tables(spark, 20, odd=2), checks)
    assert published.builds(spark, root) == [first] and published.read(spark, root)["fact"].count() == 10
    second = published.publish(spark, root, tables(spark, 30), checks)
    # who began with the old build reads it to its end; who begins now reads the new one
    assert (before["fact"].count(), published.read(spark, root)["fact"].count(), published.read(spark, root, first)["fact"].count()) == (10, 30, 10)
    assert published.drop_old(spark, root, keep=1) == [first] and published.builds(spark, root) == [second] and published.drop_old(spark, root, keep=0) == []
    assert published.read(spark, root)["codes"].count() == 3
    with pytest.raises(ValueError):
        published.read(spark, root, first)


def test_broken_off_builds_are_not_read(spark, tmp_path):
    root = str(tmp_path / "store")
    first = published.publish(spark, root, tables(spark, 5))
    broken = tables(spark, 5) | {"bad": spark.range(1).select(F.raise_error(F.lit("gone")).alias("x"))}
    with pytest.raises(Exception, match="gone"):
        published.publish(spark, root, broken)
    assert published.builds(spark, root) == [first] and set(published.read(spark, root)) == {"codes", "fact"}


def test_empty_tables_and_null_keys(spark, tmp_path):
    root = str(tmp_path / "store")
    given = tables(spark, 0)
    published.publish(spark, root, given, checks)
    assert published.read(spark, root)["fact"].count() == 0
    given["fact"] = spark.createDataFrame([(None, 1.0), (1, 2.0)], "code_id long, gross double")
    published.publish(spark, root, given, checks)
    assert published.read(spark, root)["fact"].count() == 2


def test_a_whole_store(spark, tmp_path):
    from tariffa.plans import owners

    root = str(tmp_path / "store")
    made = vars(owners.lake_store(spark, "/root/testdata/sf0.001"))
    published.publish(spark, root, made, published.store_checks, {"fact": ["code_id", "file_id"]})
    got = published.read(spark, root)
    assert set(got) == set(made) and got["fact"].count() == made["fact"].count() > 0
    with pytest.raises(published.Refused, match="fact: payer_id unknown.*|dim_code: code_id repeated"):
        published.publish(spark, root, made | {"dim_code": made["dim_code"].unionAll(made["dim_code"]), "dim_payer": made["dim_payer"].limit(0)}, published.store_checks)
    assert len(published.builds(spark, root)) == 1
