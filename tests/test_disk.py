"""What the layered job leaves on disk while it runs."""

import time

import pytest
from pyspark.sql import functions as F

from helpers import rows
from granary.operators import refine
from granary.operators.shared_store import RELEASE, shuffles_released
from granary.plans import landed
from granary.plans.layers import run_all
from granary.sources import files
from granary.sources.star import Star
from test_layers import lake  # noqa: F401

SF = "/root/testdata/sf0.001"


def shuffle_files(spark):
    held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {held.apply(i).getName() for i in range(held.size()) if held.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_with_their_query_and_the_setting_is_put_back(spark, conf, tmp_path):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    keyed = spark.range(2000).withColumn("k", F.col("id") % 7)
    wide = keyed.join(keyed.groupBy("k").count(), "k")
    files.write_table(wide, str(tmp_path / "outside"), ["id"])
    before, was = shuffle_files(spark), spark.conf.get(RELEASE, None)
    with pytest.raises(ValueError), shuffles_released(spark):
        files.write_table(wide, str(tmp_path / "inside"), ["id"])
        raise ValueError
    assert spark.conf.get(RELEASE, None) == was and before
    for _ in range(50):  # files are removed in the background
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.2)
    assert shuffle_files(spark) <= before
    assert rows(spark.read.parquet(str(tmp_path / "inside"))) == rows(spark.read.parquet(str(tmp_path / "outside"))) == rows(wide)


def test_wide_rows_are_stored_where_they_are_each_file_in_order(spark, tmp_path):
    gifts = spark.range(6000).selectExpr("id % 30 as day", "id as key").repartition(3, "key")
    files.write_table(gifts, str(tmp_path / "wide"), ["day", "key"], dealt=False)
    stored = spark.read.parquet(str(tmp_path / "wide")).select("*", F.col("_metadata.file_path").alias("file")).collect()
    assert len(stored) == 6000 and len({r["file"] for r in stored}) == 3
    by_file = {}
    for r in stored:
        by_file.setdefault(r["file"], []).append((r["day"], r["key"]))
    assert all(found == sorted(found) and len({day for day, _ in found}) == 30 for found in by_file.values())


def test_raw_text_lands_packed_in_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landed, "ROWS_PER_FILE", 1000)
    star = Star(spark, SF)
    landed.land_csv(star.camps().coalesce(1), "camp_id string, camp_name string, city string, location string", str(tmp_path / "camps.csv"))
    landed.land_csv(star.raw_donations().coalesce(1), "donation_id string, donor_id string, blood_group string", str(tmp_path / "donations.csv"))
    landed.land_events(star.events(), str(tmp_path / "landing"))
    names = {p.name for folder in ("camps.csv", "donations.csv", "landing") for p in (tmp_path / folder).iterdir() if p.name.startswith("part-")}
    assert names and all(n.endswith((".csv.gz", ".json.gz")) for n in names)
    text = files.read_csv(spark, str(tmp_path / "donations.csv"), "donation_id string, donor_id string, blood_group string", multi_line=False)
    wanted = star.raw_donations().select(F.col("donation_id").cast("string"), F.col("donor_id").cast("string"), "blood_group")
    assert rows(text) == rows(wanted) and max(r["count"] for r in text.groupBy("_metadata.file_path").count().collect()) <= 1000
    assert spark.read.schema(star.events().schema).json(str(tmp_path / "landing")).count() == star.events().count()


def test_the_whole_job_keeps_no_shuffle_files(spark, lake, policy):  # noqa: F811
    before = shuffle_files(spark)
    run_all(spark, lake, policy)
    for _ in range(50):
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.2)
    assert shuffle_files(spark) <= before


def test_lookups_can_be_stored_one_by_one(spark, lake, policy, tmp_path):  # noqa: F811
    star, seen = Star(spark, SF), []
    facts, dimensions = star.donations(), (star.donors(), star.banks(), star.camps(), star.inventory())

    def stored(df):
        seen.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter, ((camp_id"))
        files.write_table(df, str(tmp_path / f"step{len(seen)}"))
        return spark.read.parquet(str(tmp_path / f"step{len(seen)}"))

    assert rows(refine.enrich(facts, *dimensions, between=stored)) == rows(refine.enrich(facts, *dimensions))
    assert seen == [1, 0]  # after the camp, after the bank with its stock
    run_all(spark, lake, policy)
    assert not any((tmp_path / "passing").glob("*"))
    assert spark.read.parquet(lake.silver("enriched_donations")).count() == spark.read.parquet(lake.silver("donations")).count() > 0
