"""Classification rules, validity window, tags; cluster sizing helper."""

import datetime as dt

from riskpipe.operators import classify as K
from riskpipe.session import cluster_settings


def _df(spark):
    rows = [(f"user{i}@example.com", "F" if i % 2 else "M", "Colorado" if i % 3 else "Utah", i, f"ID{i}")
            for i in range(40)]
    return spark.createDataFrame(rows, "contact string, insured_sex string, customer_state string, age int, "
                                       "policy_number string")


def test_rules(spark):
    got = {r.column_name: (r.semantic_category, r.privacy_category, r.confidence)
           for r in K.classify(_df(spark), "t").collect()}
    assert got["contact"] == ("EMAIL", "IDENTIFIER", "MEDIUM")          # value rule only
    assert got["insured_sex"] == ("GENDER", "QUASI_IDENTIFIER", "HIGH")  # value and name agree
    assert got["customer_state"] == ("US_STATE_OR_PROVINCE", "QUASI_IDENTIFIER", "HIGH")
    assert got["age"] == ("AGE", "QUASI_IDENTIFIER", "MEDIUM")            # name rule only
    assert got["policy_number"][0] == "IDENTIFIER"


def test_validity_window_and_tags(spark, scratch):
    path = f"file:{scratch}/classification"
    df = _df(spark)
    assert K.classify_and_store(spark, df, "t", path)            # first run
    assert not K.classify_and_store(spark, df, "t", path)        # still valid (30 days)
    assert K.classify_and_store(spark, df, "t", path, force=True)
    later = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(days=31)
    assert K.needs_classification(spark, path, "t", now=later)
    young = K.ClassificationProfile(minimum_object_age_for_classification_days=2)
    assert not K.needs_classification(spark, path, "other", young, object_created=dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    res = K.classification_result(spark.read.parquet(path), "t")
    tags = K.tags(res, "t")
    assert {(r.column_name, r.tag_name) for r in tags.collect()} >= {("contact", "SEMANTIC_CATEGORY"),
                                                                    ("contact", "PRIVACY_CATEGORY")}
    tag_rows = [(r.column_name, r.tag_name, r.tag_value) for r in tags.dropDuplicates(["column_name", "tag_name"]).collect()]
    tagged = K.apply_tags_as_metadata(df, tag_rows)
    assert tagged.schema["contact"].metadata["tags"]["semantic_category"] == "EMAIL"


def test_cluster_settings():
    s = cluster_settings(100 * 1024 ** 4, executors=1000, cores_per_executor=4)
    assert int(s["spark.sql.shuffle.partitions"]) == 25 * 1024     # a quarter of 100 TB in 1 GB partitions
    assert int(s["spark.sql.files.maxPartitionBytes"]) == 512 * 1024 ** 2
    small = cluster_settings(1024 ** 3, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 80           # at least 2 per core


def test_schema_profile_and_stored_tags(spark, scratch):
    path = f"file:{scratch}/results"
    other = _df(spark).select("age", "insured_sex")
    p = K.SchemaProfile(path)
    assert p.run(spark, {"t": _df(spark), "u": other}) == ["t", "u"]
    assert p.run(spark, {"t": _df(spark), "u": other}) == []          # still valid
    tags = {(r.table_name, r.column_name, r.tag_name): r.tag_value for r in K.stored_tags(spark, path).collect()}
    assert tags["u", "age", "SEMANTIC_CATEGORY"] == "AGE" and tags["t", "contact", "PRIVACY_CATEGORY"] == "IDENTIFIER"
    assert p.run(spark, {"u": other}, force=True) == ["u"] and K.stored_tags(spark, path).count() == len(tags)
    p.unset()
    assert p.run(spark, {"t": _df(spark)}, force=True) == []
    quiet = K.SchemaProfile(f"file:{scratch}/quiet", K.ClassificationProfile(auto_tag=False))
    assert quiet.run(spark, {"u": other}) == ["u"] and K.stored_tags(spark, quiet.results_path).isEmpty()


def test_derived_columns_are_not_ages(spark):
    df = spark.createDataFrame([("Senior Driver", 5, 70)], "age_category string, age_risk_score int, age int")
    got = {r.column_name: r.semantic_category for r in K.classify(df, "t").collect()}
    assert got == {"age_category": None, "age_risk_score": None, "age": "AGE"}
