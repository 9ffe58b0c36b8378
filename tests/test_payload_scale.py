"""Payloads at size: work is spread by rows, cheap tests are made once, and none of them loses a binary."""

from callscope.functions import payload, text as tx
from callscope.plans.jobs import clean_payloads
from workload import views


def test_few_row_groups_are_spread(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(4000).selectExpr("id", "sha2(string(id), 256) AS v").repartition(1).write.parquet(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        table = spark.read.parquet(path)
        assert table.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        held = views.spread(table).selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(held) >= spark.sparkContext.defaultParallelism and sum(r["count"] for r in held) == 4000


def test_lower_case_is_taken_once():
    assert tx.sql_may_hold_secret("t").count("lower(") == 1


def test_padded_binary_of_512_bytes(spark):
    """Two of its bytes are padding, so its run is shorter than the limit."""
    rows = spark.createDataFrame([(1, '{"a":"%s==","b":"%s"}' % ("Q" * 510, "Q" * 511))], "id int, payload string")
    got = clean_payloads(rows, json=["payload"]).first().payload
    assert got == '{"a":"[base64 removed]","b":"%s"}' % ("Q" * 511)


def test_keys_are_found_after_braces_and_commas_only(spark):
    given = '{"x":"\\"blob\\":\\"v\\"","blob":"QQ","n":[{"blob":"QQ","Pass-Word":"p","data":"QQ","type":"image"}],"password":null,"token":1}'
    got = clean_payloads(spark.createDataFrame([(given,)], "payload string"), json=["payload"]).first().payload
    assert got == ('{"blob":"[binary removed]","n":[{"Pass-Word":"[redacted:sensitive-field]","blob":"[binary removed]","data":"[binary removed]",'
                   '"type":"image"}],"password":null,"token":"[redacted:sensitive-field]","x":"\\"blob\\":\\"v\\""}')


def test_what_follows_a_value_sends_it_to_the_recursion(spark):
    texts = ['{"b":1,"a":"x y"}', '{"b": 1}', '{"b":1}x', '{"b": 1}x', '{"a":"\\u0041"}123456', '{"b":1}{}', ' {"a":"]"}]']
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    shown = payload.with_native_preview(rows, "out", "v").orderBy("i")
    assert [r.out for r in shown.collect()] == ['{"a":"x y","b":1}', '{"b":1}', None, None, None, None, None]
    plan = payload._with_canonical(rows, "out", "v", "a", None, None, False)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[ \\t\\r\\n]+") <= 2
