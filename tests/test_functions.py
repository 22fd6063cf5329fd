"""Column expressions and argument parsing."""

from pyspark.sql import functions as F

from copyaudit.functions import paths, routing, statements
from copyaudit.sources.arguments import parameter_problems, partition_map_frame, token_frame


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def test_strip_one_trailing_slash(spark):
    assert one(spark, paths.strip_one_slash(F.lit("abfs://c@a/data/"))) == "abfs://c@a/data"
    assert one(spark, paths.strip_one_slash(F.lit("abfs://c@a/data"))) == "abfs://c@a/data"
    assert one(spark, paths.strip_one_slash(F.lit("abfs://c@a/data//"))) == "abfs://c@a/data/"


def test_target_path_never_holds_two_schemes(spark):
    src = F.lit("hdfs://nn:8020/wh/db/t/ods=1")
    assert one(spark, paths.target_partition_path(F.lit("abfs://c@a/data/"), src)) == "abfs://c@a/data/wh/db/t/ods=1"
    assert one(spark, paths.target_partition_path(F.lit("abfs://c@a/data"), F.lit("/wh/db/t/ods=1"))) \
        == "abfs://c@a/data/wh/db/t/ods=1"


def test_source_partition_path(spark):
    assert one(spark, paths.source_partition_path(F.lit("/wh"), F.lit("db"), F.lit("t"), F.lit("ods"),
                                                  F.lit("2022-03-01"))) == "/wh/db/t/ods=2022-03-01"


def test_control_and_failure_names(spark):
    assert one(spark, paths.control_name(F.lit("db"), F.lit("t"), F.lit("p"), F.lit(True))) == "db_t_p.match"
    assert one(spark, paths.control_name(F.lit("db"), F.lit("t"), F.lit("p"), F.lit(False))) == "db_t_p.nonmatch"
    assert one(spark, paths.two_way_control_dir(F.lit("x/"), F.lit("s"), F.lit("c"), F.lit("db"))) == "x/s/c/db"
    assert one(spark, paths.three_way_control_dir(F.lit("/ctl"))) == "/ctl/global"
    assert one(spark, paths.registration_failure_path(F.lit("/st"), F.lit("s"), F.lit("c"), F.lit("t"),
                                                      F.lit("p"))) == "/st/MetaUpdate_s_c_t_p_failure.csv"


def test_routing(spark):
    assert one(spark, routing.partition_column_case(F.lit("SRI_Open"))) == "ods"
    assert one(spark, routing.partition_column_case(F.lit("storage"))) == "vds"
    assert one(spark, routing.partition_column_case(F.lit("other"))) == "None"
    assert one(spark, routing.table_name(F.lit("orders|T"))) == "orders"
    assert one(spark, routing.table_type(F.lit("orders|T"))) == "t"
    assert one(spark, routing.table_type(F.lit("nosuffix"))) == "nosuffix"
    assert one(spark, routing.data_format(F.lit("my_Storage_db"))) == "avro"
    assert one(spark, routing.data_format(F.lit("sri_open"))) == "orc"
    args = (F.lit("/o"), F.lit("/n"), F.lit("/s"))
    assert one(spark, routing.staging_root(F.lit("t"), F.lit("sri_non_open"), *args)) == "/n"
    assert one(spark, routing.staging_root(F.lit("t"), F.lit("other"), *args)) == ""
    assert one(spark, routing.staging_root(F.lit("p"), F.lit("sri_open"), *args)) == "Plain"
    assert one(spark, routing.staging_root(F.lit("x"), F.lit("sri_open"), *args)) == ""


def test_token_frame_drops_empty_tokens(spark):
    rows = token_frame(spark, "a,,b,", "db").collect()
    assert [r["db"] for r in rows] == ["a", "b"]


def test_partition_map(spark):
    lookup, problems = partition_map_frame(spark, " Sri_Open:ods,storage:vds,storage:x2,broken,a:b:c")
    got = {r["db_key"]: r["partition_col"] for r in lookup.collect()}
    assert got == {"sri_open": "ods", "storage": "x2"}        # key trimmed + lowered, last wins
    assert sorted(r["pair"] for r in problems.collect()) == ["a:b:c", "broken"]


def test_statement_split_keeps_multi_column_specs(spark):
    batch = "[ALTER TABLE d.t ADD PARTITION (a='1', b='2'),\nALTER TABLE d.u ADD PARTITION (a='3');]"
    df = spark.createDataFrame([(batch,)], "batch string")
    rows = (df.select(F.posexplode(statements.split_batch("batch")).alias("i", "raw"))
            .select("i", statements.normalise_statement("raw").alias("s")).orderBy("i").collect())
    assert [r["s"] for r in rows] == ["ALTER TABLE d.t ADD PARTITION (a='1', b='2')",
                                      "ALTER TABLE d.u ADD PARTITION (a='3')"]


def test_statement_table_and_allow_list(spark):
    assert one(spark, statements.statement_table(F.lit("ALTER TABLE d.t ADD"))) == "d.t"
    assert one(spark, statements.statement_table(F.lit("DROP x"))) == "unknown"
    assert one(spark, statements.is_add_partition(F.lit("alter table d.t add if not exists partition (a=1)")))
    assert not one(spark, statements.is_add_partition(F.lit("DROP TABLE d.t")))


def test_parameter_problems(spark):
    params = spark.createDataFrame([("r1", "db1", None, "m"), ("r2", "", "t", "m")],
                                   "run_id string, databases string, tables string, partition_map string")
    got = sorted((r["run_id"], r["parameter"]) for r in
                 parameter_problems(params, ["databases", "tables", "partition_map", "result_db"]).collect())
    assert got == [("r1", "result_db"), ("r1", "tables"), ("r2", "databases"), ("r2", "result_db")]


def test_union_all_keeps_every_row(spark):
    from copyaudit.sources.copies import union_all
    frames = [spark.range(i, i + 1).selectExpr("id", "id * 2 AS twice") for i in range(13)]
    got = sorted(tuple(r) for r in union_all(frames).collect())
    assert got == [(i, 2 * i) for i in range(13)]
