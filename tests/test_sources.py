import pytest
from pyspark.sql import functions as F

from aisleflow.sources import readers


def _write(path, text):
    with open(path, "w", newline="") as f:
        f.write(text)


# The two header lines of the items file.
ITEMS_HEADERS = ("i_item_id|i_name|i_category_id|i_category_name|i_price|i_comp_price|i_class_id",
                 "i_item_id|i_item_name|i_category_id|i_category_name|price_1|price_2|quantity")


def test_items_both_headers_crlf(spark, tmp_path):
    rows = "0|item#0000|0|cat#00|53.09|60.10|3\r\n1|item#0001|13|cat#13|1.14|2.00|17\r\n"
    a, b = tmp_path / "a.tbl", tmp_path / "b.tbl"
    _write(a, ITEMS_HEADERS[0] + "\r\n" + rows)
    _write(b, ITEMS_HEADERS[1] + "\r\n" + rows)
    da = readers.read_delimited(spark, str(a), readers.ITEMS_SCHEMA, validate_header=True,
                                aliases=readers.ITEMS_HEADER_ALIASES)
    db = readers.read_delimited(spark, str(b), readers.ITEMS_SCHEMA, validate_header=True,
                                aliases=readers.ITEMS_HEADER_ALIASES)
    assert da.collect() == db.collect()
    r = da.orderBy("i_item_id").collect()
    assert r[0]["i_class_id"] == 3 and r[1]["i_category_name"] == "cat#13"  # no stray \r
    assert r[1]["i_price"] == 1.14


def test_header_mismatch_raises(spark, tmp_path):
    p = tmp_path / "c.tbl"
    _write(p, "x|y\n1|2\n")
    with pytest.raises(ValueError):
        readers.read_delimited(spark, str(p), readers.STORE_SALES_SCHEMA, validate_header=True)


@pytest.mark.parametrize("long_first", [True, False])
def test_swapped_columns_are_read_by_name(spark, tmp_path, long_first):
    """Whichever file is larger, columns go by each file's own header."""
    more = "".join(f"{i}|{i + 1000}|{i + 5}\n" for i in range(3, 300))
    _write(tmp_path / "a.tbl", "ss_transaction_id|ss_customer_id|ss_item_id\n1|10|100\n" + (more if long_first else ""))
    _write(tmp_path / "b.tbl", "ss_customer_id|ss_transaction_id|ss_item_id\n20|2|200\n" + ("" if long_first else "9|8|7\n" * 300))
    (tmp_path / "_SUCCESS").touch()
    (tmp_path / "empty.tbl").touch()
    got = readers.read_delimited(spark, str(tmp_path), readers.STORE_SALES_SCHEMA, validate_header=True)
    rows = {(r[0], r[1], r[2]) for r in got.collect()}
    assert got.columns == readers.STORE_SALES_SCHEMA.fieldNames()
    assert {(1, 10, 100), (2, 20, 200)} <= rows
    _write(tmp_path / "z.tbl", "ss_transaction_id|ss_customer_id|other\n1|2|3\n")
    with pytest.raises(ValueError, match="other"):
        readers.read_delimited(spark, str(tmp_path), readers.STORE_SALES_SCHEMA, validate_header=True)


def test_json_missing_keys_and_corrupt_row(spark, tmp_path):
    p = tmp_path / "clicks.json"
    _write(p, "\n".join([
        '{"wl_id": 1, "wl_customer_id": 7, "wl_item_id": 3, "wl_key1": 5}',
        '{"wl_id": 2, "wl_customer_id": 7}',
        '{"wl_id": 3, "wl_item_id": 4}',
        '{"wl_id": 4, "wl_customer_id": ',
    ]) + "\n")
    df = readers.read_json_lines(spark, str(p), readers.CLICKS_SCHEMA, keep_corrupt=True)
    rows = {r["wl_id"]: r for r in df.collect() if r["wl_id"] is not None}
    assert rows[2]["wl_item_id"] is None and rows[3]["wl_customer_id"] is None
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    c = readers.corrupt_count(df).first()
    assert (c["n_rows"], c["n_corrupt"]) == (4, 1)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_json_field_extraction(spark):
    df = spark.createDataFrame([('{"k": 69}',), ('{"j": 1}',)], "props string")
    out = readers.extract_json_fields(df, "props", {"k": "$.k"}).collect()
    assert [r["k"] for r in out] == ["69", None]


def test_run_log_roundtrip(spark, tmp_path):
    from aisleflow.sources import sinks
    p = str(tmp_path / "runs")
    sinks.log_run(spark, "job_a", {"k": 4, "tol": 0.01, "name": "x"}, {"m": 1.5}, path=p)
    sinks.log_run(spark, "job_b", None, {"m": 2.0}, path=p)
    df = sinks.read_run_log(spark, p)
    assert df.count() == 5
    assert df.filter((F.col("kind") == "metric") & (F.col("job") == "job_a")).first()["value"] == 1.5
    assert df.filter(F.col("name") == "name").first()["value_text"] == "x"


def test_publish_and_drop_view(spark, tmp_path):
    from aisleflow.sources import sinks
    df = spark.createDataFrame([(1, "a")], "k long, v string")
    sinks.publish(df, "af_rules_view", str(tmp_path / "rules"))
    assert spark.sql("SELECT count(*) FROM af_rules_view").first()[0] == 1
    assert sinks.drop_view(spark, "af_rules_view") is True
    assert sinks.drop_view(spark, "af_rules_view") is False


def test_headers_of_many_files_in_one_job(spark, tmp_path):
    """Split and empty files, folders below folders, CRLF and names that need quoting."""
    names = readers.STORE_SALES_SCHEMA.fieldNames()
    orders = ["|".join(names), "|".join(reversed(names))]
    want = {}
    for i in range(36):
        folder = tmp_path / f"part {i % 3}" / "in%ner"
        folder.mkdir(parents=True, exist_ok=True)
        _write(folder / f"f {i}.tbl", orders[i % 2] + "\r\n" + "1|2|3\r\n" * (i % 5 * 400))
        want[i] = orders[i % 2]
    (tmp_path / "empty.tbl").touch()
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")  # several splits a file
    try:
        spark.sparkContext.setJobGroup("headers", "headers")
        with readers._file_by_file(spark):
            got = readers.file_headers(spark, str(tmp_path)).collect()
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("headers")) <= 1
        assert sorted(r["header"].rstrip("\r") for r in got) == sorted(want.values())
        rows = readers.read_delimited(spark, str(tmp_path), readers.STORE_SALES_SCHEMA, validate_header=True)
        sums = rows.selectExpr("count(*)", "sum(ss_transaction_id)", "sum(ss_item_id)").first()
        n = [sum(i % 5 * 400 for i in range(36) if i % 2 == k) for k in (0, 1)]
        assert tuple(sums) == (sum(n), n[0] + 3 * n[1], 3 * n[0] + n[1])
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before


def test_any_saved_model_loads_by_its_own_class(spark, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.feature import IDF, HashingTF, Tokenizer
    from aisleflow.sources import sinks
    texts = spark.createDataFrame([("a b",), ("b c c",)], "t string")
    model = Pipeline(stages=[Tokenizer(inputCol="t", outputCol="w"), HashingTF(inputCol="w", outputCol="f", numFeatures=16),
                             IDF(inputCol="f", outputCol="x")]).fit(texts)
    loaded = sinks.load_model(sinks.save_model(model, str(tmp_path / "m")))
    assert isinstance(loaded, PipelineModel)
    assert loaded.transform(texts).collect() == model.transform(texts).collect()
