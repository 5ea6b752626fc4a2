"""Work that a query does once: scans of tokens and markup, locators that nobody asks for, tasks of a batch."""

from pyspark.sql import functions as F

from ledgermill.operators import evidence, sections
from ledgermill.queries import jobs as job_queries
from ledgermill.queries.catalog import QUERIES


def plan(spark, sf_dir, name):
    return QUERIES[name].run(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()


def test_preference_and_page_choice_read_tokens_once(spark, sf_dir):
    for name in ("s25_tagged_over_printed", "g6_s22_c14_second_pass_pages"):
        assert plan(spark, sf_dir, name).count("posexplode(split(") == 1, name


def test_class_agreement_reads_documents_once(spark, sf_dir):
    assert plan(spark, sf_dir, "d38_class_kappa").count("ArrowEvalPython") == 1


def test_class_and_range_work_out_no_locators(spark, sf_dir):
    for name in ("s2_printed_class", "s21_e16_primary_range"):
        assert "VIABILITY" not in plan(spark, sf_dir, name), name
    assert "VIABILITY" in plan(spark, sf_dir, "s4_expected_printed")


def test_batches_of_the_queue_use_all_partitions(spark, sf_dir, tmp_path):
    kept, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    spark.conf.set("spark.sql.shuffle.partitions", 3 * job_queries.FILES)
    try:
        (job_queries._stream(spark, sf_dir).writeStream.foreachBatch(lambda b, _: seen.append(b.rdd.getNumPartitions()))
         .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    assert seen and set(seen) == {3 * job_queries.FILES}


def test_printed_rows_start_where_y_steps(spark):
    pages = [[(None, 1.0, "a"), (1.0, 1.0, "b"), (1.0, 2.0, "c"), (16.0, 0.0, "d"), (31.5, 3.0, "e"), (31.5, 4.0, "f")],
             [(0.0, 0.0, "a"), (-0.0, 1.0, "b"), (40.0, 0.0, "c")], [(5.0, 5.0, "a")]]
    df = spark.createDataFrame([(p,) for p in pages], "items array<struct<y: double, x: double, text: string>>")
    got = [r[0] for r in df.select(F.transform(evidence.printed_rows(F.sort_array("items")), lambda r: F.array_join(
        F.transform(r, lambda t: t["text"]), ""))).collect()]
    assert got == [["abcd", "ef"], ["ab", "c"], ["a"]]


def test_preference_beside_and_above_agree(spark):
    slots = spark.createDataFrame([("1", "a", "found", None), ("1", "b", "not_found", None), ("2", "a", "not_found", None),
                                   (None, "a", "found", None)], "company_number string, section_id string, status string, text string")
    texts = spark.createDataFrame([("1", "b", "x"), ("2", "a", "y"), ("2", "a", "y"), ("9", "a", "z")],
                                  "company_number string, section_id string, text string")
    tagged = slots.drop("status", "text").join(texts, ["company_number", "section_id"], "left").withColumn(
        "status", F.when(F.col("text").isNotNull(), "found").otherwise("not_found"))
    want = sections.prefer_tagged(tagged, slots).collect()
    got = sections.prefer_tagged_slots(slots, texts).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) == 4
