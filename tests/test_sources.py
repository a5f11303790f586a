import datetime
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from marquee import schemas
from marquee.plans import full_run
from marquee.session import scratch_path, shared_dir
from marquee.sources import catalog, delimited, files
from marquee.sources.snapshots import SnapshotTable, VersionNotFound
from support import as_dicts, rows_of


def write(folder, name, text, bom=False):
    path = folder / name
    path.write_text(text, encoding="utf-8-sig" if bom else "utf-8")
    return str(path)


def test_film_file_with_quotes_and_line_breaks(spark, tmp_path):
    path = write(tmp_path, "Film.csv", (
        "show_id;film name;director;cast;country;release_year;rating;duration;listed_in;Description\n"
        's1;ONE;"A, B";c;VN;2019;R;90 minutes;"Drama, War";"has ; and ""quotes""\nand a second line"\n'
        "s2;TWO;D;;VN;2019;;Not Available;Drama;plain\n"
    ), bom=True)
    df = delimited.read_films(spark, path)
    assert df.columns == schemas.RAW_FILM
    first, second = df.orderBy("show_id").collect()
    assert first["director"] == "A, B"
    assert first["description"] == 'has ; and "quotes"\nand a second line'
    assert second["cast"] is None and second["film_name"] == "TWO"


def test_light_and_full_header_cleaning(spark):
    df = spark.createDataFrame([(1, 2)], ["﻿ Slot Type ", "Total"])
    assert delimited.normalised(df, identifiers=False).columns == ["Slot Type", "Total"]
    assert delimited.normalised(df).columns == ["slot_type", "total"]
    clash = spark.createDataFrame([(1, 2)], ["a b", "A_B"])
    with pytest.raises(ValueError, match="a_b"):
        delimited.normalised(clash)


def test_missing_raw_column(spark, tmp_path):
    path = write(tmp_path, "Customer.csv", "customerid;DOB;gender;job\n1;;;\n")
    with pytest.raises(ValueError, match="address"):
        delimited.read_customers(spark, path)


def test_files_with_other_headers_are_refused(spark, tmp_path):
    write(tmp_path, "a.csv", "customerid;DOB;gender;address;job\n1;01/02/1990;M;x;y\n")
    write(tmp_path, "b.csv", "customerid;DOB;gender;job;address\n2;01/02/1990;M;y;x\n")
    with pytest.raises(Exception, match="(?i)header"):
        delimited.read_customers(spark, str(tmp_path)).collect()


def test_delimited_round_trip(spark, tmp_path):
    data = [("a;b", ' "q" ', "l1\nl2"), ("y", None, " x ")]
    df = spark.createDataFrame(data, "a string, b string, c string")
    delimited.write_delimited(df, f"{tmp_path}/out")
    back = delimited.read_delimited(spark, f"{tmp_path}/out", multi_line=True)
    assert sorted(rows_of(back), key=repr) == sorted(data, key=repr)


def test_unreadable_table_names_itself(spark, tmp_path):
    with pytest.raises(files.TableNotReadable, match="dim_film"):
        files.read_parquet(spark, f"{tmp_path}/nothing", "dim_film")


def test_list_files(spark, tmp_path):
    spark.range(10).repartition(2).write.parquet(f"{tmp_path}/t")
    listed = as_dicts(files.list_files(spark, f"{tmp_path}/t", "*.parquet"))
    assert len(listed) == 2 and all(r["bytes"] > 0 and r["modified"] for r in listed)


def test_schema_report(spark):
    df = spark.range(1).select("id", F.lit("x").alias("s"))
    assert rows_of(files.schema_report(df)) == [(0, "id", "bigint", False, 1, 0), (1, "s", "string", False, 1, 0)]
    df = spark.createDataFrame([(1, "", None), (None, "x", 2.0), (3, None, 1.0)], "`a.b` int, s string, d double")
    assert [r[1:] for r in rows_of(files.schema_report(df))] == [("a.b", "int", True, 2, 1), ("s", "string", True, 1, 2), ("d", "double", True, 2, 1)]
    assert {r[-2:] for r in rows_of(files.schema_report(df.limit(0)))} == {(0, 0)}


def test_rows_by_file(spark, tmp_path):
    spark.range(10).repartitionByRange(3, "id").write.parquet(f"{tmp_path}/t")
    listed = as_dicts(files.rows_by_file(spark.read.parquet(f"{tmp_path}/t")))
    assert len(listed) == 3 and sum(r["rows"] for r in listed) == 10
    assert all(r["bytes"] > 0 and r["modified"] and r["path"].endswith(r["name"]) for r in listed)


HEADER = "\ufefforderid;Cashier;saledate;total;customerid;ticketcode;date;time;slot;room;film;slot type;ticket type;ticket price;popcorn\n"
WHOLE = '1;"A ""x""; b";d;1;c;t;2019;1;s;1;f;x;y;1;Có\n'


def test_damaged_lines_are_counted_and_left_out(spark, tmp_path):
    broken = '2;"in two\nlines";d;1;c;t;2019;1;s;1;f;x;y;1;Có\n3;short\n4' + ";z" * 16 + "\n"
    path = f"{tmp_path}/Ticket.csv"
    with open(path, "w") as out:
        out.write(HEADER + WHOLE + broken + "5" + ";" * 14 + "\n")
    for read in (lambda df: df.collect(), lambda df: df.select("orderid").collect(), lambda df: [0] * df.count()):
        seen = Observation()
        assert len(read(delimited.read_tickets(spark, path, seen))) == 2
        assert (seen.get["read"], seen.get["damaged"]) == (6, 4)
        # without a counter they are an error, whatever columns are read
        with pytest.raises(SparkRuntimeException, match="damaged line"):
            read(delimited.read_tickets(spark, path))
    seen = Observation()
    rows = {r["orderid"]: r for r in delimited.read_tickets(spark, path, seen).collect()}
    assert rows["1"]["cashier"] == 'A "x"; b' and rows["5"]["popcorn"] is None


def test_whole_file_has_no_damaged_line(spark, tmp_path):
    with open(f"{tmp_path}/Ticket.csv", "w") as out:
        out.write(HEADER + WHOLE * 3)
    assert delimited.read_tickets(spark, f"{tmp_path}/Ticket.csv").count() == 3


def test_bucketed_tables_join_without_a_shuffle(spark, conf, tmp_path):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    fact = spark.range(400).select(
        F.col("id").alias("order_id"), F.lit(1).alias("ticket_id"), F.when(F.col("id") < 150, 0).otherwise(F.col("id") % 30).alias("customer_id")
    )
    people = spark.range(25).select(F.col("id").alias("customer_id"), F.concat(F.lit("g"), F.col("id") % 3).alias("gender"))
    before = spark.catalog.currentDatabase()
    catalog.use_schema(spark, "bucket_db", f"{tmp_path}/db", "spark_catalog")
    try:
        full_run.store_for_customers(fact, people, "bucket_db", f"{tmp_path}/tables", buckets=5, slices=3)
        sales = full_run.sales_with_customers(spark, "bucket_db")
        assert "Exchange" not in sales._jdf.queryExecution().executedPlan().toString()
        wanted = fact.join(people, "customer_id", "left")
        assert sorted(map(tuple, sales.select(wanted.columns).collect()), key=repr) == sorted(map(tuple, wanted.collect()), key=repr)
        # the tickets of one customer lie in several buckets
        assert spark.table("bucket_db.fact_ticket").filter("customer_id = 0").select("slice").distinct().count() == 3
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql("DROP SCHEMA bucket_db CASCADE")


def test_buckets_follow_the_rows(spark, monkeypatch, tmp_path):
    """Twice the tickets are twice the buckets, so the rows that one task sorts stay the same."""
    monkeypatch.setattr(full_run, "BUCKET_ROWS", 100)
    before = spark.catalog.currentDatabase()
    catalog.use_schema(spark, "sized_db", f"{tmp_path}/db", "spark_catalog")
    people = spark.range(20).select(F.col("id").alias("customer_id"), F.lit("g").alias("gender"))
    try:
        for tickets, buckets in ((0, 1), (1500, 15), (3000, 30)):
            fact = spark.range(tickets).select(F.col("id").alias("order_id"), F.lit(1).alias("ticket_id"), (F.col("id") % 25).alias("customer_id"))
            full_run.store_for_customers(fact, people, "sized_db", f"{tmp_path}/t{tickets}", slices=3)
            for name in ("fact_ticket", "dim_customer"):
                told = spark.sql(f"DESCRIBE TABLE EXTENDED sized_db.{name}").filter("col_name = 'Num Buckets'").first()["data_type"]
                assert int(told) == buckets
            assert full_run.sales_with_customers(spark, "sized_db").count() == tickets
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql("DROP SCHEMA sized_db CASCADE")


def test_two_writers_replace_their_own_partitions(spark, tmp_path):
    """Two threads with one session, one of them replacing the whole table of its own."""
    setting = "spark.sql.sources.partitionOverwriteMode"
    mode = spark.conf.get(setting)
    before = spark.catalog.currentDatabase()
    catalog.use_schema(spark, "writers_db", f"{tmp_path}/db")
    try:
        rows = spark.range(40).select("id", (F.col("id") % 4).alias("k"))
        for name in ("a", "b"):
            catalog.save_table(rows, f"writers_db.{name}", ["k"])
        newer = rows.filter("k = 1").withColumn("id", F.col("id") + 100)
        with ThreadPoolExecutor(2) as pool:
            both = [
                pool.submit(catalog.save_table, newer, "writers_db.a", ["k"], True),
                pool.submit(catalog.save_table, newer, "writers_db.b", ["k"]),
            ]
            [w.result() for w in both]
        assert spark.table("writers_db.a").count() == 40 and spark.table("writers_db.a").filter("id >= 100").count() == 10
        assert sorted(r["k"] for r in spark.table("writers_db.b").select("k").distinct().collect()) == [1]
        assert spark.conf.get(setting) == mode
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql("DROP SCHEMA writers_db CASCADE")


def test_rows_are_counted_while_they_are_written(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/counted")
    table.overwrite(spark.range(1000).withColumn("k", F.col("id") % 3), ["k"])
    table.overwrite(spark.range(0).toDF("id"))
    assert [r["rows"] for r in table.history().collect()] == [0, 1000]
    table.check(0)
    table.check(1)


def monthly(spark, start, days):
    first = datetime.date.fromisoformat(start)
    df = spark.createDataFrame([(first + datetime.timedelta(days=i), i) for i in range(days)], "sale_date date, n int")
    return df.withColumns({"sale_year": F.year("sale_date"), "sale_month": F.month("sale_date")})


def opened_folders(df):
    return {r[0] for r in df.select(F.regexp_extract(F.input_file_name(), r"(sale_year=\d+/sale_month=\d+)", 1)).distinct().collect()}


def test_between_dates_prunes_folders(spark, tmp_path):
    df = monthly(spark, "2018-11-10", 200)
    files.write_parquet(df, f"{tmp_path}/t", schemas.FACT_PARTITIONS)
    stored = files.read_parquet(spark, f"{tmp_path}/t")
    cut = files.between_dates(stored, "2018-12-30", "2019-01-02")
    assert sorted(r["n"] for r in cut.collect()) == [50, 51, 52, 53]
    assert opened_folders(cut) == {"sale_year=2018/sale_month=12", "sale_year=2019/sale_month=1"}
    plan = cut._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "sale_year" in filters and "sale_month" in filters


def test_only_touched_partitions_are_replaced(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = monthly(spark, "2019-01-01", 59)
    files.write_parquet(df, path, schemas.FACT_PARTITIONS)
    newer = df.filter("sale_month = 2").withColumn("n", F.lit(-1))
    files.write_parquet(newer, path, schemas.FACT_PARTITIONS, only_touched=True)
    assert sorted(r["n"] for r in files.read_parquet(spark, path).collect()) == [-1] * 28 + list(range(31))


def test_hot_partition_is_written_by_several_tasks(spark, conf, tmp_path):
    spark.range(400_000).select("id", F.xxhash64("id").alias("x")).repartition(8).write.parquet(f"{tmp_path}/in")
    conf(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="500KB",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="1KB",
    )
    df = spark.read.parquet(f"{tmp_path}/in").withColumn("k", F.when(F.col("id") < 390_000, 0).otherwise(F.col("id") % 7))
    files.write_parquet(df, f"{tmp_path}/out", ["k"])
    listed = files.list_files(spark, f"{tmp_path}/out/k=0", "*.parquet")
    assert listed.count() > 3
    assert spark.read.parquet(f"{tmp_path}/out").count() == 400_000


def test_snapshots(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/t")
    with pytest.raises(VersionNotFound):
        table.read()
    assert table.history().count() == 0
    assert table.overwrite(monthly(spark, "2019-05-01", 31), schemas.FACT_PARTITIONS) == 0
    assert table.overwrite(spark.range(5).toDF("other")) == 1
    assert table.read().columns == ["other"] and table.read().count() == 5
    assert table.read(0).count() == 31 and table.read(0).schema["sale_month"].dataType.simpleString() == "int"
    history = table.history()
    assert [(r["version"], r["operation"], r["rows"]) for r in history.collect()] == [(1, "overwrite", 5), (0, "overwrite", 31)]
    assert table.history(1).count() == 1
    with pytest.raises(VersionNotFound):
        table.read(7)
    table.check(0)


def test_snapshot_keeps_column_types_and_order(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/t")
    df = spark.createDataFrame([("01", 1, "x"), ("2", 2, None)], "code string, n int, s string")
    table.overwrite(df, ["code"])
    assert table.read().schema.simpleString() == df.schema.simpleString()
    assert sorted(rows_of(table.read())) == [("01", 1, "x"), ("2", 2, None)]


def test_failed_write_stays_invisible(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/t")
    table.overwrite(spark.range(3))
    with pytest.raises(Exception):
        table.overwrite(spark.range(3).select(F.raise_error(F.lit("stop")).alias("x")))
    assert table.history().count() == 1 and table.read().count() == 3


def test_compaction_keeps_rows_and_cuts_files(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/t")
    copies = spark.range(30_000).select(F.lit(1).alias("same"), F.lit(2019).alias("sale_year"), F.lit(5).alias("sale_month"))
    table.overwrite(copies.repartition(12))
    entry = table.history(1).first()
    assert files.list_files(spark, entry["path"], "*.parquet").count() == 12
    assert table.compact() == 1
    assert files.list_files(spark, table.history(1).first()["path"], "*.parquet").count() == 1
    assert table.read().groupBy("same").count().collect()[0]["count"] == 30_000
    table.check()


def test_compaction_spreads_equal_rows(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/t")
    copies = spark.range(200_000).select(F.lit("x").alias("same"), (F.col("id") % 2).alias("part"))
    table.overwrite(copies, ["part"])
    size = files.list_files(spark, table.history(1).first()["path"], "*.parquet").agg(F.sum("bytes")).first()[0]
    table.compact(target_bytes=size // 8 + 1)
    per_file = table.read().groupBy(F.input_file_name()).count()
    assert per_file.agg(F.max("count")).first()[0] < 60_000
    assert table.read().count() == 200_000 and table.history(1).first()["partition_by"] == ["part"]


def test_catalog_tables(spark, tmp_path):
    before = spark.catalog.currentDatabase()
    catalog.use_schema(spark, "film_db", f"{tmp_path}/film_db")
    try:
        df = monthly(spark, "2019-04-20", 30)
        catalog.save_table(df.drop("sale_year"), "film_db.fact")
        catalog.save_table(df, "film_db.fact", schemas.FACT_PARTITIONS)
        assert set(spark.table("film_db.fact").columns) == set(df.columns)
        catalog.check_rows(spark.table("fact"), 30, "fact")
        with pytest.raises(catalog.RowCountMismatch, match="31 rows written, 30 rows stored"):
            catalog.check_rows(spark.table("fact"), 31, "fact")
        may = df.filter("sale_month = 5").limit(1)
        catalog.save_table(may, "film_db.fact", schemas.FACT_PARTITIONS, only_touched=True)
        counts = dict(rows_of(spark.table("film_db.fact").groupBy("sale_month").count()))
        assert counts == {4: 11, 5: 1}
        assert [r["tableName"] for r in catalog.list_tables(spark, "film_db").collect()] == ["fact"]
        assert rows_of(catalog.presence(spark, ["film_db.fact", "film_db.none"])) == [("film_db.fact", True), ("film_db.none", False)]
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql("DROP SCHEMA IF EXISTS film_db CASCADE")


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared_dir(spark))


def test_quotes_and_separators_survive_single_line_files(spark, tmp_path):
    rows = [("C1", '1 "A" St; x/d/c', 'say "hi"'), ("C2", 'ends with "', ' padded ;')]
    df = spark.createDataFrame(rows, "customerid string, address string, job string")
    delimited.write_delimited(df, str(tmp_path / "c"))
    back = delimited.normalised(delimited.read_delimited(spark, str(tmp_path / "c")))
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)
