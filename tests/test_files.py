"""Loads, sinks and streams: bad rows, repeated runs, rejected loads, replays."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.operators import cdc
from clientele.operators.dedupe import latest_per_key
from clientele.session import fresh_table, shared_folder
from clientele.sources import files, sinks
from clientele.streaming import feeds

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("amount", T.DecimalType(10, 2)), T.StructField("name", T.StringType())])


def test_csv_nulls_quotes_and_ragged_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,amount,name\n1," 2.50 ","x, y"\n2,NULL,null\n3,4.00\n4,5.00,z,extra\n')
    got = files.read_csv_positional(spark, str(tmp_path), SCHEMA, row_number=True).orderBy("id").collect()
    assert [(r["id"], float(r["amount"]) if r["amount"] is not None else None, r["name"]) for r in got] == [
        (1, 2.5, "x, y"), (2, None, None), (3, 4.0, None), (4, 5.0, "z"),
    ]
    assert [r["file_row_number"] for r in got] == [1, 2, 3, 4] and got[0]["source_file"].endswith("a.csv")


def test_csv_bad_value_aborts_or_becomes_null(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,amount,name\n1,abc,x\n")
    with pytest.raises(Exception):
        files.read_csv_positional(spark, str(tmp_path), SCHEMA).collect()
    assert files.read_csv_positional(spark, str(tmp_path), SCHEMA, strict=False).first()["amount"] is None


def test_load_once_takes_only_new_files(spark, tmp_path):
    src, target, check = (str(tmp_path / x) for x in ("src", "target", "check"))
    part = spark.range(5)
    part.write.parquet(f"{src}/a.parquet")
    run = lambda: files.load_once(spark, f"{src}/*", part.schema, target, check, "*.parquet")
    run()
    run()
    assert spark.read.parquet(target).count() == 5
    spark.range(5, 8).write.parquet(f"{src}/b.parquet")
    run()
    assert spark.read.parquet(target).count() == 8


def test_rejected_load_leaves_the_published_table(spark):
    name = fresh_table(spark, "t")
    good = spark.range(10).withColumn("v", F.lit("a"))
    sinks.publish_validated(good, name, "id", ["id"], expected_rows=10)
    for bad in (good.union(good), spark.range(1).withColumn("v", F.lit("b")), good.withColumn("v", F.lit(None).cast("string"))):
        with pytest.raises(sinks.ValidationFailed):
            sinks.publish_validated(bad, name, "id", ["id", "v"], expected_rows=10)
        assert sinks.read_published(spark, name).where("v = 'a'").count() == 10
        assert spark.table(name).where("v = 'a'").count() == 10
    assert len(tables_of(spark, name)) == 2  # the view and its one version


def tables_of(spark, name):
    db, short = name.split(".")
    return [t.name for t in spark.catalog.listTables(db) if t.name.startswith(short)]


def test_publish_survives_a_crash_and_rolls_back(spark, monkeypatch):
    name = fresh_table(spark, "t")
    for v in "abc":
        sinks.publish_validated(spark.range(10).withColumn("v", F.lit(v)), name, "id", ["id"], expected_rows=10)

    def crash(*args):
        raise OSError("the driver died")

    with monkeypatch.context() as broken:
        broken.setattr(sinks, "_show", crash)
        with pytest.raises(OSError):
            sinks.publish_validated(spark.range(10).withColumn("v", F.lit("d")), name, "id", ["id"], expected_rows=10)
    assert {r.v for r in sinks.read_published(spark, name).collect()} == {"c"}
    assert {r.v for r in sinks.read_published(spark, name, back=1).collect()} == {"b"}
    sinks.publish_validated(spark.range(10).withColumn("v", F.lit("e")), name, "id", ["id"], expected_rows=10)
    assert [{r.v for r in sinks.read_published(spark, name, back=i).collect()} for i in (0, 1)] == [{"e"}, {"c"}]


def stored_table(spark, rows, schema):
    name = fresh_table(spark, "t")
    sinks.create_partitioned(spark.createDataFrame(rows, schema), name, "p")
    return name


def test_deletes_and_emptied_partitions(spark):
    name = stored_table(spark, [(1, 10, "a"), (2, 20, "a"), (3, 30, "it's b")], "id long, v long, p string")
    batch = spark.createDataFrame([(3, 30, "it's b", 1, "DELETE"), (2, 20, "a", 1, "DELETE"), (4, 40, "c", 1, "INSERT")], "id long, v long, p string, at long, action string")
    sinks.upsert_table(spark, name, batch, ["id"], ["at"], "p", action="action")
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [(1, 10, "a"), (4, 40, "c")]
    table = spark.table(name)
    sinks.overwrite_partitions(table.where("id = 1 and v = 0"), name, "p", touched=table.where("p = 'c'"))
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, 10, "a")]
    assert [r.partition for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["p=a"]


def test_a_rerun_after_a_crash_gives_the_same_table(spark, monkeypatch):
    """The run dies after the partitions are written and before the emptied one is dropped."""
    start = [(1, 10, "a"), (2, 20, "a"), (3, 30, "b")]
    batch = spark.createDataFrame([(3, 30, "b", 1, "DELETE"), (1, 11, "a", 1, "INSERT")], "id long, v long, p string, at long, action string")
    name = stored_table(spark, start, "id long, v long, p string")
    real = spark.sql

    def crash(text, *args):
        if "DROP" in text:
            raise OSError("the driver died")
        return real(text, *args)

    with monkeypatch.context() as broken:
        broken.setattr(spark, "sql", crash)
        with pytest.raises(OSError):
            sinks.upsert_table(spark, name, batch, ["id"], ["at"], "p", action="action")
    for _ in range(2):
        sinks.upsert_table(spark, name, batch, ["id"], ["at"], "p", action="action")
        assert sorted(tuple(r) for r in spark.table(name).collect()) == [(1, 11, "a"), (2, 20, "a")]


def test_overwriting_leaves_other_partitions_and_the_setting(spark):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    name = stored_table(spark, [(1, 10, "a"), (2, 20, None)], "id long, v long, p string")
    sinks.overwrite_partitions(spark.createDataFrame([("a", 5, 50)], "p string, id long, v long"), name, "p")
    assert sorted((r.id, r.v, r.p) for r in spark.table(name).collect()) == [(2, 20, None), (5, 50, "a")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_rejected_lines_are_the_lines_of_the_file(spark, tmp_path):
    lines = ["1,2.50,x", "2,n/a,y", "3,4", "4,5,z,surplus", '5,6,"open', '7,8,"closed, with comma"', ",,", "x,9,", '9,1,"a ""b"" c"']
    (tmp_path / "a.csv").write_text("\n".join(["id,amount,name", *lines]) + "\n")
    got = files.read_csv_quarantine(spark, str(tmp_path), SCHEMA).collect()
    assert len(got) == len(lines)
    assert sorted(r.rejected for r in got if r.rejected is not None) == sorted([lines[1], lines[2], lines[3], lines[4], lines[7]])
    good = {r.id: (float(r.amount), r["name"]) for r in got if r.rejected is None and r.id}
    assert good[1] == (2.5, "x") and good[7] == (8.0, "closed, with comma")
    assert [r.rejected for r in files.read_csv_quarantine(spark, str(tmp_path), SCHEMA).select("rejected").where("rejected like '3%'").collect()] == ["3,4"]


def test_positional_read_keeps_malformed_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,amount,name\n1,2.50,x\n3,4.00\n4,5.00,z,extra\n")
    got = files.read_csv_positional(spark, str(tmp_path), SCHEMA, malformed="line")
    assert {r.id: r.line for r in got.collect()} == {1: None, 3: "3,4.00", 4: "4,5.00,z,extra"}
    assert {r.id: r.line for r in got.select("id", "line").collect()} == {1: None, 3: "3,4.00", 4: "4,5.00,z,extra"}


def test_only_the_readers_error_is_an_aborted_load(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("id,amount,name\n1,n/a,x\n")
    (tmp_path / "good.csv").write_text("id,amount,name\n1,2,x\n")
    assert files.load_or_abort(spark, str(tmp_path / "bad.csv"), SCHEMA, str(tmp_path / "t1")) is None
    assert files.load_or_abort(spark, str(tmp_path / "good.csv"), SCHEMA, str(tmp_path / "t2")).count() == 1
    with pytest.raises(Exception, match="(?i)exists"):
        files.load_or_abort(spark, str(tmp_path / "good.csv"), SCHEMA, str(tmp_path / "t2"))


def test_upsert_table_rewrites_only_touched_partitions(spark):
    name = stored_table(spark, [(1, 10, "a"), (2, 20, "a"), (3, 30, "b")], "id long, v long, p string")
    files_of_b = lambda: {f for f in spark.table(name).inputFiles() if "/p=b/" in f}
    before = files_of_b()
    batch = spark.createDataFrame([(1, 11, "a", 1), (4, 40, "c", 1)], "id long, v long, p string, at long")
    for _ in range(2):
        sinks.upsert_table(spark, name, batch, ["id"], ["at"], "p")
    got = sorted((r["id"], r["v"], r["p"]) for r in spark.table(name).collect())
    assert got == [(1, 11, "a"), (2, 20, "a"), (3, 30, "b"), (4, 40, "c")]
    assert before and files_of_b() == before


def test_bucketed_copies_join_without_a_shuffle(spark):
    from clientele.plans.files import bucketed_join

    joined = bucketed_join(spark, "/root/testdata/sf0.001", 4)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
    assert joined.count() > 0


def test_compaction_folds_deltas_once(spark, tmp_path):
    base = spark.createDataFrame([(1, 10), (2, 20)], "id long, v long")
    deltas = spark.createDataFrame([(1, 11, "INSERT", 1, 0), (2, 0, "DELETE", 1, 0), (3, 30, "INSERT", 2, 1), (1, 12, "INSERT", 3, 2)], "id long, v long, action string, at long, batch_id long")
    merge = (["id"], ["at"], ["v"], "action")
    want = sorted(map(tuple, feeds.current_state(base, deltas, *merge).collect()))
    table = feeds.compact_deltas(feeds.Compacted(base), deltas.where("batch_id < 2"), str(tmp_path), *merge)
    assert table.upto == 1 and sorted(map(tuple, table.base.collect())) == [(1, 11), (3, 30)]
    assert sorted(map(tuple, feeds.state_of(table, deltas, *merge).collect())) == want
    assert feeds.compact_deltas(table, deltas, str(tmp_path), *merge, at_least=2).upto == 1
    again = feeds.compact_deltas(table, deltas, str(tmp_path), *merge)
    assert again.upto == 2 and sorted(map(tuple, again.base.collect())) == want


def test_state_of_the_months_is_restored_and_closes(spark, tmp_path):
    """Each run starts from the checkpoint: open months go on, a row of a closed month is left out, state is dropped."""
    src, target, check = (str(tmp_path / x) for x in ("src", "target", "check"))
    schema = "t timestamp_ntz, v long"

    def deliver(*rows):
        part = spark.createDataFrame([(dt.datetime.fromisoformat(t), v) for t, v in rows], schema)
        part.coalesce(1).write.mode("append").parquet(src)
        query = feeds.keep_updates(feeds.monthly_totals_stream(feeds.file_stream(spark, src, part.schema), "t", "v"), target, check)
        query.awaitTermination()
        return query

    deliver(("2024-01-05", 1), ("2024-02-05", 10))
    deliver(("2024-02-07", 5), ("2024-06-01", 100))
    last = deliver(("2024-01-20", 1000), ("2024-05-02", 7), ("2024-06-03", 1))
    found = latest_per_key(spark.read.parquet(target), ["month"], ["batch_id"])
    got = {r.month.strftime("%Y-%m"): (r.txn_count, r.total_spend) for r in found.collect()}
    assert got == {"2024-01": (1, 1), "2024-02": (2, 15), "2024-05": (1, 7), "2024-06": (2, 101)}
    assert sum(s["numRowsTotal"] for s in last.lastProgress["stateOperators"]) <= 2


def test_latest_delivery_wins_with_a_bounded_state(spark, tmp_path):
    src, target, check = (str(tmp_path / x) for x in ("src", "target", "check"))
    schema, want = "id long, t timestamp_ntz, v long", {}
    sizes = []
    for month in range(1, 9):
        # A hundred keys a month, ten of them delivered again in the month and ten of the month before.
        rows = [(100 * month + i, dt.datetime(2024, month, 1 + i % 20), i) for i in range(100)]
        rows += [(100 * month + i, dt.datetime(2024, month, 25), 1000 + i) for i in range(10)]
        rows += [(100 * (month - 1) + i, dt.datetime(2024, month, 2), 2000 + i) for i in range(10) if month > 1]
        for k, t, v in sorted(rows, key=lambda r: r[1]):
            want[k] = v
        part = spark.createDataFrame(rows, schema)
        part.coalesce(1).write.mode("append").parquet(src)
        stream = feeds.latest_delivery_stream(feeds.file_stream(spark, src, part.schema), ["id"], "t", ["t"])
        query = feeds.keep_updates(stream, target, check)
        query.awaitTermination()
        sizes.append(sum(s["numRowsTotal"] for s in query.lastProgress["stateOperators"]))
    got = {r.id: r.v for r in latest_per_key(spark.read.parquet(target), ["id"], ["t", "batch_id"]).collect()}
    assert got == want
    assert max(sizes) <= 400 and sizes[-1] < len(want) / 2


def test_fixed_width_layout_by_record_type(spark, tmp_path):
    line = [" "] * 560

    def put(start, text):
        line[start - 1:start - 1 + len(text)] = text

    put(8, "19990102-030405"), put(23, "FIN"), put(26, "1999"), put(30, "1"), put(31, "19990101"), put(39, "bad-date"), put(47, "12.34"), put(168, "77"), put(194, "42")
    (tmp_path / "f.txt").write_text("".join(line) + "\n")
    parts = files.split_records(files.read_fixed_width(spark, str(tmp_path)))
    r = parts["FIN"].first()
    assert (r["pts"], int(r["year"]), float(r["revenue"]), int(r["sh_out"]), r["co_name_or_cik"]) == (dt.datetime(1999, 1, 2, 3, 4, 5), 1999, 12.34, 77, "42")
    assert r["posting_date"] is None and r["qtr_start_date"] == dt.date(1999, 1, 1)
    assert parts["CMP"].count() == 0


def test_replayed_stream_equals_batch(spark, tmp_path):
    src, deltas, check = (str(tmp_path / x) for x in ("src", "deltas", "check"))
    batch = spark.createDataFrame([(i % 50, i, "DELETE" if i % 7 == 0 else "INSERT", i) for i in range(400)], "id long, v long, action string, at long")
    batch.repartition(5, "id").write.parquet(src)
    base = spark.createDataFrame([(i, -1) for i in range(30)], "id long, v long")
    stream = lambda: feeds.file_stream(spark, src, batch.schema, files_per_batch=1)
    for folder in (check, check + "-lost"):  # the second run starts from a lost checkpoint and replays everything
        feeds.collect_changes(stream(), deltas, folder, ["id"], ["at"]).awaitTermination()
    state = feeds.current_state(base, spark.read.parquet(deltas), ["id"], ["at"], ["v"], "action")
    want = cdc.upsert(base, batch, ["id"], ["at"], ["v"], "action")
    assert sorted(map(tuple, state.collect())) == sorted(map(tuple, want.collect()))
    kept = feeds.compact(state, str(tmp_path / "base-2"))
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, want.collect()))


def test_watermark_filter_keeps_newer_rows(spark):
    source = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2))], "id long, at timestamp_ntz")
    assert [r["id"] for r in sinks.above_watermark(source, source.where("id = 1"), "at").collect()] == [2]
    assert sinks.above_watermark(source, source.where("id = 9"), "at").count() == 2


def test_sorted_copy_has_disjoint_files(spark, tmp_path):
    copy = sinks.sorted_copy(spark.range(1000).repartition(4), str(tmp_path / "s"), ["id"], files=4)
    spans = copy.groupBy(F.col("_metadata.file_name").alias("f")).agg(F.min("id").alias("lo"), F.max("id").alias("hi")).orderBy("lo").collect()
    assert len(spans) > 1 and all(a["hi"] < b["lo"] for a, b in zip(spans, spans[1:]))


def test_build_writes_all_tables_consistently(spark, tmp_path):
    from clientele.operators.telemetry import run_log
    from clientele.plans.build import build

    out = str(tmp_path / "warehouse")
    made = build(spark, "/root/testdata/sf0.001", out)
    facts, profile = made["fct_transactions"], made["customer_360_profile"]
    assert facts.count() == facts.select("transaction_key").distinct().count() > 0
    assert profile.count() == facts.select("customer_key").distinct().count()
    assert facts.join(made["dim_date"], "date_key").count() == facts.count()
    total = facts.agg(F.sum("amount").cast("double")).first()[0]
    assert profile.agg(F.sum("lifetime_value")).first()[0] == pytest.approx(total)
    approved = facts.where("status = 'approved'").agg(F.sum("amount")).first()[0]
    assert made["monthly_customer_spending"].agg(F.sum("total_spend")).first()[0] == approved
    log = run_log(spark.read.parquet(f"{out}/run_log")).first()
    assert log["status"] == "SUCCESS" and log["models_run"] == len(made)


def test_search_and_history(spark):
    from clientele.operators import campaign

    who = spark.createDataFrame([(1, "Ann Lee", "a@x.com"), (2, "Bob", "LEE@y.org")], "customer_id long, full_name string, email string")
    assert [r[0] for r in campaign.search(who, name="LEE").collect()] == [1]
    assert [r[0] for r in campaign.search(who, email="lee").collect()] == [2]
    assert campaign.search(who, customer_id=2).count() == 1 and campaign.search(who, name="' or 1=1").count() == 0
    rows = spark.createDataFrame([(1, dt.date(2024, 1, 1), "Travel"), (1, dt.date(2024, 3, 1), "Gas")], "customer_id long, transaction_date date, category_name string")
    assert campaign.history(rows, dt.date(2024, 3, 2), days=30).count() == 1
    assert campaign.history(rows, dt.date(2024, 3, 2), category="Travel").count() == 1


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_months_stay_open_for_late_rows_and_close_after(spark, tmp_path):
    import os
    import time

    source, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    schema = "at timestamp, amount long"
    # The watermark that a batch makes closes months from the batch after the next one on.
    for i, rows in enumerate(([(dt.datetime(2024, 6, 15), 1)], [(dt.datetime(2024, 4, 20), 2)], [(dt.datetime(2024, 4, 2), 8), (dt.datetime(2024, 1, 5), 4)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        for f in (tmp_path / "in").glob("*.parquet"):  # arrival order
            os.utime(f, (time.time() - 100 + 50 * i,) * 2) if f.stat().st_mtime > time.time() - 20 else None
    stream = feeds.file_stream(spark, source, spark.read.parquet(source).schema, files_per_batch=1)
    feeds.keep_updates(feeds.monthly_totals_stream(stream, "at", "amount"), target, check).awaitTermination()
    got = {r["month"].month: r["total_spend"] for r in spark.read.parquet(target).orderBy("batch_id").collect()}  # the latest batch counts
    assert got == {6: 1, 4: 10}


def test_first_delivery_drops_repeats_within_the_bound(spark, tmp_path):
    source, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    rows = [(i % 5, dt.datetime(2024, 6, 1 + i % 3)) for i in range(20)]
    spark.createDataFrame(rows, "id long, at timestamp").repartition(4).write.parquet(source)
    stream = feeds.file_stream(spark, source, spark.read.parquet(source).schema, files_per_batch=2)
    feeds.append_landing(feeds.first_delivery(stream, ["id"], "at", "10 days").select("id"), target, check).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == list(range(5))
