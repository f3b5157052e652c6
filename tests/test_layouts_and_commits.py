"""Folders of several headers, rejected rows, committed snapshots, live tables kept by a stream."""

import pytest
from pyspark.sql import functions as F

from tarmac.operators import ingest as IN
from tarmac.operators import rejects as RJ
from tarmac.session import list_folder, make_folder, work_dir
from tarmac.sinks import writers as W
from tarmac.sources import files as FS
from tarmac.sources import layouts as LA
from tarmac.sources import snapshots as SN
from tarmac.streaming import jobs as J


def put(folder, **files):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(folder)


# ------------------------------------------------------------------ layouts


def test_files_of_different_headers_are_united_by_name(spark, tmp_path):
    path = put(
        tmp_path / "raw",
        a="FL_DATE,AIRLINE,ORIGIN,DEST,ARR_DELAY\n2020-01-01,AA,X,Y,5\n",
        b='﻿"DEST",ORIGIN,OP_CARRIER,flight_date,,dest\nY,X,BB,1/2/2020,junk,other\n',
        c="FL_DATE,AIRLINE,OP_CARRIER,ORIGIN\r\n2020-01-03,CC,77,X\r\n",
        empty="",
        only_header="FL_DATE,AIRLINE,ORIGIN,DEST,ARR_DELAY\n",
    )
    put(tmp_path / "raw" / "deep er", d="ARR_DELAY,AIRLINE,FL_DATE\n-3,DD,2020-01-04\n")
    df = LA.read_mixed_csv(spark, path)
    rows = {r.airline: r for r in df.collect()}
    assert set(df.columns) == {"flight_date", "airline", "origin", "dest", "arr_delay", "OP_CARRIER"}
    assert set(rows) == {"AA", "BB", "CC", "DD"}
    assert rows["BB"].dest == "Y" and rows["BB"].flight_date == "1/2/2020" and rows["BB"].arr_delay is None
    assert rows["CC"].OP_CARRIER == "77" and rows["DD"].arr_delay == "-3" and rows["DD"].origin is None
    assert IN.clean(df).where("flight_date IS NULL").count() == 0


def test_one_header_pass_reads_first_lines_only(spark, tmp_path):
    """Many files: each gives its own header; the plan has no shuffle and a task per split."""
    for k in range(20):
        put(tmp_path / "raw", **{f"f{k}": f"c{k % 3},FL_DATE\n" + "x,2020-01-01\n" * 5000})
    found = LA.file_headers(spark, str(tmp_path / "raw"))
    rows = found.collect()
    assert sorted(r.header for r in rows) == sorted(f"c{k % 3},FL_DATE" for k in range(20)) and len({r.file for r in rows}) == 20
    assert found.rdd.getNumPartitions() == 20


def test_no_input_and_too_many_headers(spark, tmp_path):
    with pytest.raises(FS.NoInputError):
        LA.read_mixed_csv(spark, str(tmp_path / "nowhere"))
    with pytest.raises(FS.NoInputError):
        LA.read_mixed_csv(spark, put(tmp_path / "blank", a=""))
    path = put(tmp_path / "many", **{f"f{k}": f"col{k}\n1\n" for k in range(5)})
    with pytest.raises(ValueError, match="more than 4"):
        LA.read_mixed_csv(spark, path, max_layouts=4)


# ------------------------------------------------------------------ rejects


def test_every_delivered_row_is_accepted_or_has_a_reason(spark, tmp_path):
    header = "FL_DATE,AIRLINE,ORIGIN,DEST,ARR_DELAY,DISTANCE\n"
    path = put(
        tmp_path / "raw",
        a=header
        + "2020-01-01,AA,X,Y,5,100\n" * 2
        + "2020-01-01,AA,X,Y,NA,100\n"  # cancelled: no delay is no reject
        + "2020-13-01,AA,X,Y,5,100\n"
        + "2020-01-01, ,X,Y,5,far\n"
        + "2020-01-01,AA,X\n"
        + "2020-01-01,AA,X,Y,5,100,\n"
        + '2020-01-01,"A,B",X,Y,5,100\n',
    )
    tagged = RJ.tag_rejects(LA.read_mixed_csv(spark, path, corrupt=True))
    counts = {r.reason: r.n for r in RJ.counts_by_reason(tagged).collect()}
    assert counts == {"accepted": 4, "bad_flight_date": 1, "bad_distance": 1, "fields_missing": 1, "fields_extra": 1, "delivered": 8}
    assert RJ.accepted(tagged).count() + RJ.rejected(tagged).count() == 8
    both = [r for r in RJ.rejected(tagged).collect() if len(r.reject_reasons) > 1]
    assert sorted(map(tuple, (r.reject_reasons for r in both))) == [("bad_distance", "no_airline"), ("fields_missing", "no_dest")]
    short = next(r for r in both if "fields_missing" in r.reject_reasons)
    assert short[LA.CORRUPT] == "2020-01-01,AA,X"


def test_load_keeps_curated_and_rejects_apart(spark, tmp_path):
    path = put(tmp_path / "raw", a="FL_DATE,AIRLINE,ORIGIN,DEST,ARR_DELAY\n" + "2020-01-01,AA,X,Y,5\n" * 3 + "x,AA,X,Y,5\n")
    raw = LA.read_mixed_csv(spark, path, corrupt=True)
    counts = RJ.load_with_rejects(raw, f"{tmp_path}/ok", f"{tmp_path}/bad", ["flight_date", "airline", "origin", "dest", "arr_delay", "year", "month"])
    assert counts == {"delivered": 4, "rejected": 1, "duplicates": 2, "curated": 1}
    assert spark.read.parquet(f"{tmp_path}/bad").first().reject_reasons == ["bad_flight_date"]
    assert FS.read_curated(spark, f"{tmp_path}/ok").count() == 1


def test_rejects_without_required_columns_or_rows(spark):
    none = spark.createDataFrame([], "FL_DATE string, AIRLINE string")
    assert [tuple(r) for r in RJ.counts_by_reason(RJ.tag_rejects(none)).collect()] in ([], [("delivered", 0)])
    some = RJ.tag_rejects(spark.createDataFrame([("2020-01-01", "AA")], "FL_DATE string, AIRLINE string"))
    assert some.first()[RJ.REASONS] == ["no_origin", "no_dest"]


# ---------------------------------------------------------- committed snapshots


def values(df):
    return sorted(r.v for r in df.collect())


def test_readers_see_the_old_rows_until_the_new_ones_are_committed(spark):
    path = work_dir(spark, "t_commits")
    one, two = spark.range(3).withColumnRenamed("id", "v"), spark.range(10, 12).withColumnRenamed("id", "v")
    with pytest.raises(FS.NoInputError):
        J.latest_snapshot(spark, path)
    first = SN.write_version(one, path, 0)  # written, not committed
    with pytest.raises(FS.NoInputError):
        FS.read_predictions(spark, path)
    SN.commit(spark, path, first)
    assert values(FS.read_predictions(spark, path)) == [0, 1, 2]
    before = J.latest_snapshot(spark, path)
    new = SN.write_version(two, path, 0)  # the batch again: a writer that dies here changes nothing
    assert values(J.latest_snapshot(spark, path)) == [0, 1, 2]
    SN.commit(spark, path, new)
    assert values(J.latest_snapshot(spark, path)) == [10, 11]
    assert values(before) == [0, 1, 2]  # whoever had listed the old version can still read it
    W.write_batch_snapshot(one, path, 0)
    assert values(J.latest_snapshot(spark, path)) == [0, 1, 2] and len(list_folder(spark, f"{path}/batch=0")) == 2


def test_unfinished_folders_are_no_snapshots(spark):
    path = work_dir(spark, "t_unfinished")
    W.write_batch_snapshot(spark.range(2).withColumnRenamed("id", "v"), path, 3)
    make_folder(spark, f"{path}/batch=7/version=abc/_temporary/0")
    make_folder(spark, f"{path}/_commits/not-a-marker")
    assert FS.snapshot_ids(spark, path) == [3]
    assert J.latest_snapshot(spark, path).select("batch").distinct().first()[0] == 3
    W.write_batch_snapshot(spark.range(1).withColumnRenamed("id", "v"), path, 7)  # clears what the dead writer left
    assert len(list_folder(spark, f"{path}/batch=7")) == 1
    W.drop_old_snapshots(spark, path, newest=7, keep=1)
    assert FS.snapshot_ids(spark, path) == [7] and "batch=3" not in list_folder(spark, path)


# ------------------------------------------------------------------- live tables


def scored(spark, rows):
    return spark.createDataFrame(rows, "airline string, arr_delay double, pred_delayed double, p_delayed double")


def test_live_tables_follow_commits(spark, monkeypatch):
    predictions, state, ckpt = (work_dir(spark, f"t_live_{k}") for k in range(3))
    read = []
    real = J.read_committed
    monkeypatch.setattr(J, "read_committed", lambda s, path, batches, *a: (path == predictions and read.extend(c.batch for c in batches)) or real(s, path, batches, *a))

    def drain():
        read.clear()
        J.run_live_tables(spark, predictions, state, ckpt)
        seen = sorted(read)
        rows = FS.read_predictions(spark, predictions)
        for live, whole in ((J.live_delay_from_state, J.live_delay_by_airline), (J.live_rate_from_state, J.live_predicted_rate)):
            assert [tuple(r) for r in live(spark, state).collect()] == [tuple(r) for r in whole(rows).collect()]
        return seen

    W.write_batch_snapshot(scored(spark, [("AA", 1.0, 0.0, 0.25), ("BB", None, None, None)]), predictions, 0)
    SN.write_version(scored(spark, [("AA", 99.0, 1.0, 1.0)]), predictions, 5)  # never committed
    assert drain() == [0]
    W.write_batch_snapshot(scored(spark, [("AA", 4.0, 1.0, 0.75), ("CC", 2.0, 0.0, 0.5)]), predictions, 1)
    W.write_batch_snapshot(scored(spark, [("BB", 8.0, 1.0, 1.0)]), predictions, 2)
    assert drain() == [1, 2]  # only the new ones
    assert drain() == []
    W.write_batch_snapshot(scored(spark, [("AA", 2.0, 0.0, 0.5)]), predictions, 1)  # a replayed micro-batch
    assert drain() == [1]
    assert {r.airline: r.n for r in J.live_delay_from_state(spark, state).collect()} == {"AA": 2, "BB": 2}


def test_live_stream_may_start_before_the_first_commit(spark):
    predictions, state, ckpt = (work_dir(spark, f"t_early_{k}") for k in range(3))
    J.run_live_tables(spark, predictions, state, ckpt)
    with pytest.raises(FS.NoInputError):
        J.live_rate_from_state(spark, state)
    W.write_batch_snapshot(scored(spark, [("AA", 1.0, 1.0, 0.5)]), predictions, 0)
    J.run_live_tables(spark, predictions, state, ckpt)
    assert J.live_rate_from_state(spark, state).select("airline", "n").first() == ("AA", 1)
    assert FS.read_predictions(spark, predictions).select(F.max("batch")).first()[0] == 0
