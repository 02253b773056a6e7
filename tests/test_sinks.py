from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from fieldsync.schemas import TABLES, schema
from fieldsync.sources import outbox, runlog, snapshots, staging
from fieldsync.sources.state import Superseded
from fieldsync.sources.tables import empty, read_tables


def test_defaults(make):
    rows = make("contractor_outbox", dict(contractorid=1)).select("contractorid", F.lit(102).alias("type_id"), F.lit(True).alias("inserted"))
    row = outbox.with_defaults(rows, "contractor_outbox", "api_id").first()
    assert (row["contractorid"], row["inserted"], row["updated"], row["status_created"], row["request"]) == (1, True, False, False, None)
    assert row["created_datetime"] is not None and "api_id" not in row.asDict()


def test_append_gives_dense_rising_ids(spark, make, tmp_path):
    path = str(tmp_path / "outbox")
    delta = spark.range(50).select(F.col("id").cast("int").alias("distnid"), F.lit('{"a":1}').alias("request"), F.lit(106).alias("type_id"))
    known = make("install_outbox", dict(id=100))
    first = outbox.append_run(delta.repartition(4), "install_outbox", path, "r1", "id", known).written
    assert sorted(r["id"] for r in first.collect()) == [*range(101, 151)]
    log = outbox.read_outbox(spark, path, "install_outbox")
    second = outbox.append_run(delta, "install_outbox", path, "r2", "id", log).written
    assert sorted(r["id"] for r in second.collect()) == [*range(151, 201)]
    assert outbox.read_outbox(spark, path, "install_outbox").count() == 100
    sent = outbox.returned(second).first()
    assert (sent["url"], sent["json1"], sent["codepart"]) == ("", '{"a":1}', 106)


def test_a_written_run_stays(spark, make, tmp_path):
    path = str(tmp_path / "outbox")
    delta = spark.range(50).select(F.col("id").cast("int").alias("distnid"), F.lit("{}").alias("request"))
    first = outbox.append_run(delta, "install_outbox", path, "r1", "id", make("install_outbox")).written
    again = outbox.append_run(delta.limit(0), "install_outbox", path, "r1", "id", outbox.read_outbox(spark, path, "install_outbox")).written
    assert sorted(first.collect()) == sorted(again.collect()) and outbox.read_outbox(spark, path, "install_outbox").count() == 50
    empty_run = outbox.append_run(delta.limit(0), "install_outbox", path, "r2", "id", outbox.read_outbox(spark, path, "install_outbox")).written
    assert empty_run.isEmpty()


def test_types_are_skipped_by_statistics(spark, make, tmp_path):
    path = str(tmp_path / "outbox")
    delta = spark.range(9).select(F.col("id").cast("int").alias("contractorid"), (F.col("id").cast("int") % 3 + 101).alias("type_id"))
    outbox.append_run(delta, "contractor_outbox", path, "r1", "api_id", make("contractor_outbox"))
    changed = outbox.read_outbox(spark, path, "contractor_outbox").where("type_id = 103")
    assert changed.count() == 3 and "EqualTo(type_id,103)" in changed._jdf.queryExecution().toString()


def test_long_requests_come_back(spark, make, tmp_path):
    """Refused with a reason, in the run and in its rerun, and never among the messages."""
    path = str(tmp_path / "o")
    rows = spark.range(3).select(F.col("id").cast("int").alias("distnid"), F.when(F.col("id") == 0, F.repeat(F.lit("x"), outbox.MAX_DOCUMENT + 1)).when(F.col("id") == 1, F.repeat(F.lit("é"), outbox.MAX_DOCUMENT)).alias("request"))
    for delta in (rows, rows.limit(0)):
        run = outbox.append_run(delta, "install_outbox", path, "r", "id", make("install_outbox"))
        assert sorted((r["id"], r["distnid"]) for r in run.written.collect()) == [(1, 1), (2, 2)]
        assert [(r["distnid"], len(r["request"]), r["reject_reason"]) for r in run.rejected.collect()] == [(0, outbox.MAX_DOCUMENT + 1, outbox.TOO_LONG)]
    assert outbox.read_outbox(spark, path, "install_outbox").count() == 2
    clean = outbox.append_run(rows.where("distnid = 2"), "install_outbox", path, "r2", "id", outbox.read_outbox(spark, path, "install_outbox"))
    assert clean.rejected.isEmpty() and [r["id"] for r in clean.written.collect()] == [3]


def test_long_requests_are_written_and_read_few_at_a_time(spark, make, tmp_path):
    """No row group of a run, nor of what is staged on the way, holds more than a few long requests."""
    import pyarrow.parquet as pq

    path, limit = tmp_path / "o", outbox.MAX_DOCUMENT
    request = F.concat(F.col("id").cast("string"), F.repeat(F.lit("x"), F.when(F.col("id") % 2 == 0, 2 * limit).otherwise(limit - 9).cast("int")))
    rows = spark.range(160).coalesce(1).select(F.col("id").cast("int").alias("distnid"), request.alias("request"))
    with staging.staging(spark, str(tmp_path)) as folder:
        run = outbox.append_run(rows, "install_outbox", str(path), "r", "id", make("install_outbox"))
        files = [f for f in tmp_path.rglob("*.parquet") if f.stat().st_size]
        assert {folder in str(f) for f in files} == {True, False}
        largest = max(meta.row_group(i).total_byte_size for meta in map(pq.read_metadata, files) for i in range(meta.num_row_groups))
        assert largest < 30 << 20
    assert run.written.count() == run.rejected.count() == 80


def test_landings_are_runs(spark, make, tmp_path):
    """Raw payloads are written with ids; the same run again leaves them as they are."""
    pulls = spark.createDataFrame([("a", "{}"), ("b", "[]")], "name string, payload string")
    for shaped, table, id_column in ((outbox.land_raw(pulls, "payload", "contractors"), "master_landing", "mcd_id"), (outbox.land_api(pulls, "payload", "receipt", "CRV"), "api_landing", "crvid")):
        path = str(tmp_path / table)
        for _ in range(2):
            written = outbox.append_run(shaped, table, path, "r1", id_column, make(table)).written
            assert sorted((r[id_column], r["details"]) for r in written.collect()) in ([(1, "[]"), (2, "{}")], [(1, "{}"), (2, "[]")])
        more = outbox.append_run(shaped, table, path, "r2", id_column, outbox.read_outbox(spark, path, table)).written
        assert sorted(r[id_column] for r in more.collect()) == [3, 4] and outbox.read_outbox(spark, path, table).count() == 4


def _messages(spark, first, last):
    return spark.range(first, last).select(F.col("id").cast("int").alias("distnid"), F.lit("{}").alias("request"))


def test_log_numbers_are_claimed_once(spark, tmp_path):
    log = str(tmp_path / "log")
    assert runlog.head(spark, log) == 0 and runlog.entries(spark, log) == []
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: runlog.claim(spark, log, 1, {"by": i}), range(8)))
    assert sum(won) == 1 and runlog.entries(spark, log) == [{"by": won.index(True), "entry": 1}]
    assert not list(tmp_path.glob("log/.draft-*"))
    with ThreadPoolExecutor(8) as pool:
        firsts = list(pool.map(lambda n: runlog.claim_range(spark, str(tmp_path / "ids"), n, 100), range(1, 9)))
    ranges = [i for n, first in enumerate(firsts, 1) for i in range(first, first + n)]
    assert sorted(ranges) == [*range(101, 137)]


def test_a_run_that_gets_in_between(spark, make, tmp_path, monkeypatch):
    """The later claimant looks again: what the other run wrote since falls, ids stay unique, nobody sees it before its entry."""
    path = str(tmp_path / "outbox")
    nothing, claim, others = make("install_outbox"), runlog.claim, []

    def late(session, folder, number, content):
        if folder.endswith("_log") and not others:
            others.append(True)
            assert outbox.read_outbox(session, path, "install_outbox").isEmpty()
            outbox.append_run(_messages(session, 30, 60), "install_outbox", path, "other", "id", nothing)
        return claim(session, folder, number, content)

    monkeypatch.setattr(runlog, "claim", late)
    run = outbox.append_run(_messages(spark, 0, 50).repartition(3), "install_outbox", path, "one", "id", nothing, unique=[["distnid"]])
    assert sorted(r["distnid"] for r in run.written.collect()) == [*range(30)]
    log = outbox.read_outbox(spark, path, "install_outbox").collect()
    assert {r["distnid"]: r["run_id"] for r in log} == {i: "one" if i < 30 else "other" for i in range(60)}
    assert len(log) == len({r["id"] for r in log}) == 60
    assert len(list(tmp_path.glob("outbox/_runs/run_id=*/attempt=*"))) == 2
    seen = outbox.log_head(spark, path)
    assert seen == 2
    more = outbox.append_run(_messages(spark, 55, 65), "install_outbox", path, "more", "id", nothing, unique=[["distnid"]])
    assert sorted(r["distnid"] for r in more.written.collect()) == [*range(60, 65)]
    told = outbox.append_run(_messages(spark, 0, 2), "install_outbox", path, "trusting", "id", nothing, unique=[["distnid"]], seen=outbox.log_head(spark, path))
    assert told.written.count() == 2


def test_one_run_id_twice_at_once(spark, make, tmp_path):
    path = str(tmp_path / "outbox")
    nothing = make("install_outbox")
    with ThreadPoolExecutor(2) as pool:
        runs = list(pool.map(lambda _: outbox.append_run(_messages(spark, 0, 20), "install_outbox", path, "same", "id", nothing).written.collect(), range(2)))
    assert sorted(runs[0]) == sorted(runs[1]) and len(runs[0]) == 20
    assert outbox.read_outbox(spark, path, "install_outbox").count() == 20


def test_acknowledgements(make):
    log = make("install_outbox", dict(id=1, status=False), dict(id=2, status=False, response="old"), dict(id=3, status=False))
    told = make("acknowledgement", dict(seq=1, message_id=1, status=False, response="busy"), dict(seq=2, message_id=1, status=True, response="done"), dict(seq=3, message_id=2, status=True))
    got = {r["id"]: (r["status"], r["response"]) for r in outbox.acknowledged(log, told, "id").collect()}
    assert got == {1: (True, "done"), 2: (True, "old"), 3: (False, None)}


def test_serial_of_the_request(make):
    log = make("install_outbox", dict(id=1, request='{"serialNumber": "A"}')).drop("serial_number")
    assert outbox.with_serial(log).first()["serial_number"] == "A"
    kept = make("install_outbox", dict(id=1, request='{"serialNumber": "A"}'), dict(id=2, request='{"serialNumber": "A"}', serial_number="B"))
    assert {r["id"]: r["serial_number"] for r in outbox.with_serial(kept).collect()} == {1: "A", 2: "B"}


def test_landings(spark):
    raw = spark.createDataFrame([("{}",)], "body string")
    assert outbox.land_raw(raw, "body", "pull").first()["activity_type"] == "pull"
    landed = outbox.land_api(raw, "body", "serialized", "CRV").first()
    assert (landed["details"], landed["type"], landed["wh_activity"], landed["status"]) == ("{}", "serialized", "CRV", False)


def test_snapshots_switch_versions(spark, make, tmp_path):
    root = str(tmp_path / "stock")
    assert snapshots.read_snapshot(spark, root, "stock").count() == 0
    assert snapshots.write_snapshot(make("stock", dict(stock_rid=1)), root) == 1
    assert snapshots.write_snapshot(make("stock", dict(stock_rid=1), dict(stock_rid=2)), root) == 2
    assert snapshots.read_snapshot(spark, root, "stock").count() == 2
    assert snapshots.read_snapshot(spark, root, "stock", 1).count() == 1
    for version in (2, 4):  # taken, and not the next one
        with pytest.raises(Superseded):
            snapshots.write_snapshot(make("stock"), root, version)
    assert snapshots.read_snapshot(spark, root, "stock").count() == 2 and snapshots.current_version(spark, root) == 2


class _Session:
    """Just enough of a session to tell a checkpoint folder and a master."""

    def __init__(self, master, folder):
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})()
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: folder if key == "spark.checkpoint.dir" else default)})()


def test_staging_uses_the_named_folder(spark):
    assert staging.staging_root(_Session("yarn", "hdfs:///shared")) == "hdfs:///shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.staging_root(_Session("yarn", None))
    root = staging.staging_root(spark)
    staged = staging.stage(spark.range(3), "numbers")
    assert staged.count() == 3 and all(root in f for f in staged.inputFiles())


def test_staging_scope(spark, tmp_path):
    with staging.staging(spark, str(tmp_path)) as folder:
        staged = staging.stage(spark.range(3), "numbers")
        assert all(folder in f for f in staged.inputFiles())
        assert staged.count() == 3
    assert not list(tmp_path.glob("*/scope-*"))


def test_every_schema_is_declared_and_read(spark, make, tmp_path):
    for table in TABLES:
        assert empty(spark, table).schema == schema(table)
    make("users", dict(userid=1)).write.parquet(str(tmp_path / "users"))
    assert read_tables(spark, str(tmp_path), ["users"])["users"].count() == 1
