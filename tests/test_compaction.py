from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from fieldsync.sources import compaction, outbox, runlog
from fieldsync.sources.clustered import point_scan, write_clustered

TABLE = "install_outbox"


def messages(spark, first, last, kind=106):
    node = (F.col("id") % 50).cast("int").alias("distnid")
    return spark.range(first, last).select(node, F.format_string('{"serialNumber": "MT%d"}', "id").alias("request"), F.lit(kind).alias("type_id"))


def append(spark, make, path, name, first, last, **kwargs):
    return outbox.append_run(messages(spark, first, last, **kwargs), TABLE, path, name, "id", make(TABLE))


def rows(frame):
    return sorted((r["id"], r["run_id"], r["distnid"], r["request"], r["type_id"]) for r in frame.collect())


def scanned(frame):
    """Rows that the scan of a frame without exchanges gave its filter."""
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def test_the_same_messages_in_few_files(spark, make, tmp_path):
    path = str(tmp_path / "o")
    assert not outbox.compact(spark, path, TABLE, "id")
    for i in range(6):
        append(spark, make, path, f"r{i}", 20 * i, 20 * i + 20, kind=105 + i % 2)
    before = outbox.read_outbox(spark, path, TABLE)
    wanted = rows(before)
    assert len(wanted) == 120
    assert outbox.compact(spark, path, TABLE, "id", file_rows=1000)
    assert not outbox.compact(spark, path, TABLE, "id")
    after = outbox.read_outbox(spark, path, TABLE)
    assert rows(after) == wanted and len(after.inputFiles()) == 1
    assert {r["serial_number"] for r in after.collect()} == {f"MT{i}" for i in range(120)}
    assert rows(before) == wanted  # who read before still finds the files
    append(spark, make, path, "late", 500, 510)
    assert outbox.read_outbox(spark, path, TABLE).count() == 130


def test_segments_halve_and_runs_stay_known(spark, make, tmp_path):
    """Rows are rewritten a logarithmic number of times; reruns and unique keys work on cleared runs."""
    path = str(tmp_path / "o")
    for i in range(8):
        append(spark, make, path, f"r{i}", 10 * i, 10 * i + 10)
        outbox.compact(spark, path, TABLE, "id")
        sizes = [s["rows"] for s in compaction.manifest(spark, path)["segments"]]
        assert sum(sizes) == 10 * (i + 1) and all(a > b for a, b in zip(sizes, sizes[1:]))
    wanted = rows(outbox.read_outbox(spark, path, TABLE))
    assert compaction.clear(spark, path) and not compaction.clear(spark, path)
    assert not list(tmp_path.glob("o/_runs/run_id=*/attempt=*")) and len(list(tmp_path.glob("o/_segments/*"))) == len(sizes)
    assert rows(outbox.read_outbox(spark, path, TABLE)) == wanted
    again = append(spark, make, path, "r3", 0, 5).written
    assert sorted(r["request"] for r in again.collect()) == sorted(w[3] for w in wanted if w[1] == "r3")
    more = outbox.append_run(messages(spark, 45, 60).where("distnid >= 45"), TABLE, path, "new", "id", make(TABLE), unique=[["distnid"]]).written
    assert more.isEmpty()
    assert len(wanted) == outbox.read_outbox(spark, path, TABLE).count() == 80


def test_two_compactions_at_once(spark, make, tmp_path):
    path = str(tmp_path / "o")
    for i in range(2):
        append(spark, make, path, f"r{i}", 10 * i, 10 * i + 10)
    with ThreadPoolExecutor(2) as pool:
        won = list(pool.map(lambda _: outbox.compact(spark, path, TABLE, "id"), range(2)))
    assert sum(won) == 1 and len(list(tmp_path.glob("o/_segments/*"))) == 1
    assert outbox.read_outbox(spark, path, TABLE).count() == 20


def test_a_run_between_reading_and_the_manifest(spark, make, tmp_path, monkeypatch):
    """It is neither lost nor put in twice."""
    path, claim, others = str(tmp_path / "o"), runlog.claim, []
    append(spark, make, path, "r0", 0, 10)

    def late(session, folder, number, content):
        if folder.endswith("_compacted") and not others:
            others.append(True)
            append(session, make, path, "r1", 10, 20)
        return claim(session, folder, number, content)

    monkeypatch.setattr(runlog, "claim", late)
    assert outbox.compact(spark, path, TABLE, "id")
    assert sorted(r["request"] for r in outbox.read_outbox(spark, path, TABLE).collect()) == sorted(f'{{"serialNumber": "MT{i}"}}' for i in range(20))
    assert compaction.manifest(spark, path)["upto"] == 1


def test_type_and_node_skip_files(spark, make, tmp_path):
    path = str(tmp_path / "o")
    for i, kind in enumerate((105, 106, 108)):
        append(spark, make, path, f"r{i}", 1000 * i, 1000 * i + 1000, kind=kind)
    outbox.compact(spark, path, TABLE, "id", file_rows=250)
    log = outbox.read_outbox(spark, path, TABLE)
    few = spark.read.schema(log.schema).parquet(*log.inputFiles()).where("type_id = 106 and distnid = 7")
    assert few.count() == 20 and scanned(few) <= 600


def test_point_scan_reads_few_row_groups(spark, tmp_path):
    """A few wanted ids spread over all ranges read the row groups that may hold them; many ids are joined."""
    path = str(tmp_path / "t")
    table = spark.range(20_000).select((F.col("id") * 1_000_003 % 20_011).alias("k"), "id")
    write_clustered(table, path, ["k"], 20_000, ["k"], file_rows=500)
    rows = spark.read.parquet(path)
    wanted = spark.createDataFrame([(k,) for k in (5, 9_000, 19_990, 9_000, None, -1)], "k long")
    few = point_scan(rows, wanted, "k")
    assert sorted(r["k"] for r in few.collect()) == sorted(r["k"] for r in rows.where("k in (5, 9000, 19990)").collect()) != []
    assert scanned(point_scan(rows, wanted, "k")) < 4_000
    many = point_scan(rows, rows.select("k").limit(50), "k", at_most=10)
    assert many.count() == 50 and "LeftSemi" in many._jdf.queryExecution().toString()
    assert point_scan(rows, wanted.limit(0), "k").count() == 0
