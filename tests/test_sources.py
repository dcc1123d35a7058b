"""Side files, keys, required fields, merging and delivery on small fixtures."""

import hashlib

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from radiolith.functions import keys
from radiolith.operators import accounting, deid, delivery, extract, integrity, merge, structural
from radiolith.schemas import INSTANCES
from radiolith.sources import objects, sidecar, sinks, stores


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "patient_id;study_date;modality;accession_number;status\nPÄ;2024-01-02;CT;;pending\nP2;2024-02-30;MR;A2;done\n",
        encoding="latin-1",
    )
    rows = sidecar.read_csv(spark, str(tmp_path / "a.csv"), delimiter=";", encoding="iso-8859-1").orderBy("status").collect()
    assert [(r["patient_id"], r["study_date"], r["accession_number"]) for r in rows] == [
        ("P2", "2024-02-30", "A2"),
        ("PÄ", "2024-01-02", None),
    ]
    with pytest.raises(AnalysisException):
        sidecar.read_csv(spark, str(tmp_path / "none.csv")).count()


@pytest.mark.parametrize("text, rows", [('{"patient_id": "P1"}', 1), ('[{"patient_id": "P1"}, {"patient_id": "P2"}]', 2)])
def test_json(spark, tmp_path, text, rows):
    (tmp_path / "a.json").write_text(text)
    found = sidecar.read_json(spark, str(tmp_path)).select("patient_id").collect()
    assert sorted(r[0] for r in found) == ["P1", "P2"][:rows]


def test_malformed_json(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"patient_id": ')
    kept = sidecar.read_json(spark, str(tmp_path)).first()
    assert kept["patient_id"] is None and kept["_corrupt_record"]
    with pytest.raises(Exception):
        sidecar.read_json(spark, str(tmp_path), mode="FAILFAST").collect()


XML = """<imaging_study><patient id="P1"><name> Jane </name><dob></dob></patient>
<study uid="1.2" date="20230615"><description>Scan</description><series><item number="1">one</item></series></study>
<acquisition><kvp>120</kvp></acquisition></imaging_study>"""


def test_xml(spark, tmp_path):
    (tmp_path / "a.xml").write_text(XML)
    row = sidecar.read_xml(spark, str(tmp_path)).first()
    assert row["patient"].asDict() == {"_id": "P1", "name": "Jane", "dob": None}
    assert [(i["_VALUE"], i["_number"]) for i in row["study"]["series"]["item"]] == [("one", 1)]
    assert row["acquisition"]["kvp"] == 120.0
    text = spark.createDataFrame([(XML,)], "x string")
    legacy = text.select(sidecar.parse_xml(F.col("x"), legacy_leaf_attrs=True).alias("r")).first()["r"]
    assert legacy["study"]["series"]["item"] == ["one"]


@pytest.mark.parametrize(
    "uri, key",
    [
        ("s3://bucket/a/b.dcm", "a/b.dcm"),
        ("a/b.dcm", "a/b.dcm"),
        ("s3://bucket", "s3://bucket"),
        ("s3://bucket/", ""),
    ],
)
def test_key_of(spark, uri, key):
    assert spark.createDataFrame([(uri,)], "u string").select(keys.key_of(F.col("u"))).first()[0] == key


def test_arrivals(spark):
    body = (
        '{"Records":[{"s3":{"bucket":{"name":"b"},"object":{"key":"my+scan%281%29.dcm","size":3}}},'
        '{"s3":{"bucket":{"name":"b"},"object":{"key":"100%.dcm"}}},{"s3":{"bucket":{"name":"b"},"object":{"key":"x.txt"}}}]}'
    )
    found = objects.arrivals(spark.createDataFrame([(body,), ("{}",)], "body string")).collect()
    assert [(r["key"], r["size"]) for r in found] == [("my scan(1).dcm", 3), ("100%.dcm", None)]


def test_structural(spark):
    def row(**tags):
        base = dict(SOPInstanceUID="1", StudyInstanceUID="1", SeriesInstanceUID="1", Modality="CT", Rows=64, Columns=64, has_pixel_data=True)
        return tuple({**base, **tags}.get(n) for n in INSTANCES.names)

    frame = spark.createDataFrame(
        [row(path="1"), row(path="2", Rows=32, Columns=32), row(path="3", Modality="ZZ"), row(path="4", Rows=0, Modality=None, has_pixel_data=None)],
        INSTANCES,
    )
    found = {r["path"]: r for r in structural.structural_check(frame).collect()}
    assert (found["1"]["errors"], found["1"]["warnings"]) == ([], [])
    assert found["2"]["warnings"] == ["Image dimensions (32x32) are unusually small"] and found["2"]["is_valid"]
    assert found["3"]["warnings"] == ["Modality 'ZZ' may not be fully supported"] and found["3"]["is_valid"]
    assert found["4"]["errors"] == ["Missing required tag: Modality"] and not found["4"]["is_valid"]
    assert found["4"]["warnings"] == ["Image dimensions not found", "No pixel data found"]


def test_required_fields(spark):
    frame = spark.createDataFrame([("x", "", None, [], ["a"])], "a string, b string, c string, d array<string>, e array<string>")
    row = extract.required_fields(frame, ["e", "d", "c", "b", "a", "z"]).first()
    assert row["missing_fields"] == ["d", "c", "b", "z"] and row["present_fields"] == ["e", "a"] and not row["is_valid"]


def test_merge_overrides_by_presence(spark):
    primary = spark.createDataFrame([(1, "CT", "x"), (2, "MR", "y"), (2, "MR", "y")], "id int, modality string, note string")
    side = spark.createDataFrame([(2, "XR", "a"), (2, None, "new")], "id int, modality string, extra string")
    merged = merge.merge_metadata(primary, [(side, "extra")], ["id"]).orderBy("id").collect()
    assert [tuple(r) for r in merged] == [(1, "CT", "x", None), (2, None, "y", "new"), (2, None, "y", "new")]


def test_existence_with_a_hot_key(spark):
    """A third of all requests asks for one key; the join sees it once."""
    requests = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("object_key")
    )
    listing = spark.createDataFrame([("hot", 1), ("k1", 1)], "key string, size long")
    checked = integrity.check_exists(requests, listing)
    assert checked.count() == 20_001 and checked.where("object_exists").count() == 2
    ok, refused = delivery.batch_grants(requests, listing, "b")
    assert (ok.count(), refused.count()) == (2, 19_999)


def test_verify_transfer_is_null_safe(spark):
    listing = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y"), ("d", 1, None)], "key string, size long, etag string")
    copies = spark.createDataFrame([("a", "x"), ("b", "z"), ("c", "x"), ("d", None)], "key string, checksum string")
    found = {r["key"]: r["checksum_verified"] for r in integrity.verify_transfer(copies, listing).collect()}
    assert found == {"a": True, "b": False, "c": False, "d": False}


def test_studies_are_numbered_into_documents(spark):
    files = spark.range(5_000).select(
        F.lit("P").alias("patient_id"),
        F.when(F.col("id") < 4_000, "1.big").otherwise(F.concat(F.lit("1."), (F.col("id") % 100).cast("string"))).alias("study_instance_uid"),
        F.format_string("%05d", F.col("id") % 4_990).alias("file_path"),  # ten paths come twice
        F.lit(1).cast("long").alias("file_size"),
        F.md5(F.col("id").cast("string")).alias("checksum"),
    ).repartition(7)
    rows = delivery.manifest_documents(files, F.lit("2025-01-01T00:00:00Z"), max_files=30).collect()
    big = sorted((r for r in rows if r["study_instance_uid"] == "1.big"), key=lambda r: r["part"])
    assert [r["part"] for r in big] == list(range(134)) and {r["parts"] for r in big} == {134}
    assert [r["part_files"] for r in big] == [30] * 133 + [10]
    paths = [f["file_path"] for r in big for f in r["files"]]
    assert paths == sorted(paths) and len(paths) == 4_000
    assert sum(r["part_size_bytes"] for r in rows) == 5_000 and max(r["part_files"] for r in rows) == 30
    empty = delivery.manifest_documents(files.limit(0), F.lit("x"), max_files=30)
    assert empty.count() == 0


def test_manifest_ids_keep_pairs_apart(spark):
    pairs = [("a|b", "c"), ("a", "b|c"), (None, "a"), ("a", None), ("", "a")]
    frame = spark.createDataFrame(pairs, "patient_id string, study_instance_uid string")
    assert frame.select(delivery.manifest_id().alias("m")).distinct().count() == len(pairs)


def test_small_values_raise_an_alarm(spark):
    points = spark.sql("SELECT timestamp '2024-01-01 00:00:00' AS ts, 'n' AS namespace, 'error' AS name, 4e-7D AS value FROM range(2)")
    raised = accounting.alarms(accounting.metric_rollup(points)).collect()
    assert [r["total"] for r in raised] == [8e-7]


def test_quoted_line_break_is_one_record(spark, tmp_path):
    (tmp_path / "a.csv").write_text('patient_id,study_date,modality,status\n"P\n1",2024-01-01,CT,pending\n')
    rows = sidecar.read_csv(spark, str(tmp_path), T.StructType([T.StructField(n, T.StringType()) for n in ("patient_id", "study_date", "modality", "status")])).collect()
    assert [r["patient_id"] for r in rows] == ["P\n1"]


def test_tags_keyed_by_number_are_removed(spark):
    frame = spark.sql("SELECT map('0010,0010', 'Doe', 'PatientName', 'Doe', '0018,0015', 'CHEST') AS tags")
    assert deid.remove_tags(frame).first()["tags"] == {"0018,0015": "CHEST"}


def test_secure_grant_can_skip_the_check(spark):
    requests = spark.createDataFrame([("a/b.dcm",)], "object_key string")
    row = delivery.secure_grants(requests, None, "bucket", validate_exists=False, issued_at="2025-01-01 00:00:00").first()
    assert row["grant"]["response_content_disposition"] == 'attachment; filename="b.dcm"'
    assert row["grant"]["response_content_type"] == "application/dicom" and row["grant"]["expires_in"] == 3600


def test_events_get_the_upload_before_them(spark):
    """Against a plain search; one key holds half of all rows, over many days."""
    import random

    pick = random.Random(1)
    moments = lambda n: [(pick.choice(["hot", "hot", "a", "b", None]), pick.choice([None] + [3600 * h for h in range(400)]), i) for i in range(n)]
    uploads, events = moments(150), moments(400)
    frame = lambda rows, name: spark.createDataFrame(rows, f"key string, s long, {name} long").selectExpr("key", "timestamp_seconds(s) AS at", name)
    got = {r["event"]: r["version"] for r in merge.as_of(frame(events, "event"), frame(uploads, "version"), ["key"]).collect()}
    for key, at, number in events:
        before = [(s, v) for k, s, v in uploads if k is not None and s is not None and k == key and at is not None and s <= at]
        assert got[number] == (max(before)[1] if before else None)
    assert len(got) == 400 and merge.as_of(frame(events, "event"), frame([], "version"), ["key"]).where("version is not null").count() == 0


def test_two_uploads_that_fail_one_stage_each_never_succeed(spark):
    rows = [("k", v, s, status, 1) for v, bad in (("v1", "ingestion"), ("v2", "validation")) for s, (good, wrong) in accounting.STAGE_STATUS.items() for status in [wrong if s == bad else good]]
    rows += [("again", "v", "ingestion", "failed", 1), ("again", "v", "ingestion", "success", 2), ("again", "v", "validation", "valid", 1), ("again", "v", "deidentification", "success", 1)]
    rows += [("tie", "v", "ingestion", "success", 1), ("tie", "v", "ingestion", "failed", 1)]
    stacked = spark.createDataFrame(rows, "key string, version string, stage string, status string, attempt int")
    found = {(r["key"], r["version"]): r["status"] for r in accounting.stacked_results(stacked).collect()}
    assert found == {("k", "v1"): "FAILED", ("k", "v2"): "FAILED", ("again", "v"): "SUCCESS", ("tie", "v"): "FAILED"}
    stages = [stacked.where(F.col("stage") == s) for s in accounting.STAGE_STATUS]
    assert sorted(accounting.pipeline_results(*stages).collect()) == sorted(accounting.stacked_results(stacked).collect())


def test_runs_under_one_key_count_each(spark):
    wide = spark.createDataFrame([("k", "v1", 1, True, True, True), ("k", "v2", 1, True, False, True), ("k", "v2", 2, True, True, True)], "key string, version string, attempt int, ingestion boolean, validation boolean, deidentification boolean")
    found = {r["metric_name"]: r["count"] for r in accounting.handler_outcomes(wide).collect()}
    assert found == {"IngestionSuccess": 3, "ValidationSuccess": 2, "ValidationFailure": 1, "DeidentificationSuccess": 3, "PipelineSuccess": 2}


def test_folders_are_a_closed_set(spark, tmp_path):
    judged = spark.range(3000).select(
        F.element_at(F.array(*[F.lit(m) for m in ("CT", "a/b", "..", "mr", "")]), (F.col("id") % 5 + 1).cast("int")).alias("modality"),
        F.col("id").cast("string").alias("path"), F.lit("P").alias("patient_id"), F.lit("1").alias("study_instance_uid"),
        F.lit(True).alias("is_valid"), F.lit("").alias("error_codes"),
    ).repartition(40)
    sinks.write_validated(judged, str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == ["modality_group=CT", "modality_group=MR", "modality_group=OTHER"]
    assert len(list((tmp_path / "out").rglob("part-*.parquet"))) <= 3 + 8
    kept = spark.read.parquet(str(tmp_path / "out")).groupBy("modality").count().collect()
    assert {r["modality"]: r["count"] for r in kept} == {"CT": 600, "A/B": 600, "..": 600, "MR": 600, "": 600}


def test_tree_is_listed_level_by_level(spark, tmp_path):
    for name in ("a.txt", "x/b.txt", "x/y/z/c.txt", "x/y/d.bin", "empty/.hidden"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    (tmp_path / "nothing").mkdir()
    found = objects.object_listing(spark, str(tmp_path), with_etag=True).collect()
    assert sorted((r["key"], r["size"]) for r in found) == sorted((n, len(n)) for n in ("a.txt", "x/b.txt", "x/y/z/c.txt", "x/y/d.bin", "empty/.hidden"))
    assert {r["etag"] for r in found if r["key"] == "a.txt"} == {hashlib.md5(b"a.txt").hexdigest()}
    assert objects.object_listing(spark, f"file://{tmp_path}", pattern="*.txt").count() == 3
    assert objects.object_listing(spark, str(tmp_path / "nothing")).count() == 0
    assert stores.list_tree(spark, str(tmp_path / "a.txt")).count() == 1
    with pytest.raises(AnalysisException):
        stores.list_tree(spark, str(tmp_path / "none"))


def test_objects_stay_below_their_root(spark, tmp_path):
    rows = spark.createDataFrame([("a/b.bin", b"12"), ("c", None)], "key string, content binary")
    assert sorted(map(tuple, stores.put_objects(rows, str(tmp_path / "o")).collect())) == [("a/b.bin", 2), ("c", 0)]
    assert (tmp_path / "o" / "a" / "b.bin").read_bytes() == b"12"
    for key in ("../x", "a/../../x", "", "/abs"):
        with pytest.raises(Exception, match="not a key"):
            stores.put_objects(spark.createDataFrame([(key, b"")], "key string, content binary"), str(tmp_path / "o"))


def test_notifications_that_come_twice(spark, tmp_path):
    schema = "bucket string, key string, version string, event_time timestamp, n long"
    for _ in range(2):
        spark.range(50).selectExpr("'b' AS bucket", "'k' || id % 10 AS key", "'v' || id % 5 AS version", "timestamp_seconds(id) AS event_time", "id AS n").write.mode("append").parquet(str(tmp_path / "in"))
        read = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        stream = objects.distinct_arrivals(read).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        stream.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 10 == objects.distinct_arrivals(spark.read.parquet(str(tmp_path / "in"))).count()


def test_files_of_manifest_documents_move_without_their_digest(spark, monkeypatch, tmp_path):
    rows = [(p, s, f"raw/{n}.dcm", n, "c" * 32) for p, s in (("P1", "1.2"), (None, "1.2"), ("", "1.2"), ("-", None)) for n in range(5)]
    files = spark.createDataFrame(rows, "patient_id string, study_instance_uid string, file_path string, file_size long, checksum string")
    monkeypatch.setattr(delivery, "shared_dir", lambda *_: str(tmp_path / "ranges"))
    documents = delivery.manifest_documents(files, F.lit("x"), max_files=2).collect()
    found = sorted((str(d["patient_id"]), str(d["study_instance_uid"]), d["part"], d["parts"], d["part_files"]) for d in documents)
    pairs = sorted((str(p), str(s)) for p, s in (("P1", "1.2"), (None, "1.2"), ("", "1.2"), ("-", None)))
    assert found == [(*pair, part, 3, size) for pair in pairs for part, size in ((0, 2), (1, 2), (2, 1))]
    assert "manifest_id" not in spark.read.parquet(str(tmp_path / "ranges")).columns
    ids = {r["manifest_id"] for r in delivery.manifest_headers(files, F.lit("x")).collect()}
    assert {d["manifest_id"] for d in documents} == ids and len(ids) == 4
