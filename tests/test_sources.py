"""Files, tables, parameters, rules."""

import gzip
import hashlib
import json
import uuid
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from equisite.operators import load as ld
from equisite.operators import snapshot
from equisite.operators import violations as vi
from equisite.plans import settings as cfg
from equisite.plans.session import fresh_path, materialise, setting, work_root
from equisite.sources import files
from fixtures import domain


def test_csv_comments_stay_out_and_text_stays_text(spark, tmp_path):
    path = tmp_path / "o.csv"
    path.write_text("a,b\n# whole line\n1,NA\n# another\n2,*\n")
    assert [tuple(r) for r in files.read_csv(spark, str(path), ["a", "b"], comment="#").collect()] == [("1", "NA"), ("2", "*")]


def test_published_geojson_with_multipolygon(spark, tmp_path):
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"shapeID": "p", "shapeISO": ""}, "geometry": {"type": "Polygon", "coordinates": [ring]}},
        {"type": "Feature", "properties": {"shapeID": "m", "shapeISO": ""}, "geometry": {"type": "MultiPolygon", "coordinates": [[ring], [ring, ring]]}}]}
    path = tmp_path / "x.geojson"
    path.write_text(json.dumps(doc, indent=1))
    df = files.read_geojson(spark, str(path), "shapeID:string,shapeISO:string", collection=True, whole_file=True)
    sizes = {r["shapeID"]: [len(p) for p in r["parts"]] for r in df.collect()}
    assert sizes == {"p": [1], "m": [1, 2]}


def test_append_and_fallback(spark, tmp_path):
    name = f"t_{tmp_path.name}".replace("-", "_")
    spark.sql(f"CREATE TABLE {name} (k INT) USING parquet LOCATION '{tmp_path}/{name}'")
    one = spark.range(3).select(F.col("id").cast("int").alias("k"))
    files.append_table(one, name)
    files.append_table(one, name)
    assert spark.table(name).count() == 6
    assert {r[0] for r in files.table_or_snapshot(spark, name, "/nowhere").select("source_kind").collect()} == {"table"}
    spark.sql(f"DROP TABLE {name}")
    with pytest.raises(RuntimeError):
        files.table_or_snapshot(spark, name, f"{tmp_path}/nothing")


def test_absent_property_is_found(spark, tmp_path):
    path = tmp_path / "features.json"
    path.write_text("\n".join('{"type":"Feature","properties":{%s},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}}' % p
                              for p in ('"name":"a","code":1', '"name":null,"code":2', '"code":3')))
    df = files.read_geojson(spark, str(path), "name:string,code:long", keys=True)
    rules = {"required_properties": ["name", "code"]}
    assert [tuple(r) for r in files.shape_checks(df, rules).filter("check_name = 'required properties'").collect()] == [
        ("required properties", False, "1 features lack some")]
    assert files.shape_checks(df, {"required_properties": ["code"]}).filter("NOT passed").count() == 0


def test_rebuild_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "out")
    for _ in range(2):
        spark.range(5).write.mode("overwrite").parquet(path)
    assert spark.read.parquet(path).count() == 5


class FakeSession:
    """A session with a given master and checkpoint folder."""

    def __init__(self, master, folder):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = SimpleNamespace(master=master, applicationId=f"app-{master}")


def test_work_folder_follows_the_session(spark):
    assert work_root(FakeSession("yarn", "/shared/work/")) == "/shared/work"
    with pytest.raises(ValueError):
        work_root(FakeSession("yarn", None))
    local = FakeSession("local[2]", None)
    assert work_root(local) == work_root(local)
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    assert materialise(spark.range(4), "four").count() == 4


def test_missing_parameter_raises():
    with pytest.raises(KeyError):
        cfg.get_param("no_such_key")
    assert cfg.get_param("budget") == 25


def test_unknown_objective_raises(spark, small):
    from equisite.operators.index import choose_objective
    with pytest.raises(ValueError):
        choose_objective(domain(spark, small).default_score, "fastest")


def test_rules_find_and_pass(spark):
    df = spark.createDataFrame([(1, 5), (1, None), (2, 50)], "k int, v int")
    assert [tuple(r) for r in vi.unique(df, "u", ["k"]).collect()] == [("u", "1", "2 rows")]
    assert vi.holds(df, "range", "k", F.col("v") < 10, F.col("v").cast("string")).count() == 1
    assert vi.holds(df, "range", "k", F.col("v") < 10, F.col("v").cast("string"), null_passes=False).count() == 2
    w = spark.createDataFrame([("a", 1, 400_000), ("a", 2, 600_000), ("b", 1, 1)], "scheme string, indicator_id int, w_ppm long")
    ind = spark.createDataFrame([(1,), (2,)], "indicator_id int")
    assert [r["key"] for r in vi.weight_sums(w).collect()] == ["b"]
    assert [(r["key"], r["detail"]) for r in vi.weight_cover(w, ind).collect()] == [("b", "2")]
    s = spark.createDataFrame([(1, "robust", 5, 10, 3, 9), (2, "odd", 11, 10, 3, 9)],
                              "unit_id long, classification string, times_in_top_n long, draws long, times_allocated long, runs long")
    assert {r["rule"] for r in vi.sensitivity_rules(s).collect()} == {"classification known", "stability is a share"}
    a = spark.createDataFrame([(1, True, 2), (2, True, 1)], "unit_id long, is_apportioned boolean, n_sharing_parent long")
    assert [r["key"] for r in vi.apportioned_rule(a).collect()] == ["2"]


def test_modal_name_takes_the_smallest_on_ties(spark):
    rows = [("7. b",), ("7. a",), ("8. x",), ("8. y",), ("8. y",), ("200. out",)]
    parsed = ld.parse_rows(spark.createDataFrame(rows, "indicator_text string"))
    assert {tuple(r) for r in ld.modal_name(parsed).collect()} == {(7, "7. a", 2), (8, "8. y", 2)}


def test_a_load_replaces_itself_only(spark):
    name = f"loads_{uuid.uuid4().hex[:8]}"
    try:
        files.replace_loads(spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "v int, day string"), name, "day")
        files.replace_loads(spark.createDataFrame([("b", 9), ("c", 4)], "day string, v int"), name, "day")
        assert sorted(map(tuple, spark.table(name).collect())) == [(1, "a"), (4, "c"), (9, "b")]
        assert spark.conf.get(files.OVERWRITE_KEY).lower() == "static"
        files.replace_loads(spark.createDataFrame([], "v int, day string"), name, "day")
        assert spark.table(name).count() == 3
        with pytest.raises(ValueError):
            files.replace_loads(spark.createDataFrame([(1,)], "v int"), name, "day")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_snapshot_commits_last_and_notices_changes(spark, tmp_path):
    rows = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "k int, v string")
    folder = f"{tmp_path}/snap"
    done = {r["table_name"]: r["n_rows"] for r in snapshot.write_snapshot({"a": rows, "b": rows.limit(0)}, folder).collect()}
    assert done == {"a": 3, "b": 0}
    assert all(r["unchanged"] for r in snapshot.verify_snapshot(spark, folder, ["a", "b"]).collect())
    spark.createDataFrame([(2, "x"), (1, None), (2, None)], "k int, v string").write.mode("overwrite").parquet(f"{folder}/a")
    assert {r["table_name"]: r["unchanged"] for r in snapshot.verify_snapshot(spark, folder, ["a", "b"]).collect()} == {"a": False, "b": True}
    with pytest.raises(Exception):
        snapshot.write_snapshot({"a": rows}, folder)
    rows.write.parquet(f"{tmp_path}/half/a")  # lost before the commit
    with pytest.raises(RuntimeError):
        snapshot.snapshot_tables(spark, f"{tmp_path}/half")
    rows.write.parquet(f"{folder}/c")
    with pytest.raises(Exception, match="not in the snapshot"):
        snapshot.verify_snapshot(spark, folder, ["c"]).collect()


def test_fingerprint_ignores_order_and_partitions(spark):
    rows = spark.createDataFrame([(i % 7, None if i % 3 else str(i)) for i in range(100)], "k int, v string")
    one = snapshot.fingerprint(rows).head()
    assert snapshot.fingerprint(rows.repartition(5).select("v", "k")).head() == one
    assert snapshot.fingerprint(rows.unionByName(rows.limit(1))).head() != one
    swapped = spark.createDataFrame([(None, 1)], "k int, v int"), spark.createDataFrame([(1, None)], "k int, v int")
    assert snapshot.fingerprint(swapped[0]).head() != snapshot.fingerprint(swapped[1]).head()


def test_written_relations_leave_no_shuffle_files(spark):
    """What is written keeps no shuffle, and the session keeps its setting."""
    import time

    from equisite.plans.session import CLEANUP_KEY

    def shuffled():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}
    before, was = shuffled(), spark.conf.get(CLEANUP_KEY, None)
    rows = spark.range(3000).withColumn("k", F.col("id") % 100).repartition(3, "id")
    counted = materialise(rows.groupBy("k").count().repartition(3), "counted")
    until = time.monotonic() + 10  # files are removed behind the scenes
    while (left := shuffled() - before) and time.monotonic() < until:
        time.sleep(0.1)
    assert not left and spark.conf.get(CLEANUP_KEY, None) == was
    assert counted.filter("count = 30").count() == 100


def test_large_files_are_hashed_by_lines(spark, tmp_path, monkeypatch):
    """Files are read in stretches between line breaks; the sums are those of their bytes, however these are laid out."""
    monkeypatch.setattr(files, "STREAMED", 8)
    noise = bytes(np.random.default_rng(2).integers(0, 256, 300_000, dtype=np.uint8))
    held = {"noise.bin": noise, "breaks.bin": b"\n" * 20, "no_break.bin": b"a" * 50, "ends.txt": b"one line\n", "windows.txt": b"one\r\ntwo\r\n\r\n",
            "mark.txt": b"\xef\xbb\xbfone\ntwo\n", "mark_only.txt": b"\xef\xbb\xbfone two", "zeros.bin": bytes(500), "short.txt": b"x\n",
            "deep/more/a+b c%20d.bin": noise[:1000] + b"\n", "deep/noise.bin": noise[::-1], "packed.csv.gz": gzip.compress(b"text\n" * 1000)}
    for name, content in held.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(content)
    told = files.file_manifest(spark, str(tmp_path))
    assert told.columns == ["filename", "bytes", "sha256"]
    wanted = sorted((n.split("/")[-1], len(c), hashlib.sha256(c).hexdigest()) for n, c in held.items())
    assert sorted(map(tuple, told.collect())) == wanted
    scanned = files.file_manifest(spark, str(tmp_path), "noise*")
    assert scanned.filter("sha256 is not null").count() == 2
    with setting(spark, "spark.sql.sources.binaryFile.maxLength", "1000"):  # a file that is one value could not be longer
        assert [r["bytes"] for r in files.file_manifest(spark, str(tmp_path), "noise*").collect()] == [300_000, 300_000]
