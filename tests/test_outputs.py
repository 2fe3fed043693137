"""Results, records, series and the whole run on disk."""

import os
import subprocess
import sys
import time
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidewatt import ELECTRICITY
from tidewatt.ingest import MissingReadings
from tidewatt.jobs import kept, run_pipeline, run_query, store_records, together
from tidewatt.operators.series import single_series, split_series
from tidewatt.scratch import scratch_dir
from tidewatt.sinks.records import RecordLayout, flat_records, hash_records, upsert_records
from tidewatt.sinks import store as record_store
from tidewatt.sinks.results import merge_csv, new_run_id, write_ordered_csv, write_result, write_single_csv
from tidewatt.sinks.store import RecordStore, key_hash
from tidewatt.sources.files import discover_sources, latest_result, read_result
from tidewatt.sources.readings import as_readings

HEADER = "datetime,country_code,carbon_intensity_direct,cfe_percent"
LABELS = {"IT": "Italy", "SE": "Sweden"}


@pytest.fixture(scope="module")
def raw_files(tmp_path_factory):
    """Two countries and two years, every 7 hours."""
    folder = tmp_path_factory.mktemp("raw")
    for country, base in (("IT", 280.0), ("SE", 4.0)):
        for year in (2021, 2022):
            start, lines = datetime(year, 1, 1), [HEADER]
            for step in range(0, 365 * 24, 7):
                at = start + timedelta(hours=step)
                carbon = base + step % 24 + year - 2021 + step / 8760
                lines.append(f"{at},{country},{carbon:.2f},{40 + step % 50}")
            (folder / f"{country}_{year}_hourly.csv").write_text("\n".join(lines) + "\n")
    return folder


def result(spark, rows=((2021, "IT", 1.5), (2022, "IT", 10000000.0))):
    return spark.createDataFrame(list(rows), "year int, country string, `carbon-mean` double")


def test_result_round_trip_and_no_overwrite(spark, tmp_path):
    table = result(spark)
    path = write_result(table, str(tmp_path), "q1", "df", "20250101000000")
    assert Path(path).name == "q1_df_20250101000000"
    assert read_result(spark, path, table.schema, ["year"]).sort("year").collect() == table.collect()
    with pytest.raises(Exception, match="exists"):
        write_result(table, str(tmp_path), "q1", "df", "20250101000000")
    with pytest.raises(ValueError):
        write_result(table, str(tmp_path), "q1", "df", "today")
    assert len(new_run_id()) == 14


def test_reading_back_leaves_out_headers_blanks_and_short_rows(spark, tmp_path):
    (tmp_path / "part-0.csv").write_text(
        "year,country,carbon-mean\n2021,IT,1.5\n\nyear,country,carbon-mean\n2022,IT\n"
        "2023,IT,\n2024,IT,2.5,extra\n,IT,1\n"
    )
    found = read_result(spark, str(tmp_path), result(spark).schema, ["year"])
    assert sorted(map(tuple, found.collect())) == [
        (2021, "IT", 1.5), (2023, "IT", None), (2024, "IT", 2.5),
    ]
    assert found.select("year").count() == 3


def test_latest_run_matches_the_whole_name(spark, tmp_path):
    base = str(tmp_path)
    for run in ("20250101000000", "20250301000000"):
        write_result(result(spark), base, "q2", "df", run)
    write_result(result(spark), base, "q2", "df", "20250401000000", "all")
    assert latest_result(spark, base, "q2", "df").endswith("/q2_df_20250301000000")
    assert latest_result(spark, base, "q2", "df", "all").endswith("/q2_df_all_20250401000000")
    for query in ("q1", "q2_df"):
        with pytest.raises(FileNotFoundError):
            latest_result(spark, base, query, "sql")


def test_an_unfinished_run_is_not_read(spark, tmp_path):
    done = write_result(result(spark), str(tmp_path), "q1", "df", "20250101000000")
    later = write_result(result(spark), str(tmp_path), "q1", "df", "20250102000000")
    (Path(later) / "_SUCCESS").unlink()
    assert latest_result(spark, str(tmp_path), "q1", "df") == done


@pytest.mark.parametrize("rows", [1000, 100_000, 100_001])
def test_ordered_csv(spark, tmp_path, rows):
    write_ordered_csv(spark.range(rows).repartition(4).orderBy("id"), str(tmp_path / "one"))
    files = sorted((tmp_path / "one").glob("part-*"))
    assert [x for f in files for x in f.read_text().split()[1:]] == [str(k) for k in range(rows)]
    assert len(files) == 1


def test_ordered_csv_without_adaptive_execution(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        write_ordered_csv(spark.range(1000).orderBy("id"), str(tmp_path / "many"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    files = sorted((tmp_path / "many").glob("part-*"))
    assert len(files) > 1
    assert [x for f in files for x in f.read_text().split()[1:]] == [str(k) for k in range(1000)]


LAYOUT = RecordLayout(("Q1", "{country}", "{year}"), {"carbon_mean": "carbon-mean", "y": "year"})


def test_records(spark):
    rows = [(2021, "IT", 1.5), (2022, None, None), (2023, "SE", 1e7)]
    found = {r.key: r.value for r in hash_records(result(spark, rows), LAYOUT).collect()}
    assert found == {
        "Q1:IT:2021": {"carbon_mean": "1.5", "y": "2021"},
        "Q1::2022": {"carbon_mean": "", "y": "2022"},
        "Q1:SE:2023": {"carbon_mean": "1.0E7", "y": "2023"},
    }


def test_upsert_replaces_given_fields_only(spark):
    schema = "key string, value map<string,string>"
    stored = spark.createDataFrame([("a", {"x": "1", "y": "2"}), ("b", {"x": "3"})], schema)
    updates = spark.createDataFrame([("a", {"x": "9", "z": "8"}), ("c", {"x": "4"})], schema)
    found = flat_records(upsert_records(stored, updates), ["x", "y", "z"]).orderBy("key").collect()
    assert [tuple(r) for r in found] == [
        ("a", "9", "2", "8"), ("b", "3", None, None), ("c", "4", None, None),
    ]


def test_upsert_with_repeated_keys_gives_one_record_each(spark):
    schema = "key string, value map<string,string>"
    stored = spark.createDataFrame([("a", {"x": "1"}), ("a", {"x": "2"})], schema)
    updates = spark.createDataFrame([("a", {"y": "3"}), ("a", {"y": "4"})], schema)
    found = [tuple(r) for r in flat_records(upsert_records(stored, updates), ["x", "y"]).collect()]
    assert found == [("a", "2", "4")]


MAPS = "key string, value map<string,string>"


def test_records_that_come_late_are_kept(spark, tmp_path):
    newer, older = (spark.createDataFrame([(k, {"x": k})], MAPS) for k in ("b", "a"))
    store_records(spark, newer, str(tmp_path), "q1")
    path = store_records(spark, older, str(tmp_path), "q1")
    store = RecordStore(path)
    assert store.version(spark).number == 2
    assert sorted(r.key for r in store.read(spark).collect()) == ["a", "b"]
    assert [r.key for r in store.read(spark, store.version(spark, 1)).collect()] == ["b"]


def files_of(store, version):
    return {b: sorted((p.name, p.stat().st_mtime_ns) for p in Path(f).glob("part-*")) for b, f in store.folders(version).items()}


def test_an_upsert_touches_its_buckets_only(spark, tmp_path):
    keys = [f"k{n}" for n in range(60)]
    store = RecordStore(str(tmp_path / "s"), 8)
    first = store.upsert(spark.createDataFrame([(k, {"x": k, "y": "1"}) for k in keys], MAPS))
    before = files_of(store, first)
    second = store.upsert(spark.createDataFrame([("k7", {"x": "new"}), ("k7", {"x": "new"})], MAPS))
    bucket = spark.createDataFrame([("k7",)], "key string").select(key_hash(F.col("key"), 8)).first()[0]
    after = files_of(store, second)
    assert len(before) > 4 and {b for b in after if after[b] != before.get(b)} == {bucket}
    found = {r.key: r.value for r in store.read(spark).collect()}
    assert found == {k: {"x": "new" if k == "k7" else k, "y": "1"} for k in keys}
    assert {r.key: r.value["x"] for r in store.read(spark, first).collect()}["k7"] == "k7"


def test_a_crash_before_the_swap_leaves_the_old_version(spark, tmp_path, monkeypatch):
    store = RecordStore(str(tmp_path / "s"), 4)
    store.upsert(spark.createDataFrame([("a", {"x": "1"})], MAPS))
    update = spark.createDataFrame([("a", {"x": "2"})], MAPS)

    def crash(*_):
        raise RuntimeError("crash")

    with monkeypatch.context() as patch:
        patch.setattr(RecordStore, "_put", crash)
        with pytest.raises(RuntimeError):
            store.upsert(update)
    assert store.version(spark).number == 1 and store.read(spark).first().value == {"x": "1"}
    assert store.upsert(update).number == 2 and store.read(spark).first().value == {"x": "2"}


def test_of_two_upserts_from_one_version_one_fails(spark, tmp_path, monkeypatch):
    store = RecordStore(str(tmp_path / "s"), 4)
    first = store.upsert(spark.createDataFrame([("a", {"x": "1"})], MAPS))
    store.upsert(spark.createDataFrame([("a", {"x": "2"})], MAPS))
    monkeypatch.setattr(RecordStore, "version", lambda *_: first)
    with pytest.raises(Exception, match="exists"):
        store.upsert(spark.createDataFrame([("a", {"x": "3"})], MAPS))
    monkeypatch.undo()
    assert store.read(spark).first().value == {"x": "2"}
    assert sorted(p.name for p in (tmp_path / "s/versions").iterdir() if p.suffix != ".crc") == [f"{n:014d}" for n in (1, 2)]


def test_an_empty_store_and_an_empty_update(spark, tmp_path):
    store = RecordStore(str(tmp_path / "s"), 4)
    assert store.read(spark).collect() == [] and store.version(spark).number == 0
    store.upsert(spark.createDataFrame([], MAPS))
    assert store.read(spark).collect() == [] and store.version(spark).number == 1
    with pytest.raises(FileNotFoundError):
        store.version(spark, 9)
    assert RecordStore(str(tmp_path / "s"), 99).version(spark).buckets == 4
    assert record_store.BUCKETS == 64


def test_one_file_of_many_ranges(spark, tmp_path):
    """With adaptive execution off and 200 ranges: one header, the bytes of the parts."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    rows = spark.range(5000).select("id", F.concat(F.lit('é "q", \n'), "id").alias("text"))
    try:
        write_ordered_csv(rows.orderBy(F.desc("id")), str(tmp_path / "parts"))
        write_single_csv(rows.orderBy(F.desc("id")), str(tmp_path / "one.csv"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    parts = [p.read_bytes() for p in sorted((tmp_path / "parts").glob("part-*"))]
    header = b"id,text\n"
    assert len(parts) > 100 and all(p.startswith(header) for p in parts)
    assert (tmp_path / "one.csv").read_bytes() == header + b"".join(p.removeprefix(header) for p in parts)
    assert not [p for p in tmp_path.iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]


def test_a_merged_file_is_whole_or_not_there(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "part-0").write_text("a,b\n1,2\n")
    (folder / "part-1").write_text("a,c\n3,4\n")
    with pytest.raises(ValueError, match="header"):
        merge_csv(spark, str(folder), str(tmp_path / "one.csv"))
    assert not (tmp_path / "one.csv").exists()
    (folder / "part-1").write_text("a,b\n")
    (folder / "part-2").write_text("")
    (folder / "_SUCCESS").write_text("")
    merge_csv(spark, str(folder), str(tmp_path / "one.csv"))
    assert (tmp_path / "one.csv").read_text() == "a,b\n1,2\n"
    with pytest.raises(FileExistsError):
        merge_csv(spark, str(folder), str(tmp_path / "one.csv"))
    write_single_csv(spark.range(0).orderBy("id"), str(tmp_path / "none.csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "none.csv")).count() == 0


def test_outputs_at_the_same_time(spark):
    import threading

    meet = threading.Barrier(3, timeout=60)
    task = lambda k: lambda: (meet.wait(), spark.range(k).count())[1]
    assert together(spark, {str(k): task(k) for k in (1, 2, 3)}) == {"1": 1, "2": 2, "3": 3}
    seen = []
    with pytest.raises(ZeroDivisionError):
        together(spark, {"bad": lambda: 1 // 0, "good": lambda: seen.append(time.sleep(0.3))})
    assert seen == [None] and together(spark, {}) == {}


def test_a_run_with_a_missing_year_writes_no_result(spark, raw_files, tmp_path):
    run = lambda out, expected: run_pipeline(
        spark, "q1", "df", f"{raw_files}/*_hourly.csv", ELECTRICITY, str(out), LABELS, expected=expected, run_id="20250101000000"
    )
    with pytest.raises(MissingReadings, match="SE 2023, FR 2021") as error:
        run(tmp_path / "bad", {"IT": [2021], "SE": [2022, 2023], "FR": [2021]})
    assert error.value.missing == [("SE", 2023), ("FR", 2021)]
    assert [p.name for p in (tmp_path / "bad").iterdir()] == ["data"]
    counted = run(tmp_path / "good", {"IT": [2021, 2022], "SE": [2021, 2022]})
    partly = run(tmp_path / "part", {"IT": [2021]})
    read = lambda paths: sorted(map(tuple, spark.read.option("header", True).csv(paths["report"]).collect()), key=repr)
    assert read(counted) == read(partly) and len(read(counted)) == 4


def test_the_pivot_does_not_sort_what_it_reads(spark):
    yearly = result(spark).orderBy("country", "year")
    plan = split_series(yearly, ELECTRICITY, "year", "carbon-mean", LABELS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 1  # of the series itself


def test_series(spark):
    yearly = result(spark, [(2021, "IT", 1.5), (2021, "SE", 2.5), (2022, "IT", 3.5)])
    found = split_series(yearly, ELECTRICITY, "year", "carbon-mean", LABELS)
    assert found.columns == ["time", "Italy", "Sweden"]
    assert [tuple(r) for r in found.collect()] == [
        (date(2021, 1, 1), 1.5, 2.5), (date(2022, 1, 1), 3.5, None),
    ]
    months = spark.createDataFrame([("2021-02", 1.0), ("2021-01", 2.0)], "date string, cfe double")
    assert [tuple(r) for r in single_series(months, "date", "cfe", "CFE").collect()] == [
        (date(2021, 1, 1), 2.0), (date(2021, 2, 1), 1.0),
    ]
    hours = spark.createDataFrame([(7, "IT", 1.0)], "hour int, country string, cfe double")
    assert split_series(hours, ELECTRICITY, "hour", "cfe", LABELS).first()["time"] == "07:00:00"
    with pytest.raises(ValueError):
        single_series(months, "week", "cfe", "CFE")


def test_discover_sources(spark, raw_files):
    found = discover_sources(spark, f"{raw_files}/*.csv").orderBy("entity", "year").collect()
    assert [(r.entity, r.year) for r in found] == [
        ("IT", 2021), ("IT", 2022), ("SE", 2021), ("SE", 2022),
    ]
    assert all(r.bytes > 1000 for r in found)


def test_scratch_dir_is_under_the_shared_folder(spark):
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(f"{base}/tidewatt-") and first != second and not Path(first).exists()


def test_scratch_goes_with_the_session_and_needs_no_setting(tmp_path):
    """In a process of its own, without a checkpoint folder."""
    code = f"""
from pyspark.sql import SparkSession
from tidewatt.scratch import scratch_dir
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.sql.warehouse.dir", {str(tmp_path)!r}).getOrCreate())
path = scratch_dir(spark, "x")
spark.range(10).write.parquet(path)
print("WROTE", path.removeprefix("file:"), spark.read.parquet(path).count())
"""
    root = Path(__file__).resolve().parents[1]
    (tmp_path / "conf").mkdir()
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path / "conf")}
    run = subprocess.run([sys.executable, "-c", code], cwd=root, env=env, capture_output=True, text=True, timeout=120)
    _, path, count = next(line for line in run.stdout.splitlines() if line.startswith("WROTE")).split()
    assert count == "10" and path.startswith(str(tmp_path))
    for _ in range(50):  # the JVM ends a little after its driver
        if not list(tmp_path.glob("tidewatt-*")):
            break
        time.sleep(0.2)
    assert not list(tmp_path.glob("tidewatt-*"))


def test_no_machine_local_scratch():
    root = Path(__file__).resolve().parents[1] / "tidewatt"
    assert not [p for p in root.rglob("*.py") if "tempfile" in p.read_text()]


def uses_cache(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return "InMemoryTableScan" in plan or "Scan In-memory table" in plan


@pytest.mark.parametrize("face", ["df", "sql"])
@pytest.mark.parametrize("query", ["q2", "q3"])
def test_outputs_share_the_kept_table_and_it_is_released(spark, raw_files, face, query):
    source = spark.read.option("header", True).csv(str(raw_files))
    readings = as_readings(source, ELECTRICITY)

    def outputs():
        tables = run_query(spark, query, face, readings, ELECTRICITY, "IT", view="release")
        return tables, tables.outputs.values()

    tables, frames = outputs()
    with kept(spark, tables):
        assert all(uses_cache(frame) for frame in frames)
    assert not any(spark.catalog.tableExists(view) for view in tables.views)
    assert not any(uses_cache(frame) for frame in outputs()[1])
    tables, _ = outputs()
    with pytest.raises(RuntimeError), kept(spark, tables):
        raise RuntimeError
    assert not any(spark.catalog.tableExists(view) for view in tables.views)
    assert not any(uses_cache(frame) for frame in outputs()[1])


def test_two_sql_queries_do_not_share_views(spark, raw_files):
    source = as_readings(spark.read.option("header", True).csv(str(raw_files)), ELECTRICITY)
    one, two = (run_query(spark, "q2", "sql", source, ELECTRICITY, entity) for entity in ("IT", "SE"))
    assert not set(one.views) & set(two.views)


def test_what_is_asked_for_is_checked_before_anything_is_read(spark, tmp_path):
    for query, extra, message in (("q1", {"run_id": "today"}, "run id"), ("q2", {}, "entity")):
        with pytest.raises(ValueError, match=message):
            run_pipeline(spark, query, "df", "/nowhere", ELECTRICITY, str(tmp_path), LABELS, **extra)
    assert not list(tmp_path.iterdir())


def test_readings_without_an_entity_stay(spark, tmp_path):
    (tmp_path / "raw.csv").write_text(f"{HEADER}\n2021-01-01 00:00:00,,1.0,2.0\n")
    for query, kind in (("q1", "result"), ("q3", "stats")):
        paths = run_pipeline(
            spark, query, "df", str(tmp_path / "raw.csv"), ELECTRICITY, str(tmp_path / query), LABELS
        )
        text = spark.read.option("header", True).csv(paths[f"csv_{kind}"])
        assert text.filter("country IS NULL").count() == (1 if query == "q1" else 2)
        keys = {r.key for r in RecordStore(paths["records"]).read(spark).select("key").collect()}
        assert keys == ({"Q1::2021"} if query == "q1" else {"Q3::carbon-intensity", "Q3::cfe"})


@pytest.mark.parametrize("query", ["q1", "q2", "q3"])
def test_whole_run_is_the_same_by_every_face(spark, raw_files, tmp_path, query):
    seen = {}
    for face in ("df", "sql", "rdd"):
        out = tmp_path / face
        paths = run_pipeline(
            spark, query, face, f"{raw_files}/*_hourly.csv", ELECTRICITY, str(out), LABELS,
            entity="IT", run_id="20250101000000",
        )
        kinds = [k for k in paths if k not in ("data", "records", "text")]
        parts = lambda path: [path] if path.is_file() else sorted(path.glob("part-*"))
        seen[face] = {kind: [p.read_text() for p in parts(Path(paths[kind]))] for kind in kinds}
        records = RecordStore(paths["records"]).read(spark)
        seen[face]["records"] = sorted((r.key, sorted(r.value.items())) for r in records.collect())
        assert all(len(seen[face][k]) == 1 for k in kinds)
    assert seen["df"] == seen["sql"] == seen["rdd"]
    expected = {"q1": ["report", "result"], "q2": ["all", "report", "top"], "q3": ["hourly", "report", "stats"]}
    assert [k for k in sorted(seen["df"]) if not k.startswith(("csv_", "series_", "rec"))] == expected[query]


def test_second_run_updates_records(spark, raw_files, tmp_path):
    run = lambda files, run_id: run_pipeline(
        spark, "q1", "df", f"{raw_files}/{files}", ELECTRICITY, str(tmp_path), LABELS, run_id=run_id
    )["records"]
    run("*_2021_hourly.csv", "20250101000000")
    newest = run("IT_2022_hourly.csv", "20250102000000")
    keys = sorted(r.key for r in RecordStore(newest).read(spark).select("key").collect())
    assert keys == ["Q1:IT:2021", "Q1:IT:2022", "Q1:SE:2021"]


def test_unknown_query_or_face(spark, raw_files):
    source = as_readings(spark.read.option("header", True).csv(str(raw_files)), ELECTRICITY)
    for query, face in (("q4", "df"), ("q1", "scala")):
        with pytest.raises(ValueError):
            run_query(spark, query, face, source, ELECTRICITY)
    with pytest.raises(ValueError, match="entity"):
        run_query(spark, "q2", "df", source, ELECTRICITY)


def test_rows_are_unordered_safe(spark, raw_files):
    """The same answer whatever the partitioning."""
    source = as_readings(spark.read.option("header", True).csv(str(raw_files)), ELECTRICITY)
    answers = [
        run_query(spark, "q1", "df", frame, ELECTRICITY).outputs["result"].collect()
        for frame in (source, source.repartition(13), source.orderBy(F.desc("carbon")))
    ]
    assert answers[0] == answers[1] == answers[2]
