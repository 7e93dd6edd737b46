"""Versioned tables: patches, upserts, refreshes and indexes, with crashes, replays and file names."""

import json
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import Window, functions as F

from marketlens.catalog.fixture import AS_OF, Fixture
from marketlens.operators import search_index, store, versioned
from marketlens.operators.rows import first_per_key
from marketlens.operators.versioned import PIECE, ChangedMeanwhile, VersionedTable, families
from marketlens.plans import refresh, search
from marketlens.plans.refresh import Tables
from marketlens.plans.views import bi_export
from marketlens.schemas import JOBS_FEATURES, JOBS_RAW
from marketlens.streaming import ingest

COLUMNS = "job_id string, n int"


@pytest.fixture(scope="module")
def fx(spark):
    return Fixture(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def postings(fx):
    raw = first_per_key(fx.raw, ["job_id"], ["id"])
    absent = [f for f in JOBS_RAW.fields if f.name not in raw.columns]
    return raw.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent}).select(*JOBS_RAW.names)


def numbers(spark, low, high, add=0):
    return spark.range(low, high, numPartitions=3).select(F.concat(F.lit("k"), "id").alias("job_id"), (F.col("id") + add).cast("int").alias("n"))


def contents(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len({r[0] for r in rows})
    return dict(rows)


def data_files(path):
    return {str(p.relative_to(path)) for p in Path(path, "data").rglob("*.parquet")}


def test_rows_of_every_version_stay_readable(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), numbers(spark, 0, 1).schema, piece_rows=20)
    assert table.read().count() == 0 and not table.exists()
    table.append(numbers(spark, 0, 100))
    table.append(numbers(spark, 100, 150))
    table.replace_rows(numbers(spark, 90, 160, add=1000))
    table.replace_rows(numbers(spark, 155, 156, add=5000))
    want = {f"k{i}": i for i in range(150)} | {f"k{i}": i + 1000 for i in range(90, 160)} | {"k155": 5155}
    assert contents(table.read()) == want
    assert [table.read(v).count() for v in table.versions()] == [100, 150, 160, 160]
    assert contents(table.read(3))["k155"] == 1155
    # Keys find their rows in old and new pieces alike.
    keys = numbers(spark, 85, 95).unionByName(numbers(spark, 900, 910))
    assert contents(table.lookup(keys)) == {k: n for k, n in want.items() if k in {f"k{i}" for i in range(85, 95)}}
    table.compact(share=0.0)
    assert contents(table.read()) == want and not any(p["delta"] for p in table.manifest()["pieces"].values())
    assert contents(table.read(3))["k155"] == 1155
    gone = table.vacuum(keep=1)
    assert gone and contents(table.read()) == want and len(table.versions()) == 1


def test_pieces_split_as_the_table_grows_and_only_touched_ones_are_read(spark, tmp_path):
    path = tmp_path / "t"
    table = VersionedTable(spark, str(path), numbers(spark, 0, 1).schema, piece_rows=50)
    table.append(numbers(spark, 0, 40))
    assert set(table.manifest()["pieces"]) == {"p"}
    for begin in range(40, 1000, 240):
        table.append(numbers(spark, begin, begin + 240))
    manifest = table.manifest()
    assert manifest["depth"] == 5 and "p" in manifest["pieces"] and any(len(name) == 5 for name in manifest["pieces"])
    # A change of one key adds files of one piece; no stored file is touched.
    before = data_files(path)
    table.replace_rows(numbers(spark, 500, 501, add=1))
    added = data_files(path) - before
    assert before < data_files(path) and len({f.split(PIECE)[1].split("/")[0] for f in added}) == 1
    # A look-up opens the ancestors of one piece.
    plan = table.lookup(numbers(spark, 500, 501))
    opened = {f.split(PIECE + "=")[1].split("/")[0] for f in plan.inputFiles()}
    assert len(opened) <= 6 and len({len(name) for name in opened}) == len(opened) < len(manifest["pieces"])
    # Compaction splits what has become too large, into pieces of the present depth.
    rewritten = table.compact(share=10.0)
    assert "p" in rewritten and {len(name) for name in table.manifest()["pieces"]} == {6}
    assert contents(table.read()) == {f"k{i}": i + (i == 500) for i in range(1000)}


def test_families_of_pieces():
    assert families(["p01", "p0", "p1", "p010", "p11"]) == {"p0": ["p0", "p01", "p010"], "p1": ["p1", "p11"]}
    assert families(["p00", "p1"]) == {"p00": ["p00"], "p1": ["p1"]}


def test_reader_sees_one_version_while_a_write_dies(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, str(tmp_path / "t"), numbers(spark, 0, 1).schema)
    table.append(numbers(spark, 0, 10))
    reader = table.read()
    other = VersionedTable(spark, table.path, table._schema)

    def dies(*_):
        raise RuntimeError("power cut")

    monkeypatch.setattr(other.files, "put_new", dies)
    for write in (lambda: other.replace_rows(numbers(spark, 0, 5, add=100)), lambda: other.replace_pieces(numbers(spark, 0, 1), ["p"])):
        with pytest.raises(RuntimeError):
            write()
    # A task that fails leaves files, but no version.
    broken = numbers(spark, 0, 5).withColumn("n", F.raise_error(F.lit("bad row")).cast("int"))
    with pytest.raises(Exception, match="bad row"):
        table.append(broken)
    assert contents(reader) == contents(table.read()) == {f"k{i}": i for i in range(10)} and table.versions() == [1]
    # The same write again, undisturbed, is whole; the reader from before keeps its rows.
    table.replace_pieces(numbers(spark, 0, 3, add=100), ["p"])
    assert contents(table.read()) == {"k0": 100, "k1": 101, "k2": 102} and len(contents(reader)) == 10
    assert table.vacuum(keep=1)


def test_slower_writer_is_refused(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), numbers(spark, 0, 1).schema)
    table.append(numbers(spark, 0, 10))
    stale = table.manifest()
    table.append(numbers(spark, 10, 20))
    with pytest.raises(ChangedMeanwhile):
        table._commit(stale, stale["pieces"], table._schema)
    assert table.versions() == [1, 2] and not [n for n in table.files.names("versions") if n.endswith("draft")]
    assert json.loads(Path(table.path, "versions", f"{2:012d}.json").read_text())["version"] == 2


def test_changed_since(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), numbers(spark, 0, 1).schema)
    table.append(numbers(spark, 0, 10))
    table.append(numbers(spark, 10, 12))
    table.replace_rows(numbers(spark, 3, 4, add=50))
    assert contents(table.changed_since(1)) == {"k10": 10, "k11": 11, "k3": 53}
    assert contents(table.changed_since(1, until=2)) == {"k10": 10, "k11": 11}
    assert contents(table.changed_since(3)) == {} and len(contents(table.changed_since(0))) == 12


def test_patches_change_the_stored_table_once(spark, tmp_path, postings):
    path = str(tmp_path / "raw")
    table = VersionedTable(spark, path, JOBS_RAW, piece_rows=100)
    table.append(postings, expected_rows=1500)
    before = data_files(path)
    one = postings.where("salary_min > 30000 AND salary_max IS NULL").orderBy("id").first()
    updates = spark.createDataFrame(
        [(one.job_id, "new text", None, None, 1), (one.job_id, "", None, 10, 2), ("absent", "x", 1, 2, 1)],
        "job_id string, description string, salary_min int, salary_max int, step int",
    )
    report = {r.job_id: (r.found, r.changed) for r in store.patch_postings(updates, path, "step", at=datetime(2026, 2, 20)).collect()}
    assert report == {one.job_id: (True, True), "absent": (False, False)}
    got = {r.job_id: r for r in table.read().collect()}
    assert len(got) == postings.count()
    assert (got[one.job_id].description, got[one.job_id].salary_min, got[one.job_id].updated_at) == ("new text", one.salary_min, datetime(2026, 2, 20))
    assert before < data_files(path) and len({f.split(PIECE)[1].split("/")[0] for f in data_files(path) - before}) == 1
    # The same call again finds nothing to change and writes nothing.
    files, versions = data_files(path), table.versions()
    report = {r.job_id: (r.found, r.changed) for r in store.patch_postings(updates, path, "step").collect()}
    assert report == {one.job_id: (True, False), "absent": (False, False)}
    assert table.versions() == versions and {f for f in data_files(path) - files if "part-" in f} == set()


def test_runs_are_counted_once(spark, tmp_path, postings):
    raw, metrics = str(tmp_path / "raw"), str(tmp_path / "metrics")
    half = postings.where("id % 2 = 0")
    arguments = (raw, ["id"], metrics, "all")
    first = [store.insert_postings(half, *arguments, "r1", datetime(2026, 2, 20)) for _ in range(2)]
    second = [store.insert_postings(postings, *arguments, "r2", datetime(2026, 2, 21)) for _ in range(2)]
    assert first == [half.count()] * 2 and second == [postings.count() - half.count()] * 2
    assert store.insert_postings(half, *arguments, "r1", datetime(2026, 2, 20)) == first[0]
    runs = {r.run_id: (r.jobs_valid, r.jobs_duplicates, r.status) for r in store.read_runs(spark, metrics).collect()}
    assert runs == {"r1": (first[0], 0, "completed"), "r2": (second[0], first[0], "completed")}
    assert store.insert_postings(half, *arguments, "r3", datetime(2026, 2, 22)) == 0
    assert store.read_table(spark, raw, JOBS_RAW).count() == postings.count()


def test_stored_keys_are_looked_up_without_a_shuffle_of_the_stored_side(spark, tmp_path, postings):
    table = VersionedTable(spark, str(tmp_path / "raw"), JOBS_RAW, piece_rows=100)
    table.append(postings, expected_rows=1500)
    batch = spark.createDataFrame([(r.job_id,) for r in postings.limit(2).collect()], "job_id string")
    found = table.lookup(batch, ["job_id"])
    assert found.count() == 2 and len(found.inputFiles()) <= 2 * 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "description" not in scan


def same_rows(a, b):
    names = [c for c in a.columns if c in b.columns]
    rows = [sorted((tuple(map(str, r)) for r in df.select(*names).collect())) for df in (a, b)]
    assert rows[0] == rows[1] and rows[0]


def export_files(path):
    """Files of the listed folders, by month."""
    manifest = json.loads(max(Path(path, "versions").glob("*.json")).read_text())
    return {month: {str(f) for w in p["base"] for f in Path(path, "data", w, f"{PIECE}={month}").glob("*.parquet")} for month, p in manifest["pieces"].items()}


def test_export_rewrites_only_months_that_changed(spark, tmp_path, postings, fx):
    tables = Tables(*[str(tmp_path / n) for n in ("raw", "features", "export", "metrics")])
    raw, features = VersionedTable(spark, tables.raw, JOBS_RAW), VersionedTable(spark, tables.features, JOBS_FEATURES)
    held = F.col("posted_date") == "2026-02-10"
    raw.append(postings.where(~F.coalesce(held, F.lit(False))))
    found = first_per_key(fx.features, ["job_id"], ["job_id"]).withColumn("extracted_at", F.lit(None).cast("timestamp_ntz")).select(*JOBS_FEATURES.names)
    features.append(found)
    whole = lambda day: bi_export(raw.read(), features.read(), day)
    stored = lambda: store.export_table(spark, tables.export).read()
    assert refresh.refresh_export(spark, tables, AS_OF) is None
    same_rows(stored(), whole(AS_OF))
    before = export_files(tables.export)
    assert sorted(before) == ["2026-01", "2026-02"]
    # Nothing new: nothing is written.
    assert refresh.refresh_export(spark, tables, AS_OF) == [] and export_files(tables.export) == before
    # New postings of February leave January as it is.
    raw.append(postings.where(held))
    assert refresh.refresh_export(spark, tables, AS_OF) == ["2026-02"]
    after = export_files(tables.export)
    assert after["2026-01"] == before["2026-01"] and not after["2026-02"] & before["2026-02"]
    same_rows(stored(), whole(AS_OF))
    # A changed feature of a January posting rewrites January; so does a later day, which January loses.
    january = raw.read().where("posted_date between '2026-01-22' and '2026-01-31'").join(features.read().select("job_id"), "job_id", "left_semi").first()
    change = features.read().where(F.col("job_id") == january.job_id).withColumn("exp_level", F.lit("lead"))
    features.replace_rows(change)
    assert refresh.refresh_export(spark, tables, AS_OF) == ["2026-01"]
    same_rows(stored(), whole(AS_OF))
    assert refresh.refresh_export(spark, tables, date(2026, 2, 23)) == ["2026-01"]
    same_rows(stored(), whole(date(2026, 2, 23)))
    assert refresh.refresh_export(spark, tables, date(2026, 3, 10)) == ["2026-01", "2026-02"]
    assert sorted(export_files(tables.export)) == ["2026-02"]
    same_rows(stored(), whole(date(2026, 3, 10)))
    # Going back brings January in again.
    assert refresh.refresh_export(spark, tables, AS_OF) == ["2026-01", "2026-02"]
    same_rows(stored(), whole(AS_OF))


def test_failed_refresh_leaves_the_old_export(spark, tmp_path, postings):
    path = str(tmp_path / "export")
    rows = postings.where("posted_date > '2026-01-20'").select("job_id", "posted_date")
    store.write_export(rows, path)
    with pytest.raises(Exception, match="broken"):
        store.write_export(rows.withColumn("job_id", F.raise_error(F.lit("broken")).cast("string")), path)
    same_rows(store.export_table(spark, path).read(), rows)
    january = store.export_table(spark, path).read(pieces=lambda month: month < "2026-02")
    assert january.where("posted_date >= '2026-02-01'").count() == 0 < january.count()


def test_clustered_postings_skip_files(spark, tmp_path, postings):
    raw, path = VersionedTable(spark, str(tmp_path / "raw"), JOBS_RAW), str(tmp_path / "clustered")
    raw.append(postings.where("coalesce(posted_date, date'2026-01-01') <> '2026-02-10'"))
    first = store.refresh_clustered(raw, path)
    assert {"2025-12", "2026-01", "2026-02", "unknown"} <= set(first) and store.refresh_clustered(raw, path) == []
    raw.append(postings.where("posted_date = '2026-02-10'"))
    assert store.refresh_clustered(raw, path) == ["2026-02"]
    table = store.clustered_table(spark, path)
    same_rows(table.read(), postings)
    # P2: the other months' files are not opened.
    for days, months in ((14, {"2026-02"}), (30, {"2026-01", "2026-02"})):
        recent = store.clustered_since(table, AS_OF, days)
        assert {f.split(PIECE + "=")[1].split("/")[0] for f in recent.inputFiles()} == months
        same_rows(recent, postings.where(F.col("posted_date") >= F.date_sub(F.lit(AS_OF), days)))
    # P5: a search form's dates and city reach the files.
    spec = search.FilterSpec(city="Ottawa", posted_days=14)
    found = search.filter_search(store.clustered_since(table, AS_OF, spec.posted_days), spec, AS_OF)
    assert [tuple(r) for r in found.collect()] == [tuple(r) for r in search.filter_search(postings, spec, AS_OF).collect()]
    few = table.read().where("city = 'Ottawa'").select("job_id")
    assert "EqualTo(city,Ottawa)" in few._jdf.queryExecution().executedPlan().toString()
    assert store.clustered_since(table, AS_OF, 0).count() == postings.count()


def test_runs_with_a_waiting_table_store_the_same_features(spark, tmp_path, postings):
    sets = [[str(tmp_path / f"{k}-{n}") for n in ("raw", "features", "export", "metrics", "waiting")] for k in range(2)]
    with_it, without = Tables(*sets[0]), Tables(*sets[1][:4])
    days = [postings.where("id % 3 = 0"), postings.where("id % 3 = 1"), postings.where("id % 3 = 2")]
    for n, day in enumerate(days):
        stored = []
        for tables in (with_it, without):
            store.insert_postings(day, tables.raw, ["id"], tables.metrics, "all", f"r{n}", datetime(2026, 2, 20))
            stored.append(refresh.process(spark, tables, AS_OF))
        assert stored[0] == stored[1]
    features = [store.read_table(spark, t.features, JOBS_FEATURES).drop("extracted_at") for t in (with_it, without)]
    same_rows(*features)
    same_rows(*[store.export_table(spark, t.export).read() for t in (with_it, without)])
    waiting = VersionedTable(spark, with_it.waiting, JOBS_RAW).read().select("job_id")
    left = store.read_table(spark, with_it.raw, JOBS_RAW).select("job_id").subtract(features[0].select("job_id"))
    same_rows(waiting, left)
    # A version that tidy() makes is not taken for news.
    VersionedTable(spark, with_it.raw, JOBS_RAW).compact(folders=1)
    refresh.tidy(spark, with_it)
    assert refresh.process(spark, with_it, AS_OF) == refresh.process(spark, without, AS_OF)


def test_skill_index_equals_the_scan(spark, tmp_path, fx):
    index = search_index.SkillIndex(spark, str(tmp_path / "skills"), piece_rows=200)
    features = fx.features
    index.add(features.where("exp_level = 'mid'"), expected_rows=2000)
    index.add(features.where("exp_level <> 'mid'"))
    for wanted in (["python"], ["python", "sql"], ["sql", "python", "aws", "python"], ["python", "none such"], ["none such"]):
        scan = features.where(F.size(F.array_except(F.array(*map(F.lit, wanted)), F.coalesce("skills", F.array().cast("array<string>")))) == 0)
        assert sorted(r[0] for r in index.has_all(wanted).collect()) == sorted({r[0] for r in scan.select("job_id").collect()})
    with pytest.raises(ValueError):
        index.has_all([])
    every, one = index.table.read().inputFiles(), index.lists(["git"]).inputFiles()
    assert set(one) < set(every) and len(one) <= 4


PATTERNS = ["%data%analyst%", "%ANALYST%", "Senior%", "%_enior d%", "%q_", "%", "%it%", "%\\%%", "%no such title%", "%a\\_b%", "%ée%"]


def test_substring_index_equals_the_scan(spark, tmp_path, postings):
    odd = ["50% off", "a_b", "née", "NÉE", "ab", ""]
    place = F.row_number().over(Window.orderBy("id"))
    ranked = postings.withColumn("title", F.coalesce(F.get(F.array(*map(F.lit, odd)), place - 1), "title"))
    raw = ranked.select(*JOBS_RAW.names)
    index = search_index.SubstringIndex(spark, str(tmp_path / "titles"), "title", piece_rows=100)
    index.add(raw.where("id % 2 = 0"), expected_rows=1500)
    index.add(raw.where("id % 2 = 1"))
    for pattern in PATTERNS:
        scan = sorted({r[0] for r in raw.where(F.col("title").ilike(pattern)).select("job_id").collect()})
        assert sorted(r[0] for r in index.find(pattern).collect()) == scan, pattern
    assert search_index.pattern_grams("%Data_Sc\\%ien%x") == ["ata", "dat", "ien"]
    table = VersionedTable(spark, str(tmp_path / "raw"), JOBS_RAW)
    table.append(raw)
    for phrase in ("show me data analyst in Toronto", "da%ta in otta", "it in o", "jobs in Toronto in Canada"):
        a, b = search.indexed_phrase_search(table, index, phrase), search.phrase_search(raw, phrase)
        assert (a is None and b is None) or [tuple(r) for r in a.collect()] == [tuple(r) for r in b.collect()]
    for spec in (search.FilterSpec(keywords="senior  Data"), search.FilterSpec(keywords="% a_"), search.FilterSpec(city="Toronto")):
        a, b = search.indexed_filter_search(table, index, spec, AS_OF), search.filter_search(raw, spec, AS_OF)
        assert [tuple(r) for r in a.collect()] == [tuple(r) for r in b.collect()]


def test_bounded_suppression_of_repeats(spark, tmp_path):
    """Each file is a batch: the watermark moves between them."""
    folder, out = tmp_path / "in", {}
    folder.mkdir()
    days = [
        ['{"job_id": "a", "at": "2026-01-01T00:00:00"}', '{"job_id": "a", "at": "2026-01-01T05:00:00"}'],
        ['{"job_id": "a", "at": "2026-01-02T00:00:00"}', '{"job_id": "b", "at": "2026-01-05T00:00:00"}'],
        ['{"job_id": "a", "at": "2026-01-06T00:00:00"}', '{"job_id": "c", "at": "2026-01-01T00:00:00"}'],
    ]
    for n, lines in enumerate(days):
        (folder / f"{n}.json").write_text("\n".join(lines))
        stream = spark.readStream.schema("job_id string, at timestamp").json(str(folder))
        kept = ingest.without_repeats(stream, "at", "2 days")
        query = kept.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
        query.awaitTermination()
        out[n] = sorted((r.job_id, r.at.day) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert out[0] == [("a", 1)] and out[1] == [("a", 1), ("b", 5)]
    # The state of a has gone with the watermark; c comes too late.
    assert out[2] == [("a", 1), ("a", 6), ("b", 5)]


@pytest.mark.parametrize("most", [0, versioned.BROADCAST_BYTES])
def test_stored_keys_leave_out_what_is_stored(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(versioned, "BROADCAST_BYTES", most)
    table = VersionedTable(spark, str(tmp_path / "t"), key="job_id", piece_rows=10)
    batch = spark.range(60).selectExpr("concat('k', id) AS job_id")
    assert table.stored_keys(batch).count() == 0
    table.append(batch.where("job_id < 'k3'"), expected_rows=40)
    left = batch.join(table.stored_keys(batch), "job_id", "left_anti")
    assert {r[0] for r in left.collect()} == {f"k{n}" for n in range(60) if f"k{n}" >= "k3"}


def test_insert_writes_rows_once(spark, tmp_path, monkeypatch):
    """Whole rows are dealt by key once and go to the table, not to a checkpoint and a second shuffle."""
    fx = Fixture(spark, "/root/testdata/sf0.001")
    plans = []
    write = VersionedTable._write
    monkeypatch.setattr(VersionedTable, "_write", lambda self, rows, *more: plans.append(rows) or write(self, rows, *more))
    monkeypatch.setattr(type(fx.raw), "checkpoint", lambda *_: pytest.fail("rows are written beside the table"))
    arguments = str(tmp_path / "raw"), ["id"], str(tmp_path / "metrics"), "all"
    batches = [fx.raw.where("source = 'adzuna'"), fx.raw]
    counts = [store.insert_postings(b, *arguments, f"r{n}", datetime(2026, 2, 20)) for n, b in enumerate(batches)]
    assert sum(counts) == fx.raw.select("job_id").distinct().count()
    for rows in plans:
        text = rows._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange hashpartitioning(job_id") <= 2  # the rows, and keys alone


def test_index_reads_its_postings_once(spark, tmp_path, postings):
    """What is indexed may be costly to make: its rows are asked for a single time."""
    asked = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            asked.add(len(batch))
            yield batch

    some = postings.select("job_id", "title").limit(40)
    index = search_index.SubstringIndex(spark, str(tmp_path / "titles"), "title")
    for number in (1, 2):
        index.add(some.mapInPandas(counted, "job_id string, title string"))
        assert asked.value == 40 * number
    assert index.find("%data%").count() == some.where("title ILIKE '%data%'").count() > 0
