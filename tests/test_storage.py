"""Logs, sequences, keyed update by file and staging by generation."""

import json
import threading

import pytest

from checks.derived import Derived
from claimspark.session import shuffles_freed
from claimspark.sources import tables as s
from claimspark.sources.files import Folder, Log
from claimspark.sources.keyed import Conflict, KeyedTable
from claimspark.sources.sequences import Sequence
from tests.conftest import values


def at_once(n, work):
    """Run work(i) on n threads that start together; returns results and errors."""
    gate, out, errors = threading.Barrier(n), [], []

    def run(i):
        gate.wait()
        try:
            out.append(work(i))
        except Exception as e:  # noqa: BLE001 - the test looks at it
            errors.append(e)

    threads = [threading.Thread(target=run, args=(i,)) for i in range(n)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return out, errors


def test_one_writer_of_an_entry_wins(spark, tmp_path):
    log = Log(spark, f"file://{tmp_path}/a log")
    assert log.last() == (0, None) and log.entries() == []
    out, errors = at_once(8, lambda i: (i, log.add(1, {"by": i, "text": "x" * 10_000})))
    winners = [i for i, won in out if won]
    assert not errors and len(winners) == 1 and log.last()[1]["by"] == winners[0]
    assert [p.name for p in (tmp_path / "a log").iterdir()] == ["000000000001"]


def test_concurrent_jobs_get_disjoint_numbers(spark, tmp_path):
    out, errors = at_once(8, lambda i: [(Sequence(spark, str(tmp_path), "n", 100).lease(k), k) for k in (i, 3, 50)])
    assert not errors
    blocks = sorted(b for x in out for b in x if b[1])
    assert blocks[0][0] == 100
    assert all(a + n == b for (a, n), (b, _) in zip(blocks, blocks[1:]))  # no overlap and no gap
    with pytest.raises(ValueError):
        Sequence(spark, str(tmp_path), "n").lease(-1)


def test_a_rerun_gets_its_numbers_back(spark, tmp_path):
    numbers = Sequence(spark, str(tmp_path), "n")
    first = numbers.lease(10, "batch 1")
    assert numbers.lease(5, "batch 2") == first + 10
    assert numbers.lease(10, "batch 1") == first
    assert numbers.lease(11, "batch 1") == first + 15  # more rows than before: new numbers
    assert Sequence(spark, str(tmp_path), "other").lease(1) == 1


@pytest.fixture
def stored(spark, tmp_path):
    rows = spark.createDataFrame([(k, "a", "same") for k in [*range(1000), None]], "k long, v string, w string").repartition(3)
    table = KeyedTable(spark, str(tmp_path / "t"), rows.schema, "k")
    table.create(rows, 10)
    return table


def test_files_grow_in_number_and_not_in_rows(spark, stored, tmp_path, monkeypatch):
    monkeypatch.setattr("claimspark.sources.keyed.FILE_ROWS", 50)
    assert stored.update(stored.read().where("k is not null").selectExpr("k", "string(k) as v"), ["k"], ["v"]) == 10
    assert len(stored.manifest()) >= 20 and sum(f["rows"] for f in stored.manifest()) == 1001
    table = KeyedTable(spark, str(tmp_path / "u"), stored.schema, "k")
    table.create(stored.read(), 2)
    assert len(table.manifest()) >= 20 and max(f["rows"] for f in table.manifest()) <= 100
    assert values(table.read(), "k", "v", "w") == values(stored.read(), "k", "v", "w")


def test_only_files_with_a_changed_key_are_written(spark, stored):
    before = {f["file"] for f in stored.manifest()}
    assert len(before) == 10 and sum(f["rows"] for f in stored.manifest()) == 1001
    changes = spark.createDataFrame([(5, "b"), (6, None), (999, "c"), (5000, "d"), (-1, "e"), (None, "f")], "k long, v string")
    assert stored.update(changes, ["k"], ["v"]) == 2
    after = {f["file"] for f in stored.manifest()}
    assert len(before & after) == 8 and len(after) == 10
    got = {r.k: (r.v, r.w) for r in stored.read().collect()}
    want = {k: ("a", "same") for k in [*range(1000), None]} | {5: ("b", "same"), 6: (None, "same"), 999: ("c", "same")}
    assert got == want and stored.read().count() == 1001
    assert stored.update(changes.where("k > 4000"), ["k"], ["v"]) == 0 and stored.version() == 2
    assert stored.update(changes.limit(0), ["k"], ["v"]) == 0


def test_a_reader_keeps_its_version_until_the_table_is_tidied(spark, stored):
    seen = stored.read()
    stored.update(spark.createDataFrame([(5, "b")], "k long, v string"), ["k"], ["v"])
    assert seen.where("v = 'b'").count() == 0 and stored.read().where("v = 'b'").count() == 1
    stored.tidy()
    assert stored.read().count() == 1001


def test_two_updates_at_once_both_take_effect(spark, stored):
    def work(i):
        return stored.update(spark.createDataFrame([(i, f"t{i}"), (990 + i, f"t{i}")], "k long, v string"), ["k"], ["v"])

    out, errors = at_once(3, work)
    assert not errors and out == [2, 2, 2]
    assert values(stored.read().where("v <> 'a'"), "k", "v") == sorted([(k, f"t{k % 10}") for k in (0, 1, 2, 990, 991, 992)], key=repr)
    # the writes that lost against another are gone
    folders = {f["file"].split("/")[1] for entry in stored.log.entries() for f in entry["files"]}
    kept = Folder(spark, f"{stored.path}/data")
    assert {p.getPath().getName() for p in kept._fs.listStatus(kept._at(""))} == folders


def test_a_change_that_loses_rows_is_refused(spark, stored):
    with pytest.raises(ValueError):
        stored.rewrite(spark.createDataFrame([(5,)], "k long"), lambda rows: rows.where("k <> 7"))
    with pytest.raises(ValueError):
        stored.update(spark.createDataFrame([("a", "b")], "w string, v string"), ["w"], ["v"])
    with pytest.raises(Conflict):
        stored.create(stored.read(), 2)
    assert stored.version() == 1


def test_text_keys_and_overlapping_files(spark, tmp_path):
    rows = spark.createDataFrame([(c, 0) for c in "aabbccddeeff"] + [("b", 1)], "k string, v int")
    table = KeyedTable(spark, str(tmp_path / "t"), rows.schema, "k")
    table.create(rows, 4)
    # a second load whose ranges overlap those there
    version, entry = table.log.last()
    table.log.add(version + 1, {"files": entry["files"] + table._write(rows, 2)})
    table.update(spark.createDataFrame([("b", 9), ("z", 9)], "k string, v int"), ["k"], ["v"])
    assert table.read().count() == 26 and table.read().where("v = 9").count() == 6 == table.read().where("k = 'b'").count()


def staged_rows(spark, path, *ids):
    spark.createDataFrame([(i,) for i in ids], "cd_item_ress_sus_anexo long").write.mode("append").parquet(path)


SCHEMA = "cd_item_ress_sus_anexo long"


def taken(spark, path):
    schema = spark.createDataFrame([], SCHEMA).schema
    return sorted(r[0] for r in s.taken_rows(spark, path, schema).collect())


def test_rows_that_arrive_half_way_wait(spark, tmp_path, monkeypatch):
    staging, path = str(tmp_path / "staging"), str(tmp_path / "taken")
    assert taken(spark, path) == []
    staged_rows(spark, staging, 1, 2)
    real = Log.add

    def late(log, number, entry):
        staged_rows(spark, staging, 3)  # between the write of the rows and their entry
        return real(log, number, entry)

    monkeypatch.setattr(Log, "add", late)
    left = s.consume_staging(spark, staging, path)
    monkeypatch.undo()
    assert taken(spark, path) == [1, 2] and values(left, "cd_item_ress_sus_anexo") == [(3,)]
    assert s.consume_staging(spark, staging, path).count() == 0
    assert taken(spark, path) == [1, 2, 3]
    # the stored table is empty when read again, and stays readable
    assert spark.read.parquet(staging).count() == 0 and s.consume_staging(spark, staging, path).count() == 0
    assert taken(spark, path) == [1, 2, 3]


@pytest.mark.parametrize("stop", ["add", "delete"])
def test_a_job_that_stops_takes_no_row_twice(spark, tmp_path, monkeypatch, stop):
    staging, path = str(tmp_path / "staging"), str(tmp_path / "taken")
    staged_rows(spark, staging, 1, 2)

    def fail(*_):
        raise OSError("stopped")

    monkeypatch.setattr(*((Log, "add") if stop == "add" else (Folder, "delete")), fail)
    with pytest.raises(OSError):
        s.consume_staging(spark, staging, path)
    monkeypatch.undo()
    assert taken(spark, path) == ([] if stop == "add" else [1, 2])
    staged_rows(spark, staging, 3)
    assert s.consume_staging(spark, staging, path).count() == 0
    assert taken(spark, path) == [1, 2, 3]


def test_two_consumers_share_the_rows(spark, tmp_path):
    staging, path = str(tmp_path / "staging"), str(tmp_path / "taken")
    staged_rows(spark, staging, *range(20))
    _, errors = at_once(2, lambda i: s.consume_staging(spark, staging, path))
    assert taken(spark, path) == list(range(20)) and not errors
    assert json.dumps(Log(spark, f"{path}/_generations").entries())


def test_frames_written_side_by_side_free_their_shuffles_until_the_last_ends(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    first, second = shuffles_freed(spark), shuffles_freed(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(name) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(name, None) == before


def test_derived_tables_are_made_side_by_side_and_once(spark, tmp_path):
    spark.createDataFrame([(0,), (4,)], "r_regionkey int").write.parquet(f"{tmp_path}/region.parquet")
    spark.createDataFrame([(1, "A", 2, 5.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    tables = Derived(spark, str(tmp_path))
    tables.prepare("fx_config", "fx_provider", "fx_address_authoriser")
    paths = {step: path for step, (path, _) in tables._files.items()}
    assert set(paths) == {"fx_insurer", "fx_config", "fx_provider", "fx_address", "fx_address_authoriser"}
    assert (tables["config"].count(), tables["address_authoriser"].count()) == (14, 2)
    assert {step: path for step, (path, _) in tables._files.items()} == paths
