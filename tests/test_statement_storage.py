"""Stored statements: every row has one parent, ids are dense blocks, a rerun adds nothing."""

import pytest
from pyspark.sql import functions as F

from checks.catalog import AS_OF, ENTRIES, TENANT, Frames
from claimspark.operators.analysis import REQUEST
from claimspark.plans import storage
from claimspark.schemas import schema
from claimspark.session import Run, shared_dir
from claimspark.sources.files import Folder, Log
from tests.conftest import SF, values

# Table, its id, the table above and the column that holds that one's id.
TREE = [
    ("analysis_statement", "id", "reply", "id_pai"),
    ("analysis_protocol", "id", "analysis_statement", "cd_tiss_dem_ana"),
    ("analysis_guide", "id", "analysis_protocol", "id_pai"),
    ("analysis_procedure", "id", "analysis_guide", "id_pai"),
    ("analysis_denial", "id", "analysis_procedure", "id_pai"),
    ("payment_statement", "id", "reply", "id_pai"),
    ("payment_item", "cd_tiss_dem_pgt_item", "payment_statement", "id_pai"),
    ("payment_summary", "cd_tiss_dem_pgt_item_resumo", "payment_item", "id_pai"),
    ("payment_item_credit", "cd_tiss_dem_pgt_item_deb_cre", "payment_item", "cd_tiss_dem_pgt_item"),
    ("payment_statement_credit", "cd_tiss_dem_pgt_deb_cre", "payment_statement", "id_pai"),
    ("error", "cd_tiss_dem_retorno_erro", "reply", "cd_tiss_mensagem"),
]


class Mixed(Frames):
    """Messages of which some cannot be read, and requests that ask for a protocol twice."""

    def __getitem__(self, name):
        if name == "message":
            return super().__getitem__("message_mixed")
        df = super().__getitem__(name)
        return df.unionByName(df.where("cd_pai % 3 = 0")) if name == "req_proto" else df


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored"))
    storage.write_statements(Mixed(spark, SF), path, "b1", AS_OF, TENANT)
    return path


@pytest.fixture(scope="module")
def tables(spark, base):
    return {n: spark.read.schema(schema(n)).parquet(f"{base}/{n}/id_lote_carga=b1").toPandas() for n in storage.STORED}


def test_all_tables_have_rows_and_their_schema(spark, base, tables):
    assert all(len(tables[n]) for n in storage.STORED)
    for n in storage.STORED:
        assert spark.read.parquet(f"{base}/{n}/id_lote_carga=b1").schema == schema(n)


@pytest.mark.parametrize("name,own,above,link", TREE)
def test_every_row_has_one_parent(tables, name, own, above, link):
    rows, parents = tables[name], tables[above]
    assert rows[own].is_unique and rows[own].notna().all()
    assert set(rows[link]) <= set(parents[parents.columns[0]])
    # children are numbered in the order of their parents, without gaps
    rows = rows.sort_values(own)
    assert rows[link].is_monotonic_increasing
    if above != "reply":
        assert rows[own].max() - rows[own].min() == len(rows) - 1


def test_no_id_is_given_twice(base, tables, spark):
    ids = [i for name, own, *_ in TREE if name != "error" for i in tables[name][own]] + list(tables["reply"]["id"])
    # a payment statement without dates and its error row share their number, as they do in the source
    shared = set(tables["error"]["cd_tiss_dem_retorno_erro"]) & set(ids)
    assert len(ids) == len(set(ids)) and shared <= set(tables["payment_statement"]["id"])
    assert (tables["analysis_statement"]["nr_demonstrativo"] == tables["analysis_statement"]["id"]).all()
    blocks = sorted((e["first"], e["count"]) for e in Log(spark, f"{base}/_sequences/{storage.MESSAGES}").entries())
    assert all(a + n == b for (a, n), (b, _) in zip(blocks, blocks[1:]))


def test_equal_parents_keep_their_children_apart(tables):
    protocols = tables["analysis_protocol"]
    twice = protocols[protocols.duplicated(["cd_tiss_dem_ana", "nr_protocolo"], keep=False)]
    guides = tables["analysis_guide"].groupby("id_pai").size()
    seen = 0
    for _, same in twice.groupby(["cd_tiss_dem_ana", "nr_protocolo"]):
        numbers = {int(guides.get(i, 0)) for i in same["id"]}
        assert len(numbers) == 1  # each of them lists all guides
        seen += max(numbers)
    assert seen > 0


def test_failed_requests_lead_to_their_log(tables):
    log, error, reply = tables["log"], tables["error"], tables["reply"]
    text = error.merge(reply, left_on="cd_tiss_mensagem", right_on="id").set_index("cd_tiss_mensagem_origem")["ds_motivo_glosa"]
    for row in log.itertuples():
        assert text[row.cd_tiss_mensagem].endswith(f" {row.cd_tiss_mensagem_log}")
    assert sorted(log["cd_tiss_mensagem_log"]) == list(range(1, len(log) + 1))


def test_a_rerun_adds_nothing_and_keeps_its_numbers(spark, base, tables):
    storage.write_statements(Mixed(spark, SF), base, "b1", AS_OF, TENANT)
    for n in storage.STORED:
        again = spark.read.schema(schema(n)).parquet(f"{base}/{n}").toPandas()
        assert len(again) == len(tables[n])
        assert set(again.iloc[:, 0]) == set(tables[n].iloc[:, 0])


def test_another_batch_takes_other_numbers(spark, base, tables):
    with Run(spark) as run:
        rows = spark.range(50).withColumnRenamed("id", "k")
        given = storage.Numbers(run, base, "b2").give(rows, ["k"], "analysis_guide", "n")
        first = min(values(given, "n"))[0]
        assert values(given.filter(F.col("n") != F.col("k") + first), "n") == []
        assert first > max(int(tables[n].iloc[:, 0].max()) for n in storage.STORED if n != "log")


def test_no_frame_of_a_run_stays(spark, base):
    assert Folder(spark, f"{shared_dir(spark)}/runs").names() == []
    folder = Folder(spark, f"{shared_dir(spark)}/runs")
    assert len(folder._fs.listStatus(folder._at(""))) == 0


def test_numbers_and_stored_rows_do_not_meet_in_the_driver(spark, base, tmp_path, monkeypatch):
    """Files hold ids in a byte or two, so by their bytes the parents of very many rows look small enough to be broadcast."""
    with Run(spark) as run:
        asked = spark.range(20).withColumnRenamed("id", REQUEST)
        tops = storage.numbered_requests(asked, storage.Numbers(run, str(tmp_path), "b1"))
        plan = asked.join(tops, REQUEST)._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    monkeypatch.setitem(Frames._stored, (spark.sparkContext.applicationId, SF), base)
    for name, joins in (("s3_stored_summaries", 3), ("s3_stored_procedures", 4)):
        plan = ENTRIES[name].run(spark, SF)._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("SortMergeJoin") == joins and "BroadcastHashJoin" not in plan


def test_providers_are_looked_up_for_one_kind_of_request_at_a_time(spark, tmp_path, monkeypatch):
    """Each look-up sends the providers by three keys through the driver."""
    judged, real = [], Run.keep

    def keep(run, df):
        judged.extend(["begun"] * ("g_corpo" in df.columns))
        kept = real(run, df)
        judged.extend(["ended"] * ("g_corpo" in df.columns))
        return kept

    monkeypatch.setattr(Run, "keep", keep)
    for tree in ("analysis_tree", "payment_tree"):
        monkeypatch.setattr(storage, tree, lambda f, *_: judged.append("tree") or {"error": f["error"]})
    with Run(spark) as run, pytest.raises(KeyError):  # the trees are left out
        storage.stored_statements(Mixed(spark, SF), AS_OF, TENANT, storage.Numbers(run, str(tmp_path), "b1"))
    assert judged == ["begun", "ended"] * 2 + ["tree"] * 2
