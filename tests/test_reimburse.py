from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from claimspark.functions import split_cco
from claimspark.operators import reimburse as r
from claimspark.plans.reimbursement import generate_reimbursements, reimburse, write_reimbursements
from claimspark.session import shared_dir
from claimspark.sources.files import Folder
from claimspark.sources.keyed import KeyedTable
from claimspark.sources.tables import append
from tests.conftest import values

AS_OF = date(2024, 1, 31)


def item(i, **kw):
    base = dict(cd_item_ressarciment_sus_anexo=i, cd_ressarcimento_sus=1, nr_atendimento=7, cd_cco=123456, nm_ups="U",
                nm_municipio="M", cd_uf="SP", cd_procedimento=10, vl_procedimento=D("100.00"), sn_confirmar="S",
                dt_inicio=datetime(2023, 1, i), dt_fim=datetime(2023, 2, i))
    return {**base, **kw}


def check(i, tp="A", msg=None, n=0):
    return dict(cd_valida_item_ress_sus_anexo=i * 10 + n, cd_item_ressarciment_sus_anexo=i, tp_validacao=tp, ds_mensagem=msg)


@pytest.fixture(scope="module")
def world(table):
    return dict(
        items=table(
            "item", item(1), item(2, nm_ups="V"), item(3, sn_confirmar="N"), item(4, cd_procedimento=11),
            item(5, nr_atendimento=8, cd_cco=5), item(6, nr_atendimento=9, cd_ressarcimento_sus=2),
        ),
        val=table(
            "validation", check(1), check(1, "I", "late", 1), check(2), check(3), check(4, "E", "bad"), check(4, None, None, 1),
            check(5), check(6),
        ),
        notices=table("notice", dict(cd_ressarcimento_sus=1, dt_oficio=date(2023, 3, 1)), dict(cd_ressarcimento_sus=2)),
        reemb=table("reimb", dict(cd_reembolso=9, cd_ressarcimento_sus=2)),
        members=table(
            "member", dict(cd_matricula=50, cd_cco=1234, nr_div_cco=56, cd_matricula_tem=49, cd_fornecedor=2, cd_multi_empresa=3),
            dict(cd_matricula=51, cd_cco=1234, nr_div_cco=56, cd_fornecedor=8), dict(cd_matricula=49, cd_cco=1, nr_div_cco=1, cd_fornecedor=77),
        ),
        depara=table("depara", dict(cd_procedimento_sus=10, cd_procedimento=1010),
                     dict(cd_procedimento_sus=11, cd_procedimento=1111, dt_fim_vigencia=date(2020, 1, 1))),
    )


def test_short_and_long_numbers_split(spark):
    df = spark.createDataFrame([(5,), (56,), (123,), (123456789012345,)], "n long")
    code, div = split_cco(F.col("n"))
    assert values(df.select("n", code.alias("c"), div.alias("d")), "n", "c", "d") == [
        (123, "0000000001", "23"), (123456789012345, "1234567890", "45"), (5, None, "05"), (56, None, "56")]


def test_summary_counts_each_validation_and_drops_errors(world):
    got = r.attendance_summary(world["items"], world["val"], world["notices"], world["reemb"])
    # item 1 counts twice, item 3 is not confirmed, item 4 has an error and a missing type, notice 2 is reimbursed
    assert values(got, "nr_atendimento", "nm_ups", "nr_qtd", "vl_qtd") == [
        (7, "U", 2, 200.0), (7, "V", 1, 100.0), (8, "U", 1, 100.0)]


def test_items_keep_errors_and_zero_disputed(world):
    got = r.attendance_items(world["items"], world["val"], world["notices"], world["depara"], AS_OF)
    mine = got.filter("cd_ressarcimento_sus = 1 and nr_atendimento = 7")
    assert values(mine, "cd_procedimento_mapeado", "vl_qtd", "vl_qtd_original", "nr_qtd") == [
        (1010, 200.0, 300.0, 3), (None, 200.0, 200.0, 2)]


def test_whole_job(world, spark, tmp_path):
    out = generate_reimbursements(**world, as_of=AS_OF, user="U1", tenant=None)
    heads = out["reimbursement"]
    assert len(heads.select("*").columns) == 63 + 6
    # the smallest registration wins, the holder's supplier, the member's tenant; the short number has no member
    assert values(heads, "cd_reembolso", "cd_matricula", "cd_fornecedor", "cd_multi_empresa", "nm_ups", "ds_consideracoes_internas") == [
        (1, 50, 77, 3, "U", ": bad\n1010 : late\n"), (2, 50, 77, 3, "V", ": bad\n1010 : late\n")]
    # both places list all procedures of the attendance; an unmapped one is -1, but stays empty in the denial
    assert values(out["reimbursement_item"], "cd_reembolso", "cd_procedimento", "vl_procedimento", "vl_cobrado") == [
        (1, -1, 200.0, 200.0), (1, 1010, 200.0, 300.0), (2, -1, 200.0, 200.0), (2, 1010, 200.0, 300.0)]
    assert values(out["reimbursement_denial"], "cd_reembolso", "cd_procedimento", "cd_motivo") == [(1, 1010, 9630), (2, 1010, 9630)]
    # the last one wins, unconfirmed items included
    assert values(out["item"], r.ITEM, "cd_reembolso") == [(1, 2), (2, 2), (3, 2), (4, 2), (5, None), (6, None)]
    write_reimbursements(out, str(tmp_path), "b1")
    write_reimbursements(out, str(tmp_path), "b1")
    assert spark.read.parquet(f"{tmp_path}/reimbursement_item").count() == 4
    denials = spark.read.parquet(f"{tmp_path}/reimbursement_denial")
    assert values(denials, "cd_itreembolso_glosa") == [(1,), (2,)]
    # a second run on its own output adds nothing
    again = generate_reimbursements(**{**world, "reemb": world["reemb"].unionByName(
        heads.select("cd_reembolso", "cd_ressarcimento_sus", "tp_status"))}, as_of=AS_OF, user="U1", tenant=None)
    assert again["reimbursement"].count() == 0


def test_stored_job_scans_the_items_once_and_writes_few_files(world, spark, tmp_path):
    base = str(tmp_path)
    items = KeyedTable(spark, f"{base}/item", world["items"].schema, r.NOTICE)
    items.create(world["items"], 2)
    rest = {k: v for k, v in world.items() if k != "items"}
    before = {f["file"] for f in items.manifest()}
    for _attempt in range(2):
        reimburse(items, **rest, base=base, batch="b1", as_of=AS_OF, user="U1", tenant=None)
    assert values(spark.read.parquet(f"{base}/reimbursement"), "cd_reembolso") == [(1,), (2,)]
    assert values(spark.read.parquet(f"{base}/reimbursement_denial"), "cd_itreembolso_glosa") == [(1,), (2,)]
    assert values(items.read(), r.ITEM, "cd_reembolso") == [(1, 2), (2, 2), (3, 2), (4, 2), (5, None), (6, None)]
    # the file of the other notice stays as it was
    assert len(before & {f["file"] for f in items.manifest()}) == 1
    runs = Folder(spark, f"{shared_dir(spark)}/runs")
    assert len(runs._fs.listStatus(runs._at(""))) == 0
    # summary, items and critiques read the kept rows, not the items
    out = generate_reimbursements(**{**world, "items": items.read()}, as_of=AS_OF, user="U1", tenant=None)
    for name in ("reimbursement", "reimbursement_item", "reimbursement_denial"):
        assert not any(f"{base}/item" in x for x in out[name].inputFiles())


def test_earlier_rule_equals_current_when_all_confirmed(world):
    args = (world["items"].withColumn("sn_confirmar", F.lit("S")), world["val"], world["notices"])
    new, old = (r.attendance_summary(*args, world["reemb"], flag) for flag in (True, False))
    assert sorted(map(repr, new.collect())) == sorted(map(repr, old.collect()))


def test_confirm_takes_duplicate_ids(world, table):
    staged = table("staging", dict(cd_item_ress_sus_anexo=3), dict(cd_item_ress_sus_anexo=3))
    got = r.confirm_items(world["items"], staged, "S")
    assert got.count() == 6 and got.filter("sn_confirmar = 'S'").count() == 6


def test_confirm_with_null_clears_the_flag(world, table):
    items = world["items"].withColumn("sn_confirmar", F.lit("S"))
    got = r.confirm_items(items, table("staging", dict(cd_item_ress_sus_anexo=3)), None)
    assert got.filter("sn_confirmar is null").count() == 1 and got.filter("sn_confirmar = 'S'").count() == 5


def test_append_keeps_other_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in ("a", "b", "a"):
        append(spark.range(3), path, batch)
    assert spark.read.parquet(path).count() == 6
