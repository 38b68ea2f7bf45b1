"""Spark against SQL on the smallest data, and the shape of the plans."""

import pytest
from pyspark.sql import functions as F

from checks import oracle
from checks.catalog import AS_OF, ENTRIES, TENANT, Frames, plain
from checks.compare import bag, compare, connect
from claimspark.plans import statements as st
from tests.conftest import SF


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", ["r10_reimbursement_header", "v1_item_listing", "h12_header_verdict", "a6_guide_totals",
                                  "a16_procedure_rows", "p12_item_totals", "c1_account_name"])
def test_equals_sql(spark, con, name):
    ok, note = compare(spark, con, SF, name)
    assert ok, note


class PayrollOff(Frames):
    def __getitem__(self, name):
        df = super().__getitem__(name)
        if name == "config":
            df = df.withColumn("valor", F.when(F.col("chave") == "CONTMED_FOLHA_PGTO", "N").otherwise(F.col("valor")))
        return df


@pytest.mark.parametrize("name", ["p2_payment_dates", "p9_transfer_summary", "p12_item_totals"])
def test_equals_sql_without_payroll(spark, con, name):
    e = ENTRIES[name]
    sql = " ".join(e.sql().split())
    off = sql.replace("case when cd_multi_empresa=1 then 'S' else 'N' end", "'N'")
    assert off != sql
    cols = [c.split(":")[0] for c in e.spec.split()]
    got = bag(plain(e.build(PayrollOff(spark, SF))).select(*cols).collect())
    assert got == bag(con.execute(off).fetchall()) and got


@pytest.mark.parametrize("name", ["h3_resolve_plan", "h5_resolve_provider", "a2_contracted_provider", "a8_guide_paid",
                                  "a10_guide_procedures", "p2_payment_dates", "c1_account_name"])
def test_no_nested_loops(spark, name):
    plan = ENTRIES[name].run(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_every_entry_has_sql_over_tables():
    for e in ENTRIES.values():
        assert e.step in oracle.STEPS and " from " in e.sql()


def test_each_request_gets_one_reply_and_one_outcome(spark):
    t = Frames(spark, SF)
    out = st.statements(t, AS_OF, TENANT)
    asked = t["request"].count()
    assert out["reply"].count() == asked == out["reply"].select("cd_tiss_demnstrv_retorno").distinct().count()
    key = "cd_tiss_demnstrv_retorno"
    ana = out["analysis_statement"].select(key)
    # a payment statement without dates is written next to its error row
    pay = out["payment_statement"].filter("vl_total_geral_informado is not null").select(key)
    assert ana.unionByName(pay).unionByName(out["error"].select(key)).count() == asked


def test_a_grain_stages_only_what_it_is_made_of(spark):
    """Error rows need no claims, and totals no guide lines: frames are made when they are read."""
    t, kept = Frames(spark, SF), []

    def stage(df):
        kept.append(df)
        return df

    gated = t.gated
    paid = st.payment_statement(gated.filter(F.col("ds_destino") == "PAGAMENTO"), t, AS_OF, stage)
    assert len(paid["error"].columns) == 4 and len(kept) == 2  # verdict and dates
    asked = st.analysis_statement(gated.filter(F.col("ds_destino") == "ANALISE"), t, AS_OF, stage)
    assert len(asked["error"].columns) == 4 and len(kept) == 3
    assert set(asked) == {"statement", "protocol", "guide", "procedure", "denial", "error"}
    kept.clear()
    st.statements(t, AS_OF, TENANT, stage)["error"]
    assert len(kept) == 4  # requests, two verdicts, dates


def test_members_are_asked_for_by_their_numbers_alone(spark):
    """No text of a summary row's place is read or moved to find its member."""
    plan = ENTRIES["r8_resolve_members"].run(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "cd_cco" in plan and "nm_ups" not in plan.split("Relation")[0] and "nm_municipio" not in plan.split("Relation")[0]


def test_totals_read_no_text_of_the_claims(spark):
    plan = ENTRIES["a14_statement_totals"].run(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "vl_total_pago" in plan and "ds_procedimento" not in plan
