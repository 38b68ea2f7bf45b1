"""The pipeline's stages take effect, keep their columns, and survive odd tables; entries equal their SQL."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from claimspark.llm import entries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.keep(stage(spark, out[-1], SF)))
    return out


def test_stages(stages, spark):
    docs, judged, lined, single, masked, packed = stages
    for frame in (judged, lined, single, masked):
        assert frame.columns == docs.columns
    kept = entries.op10_quality_rules(spark, SF).where("kept")
    assert {r[0] for r in judged.select("doc_id").collect()} == {r[0] for r in kept.select("doc_id").collect()}
    assert lined.where(r"not text rlike '[^\\x20\\x09-\\x0D]'").count() == 0 and lined.join(judged, "doc_id", "left_anti").count() == 0
    assert lined.count() <= judged.count() and lined.where("n_chars != length(text)").count() == 0
    assert lined.exceptAll(judged).count() > 0
    assert single.count() <= lined.count() and single.exceptAll(lined).count() == 0
    assert masked.count() == single.count() and masked.where("text rlike '[a-z]@[a-z]+[.]'").count() == 0
    assert packed.select("doc_id").distinct().count() == masked.count()
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0


@pytest.mark.parametrize("name", sorted(entries.oracle_sql()))
def test_entries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.execute(f"create view {table} as select * from read_parquet('{SF}/{table}.parquet')")
    want = con.execute(entries.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    got = entries.queries()[name](spark, SF)
    assert got.columns == columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_line_and_near_dedup_in_turn_keep_the_right_rows(spark):
    """All rows against plain Python: short lines, and equal words broken into other lines."""
    body = [" ".join(f"w{i}x{j}" for j in range(12)) for i in range(6)]
    texts = ["\n".join([body[0], "all rights reserved."]), "\n".join([body[1], "All rights reserved.", "x"]), body[0], "", "x", body[2] + "\n" + body[3]]
    texts += [body[2] + " more\nnew words of its own here", "\n".join([body[4], body[5]]), body[4] + "\nnew words of its own here"]
    w = [f"y{i}" for i in range(18)]
    texts += ["\n".join(" ".join(w[i:j]) for i, j in zip(cut, cut[1:])) for cut in ((0, 6, 12, 18), (0, 3, 9, 15, 18))]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    seen: list[set] = []
    lined = []
    for row in rows:
        left = []
        for line in row[1].split("\n"):
            w = set(line.lower().split())
            if not any(5 * len(w & v) >= 4 * len(w | v) for v in seen if w):
                left.append(line)
            seen += [w] if w else []
        if len(left) < len(row[1].split("\n")) and not "".join(left).strip():
            continue
        lined.append((row[0], "\n".join(left), *row[2:4], len("\n".join(left))))
    sets = []
    for row in lined:
        w = row[1].lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    single = [r for i, r in enumerate(lined) if not any(sets[i] and 5 * len(sets[i] & s) >= 4 * len(sets[i] | s) for s in sets[:i])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    after = corpus_pipeline.keep(corpus_pipeline.line_dedup(spark, docs, SF))
    assert sorted(map(tuple, after.collect())) == lined
    assert sorted(map(tuple, corpus_pipeline.near_dedup(spark, after, SF).collect())) == single
    assert lined != rows and single != lined
