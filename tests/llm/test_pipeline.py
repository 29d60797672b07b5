"""The pipeline against its stages done by hand."""

from compare import connect
from conftest import SF_DIR
from test_near_dedup import brute

import corpus_pipeline
from tellerlake.llm import line_dedup, mixing, pieces, quality_rules


def test_stages_have_their_effects(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    con, current, kept = connect(SF_DIR), docs, {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = str(tmp_path / str(number))
        stage(spark, current, SF_DIR).write.parquet(out)
        before, current = current, spark.read.parquet(out)
        kept[name] = current
        if number < 4:
            assert current.columns == docs.columns
    good = {i for (i,) in con.execute(f"SELECT doc_id FROM ({quality_rules.ORACLE}) WHERE kept").fetchall()}
    assert {r.doc_id for r in kept["quality rules"].select("doc_id").collect()} == good

    con.execute(f"CREATE VIEW good AS SELECT * FROM '{tmp_path}/0/*.parquet'")
    lines = con.execute(f"WITH {line_dedup._SHORT_SQL.format(docs='good')} SELECT doc_id, text FROM lines_kept").fetchall()
    assert sorted(lines) == sorted((r.doc_id, r.text) for r in kept["line dedup"].collect())

    stay = {i for i, _, c in brute(lines) if i == c}
    assert {r.doc_id for r in kept["near dedup"].collect()} == stay

    con.execute(f"CREATE VIEW single AS SELECT * FROM '{tmp_path}/2/*.parquet'")
    copies = con.execute(f"WITH {mixing._TARGETS_SQL.format(docs='single')} SELECT doc_id, copies FROM planned WHERE copies > 0").fetchall()
    mixed = kept["mixing"].groupBy("doc_id").count().collect()
    assert sorted(copies) == sorted((r.doc_id, r["count"]) for r in mixed)

    last = kept["pieces"]
    assert last.count() == kept["mixing"].count() and last.where("not exact").isEmpty()
    texts = {r.doc_id: r.text for r in kept["mixing"].collect()}
    assert all(r.text == texts[r.doc_id] for r in pieces.decoded(last).select("doc_id", "text").collect())


def test_run_gives_the_last_stage_and_takes_an_empty_table(spark, tmp_path):
    result = corpus_pipeline.run(spark, SF_DIR)
    assert result.columns == ["doc_id", "source", *pieces.DERIVED] and result.count() > 0
    spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
