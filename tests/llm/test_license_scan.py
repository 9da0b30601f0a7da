from __future__ import annotations

from tidemark.llm.license_scan import TEMPLATES, scan_licenses


def test_quotes_are_found_wherever_they_stand(spark):
    apache, gpl = TEMPLATES[2][1], TEMPLATES[7][1]
    pad = " ".join(f"word{i}" for i in range(7))
    changed = gpl.replace("Foundation", "Institute")
    texts = [f"{pad} {apache} {pad}", apache.upper(), " ".join(apache.split()[:10]), changed, pad * 40, TEMPLATES[3][1]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in scan_licenses(df).collect()}
    assert found[0]["licenses"] == found[1]["licenses"] == ["Apache-2.0"]
    assert found[0]["best"] == 1.0
    assert found[2]["licenses"] == found[4]["licenses"] == []
    assert found[3]["licenses"] == ["GPL-3.0"] and 0.8 <= found[3]["best"] < 1
    assert found[5]["licenses"] == ["MIT"]


def test_every_phase_is_found(spark):
    template = TEMPLATES[7][1]
    rows = [(i, " ".join(f"w{k}" for k in range(i)) + " " + template) for i in range(20)]
    found = scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r["licenses"] == ["GPL-3.0"] for r in found)


def test_odd_rows_and_plan(odd_rows, no_rows):
    found = scan_licenses(odd_rows)
    assert found.count() == odd_rows.count() and found.filter("n_templates > 0").count() == 0
    assert scan_licenses(no_rows).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in ("Python", "Arrow", "Exchange") if w in plan]
