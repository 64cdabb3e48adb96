from __future__ import annotations

import pytest

from ledgerline.llm import licenses


def test_edited_split_and_shifted_notices(spark):
    gpl = licenses.TEMPLATES["GPL-3.0"]
    rows = [(k, "pad " * k + gpl.upper() + " tail" * 50) for k in range(30)]
    rows += [
        (100, gpl.replace("version 3", "version 4")), (101, gpl.replace("General", "Generic")),
        (102, gpl.replace(" ", "\n\t")), (103, "x " * 30000 + gpl), (104, None), (105, ""), (None, gpl), (None, gpl), (106, gpl + " " + gpl),
    ]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, license string")
    out = {r["doc_id"]: (r["license"], round(r["containment"], 3)) for r in licenses.scan_licenses(df).collect()}
    assert set(out) == {*range(30), 100, 102, 103, None, 106}
    assert out[100] == ("GPL-3.0", 0.875) and out[103] == ("GPL-3.0", 1.0)
    assert licenses.scan_licenses(df.limit(0)).count() == 0


def test_short_templates_are_refused(awkward):
    with pytest.raises(ValueError):
        licenses.scan_licenses(awkward, {"x": "too short"})


def test_main_path_is_native(docs):
    plan = licenses.scan_licenses(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
