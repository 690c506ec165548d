"""Rule catalogs from files."""

import pytest

from cairn.operators import rules
from cairn.sources.catalogs import COLUMNS, read_catalog
from cairn.sources.readers import SourceError

HEAD = ",".join(COLUMNS)
GOOD = ["gas,lab,LOINC,2019-8,exact,true,\"carbon dioxide, arterial\",a,1,2020-01-01,,", "gas,lab,LOINC,^99.*$,regex,true,,a,1,,,", "fail,dx,ICD-10,J96,prefix,true,,a,1,,,", "fail,dx,ICD-10,J96.9,exact,false,,a,1,,,"]


def folder(tmp_path, lines, head=HEAD):
    (tmp_path / "c.csv").write_text("\n".join([head, *lines]) + "\n")
    return f"file://{tmp_path}"


def test_reads_and_matches(spark, tmp_path):
    cat = read_catalog(spark, folder(tmp_path, GOOD), domains=["lab", "dx"], required=["gas", "fail"])
    assert cat.count() == 4
    df = spark.createDataFrame([("2019-8", "loinc"), ("99x", "LOINC"), ("j96.9", "ICD10"), ("2019-8", "ICD10")], "code string, system string")
    hits = rules.match_codes(df, cat, code="code", system="system")
    assert sorted((r["code"], r["rule"]) for r in hits.collect()) == [("2019-8", "gas"), ("99x", "gas"), ("j96.9", "fail")]


@pytest.mark.parametrize("line", [GOOD[0], "x,lab,LOINC,,exact,true,,a,1,,,", "x,lab,LOINC,(,regex,true,,a,1,,,", "x,lab,LOINC,1,like,true,,a,1,,,", "x,other,LOINC,1,exact,true,,a,1,,,", "x,lab,LOINC,1,exact,true,,a,1,2020-02-01,2020-01-01,", "x,lab,LOINC,1,exact,maybe,,a,1,,,"])
def test_refuses(spark, tmp_path, line):
    with pytest.raises(SourceError):
        read_catalog(spark, folder(tmp_path, [*GOOD, line]), domains=["lab", "dx"])


def test_refuses_header_and_missing_sets(spark, tmp_path):
    with pytest.raises(SourceError, match="header"):
        read_catalog(spark, folder(tmp_path, GOOD, HEAD.replace("notes", "note")))
    with pytest.raises(SourceError, match="required"):
        read_catalog(spark, folder(tmp_path, GOOD), required=["absent"])
