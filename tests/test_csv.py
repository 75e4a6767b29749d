"""A hand-written export: quotes, commas, line breaks and missing markers."""

from vitrine.sources.ingest import ingest_csv, write_csv

EXPORT = '''id,Libellé,note (texte)
1,"He said ""hi"", ok",NA
2,"two
lines",null
3,plain,"a, b"
4,,N/A
5,Nathalie,n/a x
'''


def test_standard_quoting(spark, tmp_path):
    path = tmp_path / "export.csv"
    path.write_text(EXPORT, encoding="utf-8")
    df = ingest_csv(spark, f"file://{path}")
    assert df.columns == ["id", "libelle", "note _texte_"]
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [("1", 'He said "hi", ok', None), ("2", "two\nlines", None), ("3", "plain", "a, b"), ("4", None, None), ("5", "Nathalie", "n/a x")]
    write_csv(df, f"file://{tmp_path}/again")
    assert sorted(tuple(r) for r in ingest_csv(spark, f"file://{tmp_path}/again").collect()) == rows
    assert ingest_csv(spark, f"file://{path}", missing=()).where("id = '1'").first()[2] == "NA"
