"""Fused language: accuracy against the tables' languages, evidence, edge rows."""

from pyspark.sql import functions as F
from tidemark.llm import langid
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_query_agrees_with_tables(spark):
    got = QUERIES["op9_language_id"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = got.cache()
    assert rows.count() == docs.count() + pages.count()
    j = docs.join(rows, "doc_id")
    assert j.where("lang = language").count() >= 0.97 * docs.count()
    assert j.where("kept").count() >= 0.97 * docs.count()
    assert rows.where("page_id is not null and kept").count() >= 0.95 * pages.count()


def test_edges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    model = langid.fit(langid.records_of_documents(docs))
    some = docs.where("lang = 'de'").first().text
    rows = [(1, None, None, None), (2, "", "de", "src0"), (3, some, None, "nowhere"), (4, some, "en", "src1"), (5, some, "xx-YY", None),
            (6, "zz", "fr-CA", "src1"), (None, some * 40, "DE_at", "src1"), (3, some, None, "nowhere")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, lang string, source string, p string")
    got = langid.identify(langid.records_of_documents(df), model)
    assert got.columns == [*df.columns, "language", "text_language", "confidence", "kept"]
    by = {r.doc_id: r for r in got.collect()}
    assert got.count() == len(rows) and not by[1].kept and not by[2].kept and by[2].text_language is None
    assert all(by[i].text_language == "de" and by[i].kept for i in (3, 4, 5, None)) and by[6].language == "fr"
    assert all(0 <= r.confidence <= 1 for r in got.collect())
    empty = langid.records_of_documents(df.limit(0))
    assert langid.identify(empty, langid.fit(empty)).count() == 0
    assert langid.identify(langid.records_of_documents(df), langid.fit(empty)).where("kept").count() == 0


def test_pages_fields(spark):
    rows = [(1, "https://u:p@WWW.Host.DE:80/a?b#c", '<html class=x lang="de-AT"><script>if (a<b) x="</p>"</script><p>Der Text</p>'),
            (2, None, None), (3, "notaurl", "<<<p>a < b")]
    got = {r.row.page_id: r for r in langid.records_of_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    r = got[1]
    assert (r._host, r._suffix, r._declared, r._text.split()) == ("www.host.de", "de", "de-AT", ["Der", "Text"])
    assert got[2]._text is None and got[3]._host == "" and "a < b" in got[3]._text
    codes = spark.createDataFrame([("EN",), ("en-US",), (" fr ",), ("english",), ("",), (None,)], "x string").select(langid.code(F.col("x")))
    assert [r[0] for r in codes.collect()] == ["en", "en", "fr", None, None, None]
