"""Files in and out."""

import pytest

from leadspark.operators.checkpoint import Checkpoints
from leadspark.plans import pipeline
from leadspark.sources import csv as source
from leadspark.sources import sinks


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.csv").write_text('Name,Category,Address,Phone,Website,City,Rating,Reviews\nCafé Müller GmbH,Bakery,"Hauptstr. 5, 10115 Berlin, Germany",+49 30 1234567,a.de,berlin,4.5,(12)\nBar,bar,n/a,030 7654321,,berlin,,\nshort,row\nToo,many,fields,1,2,3,4,5,6,7\n', encoding="utf-8")
    (tmp_path / "b.csv").write_bytes("title;type;vicinity;tel;site;town\nBäckerei Süß;Bäckerei;keine Angabe;0049 30 1234567;https://b.de/?ref=x;Wien\n".encode("latin-1"))
    (tmp_path / "c.csv").write_text("business_name\nFoo\n")
    (tmp_path / "notes.txt").write_text("no")
    return tmp_path


def test_sniffing():
    assert source.detect_encoding("ä".encode()) == "UTF-8" and source.detect_encoding("ä".encode("latin-1")) == "ISO-8859-1" and source.detect_encoding(b"\xef\xbb\xbfx") == "UTF-8"
    assert source.detect_encoding("xä".encode()[:-1], True) == "UTF-8"  # cut within a character
    assert source.detect_delimiter("a;b\n1;2\n") == ";" and source.detect_delimiter("") == ","


def test_headers():
    assert source.map_columns(["URL", "Name", "Title", "z"]) == {"business_name": "Name", "website_raw": "URL"}
    assert source.map_columns(["website", "url"])["google_maps_url"] == "url"


def test_folder(spark, folder):
    d = source.read_folder(spark, str(folder))
    got = {r.business_name: r for r in d.collect()}
    assert sorted(r.source_row_id for r in got.values()) == list(range(len(got))) and "Too" not in got
    assert got["Bäckerei Süß"].address is None and got["Bäckerei Süß"].city == "Wien" and got["Bar"].address is None
    assert got["Foo"].category is None and got["Foo"].source_file == "c.csv" and got["short"].address is None
    with pytest.raises(FileNotFoundError):
        source.read_folder(spark, str(folder / "none"))


def test_run(spark, folder, tmp_path):
    pages = spark.createDataFrame([("a.de", "https://a.de", '<html lang="de-AT"><title>Café A | Home</title><a href="https://facebook.com/a">f</a> max.meier@a.de © 2019</html>'), ("a.de", "https://a.de/impressum", "<p>Geschäftsführer: Max Meier</p><p>Tel.: +49 (30) 123-456</p><p>USt-IdNr.: DE 123456789</p>")], "domain string, url string, html string")
    pages.write.parquet(str(tmp_path / "pages"))
    spark.createDataFrame([("a.de", True, ["10 mx.a.de"])], "domain string, has_mx boolean, hosts array<string>").write.parquet(str(tmp_path / "mx"))
    o = pipeline.Options(pages=str(tmp_path / "pages"), mx=str(tmp_path / "mx"), year=2025, checkpoints=str(tmp_path / "points"))
    files = pipeline.run(spark, str(folder), str(tmp_path / "out"), "x", o)
    text = open(files["full"], "rb").read()
    assert text.startswith(b"\xef\xbb\xbf") and b"Max Meier" in text and b"DE123456789" in text
    slim = source.read_strings(spark, files["slim"])
    row = {r.companyName: r for r in slim.collect()}["Café A"]
    assert (row.email, row.firstName, row.lastName, row.reviewsCount) == ("max.meier@a.de", "Max", "Meier", "12")
    assert "Filled fields" in open(files["report"]).read() and open(files["searches"]).read().startswith("business_name")
    # the two phones of Berlin are one number in two notations: one record less
    assert slim.count() == 4
    again = pipeline.run(spark, str(folder), str(tmp_path / "out2"), "x", pipeline.Options(checkpoints=str(tmp_path / "points"), resume=True))
    assert open(again["slim"]).read() == open(files["slim"]).read()
    assert source.latest(spark, str(tmp_path / "out")).endswith("cleaned_enriched_x.csv")
    assert sinks.slim_path("/o/cleaned_enriched_x.csv") == "/o/slim_final_x.csv"


def test_checkpoints(spark, tmp_path):
    c = Checkpoints(spark, str(tmp_path / "c"))
    assert c.load() is None
    for n, step in enumerate(("cleaned", "deduped", "filtered", "enriched")):
        c.save(spark.range(n + 1).toDF("x"), step, {"n": n})
    assert len(c.list()) == 3 and c.load()[1:] == ("enriched", {"n": 3}) and c.load()[0].count() == 4
    with pytest.raises(ValueError):
        c.save(spark.range(1).toDF("x"), "nothing")
    c.clear()
    assert c.list() == []
