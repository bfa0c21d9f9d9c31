from leadspark.streaming.leads import cleaned_stream, read_stream, write_stream


def test_stream(spark, tmp_path):
    head = "city,business_name,category,address,phone_raw,website_raw,email_raw,google_maps_url,rating,reviews_count,lat,lon\n"
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_text(head + "berlin,A GmbH,Bakery,x,+49 30 1234567,a.de,,,4.5,1,,\nberlin,A again,Bakery,x,0049 30 1234567,b.de,,,,,,\nberlin,B,bar,x,,,,,,,,\nberlin,C,bar,x,,,,,,,,\n")
    q = write_stream(cleaned_stream(read_stream(spark, str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "point"))
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 3 and got.where("phone_e164 = '+49301234567'").count() == 1
