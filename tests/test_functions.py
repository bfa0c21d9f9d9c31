"""Scalar functions on vectors worked out by hand."""

import pytest
from pyspark.sql import functions as F

from leadspark import functions as X
from leadspark.operators import size


def one(spark, expr, *values):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"c{k} string" for k in range(len(values))))
    return df.select(expr.alias("x")).first().x


@pytest.mark.parametrize("text, want", [("  Café \t Müller ", "Café Müller"), ("a  b", "a b"), (None, ""), ("", "")])
def test_clean_text(spark, text, want):
    assert one(spark, X.clean_text("c0"), text) == want


@pytest.mark.parametrize("text, want", [("4.5 out of 5", 4.5), ("4,5", 4.0), ("7", 5.0), ("none", None), (None, None)])
def test_rating(spark, text, want):
    assert one(spark, X.rating("c0"), text) == want


@pytest.mark.parametrize("text, want", [("(1,234)", 1234), ("1.234", 1), ("x", None), (None, None)])
def test_reviews(spark, text, want):
    assert one(spark, X.reviews_count("c0"), text) == want


@pytest.mark.parametrize("text, want", [("Bakery", "food"), ("Plumber", "non_food"), ("Notary", "other"), ("Spanish restaurant", "beauty"), ("Barber shop", "food"), (None, "other"), ("", "other")])
def test_category(spark, text, want):
    assert one(spark, X.category_class("c0"), text) == want


@pytest.mark.parametrize("text, want", [("Bäckerei Schmidt GmbH & Co. KG", "Bäckerei Schmidt"), ("Foo S.R.L.", "Foo"), ("Foo", "Foo")])
def test_suffix(spark, text, want):
    assert one(spark, X.strip_suffix("c0"), text) == want


@pytest.mark.parametrize("text, want", [
    ("Example.org/Path/?utm_source=x&id=3#top", "https://example.org/Path/?id=3"), ("http://ththre.example.com/fr/825?page=2&ref=x", "https://ththre.example.com/fr/825?page=2"), ("http://a.example.org/en/853/", "https://a.example.org/en/853"),
    ("a.de?x=1&y=&x=2", "https://a.de?x=1&x=2"), (None, None),
])
def test_url(spark, text, want):
    assert one(spark, X.normalize_url("c0"), text) == want


@pytest.mark.parametrize("text, want", [("https://www.shop.co.uk/x", "shop.co.uk"), ("https://a.b.example.de", "example.de"), ("https://localhost", "localhost.")])
def test_domain(spark, text, want):
    assert one(spark, X.domain_of("c0"), text) == want


@pytest.mark.parametrize("text, want", [("www.facebook.com/x", True), ("shop.wixsite.com", True), ("notfacebook.com", False), ("", True), (None, True)])
def test_denylist(spark, text, want):
    assert one(spark, X.denylisted("c0"), text) is want


@pytest.mark.parametrize("text, want", [
    ("Hauptstr. 5, 10115 Berlin, Germany", ("Hauptstr. 5", "10115", "10115 Berlin", "Germany")), ("Damrak 1, 1012 AB Amsterdam", ("Damrak 1", "1012 AB", "1012 AB Amsterdam", "")),
    ("ul. Nowa 3, 00-001 Warszawa", ("ul. Nowa 3", "00-001", "00-001 Warszawa", "")), ("Rua A, 1000-001 Lisboa", ("Rua A", "1000-001", "1000-001 Lisboa", "")), (None, (None, None, None, None)),
])
def test_address(spark, text, want):
    assert tuple(one(spark, X.address_parts("c0"), text)) == want


@pytest.mark.parametrize("phone, region, want", [
    ("+49 (0) 30 1234567", None, ("+49301234567", "DE", True)), ("0049 30 1234567", None, ("+49301234567", "DE", True)), ("030 1234567", "DE", ("+49301234567", "DE", True)), ("06 1234567", "IT", ("+39061234567", "IT", True)),
    ("call us", "DE", (None, None, False)), ("123", None, ("+123", None, False)), (None, None, (None, None, False)),
])
def test_phone(spark, phone, region, want):
    assert tuple(one(spark, X.parse_phone("c0", "c1"), phone, region)) == want


@pytest.mark.parametrize("text, want", [("Dr. Hans Müller (CEO)", "Hans Müller"), ("A|B", "A B"), (None, "")])
def test_person_name(spark, text, want):
    assert one(spark, X.person_name("c0"), text) == want


@pytest.mark.parametrize("text, want", [("Hans Müller", True), ("Jan van der Berg", True), ("Owner Team", False), ("J Smith", False), ("a@b.de", False), (None, False)])
def test_is_person(spark, text, want):
    assert one(spark, X.is_person("c0"), text) is want


def test_names_from_mail(spark):
    assert tuple(one(spark, X.split_name("c0"), "Jan van der Berg")) == ("Jan", "van der Berg")
    assert one(spark, X.name_from_email("c0"), "john.smith@x.de") == "John Smith"
    assert one(spark, X.name_from_email("c0"), "info@x.de") is None
    assert one(spark, X.email_pattern(F.array("c0")), "john.smith@x.de") == ["firstname.smith"]
    assert one(spark, X.emails_in("c0"), "Write A.B@x.de, noreply@x.de or a.b@x.de; x@example.com") == ["a.b@x.de"]
    assert "kontakt@x.de" in one(spark, X.likely_emails("c0", "c1"), "x.de", "Foo & Co") and one(spark, X.likely_emails("c0"), "localhost") == []


@pytest.mark.parametrize("text, want", [("18", 18.0), ("10-50", 30.0), ("50+", 75.0), ("2-5", 3.5), ("~30", 30.0), ("approx. 12", 12.0), (None, None)])
def test_employees(spark, text, want):
    assert one(spark, size.parse_employees("c0"), text) == want


def test_buckets(spark):
    df = spark.createDataFrame([(1.0,), (1.5,), (30.0,), (75.0,), (500.0,)], "n double")
    assert [r[0] for r in df.select(size.bucket(F.col("n"))).collect()] == ["1", "2-5", "21-50", "51-200", "200+"]


def test_size_of_reviews_and_category(spark):
    df = spark.createDataFrame([(150, "food", "Bakery")], "reviews_count_normalized int, canonical_category string, category string")
    r = size.with_estimate(df, [size.review_signal("reviews_count_normalized"), size.category_signal("canonical_category", "category")], "s").first()
    assert (r.s_bucket, r.s_confidence, r.s_source, r.s_evidence) == ("6-20", "medium", "review_count", "review_count:150_reviews; category_prior:food→6-20")
