"""Operators against small cases and brute force."""

import random

import pytest
from pyspark.sql import functions as F

from leadspark.operators import cache, clean, dedupe, pages, people, verify
from leadspark.operators import jsonld as J
from leadspark.operators.components import components
from leadspark.plans import report


def union_find(n, edges):
    p = list(range(n))

    def find(x):
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        p[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


@pytest.mark.parametrize("n, m", [(30, 12), (60, 70), (40, 0)])
def test_components(spark, n, m):
    r = random.Random(n)
    edges = [(r.randrange(n), r.randrange(n)) for _ in range(m)] + [(k, k + 1) for k in range(5, 15)]
    want = union_find(n, edges)
    got = {x.id: x.component for x in components(spark.createDataFrame(edges + [(None, 1)], "a long, b long")).collect()}
    assert got == {v: want[v] for v in got} and set(got) == {v for a, b in edges if a != b for v in (a, b)}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


LEAD = "source_row_id long, business_name string, category string, address string, phone_raw string, google_maps_url string, website_raw string, website_normalized string, website_domain string, phone_e164 string, phone_valid boolean, rating string, rating_normalized double, reviews_count string, reviews_count_normalized int, lat string, lon string"


def lead(spark, *rows):
    names = [f.split()[0] for f in LEAD.split(",")]
    return spark.createDataFrame([tuple(dict(zip(("source_row_id",), (k,)), **r).get(n) for n in names) for k, r in enumerate(rows)], LEAD)


def test_dedupe_by_keys(spark):
    p = "+4930123456"
    d = lead(spark, {"phone_e164": p, "website_domain": "a.de"}, {"phone_e164": p, "website_domain": "b.de"}, {"website_domain": "b.de"}, {"website_domain": "gmail.com"}, {"website_domain": "gmail.com"})
    assert {r.id: r.component for r in dedupe.groups(d).collect()} == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4}
    got = dedupe.deduplicate(d).select("source_row_id", "duplicate_group_id", "duplicate_count").collect()
    assert sorted(map(tuple, got)) == [(0, 1, 3), (3, None, 1), (4, None, 1)]


def brute(rows):
    """All pairs of a row that no key links with a later row, scored one by one."""
    out = set()
    for i, (n, a) in enumerate(rows):
        for j in range(i + 1, len(rows)):
            if n and a and rows[j][0] and rows[j][1] and dedupe.name_address_score(n, a, *rows[j]) >= dedupe.LEAST:
                out.add((i, j))
    return out


def test_fuzzy_equals_brute_force(spark):
    r = random.Random(3)
    words = ["backerei", "schmidt", "cafe", "central", "muller", "haus", "garten", "restaurant", "adler", "krone"]
    rows = []
    for _ in range(70):
        n = " ".join(r.sample(words, r.choice((1, 2, 3))))
        if r.random() < 0.4:
            k = r.randrange(len(n))
            n = n[:k] + r.choice("abcxyz") + n[k + 1 :]
        rows.append((n, r.choice(["", f"hauptstr {r.randrange(4)} 10115 berlin"])))
    d = lead(spark, *[{"business_name": n, "address": a} for n, a in rows])
    none = spark.createDataFrame([], "id long")
    got = {(x.a, x.b) for x in dedupe.fuzzy_edges(d, none).collect()}
    assert got == brute(rows) and got


def test_ratios():
    assert dedupe.indel("abc", "abd") == pytest.approx(200 * 2 / 6) and dedupe.token_sort_ratio("b a", "a b") == 100
    assert dedupe.partial_ratio("str 5", "haupt str 5 berlin") == 100 and dedupe.name_address_score("x", "", "x", "") == 80


def test_best_record_ties_go_to_the_first(spark):
    d = lead(spark, {"phone_e164": "+4930123456", "business_name": "x"}, {"phone_e164": "+4930123456", "business_name": "y"})
    assert dedupe.deduplicate(d).first().business_name == "x"


def test_cache(spark):
    now = F.lit("2025-01-31 00:00:00").cast("timestamp")
    day = lambda d: f"2025-{d} 00:00:00"
    rows = [("a.de", "p", "success", day("01-30"), day("02-28")), ("a.de", "p", "failed", day("01-01"), None), ("b.de", "p", "success", day("01-20"), day("01-25")), ("c.de", "p", "failed", day("01-30"), day("02-03")), ("d.de", "p", None, "2024-12-01 00:00:00", None)]
    t = cache.of_table(spark.createDataFrame(rows, "domain string, provider string, status string, c string, e string").select(cache.key("domain", "provider").alias("cache_key"), "domain", "provider", "status", F.to_timestamp("c").alias("created_at"), F.to_timestamp("e").alias("expires_at")))
    d = spark.createDataFrame([(k, x) for k, x in enumerate(["a.de", "b.de", "c.de", "d.de", "", None])], "i int, website_domain string")
    assert {r.website_domain: r.cached_status for r in cache.lookup(d, t, "p", now).collect() if r.cached_status} == {"a.de": "success", "c.de": "failed"}
    assert {r.website_domain for r in cache.not_cached(d, t, "p", now).collect()} == {"b.de", "d.de"}
    s = cache.stats(t, now).first()
    assert (s.total, s.domains, s.success, s.failed, s.expired) == (5, 4, 3, 2, 1)
    new = cache.entries(spark.createDataFrame([("c.de", "p", "success", "{}", None)], "domain string, provider string, status string, result string, error_reason string"), now)
    up = cache.upsert(t, new)
    assert {r.domain: r.status for r in up.collect()}["c.de"] == "success" and up.count() == 4
    assert cache.without_expired(t, now).count() == 4 and cache.without_failed(t).count() == 3 and cache.without(t, "a.de", "p").count() == 3
    assert [tuple(r)[:2] for r in cache.failed(t, now).collect()] == [("c.de", "p")]
    assert cache.deny(spark.createDataFrame([("x.facebook.com",), ("ok.de",)], "website_domain string"), "p", now).count() == 1
    assert spark.range(1).select(cache.key(F.lit("a.de"), F.lit("free"))).first()[0] == "5ac458d2bc09b4f6c872bea5a2b498c0"


def test_verify(spark):
    d = spark.createDataFrame([(1, "a@x.de"), (2, "bad"), (3, "a@nomx.de"), (4, None), (5, "b@x.de"), (6, "c@unknown.de"), (7, "c@x.de")], "i int, email string")
    mx = spark.createDataFrame([("x.de", True, ["20 b", "10 a"]), ("nomx.de", False, [])], "domain string, has_mx boolean, hosts array<string>")
    probes = spark.createDataFrame([("a@x.de", "a", 450), ("a@x.de", "b", 250), ("b@x.de", "a", 550), ("c@x.de", "a", 450)], "email string, host string, code int")
    got = {r.i: (r.verification_status, r.verification_confidence) for r in verify.verify(d, mx, probes).collect()}
    assert got == {1: ("verified", "high"), 2: ("invalid", "high"), 3: ("invalid", "high"), 4: ("unverified", "low"), 5: ("invalid", "high"), 6: ("likely_valid", "medium"), 7: ("likely_valid", "medium")}
    assert mx.select(verify.by_preference(F.col("hosts"))).first()[0] == ["a", "b"]


def test_pages(spark):
    h = '<html lang="de-AT"><head><title>Foo &amp; Bar | Home</title><meta name="description" content="We bake"></head><body>© 2019-2024 since 1998 <a href="/x"></a><a href="https://www.facebook.com/1"></a><a href="https://facebook.com/2"></a> info@foo.de noreply@foo.de</body></html>'
    d = spark.createDataFrame([(h,), ("<p>willkommen impressum</p>",), (None,)], "h string")
    got = d.select(pages.language("h"), pages.title("h"), pages.description("h"), pages.social_links("h")["facebook"], pages.business_age("h", 2026)).collect()
    assert tuple(got[0]) == ("DE", "Foo & Bar", "We bake", "https://www.facebook.com/1", 28)
    assert tuple(got[1]) == ("DE", None, None, None, None) and tuple(got[2]) == (None,) * 5
    crawled = pages.crawl(spark.createDataFrame([("foo.de",)], "domain string"), spark.createDataFrame([("https://foo.de/", h), ("https://foo.de/kontakt", "a@foo.de"), ("https://other.de", "b@other.de")], "url string, html string")).first()
    assert crawled.emails == ["info@foo.de", "a@foo.de"] and crawled.success


def test_jsonld(spark):
    block = lambda t: f'<script type="application/ld+json">{t}</script>'
    h = block('<!-- {"@graph": [{"@type": ["Bakery"], "name": "B", "telephone": 5, "address": [{"streetAddress": "S 1", "postalCode": "1", "addressLocality": "L", "addressCountry": {"name": "DE"}}], "founder": {"givenName": "A", "familyName": "B"}, "numberOfEmployees": {"minValue": 10, "maxValue": 50}, "openingHoursSpecification": [{"dayOfWeek": ["Monday", "https://schema.org/Tuesday"], "opens": "09:00", "closes": "18:00"}], "sameAs": ["https://www.linkedin.com/company/b"], "geo": {"latitude": "1.5", "longitude": 2},},]} -->') + block('{"@type": "WebSite", "name": "W"}') + block('{"@type": "Organization", "contactPoint": [{"email": "mailto:X@b.de"}]}')
    r = spark.createDataFrame([(h,), ("<p>",), (None,), (block("no json"),)], "h string").select(J.jsonld("h").alias("j")).collect()
    j = r[0].j
    assert (j.business_name, j.address, j.founder_name, j.employee_count, j.opening_hours, j.business_type, j.email, j.lat) == ("B", "S 1, 1 L, DE", "A B", "10-50", "Mon,Tue 09:00-18:00", "food", "x@b.de", 1.5)
    assert j.social_links == {"linkedin": "https://www.linkedin.com/company/b"} and all(x.j.business_name is None for x in r[1:])
    assert J._staff({"value": 18}) == "18" and J._staff(12.0) == "12" and J._staff({"minValue": 3}) == "3+"


def test_people(spark):
    assert people.find_owner("Geschäftsführer: Max Müller") == ("Max Müller", "Managing Director", "high") and people.find_owner("Inhaber\nAnna Berg")[0] == "Anna Berg" and people.find_owner(None)[0] is None
    d = spark.createDataFrame([("<p>Geschäftsführer: Max Müller</p>",), ("<p>Inhaberin: Eva Lang</p><p>Tel.: +49 (30) 123-456</p><p>USt-IdNr.: DE 123456789</p><p>info@x.de eva.lang@x.de</p>",)], "h string").select(people.legal_notice("h").alias("n")).collect()
    assert (d[0].n.owner_name, d[0].n.confidence) == ("Max Müller", "medium")
    assert (d[1].n.phone, d[1].n.vat_id, d[1].n.email, d[1].n.confidence) == ("+49 30 123 456", "DE123456789", "eva.lang@x.de", "high")
    v = spark.createDataFrame([("a.de", 1, "<p>Anna Berg - Head of Sales manager</p>"), ("a.de", 2, "<p>Max Müller, owner of this</p>"), ("b.de", 0, "x")], "domain string, ordinal int, html string")
    m = spark.createDataFrame([("b.de", ["john.smith@b.de"])], "domain string, emails array<string>")
    got = {r.domain: (r.name, r.confidence) for r in people.decision_maker(v, m).collect()}
    assert got == {"a.de": ("Max Müller", "high"), "b.de": ("John Smith", "medium")}


def test_filter_categories(spark):
    d = spark.createDataFrame([("Bakery", "food"), ("Plumber", "non_food"), (None, None)], "category string, canonical_category string")
    assert clean.filter_categories(d, "bak,,").count() == 1 and clean.filter_categories(d, " , ").count() == 3


def test_report(spark):
    d = spark.createDataFrame([(k, v) for k, v in enumerate([0, 40, 41, 60, 61, 100, None])], "source_row_id long, s int")
    assert [r.n for r in report.histogram(d, "s").orderBy("bin").collect()] == [1, 2, 1, 1]
    assert [r.s for r in report.top_rows(d, "s", 2, 50).collect()] == [100, 61]
    rules = [("a", F.col("s") > 50, 10), ("b", F.col("s"), 0.5)]
    assert d.where("s = 100").select(report.points(rules, 40), report.breakdown(rules)["b"], report.class_of(F.lit(80), [(75, "hot"), (50, "warm")], "cold")).first() == (40.0, 50.0, "hot")


def test_fuzzy_query_needs_no_town_and_no_number(spark, tmp_path):
    from leadspark.plans import queries

    rows = [("Jaslauville", "Hauptstrasse 7, 10115 Jaslauville"), ("Jaslauvile", "10115 Jaslauville, Hauptstrasse 7"), (None, "Hauptstrasse 7, 10115 Jaslauville")]
    d = spark.createDataFrame([(k, None, None, "Backerei Schmidt", a, c) for k, (c, a) in enumerate(rows)], "source_row_id long, phone_e164 string, website_domain string, business_name string, address string, city string")
    d.write.parquet(f"{tmp_path}/cleaned_enriched.parquet")
    spark.createDataFrame([], "domain string").write.parquet(f"{tmp_path}/shared_domains.parquet")
    assert {tuple(r) for r in queries.dedupe_fuzzy(spark, str(tmp_path)).collect()} == {(0, 1), (0, 2), (1, 2)}
    assert "dedupe_whole" in queries.QUERIES


@pytest.mark.parametrize("most", [10**6, 10])
def test_components_of_a_long_path_need_few_jobs(spark, most):
    """In one task, and by contraction where the forests are too large for it."""
    path = [(k, k + 1) for k in range(0, 3000, 2)] + [(k + 1, k) for k in range(1, 3000, 2)]
    edges = spark.createDataFrame(path + [(5000, 4000)], "a long, b long").repartition(7)
    spark.sparkContext.setJobGroup(f"path {most}", "")
    got = {x.id: x.component for x in components(edges, most=most).collect()}
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"path {most}"))
    spark.sparkContext.setJobGroup("", "")
    assert got == {k: 0 for k in range(3001)} | {4000: 4000, 5000: 4000}
    assert most < 100 or jobs <= 12
