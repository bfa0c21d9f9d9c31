"""Problem 2."""

import random

import pytest

from leadspark.llm import names as N
from leadspark.llm.common import edit_distance, typing_distance
from leadspark.llm.metric import radius_join


def slow_distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, e in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != e)))
        row = new
    return row[-1]


def test_distances():
    r = random.Random(1)
    for _ in range(500):
        a, b = ("".join(r.choice("abc") for _ in range(r.randrange(9))) for _ in "xx")
        d = slow_distance(a, b)
        assert edit_distance(a, b, 20) == d and edit_distance(a, b, 2) == min(d, 3)
    assert typing_distance("abcd", "abdc", 3) == 1 and typing_distance("", "ab", 1) == 2


@pytest.mark.parametrize("cell", [256, 10])
def test_radius_join_equals_brute_force(spark, cell):
    r = random.Random(5)
    keys = [("b" + str(r.randrange(2)), "".join(r.choice("abcd") for _ in range(r.randrange(4, 9)))) for _ in range(150)]
    d = spark.createDataFrame(keys + keys[:10] + [("b0", None), (None, "abc")], "blk string, k string")
    got = {(x.block, x.a, x.b, x.distance) for x in radius_join(d, "blk", "k", 2, cell=cell, pivots=5).collect()}
    u = sorted(set(keys))
    want = {(b, x, y, slow_distance(x, y)) for i, (b, x) in enumerate(u) for c, y in u[i + 1 :] if b == c and slow_distance(x, y) <= 2}
    assert got == want and want


@pytest.mark.parametrize("a, b, want", [
    ("Konditorei Stegeder GmbH", "komditorei stegeder, ohg", True), ("Restaurant am Mühlbach", "Rest. am Muehlbach in Roslenfeld, e.K.", True), ("Grümgräber Blumenhaus", "Blumenhaus Grümgräber", True), ("KosmetikstudioMondkörnchen", "Kosmetik-St. Mondkörnchen", True), ("Stegeder", "Konditorei Stegeder", True),
    ("Café & Bar Foo", "Café u. Bar Foo", True), ("Past. São Mel, Unipeassoal Lda", "Pastelaria Sao Mel", True), ("Café Foo", "Bäckerei Berg", False), ("Vlaaienhuis Zuid Molenheuvel", "Vlaaienhuis Zuid Brinkmans", False), ("Café Wolkenbrösel", "Wolkenbrösel Quellhofer", False),
])
def test_organisations(a, b, want):
    assert N.same_organisation(N.organisation(a, "Roslenfeld"), N.organisation(b, "Roslenfeld")) is want


@pytest.mark.parametrize("a, b, want", [
    ("Theresa Düsgräber", "T. Düsgräber", True), ("Brünhofer, Tilly R.", "Ottilie R. Brünhofer", True), ("KALTHOFER, ALEXANDER", "Alexander Kalthofer / owner", True), ("Günni Quellhofer", "Günther Quellhofer", True), ("Dr. Jan Berg", "Jan Berg (Inh.)", True), ("Theresa Düsgräber", "Friedrich Hülleder", False),
    ("Ursula Berger", "Thomas Berger", False), ("A. Berger", "B. Berger", False),
])
def test_persons(a, b, want):
    assert N.same_person(N.person(a), N.person(b)) is want


def test_rows(spark):
    at = "Weg 1, 10000 Roslenfeld"
    rows = [
        (1, at, "Café Foobar", "Anna Berg", "+4930111111112", None), (2, at, "Cafe Foobar GmbH", "A. Berg", None, None), (3, at, "Bäckerei Zimt", None, None, None), (4, "Weg 9, 10000 Roslenfeld", "Café Foobar", "Anna Berg", "+4930111111112", None),
        (5, None, "Caffé Foobar", "n/a", "+4930111111112", None), (6, at, "Café Foobar", "", None, None), (7, at, None, None, None, None), (8, None, "café foobar", None, None, "shared.example"), (9, at, "Café Foobar, UG", None, None, 1),
    ]
    d = spark.createDataFrame([(k, a, "Roslenfeld", n, p, ph, None if isinstance(x, int) else x, x if isinstance(x, int) else None) for k, a, n, p, ph, x in rows], "source_row_id long, address string, city string, business_name string, decision_maker_name string, phone_e164 string, website_domain string, duplicate_group_id long")
    shared = spark.createDataFrame([("shared.example",)], "domain string")
    got = sorted(map(tuple, N.variants(d, shared).collect()))
    # 4 is elsewhere; 5 has no address and 1's and 4's phone; 8 has nothing but a shared domain; 9 is grouped
    assert got == [("business_name", 1, 2), ("business_name", 1, 5), ("business_name", 2, 6), ("business_name", 4, 5), ("decision_maker_name", 1, 2)]
    assert N.variants(d.limit(0), shared).count() == 0


def test_large_blocks_give_the_same(spark, monkeypatch):
    r = random.Random(7)
    base = ["".join(r.choice("abcdefghijklm") for _ in range(8)) for _ in range(40)]
    rows = [(k, "Weg 1, 10000 Roslenfeld", "Roslenfeld", f"Cafe {(b := r.choice(base))[: r.randrange(7, 9)]}", None, None, None, None) for k in range(80)]
    d = spark.createDataFrame(rows, "source_row_id long, address string, city string, business_name string, decision_maker_name string, phone_e164 string, website_domain string, duplicate_group_id long")
    shared = spark.createDataFrame([], "domain string")
    small = set(map(tuple, N.variants(d, shared).collect()))
    monkeypatch.setattr(N, "BLOCK_ROWS", 20)  # joins instead of the stream
    assert set(map(tuple, N.variants(d, shared).collect())) == small
    monkeypatch.setattr(N, "CELL", 5)  # and metric cells
    assert small and set(map(tuple, N.variants(d, shared).collect())) == small


def test_large_blocks_lose_no_name_that_shares_no_word(spark, monkeypatch):
    # three mistakes in a word, swapped letters twice, abbreviations, one name inside the other, run together, edits over the whole name
    names = ["Stegederhof", "Stagadarhof", "Quellhofer", "Qeullhoefr", "Kosmetikstudio", "Kosmetik-St.", "Wolkenbrösel", "Altewolkenbröselstube", "Blumenhaus Grün", "Blumenhausgrün", "Kond. Berg", "Konditorei Berg", "Mondkörnchen", "Mandkirnchan", "Zum Al Fi", "Zumalfi", "Birnbaum", "Tannhain"]
    people = ["Theresa Stegeder", "Stagadar", "Günther Quellhofer", "Qeullhoefr", "Anna Wolkenbach", "Annawolkenbach", "Jan Li", "J. Li", None]
    rows = [(k, "Weg 1, 10000 Roslenfeld", "Roslenfeld", n, people[k % len(people)], "+4930111111112", None, None) for k, n in enumerate(names)]
    d = spark.createDataFrame(rows, "source_row_id long, address string, city string, business_name string, decision_maker_name string, phone_e164 string, website_domain string, duplicate_group_id long")
    shared = spark.createDataFrame([], "domain string")
    small = set(map(tuple, N.variants(d, shared).collect()))
    assert {("business_name", 0, 1), ("business_name", 6, 7)} <= small
    monkeypatch.setattr(N, "BLOCK_ROWS", 5)
    monkeypatch.setattr(N, "CELL", 1)
    assert set(map(tuple, N.variants(d, shared).collect())) == small


def test_candidates_hold_all_that_the_comparison_accepts():
    r = random.Random(3)
    base = ["stegeder", "konditorei", "cafe", "am", "alt", "kond.", "kosmetik-st.", "kosmetikstudio", "b?ckerei", "backerei", "muhlbach"]

    def typo(w):
        for _ in range(r.randrange(4) if len(w) > 4 else 0):
            k = r.randrange(len(w))
            w = w[:k] + r.choice([w[k + 1 : k + 2] + w[k], "", "x", w[k] + "y"]) + w[k + 2 :]
        return w

    names = [" ".join(typo(r.choice(base)) for _ in range(r.randrange(1, 4))) for _ in range(200)]
    for is_person, same in ((False, lambda a, b: N.level_of(a, b) is not None), (True, N.same_person)):
        found = set()
        keys = {n: N._keys(n, is_person) for n in names}
        for kind in "wj":
            have = sorted({k for v in keys.values() for c, k in v if c == kind})
            found |= {(kind, x, y) for p in N.near_keys(have, None, kind, is_person) for x, y in (p, p[::-1])}
        run = lambda n: n.replace(" ", "").replace(".", "")
        for a in names:
            for b in names:
                if a < b and same(a, b):
                    assert any(c == d and (x == y or (c, x, y) in found) for c, x in keys[a] for d, y in keys[b]) or run(a) in run(b) or run(b) in run(a), (a, b)


def test_names_without_variants_are_not_read(monkeypatch):
    """A block's names of which only one is stored have no variants; the links are those of reading all of them."""
    import random

    from leadspark.llm import names

    r = random.Random(3)
    firms, whos = ("Cafe Adler GmbH", "Café Adler", "Kafe Adler", "Metzgerei Huber", None, "-"), ("Anna Berg", "Berg, Anna", "A. Berg", None, None, "n/a")
    for n in (2, 3, 5):
        for _ in range(150):
            some = r.sample(firms, r.choice((1, 2, 4))), r.sample(whos, r.choice((1, 2, 4)))
            rows = [(k, r.random() < 0.5, r.choice(some[0]), r.choice(some[1]), r.choice(("Ulm", None)), "ulm", r.choice((1, 2, None)), None) for k in range(n)]
            block = r.choice(("a|ulm|1|weg", "p+49301234567"))
            assert sorted(names._links(block, rows)) == sorted(names._row_pairs(block, names._read(rows)))

    def fail(*_):
        raise AssertionError("read")

    monkeypatch.setattr(names, "person", fail)
    assert names._links("a|ulm|1|weg", [(k, True, f, "Anna Berg", "Ulm", "ulm", None, None) for k, f in enumerate(firms[:2])]) == [("business_name", 0, 1)]
    monkeypatch.setattr(names, "organisation", fail)
    assert names._links("a|ulm|1|weg", [(k, True, "Cafe Adler", None, "Ulm", "ulm", None, None) for k in range(9)]) == []


def test_long_legal_forms_with_mistakes():
    from leadspark.llm import names
    from leadspark.llm.common import typing_distance

    forms = ("unipessoallda", "unipessoal", "gmbhcokg")
    for f in forms:
        tails = [f] + [f[:i] + x + f[j:] for i in range(len(f)) for j in (i, i + 1) for x in ("", "x", "ab", f[i : i + 2][::-1])]
        for t in [*tails, *[t[:3] + "q" + t[4:] for t in tails], "konditorei", "backerei"]:
            if 8 < len(t) < 16:
                assert names._long_form(t) == any(typing_distance(t, x, 2) <= 2 for x in forms)


def test_workers_do_not_walk_what_earlier_tasks_kept(spark):
    from leadspark.llm.common import map_batches

    def kept(b):
        import gc

        return {"n": [gc.get_freeze_count()]}

    assert map_batches(spark.range(1), kept, "n long").first().n > 0


def test_missing_strips_all_that_java_calls_blank(spark):
    from pyspark.sql import functions as F

    from leadspark.llm.common import missing

    blank = "".join(map(chr, [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
    d = spark.createDataFrame([(blank + "N/A" + blank,), (blank,), (None,), ("​N/A",), ("\x1cN/A",), ("N / A",)], "s string")
    assert [x.m for x in d.select(missing("s").alias("m")).collect()] == [True, True, True, False, False, False]
    assert d.select(F.explode(F.split("s", "")).alias("s")).where("s <> ''").where(missing("s") != (F.regexp_replace("s", r"(?U)^\s+|\s+$", "") == "")).count() == 0
