"""Problem 1."""

import random

import pytest
from pyspark.sql import functions as F

from leadspark.llm import addresses as A


@pytest.mark.parametrize("address, city, want", [
    ("Ahrdorferallee 45, 10000 Roslenfeld", "Roslenfeld", ("ahrdorferallee", "45", "roslenfeld", "10000")), ("10000 Roslenfeld, Ahrdorfer Allee Nr. 45", None, ("ahrdorferallee", "45", "roslenfeld", "10000")), ("Ahrdorfer-Allee 45, 1. Stock links, 10000 Roslenfeld", "Roslenfeld", ("ahrdorferallee", "45", "roslenfeld", "10000")),
    ("C/O HAUSVERWALTUNG, AHRDORFERALLEE 45, D-10000 ROSLENFELD, DEUTSCHLAND", None, ("ahrdorferallee", "45", "roslenfeld", "10000")), ("182A, rue Ruchoches / 10059 Glafascourt", "Glafascourt", ("rueruchoches".replace("ue", "u"), "182a", "glafascourt", "10059")),
    ("Röschbachgasse 173 – 175, Lömzopburg", "Lömzopburg", ("roschbachgasse", "173-175", "lomzopburg", "")), ("loja 2, Praça Olivóia, 17, 1037-100 Ulmgelonne, PT", "Ulmgelonne", ("pracaolivoia", "17", "ulmgelonne", "1037100")), ("ul. Nowa 98-100, 10-006 Stadt", "Stadt", ("ulnowa", "98-100", "stadt", "10006")),
    ("MÃ¼hlweg 7, 10000 Roslenfeld", "Roslenfeld", ("muhlweg", "7", "roslenfeld", "10000")), ("1005 AR Lunlenveen, unit 4, Graanlaan 223b", None, ("graanlaan", "223b", "lunlenveen", "1005ar")), ("Kühngasse 219 a - 10000 Roslenfeld - Germany", "Roslenfeld", ("kuhngasse", "219a", "roslenfeld", "10000")),
])
def test_parse(address, city, want):
    assert A.parse(address, city) == want


@pytest.mark.parametrize("address", [None, "", "  ", "n/a", "???", ",,,", "x" * 5000, "1", "\n"])
def test_parse_of_nothing_and_of_anything(address):
    got = A.parse(address, None)
    assert got is None or len(got) == 4


@pytest.mark.parametrize("address, city", [
    ("Weg 5, 10000 Roslenfeld", None), ("10000 Roslenfeld, Weg 5", "Roslenfeld"), ("5 rue Nova, 10000 Roslenfeld, FR", "Roslenfeld"), ("Via Tre, 17, 10000 Roslenfeld", "Roslenfeld"), ("Weg 5, 1005 AT, NL", None), ("1. Stock links; Weg 012 b; Roslenfeld", "Roslenfled"),
    ("Weg 43–45, 10-006 Stadt", "Stadt"), ("Pº Nova 3, Stadt", None), ("PÂº Nova 3, Stadt", None), ("17 rue Nova Stadt", None), ("72  D Iepenweg, 1157 AP Stadt", None), ("Stadt, 61-163, 10-006", None), ("c/o Weber, Weg 5, Stadt", "Stadt"), ("HÃªtreweg 5, Stadt", None),
])
def test_the_plain_form_says_what_parse_says(address, city):
    assert A.plain_form(address, city) in (None, A.parse(address, city))


def test_streets_of_many_words_are_read_whole():
    assert A.parse(" ".join(f"w{chr(97 + k)}" for k in range(15)) + " 5, 10000 Stadt", None)[0] == "".join(f"w{chr(97 + k)}" for k in range(15))


def leads(spark, rows):
    return spark.createDataFrame([(k, a, "Roslenfeld", p, None, None, "x") for k, (a, p) in enumerate(rows)], "source_row_id long, address string, city string, phone_e164 string, website_domain string, duplicate_group_id long, town string")


def test_rewrites_are_mined_and_applied(spark):
    r = random.Random(2)
    stems = ["Ahrdorfer", "Birnbach", "Dornwiesen", "Erlgrund", "Föhrhofen", "Haselanger", "Kühnstein", "Lärchmühlen"]
    rows = []
    for k in range(120):
        s, n = r.choice(stems), r.randrange(1, 60)
        phone = f"+49301{k:07d}"
        rows += [(f"{s}allee {n}, 10000 Roslenfeld", phone), (f"{s}al. {n}, 10000 Roslenfeld", phone), (f"{s}allee {n}, Roslenfeld", None)]
    rows += [("Birnbachgasse 7, 10000 Roslenfeld", None)] * 2 + [("Birnbachallee 7, 10000 Roslenfeld", None), ("Birnbahcgasse 7, 10000 Roslenfeld", None)]
    d = leads(spark, rows)
    got = {(r.source_row_id_a, r.source_row_id_b) for r in A.same_place(d).collect()}
    plain = [(" ".join(a.replace("al. ", "allee ").replace("hcg", "chg").replace(", 10000", ",").split()), a) for a, _ in rows]
    want = {(i, j) for j in range(len(rows)) for i in range(j) if plain[i][0] == plain[j][0] and plain[i][1] != plain[j][1]}
    assert len(got & want) >= 0.99 * len(want) and len(got - want) <= 0.01 * len(got)


def test_edges(spark):
    d = leads(spark, [(None, None), ("", None), ("n/a", None), ("Weg 1, 10000 Roslenfeld", None), ("Weg 1, 10000 Roslenfeld", None), ("Weg 1 10000 Roslenfeld " + "," * 3000, None)])
    assert sorted(map(tuple, A.same_place(d).collect())) == [(3, 5), (4, 5)]
    assert A.same_place(d.limit(0)).count() == 0
    assert A.same_place(d.withColumn("duplicate_group_id", F.lit(1).cast("long"))).count() == 0


def test_significance():
    counts = [("end", "al", "allee", 20), ("end", "e", "es", 3), ("end", "g", "gasse", 15)]
    got = A._significant(counts, {("end", "al"): 25, ("end", "g"): 30, ("end", "e"): 1000})
    assert ("end", "al", "allee") in got and ("end", "g", "gasse") in got and ("end", "e", "es") not in got


@pytest.mark.parametrize("right, wrong", [("hauptstrasse", "huuptstrase"), ("bahnhofstrasse", "bajnhofstrase"), ("rosenweg", "rozenwge"), ("birkenpfad", "brikenfpad"), ("altegrabengasse", "latgrabengasse")])
def test_every_spelling_within_the_limit_is_compared(right, wrong):
    to = A.cluster([(right, 30, 100), ("unterdenlinden", 5, 90), (wrong, 1, 1)], A.Rewrites(set()))
    assert to == {right: right, "unterdenlinden": "unterdenlinden", wrong: right}


def test_a_rewrite_at_one_end_is_mined_beside_a_known_one_at_the_other(spark):
    stems = ["birnbach", "dornwies", "erlgrund", "fohrhofen", "haselang", "kuhnstein", "larchmuhl", "tannhain", "ulmenrot", "weidfurt"]
    rows = []
    for k, m in enumerate(stems):
        short, long = ("b", "boulevard") if k % 2 else ("p", "promenade")
        rows += [(f"gr{m}allee", k)] + [(f"grosse{m}allee", k)] * 2 + [(f"kl{m}gasse", 50 + k)] + [(f"kleine{m}gasse", 50 + k)] * 2
        rows += [(f"gr{m}{short}", 100 + k)] + [(f"grosse{m}{long}", 100 + k)] * 2
    d = spark.createDataFrame([("roslenfeld", "7", s, k, None) for s, k in rows], "town string, num string, street string, phone long, domain long")
    found, _ = A.mine(d)
    assert {("end", "b", "boulevard"), ("end", "p", "promenade"), ("start", "gr", "grosse")} <= found
