"""Problem 3: every damage that can be made on purpose is found, and what is whole is left alone."""

import pytest

from leadspark.llm import encoding as E

WHOLE = ["Bäckerei Süß", "Épicerie de l'Écluse", "Pastelaria Pão & Canela", "Confeitaria MAÇÃ DOCE", "Piekarnia Śwęcki", "Żółty Domek", "Plain", "Wer? Wir!", "Café №1", "Großhandel ½ Preis", "Kącik™", "Pº Almanjal, 118", "FERÛLET HÔTEL", "PLÉAÎNÉ", "Москва", "", "?", "Šimek & Syn", "Ørsted"]
GOOD = ["Bäckerei Müller", "Großhandel Süße Träume", "Pâtisserie Brévessin", "Panadería Peñón", "Salão de Chá", "Piekarnia Świński", "Caffè Città"]


@pytest.fixture(scope="module")
def known():
    words = [w for w in WHOLE + GOOD if w] * 40
    counts: dict[str, int] = {}
    for w in words:
        s = f" {w.lower()} "
        for i, c in enumerate(s):
            if c in E.LETTERS:
                k = E._key(s[i - 1], c, s[i + 1])
                counts[k] = counts.get(k, 0) + 1
    counts["$aff"] = counts["$itt"] = 40
    return E.Contexts(counts)


@pytest.mark.parametrize("text", WHOLE)
def test_whole(known, text):
    assert E.repair(text, known) == (text, False) and E.repair(None, known) == (None, False)


@pytest.mark.parametrize("text", GOOD)
@pytest.mark.parametrize("charset", ["cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1250"])
def test_round_trip_of_utf8_read_otherwise(known, text, charset):
    try:
        bad = text.encode("utf-8").decode(charset)
    except UnicodeDecodeError:
        pytest.skip("the charset lacks a byte")
    assert E.repair(bad, known) == (text, True)


def test_twice(known):
    bad = "Bäckerei".encode().decode("latin-1").encode().decode("latin-1")
    assert E.repair(bad, known) == ("Bäckerei", True)


@pytest.mark.parametrize("bad, good", [("B„ckerei M\x81ller", "Bäckerei Müller"), ("BŠckerei MŸller", "Bäckerei Müller"), ("Großhandel".replace("ß", "Я"), "Großhandel"), ("Panader¡a Pe¤¢n", "Panadería Peñón")])
def test_one_byte_charsets(known, bad, good):
    assert E.repair(bad, known) == (good, True)


def test_lost_letters(known):
    assert E.repair("B�ckerei", known)[1] and E.repair("B?ckerei", known) == ("Bäckerei", True) and E.repair("Caff? Foo", known)[1] and not E.repair("Fertig? Ja", known)[1]


def test_automaton():
    assert E.decode_spans("Ã¤x", "cp1252") == ("äx", 1) and E.decode_spans("ÃO", "cp1252") == ("ÃO", 0) and E.decode_spans("Ã", "cp1252")[1] == 0


def test_rows(spark):
    from leadspark.llm.encoding import find_damage

    rows = [(k, "Bäckerei", "x", 7) for k in range(6)] + [(6, "BÃ¤ckerei", None, 7), (7, "BÃ¤ckerei", "", 7), (8, None, "stra�e " * 3000, 7)]
    d = spark.createDataFrame(rows, "source_row_id long, business_name string, address string, value int")
    got = sorted((r.source_row_id, r.field_name, r.restored[:8]) for r in find_damage(d, "source_row_id", ["business_name", "address"]).collect())
    assert got == [(6, "business_name", "Bäckerei"), (7, "business_name", "Bäckerei"), (8, "address", "stra�e s")]
    assert find_damage(d.limit(0), "source_row_id", ["business_name", "address"]).count() == 0


def test_letters_misread_as_letters(spark):
    from leadspark.llm.encoding import find_damage

    good = ["Kwiac. Brziiński", "ul. Topolańska 145", "Piekarnia Kręcik", "España", "Peñón", "Bäckerei"]
    bad = ["Kwiac. Brziiñski", "ul. Topolañska 145", "Piekarnia Krêcik"]
    mistyped = ["Bkäcerei", "ul. Topolańrska 145"]
    rows = [(k, v) for k, v in enumerate(good * 25 + bad + mistyped)]
    d = spark.createDataFrame(rows, "source_row_id long, business_name string")
    got = sorted((r.source_row_id, r.restored) for r in find_damage(d, "source_row_id", ["business_name"]).collect())
    assert got == [(150, good[0]), (151, good[1]), (152, good[2])]


@pytest.mark.parametrize("text, shown_in", [("Магазин", "cp1252"), ("Магазин", "latin-1"), ("Καφενείο", "latin-1"), ("ラーメン", "latin-1"), ("Пекарня", "cp437")])
def test_spans_of_other_scripts_are_decoded(text, shown_in):
    try:
        damaged = text.encode().decode(shown_in)
    except UnicodeDecodeError:
        damaged = "".join(bytes([b]).decode(shown_in) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b) for b in text.encode())
    assert E.repair(damaged) == (text, True)


def test_whole_texts_of_other_scripts_are_whole():
    for s in ("Магазин на углу", "Καφενείο", "ラーメン屋"):
        assert E.repair(s) == (s, False)
