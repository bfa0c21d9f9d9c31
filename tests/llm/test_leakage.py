"""Problem 8."""

import random

import pytest

from leadspark.llm import leakage as L

NAMES = ["Vanhuis", "Kopermans", "Lindwijk", "Zandkamp", "Molenstra", "Brinkveen", "Oosterboer", "Hoeksloot", "Dijkmans", "Veldhuis"]
TEMPLATES = ["The ledger of {0} lists {2} crates of cane sugar bought from {1} in the spring of {3}.", "Page {2} of the visitor book shows the initials of {0} next to a pressed leaf of {3}.", "Nobody remembered why {1} paid {3} coins for a cabinet with {2} drawers.", "The well behind number {2} was dug by {0} after {3} dry days and reached water.", "{1} taught {2} apprentices, {3} of whom later opened stalls of their own."]


def make(seed):
    r = random.Random(seed)
    a, b = r.sample(NAMES, 2)
    return " ".join(t.format(a, b, r.randrange(10, 99), r.randrange(1000, 9999)) for t in TEMPLATES), f"What did {a} owe {b} under permit {r.randrange(10000, 99999)} that year?", f"{r.randrange(10, 99)} kegs of {a} honey"


ITEMS = [(k, *make(k)) for k in range(30)]


@pytest.fixture(scope="module")
def known():
    return L.Items(ITEMS)


def found(known, text):
    return [x[0] for x in known.leaks(text)]


def test_whole_and_parts(known):
    p = ITEMS[3][1]
    words = p.split()
    n = len(words)
    assert found(known, "Intro. " + p + " End.") == [3]
    assert found(known, " ".join(words[: int(0.65 * n)])) == [3]
    assert found(known, " ".join(words[: int(0.3 * n)]) + " filler text " * 20 + " ".join(words[int(0.65 * n) :])) == [3]  # two stretches
    assert found(known, " ".join(words[: int(0.35 * n)])) == []  # a short quotation


def test_typography(known):
    p = ITEMS[4][1]
    cyrillic = p.translate(str.maketrans("aeopc", "аеорс"))
    for t in (p.upper(), cyrillic, "<p>" + p.replace(". ", ".<br/>") + "</p>", p.replace(" ", "  \n "), p.replace("a", "a​"), p.replace(",", "").replace(".", "")):
        assert found(known, t) == [4]


def test_edited(known):
    words = ITEMS[5][1].split()
    for k in range(6, len(words), 14):
        words[k] = words[k] + " indeed"
    assert found(known, " ".join(words)) == [5]


def test_others_names_and_figures(known):
    for k in range(1000, 1020):
        assert found(known, make(k)[0]) == []


def test_question_with_answer(known):
    _, _, q, a = ITEMS[6]
    assert found(known, f"x. {q} Answer: {a}. y") == [6] and found(known, q) == [] and found(known, a) == []


def test_rows(spark):
    docs = spark.createDataFrame([(1, ITEMS[0][1], "x"), (2, None, "x"), (3, "", "x"), (4, ITEMS[0][1], "x"), (5, "word " * 20000 + ITEMS[1][1], "x")], "doc_id long, text string, item_id string")
    items = spark.createDataFrame(ITEMS + [(99, None, None, None)], "item_id long, passage string, question string, answer string")
    assert sorted((r.doc_id, r.item_id) for r in L.leaks(docs, items).collect()) == [(1, 0), (4, 0), (5, 1)]
    assert L.leaks(docs, items.limit(0)).count() == 0 and L.leaks(docs.limit(0), items).count() == 0


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK", 10)
    docs = spark.createDataFrame([(k, i[1]) for k, i in enumerate(ITEMS)], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, passage string, question string, answer string")
    assert sorted((r.doc_id, r.item_id) for r in L.leaks(docs, items).collect()) == [(k, k) for k in range(30)]


def test_a_passage_in_another_script_is_found():
    passage = "Старая пекарня на углу открылась весной девятьсот второго года и сразу стала местом встречи рыбаков, которые приносили сюда угрей и новости с залива"
    items = L.Items([(1, passage, None, None), (2, "The mill by the river was rebuilt after the flood of 1854 by three brothers from Tilsit who never spoke again", None, None)])
    assert [x[0] for x in items.leaks("Вчера писали: " + passage + ". Конец.")] == [1]


def test_items_with_one_passage_all_leak():
    passage = "The mill by the river was rebuilt after the flood of 1854 by three brothers from Tilsit who never spoke again"
    others = [(k, " ".join(f"w{chr(97 + k)}{chr(97 + n)}" for n in range(20)), None, None) for k in range(10, 14)]
    items = L.Items([*[(k, passage, None, None) for k in (1, 2, 3)], *others])
    assert sorted(x[0] for x in items.leaks("Read: " + passage)) == [1, 2, 3]


def test_long_documents_are_aligned_in_windows(monkeypatch):
    passage = "The mill by the river was rebuilt after the flood of 1854 by three brothers from Tilsit who never spoke again"
    items = L.Items([(1, passage, None, None), (2, "another text altogether about bread and cheese and the price of eggs in Danzig", None, None)])
    text = "x y z " * 700 + passage + " y z x" * 900
    whole = items.leaks(text)
    monkeypatch.setattr(L, "WINDOW", 50)
    assert whole and items.leaks(text) == whole
