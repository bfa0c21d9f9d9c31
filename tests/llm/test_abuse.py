"""Problem 10."""

import pytest

from leadspark.llm import abuse as A

BAD = [
    "You are nothing but a pathetic pig, Hoeksloot.", "Crawl back into your hole, you asshole.", "The owner is a stupid moron and so is his mother.", "Kill yourself, Rüdwinkler, you rotten piece of trash.", "Somebody should break that idiot's fingers.", "People with that skin are vermin and should be driven out of town.",
    "Shops run by foreigners ought to burn.", "You know how women are: dirty, lazy, subhuman.", "Verrecke, du elender Missgeburt.", "Dieser Laden wird von einer dummer Drecksau geführt.", "Ausländer wie die gehören rausgeprügelt.", "Crève, sale ordure.", "Espèce de gros connard, ferme ta gueule.", "Ces étrangers sont des cafards, dehors !",
    "El dueño es un maldito hijo de puta.", "Esos extranjeros son ratas, fuera de aquí.", "Send me nudes and I will lick the cream off your tits.", "Horny girls are waiting naked for you tonight.", "Geile nackte Weiber warten auf dich, ruf an und fick.", "You are an id!o7.", "Der Chef ist ein dummer W*****r.", "You stupid m.o.r.o.n, shut up.", "You are a moooron.", "YOU STUPID PIG!", "Old people belong in a cage, not behind a counter.", "Only a s c u m b a g would bake like this, drop dead.", "Yоu аrе а stuрid idiоt.",
]
GOOD = [
    "The cake was dry and the coffee cold, I would not go again.", "Please no words like idiot or moron in the guest book, we are all adults here.", "The reviewer before me called the chef a pig, which is unfair; the roast pig was superb.", "Insults, hate and pornographic posts in our guest book are deleted without notice.", "The naked cake for our wedding was rich.",
    "Trash goes behind the house, pests like vermin and cockroaches are checked monthly.", "Kill the heat, beat the eggs, whip the cream and punch down the dough.", "Our evening course in adult education covers sex and sexing of chicks, day-old hens and cocks.", "The cock on the steeple and the tits in the garden made breakfast lovely.", "A stupid mistake on our side, we apologise.",
    "We fired the oven and burned the first batch, what a bitch of a stove.", "The chicken breast with saffron and the spicy hot chocolate are lunch favourites.", "Ask for the cocktail list with vanilla syrup at the bar.", "Foreigners and locals share one long table.", "Im Gästebuch bitte keine Wörter wie Idiot, danke.", "Merci d'éviter les injures comme connard dans le livre d'or.", "Killer fig jam, honestly the best!", "Nackter Kuchen heißt bei uns Torte ohne Glasur.", "", None,
]


@pytest.mark.parametrize("text", BAD)
def test_bad(text):
    assert A.score(f"We came on Monday. {text} The toilet was clean.") >= A.LEAST


@pytest.mark.parametrize("text", GOOD)
def test_good(text):
    assert A.score(text) < A.LEAST


def test_disguise():
    assert A.plain_words("i.d.i.o.t") == "idiot" and A.plain_words("id!o7") == "idiot" and A.plain_words("offer 94850") == "offer 94850" and A.symbol("moooron") == "I" and A.symbol("w*****r") == "I"


def test_rows(spark):
    d = spark.createDataFrame([(1, BAD[0], "a"), (2, GOOD[0], "a"), (3, None, "b"), (4, "", None), (5, "fine words " * 20000 + BAD[1], "b"), (6, BAD[0], "a")], "doc_id long, text string, source string")
    assert sorted(r.doc_id for r in A.abusive(d).collect()) == [1, 5, 6]
    assert {r.source: (r.documents, r.abusive) for r in A.rates(d).collect()} == {"a": (3, 2), "b": (2, 1), None: (1, 0)}
    assert A.scored(d).count() == 6 and A.scored(d.limit(0)).count() == 0


# Written apart from the tables; the rules for threats were made with these in view, so they are no held-out set.
FRESH = (
    "We know where you live, Jansen, and we will break your legs.", "I will burn your shop down with you inside.", "You are a worthless piece of filth and everyone here hates you.", "Jullie zijn allemaal smerige varkens, rot op naar je eigen land.", "Siete dei bastardi, spero che il vostro locale bruci.",
    "Ty glupi idioto, zabije cie jesli jeszcze raz przyjdziesz.", "Die Ungarn sind dreckige Diebe und sollten vergast werden.", "All Hungarians are vermin and must be driven out of town.", "Je vais te casser la gueule si tu reviens.", "Te voy a matar, camarero de mierda.",
)
HARMLESS = (
    "He played an idiot savant at the piano.", "The oven will burn your bread if you leave it.", "We will break your order into two parcels.", "Please do not insult our staff; words like idiot are removed.", "I will kill for this cake, it is that good.", "The dog bites, beware.",
    "The bread was terrible and the waiter was rude, never again.", "Wir wissen, wo Sie wohnen: Lieferung frei Haus.", "I hope the dough does not burn.", "We are going to cut your cake at three.",
)


def test_fresh_sentences():
    hit, false = sum(A.score(t) >= A.LEAST for t in FRESH), sum(A.score(t) >= A.LEAST for t in HARMLESS)
    assert hit >= 9 and false <= 1, (hit, false)
