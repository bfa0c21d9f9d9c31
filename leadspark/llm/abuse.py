"""Problem 10: abusive, hateful or sexually explicit text.

Method: a weighted finite-state pattern grammar. A chain of transducers is composed for each clause: disguise to plain words, words and
phrases to symbols (insult, threat, target, group, sexual act, negation, reported speech, harmless sense), symbols to weighted matches.
The symbol level is a regular language and is run as one: a clause becomes a string of one letter per word, and each rule of the grammar
is a regular expression over these letters. What is scored is the matched clause, not a word: an insult needs a target, a threat one
whom it is for, and clauses that report, forbid or mean something harmless lose their weight.
"""

from __future__ import annotations

import re
from collections import defaultdict
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches
from .texts import bare

# The lexicon, in lower case without accents, by symbol. A trailing * stands for any ending.
LEXICON = {
    # I: words that insult whomever they are said of
    "I": "idiot* moron* imbecile* dimwit* bastard* bitch bitches asshole* arsehole* scumbag* scum wanker* dickhead* motherfucker* cunt* whore* slut* twat* retard* halfwit* nitwit* cretin* shithead* fuckwit* jackass*"
    " trottel* depp wichser* schlampe* drecksau* missgeburt* arschloch* hurensohn* fotze* nutte* hure* abschaum penner* untermensch* schwachkopf* dreckskerl* mistkerl* vollpfosten* spast* kanake* wixer*"
    " connard* connasse* salope* salaud* encule* pute putes abruti* cretin* batard* ordures enfoire* bougnoule* conne"
    " puto putos puta putas gilipollas cabron* imbecil* maricon* zorra* idiota* hijoputa estupido* sudaca*"
    " stronzo* stronza* bastardo* puttana* troia* coglione* klootzak* hoer* kutwijf* trut* mongool* eikel sukkel* merda stronzi bastardi deficiente* cretino* idioci idiotk* skurwysyn* szmat* sukinsyn* kurwa* debil* dupek*",
    # W: words that insult only where they are said of people
    "W": "pig pigs cockroach* vermin rat rats parasite* trash garbage filth animal animals dog dogs ape apes monkey monkeys swine leech* maggot* thieves thief schwein* sau ungeziefer ratte* dreck parasit* affe affen ordure cafard* rats vermine porc porcs basura rata ratas cucaracha* cerdo* escoria parasito* sanguijuela* scheiße scheisse merde mierda varken* ratten ongedierte tuig schoft* maiale maiali ratti spazzatura parassit* feccia swinia swinie szczur* robactwo smiec* bydlo",
    # A: what insults are embellished with
    "A": "stupid filthy rotten pathetic worthless disgusting lying braindead spineless fat dirty lazy useless ugly dumb miserable damn damned fucking bloody goddamn dummer dumme dummes dumm elender elende elendes hirnloser hirnlose hirnloses verdammter verdammte verdammtes fette fetter dreckige dreckiger sale sales gros grosse pauvre espece pedazo maldito maldita sucio sucia asqueroso asquerosa puto puta smerige vuile domme achterlijke lelijke walgelijke sporchi sporco schifosi schifoso stupidi stupido brutti glupi glupia glupie brudny brudne obrzydliw*",
    # Y: you
    "Y": "you your yourself u du dich dir dein deine deiner ihr euch eure tu te toi ta ton tes vous votre vos eres tu ti usted ustedes vuestra vuestro os jij jullie jou jouw siete tuo tua vostro vostra voi ty cie ciebie jestes jestescie wasz twoj",
    # T: someone spoken of
    "T": "he she him her his hers owner chef cook waiter waitress manager boss clerk someone somebody baker staff guy woman man people laden betreiber besitzer wirt wirtin koch kellner kellnerin frau inhaber serveuse serveur patron patronne gerant dueno duena camarero camarera jefe cocinero gentuza sie er elle il ils ellos ella mother mutter mere madre",
    # G: groups of people
    "G": "immigrant* foreigner* migrant* refugee* women jews muslims christians gays lesbians blacks whites gypsies cripples cripple disabled believers arabs africans asians auslander* fluchtling* migranten juden moslems muslime zigeuner kruppel behinderte frauen schwule schwarze etranger etrangers etrangere immigre* juifs musulmans arabes femmes noirs roms handicapes extranjero* inmigrante* judios musulmanes moros negros mujeres gitanos refugiado*",
    # D: what is wished on or done to people
    "D": "kill* die rot strangle* stab* shoot hang* drown* burn* starve* suffer* choke* beat* verrecke* krepier* umbringen abstechen totschlagen vergasen rausgeprugelt erschlagen aufhangen creve* crevez pendez muerete mueranse pudrete matar quemar deport* chains gassed lynch* exterminat* vermoord* verbrand* ophangen ammazz* bruciat* impiccat* zabije zabic spalic powiesic",
    # V: what breaks somebody or something; a threat only with whom it is for
    "V": "break smash crush hit punch cut destroy wreck slice brechen breche zertrummern zerschlagen zusammenschlagen einschlagen anzunden casser briser defoncer frapper bruler tuer crever romper partir reventar golpear spaccare rompere distruggere bruciare breken slaan afmaken kapotmaken polamac polamie rozwalic rozwale pobije",
    # L: what a threat is about: bodies, and what somebody has
    "L": "legs bones neck face skull teeth fingers arms kneecaps house car shop windows family kids beine knochen genick fresse gesicht zahne schadel laden auto jambes os gueule crane dents boutique piernas huesos cuello dientes tienda gambe ossa faccia collo denti negozio benen botten nek gezicht tanden winkel nogi kosci kark twarz zeby sklep inside",
    # B: what joins a group with what is said of it
    "B": "are sind sont son sono zijn sa",
    # S: sexual, whatever is around it
    "S": "fuck fucks fucked fucker porn porno pornos nudes horny blowjob* handjob* cumshot* hardcore orgasm* ejaculat* masturbat* dildo* xxx fick ficken fickt gefickt geile geiler muschi titten schwanz wichsen blasen baiser niquer suceuse bite chatte bander follar folla polla tetas coño cono mamada corrida scopare cazzo figa neuken kut geil pik",
    # P: sexual or harmless, as the words around it have it
    "P": "cock cocks tits breast breasts naked nude sex sexy wet lick licks pussy moan moans strip strips spreads legs ass asses jerk nackt nackte nackter weiber nue nues nu desnuda desnudas desnudo mouth hard begs housewives girls boys",
    # N: negation
    "N": "not no never nobody none without nicht kein keine keinen nie ohne ne pas jamais aucun sans no nunca ningun ninguna sin non niet geen",
    # R: reported, forbidden or discussed
    "R": "word words called calls calling say says said saying wrote write deleted delete removed insults insult hate guestbook reviewer unfair quote quoted comment comments posts rules rule policy words adults beleidigungen beleidigung hetze worter wort geloscht gastebuch genannt schrieb sagte injures injure mots mot supprimees livre insultos insulto palabras palabra eliminan borran libro llamo dijo apologise apologize sorry entschuldig* disculp* excus* please bitte merci evitez eviter education course evening lesson biology health breeding",
    # H: things that give a word a harmless sense
    "H": "cake cakes brownie chai oven stove dough batch heat eggs cream steeple garden chicken hen hens chicks chick day-old cocktail cocktails spicy brunch mary killer roast superb checked pests monthly behind house mistake fair closed coupons kuchen torte glasur turm kraht hahn huhn schadling* gateau four pate horno masa pastel tarta pollo gallo torre jardin welcome share bienvenus willkommen bienvenidos long table",
}
# Phrases that are one symbol, in lower case without accents.
PHRASES = {
    "I": ("piece of trash", "piece of shit", "piece of garbage", "son of a bitch", "sack of shit", "stuck scheiße", "stuck scheisse", "stuck dreck", "hijo de puta", "hija de puta", "hijos de puta", "pedazo de mierda", "tas de merde", "fils de pute", "figlio di puttana", "waste of space"),
    "Q": ("shut your mouth", "shut up", "drop dead", "go rot", "go to hell", "kill yourself", "crawl back", "halt dein maul", "halt die fresse", "halts maul", "fahr zur holle", "verpiss dich", "geh sterben", "ferme ta gueule", "ta gueule", "va crever", "va te faire", "vete a la mierda", "cierra la boca", "callate la boca", "piss off", "fuck off", "fuck you", "nobody will miss you", "get lost", "hang yourself", "rot op", "rot toch op", "ga dood", "hou je bek", "val dood", "vaffanculo", "crepa", "muori", "spierdalaj", "zdychaj", "zamknij sie"),
    "Z": ("know where you live", "know where your kids", "weiß wo du wohnst", "weiss wo du wohnst", "wissen wo du wohnst", "sais ou tu habites", "savons ou tu habites", "se donde vives", "sabemos donde vives", "so dove abiti", "sappiamo dove abiti", "weet waar je woont", "weten waar je woont", "wiem gdzie mieszkasz", "wiemy gdzie mieszkasz"),
    "E": ("i hope", "hope", "hopefully", "j espere", "esperons", "ojala", "espero", "spero", "ik hoop"),
    "M": ("i will", "we will", "i ll", "we ll", "i am going to", "we are going to", "i m going to", "we re going to", "gonna", "ich werde", "wir werden", "je vais", "nous allons", "on va", "voy a", "vamos a", "ik ga", "ik zal", "we gaan", "wij gaan", "wij zullen"),
    "G": ("old people", "those people", "these people", "that skin", "of that sect", "travelling folk", "that kind of people", "people like that", "wie die", "solche leute", "diese leute", "gens du voyage", "ces gens", "cette race", "esa gente", "esos de"),
    "X": ("belong in a cage", "belongs in a cage", "belong in cages", "belong in a zoo", "gehoren in einen kafig", "gehoren eingesperrt", "en cage", "en una jaula", "driven out", "put them back", "ought to burn", "should burn", "should be shot", "do not deserve to live", "not deserve to live", "back in chains", "refuse to be served by", "gehoren raus", "raus aus", "gehoren aus", "durften hier gar nicht", "dehors de", "dehors", "fuera de", "go back to", "send them back", "nicht hierher", "wiped out", "are all filthy", "subhuman", "driven from", "chased out", "sollten vergast", "moeten dood", "devono sparire"),
    "S": ("sex chat", "porn clips", "jerk off", "sexual favours", "spreads her legs", "spread your legs", "in her mouth", "hot sex", "naked girls", "naked women", "nackte weiber", "nackte frauen", "femmes nues", "chicas desnudas", "waiting naked", "suck my", "lick your", "your tits", "his cock", "her pussy"),
    "H": ("naked cake", "nackter kuchen", "dirty chai", "chicken breast", "bloody mary", "roast pig", "adult education", "sexing of", "tits in the garden", "cock on the", "kill the heat", "beat the eggs", "whip the cream", "punch down", "guest book", "stupid mistake", "bitch of a", "cocktail list", "idiot savant", "livre d'or"),
}
# The grammar: (weight, rule over the symbols of a clause). o is any other word, K a capitalised word that may be a name.
GRAMMAR = (
    (0.95, r"Q.*[IWA]|[IWA].*Q"),
    (0.9, r"[YKT]o?A+o?[IW]"),
    (0.9, r"Y[oBN]{0,4}A*o{0,2}I"),
    (0.9, r"Y[oBN]{0,4}A+o{0,3}W"),
    (0.9, r"(?:A|W)o{0,2}A*[IW]"),
    (0.85, r"AI|AoI|AW"),
    (0.85, r"[TK][^R]{0,8}[AI]o{0,2}I|[TK]o{0,6}I"),
    (0.85, r"I[^RNH]{0,5}[YTK]"),
    (0.85, r"I[^RNH]{0,6}[DX]|[DX][^RNH]{0,6}I|[DX][^RNH]{0,6}[AW]"),
    (0.9, r"^D[^H]{0,5}[IWA]|D[oK]{0,3}Y[^H]{0,4}[IWA]"),
    (0.9, r"G[^NRH]{0,6}[WDIX]|G[^RH]{0,4}X|[XD][^NRH]{0,8}G"),
    (0.85, r"G[^NRH]{0,6}A[^NRH]{0,3}[AWX]|G[^NRH]{0,3}A"),
    (0.85, r"G[^RH]{0,10}X|X[^RH]{0,10}G"),
    (0.9, r"S[^RH]*[SPYTG]|[SPYTG][^RH]*S"),
    (0.7, r"S"),
    (0.85, r"P[^RH]{0,6}P[^RH]{0,8}P|P[^RH]{0,4}P[^RH]{0,8}[YT]|[YT][^RH]{0,3}P[^RH]{0,6}P"),
    (0.55, r"^A?I$|^o{0,2}I$"),
    (0.9, r"W[oBK]{0,2}[YK]$|Y[oB]{0,3}W$"),
    (0.7, r"Q"),
    # threats: someone's intention, what is done, and to whom or to what of theirs, in the orders of the seven languages
    (0.9, r"M[^RNH]{0,3}[DV][^RNH]{0,2}Y[^RNH]{0,2}L|M[^RNH]{0,2}Y[^RNH]{0,3}[DV][^RNH]{0,2}L|M[^RNH]{0,2}Y[^RNH]{0,2}L[^RNH]{0,2}[DV]"),
    (0.85, r"YM[DV]|M[^RNH]{0,2}[DV]Y[oK]{0,2}$|MY[oK]{0,2}[DV]$|DY[oK]{0,4}$"),
    (0.6, r"Z"),
    # what is wished on someone: harm to an insulted one's body; a hope that a person or you come to harm
    (0.9, r"[DV][^RNH]{0,3}I[^RNH]{0,3}L"),
    (0.85, r"E[^RNH]{0,2}[TYGK][^RNH]{0,6}D"),
    # a people that no list names: a capitalised word said to be vermin, or to be driven out
    (0.6, r"K[oN]?BA{0,2}o?A{0,2}W|KB?o{0,2}X"),
)
RULES = tuple((w, re.compile(r)) for w, r in GRAMMAR)
#: What the context takes from a clause's weight: reported or forbidden, a harmless sense.
REPORTED, HARMLESS, REVERSED = 0.15, 0.25, 0.5
LEAST = 0.5

_CLAUSE = re.compile(r"[^.!?;\n]+(?:\.(?=[a-z])[^.!?;\n]*)*[.!?;]*")
_SPELT = re.compile(r"(?<![^\W\d_])(?:(?:[^\W\d_][.\-_*·]){2,}|(?:[^\W\d_] ){3,})[^\W\d_](?![^\W\d_])")
_LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "+": "t", "€": "e", "|": "i"})
_DISGUISED = re.compile(r"(?<![\w])(?=[\w@$!+€|*]*[^\W\d_])(?=[\w@$!+€|*]*[0-9@$!+€|*])[\w@$+€|*](?:[\w@$!+€|*]*[\w@$*])?")
_LONG = re.compile(r"([^\W\d_])\1{2,}")
_TOKEN = re.compile(r"[^\W\d_]+(?:\*+[^\W\d_]+)+|[^\W\d_]+(?:['’][^\W\d_]+)?\*?|\d+")


def _compile() -> tuple[dict[str, str], list[tuple[str, str]], dict[tuple[str, ...], str]]:
    words, stems, phrases = {}, [], {}
    for symbol in ("B", "L", "V", "H", "R", "N", "T", "Y", "P", "A", "W", "G", "D", "S", "I"):
        for w in LEXICON[symbol].split():
            if w.endswith("*"):
                stems.append((w[:-1], symbol))
            else:
                words[w] = symbol
    for symbol, ps in PHRASES.items():
        for p in ps:
            phrases[tuple(p.replace("'", " ").split())] = symbol
    return words, sorted(stems, key=lambda x: -len(x[0])), phrases


_WORDS, _STEMS, _PHRASES = _compile()
_FIRST: dict[str, list[tuple[str, ...]]] = defaultdict(list)
for _p in sorted(_PHRASES, key=len, reverse=True):
    _FIRST[_p[0]].append(_p)
_BY_STEM: dict[str, list[tuple[str, str]]] = defaultdict(list)
for _s, _y in _STEMS:
    _BY_STEM[_s[:3]].append((_s, _y))
_TARGETED = [w for w, s in _WORDS.items() if s in "IWSP" and len(w) > 3] + [s for s, y in _STEMS if y in "IWS"]


@lru_cache(200_000)
def symbol(word: str) -> str:
    """The symbol of a word in lower case; o for other words."""
    got = _WORDS.get(word)
    if got:
        return got
    for s, y in _BY_STEM.get(word[:3], ()):
        if word.startswith(s):
            return y
    if (short := _LONG.sub(r"\1", word)) != word:
        for v in (short, _LONG.sub(r"\1\1", word)):
            if (got := symbol(v)) != "o":
                return got
    if "*" in word and (hit := _starred(word)):
        return hit
    return "o"


def _starred(word: str) -> str:
    """The symbol of a word whose letters are partly starred out."""
    pattern = re.compile("".join("." if c == "*" else re.escape(c) for c in word) + "(?:e?[nrs])?$")
    found = {symbol(w) for w in _TARGETED if len(w) >= len(word) - 2 and pattern.match(w)}
    return next((s for s in "ISWP" if s in found), "")


def plain_words(clause: str) -> str:
    """The clause with disguised words written out: letters spelt apart, figures and signs for letters, letters drawn out."""
    clause = _SPELT.sub(lambda m: re.sub(r"[.\-_*· ]", "", m[0]), clause)
    return _DISGUISED.sub(lambda m: m[0] if m[0].replace(",", "").isdigit() or "*" in m[0] else m[0].translate(_LEET), clause)


def _gate() -> ahocorasick.Automaton:
    """Finds the documents that may hold anything: some word of insult, threat or sex, or a sign of disguise."""
    a = ahocorasick.Automaton()
    for w, s in _WORDS.items():
        if s in "IWDSPGV" and len(w) > 2:
            a.add_word(w, 1)
    for w, s in _STEMS:
        if s in "IWDSPG":
            a.add_word(w, 1)
    for p, s in _PHRASES.items():
        if s in "IQXSZ":
            a.add_word(" ".join(p), 1)
    a.make_automaton()
    return a


_GATE = _gate()


def _symbols(clause: str, names: set[str]) -> str:
    words = [w for t in _TOKEN.findall(clause) for w in (t.replace("’", "'").split("'") if "'" in t or "’" in t else [t])]
    out, i = [], 0
    while i < len(words):
        for p in _FIRST.get(words[i], ()):
            if tuple(words[i : i + len(p)]) == p:
                out.append(_PHRASES[p])
                i += len(p)
                break
        else:
            s = symbol(words[i])
            out.append("K" if s == "o" and words[i] in names else s)
            i += 1
    return "".join(out)


def clauses(text: str | None) -> list[tuple[float, str, str]]:
    """(weight, symbols, clause) of every clause of a text that the grammar matches."""
    if not text:
        return []
    flat = bare(text)
    if not any(True for _ in _GATE.iter(flat)) and not re.search(r"[*@$]|[a-z][0-9!+|]+[a-z]|(?:[a-z][.\-_*]){3}|([a-z])\1\1", flat):
        return []
    out = []
    names = {w.lower() for w in re.findall(r"(?<=[a-z,;] )[A-ZÀ-Þ][^\W\d_]+", text)}
    names = {bare(w) for w in names}
    for m in _CLAUSE.finditer(plain_words(flat)):
        c = m[0].strip()
        s = _symbols(c, names)
        if not re.search("[IWDSPQXGVZ]", s):
            continue
        best = max((w for w, r in RULES if r.search(s)), default=0.0)
        if not best:
            continue
        if "R" in s:
            best *= REPORTED if not re.search(r"Y[^R]{0,4}[IW]|Q", s) else 0.6
        if "H" in s and not re.search(r"Q|Y[^H]{0,4}A?I|S.*S|X", s):
            best *= HARMLESS
        if re.search(r"N[^IWQX]{0,2}[IW]", s):
            best *= REVERSED
        out.append((best, s, c))
    return out


def score(text: str | None) -> float:
    """0 to 1: how likely at least one clause is meant as abuse, hatred or explicit sex."""
    rest = 1.0
    for w, _, _ in clauses(text):
        rest *= 1 - w if w >= 0.3 else 1 - w / 4
    return round(1 - rest, 4)


def scored(documents: DataFrame) -> DataFrame:
    """(doc_id, source, score, clause) for every document; clause is the one of the greatest weight, null if none matches.

    Whole texts are read, however long; null and empty texts score 0; repeated documents score alike; no documents, no rows."""

    def run(b):
        out = {"doc_id": b["doc_id"], "source": b["source"], "score": [], "clause": []}
        for t in b["text"]:
            found = clauses(t)
            rest = 1.0
            for w, _, _ in found:
                rest *= 1 - w if w >= 0.3 else 1 - w / 4
            out["score"].append(round(1 - rest, 4))
            out["clause"].append(max(found)[2] if found else None)
        return out

    return map_batches(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text"), run, "doc_id long, source string, score double, clause string")


def abusive(documents: DataFrame, least: float = LEAST) -> DataFrame:
    """(doc_id, score, clause) of the documents to be reviewed or left out."""
    return scored(documents).where(F.col("score") >= least).select("doc_id", "score", "clause")


def rates(documents: DataFrame, least: float = LEAST) -> DataFrame:
    """(source, documents, abusive, rate, mean_score) of each source; a null source is one of its own."""
    return scored(documents).groupBy("source").agg(F.count("*").alias("documents"), F.count_if(F.col("score") >= least).alias("abusive"), F.round(F.avg((F.col("score") >= least).cast("double")), 6).alias("rate"), F.round(F.avg("score"), 6).alias("mean_score"))
