"""Word lists and tables that results depend on, as plain text."""

from __future__ import annotations


def _lines(text: str) -> tuple[str, ...]:
    return tuple(dict.fromkeys(t.strip() for t in text.replace("\n", ",").split(",") if t.strip()))


# Cells of a scanned CSV that mean null (compared as they are).
NA_TOKENS = (
    "", "NULL", "null", "N/A", "n/a", "-", "NA", "na", "k.A.", "k.a.", "n/v", "n.v.t.", "n/d", "n.d.", "s/d", "brak", "sem dados",
    "keine Angabe", "nicht verfügbar", "non disponibile", "no disponible", "niet beschikbaar",
)

# Header names accepted for each canonical column, in the order in which columns are matched.
HEADERS = {
    "business_name": ("business_name", "name", "title", "store_name", "company_name", "place_name", "location_name"),
    "category": ("category", "type", "business_type", "categories", "sector"),
    "address": ("address", "full_address", "street_address", "location", "formatted_address", "vicinity"),
    "phone_raw": ("phone", "phone_raw", "phone_number", "telephone", "tel", "contact_number", "phone_no"),
    "website_raw": ("website", "website_raw", "site", "web", "url", "web_site", "business_url"),
    "email_raw": ("email", "email_raw", "business_email", "contact_email", "mail", "e_mail"),
    "google_maps_url": ("google_maps_url", "maps_url", "gmaps_url", "google_url", "map_url", "url"),
    "rating": ("rating", "star_rating", "stars", "score", "avg_rating"),
    "reviews_count": ("reviews_count", "review_count", "num_reviews", "total_reviews", "user_ratings_total", "reviews"),
    "city": ("city", "town", "location_city", "city_name"),
    "lat": ("lat", "latitude", "y", "location_lat"),
    "lon": ("lon", "lng", "longitude", "x", "location_lng"),
}

# Query parameters dropped from URLs.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_content", "fbclid", "gclid", "msclkid", "ref", "source", "si")

# Legal forms at the end of a business name.
SUFFIXES = _lines("""
llc, inc, ltd, limited, corp, corporation, co, company
gmbh, ag, ug, kg, ohg, e.k., e.kfm., gmbh & co. kg, ag & co. kg, gmbh & co kg, ag & co kg, og
sa, sarl, s.à r.l., sagl, s.r.l., srl, s.p.a., spa, s.n.c., snc, s.a.s., sas, s.s., ss
lda., lda, ltda, s.a., unipessoal lda., crl
b.v., bv, n.v., nv, v.o.f., vof, c.v., cv, comm.v, bvba, nvsa, sprl, scrl
sp. z o.o., sp z o.o., sp.z o.o., sp. z oo, sp z oo, sp. j., sp j, sp. p., sp p, sp. k., sp k, sp. z o.o. sp.k., sp z oo sp k
s.l., sl, s.c., sc
ab, hb, kb, as, a/s, aps, i/s, oy, oyj, s.r.o., sro, a.s., kft, rt, bt, zrt, nyrt, d.o.o., doo, d.d., dd, teo, teoranta
""")

# Words that put a typed category into a class, class by class in the order of testing; a word may stand inside another.
CATEGORY_TERMS = {
    "beauty": _lines("""
beauty salon, beauty studio, nail salon, spa, wellness, cosmetics, cosmetology, skin care, aromatherapy, natural cosmetics, essential oils, perfumery
kosmetik, kosmetikstudio, schönheitspflege, nagelstudio, wellnesscenter, naturkosmetik, parfümerie, aromatherapie
salon de beauté, institut de beauté, esthétique, cosmétique, bien-être, cosmétique naturelle, parfumerie, aromathérapie
salone di bellezza, estetica, centro estetico, cosmetica, benessere, cosmetica naturale, profumeria
salón de belleza, estética, centro de estética, cosmética, bienestar, cosmética natural, perfumería
salão de beleza, bem-estar, perfumaria, schoonheidssalon, natuurlijke cosmetica
salon kosmetyczny, kosmetyka, studio urody, kosmetyki naturalne, perfumeria
"""),
    "horeca": _lines("""
horeca, ho.re.ca, food service, food distribution, food wholesale, wholesale, food supplier, ingredient supplier, spice supplier, spice shop
großhandel, grosshandel, lebensmittelgroßhandel, gewürzhandel, zulieferer, lieferant, gastronomiebedarf, gastro-großhandel
grossiste, distribution alimentaire, fournisseur, épicerie fine, ingrosso, distribuzione alimentare, fornitore, drogheria
mayorista, distribución alimentaria, proveedor, especias, atacado, distribuição alimentar, fornecedor, especiaria
groothandel, voedseldistributie, leverancier, specerijhandel, hurtownia, dystrybucja żywności, dostawca, sklep z przyprawami
"""),
    "food": _lines("""
bakery, bakeries, boulangerie, pastry, patisserie, confectionery, cake shop, dessert shop, sweet shop, chocolatier, chocolate shop
ice cream, ice cream shop, gelato, gelateria, frozen yogurt, cafe, coffee shop, tea room, cafeteria, restaurant, fine dining, bistro, brasserie
catering, caterer, event catering, food manufacturer, food production, flavor company, ingredient supplier, hotel, pastry chef
bäckerei, konditorei, café, confiserie, schokolade, eisdiele, eiscafe, speiseeis, gastronomie, grosskuche, partyservice, lebensmittelhersteller
pâtisserie, chocolaterie, glacier, glace, crêperie, salon de thé, traiteur, restauration, hôtel, chef pâtissier
panetteria, pasticceria, confetteria, cioccolateria, bar, caffè, ristorante, trattoria, osteria, albergo, pasticcere, chef pasticcere
panadería, pastelería, confitería, chocolatería, heladería, cafetería, restaurante, repostería
padaria, pastelaria, confeitaria, chocolataria, gelataria, cafetaria, doçaria
bakkerij, banketbakkerij, ijssalon, gebak, piekarnia, cukiernia, lodziarnia, kawiarnia, restauracja, cukiernik, wytwórnia, producent
spice shop, gewürzladen, épicerie, drogheria, especiaria, aromen, food ingredient
"""),
    "non_food": _lines("""
plumber, electrician, lawyer, attorney, accountant, consultant, hair salon, barber, auto repair, mechanic, car dealer, gas station
real estate, realtor, insurance, bank, financial, tech, software, it services, web design, marketing, cleaning service, construction, contractor, handyman
gym, fitness, yoga studio, dance studio, klempner, elektriker, anwalt, rechtsanwalt, steuerberater, friseur, autowerkstatt, immobilien, versicherung, reinigung, bau, fitnessstudio
plombier, électricien, avocat, comptable, coiffeur, garage, immobilier, assurance, banque, informatique, nettoyage, salle de sport
idraulico, elettricista, avvocato, commercialista, parrucchiere, officina, immobiliare, assicurazione, banca, informatica, pulizie, edilizia, palestra
fontanero, electricista, abogado, contable, peluquería, taller, inmobiliaria, seguros, banco, informática, limpieza, construcción, gimnasio
encanador, eletricista, advogado, contador, cabeleireiro, oficina, imobiliária, seguro, tecnologia, limpeza, construção, ginásio
loodgieter, electricien, advocaat, kapper, makelaar, verzekering, ict, schoonmaak, bouw, sportschool
hydraulik, elektryk, prawnik, księgowy, fryzjer, warsztat, biuro nieruchomości, ubezpieczenia, informatyka, sprzątanie, budowlanka, siłownia
"""),
}

# Large cities by country. A longer table is a parameter of functions.country_of_city.
CITIES = {
    "GB": _lines("london, manchester, birmingham, leeds, glasgow, sheffield, bradford, liverpool, edinburgh, bristol"),
    "US": _lines("new york, los angeles, chicago, houston, phoenix, philadelphia, san antonio, san diego, dallas, san jose, austin, san francisco, seattle, denver, washington, boston, detroit, portland, las vegas"),
    "DE": _lines("berlin, hamburg, munich, münchen, cologne, köln, frankfurt, stuttgart, düsseldorf, leipzig, dortmund, essen, bremen, dresden, hanover, hannover, nuremberg, nürnberg"),
    "AT": _lines("vienna, wien, graz, linz, salzburg, innsbruck"),
    "CH": _lines("zurich, zürich, geneva, genève, basel, bern, lausanne"),
    "FR": _lines("paris, marseille, lyon, toulouse, nice, nantes, strasbourg, montpellier, bordeaux, lille"),
    "IT": _lines("rome, roma, milan, milano, naples, napoli, turin, torino, palermo, genoa, genova, bologna, florence, firenze, venice, venezia, verona"),
    "ES": _lines("madrid, barcelona, valencia, seville, sevilla, zaragoza, málaga, malaga, murcia, bilbao"),
    "PT": _lines("lisbon, lisboa, porto, braga, coimbra, faro"),
    "NL": _lines("amsterdam, rotterdam, the hague, den haag, utrecht, eindhoven, groningen"),
    "BE": _lines("brussels, bruxelles, antwerp, antwerpen, ghent, gent, bruges, brugge, liège, bergen"),
    "PL": _lines("warsaw, warszawa, kraków, krakow, łódź, wrocław, wroclaw, poznań, poznan, gdańsk, gdansk"),
    "CZ": _lines("prague, praha, brno, ostrava"),
    "HU": _lines("budapest, debrecen, szeged"),
    "SE": _lines("stockholm, gothenburg, göteborg, malmö"),
    "DK": _lines("copenhagen, københavn, aarhus"),
    "NO": _lines("oslo, trondheim"),
    "FI": _lines("helsinki, espoo, tampere"),
    "IE": _lines("dublin, cork, galway"),
    "GR": _lines("athens, thessaloniki"),
}

# Calling codes of the regions that a phone is parsed for.
CALLING_CODES = {
    "1": "US", "7": "RU", "20": "EG", "27": "ZA", "30": "GR", "31": "NL", "32": "BE", "33": "FR", "34": "ES", "36": "HU", "39": "IT", "40": "RO", "41": "CH", "43": "AT", "44": "GB",
    "45": "DK", "46": "SE", "47": "NO", "48": "PL", "49": "DE", "52": "MX", "55": "BR", "61": "AU", "81": "JP", "86": "CN", "90": "TR", "91": "IN", "351": "PT", "352": "LU", "353": "IE",
    "354": "IS", "356": "MT", "357": "CY", "358": "FI", "359": "BG", "370": "LT", "371": "LV", "372": "EE", "380": "UA", "381": "RS", "385": "HR", "386": "SI", "420": "CZ", "421": "SK",
}

# Suffixes of more than one label under which names are registered; any other last label counts as a suffix.
PUBLIC_SUFFIXES = _lines("co.uk, org.uk, me.uk, ac.uk, gov.uk, co.at, or.at, com.pl, net.pl, org.pl, com.pt, com.es, org.es, nom.es, com.br, com.au, co.nz, co.za, com.tr, com.mx, co.jp, com.cn, co.in")

# Domains that say nothing about a business, and those of free mail.
DENYLIST = _lines("""
facebook.com, instagram.com, twitter.com, x.com, linkedin.com, tiktok.com, youtube.com, pinterest.com, snapchat.com, reddit.com, tumblr.com, threads.net, xing.com
bit.ly, goo.gl, t.co, tinyurl.com, ow.ly, is.gd
yelp.com, tripadvisor.com, tripadvisor.de, tripadvisor.fr, tripadvisor.it, tripadvisor.es, trustpilot.com, trustpilot.de
google.com, google.de, google.fr, google.it, google.es, google.nl, google.pl, google.pt, google.at, google.ch
kununu.com, jameda.de, golocal.de, iens.nl, thefork.com, lafourchette.com
gelbeseiten.de, dasoertliche.de, meinestadt.de, pagesjaunes.fr, paginasmarillas.es, paginegialle.it, goudengids.be, goldenpages.ie, herold.at, local.ch, search.ch, telefoongids.nl, detelefoongids.nl, panoramafirm.pl, pkt.pl, pai.pt
amazon.com, amazon.de, amazon.fr, amazon.it, amazon.es, ebay.com, ebay.de, ebay.fr, ebay.it, etsy.com, aliexpress.com, alibaba.com, bol.com, allegro.pl, cdiscount.fr, idealo.de, marktplaats.nl
wix.com, wixsite.com, wordpress.com, squarespace.com, weebly.com, jimdo.com, strato.de, ionos.de, webflow.io, shopify.com
maps.google.com, maps.apple.com, openstreetmap.org, example.com, test.com, localhost
""")
FREE_MAIL = _lines("""
gmail.com, yahoo.com, hotmail.com, outlook.com, aol.com, icloud.com, live.com, msn.com, gmx.de, gmx.at, gmx.ch, gmx.net, web.de, t-online.de, freenet.de, arcor.de, posteo.de
orange.fr, laposte.net, wanadoo.fr, sfr.fr, free.fr, libero.it, virgilio.it, tin.it, alice.it, tiscali.it, wp.pl, onet.pl, o2.pl, interia.pl, poczta.fm, ziggo.nl, home.nl, kpnmail.nl, xs4all.nl
telenet.be, skynet.be, proximus.be, sapo.pt, clix.pt, iol.pt, telefonica.net, terra.es, bluewin.ch, hispeed.ch, chello.at, aon.at, mail.ru, yandex.ru, yandex.com, protonmail.com, protonmail.ch, tutanota.com
""")

# Prefixes of likely mailboxes.
MAILBOXES = ("info", "hello", "contact", "support", "sales", "service", "hallo", "kontakt", "anfrage", "bestellen", "bonjour", "contatto", "contacto", "contato", "welkom")
# Addresses that nobody reads, and domains of examples.
NO_REPLY = ("noreply", "no-reply", "donotreply", "do-not-reply")
EXAMPLE_DOMAINS = ("example.com", "domain.com", "test.com")

# Mailbox names of nobody in particular; words that no person's name has; particles that count as no name.
GENERIC_LOCAL_PARTS = ("info", "contact", "hello", "hi", "mail", "office", "sales", "support", "team", "admin", "service", "booking", "reservations")
NOT_NAMES = ("gmbh", "llc", "ltd", "inc", "company", "co", "restaurant", "bakery", "cafe", "shop", "hotel", "team", "office", "admin", "support", "info", "contact", "owner", "founder", "manager", "director", "ceo")
PARTICLES = ("de", "del", "der", "van", "von", "da", "di", "la", "le")

# Platforms and what their links hold, in order.
PLATFORMS = {"linkedin": r"linkedin\.com", "facebook": r"facebook\.com", "instagram": r"instagram\.com", "twitter": r"(twitter\.com|x\.com)", "tiktok": r"tiktok\.com", "youtube": r"youtube\.com"}
# What a page title is cut at, the first that it contains.
TITLE_CUTS = (" - Home", " | Home", " - Homepage", " | ", " - ")

# Routes of contact and legal pages by language, in the order of visits.
ROUTES = {
    "en": ("/contact", "/about", "/about-us", "/team"),
    "de": ("/kontakt", "/impressum", "/uber-uns", "/ueber-uns"),
    "fr": ("/contact", "/a-propos", "/mentions-legales"),
    "it": ("/contatti", "/contatto", "/chi-siamo", "/note-legali"),
    "es": ("/contacto", "/sobre-nosotros", "/aviso-legal"),
    "pt": ("/contato", "/contactos", "/fale-conosco", "/sobre-nos", "/quem-somos", "/avisos-legais"),
    "nl": ("/contact", "/over-ons", "/juridisch", "/disclaimer"),
    "pl": ("/kontakt", "/o-firmie", "/o-nas", "/informacje-prawne"),
}
LEGAL_ROUTES = ("/impressum", "/imprint", "/mentions-legales", "/mentions_legales", "/aviso-legal", "/avisolegal", "/note-legali", "/juridisch", "/disclaimer", "/informacje-prawne", "/avisos-legais")

# Words that show a page's language, tested in this order; two of them decide.
LANGUAGE_WORDS = {
    "DE": _lines("willkommen, impressum, datenschutz, geschäftsbedingungen, öffnungszeiten, angebote, unternehmen, startseite, leistungen"),
    "FR": _lines("bienvenue, mentions légales, politique de confidentialité, accueil, entreprise, nos services, à propos, contactez-nous"),
    "IT": _lines("benvenuto, benvenuti, chi siamo, azienda, servizi, contatti, note legali, privacy, prodotti"),
    "ES": _lines("bienvenido, bienvenidos, quiénes somos, empresa, servicios, aviso legal, política de privacidad, inicio, nosotros"),
    "PT": _lines("bem-vindo, bem-vindos, quem somos, empresa, serviços, avisos legais, política de privacidade, início"),
    "NL": _lines("welkom, over ons, diensten, privacybeleid, algemene voorwaarden, producten, bedrijf, thuispagina, openingstijden"),
    "PL": _lines("witamy, o nas, usługi, polityka prywatności, regulamin, produkty, kontakt, strona główna, oferta"),
    "RO": _lines("bine ați venit, despre noi, servicii, produse, politica de confidențialitate, termeni și condiții"),
    "CS": _lines("vítejte, o nás, služby, produkty, ochrana osobních údajů, obchodní podmínky, úvod, kontakt"),
    "HU": _lines("üdvözöljük, rólunk, szolgáltatások, termékek, adatvédelmi irányelvek, kapcsolat, főoldal"),
    "SV": _lines("välkommen, om oss, tjänster, produkter, integritetspolicy, villkor, startsida, kontakta oss"),
    "DA": _lines("velkommen, om os, tjenester, produkter, privatlivspolitik, betingelser, forside, kontakt"),
    "NO": _lines("velkommen, om oss, tjenester, produkter, personvern, vilkår, forside, kontakt oss"),
    "FI": _lines("tervetuloa, meistä, palvelut, tuotteet, tietosuoja, ehdot, etusivu, yhteystiedot"),
    "EL": _lines("καλώς ήρθατε, σχετικά, υπηρεσίες, επικοινωνία, πολιτική απορρήτου, προϊόντα"),
    "BG": _lines("добре дошли, за нас, услуги, продукти, политика за поверителност, контакт"),
    "HR": _lines("dobrodošli, o nama, usluge, proizvodi, pravila privatnosti, kontakt"),
    "EN": _lines("welcome, about us, services, products, privacy policy, terms, contact us, home"),
}

# Patterns before a founding year, in several languages.
FOUNDED = (
    r"©\s*", r"Copyright\s+", r"Founded\s+(?:in\s+)?", r"Established\s+(?:in\s+)?", r"Est\.\s+", r"Since\s+", r"Gegründet\s+(?:im\s+)?", r"Seit\s+", r"Gründung(?:sjahr)?\s*:?\s*", r"Fondée?\s+(?:en\s+)?", r"Depuis\s+",
    r"Créée?\s+(?:en\s+)?", r"Fondata?\s+(?:nel\s+)?", r"Dal\s+", r"Fundada?\s+(?:en\s+)?", r"Fundada?\s+(?:em\s+)?", r"Desde\s+", r"Opgericht\s+(?:in\s+)?", r"Sinds\s+", r"Założona?\s+(?:w\s+)?", r"Grundad\s+", r"Grunnlagt\s+", r"Grundlagt\s+", r"Perustettu\s+",
)

# Titles of those who answer for a firm, as patterns, with their English names, in the order of testing.
TITLES = (
    (r"Geschäftsführer(?:in)?", "Managing Director"), (r"Inhaber(?:in)?", "Owner"), (r"Einzelunternehmer(?:in)?", "Sole Proprietor"), (r"Vorstand", "Board Member"), (r"Prokurist(?:in)?", "Authorised Signatory"), (r"Verantwortlich(?:er|e)?", "Responsible Person"),
    (r"Gérant(?:e)?", "Manager"), (r"Directeur(?:\s+général)?", "Director"), (r"Directrice(?:\s+générale)?", "Director"), (r"Président(?:e)?", "President"), (r"Responsable", "Responsible Person"), (r"Propriétaire", "Owner"),
    (r"Administrador(?:a)?", "Administrator"), (r"Director(?:a)?(?:\s+General)?", "Director"), (r"Titular", "Holder"), (r"Propietario(?:a)?", "Owner"), (r"Representante\s+Legal", "Legal Representative"),
    (r"Titolare", "Holder"), (r"Amministratore(?:\s+Delegato)?", "Administrator"), (r"Legale\s+Rappresentante", "Legal Representative"), (r"Proprietario(?:a)?", "Owner"), (r"Direttore(?:\s+Generale)?", "Director"),
    (r"Eigenaar", "Owner"), (r"Bestuurder", "Board Member"), (r"Beheerder", "Manager"), (r"Właściciel(?:ka)?", "Owner"), (r"Prezes(?:\s+Zarządu)?", "President"), (r"Dyrektor(?:\s+Generalny)?", "Director"), (r"Kierownik", "Manager"),
    (r"Proprietário(?:a)?", "Owner"), (r"Gerente", "Manager"), (r"Diretor(?:a)?(?:\s+Geral)?", "Director"), (r"Responsável", "Responsible Person"),
)

# Tax numbers and register entries, as patterns with one group, in the order of testing.
TAX_NUMBERS = (
    r"USt[\-\.]?\s*(?:Id[\-\.]?\s*)?Nr\.?\s*:?\s*(DE\s?\d{9})", r"TVA\s*(?:intra(?:communautaire)?)?\s*:?\s*(FR\s?\d{2}\s?\d{9})", r"(?:CIF|NIF|NIE)\s*:?\s*([A-Z]\d{7}[A-Z0-9])", r"P\.?\s*IVA\s*:?\s*(IT\s?\d{11})",
    r"BTW\s*(?:nummer|nr\.?)?\s*:?\s*(NL\d{9}B\d{2})", r"(?:KVK|KvK)\s*(?:nummer|nr\.?)?\s*:?\s*(\d{8})", r"NIP\s*:?\s*(\d{3}[\s\-]?\d{3}[\s\-]?\d{2}[\s\-]?\d{2})", r"(?:NIF|NIPC)\s*:?\s*(\d{9})",
)
REGISTERS = (
    r"(?:Handelsregister|HR[AB])\s*:?\s*((?:HR[AB]\s*\d+|[A-Z]{2,3}\s*\d{3,})(?:\s*[A-Z])?)", r"Registergericht\s*:?\s*(.+?)(?:\n|$|,)", r"Amtsgericht\s+(\S+(?:\s+\S+)?)\s*,?\s*(?:HR[AB]\s*\d+)",
    r"RCS\s*:?\s*(.+?\d{3}\s?\d{3}\s?\d{3})", r"SIRET\s*:?\s*(\d{3}\s?\d{3}\s?\d{3}\s?\d{5})", r"SIREN\s*:?\s*(\d{3}\s?\d{3}\s?\d{3})", r"Registro\s+Mercantil\s*(?:de\s+\w+)?\s*:?\s*(.+?)(?:\n|$|\.)",
    r"Registro\s+(?:delle\s+)?Imprese\s*(?:di\s+\w+)?\s*:?\s*(.+?)(?:\n|$|\.)", r"REA\s*:?\s*([A-Z]{2}[\s\-]?\d+)", r"(?:KVK|KvK)\s*(?:nummer|nr\.?)?\s*:?\s*(\d{8})", r"KRS\s*:?\s*(\d{10})", r"REGON\s*:?\s*(\d{9,14})", r"NIPC\s*:?\s*(\d{9})",
)

# Sizes of firms: bucket, its midpoint, and the number below which a count falls into it.
SIZES = (("1", 1.0, 1.5), ("2-5", 3.5, 5.5), ("6-20", 13.0, 20.5), ("21-50", 35.0, 50.5), ("51-200", 100.0, 200.5), ("200+", 300.0, None))
# Weights of the signals of size.
SIGNAL_WEIGHTS = {"api": 10.0, "jsonld": 9.0, "explicit_text": 7.0, "team_page": 6.0, "careers_page": 5.0, "review_count": 2.0, "category_prior": 1.5}
# Review counts from which a size is supposed; the sizes supposed by category, the first key contained.
REVIEW_TIERS = ((2000, "51-200"), (500, "21-50"), (100, "6-20"), (20, "2-5"), (1, "1"))
CATEGORY_PRIORS = {
    "bakery": "2-5", "confectionery": "2-5", "ice cream": "2-5", "chocolatier": "2-5", "pastry": "2-5", "gelateria": "2-5", "cafe": "2-5", "coffee shop": "2-5", "bistro": "2-5", "trattoria": "2-5",
    "restaurant": "6-20", "fine dining": "6-20", "brasserie": "6-20", "hotel": "21-50", "resort": "51-200", "catering": "6-20", "beauty salon": "2-5", "spa": "6-20", "wellness": "6-20", "hair salon": "2-5", "nail salon": "1",
    "horeca": "21-50", "food distribution": "21-50", "food wholesale": "21-50", "food manufacturer": "51-200", "spice supplier": "6-20", "food": "6-20", "retail": "6-20", "business": "6-20",
}
HEADCOUNT = (
    r"(\d{1,6})\s*\+?\s*(?:employees|staff|team members|people work|mitarbeiter(?:innen)?|angestellte|beschäftigte|employés|salariés|collaborateurs|dipendenti|collaboratori|empleados|trabajadores|funcionários|colaboradores|medewerkers|werknemers|pracowników)",
    r"(?:team of|staff of|over|more than|über|mehr als|plus de|équipe de|oltre|più di|más de|equipo de|mais de|equipa de|meer dan|ponad)\s+(\d{1,6})\s+(?:employees|people|mitarbeiter|personnes|persone|personas|pessoas|mensen|osób)",
)
# Beginnings of links to pages with vacancies.
CAREERS = ("/karriere", "/career", "/careers", "/jobs", "/job", "/stellenangebote", "/emploi", "/lavoro", "/empleo", "/vacatures", "/praca", "/kariera", "/lediga-tjanster")

# Search-engine queries about a firm; {0} is its name.
SEARCHES = {
    "linkedin_company": 'site:linkedin.com/company "{0}"',
    "linkedin_owner": 'site:linkedin.com/in "{0}" owner OR founder OR inhaber OR gründer OR propriétaire OR fondateur OR proprietario OR eigenaar OR właściciel',
    "linkedin_manager": 'site:linkedin.com/in "{0}" manager OR ceo OR director OR geschäftsführer OR directeur OR direttore OR gerente OR dyrektor',
    "xing_company": 'site:xing.com/companies "{0}"',
    "xing_people": 'site:xing.com/profile "{0}"',
    "owner_search": '"{0}" owner OR founder OR inhaber OR gründer OR gérant OR titolare OR propietario OR eigenaar',
    "news": '"{0}" news OR interview OR Pressemitteilung OR actualités OR notizie OR Nachrichten',
    "website": '"{0}" website OR homepage OR Webseite',
    "impressum": '"{0}" impressum OR "mentions légales" OR "aviso legal" OR "note legali"',
    "ingredient_relevance": '"{0}" vanilla OR vanille OR cacao OR kakao OR chocolate OR schokolade OR spice OR gewürz',
    "supplier": '"{0}" supplier OR lieferant OR fournisseur OR fornitore OR proveedor OR leverancier OR dostawca',
}

# Words that show what a firm works with.
INGREDIENTS = _lines("""
vanilla, vanille, vaniglia, vainilla, baunilha, wanilia, cacao, kakao, cocoa, chocolate, schokolade, chocolat, cioccolato, spice, spices, gewürz, gewürze, épice, épices, spezie, especia, especiaria, kruiden, przyprawy
essential oil, ätherisches öl, huile essentielle, olio essenziale, flavor, flavour, aroma, arôme, geschmack
""")
CERTIFICATES = _lines("bio, organic, biologisch, biologique, biologico, ecológico, fair trade, fairtrade, fair-trade, vegan, vegetarian, vegetarisch, eu-bio, demeter, bioland, naturland, halal, kosher, kasher, naturkosmetik, bdih, natrue, cosmos, ecocert")
