"""Structured data of web pages (JSON-LD) as one struct. Its fields may be texts, lists or objects, so it is read in Arrow batches."""

from __future__ import annotations

import json
import re
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import JSONLD

# Types and the classes they stand for, the specific first.
TYPES = {
    "Restaurant": "food", "Bakery": "food", "CafeOrCoffeeShop": "food", "IceCreamShop": "food", "FastFoodRestaurant": "food", "BarOrPub": "food", "Brewery": "food", "Winery": "food",
    "Hotel": "horeca", "BedAndBreakfast": "horeca", "Hostel": "horeca", "Motel": "horeca", "Resort": "horeca",
    "BeautySalon": "beauty", "HairSalon": "beauty", "NailSalon": "beauty", "DaySpa": "beauty", "HealthAndBeautyBusiness": "beauty", "TattooParlor": "beauty",
    "Store": "retail", "GroceryStore": "retail", "ClothingStore": "retail", "ElectronicsStore": "retail", "HardwareStore": "retail", "ShoppingCenter": "retail",
    "FoodEstablishment": "food", "LodgingBusiness": "horeca", "ProfessionalService": "business", "FinancialService": "business", "LocalBusiness": "business", "Organization": "business", "Corporation": "business",
    "InsuranceAgency": "business", "RealEstateAgent": "business", "AutoRepair": "business", "AutoDealer": "business",
}
_UNMAPPED = {"InsuranceAgency", "RealEstateAgent", "AutoRepair", "AutoDealer"}  # known types that give no class
# Hosts of profiles.
PROFILES = {"linkedin.com": "linkedin", "facebook.com": "facebook", "fb.com": "facebook", "instagram.com": "instagram", "twitter.com": "twitter", "x.com": "twitter", "tiktok.com": "tiktok", "youtube.com": "youtube", "youtu.be": "youtube"}
# Points for how complete an object is.
POINTS = {"business_name": 15, "description": 5, "email": 15, "phone": 10, "address": 10, "founder_name": 10, "employee_count": 5, "founding_date": 5, "business_type": 5, "opening_hours": 3, "price_range": 2, "lat": 3, "image": 2}
_SCRIPT = re.compile(r"<script\b[^>]*type\s*=\s*[\"']?application/ld\+json[\"']?[^>]*>(.*?)</script>", re.I | re.S)
_FIELDS = [f.name for f in JSONLD.fields]


def _load(raw: str) -> Any:
    raw = raw.strip().removeprefix("<!--").removesuffix("-->").strip()
    try:
        return json.loads(raw)
    except ValueError:
        pass
    # commas before a closing bracket, and comments of a line of their own or after a blank
    mended = re.sub(r"(^|\s)//[^\n]*", r"\1", re.sub(r",\s*([}\]])", r"\1", raw))
    try:
        return json.loads(re.sub(r",\s*([}\]])", r"\1", mended))
    except ValueError:
        return None


def objects(html: str) -> list[dict]:
    """The objects of a page's blocks, graphs taken apart; those of known types, or all if none is known."""
    out: list[dict] = []
    for m in _SCRIPT.finditer(html):
        top = _load(m[1])
        for o in top if isinstance(top, list) else [top]:
            if isinstance(o, dict):
                g = o.get("@graph", o)
                out += [x for x in (g if isinstance(g, list) else [g]) if isinstance(x, dict)]
    return [o for o in out if set(_types(o)) & set(TYPES)] or out


def _types(o: dict) -> list[str]:
    t = o.get("@type")
    return [t] if isinstance(t, str) else [x for x in t if isinstance(x, str)] if isinstance(t, list) else []


def _text(o: Any, k: str) -> str | None:
    v = o.get(k) if isinstance(o, dict) else None
    return str(v).strip() or None if isinstance(v, (str, int, float)) and not isinstance(v, bool) else None


def _many(v: Any) -> list:
    return v if isinstance(v, list) else [] if v is None else [v]


def _contact(o: dict, k: str) -> str | None:
    return _text(o, k) or next((x for p in _many(o.get("contactPoint")) if (x := _text(p, k))), None)


def _address(v: Any) -> str | None:
    for a in _many(v):
        if isinstance(a, str) and a.strip():
            return a.strip()
        if isinstance(a, dict):
            country = a.get("addressCountry")
            country = _text(country, "name") if isinstance(country, dict) else _text(a, "addressCountry")
            line = " ".join(x for x in (_text(a, "postalCode"), _text(a, "addressLocality"), _text(a, "addressRegion")) if x)
            if got := ", ".join(x for x in (_text(a, "streetAddress"), line, country) if x):
                return got
    return None


def _person(v: Any) -> str | None:
    for p in _many(v):
        if isinstance(p, str) and p.strip():
            return p.strip()
        if got := _text(p, "name") or " ".join(x for x in (_text(p, "givenName"), _text(p, "familyName")) if x):
            return got
    return None


def _whole(v: Any) -> str | None:
    if isinstance(v, bool) or v is None:
        return None
    if isinstance(v, float) and v.is_integer():
        v = int(v)
    return str(v).strip() or None


def _staff(v: Any) -> str | None:
    if not isinstance(v, dict):
        return _whole(v) if isinstance(v, (str, int, float)) else None
    if one := _whole(v.get("value")):
        return one
    low, high = _whole(v.get("minValue")), _whole(v.get("maxValue"))
    return f"{low}-{high}" if low and high else f"{low}+" if low else f"1-{high}" if high else None


def _hours(o: dict) -> str | None:
    plain = o.get("openingHours")
    if isinstance(plain, str) and plain.strip():
        return plain.strip()
    if isinstance(plain, list) and (parts := [str(h).strip() for h in plain if h]):
        return "; ".join(parts)
    out = []
    for s in _many(o.get("openingHoursSpecification")):
        if isinstance(s, dict):
            days = [d.rsplit("/", 1)[-1][:3] if d.rsplit("/", 1)[-1] in ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday") else d for d in _many(s.get("dayOfWeek")) if isinstance(d, str)]
            a, b = _text(s, "opens") or "", _text(s, "closes") or ""
            if days and (a or b):
                out.append(f"{','.join(days)} {a}-{b}")
    return "; ".join(out) or None


def _number(v: Any) -> float | None:
    try:
        return float(v)
    except (TypeError, ValueError):
        return None


def read_object(o: dict) -> dict:
    """The fields of one object; those that it lacks are None."""
    mail = _contact(o, "email")
    geo = o.get("geo") if isinstance(o.get("geo"), dict) else {}
    lat, lon = _number(geo.get("latitude")), _number(geo.get("longitude"))
    image = next(iter(_many(o.get("image") or o.get("logo"))), None)
    links: dict[str, str] = {}
    for u in _many(o.get("sameAs")):
        if isinstance(u, str):
            host = re.sub(r"^www\.", "", re.sub(r"^[a-z]+://", "", u.lower()).split("/")[0])
            for h, p in PROFILES.items():
                if host == h or host.endswith("." + h):
                    links.setdefault(p, u)
    types = _types(o)
    return {
        "business_name": _text(o, "name"), "description": _text(o, "description"), "email": re.sub(r"(?i)^mailto:", "", mail).strip().lower() if mail else None, "phone": _contact(o, "telephone"), "address": _address(o.get("address")),
        "lat": lat if lon is not None else None, "lon": lon if lat is not None else None, "founder_name": next((p for k in ("founder", "foundingTeam", "member", "employee") if (p := _person(o.get(k)))), None),
        "employee_count": _staff(o.get("numberOfEmployees")), "founding_date": _text(o, "foundingDate") or _text(o, "dateEstablished"), "social_links": links, "business_type": next((c for t, c in TYPES.items() if t in types and t not in _UNMAPPED), None),
        "opening_hours": _hours(o), "image": (image.strip() or None) if isinstance(image, str) else (_text(image, "url") or _text(image, "contentUrl")), "price_range": _text(o, "priceRange"),
    }


def completeness(r: dict) -> int:
    return sum(n for k, n in POINTS.items() if r.get(k) not in (None, "")) + min(3 * len(r.get("social_links") or {}), 10)


def read_page(html: str | None) -> dict | None:
    """The objects of a page merged: the most complete first, gaps filled from the others; None if there is nothing."""
    if not html or "ld+json" not in html:
        return None
    found = sorted((read_object(o) for o in objects(html)), key=completeness, reverse=True)
    found = [f for f in found if completeness(f)]
    if not found:
        return None
    out = {k: next((f[k] for f in found if f[k] is not None), None) for k in _FIELDS if k != "social_links"}
    out["social_links"] = {}
    for f in found:
        out["social_links"] = {**f["social_links"], **out["social_links"]}
    return out


@F.pandas_udf(JSONLD)
def _read(html: pd.Series) -> pd.DataFrame:
    rows = [read_page(h) or {} for h in html]
    return pd.DataFrame({k: [r.get(k) for r in rows] for k in _FIELDS})


def jsonld(html: Column | str) -> Column:
    """A struct of schema.JSONLD; all its fields are null for a page without structured data."""
    return _read(F.col(html) if isinstance(html, str) else html)
