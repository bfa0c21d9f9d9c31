"""Normalisation of documents against typography and disguise."""

from __future__ import annotations

import re
import unicodedata

# Cyrillic and Greek letters that look like Latin ones.
_LOOKALIKES = dict(zip("абсԁеһіјӏоргѕтухѵԝАВСЕНІЈКМОРЅТХУЗьοαενικρτυχωΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "abcdehijloprstyxvwABCEHIJKMOPSTXY3bοαενικρτυχωABEZHIKMNOPTYX"))
_LOOKALIKES |= dict(zip("οαενικρτυχω", "oaevikptyxw"))
_INVISIBLE = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0x180E, 0x200E, 0x200F, *range(0x202A, 0x202F), *range(0x2066, 0x206A)])
_TABLE = {ord(k): v for k, v in _LOOKALIKES.items()} | _INVISIBLE
_ACCENTS = {c: None for c in range(0x300, 0x370)}
_TAG = re.compile(r"</?[A-Za-z][^<>]{0,200}>")
_HYPHEN = re.compile(r"(?<=[^\W\d_])-[ \t]*\r?\n\s*(?=[^\W\d_])")
_MIXED = re.compile(r"[Ͱ-ӿ]")


def surface(text: str) -> str:
    """The text without markup, invisible characters, line-break hyphens and look-alike letters; case and punctuation stay."""
    if "<" in text:
        text = _TAG.sub(" ", text).replace("&nbsp;", " ").replace("&amp;", "&")
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
        if _MIXED.search(text) and sum("A" <= c <= "z" for c in text) > len(text) // 8:
            text = text.translate(_TABLE)
        else:
            text = text.translate(_INVISIBLE)
    return _HYPHEN.sub("", text) if "-" in text else text


def bare(text: str) -> str:
    """surface, in lower case and without accents."""
    text = surface(text).lower()
    if text.isascii():
        return text
    return unicodedata.normalize("NFKD", text.replace("ß", "ss").replace("ø", "o").replace("ł", "l").replace("œ", "oe").replace("æ", "ae")).translate(_ACCENTS)
