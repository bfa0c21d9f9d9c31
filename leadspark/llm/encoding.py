"""Problem 3: text decoded with the wrong character encoding.

Method: each character is mapped back to the byte it has in a legacy charset; an automaton over the byte structure of UTF-8
finds the maximal well-formed multibyte spans, and those spans alone are decoded (again and again, for text damaged twice).
Two further kinds of damage leave no multibyte span and are judged by the corpus instead: bytes of one single-byte charset shown
in another (ä as „ or Š), and letters replaced by ? or U+FFFD. For these, character contexts counted over all values decide:
a reading is taken if its letters are usual between their neighbours and the written ones are not.

The contexts are at most len(LETTERS) * (26 + len(LETTERS) + 1) ** 2 pairs of a letter and its neighbours (about 700,000), however
many rows there are; only those seen 3 times or more are sent to the tasks.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

# Charsets that text was read in by mistake, in the order in which readings are tried.
SHOWN_IN = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1250", "iso8859-2", "iso8859-15", "cp1251", "iso8859-5", "koi8-r", "cp866")
WRITTEN_IN = ("latin-1", "mac_roman", "cp850", "cp437", "cp1250", "iso8859-2", "cp852")
# Charsets that have letters where the others have letters, too. A DOS or Mac reading of nothing but letters (ä as õ) comes
# from mistyped words: contexts of three letters cannot tell it.
_SISTERS = frozenset({"cp1252", "latin-1", "iso8859-15", "cp1250", "iso8859-2"})
# Letters beyond a-z of German, French, Spanish, Italian, Portuguese, Dutch and Polish.
LETTERS = frozenset("äöüßàâæçéèêëîïôœùûÿáíñóúìòãõąćęłńśźż")
_LETTERS = LETTERS | {c.upper() for c in LETTERS if c != "ß"} | {"Ÿ"}
_PUNCTUATION = frozenset("–—‘’‚“”„†‡•…‰‹›€™ºª°«»¿¡·№½¼¾²³§©®´ ẞ")
_PLAUSIBLE = _LETTERS | _PUNCTUATION | frozenset("åÅøØšŠžŽčČďĎěĚňŇřŘťŤůŮýÝđĐðÐþÞőŐűŰăĂâÂîÎșȘțȚşŞţŢğĞıİ")


def _to_bytes(charset: str) -> dict[str, int]:
    got = {}
    for b in range(0x80, 0x100):
        try:
            got[bytes([b]).decode(charset)] = b
        except UnicodeDecodeError:
            got[chr(b)] = b  # an undefined byte usually comes through as the control of the same number
    if charset != "latin-1":
        for b in range(0x80, 0xA0):
            got.setdefault(chr(b), b)
    return got


_BYTES = {c: _to_bytes(c) for c in {*SHOWN_IN, *WRITTEN_IN}}

# A multibyte span begins with such a pair of characters: without one the automaton need not run.
_BEGINS = {c: re.compile("[" + "".join(re.escape(k) for k, b in t.items() if 0xC2 <= b <= 0xF4) + "][ " + "".join(re.escape(k) for k, b in t.items() if b <= 0xBF) + "]") for c, t in _BYTES.items()}

# The automaton: (state, byte class) -> state. A state is the number of continuation bytes still due, with the limits of the next.
_ACCEPT = 0


def _step(state: tuple[int, int, int], byte: int) -> tuple[int, int, int] | None:
    """The state after the byte, None where no well-formed sequence goes on so. state: bytes due, least and greatest next byte."""
    due, low, high = state
    if due:
        return (due - 1, 0x80, 0xBF) if low <= byte <= high else None
    for first, last, n, lo, hi in ((0xC2, 0xDF, 1, 0x80, 0xBF), (0xE0, 0xE0, 2, 0xA0, 0xBF), (0xE1, 0xEC, 2, 0x80, 0xBF), (0xED, 0xED, 2, 0x80, 0x9F), (0xEE, 0xEF, 2, 0x80, 0xBF), (0xF0, 0xF0, 3, 0x90, 0xBF), (0xF1, 0xF3, 3, 0x80, 0xBF), (0xF4, 0xF4, 3, 0x80, 0x8F)):
        if first <= byte <= last:
            return n, lo, hi
    return None


def decode_spans(s: str, charset: str) -> tuple[str, int]:
    """s with its maximal well-formed multibyte spans decoded, and how many characters were restored. Spans whose decoding is no
    plausible text (letters and signs of the seven languages, see _PLAUSIBLE; three or more letters of any script) stay as they are."""
    if not _BEGINS[charset].search(s):
        return s, 0
    table, out, i, n, restored = _BYTES[charset], [], 0, len(s), 0
    while i < n:
        if s[i] < "\x80" or s[i] not in table:
            out.append(s[i])
            i += 1
            continue
        state, raw, j, end = (0, 0, 0), bytearray(), i, i
        while j < n:
            c = s[j]
            byte = table.get(c)
            if byte is None and state[0] and c == " " and state[1] <= 0xA0 <= state[2] and i and s[i - 1].islower() and s[i].isupper():
                byte = 0xA0  # a no-break space that was normalised to a blank
            if byte is None or (nxt := _step(state, byte)) is None:
                break
            raw.append(byte)
            state = nxt
            j += 1
            if state[0] == _ACCEPT:
                end = j
        text = bytes(raw[: end - i]).decode("utf-8") if end > i else ""
        if text and (all(c in _PLAUSIBLE or "\x80" <= c <= "\xff" and _half_way(c) for c in text) or _other_script(text)):
            out.append(text)
            restored += len(text)
            i = end
        else:
            out.append(s[i])
            i += 1
    return "".join(out), restored


def _other_script(text: str) -> bool:
    """Whether a span is three or more letters of scripts other than Latin (Cyrillic, Greek, kana, ...)."""
    return len(text) >= 3 and all(c >= "\u0370" and c.isalpha() for c in text)


def _half_way(c: str) -> bool:
    """Characters that are plausible only as a stage of text damaged twice."""
    return c in "ÃÂÅÄâƒ€™šžŸ" or "\x80" <= c <= "\xbf"


def multibyte(s: str) -> str | None:
    """The best decoding of s's multibyte spans, repeated while it helps; None if there is no span."""
    best = None
    for _ in range(3):
        options = []
        for k, charset in enumerate(SHOWN_IN):
            text, n = decode_spans(s, charset)
            if n:
                odd = sum(c >= "\x80" and c not in _LETTERS and c not in "–’“”„" for c in text)
                options.append((odd, -n, k, text))
        if not options:
            return best
        odd, _, _, text = min(options)
        if best is not None and odd > sum(c >= "\x80" and c not in _LETTERS and c not in "–’“”„" for c in s):
            return best
        s = best = text
    return best


def _key(left: str, c: str, right: str) -> str:
    """A letter between its neighbours; whatever is no letter of the seven languages counts as a boundary."""
    near = lambda x: x if "a" <= x <= "z" or x in LETTERS else " "
    return near(left.lower()) + c.lower() + near(right.lower())


class Contexts:
    """How often each non-ASCII letter stands between its neighbours in the corpus."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        self.open: dict[str, list[tuple[int, str]]] = {}
        for k, n in counts.items():
            if k[1] in LETTERS:
                self.open.setdefault(k[0] + k[2], []).append((n, k[1]))
        for v in self.open.values():
            v.sort(reverse=True)

    def of(self, s: str, i: int) -> int:
        c = s[i].lower()
        return self.counts.get(_key(s[i - 1] if i else " ", c, s[i + 1] if i + 1 < len(s) else " "), 0) if c in LETTERS else 0

    def usual(self, s: str) -> bool:
        """Whether no letter of s can be one misread: none has a reading that is ten times as usual as itself between its neighbours."""
        for i, c in enumerate(s):
            if c >= "\x80":
                got = self.open.get(_key(s[i - 1] if i else " ", "x", s[i + 1] if i + 1 < len(s) else " ")[::2])
                if got and got[0][0] >= 10 * max(self.of(s, i), 2):
                    return False
        return True

    def fill(self, left: str, right: str) -> tuple[int, str] | None:
        """The usual letter between two neighbours, if one is: ten times as usual as the second."""
        got = self.open.get(_key(left, "x", right)[::2], [])
        return got[0] if got and (len(got) == 1 or got[0][0] >= 10 * got[1][0]) else None


def _in_case(s: str, i: int, c: str) -> bool:
    """Whether letter c at place i of s has the case that its neighbours ask for."""
    left, right = s[i - 1 : i], s[i + 1 : i + 2]
    if left.islower() or right.islower() and not (left.isspace() or not left.isalpha()):
        return c.islower()
    return not (left.isupper() and right.isupper()) or c.isupper() or c == "ß"


_UPPER = "".join(sorted(c for c in _LETTERS if c.isupper()))
_LOWER = "".join(sorted(LETTERS))
#: What a value damaged without regard to a corpus has at least one of, as a pattern for Java and Python alike: a question mark, a
#: character beyond the seven languages' letters, two non-ASCII characters in a row, or a capital after a small letter.
SUSPECT = rf"[?]|[^\x00-\x7f{_LOWER}{_UPPER}]|[^\x00-\x7f]{{2}}|[a-z{_LOWER}][{_UPPER}]"
_SUSPECT = re.compile(SUSPECT)
#: Without a corpus: every letter of the seven languages is as usual as any.
NO_CONTEXTS = None
_SIGNS = re.compile(r"[\u0080-\u009f�]")
_FOREIGN = re.compile(r"[Ѐ-ӿ]")
_LATIN = re.compile(r"[A-Za-z]")
_QUESTION = re.compile(r"(?<=[^\W\d_])\?+(?=[^\W\d_])|(?<![^\s\"'(/-])\?(?=[^\W\d_]{2})")
_LAST_QUESTION = re.compile(r"(?<=[^\W\d_]{2})\?(?=[\s,;|/)\"-]|$)")
#: Signs that stand inside a word only by mistake.
_INSIDE = re.compile(r"[^\W\d_][¡¢£¤¥¦§¨©¬¯±³´¶¸¹¼½¾¿„”†‡…‰‹›˜•∞√≈∂∑∏π∫Ω][a-zà-ÿ]")


def single_byte(s: str, contexts: Contexts | None) -> str | None:
    """The reading of s as bytes of another single-byte charset, if its letters are usual where the written ones are not.

    All non-ASCII characters of s are read anew, each must become a letter of the seven languages, and on the whole the new letters
    must be in places where the corpus has them: each at least 3 times and 10 times as often as what is written there."""
    at = [i for i, c in enumerate(s) if c >= "\x80" and (s[i - 1 : i].isalpha() or s[i + 1 : i + 2].isalpha())]
    if not at:
        return None
    foreign = bool(_FOREIGN.search(s))
    best: tuple[float, int, str] | None = None
    for k, shown in enumerate(SHOWN_IN):
        if foreign != (shown in ("cp1251", "iso8859-5", "koi8-r", "cp866")):
            continue
        table = _BYTES[shown]
        if any(s[i] not in table for i in at):
            continue
        for m, written in enumerate(WRITTEN_IN):
            if written == shown:
                continue
            try:
                new = {i: bytes([table[s[i]]]).decode(written) for i in at}
            except UnicodeDecodeError:
                continue
            if any(c not in _LETTERS for c in new.values()) or all(new[i] == s[i] for i in at) or not all(_in_case(s, i, c) for i, c in new.items()):
                continue
            t = list(s)
            for i, c in new.items():
                t[i] = c
            text = "".join(t)
            if contexts is None:
                unusual = sum(s[i] not in _LETTERS and s[i] not in "ºª°№®™½¼•€–—’‘“”´`·²³" for i in at)
                if unusual and (best is None or (unusual, -k * 10 - m) > best[:2]):
                    best = (unusual, -k * 10 - m, text)
                continue
            counts = [(contexts.of(text, i), contexts.of(s, i)) for i in at if new[i] != s[i]]
            good = sum(a >= 3 and a >= 10 * b for a, b in counts)
            bad = sum(a < 3 or a < b for a, b in counts)
            # foreign letters, signs and capitals among small letters cannot be meant
            odd = [s[i] not in _LETTERS or not _in_case(s, i, s[i]) for i in at if new[i] != s[i]]
            # letters of the seven languages are misread only where each new one is ten times as usual as the written one can be: contexts
            # seen up to twice are not counted, and mistyped words make such
            if good and (good >= bad if all(odd) else not bad if any(odd) else shown in _SISTERS and written in _SISTERS and all(a >= 10 * max(b, 2) for a, b in counts)) and (best is None or (good - bad, sum(a for a, _ in counts)) > best[:2]):
                best = (good - bad, sum(a for a, _ in counts), text)
    return best[2] if best else None


def repair(s: str | None, contexts: Contexts | None = NO_CONTEXTS) -> tuple[str | None, bool]:
    """(the text as it was meant, whether s is damaged). Where the text cannot be known, lost letters stay as U+FFFD."""
    if not s:
        return s, False
    if not _SUSPECT.search(s):  # plain letters of the seven languages: only the corpus can tell
        read = None if contexts is None or s.isascii() or contexts.usual(s) else single_byte(s, contexts)
        return (s, False) if read is None else (unicodedata.normalize("NFC", read), True)
    text, damaged = s, False
    if not s.isascii():
        got = multibyte(s)
        if got is not None:
            text, damaged = got, True
        elif any(c >= "\x80" and c not in _LETTERS for c in s) or contexts is not None:
            if (foreign := _FOREIGN.search(s)) and not _LATIN.search(s):
                return s, False  # wholly in another script
            read = single_byte(s, contexts)
            if read is None and foreign:
                read = single_byte(s, None) or s
            if read is not None:
                text, damaged = read, True
        if _SIGNS.search(text) or _INSIDE.search(text):
            damaged = True
    if "?" in text or "�" in text:
        lost = [m.span() for m in _QUESTION.finditer(text)]
        if contexts is not None:
            for m in _LAST_QUESTION.finditer(text):
                i = m.start()
                got = contexts.open.get(_key(text[i - 1], "x", " ")[::2])
                if got and sum(n for n, _ in got) >= 3 and contexts.counts.get("$" + text[max(0, i - 3) : i].lower(), 0) >= 3:
                    lost.append(m.span())
        damaged = damaged or bool(lost) or "�" in text
        for i, j in sorted(lost, reverse=True):
            text = text[:i] + "�" * (j - i) + text[j:]
        if contexts is not None:
            for i, c in enumerate(text):
                if c == "�":
                    got = contexts.fill(text[i - 1] if i else " ", text[i + 1] if i + 1 < len(text) else " ")
                    if got:
                        new = got[1].upper() if (text[i + 1 : i + 2].isupper() or text[i - 1 : i].isupper() and i and text[i - 1 : i + 2].upper() == text[i - 1 : i + 2]) and got[1] != "ß" else got[1]
                        text = text[:i] + new + text[i + 1 :]
    if damaged:
        text = unicodedata.normalize("NFC", text)
    return text, damaged


def contexts(df: DataFrame, *columns: str) -> Contexts:
    """Count the contexts of non-ASCII letters over all values of the columns."""
    got = None
    for c in columns:
        v = F.lower(F.col(c))
        inner = F.regexp_extract_all(F.concat(F.lit(" "), v, F.lit(" ")), F.lit(r"(?=(.[äöüßàâæçéèêëîïôœùûÿáíñóúìòãõąćęłńśźż].))"), F.lit(1))
        # the three letters before a final accented one, to tell a lost last letter from a question
        last = F.transform(F.regexp_extract_all(v, F.lit(r"(?U)(\w{3})[àèéòùìáíóúãęąüö](?=\W|$)"), F.lit(1)), lambda x: F.concat(F.lit("$"), x))
        norm = F.transform(inner, lambda x: F.concat(*[F.regexp_replace(F.substring(x, i, 1), "[^a-zäöüßàâæçéèêëîïôœùûÿáíñóúìòãõąćęłńśźż]", " ") for i in (1, 2, 3)]))
        part = df.where(F.col(c).rlike(r"[^\x00-\x7f]") & ~F.col(c).rlike("[\u0080-\u009f�]")).select(F.explode(F.concat(norm, last)).alias("k"))
        got = part if got is None else got.union(part)
    counted = got.groupBy("k").count().where("count >= 3")
    return Contexts({k: n for k, n in counted.collect()})


def find_damage(df: DataFrame, id: str, columns: list[str], known: Contexts | None = None) -> DataFrame:
    """One row (id, field_name, value, restored) for each damaged value of the columns of df.

    restored has U+FFFD where a lost letter cannot be known. Null and empty values are never damaged; repeated rows give a row each;
    an empty table gives no row; other columns of df are not looked at."""
    known = known or contexts(df, *columns)
    shared = df.sparkSession.sparkContext.broadcast(known)
    long = df.select(F.col(id).alias("id"), F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).alias("value")) for c in columns])).alias("v")).select("id", "v.*")
    long = long.where(F.col("value").rlike(r"[?]|[^\x00-\x7f]"))  # plain ASCII without a question mark is whole

    def judge(b: dict[str, list]) -> dict[str, list]:
        rows = [(i, f, v, text) for i, f, v in zip(b["id"], b["field_name"], b["value"]) for text, bad in (repair(v, shared.value),) if bad]
        return dict(zip(("id", "field_name", "value", "restored"), map(list, zip(*rows)) if rows else ([], [], [], [])))

    kind = df.schema[id].dataType.simpleString()
    return map_batches(long, judge, f"id {kind}, field_name string, value string, restored string").withColumnRenamed("id", id)


@lru_cache(100_000)
def repaired(s: str) -> str:
    """repair without a corpus, for normalisation."""
    return repair(s)[0] or ""

