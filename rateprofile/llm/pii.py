"""PII surrogates: detected entities get keyed replacements of the same type and
format, one per entity throughout the corpus.

Detection gives each mention a type and a canonical form (a phone number with its country's code,
lower-cased address, name words). The forms of one format (what stays: kind, length, letters and
digits by place, country, checksum status) are numbered, and a keyed permutation of these numbers, a
Feistel network that walks past numbers beyond the format's, moves each to another: distinct forms
get distinct surrogates by construction, and none its own. The domain of an address is an
entity of its own, so that addresses of one domain share the new one. Names keep script and
gender; they are drawn from HMAC-SHA256(key, kind, form, attempt), and parts of a name get the parts of its
surrogate. A surrogate is poured back into the punctuation and case of each mention, so
mentions of one entity agree (coreference).

Distinctness is checked over the whole corpus: an entity whose surrogate is itself an entity of the
corpus, or a name whose surrogate another has, draws again. Formats with few forms beside those in the corpus
keep their first draw, and what is not kept apart from the corpus is marked. Only entities
that had to draw again are sent to the tasks; all others recompute theirs.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import count
from math import prod

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, whole_row

KEY = b"rateprofile-surrogates"
#: Entities that drew again or whose gender another text tells, and formats without room, are broadcast up to this number, else joined.
BROADCAST_REDRAWN = 100_000
#: A format draws again only while it has at least this many forms for each one in the corpus: with
#: fewer there may be no free form, with more each round settles at least three of four.
ROOM = 8
#: Countries of phone numbers without ``+``: of ddd-ddd-dddd, and of numbers behind a trunk 0.
COUNTRIES = ("1", "44")

#: Titles by gender.
TITLES = {
    "m": ("Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Mister", "господин"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Señorita", "Srta", "госпожа"),
    "n": ("Mx", "Dr", "Prof"),
}
#: Given names of the surrogates, by script and gender.
GIVEN = {
    ("latin", "m"): ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karim", "Leo", "Martin", "Noel", "Oscar", "Paul"),
    ("latin", "f"): ("Alice", "Berta", "Clara", "Diana", "Emma", "Flora", "Greta", "Helena", "Irene", "Julia", "Karla", "Laura", "Marta", "Nina", "Olga", "Petra"),
    ("latin", "n"): ("Alex", "Robin", "Kim", "Sascha", "Noa", "Charlie", "Dominique", "Andrea"),
    ("cyrillic", "m"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл"),
    ("cyrillic", "f"): ("Анна", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Ксения", "Мария"),
    ("cyrillic", "n"): ("Саша", "Женя", "Валя", "Слава"),
}
#: Common given names that are detected without a title if a family name follows, by gender;
#: those of the surrogates are too. A titled mention tells the gender of any other name.
KNOWN = {
    "m": "Alexander Andreas Antoine Antonio Arthur Benjamin Bernd Carlos Charles Christian Christopher Claude Daniel Diego Edward Eric Fernando Francisco Frank Fritz Hans Heinrich Henri Henry Jack Jacques Jakob James Javier Jean Jens John José Joseph Juan Julien Jürgen Karl Klaus Louis Luis Lukas Manuel Marc Mark Matthias Max Michael Michel Miguel Nicolas Pablo Pedro Peter Philippe Pierre Rafael Ralf Richard Robert Samuel Stefan Stephen Steven Thomas Tobias Uwe Walter William Wolfgang Ahmed Ali Arjun Chen Hassan Hiroshi Ibrahim Jun Kenji Kofi Kwame Mehmet Mohamed Mohammed Mustafa Omar Rahul Raj Ravi Sanjay Wei Yusuf Александр Алексей Андрей Дмитрий Михаил Николай Павел Пётр Сергей",
    "f": "Ana Angela Anna Anne Barbara Beatriz Birgit Camille Carmen Caroline Catherine Charlotte Christine Claudia Cristina Elena Elisabeth Elizabeth Emily Eva Françoise Hannah Heike Ingrid Isabel Isabelle Jane Jennifer Jessica Johanna Karin Katharina Lena Linda Lisa Lucía Lucy Margaret Maria Marie María Martina Mary Monika Monique Nathalie Nicole Olivia Patricia Paula Pilar Rachel Sabine Sandra Sarah Sophie Susan Susanne Sylvie Teresa Ursula Valérie Victoria Aisha Amina Ayşe Deepa Fatima Hana Lakshmi Leila Mei Min-ji Priya Sakura Yuki Zainab Наталья Ольга Светлана Татьяна Юлия",
}
#: Words inside a family name.
PARTICLES = frozenset("al bin da das de del della den der di do dos du el la las le los ter van vom von y zu zum zur".split())
#: Capitalised words that end a name or are none.
NO_NAMES = frozenset(
    "a am an and are as at auf aus but by das de der die ein eine el en er es et for from für has he her his how i if im in is it its la las le les los mit my no not of on or our she so that the their they this to un und une was we were what when where who will with you your"
    " monday tuesday wednesday thursday friday saturday sunday january february march april may june july august september october november december"
    " north south east west northern southern eastern western new city county state street road avenue square park lake river mount island university college school church hospital station airport company corporation inc ltd gmbh ag"
    " straße platz и в на не он она".split()
)
#: Syllables of which family names are made, by script.
SYLLABLES = {
    "latin": [c + v for c in "bdfgklmnprstv" for v in "aeiou"],
    "cyrillic": [c + v for c in "бвгдклмнпрст" for v in "аеиоу"],
}

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
#: 555-123-4567 with or without 1 before it; behind a trunk 0: an area and one block, an area
#: and two blocks, 044 123 45 67, 01 23 45 67 89.
_NATIONAL = (
    r"(?:1[-. ])?[0-9]{3}(?P<s1>[-. ])[0-9]{3}(?P=s1)[0-9]{4}"
    r"|(?:\(0[1-9][0-9]{0,4}\) ?|0[1-9][0-9]{0,3}[ /-])[0-9]{5,8}"
    r"|(?:\(0[1-9][0-9]{1,3}\) ?|0[1-9][0-9]{1,3}[-. /])[0-9]{3,4}[-. ][0-9]{3,4}"
    r"|0[1-9][0-9][-. /][0-9]{3}(?P<s2>[-. ])[0-9]{2}(?P=s2)[0-9]{2}"
    r"|0[1-9](?P<s3>[-. ])[0-9]{2}(?:(?P=s3)[0-9]{2}){3}"
)
#: Digits of the phone numbers of countries where all have the same number, without the country's code.
_PHONE_DIGITS = {"1": 10, "7": 10, "31": 9, "33": 9, "34": 9, "41": 9, "44": 10, "45": 8, "47": 8, "48": 9, "52": 10, "61": 9, "91": 10, "351": 9}
#: Of any phone number, with the country's code (E.164).
_MOST_PHONE_DIGITS = 15
#: Country codes of one and of two digits; all others have three.
_SHORT_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
_DIGITAL = re.compile(
    r"(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))"
    r"|(?P<phone>(?<![0-9A-Za-z+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,5}){1,4}(?![0-9])|(?<![0-9A-Za-z])\([0-9]{3}\) ?[0-9]{3}[-. ][0-9]{4}(?![0-9]))"
    r"|(?P<ssn>(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-]))"
    rf"|(?P<ip>(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?[0-9]))"
    r"|(?P<card>(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z]))"
    rf"|(?P<national>(?<![0-9A-Za-z+])(?<![0-9][.,/-])(?:{_NATIONAL})(?![0-9A-Za-z])(?![.,/-][0-9]))"
)
_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])|(?<!\w)[\w.%+-]{1,64}@(?:[\w-]{1,63}\.){1,8}[A-Za-z]{2,24}(?!\w)")
_UPPER, _LOWER, _INNER = r"[^\W\d_a-zа-яß-öø-ÿ]", r"[^\W\d_A-ZА-ЯÀ-Þ]", "[A-ZА-ЯÀ-Þ]"
#: Weber, McDonald, O'Brien; no part of a longer word.
_NAME_WORD = rf"(?:{_UPPER}['’])?{_UPPER}{_LOWER}+(?:{_INNER}{_LOWER}+)*(?![^\W\d_])"
_TITLE = "|".join(t for g in TITLES.values() for t in g)
_NAME = re.compile(rf"\b(?P<title>(?:{_TITLE})\.?(?: (?:{_TITLE})\b\.?)*) (?P<name>{_NAME_WORD}(?:[ -]{_NAME_WORD}){{0,2}})")
_CAPITALS = re.compile(rf"\b(?:{_UPPER}['’])?{_UPPER}[^\W\d_]+(?![^\W\d_])")
_GENDER = {t: g for g, ts in TITLES.items() for t in ts}
_GIVEN_GENDER = {w.lower(): g for (_, g), ws in GIVEN.items() for w in ws} | {w.lower(): g for g, ws in KNOWN.items() for w in ws.split()}
_GIVEN_NAME = re.compile(rf"(?P<given>[A-ZА-Я](?<!\w.){_LOWER}+)(?:-{_NAME_WORD})?(?= )")
#: The next word of a name with the particles before it.
_NEXT_WORD = re.compile(rf" (?:(?:{'|'.join(sorted(PARTICLES))}) ){{0,2}}(?P<word>{_NAME_WORD}(?:-{_NAME_WORD})?)")
_FAMILY_WORDS = 3
_IBAN_LENGTHS = range(15, 35)
#: Lengths of the countries' IBANs; other countries have any.
_IBAN_LENGTH = {
    c: int(n)
    for n, cs in (part.split(":") for part in "15:NO 16:BE 18:DK,FI,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,XK 21:CH,CR,HR,LI,LV 22:BG,BH,DE,GB,GE,IE,ME,RS,VA 23:AE,GI,IL,IQ,TL 24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST 26:IS,TR 27:FR,GR,IT,MC,MR,SM 28:AL,AZ,BY,CY,DO,GT,HU,LB,PL,SV 29:BR,EG,PS,QA,UA 30:JO,KW,MU 31:MT,SC 32:LC".split())
    for c in cs.split(",")
}


def luhn(digits: str) -> bool:
    total = sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def _iban_ok(s: str) -> bool:
    return len(s) in _IBAN_LENGTHS and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _iban_end(text: str, start: int, end: int) -> int | None:
    """Where a valid IBAN ends that begins at ``start``: with the length of its country, else the
    longest one, at the end of a word. The pattern takes in upper-case words and numbers behind it."""
    ends = [e for e in range(end, start, -1) if text[e - 1].isalnum() and (e == len(text) or not text[e].isalnum())]
    forms = [(e, text[start:e].replace(" ", "")) for e in ends]
    fixed = _IBAN_LENGTH.get(text[start : start + 2])
    return next((e for e, form in sorted(forms, key=lambda x: len(x[1]) != fixed) if _iban_ok(form)), None)


def _phone_end(s: str) -> int | None:
    """Where the phone number ends in what the pattern took in, which may hold numbers behind it: with
    the digits of its country, else as late as any number may."""
    ends = [e for e in range(len(s), 0, -1) if s[e - 1].isdigit() and (e == len(s) or not s[e].isdigit())]
    digits = {e: sum(c.isdigit() for c in s[:e]) for e in ends}
    sign = re.sub("[^0-9]", "", s)
    code = next((sign[:n] for n in (3, 2, 1) if sign[:n] in _PHONE_DIGITS), None)
    exact = len(code) + _PHONE_DIGITS[code] + ("(0)" in s) if code else None
    return next((e for e in sorted(ends, key=lambda e: digits[e] != exact) if digits[e] <= _MOST_PHONE_DIGITS), None)


def _code(digits: str) -> str:
    """The country's code at the start of an international number."""
    return next((digits[:n] for n in (1, 2) if digits[:n] in _SHORT_CODES), digits[:3])


def _phone_form(mention: str, national: bool, countries: tuple[str, str]) -> str:
    """The digits of the international form: a number has one form with and without its country."""
    digits = re.sub("[^0-9]", "", mention)
    if mention.startswith("+"):
        code = _code(digits)
        rest = digits[len(code) :]
        return code + (rest[1:] if "(0)" in mention and rest.startswith("0") else rest)
    if national and digits.startswith("0"):
        return countries[1] + digits[1:]
    return digits if len(digits) == 11 else countries[0] + digits


def _digital(text: str, countries: tuple[str, str]) -> Iterator[tuple[int, int, str, str]]:
    at = 0
    while m := _DIGITAL.search(text, at):
        kind, start, end = m.lastgroup, m.start(), m.end()
        if kind == "iban":
            end = _iban_end(text, start, end)
            if end is None:
                # what the false match took in can hold other entities
                at = start + 1
                continue
        if kind == "phone" and text[start] == "+":
            end = start + (_phone_end(text[start:end]) or end - start)
        s = text[start:end]
        if kind in ("phone", "national"):
            yield start, end, "phone", _phone_form(s, kind == "national", countries)
        else:
            yield start, end, kind, s if kind == "ip" else re.sub(r"[^0-9A-Z]", "", s)
        at = end


def _words(name: str) -> tuple[str, ...]:
    return tuple(re.split("[ -]", name.lower()))


def _family_end(text: str, at: int, most: int) -> int:
    """Where the words of a family name behind ``at`` end: up to ``most`` words with their particles."""
    for _ in range(most):
        m = _NEXT_WORD.match(text, at)
        if not m or m["word"].lower() in NO_NAMES:
            break
        at = m.end()
    return at


def _name_end(text: str, start: int, end: int) -> int | None:
    """Where a titled name ends: before a word that is none, behind a family name with particles."""
    for m in re.finditer(_NAME_WORD, text[start:end]):
        if m.group().lower() in NO_NAMES:
            return start + len(text[start : start + m.start()].rstrip(" -")) if m.start() else None
    left = _FAMILY_WORDS - len(_words(text[start:end]))
    return _family_end(text, end, left)


def _direct_names(text: str) -> list[tuple[int, int, tuple[str, ...], str | None]]:
    """(start, end, words, gender of the title or None) of titled names and of given names with a family name."""
    found = []
    for m in _NAME.finditer(text):
        told = next((g for t in re.findall(r"\w+", m["title"]) if (g := _GENDER[t]) != "n"), "n")
        end = _name_end(text, m.start("name"), m.end("name"))
        if end is not None:
            found.append((m.start("name"), end, _words(text[m.start("name") : end]), told))
    for m in _GIVEN_NAME.finditer(text):
        if m["given"].lower() in _GIVEN_GENDER and (end := _family_end(text, m.end(), _FAMILY_WORDS)) > m.end():
            found.append((m.start(), end, _words(text[m.start() : end]), None))
    out = []
    for d in sorted(found, key=lambda d: (d[0], -d[1], d[3] is None)):
        if not out or d[0] >= out[-1][1]:
            out.append(d)
    return out


def _names(text: str) -> list[tuple[int, int, str, str]]:
    """Mentions of the names that ``_direct_names`` finds and, anywhere in the text, of these names
    or parts of them without a title. The form of a part is that of the whole name: of several, the one mentioned
    last, else the first to come. A title of the other gender keeps a part apart from a name."""
    direct = _direct_names(text)
    if not direct:
        return []
    first: dict[tuple[str, ...], int] = {}
    said: dict[tuple[str, ...], set[str]] = {}
    for a, _, f, told in direct:
        first.setdefault(f, a)
        said.setdefault(f, set()).add(told or "n")
    gender = {f: _gender(f, g) for f, g in said.items()}
    parts: dict[tuple[str, ...], set[tuple[str, ...]]] = {}
    for f in first:
        for i in range(len(f)):
            for j in range(i + 1, len(f) + 1):
                if not PARTICLES.issuperset(f[i:j]):
                    parts.setdefault(f[i:j], set()).add(f)
    whole = {p: {w for w in fs if len(parts[w]) == 1} - {p} for p, fs in parts.items()}

    def fitting(f: tuple[str, ...], told: str) -> set[tuple[str, ...]]:
        return {w for w in whole[f] if "n" in (told, gender[w]) or gender[w] == told}

    own = {f for _, _, f, told in direct if not fitting(f, told or "n")}
    mentions, at = [], 0
    for d in [*direct, (len(text), len(text), (), None)]:
        mentions += [(*m, None) for m in _parts_between(text, at, d[0], parts)]
        at = d[1]
        mentions.append(d)
    last: dict[tuple[str, ...], int] = {}
    resolved = []
    for a, b, f, told in mentions[:-1]:
        fits = fitting(f, told or "n") | ({f} & own if told is None else set()) or {f}
        form = max(fits, key=lambda w: (last.get(w, -1), -first.get(w, a), w))
        last[form] = a
        said.setdefault(form, set()).add(told or "n")
        resolved.append((a, b, form))
    return [(a, b, "name_" + _gender(f, said[f]), " ".join(f)) for a, b, f in resolved]


def _gender(form: tuple[str, ...], titles: set[str]) -> str:
    """What titles say, n if they contradict each other; without one, that of a known given name."""
    told = titles - {"n"}
    if told:
        return told.pop() if len(told) == 1 else "n"
    return _GIVEN_GENDER.get(form[0], "n") if len(form) > 1 else "n"


def _parts_between(text: str, start: int, end: int, parts: dict) -> list[tuple[int, int, tuple[str, ...]]]:
    """The longest runs of capitalised words that are names or parts of names."""
    words, out, k = list(_CAPITALS.finditer(text, start, end)), [], 0
    while k < len(words):
        a, b, run = words[k].start(), words[k].end(), (words[k].group().lower(),)
        k += 1
        if run not in parts:
            continue
        while k < len(words) and text[b : words[k].start()] in (" ", "-") and (longer := (*run, words[k].group().lower())) in parts:
            run, b = longer, words[k].end()
            k += 1
        out.append((a, b, run))
    return out


def detect(text: str, countries: tuple[str, str] = COUNTRIES) -> list[tuple[int, int, str, str]]:
    """(start, end, type, canonical form) of the entities, in order, not overlapping."""
    found: list[tuple[int, int, str, str]] = []
    if "@" in text:
        found += [(m.start(), m.end(), "email", m.group().lower()) for m in _EMAIL.finditer(text)]
    if any(d in text for d in "0123456789"):
        found += _digital(text, countries)
    found += _names(text)
    out: list[tuple[int, int, str, str]] = []
    for e in sorted(found, key=lambda e: (e[0], -e[1])):
        if not out or e[0] >= out[-1][1]:
            out.append(e)
    return out


class _Draw:
    """A stream of numbers from the key, an entity and the attempt."""

    def __init__(self, key: bytes, kind: str, form: str, attempt: int):
        self.seed = hmac.new(key, f"{kind}\x00{form}\x00{attempt}".encode(), hashlib.sha256).digest()
        self.n, self.left = 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left += hashlib.sha256(self.seed + self.n.to_bytes(4, "big")).digest()
            self.n += 1
        x, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return x % n


class Permutation:
    """A keyed bijection of 0 .. n - 1: a Feistel network over the next even number of bits,
    repeated until the number is below n."""

    ROUNDS = 8

    def __init__(self, n: int, key: bytes):
        self.n, self.key = n, key
        self.half = max(1, ((n - 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.size = (self.half + 7) // 8

    def _mix(self, turn: int, x: int) -> int:
        return int.from_bytes(hashlib.shake_256(self.key + bytes([turn]) + x.to_bytes(self.size, "big")).digest(self.size), "big") & self.mask

    def forth(self, x: int) -> int:
        while True:
            left, right = x >> self.half, x & self.mask
            for turn in range(self.ROUNDS):
                left, right = right, left ^ self._mix(turn, right)
            x = left << self.half | right
            if x < self.n:
                return x

    def back(self, x: int) -> int:
        while True:
            left, right = x >> self.half, x & self.mask
            for turn in reversed(range(self.ROUNDS)):
                left, right = right ^ self._mix(turn, left), left
            x = left << self.half | right
            if x < self.n:
                return x

    def other(self, x: int, attempt: int) -> int:
        """A number other than x, for another attempt another one; for each attempt a bijection."""
        if self.n == 1:
            return x
        step = 1 + (int.from_bytes(hashlib.shake_256(self.key + b"step").digest(8), "big") + attempt) % (self.n - 1)
        return self.back((self.forth(x) + step) % self.n)


@lru_cache(maxsize=4096)
def _alphabet(c: str) -> str:
    """What a letter or digit may become: one of its kind, in the same script; empty for all other signs."""
    for letters in ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"):
        if c in letters:
            return letters
    if not c.isalpha():
        return ""
    near = [chr(x) for x in range(ord(c) & ~255, (ord(c) | 255) + 1)]
    plain = lambda x: x.isalpha() and x == x.lower() and len(x.upper()) == 1 and ord(x) > 127
    return "".join(x for x in near if plain(x)) if plain(c) else ""


def _spelled(text: str) -> tuple[str, list[int], list[int]]:
    """(format, sizes, numbers) of a text of which each letter and digit may become another one."""
    letters = [_alphabet(c) for c in text]
    return "".join(a[0] if a else c for c, a in zip(text, letters)), [len(a) for a in letters if a], [a.index(c) for c, a in zip(text, letters) if a]


def _spell(text: str, numbers: list[int]) -> str:
    """``text`` with other letters and digits."""
    n = iter(numbers)
    return "".join(a[next(n)] if (a := _alphabet(c)) else c for c in text)


def _check_digit(body: str) -> int:
    return next(c for c in range(10) if luhn(body + str(c)))


def _layout(kind: str, form: str) -> tuple[str, list[int], list[int], Callable[[list[int]], str]]:
    """(format, sizes and numbers of its places, how other numbers are written). Forms of different formats
    never get the same surrogate: all that the format tells stays."""
    if kind == "ip":
        return "", [256] * 4, [int(o) for o in form.split(".")], lambda n: ".".join(map(str, n))
    if kind == "card":
        body, last = form[1:-1], int(form[-1])
        off = (last - _check_digit(form[:-1])) % 10

        def card(n: list[int]) -> str:
            new = form[0] + "".join(map(str, n[: len(body)]))
            return new + str((_check_digit(new) + (n[-1] + 1 if off else 0)) % 10)

        more = ([9], [off - 1]) if off else ([], [])
        return f"{form[0]} {len(form)} {off > 0}", [10] * len(body) + more[0], [int(c) for c in body] + more[1], card
    if kind == "phone":
        code = _code(form)
        first, rest = form[len(code) : len(code) + 1], form[len(code) + 1 :]
        # a leading zero stays, so that the number keeps its form
        lead = ([9], [int(first) - 1]) if first and first != "0" else ([], [])
        n0 = len(lead[0])
        head = lambda n: str(n[0] + 1) if n0 else first
        return f"{code} {n0} {len(form)}", lead[0] + [10] * len(rest), lead[1] + [int(c) for c in rest], lambda n: code + head(n) + "".join(map(str, n[n0:]))
    if kind == "iban":
        sign, sizes, numbers = _spelled(form[4:])

        def iban(n: list[int]) -> str:
            body = _spell(form[4:], n)
            check = 98 - int("".join(str(int(c, 36)) for c in body + form[:2] + "00")) % 97
            return f"{form[:2]}{check:02d}{body}"

        return form[:2] + sign, sizes, numbers, iban
    # ssn, the part of an address before @, and a domain, whose last label stays
    body, dot, last = form.rpartition(".") if kind == "domain" else (form, "", "")
    sign, sizes, numbers = _spelled(body)
    return sign + dot + last, sizes, numbers, lambda n: _spell(body, n) + dot + last


def room(kind: str, form: str) -> tuple[str, int]:
    """(format, number of its forms) of a form that is no name."""
    sign, sizes, _, _ = _layout(kind, form)
    return sign, prod(sizes)


def surrogate(kind: str, form: str, attempt: int = 0, key: bytes = KEY, domain_attempt: int = 0) -> str:
    """Canonical form of the replacement; never the form itself, unless nothing in its format can change."""
    if kind.startswith("name_"):
        return next(out for turn in count() if (out := _new_name(kind, form, attempt, _Draw(key, kind, form, attempt + 1_000_000 * turn))) != form)
    if kind == "email":
        name, _, domain = form.rpartition("@")
        return f"{_moved('local@' + domain, name, 0, key)}@{surrogate('domain', domain, domain_attempt, key)}"
    return _moved(kind, form, attempt, key)


def _moved(kind: str, form: str, attempt: int, key: bytes) -> str:
    sign, sizes, numbers, write = _layout(kind, form)
    x = 0
    for size, n in zip(sizes, numbers):
        x = x * size + n
    x = Permutation(prod(sizes), hmac.new(key, f"{kind}\x00{sign}".encode(), hashlib.sha256).digest()).other(x, attempt)
    out = []
    for size in reversed(sizes):
        x, n = divmod(x, size)
        out.append(n)
    return write(out[::-1])


def _new_name(kind: str, form: str, attempt: int, d: _Draw) -> str:
    """Family names grow with the attempts, so that names never run out."""
    words = form.split(" ")
    script = "cyrillic" if re.match(r"[а-яё]", form) else "latin"
    made = [w if w in PARTICLES else "".join(SYLLABLES[script][d.below(len(SYLLABLES[script]))] for _ in range(3 + attempt // 2 + d.below(2))) for w in words]
    if len(words) > 1:
        given = GIVEN[script, kind[-1]]
        made[0] = given[d.below(len(given))].lower()
    return " ".join(made)


def pour(mention: str, kind: str, form: str, new: str) -> str:
    """The replacement in the punctuation and case of the mention."""
    if kind == "ip":
        return new
    if kind.startswith("name_"):
        # a mention of a part of the name gets that part of the surrogate
        part, whole = _words(mention), tuple(form.split(" "))
        at = next((i for i in range(len(whole) - len(part) + 1) if whole[i : i + len(part)] == part), 0)
        words = iter(new.split(" ")[at:])
        parts = re.split(r"([ -])", mention)
        return "".join(p if i % 2 else (next(words) if p in PARTICLES else next(words).upper() if p.isupper() and len(p) > 1 else next(words).capitalize()) for i, p in enumerate(parts))
    if kind == "email":
        return "".join(n.upper() if m.isupper() else n for m, n in zip(mention, new)) if len(new) == len(mention) else new
    if kind == "phone":
        code = len(_code(form))
        digits = re.sub("[^0-9]", "", mention)
        # what stands before the national number: the country's code, a trunk 0, both or nothing
        before = digits[: len(digits) - (len(form) - code)]
        new = before + new[code:]
    signs = iter(new)
    return "".join(next(signs, "") if c.isalnum() else c for c in mention)


def _assigned(kind: str, form: str) -> tuple[str, str]:
    """The entity that is assigned: of an address its domain."""
    return ("domain", form.rpartition("@")[2]) if kind == "email" else (kind, form)


def _entities(countries: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = {_assigned(k, f) for t in batch.column("text") for _, _, k, f in detect(t.as_py() or "", countries)}
            kinds, forms = [k for k, _ in seen], [f for _, f in seen]
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(forms, pa.string())], names=["kind", "form"])

    return run


def _drawn(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k.as_py(), f.as_py(), a.as_py()) for k, f, a in zip(*(batch.column(c) for c in ("kind", "form", "attempt")))]
            new = [surrogate(k, f, a, key) for k, f, a in rows]
            rooms = [("", _NO_BOUND) if k.startswith("name_") else room(k, f) for k, f, _ in rows]
            more = [pa.array(new, pa.string()), pa.array([r[0] for r in rooms], pa.string()), pa.array([min(r[1], _NO_BOUND) for r in rooms], pa.int64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("kind", "form", "attempt")), *more], names=["kind", "form", "attempt", "new", "format", "room"])

    return run


def one_gender(said: DataFrame) -> DataFrame:
    """(kind, form, as_kind): a name of which texts tell different genders has one kind throughout the
    corpus, that of the only told gender, or neither."""
    name = F.col("kind").startswith("name_")
    told = said.filter(name).groupBy("form").agg(F.max(F.col("kind") == "name_m").alias("m"), F.max(F.col("kind") == "name_f").alias("f"))
    agreed = F.when(F.col("m") & ~F.col("f"), "name_m").when(F.col("f") & ~F.col("m"), "name_f").otherwise("name_n")
    names = said.filter(name).join(told.select("form", agreed.alias("as_kind")), "form")
    return said.filter(~name).withColumn("as_kind", F.col("kind")).unionByName(names)


_NO_BOUND = 1 << 62
_SCHEMA = "kind string, form string, attempt int, new string, format string, room long"


def assign(entities: DataFrame, key: bytes = KEY) -> DataFrame:
    """(kind, form, attempt, new, apart) for distinct (kind, form) other than addresses, whose domains
    are entities: distinct replacements. ``apart`` is false where a replacement is itself an entity of the corpus.

    The replacements of one attempt are distinct, but for names. Formats of which the corpus holds more than one form in ``ROOM``
    keep their first draw. The others draw again until no replacement is an entity of the corpus or another's
    replacement: less than a quarter in each round, for names ever fewer.
    """
    family = F.split("kind", "_")[0]
    forms = entities.select(family.alias("family"), F.col("form").alias("new")).distinct()
    drawn = materialise(entities.withColumn("attempt", F.lit(0)).mapInArrow(_drawn(key), _SCHEMA), "drawn").withColumn("family", family)
    dense = drawn.filter(F.col("room") < _NO_BOUND).groupBy("kind", "format", "room").count().filter(F.col("count") * ROOM > F.col("room")).select("kind", "format")
    dense = materialise(dense, "dense")
    if dense.count() <= BROADCAST_REDRAWN:
        dense = F.broadcast(dense)
    of_corpus = forms.withColumn("taken", F.lit(True))
    kept = drawn.join(dense, ["kind", "format"], "left_semi").join(of_corpus, ["family", "new"], "left")
    settled = materialise(kept.select("kind", "form", "attempt", "new", "family", F.col("taken").isNull().alias("apart")), "settled")
    drawn = drawn.join(dense, ["kind", "format"], "left_anti")
    attempt = 0
    while True:
        owner = drawn.groupBy("family", "new").agg(F.min(F.struct("kind", "form")).alias("owner"))
        won = drawn.join(owner, ["family", "new"]).filter((F.col("owner.kind") == F.col("kind")) & (F.col("owner.form") == F.col("form")))
        won = won.join(forms, ["family", "new"], "left_anti").join(settled.select("family", "new"), ["family", "new"], "left_anti")
        won = materialise(won.select("kind", "form", "attempt", "new", "family", F.lit(True).alias("apart")), "settled")
        settled = settled.unionByName(won)
        lost = drawn.join(won, ["kind", "form"], "left_anti")
        attempt += 1
        if lost.isEmpty():
            return settled.drop("family")
        pending = lost.select("kind", "form", F.lit(attempt).alias("attempt"))
        drawn = materialise(pending.mapInArrow(_drawn(key), _SCHEMA), "drawn").withColumn("family", family)


def _replace(key: bytes, countries: tuple[str, str], shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = shared.value
        memo: dict[tuple[str, str, int, int], str] = {}
        for batch in batches:
            row, own = batch.column("row"), batch.column("redrawn")
            new_text, lists = [], []
            for i, t in enumerate(batch.column("text")):
                text = t.as_py()
                spans, out, at = [], [], 0
                found = detect(text, countries) if text else []
                mine = {(x["kind"], x["form"]): (x["as_kind"], x["attempt"]) for x in own[i].as_py() or ()} if found else {}
                for a, b, kind, form in found:
                    entity = _assigned(kind, form)
                    as_kind, n = mine.get(entity) or common.get(entity) or (kind, 0)
                    of_domain = n if kind == "email" else 0
                    if kind != "email":
                        kind = as_kind
                    if (kind, form, n) not in memo:
                        if len(memo) > 200_000:
                            memo.clear()
                        memo[kind, form, n] = surrogate(kind, form, n, key, of_domain)
                    new = pour(text[a:b], kind, form, memo[kind, form, n])
                    out += [text[at:a], new]
                    spans.append({"kind": kind, "start": a, "end": b, "surrogate": new})
                    at = b
                new_text.append(text if text is None or not found else "".join([*out, text[at:]]))
                lists.append(spans)
            yield pa.RecordBatch.from_arrays([row, pa.array(new_text, pa.string()), pa.array(lists, batch.schema.field("entities").type)], names=["row", "text", "entities"])

    return run


def anonymise(docs: DataFrame, text_col: str = "text", key: bytes = KEY, broadcast_redrawn: int = BROADCAST_REDRAWN, countries: tuple[str, str] = COUNTRIES, keep: list[str] | None = None) -> DataFrame:
    """One row per document: ``row`` (struct of the input columns ``keep``, all but the text by default, whatever their
    names), ``text`` with the surrogates, ``entities`` (kind, start, end in the input text, surrogate).

    ``countries``: the codes of phone numbers written as ddd-ddd-dddd and of those behind a trunk 0, which are one
    entity with the same number behind ``+`` and the code.
    A null text stays null and an empty one empty; texts without entities stay as
    they are; repeated rows get the same surrogates; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c != text_col] if keep is None else keep
    texts = docs.select(F.col(text_col).alias("text"))
    said = materialise(texts.mapInArrow(_entities(countries), "kind string, form string").distinct(), "said")
    entities = materialise(one_gender(said), "entities")
    again = assign(entities.select(F.col("as_kind").alias("kind"), "form").distinct(), key).filter("attempt > 0").select(F.col("kind").alias("as_kind"), "form", "attempt")
    redrawn = entities.join(again, ["as_kind", "form"], "left").filter("attempt > 0 or kind <> as_kind")
    redrawn = materialise(redrawn.select("kind", "form", "as_kind", F.coalesce("attempt", F.lit(0)).alias("attempt")), "redrawn")
    few = redrawn.count() <= broadcast_redrawn
    shared = spark.sparkContext.broadcast({(r["kind"], r["form"]): (r["as_kind"], r["attempt"]) for r in redrawn.collect()} if few else {})
    kind = "array<struct<kind:string,form:string,as_kind:string,attempt:int>>"
    text = F.col(f"`{text_col}`").alias("text")
    rows = docs.select(whole_row(docs.select(*[F.col(f"`{c}`") for c in kept])) if kept else F.struct(F.lit(0).alias("none")).alias("row"), text)
    if few:
        rows = rows.withColumn("redrawn", F.lit(None).cast(kind))
    else:
        # only documents that mention such an entity get a list of attempts; two independent hashes stand for a text
        hashes = [F.xxhash64("text").alias("h"), F.xxhash64(F.lit(1), "text").alias("h2")]
        keyed = texts.select(*hashes, "text").dropDuplicates(["h", "h2"])
        mentions = keyed.mapInArrow(_mentions(countries), "h long, h2 long, kind string, form string").join(redrawn, ["kind", "form"])
        lists = mentions.groupBy("h", "h2").agg(F.collect_list(F.struct("kind", "form", "as_kind", "attempt")).alias("redrawn"))
        rows = rows.select("*", *hashes).join(lists, ["h", "h2"], "left").select("row", "text", "redrawn")
    entity = "array<struct<kind:string,start:int,end:int,surrogate:string>>"
    rows = rows.withColumn("entities", F.array().cast(entity))
    schema = rows.select("row", "text", "entities").schema
    schema["text"].nullable = True
    return rows.mapInArrow(_replace(key, countries, shared), schema)


def _mentions(countries: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = zip(batch.column("h"), batch.column("h2"), batch.column("text"))
            rows = [(h.as_py(), h2.as_py(), k, f) for h, h2, t in texts for k, f in {_assigned(*e[2:]) for e in detect(t.as_py() or "", countries)}]
            types = (pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["h", "h2", "kind", "form"])

    return run
