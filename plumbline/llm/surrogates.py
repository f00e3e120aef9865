"""Personal data and secrets replaced by keyed surrogates of the same type.

An entity is found by pattern, brought into a canonical form (so that one phone
number in two notations is one entity), and replaced everywhere by the same
surrogate. Numbers, addresses and keys go through a keyed permutation of all strings
of their shape, so distinct entities stay distinct by construction; names are made
from syllables of their gender and script. A check over all entities of the corpus
finds surrogates that two entities share or that are themselves an entity, and gives
the later one another surrogate until none is left.
"""

from __future__ import annotations

import hashlib
import ipaddress
import math
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.llm.common import bounded_batches, replaced, set_down, string

#: Changed surrogates up to this number are broadcast; beyond, each document gets its own by a join.
BROADCAST_CHANGES = 100_000
#: Attempts after which an entity of a fixed shape, as a number, may bear the name of another one, which has a third name: its shape
#: may have no other left. Names and addresses grow with the attempts and never bear a real one; the same name twice never stays.
REAL_ATTEMPTS = 64
#: Characters up to which a string is permuted as one number.
LONG = 256
#: Surrogates a worker remembers before it starts anew.
HELD = 200_000

# Titles by gender, and frequent given names.
TITLES = {"m": "Mr|Mister|Sir|Herr|Monsieur|Señor|Signor|Don", "f": "Mrs|Ms|Miss|Madam|Frau|Madame|Mme|Mlle|Señora|Señorita|Signora",
          "u": "Dr|Prof|Mx"}
GIVEN_M = """James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Peter Paul Mark George Hans Klaus
Jürgen Wolfgang Stefan Pierre Jean Jacques Louis Antoine José Juan Carlos Luis Miguel Ivan Dmitri Иван Дмитрий Сергей Алексей""".split()
GIVEN_F = """Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Anna Emily Laura Julia Ursula Monika Petra
Sabine Marie Claire Sophie Isabelle María Carmen Ana Lucía Olga Natalia Анна Ольга Наталья Мария""".split()

# Words that follow a title or a given name in ordinary text and are no name.
NO_NAMES = frozenset("""my the your his her our their this that these those and or but if is was will words president chairman chairwoman speaker
minister chancellor secretary ambassador justice judge mayor governor director attorney you me who please said says has had would could
should may might can does did""".split())

def _plain(word: str) -> str:
    """The word without accents."""
    return "".join(c for c in unicodedata.normalize("NFD", word) if not unicodedata.combining(c)) if not re.search("[а-яё]", word) else word


def _with_plain(names: list[str]) -> list[str]:
    return list(dict.fromkeys([*names, *map(_plain, names)]))


SECRET_NAMES = r"(?i:api[_-]?key|access[_-]?key|private[_-]?key|auth|token|secret|passw(?:or)?d|pwd)"
KEY_STARTS = ("AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-", "sk-", "eyJ")

#: Characters at which, or next to which, an entity can be; only there are the patterns tried.
_TRIGGER = re.compile(r"[0-9@+(=:]")
_LOCAL = re.compile(r"[\w.%+-]+")
_DOMAIN = re.compile(r"@[^\W_](?:[\w-]*[^\W_])?(?:\.[^\W_](?:[\w-]*[^\W_])?)+")
_ASSIGNED = re.compile(SECRET_NAMES + r"[\"']?\s{0,4}\Z")
#: A quoted value runs to its quote; another one to white space or the next ``name=`` after one of ``&;,``.
_VALUE = re.compile(r"""[=:][^\w\n]{0,4}?(?:"(?P<double>(?:[^"\\\n]|\\.){6,}+)"|'(?P<single>(?:[^'\\\n]|\\.){6,}+)'"""
                    r"""|(?P<value>(?:[^\s"'&;,]|["'](?=\w)|[&;,](?!["']?[\w.-]{1,64}["']?[=:])){6,}+))""")
_AFTER_VALUE = ".,;:!?)]}>\"'"
_PEM = re.compile(r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----[A-Za-z0-9+/=\s\\]*(?:-----END [A-Z ]{0,30}PRIVATE KEY-----)?")
_KEY = re.compile(r"(?<![0-9A-Za-z])(?:AKIA[0-9A-Z]{16}|gh[pousr]_\w{20,}|xox[abprs]-[\w-]{10,}|sk-[\w-]{20,}|eyJ[\w-]{8,}\.[\w-]{8,}\.[\w-]*)")
_HEX = re.compile(r"[0-9a-fA-F]{32,}(?![0-9A-Za-z])")
_IBAN = re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])")
_MAC = re.compile(r"(?<![0-9A-Za-z:-])(?:[0-9A-Fa-f]{2}[:-]){5}[0-9A-Fa-f]{2}(?![0-9A-Za-z:-])")
_IP6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}(?:(?:\d{1,3}\.){3}\d{1,3}|[0-9A-Fa-f]{0,4})(?![\w:])")
#: Kinds that start at a digit, a plus or a bracket, in the order in which they are tried.
_NUMBERS = [
    ("ip", re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)")),
    ("ssn", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")),
    ("phone", re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{2,4}\) ?\d{3,4}[ .-]\d{3,4}"
                         r"|\d{3}[.-]\d{3}[.-]\d{4}"
                         r"|(?<![\w+.,/:-])(?!(?:\d[ /-]?){12}\d)(?:\d{3} \d{3}[ .-]\d{4}"
                         r"|(?=0(?:[ /-]?\d){8,11}(?!\d))0\d{2,5}[ /-]?\d{2,4}(?:[ -]?\d{2,4}){1,3}|0\d(?P<sep>[ .-]?)\d{2}(?:(?P=sep)\d{2}){3}))(?!\d)")),
    ("account", re.compile(r"(?<![\d.,-])\d(?:[ -]?\d){12,18}(?!\d)")),
]
_NAME = r"(?:[^\W\d_]['’](?=[^\W\d_]))?[^\W\d_][^\W\d_]+(?:['’-][^\W\d_]+)?"
_WORD = re.compile(_NAME)
#: What a name starts with, and each further word of it: initials and lower-case particles may stand before a name word.
_NAMED = re.compile(rf"\b(?:(?P<title>{'|'.join(TITLES.values())}|mrs?|ms)\b\.?(?= )|(?P<given>{'|'.join(_with_plain(GIVEN_M + GIVEN_F))})\b(?= |['’-]))")
_NEXT = re.compile(rf" +(?:[^\W\d_]\.? +)*(?:(?:van|von|vom|zu|zum|zur|den|der|ter|ten|de|del|della|di|da|dos|du|la|le|bin|ibn|al) +)*(?P<word>{_NAME})")
#: Values that are named in running text rather than assigned, and words before digits that are no entity.
_BEARER = re.compile(r"(?i:\bbearer|\bbasic) +(?P<value>[\w.~+/=-]{16,})")
_SPOKEN = re.compile(rf"{SECRET_NAMES} +(?i:is|was|ist|est|es) +[\"']?(?P<value>(?=[^\s\"']*\d)[^\s\"']{{6,}})")
_NO_IP = re.compile(r"(?i:\bversions?|\bver\.?|\brelease|\bv|\bsection|§) ?\Z")
_NO_ACCOUNT = re.compile(r"(?i:\bISBN(?:-1[03])?|\bISSN|\bEAN):? ?\Z")
_POSSESSIVE = re.compile(r"['’]s\Z", re.I)
_NAME_HINTS = ["mr", "ms", *"|".join(TITLES.values()).split("|"), *_with_plain(GIVEN_M + GIVEN_F)]


# ---------------------------------------------------------------- keyed permutations

class Permutation:
    """A keyed bijection of the numbers below a size: Feistel rounds over two digits, walked until inside."""

    def __init__(self, key: bytes, rounds: int = 8):
        self.key, self.rounds = key, rounds

    def _mix(self, tweak: str, turn: int, value: int, size: int) -> int:
        return int.from_bytes(hashlib.blake2b(f"{tweak}|{turn}|{value}".encode(), key=self.key, digest_size=32).digest()) % size

    def of(self, value: int, size: int, tweak: str, accept=lambda v: True) -> int:
        """The image; with ``accept``, of the bijection on the accepted numbers alone, to which ``value`` belongs."""
        if size < 2:
            return value
        side = math.isqrt(size - 1) + 1
        tweak = f"{tweak}|{size}"
        while True:
            a, b = divmod(value, side)
            for turn in range(self.rounds):
                if turn % 2:
                    a = (a + self._mix(tweak, turn, b, side)) % side
                else:
                    b = (b + self._mix(tweak, turn, a, side)) % side
            value = a * side + b
            if value < size and accept(value):
                return value


_ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "абвгдежзийклмнопрстуфхцчшщъыьэюя",
              "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ", "αβγδεζηθικλμνξοπρστυφχψω")
_OF_CHAR = {c: a for a in _ALPHABETS for c in a}
_LOWER_HEX, _UPPER_HEX = "0123456789abcdef", "0123456789ABCDEF"


def _permuted(p: Permutation, text: str, tweak: str, alphabet_of=_OF_CHAR.get, accept=None) -> str:
    """Each character stays in its alphabet; characters without one stay.

    A bijection on each shape; above ``LONG`` characters a keyed stream, where only
    the collision check speaks for distinctness.
    """
    places = [(i, a) for i, c in enumerate(text) if (a := alphabet_of(c))]
    if len(places) > LONG:
        out = list(text)
        stream = hashlib.shake_256(p.key + f"|{tweak}|{text}".encode()).digest(2 * len(places))
        for n, (i, a) in enumerate(places):
            out[i] = a[int.from_bytes(stream[2 * n:2 * n + 2]) % len(a)]
        return "".join(out)
    shape = "".join(str(len(a)) + "," for _, a in places)
    value, size = 0, 1
    for i, a in places:
        value, size = value * len(a) + a.index(text[i]), size * len(a)

    def spelt(number: int) -> str:
        out = list(text)
        for i, a in reversed(places):
            number, digit = divmod(number, len(a))
            out[i] = a[digit]
        return "".join(out)

    number = p.of(value, size, f"{tweak}|{shape}", (lambda v: accept(spelt(v))) if accept else lambda v: True)
    return spelt(number)


# ---------------------------------------------------------------- canonical forms

def _luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _iban_ok(code: str) -> bool:
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _private(ip: str) -> bool:
    a, b = (int(x) for x in ip.split(".")[:2])
    return a in (10, 127) or (a, b) == (192, 168) or (a == 172 and 16 <= b < 32)


def _local_ip6(exploded: str) -> bool:
    return exploded[:2] in ("fc", "fd") or exploded[:3] in ("fe8", "fe9", "fea", "feb") or exploded[:4] == "0000"


def canonical(kind: str, text: str) -> str:
    if kind == "email":
        return text.lower()
    if kind == "ip6":
        return ":".join(re.findall("....", f"{int(ipaddress.IPv6Address(text)):032x}"))
    if kind in ("hex", "mac"):
        return re.sub("-", ":", text).lower() if kind == "mac" else text.lower()
    if kind in ("phone", "account", "ssn"):
        return ("+" if text.startswith("+") else "") + re.sub(r"\D", "", text)
    if kind == "iban":
        return text.replace(" ", "")
    if kind == "ip":
        return ".".join(str(int(x)) for x in text.split("."))
    return text if kind in ("secret", "pem") else text.lower()


def _country_code(digits: str) -> int:
    """Leading digits of an international number that stay, as the format asks."""
    return 1 if digits[0] in "17" else 2


def surrogate(p: Permutation, kind: str, canon: str, attempt: int = 0) -> str:
    """The canonical form of the surrogate of a canonical entity."""
    tweak = f"{kind}|{attempt}"
    if kind == "email":
        local, _, domain = canon.rpartition("@")
        labels = domain.split(".")
        fixed = 2 if len(labels) > 2 else 1
        moved = [_permuted(p, x, f"{tweak}|domain") for x in labels[:-fixed]]
        longer = str(p.of(attempt, 10 ** attempt, canon)) if attempt else ""  # a short name must not run out of others
        return f"{_permuted(p, local, tweak)}{longer}@{'.'.join(moved + labels[-fixed:])}"
    if kind == "ip6":  # local addresses stay local; the first group of another one stays no local one
        local = _local_ip6(canon)
        first = canon[:4] if local else _permuted(p, canon[:4], f"{tweak}|first", lambda c: _LOWER_HEX, accept=lambda x: not _local_ip6(x))
        return first + _permuted(p, canon[4:], f"{tweak}|{canon[:4]}", lambda c: _LOWER_HEX if c in _LOWER_HEX else None)
    if kind in ("hex", "mac"):
        return _permuted(p, canon, tweak, lambda c: _LOWER_HEX if c in _LOWER_HEX else None)
    if kind == "ip":
        private = _private(canon)
        number = int.from_bytes(bytes(map(int, canon.split("."))))

        def dotted(v: int) -> str:
            return ".".join(map(str, v.to_bytes(4)))

        return dotted(p.of(number, 1 << 32, f"{tweak}|{private}", lambda v: _private(dotted(v)) == private))
    if kind == "phone" and canon[0] == "+":
        keep = 1 + _country_code(canon[1:])
        return canon[:keep] + _permuted(p, canon[keep:], f"{tweak}|{canon[:keep]}")
    if kind == "phone" and canon[0] == "0":
        return "0" + _permuted(p, canon[1:], f"{tweak}|0")
    if kind == "phone":
        return _permuted(p, canon, tweak, accept=lambda x: x[0] != "0")
    if kind == "account":
        valid = _luhn(canon)
        return _permuted(p, canon, f"{tweak}|{valid}", accept=lambda s: _luhn(s) == valid)
    if kind == "iban":
        valid = _iban_ok(canon)
        return canon[:2] + _permuted(p, canon[2:], f"{tweak}|{canon[:2]}|{valid}", accept=lambda s: _iban_ok(canon[:2] + s) == valid)
    if kind == "pem":
        return canon if not canon else "-----BEGIN PRIVATE KEY-----\n" + hashlib.blake2b(
            f"{tweak}|{canon}".encode(), key=p.key, digest_size=48).hexdigest() + "\n-----END PRIVATE KEY-----"
    if kind.startswith("name"):
        return _name(p, kind, canon, attempt)
    if kind == "secret" and canon.startswith("AKIA"):
        return "AKIA" + _permuted(p, canon[4:], tweak)
    return _permuted(p, canon, tweak)


# Syllables of made-up names by script, and endings by script and gender.
_SYLLABLES = {
    "latin": "ba be bi bo da de di do fa fe fi ga ge go ha he ja jo ka ke ki ko la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se si so ta te ti to va ve vi".split(),
    "cyrillic": "ба бе бо ва ве ви га го да де ди ка ко ла ле ли ма ме ми на не ни па пе ра ре ро са се си та те то".split(),
}
_ENDINGS = {
    ("latin", "m"): "ren ton mund rik bert nard".split(), ("latin", "f"): "lia nna ria line tta sha".split(),
    ("latin", "u"): "ry lin ner kim".split(), ("latin", "s"): "mann son berg field well ley ford ton wood stein".split(),
    ("cyrillic", "m"): "слав мир тон рик".split(), ("cyrillic", "f"): "лия рина лина нна".split(),
    ("cyrillic", "u"): "ша ня".split(), ("cyrillic", "s"): "енко ский ин ев".split(),
}


def _name(p: Permutation, kind: str, canon: str, attempt: int) -> str:
    """A made-up name part of the kind's gender and the entity's script; later attempts are longer, so they never run out."""
    gender, script = kind[-1], "cyrillic" if re.search("[а-яё]", canon) else "latin"
    number = int.from_bytes(hashlib.blake2b(f"{kind}|{attempt}|{canon}".encode(), key=p.key, digest_size=32).digest())
    out, syllables, endings = "", _SYLLABLES[script], _ENDINGS[script, gender]
    for _ in range(2 + attempt):
        number, k = divmod(number, len(syllables))
        out += syllables[k]
    return out + endings[number % len(endings)]


# ---------------------------------------------------------------- finding and replacing

def _dressed(kind: str, found: str, made: str) -> str:
    """The surrogate's canonical form in the notation of the place where the entity stands."""
    if kind in ("phone", "account", "ssn", "iban"):
        signs = iter(made.lstrip("+"))
        return "".join(next(signs, "") if c.isalnum() else c for c in found)
    if kind == "mac" and "-" in found:
        made = made.replace(":", "-")
    if kind.startswith("name"):
        made = "-".join(part.capitalize() for part in made.split("-"))
    letters = [c for c in found if c.isalpha()]
    if kind in ("email", "hex", "mac", "ip6") or kind.startswith("name"):
        if len(letters) > 1 and all(c.isupper() for c in letters):
            return made.upper()
    return made


def _gender(title: str) -> str:
    return next(g for g, names in TITLES.items() if title.capitalize() in names.split("|"))


_TITLES = frozenset("|".join(TITLES.values()).split("|"))
_LISTED = {x.lower(): "m" for x in _with_plain(GIVEN_M)} | {x.lower(): "f" for x in _with_plain(GIVEN_F)}


_NOT_AFTER = {"ip": _NO_IP, "account": _NO_ACCOUNT}
_SECRET_HINTS = ("passw", "Passw", "PASSW", "token", "Token", "secret", "Secret", "key", "Key", "KEY", "pwd", "auth")


def _spoken(text: str):
    return _SPOKEN.finditer(text) if any(hint in text for hint in _SECRET_HINTS) else ()


class Finder:
    """Entities of a text as ``(start, end, kind, found text)``, left to right without overlap.

    A cheap scan finds the characters around which an entity can be; the patterns are
    tried there alone, so text without any costs one pass.
    """

    def entities(self, text: str) -> list[tuple[int, int, str, str]]:
        found = []
        for m in _TRIGGER.finditer(text):
            at, sign = m.start(), m.group()
            if sign == "@":
                found += self._email(text, at)
            elif sign in "=:":
                found += self._assigned(text, at)
            else:
                found += self._number(text, at)
        if "-----BEGIN" in text:
            found += [(*m.span(), "pem") for m in _PEM.finditer(text)]
        if any(start in text for start in KEY_STARTS):
            found += [(*m.span(), "secret") for m in _KEY.finditer(text)]
        if "earer " in text or "asic " in text or "EARER " in text:
            found += [(*m.span("value"), "secret") for m in _BEARER.finditer(text)]
        if " is " in text or " was " in text or " es" in text or " ist " in text:
            found += [(*m.span("value"), "secret") for m in _spoken(text)]
        if any(name in text for name in _NAME_HINTS):
            found += self._names(text)
        if not found:
            return found
        out, end = [], 0
        for start, stop, kind in sorted(found, key=lambda e: (e[0], -e[1])):
            if start >= end:
                bare = kind == "secret" and _HEX.fullmatch(text, start, stop)
                out.append((start, stop, "hex" if bare else kind, text[start:stop]))
                end = stop
        return out

    @staticmethod
    def _email(text: str, at: int) -> list:
        start = at
        while start and (text[start - 1].isalnum() or text[start - 1] in "._%+-"):
            start -= 1
        domain = _DOMAIN.match(text, at)
        return [(start, domain.end(), "email")] if domain and start < at else []

    @staticmethod
    def _assigned(text: str, at: int) -> list:
        out = []
        if _ASSIGNED.search(text, max(0, at - 24), at):
            m = _VALUE.match(text, at)
            if m:
                start, stop = m.span(m.lastgroup)
                if m.lastgroup == "value":
                    bare = len(text[start:stop].rstrip(_AFTER_VALUE))
                    stop = start + bare if bare >= 6 else stop
                out.append((start, stop, "secret"))
        if text[at] == ":":
            out += Finder._hex_run(text, at)
        return out

    @staticmethod
    def _hex_run(text: str, at: int) -> list:
        start = at
        while start and (text[start - 1] in "0123456789abcdefABCDEF:-") and at - start < 64:
            start -= 1
        m = _MAC.match(text, start)
        if m:
            return [(*m.span(), "mac")]
        start = at
        while start and (text[start - 1] in "0123456789abcdefABCDEF:") and at - start < 64:
            start -= 1
        m = _IP6.match(text, start)
        if not m:
            return []
        stop = m.end() - (m.group().endswith(":") and not m.group().endswith("::"))
        try:  # an address without a digit, or of no host, is none
            return [(start, stop, "ip6")] if int(ipaddress.IPv6Address(text[start:stop])) > 1 and re.search(r"\d", m.group()) else []
        except ValueError:
            return []

    @staticmethod
    def _number(text: str, at: int) -> list:
        before = text[at - 1] if at else " "
        if before in "0123456789":
            return []  # tried where the digits began
        if before.isalpha() and at >= 2 and (m := _IBAN.match(text, at - 2)):
            return [(*m.span(), "iban")]
        for kind, pattern in _NUMBERS:
            m = pattern.match(text, at)
            if m and not (kind in _NOT_AFTER and _NOT_AFTER[kind].search(text, max(0, at - 16), at)):
                return [(*m.span(), kind)]
        start = at
        while before.isalpha() and start and text[start - 1] in "0123456789abcdefABCDEF":
            start -= 1
        if not (start and text[start - 1].isalnum()) and (m := _HEX.match(text, start)):
            return [(*m.span(), "hex")]
        return Finder._hex_run(text, at)

    @staticmethod
    def _names(text: str) -> list[tuple[int, int, str]]:
        """Name parts after titles and listed given names, and every other mention of these parts in the text.

        The given names and the surname are apart, so that each has its surrogate
        wherever it stands. A given name has one gender in a text: that of the lists,
        else of most of its titles and of the given names before it.
        """
        parts, genders, at = [], {}, 0
        while m := _NAMED.search(text, at):
            title, at = m.group("title"), m.end()
            words = [] if title else [Finder._word(text, m.start(), _WORD.match(text, m.start()).end())]
            here = words[0][1] if words else at
            lower = title is not None and title.islower()  # a title in small letters stands before one name in small letters
            while (n := _NEXT.match(text, here)) and (n.group("word")[0].isupper() or (lower and not words)):
                if (_NAMED.match(text, n.start("word")) and n.group("word") in _TITLES) or n.group("word").lower() in NO_NAMES:
                    break
                words.append(Finder._word(text, *n.span("word")))
                here = words[-1][1]
                if here < n.end("word"):
                    break  # a possessive ends the name
            if not words or (not title and len(words) == 1):
                continue
            at = max(at, here)
            lead = _LISTED.get(text[slice(*words[0])].lower()) or (_gender(title) if title else "u")
            for start, stop in words[:-1]:
                canon = text[start:stop].lower()
                genders.setdefault(canon, []).append(_LISTED.get(canon) or lead)
                parts.append((start, stop, canon, True))
            parts.append((*words[-1], text[slice(*words[-1])].lower(), False))
        if not parts:
            return []
        kinds = {canon: "name_" + max("mfu", key=lambda g, v=votes: (g != "u" and v.count(g), v.count(g))) for canon, votes in genders.items()}
        out = [(start, stop, kinds[canon] if given else "name_s") for start, stop, canon, given in parts]
        taken = {start for start, *_ in parts}
        spelt = {form: kind for start, stop, kind in out for form in (text[start:stop], text[start:stop].upper())}
        for m in _WORD.finditer(text):
            start, stop = Finder._word(text, *m.span())
            if start not in taken and (kind := spelt.get(text[start:stop])) and not (start and (text[start - 1].isalnum() or text[start - 1] == "_")):
                if not text[stop:stop + 1].isdigit() and text[stop:stop + 1] != "_":
                    out.append((start, stop, kind))
        return out

    @staticmethod
    def _word(text: str, start: int, stop: int) -> tuple[int, int]:
        """A word without a possessive ending."""
        ending = _POSSESSIVE.search(text[start:stop])
        return start, stop - (len(ending.group()) if ending else 0)


class Replacer:
    def __init__(self, key: bytes, changes: dict[tuple[str, str], int] | None = None):
        self.finder, self.permutation, self.changes = Finder(), Permutation(key), changes or {}
        self.held: dict[tuple[str, str], str] = {}

    def made(self, kind: str, canon: str, changes=None) -> str:
        attempt = (self.changes if changes is None else changes).get((kind, canon), 0)
        known = self.held.get((kind, canon, attempt))
        if known is None:
            if len(self.held) > HELD:
                self.held.clear()
            known = self.held[kind, canon, attempt] = surrogate(self.permutation, kind, canon, attempt)
        return known

    def replace(self, text: str | None, changes=None) -> tuple[str | None, int]:
        """The text with surrogates, and how many entities it had."""
        if not text:
            return text, 0
        out, at, found = [], 0, self.finder.entities(text)
        for start, end, kind, entity in found:
            out += [text[at:start], _dressed(kind, entity, self.made(kind, canonical(kind, entity), changes))]
            at = end
        return ("".join(out) + text[at:], len(found)) if found else (text, 0)


def _collect_entities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    finder, seen = Finder(), set()

    def out():
        rows = list(seen)
        seen.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], ["kind", "canon"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            seen.update((kind, canonical(kind, found)) for _, _, kind, found in finder.entities(text))
        if len(seen) > HELD:
            yield out()
    yield out()


def _with_surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Permutation(key)
        for batch in batches:
            made = [surrogate(p, *row) for row in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(made, pa.string())], ["kind", "canon", "attempt", "made"])
    return entities.select("kind", "canon", "attempt").mapInArrow(run, "kind string, canon string, attempt int, made string")


def changed_surrogates(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``(kind, canon, attempt)`` of the entities whose first surrogate collides, over the whole corpus.

    A surrogate collides if an entity of the same type smaller in order has it too, or
    if it is itself an entity of that type; names of all kinds are one type. Rounds go
    on until there is no collision.
    """
    entities = docs.select(string(text).alias("text")).mapInArrow(_collect_entities, "kind string, canon string").distinct()
    state = set_down(_with_surrogates(entities.withColumn("attempt", F.lit(0)), key))
    while True:
        typed = state.withColumn("type", F.when(F.col("kind").startswith("name"), F.lit("name")).otherwise(F.col("kind")))
        shared = typed.groupBy("type", "made").agg(F.min(F.struct("attempt", "canon", "kind")).alias("first"), F.count(F.lit(1)).alias("n"))
        later = typed.join(shared.where("n > 1"), ["type", "made"]).where("canon <> first.canon or kind <> first.kind").select("kind", "canon")
        real = typed.select("type", "kind", "made", "attempt", F.col("canon").alias("c")).join(
            typed.select("type", F.col("canon").alias("made")), ["type", "made"], "left_semi").where(
            F.col("type").isin("name", "email") | (F.col("attempt") < REAL_ATTEMPTS)).select("kind", F.col("c").alias("canon"))
        bad = later.unionByName(real).distinct()
        if not bad.limit(1).count():
            return state.where("attempt > 0").select("kind", "canon", "attempt")
        marked = state.join(bad.withColumn("bad", F.lit(1)), ["kind", "canon"], "left")
        again = marked.where("bad = 1").select("kind", "canon", (F.col("attempt") + 1).alias("attempt"))
        state = set_down(marked.where("bad is null").drop("bad").select("kind", "canon", "attempt", "made").unionByName(
            _with_surrogates(again, key)))


def replace_personal_data(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """The documents with surrogates in ``text``; other columns, null and empty texts are untouched.

    Works on every row by itself once the collisions of the corpus are known, so
    repeated rows change alike and names of other columns do not matter.
    """
    bounded_batches(docs.sparkSession)
    changes = set_down(changed_surrogates(docs, key, text))
    position, many = docs.columns.index(text), changes.count()
    if many > BROADCAST_CHANGES:
        return _replace_by_join(docs, key, changes, position)
    table = docs.sparkSession.sparkContext.broadcast({(r[0], r[1]): r[2] for r in changes.collect()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replacer = Replacer(key, table.value)
        return replaced(batches, position, lambda texts: [replacer.replace(t)[0] for t in texts])

    return docs.mapInArrow(run, docs.schema)


def _replace_by_join(docs: DataFrame, key: bytes, changes: DataFrame, position: int) -> DataFrame:
    """The same where the changed surrogates are too many to broadcast: each text is joined with its own."""
    names = docs.columns
    hidden = docs.toDF(*[f"__{i}" for i in range(len(names))]).withColumn("__hash", F.xxhash64(f"__{position}"))

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        for batch in batches:
            rows = {(h, kind, canonical(kind, found)) for h, t in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True)
                    for _, _, kind, found in finder.entities(t or "")}
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64())] + [
                pa.array([r[i] for r in rows], pa.string()) for i in (1, 2)], ["__hash", "kind", "canon"])

    met = hidden.select("__hash", f"__{position}").mapInArrow(occurrences, "__hash bigint, kind string, canon string").distinct()
    own = met.join(changes, ["kind", "canon"]).groupBy("__hash").agg(
        F.collect_list(F.struct("kind", "canon", "attempt")).alias("__own"))
    joined = hidden.join(own, "__hash", "left").select(*[f"__{i}" for i in range(len(names))], "__own")
    out = T.StructType(joined.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replacer = Replacer(key)
        for batch in batches:
            edits = [replacer.replace(t, {(o["kind"], o["canon"]): o["attempt"] for o in own_ or ()})[0]
                     for t, own_ in zip(batch.column(position).to_pylist(), batch.columns[-1].to_pylist(), strict=True)]
            columns = list(batch.columns[:-1])
            columns[position] = pa.array(edits, columns[position].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    return joined.mapInArrow(run, out).toDF(*names)


def count_entities(docs: DataFrame, carry: list[str], text: str = "text") -> DataFrame:
    """``carry`` columns and ``entities``: how many of each kind every text holds."""
    bounded_batches(docs.sparkSession)
    plan, n = docs.select(*[F.col(f"`{c}`") for c in carry], string(text).alias("__text")), len(carry)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plan.schema.fields[:n])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        for batch in batches:
            kinds = [[e[2] for e in finder.entities(t)] for t in batch.column(n).to_pylist()]
            maps = pa.array([[(k, x.count(k)) for k in sorted(set(x))] for x in kinds], pa.map_(pa.string(), pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], maps], [*batch.schema.names[:n], "entities"])

    return plan.mapInArrow(run, f"{fields}, entities map<string,int>")
