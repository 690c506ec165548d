"""PII surrogates (operator 5): keyed, type-consistent replacements.

Detected entities: e-mail addresses, telephone numbers (international with or
without separators, North American, and national ones with a leading zero),
payment cards, IPv4 and IPv6 addresses (compressed ones too), US social security
numbers, IBANs, and person names: after a title, after a known given name, and
after words that introduce a person ("my name is", "Contact:", "Dear").  Later
bare mentions of a name that a document has introduced so are found too.

A surrogate has its original's type, format and script: letters become letters
of the same script and case, digits digits; punctuation, country codes, top-level
domains, address ranges, card brands and check digits stay valid.  A known given
name becomes another one of the same gender and script; where a title tells the
other gender ("Mrs Jean"), two names of that gender; the parts of a hyphenated
name are replaced each by itself.  An unknown name keeps
its vowel and consonant pattern, and its ending.

Distinctness and coreference: within a type and format the replacement is a
keyed permutation without fixed points (a Feistel network P, used as
``P^-1(P(x) + 1)``, walked until the type's own conditions hold).  So equal
entities get equal surrogates in every document, different ones different
surrogates, without a table; mail domains, given names and surnames are mapped
each by themselves, so "Ms Reed" follows "Anna Reed", and a telephone number is
its country code and digits, however it is written ("+1 555-123-4567" and
"(555) 123-4567" have one surrogate).  ``collisions`` checks this over a whole
corpus, and ``checked`` refuses a result that has any.

The key comes from the session's ``spark.cairn.pii.key``.  Where that is unset
one is drawn at random for the application and never written, so its surrogates
agree with one another and nobody can invert them.

Scale: one narrow pass; only 40-byte digests of distinct entities are shuffled
for the check.

Defined results: null text stays null; empty text stays empty; null keys are
carried; repeated rows are each returned; an empty table gives an empty
result; other columns pass through unchanged, whatever their names.  A national
telephone number and its international form can't be told to be one, and differ.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import secrets
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import common

# Titles with the gender they tell, and given names by gender and script.
TITLES = {
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Signor", "Господин", "Κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Signora", "Госпожа", "Κυρία"),
    "n": ("Dr", "Prof", "Professor"),
}
GIVEN = {
    ("m", "latin"): "James John Robert Michael William David Richard Joseph Thomas Daniel Peter Paul Hans Karl Lukas Pierre Jean Louis Antoine Carlos Miguel Javier Diego Pablo Ahmed Mohammed Omar Hassan Ali Wei Kenji Raj Arjun Ivan Lars Erik Marco Giovanni".split(),
    ("f", "latin"): "Mary Linda Susan Karen Nancy Emily Sarah Laura Anna Julia Helga Ingrid Claudia Marie Sophie Camille Chloé Carmen Lucía Elena Isabel Teresa Rosa Clara Fatima Aisha Leila Yuki Mei Priya Olga Astrid Giulia Francesca Jennifer Jessica Elizabeth Patricia".split(),
    ("m", "cyrillic"): "Иван Пётр Алексей Дмитрий Сергей Николай Михаил Андрей Павел Олег".split(),
    ("f", "cyrillic"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Екатерина Юлия".split(),
    ("m", "greek"): "Γιώργος Νίκος Γιάννης Δημήτρης Κώστας Παύλος".split(),
    ("f", "greek"): "Μαρία Ελένη Κατερίνα Σοφία Αγγελική Ειρήνη".split(),
}
# Words that introduce a person's name, and country codes of one and two digits (all others have three).
INTRODUCED = ("my name is", "full name:", "first name:", "last name:", "surname:", "contact:", "contact person:", "author:", "dear", "sincerely,", "regards,", "signed by", "attn:", "attention:", "spoke with", "written by", "patient:", "employee:", "customer:")
CODES = {"1", "7", *"20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()}
_POOL_OF = {name: pool for pool in GIVEN.values() for name in pool}
_KIND_OF = {name: kind for kind, pool in GIVEN.items() for name in pool}

# Letters that replace one another, by script, case and sound.
CLASSES = (
    "0123456789", "aeiouy", "bcdfghjklmnpqrstvwxz", "AEIOUY", "BCDFGHJKLMNPQRSTVWXZ",
    "àáâãäåæèéêëìíîïòóôõöøùúûüýÿ", "çñðþß", "ÀÁÂÃÄÅÆÈÉÊËÌÍÎÏÒÓÔÕÖØÙÚÛÜÝ", "ÇÑÐÞ",
    "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "АЕЁИОУЫЭЮЯ", "БВГДЖЗЙКЛМНПРСТФХЦЧШЩ",
    "αεηιουωάέήίόύώ", "βγδζθκλμνξπρσςτφχψ", "ΑΕΗΙΟΥΩΆΈΉΊΌΎΏ", "ΒΓΔΖΘΚΛΜΝΞΠΡΣΤΦΧΨ",
)
_CLASS_OF = {ch: c for c in CLASSES for ch in c}

_EMAIL = re.compile(r"[\w.%+\-]+@(?:[A-Za-z0-9\-]+\.)+[A-Za-z]{2,}")
_IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
_IPV6 = re.compile(r"(?<![\w:.])(?=[0-9A-Fa-f]{0,4}:[0-9A-Fa-f]{0,4}:)[0-9A-Fa-f:]{0,38}(?:[0-9A-Fa-f]|::)(?!\w|:[0-9A-Fa-f:])")
_IPV4 = re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)")
_SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
_PHONE = re.compile(
    r"(?<![\w.+])(?:\+\d{1,3}[ .\-]?)?(?:\(\d{3}\)[ .\-]?|\d{3}[ .\-])\d{3}[ .\-]\d{4}(?!\w)"
    r"|(?<![\w.+])\+\d{1,3}(?:[ .\-/]\(?\d{1,10}\)?){1,6}(?!\w)"
    r"|(?<![\w.+])\+\d{8,15}(?!\w)"
    r"|(?<![\w.+\-/])0\d{1,4}[ /\-]\d{5,8}(?![\w\-/])"
)
_CARD = re.compile(r"(?<![\w.\-+])\d(?:[ \-]?\d){12,18}(?![\w])")
_WORD = r"[^\W\d_]+(?:['’\-][^\W\d_]+)*"
_TITLE_OF = {t: g for g, titles in TITLES.items() for t in titles}
_TITLE = "|".join(sorted(_TITLE_OF, key=len, reverse=True))
_PERSON = re.compile(
    rf"\b(?P<title>{_TITLE})\.? (?P<a>{_WORD})(?: (?P<b>{_WORD}))?"
    rf"|(?<![\w\-])(?P<c>(?:{'|'.join(sorted(_POOL_OF, key=len, reverse=True))})(?:-{_WORD})?) (?P<d>{_WORD})"
    rf"|\b(?i:{'|'.join(re.escape(x) for x in INTRODUCED)})\s+(?!(?:{_TITLE})\b)(?P<e>{_WORD})(?: (?P<f>{_WORD}))?"
)
# What an introduction may be followed by instead of a name.
_NO_NAME = {"Sir", "Sirs", "Madam", "All", "Team", "Customer", "Colleague", "Colleagues", "Friend", "Friends", "Editor", "User", "Support", "Sales", "Info", "The", "Our", "Us"}
_MAYBE = re.compile(r"@|\d[\d \-().:/]{5,}\d|\d{2} ?[A-Z0-9]{4}|[0-9A-Fa-f]:[0-9A-Fa-f]|::")


class Permuter:
    """Keyed permutations without fixed points of ``range(n)``, one for each tweak."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, tweak: bytes, number: int, half: int, bits: int) -> int:
        size = (bits + 7) // 8
        data = tweak + bytes([number]) + half.to_bytes(size, "big")
        out = b""
        while len(out) < size:
            out += hmac.digest(self.key, data + bytes([len(out) // 32]), "sha256")
        return int.from_bytes(out[:size], "big") & ((1 << bits) - 1)

    def _once(self, n: int, x: int, tweak: bytes, back: bool) -> int:
        bits = max(1, ((n - 1).bit_length() + 1) // 2)
        mask = (1 << bits) - 1
        while True:  # walk until the value is in range again
            left, right = x >> bits, x & mask
            for number in reversed(range(8)) if back else range(8):
                if back:
                    left, right = right ^ self._round(tweak, number, left, bits), left
                else:
                    left, right = right, left ^ self._round(tweak, number, right, bits)
            x = left << bits | right
            if x < n:
                return x

    def shift(self, n: int, x: int, tweak: bytes) -> int:
        if n < 2:
            return x
        return self._once(n, (self._once(n, x, tweak, False) + 1) % n, tweak, True)


def mixed(permuter: Permuter, text: str, kind: str, classes: list[str] | None = None, ok: Callable[[str], bool] = lambda s: True) -> str:
    """Replace ``text`` by another of the same classes, place by place; a class of one letter stays.

    Walks on until ``ok``; ``ok(text)`` must hold, so the walk ends, and stays a permutation.
    """
    classes = classes or [_CLASS_OF.get(ch, ch) for ch in text]
    n = 1
    for c in classes:
        n *= len(c)
    tweak = f"{kind}|{'|'.join(classes)}|".encode()
    x = 0
    for ch, c in zip(text, classes):
        x = x * len(c) + c.index(ch)
    while True:
        x = y = permuter.shift(n, x, tweak)
        out = []
        for c in reversed(classes):
            y, r = divmod(y, len(c))
            out.append(c[r])
        new = "".join(reversed(out))
        if ok(new):
            return new


def luhn(digits: str) -> bool:
    total = sum(int(d) if i % 2 == 0 else (2 * int(d) - 9 * (int(d) > 4)) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def iban_ok(code: str) -> bool:
    return int("".join(str(int(ch, 36)) for ch in code[4:] + code[:4])) % 97 == 1


def _refill(shape: str, chars: str) -> str:
    """Put ``chars`` in the places of ``shape``'s letters and digits."""
    it = iter(chars)
    return "".join(next(it) if ch.isalnum() else ch for ch in shape)


def _email(p: Permuter, s: str) -> str:
    local, _, domain = s.rpartition("@")
    labels = domain.split(".")
    keep = 2 if len(labels) > 1 and labels[-2].lower() == "example" else 1  # a reserved domain stays reserved
    head, tail = ".".join(labels[:-keep]), ".".join(labels[-keep:])
    # domains differ only in case when they are the same: lower case is permuted
    head = mixed(p, head.lower(), f"domain:{tail.lower()}") if head else ""
    name = "".join(n.upper() if o.isupper() and len(n.upper()) == 1 else n for o, n in zip(local, mixed(p, local.lower(), "local")))
    return f"{name}@{head + '.' if head else ''}{tail}"


# Address blocks that are not public.
_BLOCKS = [ipaddress.IPv4Network(b) for b in ("0.0.0.0/8", "10.0.0.0/8", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.168.0.0/16", "224.0.0.0/4", "240.0.0.0/4")]


def _address(s: str) -> ipaddress.IPv4Address:
    return ipaddress.IPv4Address(".".join(str(int(o)) for o in s.split(".")))


def _ipv4(p: Permuter, s: str) -> str:
    address = _address(s)
    for block in _BLOCKS:  # inside its block, if it has one
        if address in block:
            base = int(block.network_address)
            return str(ipaddress.IPv4Address(base + p.shift(block.num_addresses, int(address) - base, str(block).encode())))
    x = int(address)
    while True:
        x = p.shift(1 << 32, x, b"ipv4")
        if not any((new := ipaddress.IPv4Address(x)) in block for block in _BLOCKS):
            return str(new)


def _card(p: Permuter, s: str) -> str:
    digits = re.sub(r"\D", "", s)
    if luhn(digits):
        body = mixed(p, digits[1:-1], f"card:{digits[0]}")
        new = next(c for d in "0123456789" if luhn(c := digits[0] + body + d))
    else:
        new = digits[0] + mixed(p, digits[1:], f"number:{digits[0]}", ok=lambda b: not luhn(digits[0] + b))
    return _refill(s, new)


def _country(s: str) -> tuple[str, str]:
    """A telephone number's country code ("" for a national one) and the rest as it is written."""
    if not s.startswith("+"):
        return "", s
    separated = re.match(r"\+(\d{1,3})(?=\D)", s)
    if separated:
        return separated[1], s[separated.end() :]
    code = next(s[1 : 1 + n] for n in (1, 2, 3) if n == 3 or s[1 : 1 + n] in CODES)
    return code, s[1 + len(code) :]


def _dialled(s: str) -> tuple[str, str]:
    """Country code and digits; ten digits without a code or a leading zero are North American."""
    code, rest = _country(s)
    digits = re.sub(r"\D", "", rest)
    return ("1" if not code and len(digits) == 10 and not re.match(r"0\d{1,4}[ /\-]\d{5,8}$", s) else code), digits


def _phone(p: Permuter, s: str) -> str:
    code, digits = _dialled(s)
    american = code == "1" and len(digits) == 10
    classes = ["0123456789" if not american or i not in (0, 3) else "23456789" if ch > "1" else "01" for i, ch in enumerate(digits)]
    if not code and digits.startswith("0"):
        classes[0] = "0"  # the trunk prefix
    _, rest = _country(s)
    return s[: len(s) - len(rest)] + _refill(rest, mixed(p, digits, f"phone:{code}", classes))


# IPv6 ranges that are not global, the documentation range, and what is left.
_BLOCKS6 = [ipaddress.IPv6Network(b) for b in ("::/96", "::ffff:0:0/96", "64:ff9b::/96", "2001:db8::/32", "fc00::/7", "fe80::/10", "ff00::/8", "2000::/3", "::/0")]


def _ipv6_ok(s: str) -> bool:
    try:
        return int(ipaddress.IPv6Address(s)) > 1 and any(ch.isdigit() for ch in s)  # not the unspecified and the loopback address
    except ValueError:
        return False


def _ipv6(p: Permuter, s: str) -> str:
    """Inside its range; compressed, full or without leading zeros as the original is."""
    x = int(ipaddress.IPv6Address(s))
    number = next(n for n, b in enumerate(_BLOCKS6) if ipaddress.IPv6Address(x) in b)
    block = _BLOCKS6[number]
    base = int(block.network_address)
    while True:
        x = base + p.shift(block.num_addresses, x - base, str(block).encode())
        new = ipaddress.IPv6Address(x)
        if x > 1 and not any(new in b for b in _BLOCKS6[:number]):
            break
    if "::" in s:
        out = new.compressed
    elif all(len(part) == 4 for part in s.split(":")):
        out = new.exploded
    else:
        out = ":".join(f"{int(part, 16):x}" for part in new.exploded.split(":"))
    return out.upper() if s.upper() == s and s.lower() != s else out


def _iban(p: Permuter, s: str) -> str:
    code = s.replace(" ", "")
    body = mixed(p, code[4:], f"iban:{code[:2]}", ["0123456789" if ch.isdigit() else "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for ch in code[4:]])
    check = 98 - int("".join(str(int(ch, 36)) for ch in body + code[:2] + "00")) % 97
    return _refill(s, f"{code[:2]}{check:02d}{body}")


def _name(p: Permuter, s: str, gender: str = "") -> str:
    """``gender``: what a title tells, if it does."""
    if "-" in s:
        return "-".join(_name(p, part) for part in s.split("-"))
    pool = _POOL_OF.get(s)
    if pool:
        own, script = _KIND_OF[s]
        other = GIVEN.get((gender, script))
        if gender != own and other:  # all its names are taken: two of them, which no single name gets
            first, second = divmod(p.shift(len(other) * (len(other) - 1), pool.index(s), f"given:{own}>{gender}:{script}".encode()), len(other) - 1)
            return f"{other[first]} {other[second + (second >= first)]}"
        return pool[p.shift(len(pool), pool.index(s), ("given:" + pool[0]).encode())]
    # an unknown name: same sounds and ending, never a known given name
    classes = [_CLASS_OF.get(ch, ch) for ch in s]
    if len(s) > 2:
        classes[-1] = s[-1]
    return mixed(p, s, "name", classes, ok=lambda new: new not in _POOL_OF)


_KINDS: tuple[tuple[str, re.Pattern, Callable[[Permuter, str], str], Callable[[str], bool]], ...] = (
    ("email", _EMAIL, _email, lambda s: True),
    ("iban", _IBAN, _iban, lambda s: 15 <= len(s.replace(" ", "")) <= 34 and iban_ok(s.replace(" ", ""))),
    ("ipv6", _IPV6, _ipv6, _ipv6_ok),
    ("ipv4", _IPV4, _ipv4, lambda s: True),
    ("ssn", _SSN, lambda p, s: _refill(s, mixed(p, re.sub(r"\D", "", s), "ssn", ok=lambda d: d[0] != "9" and d[:3] not in ("000", "666") and d[3:5] != "00" and d[5:] != "0000")), lambda s: s[0] != "9" and s[:3] not in ("000", "666") and s[4:6] != "00" and s[7:] != "0000"),
    ("phone", _PHONE, _phone, lambda s: 7 <= sum(ch.isdigit() for ch in s) <= 15),
    ("card", _CARD, _card, lambda s: 13 <= sum(ch.isdigit() for ch in s) <= 19),
)


class Surrogates:
    """Finds entities in a text and replaces them."""

    def __init__(self, key: bytes):
        self.permuter = Permuter(key)
        self._of = lru_cache(maxsize=100_000)(self._make)

    def _make(self, kind: str, original: str, gender: str) -> str:
        if kind == "name":
            return _name(self.permuter, original, gender)
        return next(make for name, _, make, _ in _KINDS if name == kind)(self.permuter, original)

    def find(self, text: str) -> list[tuple[int, int, str, str]]:
        """(start, stop, kind, gender told by a title), not overlapping: earlier kinds first, then leftmost."""
        spans: list[tuple[int, int, str, str]] = []
        taken: bytearray | None = None

        def take(a: int, z: int, kind: str, gender: str = "") -> None:
            nonlocal taken
            taken = bytearray(len(text)) if taken is None else taken
            if taken.find(1, a, z) < 0:
                taken[a:z] = b"\1" * (z - a)
                spans.append((a, z, kind, gender))

        if _MAYBE.search(text):
            for kind, pattern, _, ok in _KINDS:
                for m in pattern.finditer(text):
                    if ok(m[0]):
                        take(m.start(), m.end(), kind)
        named: dict[str, str] = {}
        for m in _PERSON.finditer(text):
            gender = _TITLE_OF[m["title"]] if m["title"] else ""
            for group in "abcdef":
                word = m[group]
                if word and (word[0].isupper() or word[0].isalpha() and not word[0].islower()) and len(word) > 1 and not (group in "ef" and word in _NO_NAME):
                    told = gender if group == "a" and gender != "n" else ""
                    take(*m.span(group), "name", told)
                    named[word] = named.get(word) or told
        if named:  # later mentions without what introduced them; a word that also stands in lower case is none
            for m in re.finditer(rf"(?<![\w@])(?:{'|'.join(sorted(map(re.escape, named), key=len, reverse=True))})(?![\w@])", text):
                if len(m[0]) > 2 and taken.find(1, m.start(), m.end()) < 0 and not re.search(rf"\b{re.escape(m[0].lower())}\b", text):
                    take(m.start(), m.end(), "name", named[m[0]])
        # a given name's gender, once told, holds for the document's mentions that tell none
        return sorted((a, z, kind, gender or named.get(text[a:z], "")) for a, z, kind, gender in spans)

    def replace(self, text: str) -> tuple[str, list[tuple[str, str, str]]]:
        """The text with surrogates, and (kind, original, surrogate) in order."""
        spans = self.find(text)
        if not spans:
            return text, []
        out, at, found = [], 0, []
        for a, z, kind, gender in spans:
            new = self._of(kind, text[a:z], gender)
            out += [text[at:a], new]
            found.append((kind, text[a:z], new))
            at = z
        return "".join([*out, text[at:]]), found


@lru_cache(maxsize=4)
def _surrogates(key: bytes) -> Surrogates:
    return Surrogates(key)


KEY_SETTING = "spark.cairn.pii.key"
_DRAWN: dict[str, bytes] = {}


def session_key(spark: SparkSession) -> bytes:
    """The configured key; where there is none, one drawn at random for this application and never written."""
    configured = spark.conf.get(KEY_SETTING, None)
    if configured:
        return configured.encode()
    return _DRAWN.setdefault(spark.sparkContext.applicationId, secrets.token_bytes(32))


def _digest(kind: str, entity: str) -> bytes:
    """Of the entity's one canonical spelling."""
    if kind == "email":
        entity = entity.lower()
    elif kind == "ipv6":
        entity = str(ipaddress.IPv6Address(entity))
    elif kind == "ipv4":
        entity = str(_address(entity))
    elif kind == "phone":
        entity = " ".join(_dialled(entity))
    elif kind in ("card", "iban"):
        entity = re.sub(r"[ \-]", "", entity)
    return hashlib.md5(f"{kind}:{entity}".encode("utf-8", "surrogatepass")).digest()


def pseudonymise(docs: DataFrame, *, key: bytes | None = None, text: str = "text", length: str | None = None, digests: str | None = None) -> DataFrame:
    """The documents with ``text`` replaced; ``length`` names a column to hold the new text's length.

    ``digests`` names a further column: (kind, md5 of original, md5 of surrogate) of each entity found.
    """
    key = key or session_key(docs.sparkSession)
    common.prepare(docs.sparkSession)
    names, at = docs.columns, docs.columns.index(text)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    if digests:
        schema += f", `{digests}` array<struct<kind:string,original:binary,surrogate:binary>>"
    kind_type = pa.list_(pa.struct([("kind", pa.string()), ("original", pa.binary()), ("surrogate", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _surrogates(key)
        for batch in common.sliced(batches, at):
            done = [(None, []) if t is None else made.replace(t) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array([t for t, _ in done], batch.schema.field(at).type)
            if length is not None:
                i = names.index(length)
                columns[i] = pa.array([None if t is None else len(t) for t, _ in done], batch.schema.field(i).type)
            if digests:
                columns.append(pa.array([[{"kind": k, "original": _digest(k, a), "surrogate": _digest(k, b)} for k, a, b in found] for _, found in done], kind_type))
            yield pa.RecordBatch.from_arrays(columns, [*names, digests] if digests else names)

    return docs.mapInArrow(run, schema)


def collisions(found: DataFrame, column: str = "entities") -> DataFrame:
    """(kind, surrogate, originals): surrogates of more than one original; distinct pairs are counted after a map-side reduction."""
    pairs = found.select(F.explode(column).alias("e")).groupBy("e.kind", "e.surrogate", "e.original").agg(F.count("*").alias("n"))
    return pairs.groupBy("kind", "surrogate").agg(F.count("*").alias("originals")).filter("originals > 1")


def splits(found: DataFrame, column: str = "entities") -> DataFrame:
    """(kind, original, surrogates): originals with more than one surrogate over the corpus, so mentions that no longer name one entity.

    By design a name has one for each gender that its titles give it.
    """
    pairs = found.select(F.explode(column).alias("e")).groupBy("e.kind", "e.original", "e.surrogate").agg(F.count("*").alias("n"))
    return pairs.groupBy("kind", "original").agg(F.count("*").alias("surrogates")).filter("surrogates > 1")


def checked(spark: SparkSession, docs: DataFrame, *, key: bytes | None = None, text: str = "text", length: str | None = None) -> tuple[DataFrame, str]:
    """The pseudonymised documents, written and checked for collisions over the whole corpus, and the name of their column of digests."""
    column = "entities"
    while column in docs.columns:
        column = f"_{column}"
    made = common.written(spark, pseudonymise(docs, key=key, text=text, length=length, digests=column), "surrogates")
    if (bad := collisions(made, column).count()) > 0:
        raise RuntimeError(f"{bad} surrogates stand for more than one entity")
    return made, column


def surrogates(spark: SparkSession, docs: DataFrame, *, key: bytes | None = None, doc_key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, n_entities, kinds) for every document, after the corpus-wide collision check."""
    made, column = checked(spark, docs.select(F.col(doc_key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")), key=key)
    return made.select("doc_id", "text", F.size(column).cast("long").alias("n_entities"), F.array_join(F.sort_array(F.array_distinct(f"{column}.kind")), ",").alias("kinds"))


def without_personal_data(spark: SparkSession, docs: DataFrame, *, key: bytes | None = None, text: str = "text", length: str | None = None) -> DataFrame:
    """The documents in their own columns, with surrogates, after the corpus-wide collision check."""
    made, column = checked(spark, docs, key=key, text=text, length=length)
    return made.drop(column)
