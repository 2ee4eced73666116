"""PII replaced by keyed surrogates of the same type, gender, script and format (operator 2).

1. Entities are detected in the texts that a cheap JVM pattern lets through; other texts stay as they are.
2. Every distinct entity (kind and canonical form, over all documents) gets a keyed surrogate. A surrogate that
   another entity has got too, or that is itself an entity of the data, is drawn again with the next attempt number, for all
   but the smallest of the entities that share it, until no collision is left. So different entities
   stay different, and one entity has one surrogate in all documents. Where a format of telephone numbers is too full for that, a
   keyed permutation of the whole format takes the place of the draws: still one to one and never the same number, but a
   surrogate can then be a number of the data.
3. The surrogates are joined back per text and written in the format of each mention: same separators, same case.

Kinds: email, phone (8 to 15 digits behind + or with a bracket; 10 to 15 in groups, which are longer than 4 only behind
a 0 or as 5 and 5; 10 digits at a stretch, 11 behind a 1, 10 to 12 from a 0;
ddd-dddd) or social security number, card (13 to 19 digits; the check digit stays right if it was), IBAN, IPv4, access key, secret (long
hexadecimal tokens, and what is not letters only behind a name such as token or password, from 6 characters on to the next white space or
the closing quote; behind key from 12), and names. A name is found behind a title (given and family names apart; most titles
tell the gender), behind a label such as "name:" or words such as "my name is", and wherever a word of a name found so occurs again in the
text, capitalised. Surrogates have letters of the name's own script, by Unicode.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from functools import lru_cache, reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histora.llm.common import Scratch, free_name, saved, ship

# Titles before names, by gender
TITLES = {
    "m": ("Mr", "Herr", "Señor", "Sr", "Monsieur", "M", "Don", "Господин"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Señorita", "Sra", "Madame", "Mme", "Mademoiselle", "Doña", "Госпожа"),
    "n": ("Dr", "Prof", "Professor", "Doktor", "Docteur", "Доктор"),
}
# What comes before a name without a title
LABELS = ("name", "full name", "contact", "signed", "nombre", "nom", "имя")
PHRASES = ("my name is", "mein Name ist", "ich heiße", "je m'appelle", "me llamo", "mi nombre es", "меня зовут")



def _any_case(text: str) -> str:
    """A pattern for the text in any mixture of cases, the same in Python and Java."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() and len(c.upper()) == 1 and c.lower() != c.upper() else re.escape(c) for c in text)


#: The phrases inside and at the start of a sentence
SPOKEN = [x for p in PHRASES for x in dict.fromkeys((p, p[0].upper() + p[1:]))]
_PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "sk-", "pk-", "xoxb-", "xoxp-")
_ALL_TITLES = [t for group in TITLES.values() for t in group]
#: What Python's \s matches, and what its case-insensitive k and s match, in Java's syntax
_SPACE = r"[\s\x1c-\x1f\x85\p{Z}]*"
_K, _S = "[kK\u212a]", "[sS\u017f]"
_NAMED = f"(?:[tT][oO]{_K}[eE][nN]|{_S}[eE][cC][rR][eE][tT]|[pP][aA]{_S}{_S}(?:[wW][oO][rR])?[wW]?[dD]|[pP][wW][dD]|{_K}[eE][yY])"
#: What a text must contain to be looked at: a digit or an @, a named secret, or the start of a key or a name. A superset of all patterns
#: below, in Java's syntax; the look-ahead lets the alternatives be tried at few places only. Digits of any script count, also
#: those that Java does not know yet (Cn).
MAY_HOLD = (
    r"[0-9@\p{Nd}\p{Cn}]|:(?<=(?:"
    + "|".join(map(_any_case, LABELS))
    + "):)|(?=["
    + "".join(sorted({x[0] for x in (*_PREFIXES, *_ALL_TITLES)} | set("tTsS\u017fpPkK\u212a")))
    + "])(?:"
    + _NAMED + r"[\"']?" + _SPACE + "[:=]|"
    + "|".join(_PREFIXES)
    + "|(?:"
    + "|".join(_ALL_TITLES)
    + r")\.? [^\x00-@\[-\x7fа-яß-ÿ])"
)

_NAME = r"[^\W\d_a-zа-яß-ÿ][^\W\d_]+(?:[-'][^\W\d_]+)*"
PATTERN = re.compile(
    r"(?P<email>(?<![\w.+-])[\w.+-]+@[\w-]+(?:\.[\w-]+)*\.[A-Za-z]{2,24}(?![\w-]))"
    r"|(?P<secret>(?i:\b(?:(?P<weak>key)|token|secret|password|passwd|pwd|api[_-]?key)\b[\"']?\s*[:=]\s*)"
    r"(?:\"(?P<double>[^\"\n]{6,200})\"|'(?P<single>[^'\n]{6,200})'|[\"']?(?P<bare>[^\s\"'<>]{6,200})))"
    r"|(?P<hex>(?<![\w-])(?=[0-9a-fA-F]*[0-9])(?=[0-9a-fA-F]*[a-fA-F])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![\w-]))"
    r"|(?P<access>(?<!\w)(?:AKIA|ASIA|ghp_|gho_|sk-|pk-|xoxb-|xoxp-)[A-Za-z0-9]{16,}(?!\w))"
    r"|(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z\d]{4}){2,7}(?: ?[A-Z\d]{1,4})?(?!\w))"
    r"|(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\w))"
    r"|(?P<card>(?<![\w.+-])(?:\d{13,19}|\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-]|\.\d))"
    r"|(?P<phone>(?<![\w.])(?:"
    r"\+\d{1,15}+(?:[ .-]?\(\d{1,5}\)[ .-]?\d{1,14}+)?(?:[ .-]\d{1,14}+){0,5}"
    r"|(?:\+?\(\+?\d{1,5}\)[ .-]?)\d{2,14}+(?:[ .-]\d{1,14}+){0,4}"
    r"|0\d{1,5}+(?:[ .-]\d{2,8}+){1,4}|[6-9]\d{4}[ -]\d{5}|\d{2,4}(?:[ .-]\d{2,4}){1,4}"
    r"|(?<!\d,)(?<![/#%&$-])(?:0\d{9,11}|1[2-9]\d{9}|[2-9]\d{9})(?![-/%])"
    r")(?!\w|[.,]\d))"
    r"|(?:\b(?:(?P<title>" + "|".join(t for group in TITLES.values() for t in group) + r")\b\.?(?: (?:" + "|".join(TITLES["n"]) + r")\b\.?)? "
    r"|\b(?:(?P<label>" + "|".join(map(_any_case, LABELS)) + "):|" + "|".join(map(re.escape, SPOKEN)) + r") )(?P<first>" + _NAME + r")(?: (?P<last>" + _NAME + r"))?)"
)

#: Country codes of telephone numbers, for numbers that don't set theirs apart
_COUNTRY = re.compile(r"\+(?:\d{1,3}(?=\D)|[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})")
#: Without + or bracket fewer than ten digits are a number only if written so: a social security number or a local number
_SHORT = re.compile(r"\d{3}-\d{2}-\d{4}|\d{3}-\d{4}")

#: So often a surrogate is drawn again before the permutation of its format takes over. Names and emails grow with the attempts, so
#: only numbers that nearly fill their format come to it.
MOST_ATTEMPTS = 60

# Syllables of made-up names, by script; endings by gender
SYLLABLES = {
    "latin": "ba be bi bo da de di do fa fe ga ge ka ke ki la le li lo lu ma me mi mo na ne ni no ra re ri ro sa se ta te ti to va ve vi".split(),
    "cyrillic": "ба бе ви во га да де ди жа за зи ка ки ко ла ле ли ло ма ме ми мо на не ни но ра ре ри ро са се та те ти то ва ве".split(),
    "greek": "βα γε δι δο ζα θε κα κι λα λε λι λο μα με μι μο να νε νι νο πα πε ρα ρε ρι ρο σα σε τα τε τι το φα φι".split(),
}
ENDINGS = {
    "latin": {"m": ["n", "s", "r"], "f": ["na", "ra", "la"], "n": ["m", "l", "x"], "last": ["rt", "nd", "ck", "lt"]},
    "cyrillic": {"m": ["н", "р", "й"], "f": ["на", "ра", "ла"], "n": ["м", "л", "х"], "last": ["нов", "рин", "ков"]},
    "greek": {"m": ["ς", "ος", "ης"], "f": ["να", "ρα", "λη"], "n": ["ι", "ω"], "last": ["ίδης", "άκης"]},
}


def may_hold(text: Column) -> Column:
    """Whether a text has to be looked at. Phrases are searched for as they are: as alternatives of the pattern, which start with
    frequent letters, they would make it three times as slow."""
    return reduce(or_, [text.contains(p) for p in SPOKEN], text.rlike(MAY_HOLD))


def is_digit(c: str) -> bool:
    return "0" <= c <= "9" or c.isdecimal()


def plain(text: str) -> str:
    """The text with the digits of any script as 0 to 9."""
    return text if text.isascii() else "".join(str(int(c)) if is_digit(c) else c for c in text)


class Stream:
    """Numbers drawn from a key and a context, the same ones every time."""

    def __init__(self, key: bytes, *context: str):
        self.key, self.context, self.count, self.left = key, "\x1f".join(context).encode(), 0, 0
        self.bits = 0

    def below(self, n: int) -> int:
        if self.left < 32:
            block = hmac.new(self.key, self.context + self.count.to_bytes(4, "big"), hashlib.blake2b).digest()
            self.bits, self.left, self.count = int.from_bytes(block, "big"), 512, self.count + 1
        value = self.bits & 0xFFFFFFFF
        self.bits >>= 32
        self.left -= 32
        return value % n

    def like(self, c: str) -> str:
        """A character of the same class; others stay."""
        if is_digit(c):
            return str(self.below(10))
        if "a" <= c <= "z":
            return chr(97 + self.below(26))
        if "A" <= c <= "Z":
            return chr(65 + self.below(26))
        return c


def script(name: str) -> str:
    """The script of a name's first letter, as Unicode names it."""
    letter = next((c for c in name if c.isalpha()), "a")
    return unicodedata.name(letter, "LATIN").split()[0].split("-")[0].lower()


@lru_cache(maxsize=1024)
def alphabet(letter: str) -> str:
    """Letters to draw from in the place of one of another script: for Han all of the main block, else those of the
    same script and kind among its 256 neighbours."""
    own, kind, at = script(letter), unicodedata.category(letter), ord(letter)
    places = range(0x4E00, 0xA000) if own == "cjk" else range(at & ~0xFF, (at & ~0xFF) + 0x100)
    return "".join(c for c in map(chr, places) if unicodedata.category(c) == kind and script(c) == own) or letter


def luhn(digits: str) -> int:
    """The sum whose remainder by 10 is 0 if the check digit is right."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total


def surrogate(kind: str, entity: str, attempt: int, key: bytes) -> str:
    """The canonical surrogate of a canonical entity."""
    s = Stream(key, kind, entity, str(attempt))
    if kind == "email":
        name, _, domain = entity.partition("@")
        *labels, top = domain.split(".")
        draw = lambda t: "".join(s.like(c) if c.isascii() else chr(97 + s.below(26)) for c in t)
        longer = "".join(chr(97 + s.below(26)) for _ in range(attempt // 8))
        return f"{draw(name)}{longer}@{'.'.join(map(draw, labels))}.{top}"
    if kind == "ip":
        a, b, *_ = map(int, entity.split("."))
        keep = [a] if a in (10, 127) else [a, b] if (a, b) == (192, 168) or a == 172 and 16 <= b < 32 else []
        keep = keep if attempt < 16 else []
        drawn = [str(1 + s.below(223)) if i == 0 else str(1 + s.below(254)) for i in range(4 - len(keep))]
        return ".".join([*map(str, keep), *drawn])
    if kind == "card":
        digits = entity[0] + "".join(str(s.below(10)) for _ in entity[1:])
        if luhn(entity) % 10 == 0:
            digits = next(x for d in "0123456789" if luhn(x := digits[:-1] + d) % 10 == 0)
        return digits
    if kind == "phone":  # a + and the country code before | stay, and zeros in front
        code, _, rest = entity.rpartition("|")
        own = rest.lstrip("0")
        drawn = [str(1 + s.below(9)) if i == 0 else str(s.below(10)) for i in range(len(own))]
        return f"{code}|{rest[: len(rest) - len(own)]}{''.join(drawn)}"
    if kind == "iban":  # the country stays
        return entity[:2] + "".join(map(s.like, entity[2:]))
    if kind in ("m", "f", "n", "last"):
        way = script(entity)
        if way not in SYLLABLES:
            letters = [alphabet(c) if c.isalpha() else c for c in entity] + [alphabet(entity[0])] * (attempt // 8)
            return "".join(x[s.below(len(x))] for x in letters)
        parts = [SYLLABLES[way][s.below(len(SYLLABLES[way]))] for _ in range(2 + attempt // 8)]
        ending = ENDINGS[way][kind]
        return "".join(parts) + ending[s.below(len(ending))]
    if kind == "access":  # what tells its kind stays
        known = next(p for p in _PREFIXES if entity.startswith(p))
        return known + "".join(map(s.like, entity[len(known) :]))
    letters = "0123456789abcdef"
    if re.fullmatch(r"[0-9a-f]+", entity):
        return "".join(letters[s.below(16)] for _ in entity)
    if re.fullmatch(r"[0-9A-F]+", entity):
        return "".join(letters[s.below(16)].upper() for _ in entity)
    return "".join(map(s.like, entity))


def phone_form(entity: str) -> str:
    """What stays of a telephone number: the code, zeros in front and the number of digits behind them."""
    code, _, rest = entity.rpartition("|")
    own = rest.lstrip("0")
    return f"{code}|{rest[: len(rest) - len(own)]}|{len(own)}"


def permuted(entity: str, key: bytes) -> str:
    """The surrogate of a telephone number by a keyed permutation of its format, without fixed points: the next number in an order
    that the key decides. A Feistel network over the halves of the number, walked on until it is of the format again."""
    code, zeros, size = phone_form(entity).rsplit("|", 2)
    digits = int(size)
    if not digits:
        return entity
    low, span = 10 ** (digits - 1), 9 * 10 ** (digits - 1)
    half = max(1, (span.bit_length() + 1) // 2)
    mask = (1 << half) - 1

    def mixed(r: int, i: int) -> int:
        block = hmac.new(key, f"{code}|{zeros}|{size}|{i}|{r}".encode(), hashlib.blake2b).digest()
        return int.from_bytes(block[:8], "big") & mask

    def forth(x: int) -> int:
        while True:
            left, right = x >> half, x & mask
            for i in range(6):
                left, right = right, left ^ mixed(right, i)
            x = left << half | right
            if x < span:
                return x

    def back(x: int) -> int:
        while True:
            left, right = x >> half, x & mask
            for i in reversed(range(6)):
                left, right = right ^ mixed(left, i), left
            x = left << half | right
            if x < span:
                return x

    value = int(entity.rpartition("|")[2][len(zeros) :]) - low
    return f"{code}|{zeros}{back((forth(value) + 1) % span) + low}"


def mentions(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical entity) of every entity of the text, in order."""
    found, names = [], {}
    for m in PATTERN.finditer(text):
        if m["email"]:
            found.append((m.start(), m.end(), "email", m[0].lower()))
        elif m["secret"]:
            group = "double" if m["double"] else "single" if m["single"] else "bare"
            value = m[group] if group != "bare" else m[group].rstrip(".,;:)]}")
            if len(value) >= (12 if m["weak"] else 6) and not "".join(value.split()).isalpha() and value.strip():
                found.append((m.start(group), m.start(group) + len(value), "secret", value))
        elif m["hex"]:
            found.append((m.start(), m.end(), "secret", m[0]))
        elif m["access"]:
            found.append((m.start(), m.end(), "access", m[0]))
        elif m["iban"]:
            if sum(is_digit(c) for c in m[0]) >= 8:
                found.append((m.start(), m.end(), "iban", plain(m[0].replace(" ", ""))))
        elif m["ip"]:
            found.append((m.start(), m.end(), "ip", ".".join(str(int(x)) for x in m[0].split("."))))
        elif m["card"]:
            found.append((m.start(), m.end(), "card", plain("".join(filter(is_digit, m[0])))))
        elif m["phone"]:
            number = plain(m[0])
            digits = "".join(filter(is_digit, number))
            marked = number[0] in "+(" and len(digits) >= 8
            if len(digits) <= 15 and (marked or len(digits) >= 10 or _SHORT.fullmatch(number)):
                code = _COUNTRY.match(number)
                code = code[0] if code else ""
                found.append((m.start(), m.end(), "phone", f"{code}|{digits[max(0, len(code) - 1):]}"))
        elif m["first"] and (m["last"] or not m["label"]):
            gender = next((g for g, titles in TITLES.items() if m["title"] in titles), "n")
            first = gender if m["last"] else "last" if m["title"] else "n"
            for group, kind in (("first", first), ("last", "last")):
                if m[group]:
                    found.append((m.start(group), m.end(group), kind, m[group].lower()))
                    # one word is one name within a text; a title with a gender tells most
                    rank = ("m", "f", "last", "n").index(kind)
                    names[m[group].lower()] = min(names.get(m[group].lower(), (9, "")), (rank, kind))
    return _again(text, found, names) if names else found


def _again(text: str, found: list, names: dict) -> list[tuple[int, int, str, str]]:
    """The mentions, and every other place where a word of a name found stands again, capitalised."""
    known = sorted({x for n in names for x in (n.capitalize(), n.title(), n.upper()) if x.lower() == n} | {text[a:b] for a, b, k, _ in found if k in "m f n last".split()})
    places = re.compile(r"(?<![\w])(?:" + "|".join(map(re.escape, sorted(known, key=len, reverse=True))) + r")(?![\w])")
    taken = [(a, b) for a, b, *_ in found]
    out = [(a, b, names[e][1], e) if k in ("m", "f", "n", "last") else (a, b, k, e) for a, b, k, e in found]
    i = 0
    for m in places.finditer(text):
        while i < len(taken) and taken[i][1] <= m.start():
            i += 1
        if (i == len(taken) or taken[i][0] >= m.end()) and m[0].lower() in names:
            out.append((m.start(), m.end(), names[m[0].lower()][1], m[0].lower()))
    return sorted(out)


def written(kind: str, mention: str, new: str) -> str:
    """A canonical surrogate in the format of the mention."""
    if kind in ("card", "phone", "iban", "ip") and not mention.isascii():  # the mention's own digits
        zero = next(ord(c) - int(c) for c in mention if is_digit(c) and not c.isascii())
        return written(kind, plain(mention), new).translate({48 + d: zero + d for d in range(10)})
    if kind in ("card", "phone"):
        keep, rest = "", mention
        if kind == "phone":
            code, _, new = new.rpartition("|")
            keep, rest = code, mention[len(code) :]
        digits = iter(new)
        return keep + "".join(next(digits) if is_digit(c) else c for c in rest)
    if kind == "iban":
        signs = iter(new)
        return "".join(c if c == " " else next(signs) for c in mention)
    if kind in ("m", "f", "n", "last", "email"):
        if mention.isupper():
            return new.upper()
        if mention[:1].isupper():
            return new[:1].upper() + new[1:]
    return new


def replaced(text: str, new: dict[tuple[str, str], str]) -> tuple[str, int]:
    out, at, n = [], 0, 0
    for start, end, kind, entity in mentions(text):
        out += [text[at:start], written(kind, text[start:end], new[kind, entity])]
        at, n = end, n + 1
    return "".join([*out, text[at:]]), n


def mapping(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, entity, new) for distinct (kind, entity): no two entities of a kind share `new`, and none is an entity."""
    def draw(kind: pd.Series, entity: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(k, e, a, key) for k, e, a in zip(kind, entity, attempt, strict=True)], dtype="object")

    drawn = F.pandas_udf(draw, "string")
    new = F.col("new")
    rows = entities.withColumn("attempt", F.lit(0)).withColumn("new", drawn("kind", "entity", "attempt"))
    while True:
        rows = saved(rows.select("kind", "entity", "attempt", "new"), "surrogates")
        first = rows.groupBy("kind", "new").agg(F.min("entity").alias("owner"))
        real = entities.select(F.col("kind").alias("k"), F.col("entity").alias("e"), F.lit(True).alias("real"))
        held = rows.join(first, ["kind", "new"]).join(real, (F.col("kind") == F.col("k")) & (new == F.col("e")), "left")
        clash = (F.col("owner") != F.col("entity")) | F.coalesce("real", F.lit(False))
        held = saved(held.select("kind", "entity", "attempt", "new", clash.alias("clash")), "surrogates")
        if held.where("clash").isEmpty():
            return held.select("kind", "entity", "new")
        if held.agg(F.max("attempt")).first()[0] >= MOST_ATTEMPTS:
            return _full_formats(held, key)
        rows = held.withColumn("attempt", F.col("attempt") + F.col("clash").cast("int"))
        rows = rows.withColumn("new", F.when(F.col("clash"), drawn("kind", "entity", "attempt")).otherwise(new))


def _full_formats(held: DataFrame, key: bytes) -> DataFrame:
    """Every number of a format that is too full gets its surrogate from the permutation; what else collided is told apart by its hash."""
    def forms(entity: pd.Series) -> pd.Series:
        return pd.Series([phone_form(e) for e in entity], dtype="object")

    def swapped(entity: pd.Series) -> pd.Series:
        return pd.Series([permuted(e, key) for e in entity], dtype="object")

    form, swap = F.pandas_udf(forms, "string"), F.pandas_udf(swapped, "string")
    phones = held.where("kind = 'phone'").withColumn("form", form("entity"))
    full = phones.where("clash").select("form").distinct().withColumn("full", F.lit(True))
    phones = phones.join(full, "form", "left")
    phones = phones.select("kind", "entity", F.when(F.col("full"), swap("entity")).otherwise(F.col("new")).alias("new"))
    others = held.where("kind != 'phone'")
    longer = F.concat("new", F.lit("-"), F.substring(F.sha2(F.concat(F.lit(key.hex()), "kind", "entity"), 256), 1, 16))
    return phones.unionByName(others.select("kind", "entity", F.when(F.col("clash"), longer).otherwise(F.col("new")).alias("new")))


def with_surrogates(docs: DataFrame, text_col: str, key: bytes, count_col: str) -> DataFrame:
    """docs with the entities of one text column replaced, and their number in `count_col` (0 for null texts)."""
    import pyarrow as pa

    ship(docs.sparkSession)
    scratch = Scratch(docs.sparkSession)
    th, new_col, changed_col = (free_name(docs, n) for n in ("_text_hash", "_new", "_changed"))
    may = F.coalesce(may_hold(F.col(text_col)), F.lit(False))
    # kept, so that the pattern is tried on them once
    looked = scratch.save(docs.where(may).withColumn(th, F.xxhash64(F.md5(F.col(text_col).cast("binary")))), "looked")

    def detect(batches):
        for batch in batches:
            which, kinds, names = [], [], []
            for at in range(0, batch.num_rows, 500):
                for i, text in enumerate(batch.column(1).slice(at, 500).to_pylist(), at):
                    for kind, entity in dict.fromkeys((k, e) for _, _, k, e in mentions(text)):
                        which.append(i)
                        kinds.append(kind)
                        names.append(entity)
            rows = [batch.column(0).take(pa.array(which, pa.int64())), pa.array(kinds, pa.string()), pa.array(names, pa.string())]
            yield pa.RecordBatch.from_arrays(rows, names=["th", "kind", "entity"])

    found = looked.select(F.col(th).alias("th"), text_col).mapInArrow(detect, "th long, kind string, entity string")
    found = saved(found.distinct(), "mentions")
    new = mapping(found.select("kind", "entity").distinct(), key)
    # one row per text; a text has as many entities as its length allows
    by_text = found.join(new, ["kind", "entity"]).groupBy("th").agg(F.collect_list(F.struct("kind", "entity", "new")).alias(new_col))

    def write(texts: pd.Series, entries: pd.Series) -> pd.DataFrame:
        out = []
        for text, list_ in zip(texts, entries, strict=True):
            known = {(x["kind"], x["entity"]): x["new"] for x in list_} if list_ is not None else {}
            out.append(replaced(text, known) if known else (text, 0))
        return pd.DataFrame(out, columns=["text", "n"])

    changed = F.pandas_udf(write, "text string, n int")
    texts = looked.join(by_text.withColumnRenamed("th", th), th, "left")
    texts = texts.withColumn(changed_col, changed(F.col(text_col), F.col(new_col)))
    texts = texts.withColumns({text_col: F.col(f"{changed_col}.text"), count_col: F.col(f"{changed_col}.n")})
    rest = docs.where(~may).withColumn(count_col, F.lit(0))
    return texts.select(*[f"`{c}`" for c in docs.columns], count_col).union(rest)


def replace_pii(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's text with its entities replaced: id_col, text_col and n_entities.

    key: keep it secret, as whoever has it can find out which value a surrogate stands for by trying. The same key gives the same surrogates for the same set of entities. A null text stays null; texts without entities
    come back unchanged; rows with a null id and repeated rows are treated like others; other columns are not read. An
    empty table gives no rows.
    """
    return with_surrogates(docs.select(id_col, text_col), text_col, key, "n_entities")
