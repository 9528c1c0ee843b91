"""Surrogates for personal data and secrets.

Every entity found in a text is replaced by another of its kind: the same entity always by the same surrogate (whatever its
case or separators), different ones by different ones. That holds over the whole corpus without comparing rows, because
each surrogate is the image of a keyed permutation of all strings of its format: a Feistel network over the letters and
digits, each of which stays in its class (digit, hexadecimal, vowel or consonant, else a letter of its script). What tells
the type stays: country codes, valid check digits, public suffixes. Listed given names are permuted, without a fixed point,
among those of the same gender and script; an unlisted name never becomes a listed one, and keeps a vowel at its end, which
in many languages tells the gender. The check for collisions compares what was found in all rows."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

KEY = b"variantloom surrogate key"
#: Given names by gender and script.
NAMES = {
    ("f", "latin"): "anna maria laura julia sofia emma clara marie elena alice sarah lucia carmen petra ingrid helga".split(),
    ("m", "latin"): "john peter thomas carlos hans pierre david michael jose miguel klaus jean robert daniel stefan luis".split(),
    ("f", "cyrillic"): "анна мария ольга елена наталья татьяна светлана ирина".split(),
    ("m", "cyrillic"): "иван петр сергей дмитрий андрей алексей николай михаил".split(),
}
#: Forms of address.
TITLES = "mr mrs ms miss mx dr prof sir madam herr frau señor señora señorita sr sra don doña monsieur madame mademoiselle mme mlle signor signora г-н г-жа господин госпожа".split()
#: Words before a name.
CUES = ["my name is", "name:", "dear", "signed,", "mi nombre es", "me llamo", "ich heiße", "mein name ist", "je m'appelle", "меня зовут", "我叫", "我的名字是"]
#: Country codes of one and of two digits (any other has three), and second labels of public suffixes.
CODES = {"1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "53", "54", "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98"}
SECOND = {"co", "com", "org", "net", "ac", "gov", "edu", "gob"}
#: Domains reserved for examples, which name nobody.
RESERVED = {"example.com", "example.org", "example.net"}
#: Classes of characters; a character never leaves its class.
CLASSES = ["0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "àáâäåèéêëìíîïòóôöùúûü", "çñßš", "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщъь"]
HEX = ["0123456789abcdef"]
_CLASS = {c: k for k, group in enumerate(CLASSES) for c in group}
PATTERNS = [
    ("secret", re.compile(r"(?i)\b(?:token|secret|password|passwd|api[_-]?key)\s*[=:]\s*[\"']?(?P<x>[A-Za-z0-9_\-./+]{8,})")),
    ("secret", re.compile(r"(?<![A-Za-z0-9])(?P<x>(?=[0-9A-Fa-f]*[0-9])(?=[0-9A-Fa-f]*[A-Fa-f])[0-9A-Fa-f]{32,}|(?:AKIA|ghp_|sk-|xox[abp]-)[A-Za-z0-9-]{12,})(?![A-Za-z0-9])")),
    ("email", re.compile(r"(?P<x>[\w.+-]+@[\w-]+(?:\.[\w-]+)+)")),
    ("iban", re.compile(r"(?<!\w)(?P<x>[A-Za-z]{2}\d{2}(?: ?[A-Za-z0-9]{4}){3,7}(?: ?[A-Za-z0-9]{1,3})?)(?!\w)")),
    ("ip", re.compile(r"(?<![\w.])(?P<x>(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d))(?![\w]|\.\d)")),
    ("phone", re.compile(r"(?<![\w.+])(?P<x>(?:\+?\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}|\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}|\d{3}[.-]\d{3}[.-]\d{4})(?!\d)")),
    ("ssn", re.compile(r"(?<![\w-])(?P<x>\d{3}-\d{2}-\d{4})(?![\w-])")),
    ("card", re.compile(r"(?<![\w.-])(?P<x>\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{1,7}|\d{4}[ -]?\d{6}[ -]?\d{5})(?!\w)")),
]
_ONE = r"(?:\p{Lu}[\p{L}\p{M}'’-]+|[\p{Lo}\p{M}]{2,4}(?!\p{Lo}))"
_GIVEN = "|".join(sorted((n.capitalize() for names in NAMES.values() for n in names), key=len, reverse=True))
#: A name follows a form of address or a cue, or is a listed given name with another capitalised word.
NAME = regex.compile(rf"(?:\b(?i:{'|'.join(map(re.escape, TITLES))})\b\.? |(?<!\w)(?i:{'|'.join(map(re.escape, CUES))})(?: |(?<=[:,\p{{Lo}}])))(?P<x>{_ONE}(?: \p{{Lu}}[\p{{L}}\p{{M}}'’-]+){{0,2}})|(?<![\w'’-])(?P<x>(?:{_GIVEN}) \p{{Lu}}\p{{Ll}}[\p{{L}}\p{{M}}'’-]*)")


#: Words without one of which a text holds no name that NAME would find.
_HINTS = {w for phrase in (*TITLES, *CUES, *(n for names in NAMES.values() for n in names)) for w in re.split(r"\W+", phrase)[:1]}
_CJK = {c[0] for c in CUES if unicodedata.category(c[0]) == "Lo"}


def _may_name(text: str) -> bool:
    return not _HINTS.isdisjoint(re.split(r"\W+", text.lower())) or any(c in text for c in _CJK)


@lru_cache(1)
def _scripts() -> dict[str, tuple[str, int]]:
    """Letters beyond CLASSES, by the rule of Unicode's names: each with the other letters of its script, and its place there. Letters with a case stand for themselves in lower case."""
    groups: dict[str, list[str]] = {}
    for code in range(0xAA, 0xD7A4):
        c = chr(code)
        if c.isalpha() and c not in _CLASS and c == c.lower() and len(c.upper()) == 1 and c.upper().lower() == c:
            groups.setdefault(unicodedata.name(c, "?").split(" ")[0] + (" cased" if c != c.upper() else ""), []).append(c)
    return {c: ("".join(group), i) for group in groups.values() for i, c in enumerate(group)}


def permute(values: tuple[int, ...], radices: tuple[int, ...], key: bytes, tweak: bytes, rounds: int = 8) -> list[int]:
    """A keyed permutation of all sequences with these radices: an unbalanced Feistel network, one-to-one by construction."""
    cut = (len(values) + 1) // 2
    sides, sizes = [], []
    for part, radix in ((values[:cut], radices[:cut]), (values[cut:], radices[cut:])):
        number, size = 0, 1
        for v, r in zip(part, radix):
            number, size = number * r + v, size * r
        sides.append(number)
        sizes.append(size)
    for k in range(rounds):
        a = k & 1
        digest = hashlib.blake2b(b"%d|%d|" % (k, sides[1 - a]) + tweak, key=key[:64], digest_size=64).digest()
        sides[a] = (sides[a] + int.from_bytes(digest, "big")) % sizes[a]
    out = []
    for number, radix in zip(sides, (radices[:cut], radices[cut:])):
        part = []
        for r in reversed(radix):
            number, v = divmod(number, r)
            part.append(v)
        out += reversed(part)
    return out


def _mapped(text: str, key: bytes, kind: str, classes: list[str] | None = None) -> str:
    """Lower-case text with every character of a class permuted; the rest, and so the format, stays."""
    where, groups = ({c: k for k, g in enumerate(classes) for c in g}, classes) if classes else (_CLASS, CLASSES)
    own = []  # (position, its class, place in it)
    for i, c in enumerate(text):
        if c in where:
            own.append((i, groups[where[c]], groups[where[c]].index(c)))
        elif not classes and c.isalpha() and c in _scripts():
            own.append((i, *_scripts()[c]))
    if not own:
        return text
    shape = list(text)
    for i, group, _ in own:
        shape[i] = f"<{group[0]}>"
    new = permute(tuple(v for _, _, v in own), tuple(len(g) for _, g, _ in own), key, f"{kind}|{''.join(shape)}".encode())
    out = list(text)
    for (i, group, _), v in zip(own, new):
        out[i] = group[v]
    return "".join(out)


def _recase(like: str, text: str) -> str:
    """The case of each letter; all upper where all of them are."""
    upper = [like.isupper() or o.isupper() for o in like]
    return "".join(c.upper() if u and len(c.upper()) == 1 else c for u, c in zip(upper, text))


def _digits(value: str, key: bytes, kind: str, keep: int = 0) -> str:
    """All digits but the first `keep` permuted as one number, whatever stands between them."""
    digits = re.sub(r"\D", "", value)
    new = iter(digits[:keep] + _mapped(digits[keep:], key, kind))
    return re.sub(r"\d", lambda _: next(new), value)


def _luhn(digits: str) -> int:
    """The check digit that belongs after these."""
    total = sum(d if k % 2 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(map(int, reversed(digits))))
    return -total % 10


def _card(value: str, key: bytes) -> str:
    """A number with a valid check digit gets one again, any other gets none: both sets map to themselves."""
    digits = re.sub(r"\D", "", value)
    off = (int(digits[-1]) - _luhn(digits[:-1])) % 10
    body = _mapped(digits[:-1], key, "card")
    new = iter(body + str((_luhn(body) + off) % 10))
    return re.sub(r"\d", lambda _: next(new), value)


def _ip(value: str, key: bytes) -> str:
    return ".".join(map(str, permute(tuple(map(int, value.split("."))), (256,) * 4, key, b"ip")))


def _iban_check(country: str, rest: str) -> int:
    """The check digits that belong to these letters and digits."""
    return 98 - int("".join(str(int(c, 36)) for c in rest + country)) * 100 % 97


def _iban(value: str, key: bytes) -> str:
    """The country stays; valid check digits become valid ones, and others others. Spaces and case are the entity's own."""
    flat = re.sub(r"\W", "", value).lower()
    country, check, rest = flat[:2], int(flat[2:4]), flat[4:]
    new = _mapped(rest, key, "iban" + country)
    at = iter(f"{country}{(_iban_check(country, new) + check - _iban_check(country, rest)) % 100:02d}{new}")
    return _recase(value, re.sub(r"\w", lambda _: next(at), value))


def country_digits(value: str) -> int:
    """How many of a phone number's digits are its country code."""
    digits = re.sub(r"\D", "", value)
    if value.lstrip().startswith("+"):
        return next((n for n in (1, 2) if digits[:n] in CODES), 3)
    return max(0, len(digits) - 10)


def _email(value: str, key: bytes) -> str:
    """Every label of the domain but its public suffix is replaced, the same domain always alike."""
    local, _, domain = value.lower().partition("@")
    labels = domain.split(".")
    keep = 2 if len(labels) > 2 and len(labels[-1]) == 2 and labels[-2] in SECOND or ".".join(labels[-2:]) in RESERVED else 1
    hosts = [_mapped(x, key, "host") for x in labels[:-keep]]
    return _recase(value, f"{_mapped(local, key, 'local')}@{'.'.join(hosts + labels[-keep:])}")


@lru_cache(64)
def _orders(key: bytes) -> dict[str, str]:
    """The next listed name in a keyed order of those alike in gender and script."""
    out = {}
    for names in NAMES.values():
        order = sorted(names, key=lambda n: hashlib.blake2b(n.encode(), key=key[:64]).digest())
        out |= dict(zip(order, order[1:] + order[:1]))
    return out


def _name(word: str, key: bytes) -> str:
    listed, low = _orders(key), word.lower()
    if low in listed:
        new = listed[low]
        return new.upper() if word.isupper() and len(word) > 1 else new.capitalize() if word[:1].isupper() else new
    end = len(low) - (low[-1:] in _ENDINGS and len(low) > 2)  # a vowel at the end may tell the gender
    new = _mapped(low[:end], key, "name" + low[end:]) + low[end:]
    while new in listed:
        new = _mapped(new[:end], key, "name" + low[end:]) + low[end:]
    return _recase(word, new)


_ENDINGS = set("aeioаяоие")


@lru_cache(200_000)
def surrogate(kind: str, value: str, key: bytes = KEY) -> str:
    if kind == "ip":
        return _ip(value, key)
    if kind == "card":
        return _card(value, key)
    if kind == "ssn":
        return _digits(value, key, kind)
    if kind == "phone":  # the country code stays, and doesn't count
        return _digits(value, key, kind, country_digits(value))
    if kind == "name":
        return " ".join(_name(w, key) for w in value.split(" "))
    if kind == "email":
        return _email(value, key)
    if kind == "iban":
        return _iban(value, key)
    low = value.lower()
    return _recase(value, _mapped(low, key, kind, HEX if set(low) <= set(HEX[0]) else None))


def canonical(kind: str, value: str) -> str:
    """What makes two writings one entity: case, separators and a phone's country code don't count."""
    if kind == "phone":
        return re.sub(r"\D", "", value)[country_digits(value) :]
    if kind in ("card", "ssn", "iban"):
        return re.sub(r"\W", "", value).lower()
    return ".".join(str(int(x)) for x in value.split(".")) if kind == "ip" else value.lower()


def find(text: str) -> list[tuple[int, int, str]]:
    """Spans and kinds, in order, none over another; the kind listed first wins. A name is found after a form of address, and its parts wherever they recur in the text."""
    spans: list[tuple[int, int, str]] = []
    if _ANY.search(text):
        for kind, pattern in PATTERNS:
            if kind == "email" and "@" not in text:
                continue
            for m in pattern.finditer(text):
                a, b = m.span("x")
                if kind == "email":
                    b -= len(text[a:b]) - len(text[a:b].rstrip("."))
                if all(b <= s or a >= e for s, e, _ in spans):
                    spans.append((a, b, kind))
    parts: set[str] = set()
    for m in NAME.finditer(text) if _may_name(text) else ():
        a, b = m.span("x")
        b -= 2 * text[a:b].endswith(("'s", "’s"))
        if all(b <= s or a >= e for s, e, _ in spans):
            spans.append((a, b, "name"))
            parts.update(text[a:b].split(" "))
    if parts:
        forms = sorted({f for p in parts for f in (p, p.upper(), p.capitalize())}, key=len, reverse=True)
        for m in re.finditer(rf"(?<!\w)(?:{'|'.join(map(re.escape, forms))})(?!\w)", text):
            a, b = m.span()
            if all(b <= s or a >= e for s, e, _ in spans):
                spans.append((a, b, "name"))
    return sorted(spans)


#: Every entity but names holds a digit or an @, follows a word for a secret, or begins as keys do.
_ANY = re.compile(r"[0-9@]|(?<![A-Za-z0-9])(?:AKIA|sk-)|(?i:token|secret|passw|api[_-]?key|ghp_|xox)")


def replace(text: str, key: bytes = KEY) -> tuple[str, list[tuple[str, str, str]]]:
    """The text with surrogates, and (kind, entity, surrogate) of each place."""
    out, at, found = [], 0, []
    for a, b, kind in find(text):
        new = surrogate(kind, text[a:b], key)
        out += [text[at:a], new]
        found.append((kind, text[a:b], new))
        at = b
    return "".join([*out, text[at:]]), found


def _number(kind: str, value: str, key: bytes) -> int:
    """A keyed number of an entity, by which rows can be compared without it."""
    return int.from_bytes(hashlib.blake2b(f"{kind}|{canonical(kind, value)}".encode(), key=key[:64], digest_size=8).digest(), "big", signed=True)


ENTITY = "array<struct<kind:string,entity:long,surrogate:string,number:long>>"


def surrogates(docs: DataFrame, key: bytes = KEY, check: bool = True) -> DataFrame:
    """Every row of (doc_id, text): doc_id, text with surrogates, n_entities, entities (kind; entity, a keyed number that is the same wherever the entity occurs; surrogate; and that one's number).

    key: who knows it can find surrogates of guessed entities; give one of your own. check: the rows are written and
    compared, and a collision raises. A null text stays null and has no entity, an empty one neither; repeated rows and
    null ids are treated each; a very long text is treated whole; other columns are not read; an empty table gives no rows.
    Row by row, but for the check."""
    def run(batches):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("entity", pa.int64()), ("surrogate", pa.string()), ("number", pa.int64())]))
        for b in C.slices(batches):
            done = [(None, []) if t is None else replace(t, key) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array([t for t, _ in done], pa.string()), pa.array([len(e) for _, e in done], pa.int64()),
                pa.array([[{"kind": k, "entity": _number(k, e, key), "surrogate": s, "number": _number(k, s, key)} for k, e, s in found] for _, found in done], kind)], ["doc_id", "text", "n_entities", "entities"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, text string, n_entities long, entities {ENTITY}")
    if not check:
        return out
    out = C.stash(out, "surrogates")
    found = compare(out).groupBy("fault").count().collect()  # two numbers
    if found:
        raise RuntimeError(f"surrogates collide: {dict(map(tuple, found))}")
    return out


def compare(rows: DataFrame) -> DataFrame:
    """The collision check over rows of `surrogates`: (fault, kind, number) of surrogates that stand for several entities (`distinctness`), and of entities that have several surrogates (`coreference`). Each pair is counted once in its task before it is sent."""
    pairs = rows.select(F.explode("entities").alias("e")).select("e.kind", "e.entity", "e.number").distinct()
    shared = pairs.groupBy("kind", "number").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("distinctness").alias("fault"), "kind", "number")
    return shared.unionByName(pairs.groupBy("kind", F.col("entity").alias("number")).agg(F.count("*").alias("n")).where("n > 1").select(F.lit("coreference").alias("fault"), "kind", "number"))


def collisions(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """The collision check of a table of texts. It has no rows."""
    return compare(surrogates(docs, key, check=False))
