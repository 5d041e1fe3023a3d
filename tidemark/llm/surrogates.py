"""Surrogates for private data: every detected entity gets a keyed replacement of its own type and shape.

Detected are e-mail addresses, IPv4 addresses, payment card numbers (16 digits, or 13 to 19 with a right check digit), telephone numbers, secrets that follow a name such as
``token =``, and personal names after a title or beginning with a listed given name, with later mentions of their parts alone. An entity's canonical form is what
its mentions share (a number's digits, a name part in lower case), so mentions written differently get the same
replacement, each in its own format; given and family names are entities of their own, so ``Mr. Smith`` still goes with ``John Smith``.
A given name is one entity with and without title; its gender is settled over the corpus, by the list of names first, then by titles.

Replacements come from an HMAC of key, kind, canonical form and attempt. They keep length, separators, letter case and script, the
gender of given names, the country code of numbers, the network digit and check-digit validity of cards, the private ranges of addresses and
the top-level domain of mail; one mail domain stays one domain.

Collisions are checked over the whole corpus: if two entities of a kind get one replacement, or a replacement is itself an entity of the
corpus, the later ones try again until none clash. Where a corpus holds a whole shape, all of 192.168.x.y or every short number, nothing in it is free:
after ``WIDEN`` attempts private addresses go to public ones, and numbers, names and mail get longer with each further attempt, so it ends. All of that is joins on the table of distinct entities; a text meets only its own mentions.

Nulls and oddities: a null text stays null; a text without entities stays as it is; rows that repeat an id are treated each;
texts of any length are read in time linear in it.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import values
from tidemark.session import stored

# Titles by gender, and names by gender and script that replacements are drawn from.
TITLES = {"mr": "m", "herr": "m", "monsieur": "m", "señor": "m", "sr": "m", "mrs": "f", "ms": "f", "miss": "f", "frau": "f",
          "madame": "f", "mme": "f", "señora": "f", "sra": "f", "г-н": "m", "г-жа": "f", "dr": "", "prof": ""}
GIVEN = {
    ("m", "latin"): "Adam Bruno Carl Daniel Edgar Felix George Hugo Ivan James John Lucas Martin Noah Oscar Paul Robert Simon Thomas Victor".split(),
    ("f", "latin"): "Alice Bella Clara Diana Emma Flora Grace Helen Irene Julia Laura Maria Nina Olivia Paula Rosa Sarah Sophie Teresa Vera".split(),
    ("m", "cyrillic"): "Андрей Борис Виктор Григорий Дмитрий Егор Иван Кирилл Михаил Николай Олег Павел Роман Сергей".split(),
    ("f", "cyrillic"): "Алина Вера Галина Дарья Елена Жанна Ирина Ксения Лариса Мария Наталья Ольга Светлана Татьяна".split(),
}
FAMILY = {
    "latin": "Abbott Barnes Carter Dawson Ellis Fischer Garcia Harper Ibarra Jensen Keller Lambert Moreau Novak Olsen Parker Quinn Romero Sommer Turner".split(),
    "cyrillic": "Андреенко Белый Воронко Гончар Давыденко Ефименко Жук Зима Коваль Лысенко Мороз Назаренко".split(),
}
ALPHABETS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}

# A mail address is looked for from its @ on and back: what lies between two of them is read once for each.
_DOMAIN = re.compile(r"[^\W_](?:[\w-]*\.)+[^\W\d_]{2,}")
_LOCAL_BACKWARDS = re.compile(r"[\w.%+-]*")
_FIRST = re.compile(r"[^\W_]")
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_IP = re.compile(rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)")
_CARD = re.compile(r"(?<![\w.-])\d{4}([ -]?)\d{4}\1\d{4}\1\d{4}(?![\w-])")
# Other lengths count if the check digit is right: 13 to 19 digits unbroken or in the groups that cards are printed in.
_GROUPS = ("4 6 5", "4 6 4", "4 4 4 1", "4 4 4 2", "4 3 3 3", "4 4 5", "3 4 4 4", "4 4 4 3", "6 8", "6 9", "4 4 4 4 1", "4 4 4 4 2", "4 4 4 4 3", "6 11", "6 12", "6 13")
_LONG_CARD = re.compile(r"(?<![\w.-])(?:\d{13,19}|" + "|".join(sep.join(rf"\d{{{n}}}" for n in g.split()) for g in _GROUPS for sep in (" ", "-")) + r")(?![\w-])")
_PHONE = re.compile(r"(?<![\w.])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}[-.]\d{4}|\d{3}([-.])\d{3}\1\d{4})(?!\w)")
_SECRET = re.compile(r"(?i)\b(?:token|secret|password|api[_-]?key|access[_-]?key)\b[\"']?\s*[:=]\s*[\"']?([A-Za-z0-9+/_-]{16,})")
_TITLED = re.compile(r"\b(" + "|".join(re.escape(f) for t in TITLES for f in (t.capitalize(), t.upper())) + r")(?:\.|(?!\w))[ \xa0]+([^\W\d_]+(?:[ \xa0-][^\W\d_]+){0,2})")
_LISTED = re.compile(r"\b(" + "|".join(n for names in GIVEN.values() for n in names) + r")[ \xa0]([^\W\d_]+)")

_WORD = re.compile(r"[^\W\d_]+")
_GIVEN_NAMES = frozenset(n for names in GIVEN.values() for n in names)

#: After so many attempts that clashed, a shape counts as full and replacements become longer, or leave their range.
WIDEN = 6

Mention = tuple[int, int, str, str]


def script(text: str) -> str:
    for c in text:
        if c.isalpha():
            name = unicodedata.name(c, "LATIN").split()[0].lower()
            return name if name in ALPHABETS else "latin"
    return "latin"


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _mails(text: str) -> list[Mention]:
    """In time linear in the text, however long its unbroken runs are."""
    out: list[Mention] = []
    free, at = 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        start = _FIRST.search(text, at - _LOCAL_BACKWARDS.match(before[::-1]).end(), at)
        domain = start and _DOMAIN.match(text, at + 1)
        free = at + 1
        if domain:
            out.append((start.start(), domain.end(), "mail", text[start.start():domain.end()].lower()))
            free = domain.end()
        at = text.find("@", free)
    return out


def _names(text: str) -> list[Mention]:
    out: list[Mention] = []
    for m in _TITLED.finditer(text):
        parts = [p for p in re.finditer(r"[^\W\d_]+", m[2])]
        held = 0
        while held < len(parts) and parts[held][0][0].isupper() and parts[held][0].lower() not in TITLES:
            held += 1
        for k, p in enumerate(parts[:held]):
            # The last word is the family name, but for a given name alone after its title.
            alone = held == 1 and p[0].capitalize() in _GIVEN_NAMES
            kind = "family" if k == held - 1 and not alone else f"given_{TITLES[m[1].lower()]}"
            out.append((m.start(2) + p.start(), m.start(2) + p.end(), kind, p[0].lower()))
    for m in _LISTED.finditer(text):
        if m[2][0].isupper():
            gender = next(g for (g, _), names in GIVEN.items() if m[1] in names)
            out += [(m.start(1), m.end(1), f"given_{gender}", m[1].lower()), (m.start(2), m.end(2), "family", m[2].lower())]
    return out


def _long_card(mention: str, digits: str) -> bool:
    """One or two digits after a right number of 16 are more likely another number."""
    return len(digits) != 16 and _valid_card(digits) and not (mention[4:5] in " -" and len(digits) in (17, 18) and _valid_card(digits[:16]))


def _bare(text: str, names: list[Mention]) -> list[Mention]:
    """Later mentions, alone and capitalised, of names that the text has introduced; a name is what it was first."""
    known: dict[str, Mention] = {}
    for mention in sorted(names):
        known.setdefault(mention[3], mention)
    words = _WORD.finditer(text, min(m[1] for m in names))
    return [(w.start(), w.end(), of[2], of[3]) for w in words if w[0][0].isupper() and (of := known.get(w[0].lower())) and w.start() >= of[1]]


def detect(text: str) -> list[Mention]:
    """Mentions ``(start, end, kind, canonical form)`` in order, without overlaps; earlier kinds win."""
    found: list[Mention] = []
    if "@" in text:
        found += _mails(text)
    if "=" in text or ":" in text:
        found += [(m.start(1), m.end(1), "secret", m[1]) for m in _SECRET.finditer(text)]
    if any(d in text for d in "0123456789"):
        found += [(m.start(), m.end(), "ip", m[0]) for m in _IP.finditer(text)]
        found += [(m.start(), m.end(), "card", d) for m in _LONG_CARD.finditer(text) if _long_card(m[0], d := _digits(m[0]))]
        found += [(m.start(), m.end(), "card", _digits(m[0])) for m in _CARD.finditer(text)]
        found += [(m.start(), m.end(), "phone", ("+" if m[0][0] == "+" else "") + _digits(m[0])) for m in _PHONE.finditer(text)]
    found += _names(text)
    taken = _apart(found)
    names = [m for m in taken if m[2] == "family" or m[2].startswith("given_")]
    return _apart(taken + _bare(text, names)) if names else taken


def _apart(found: list[Mention]) -> list[Mention]:
    """Mentions in order of place, without those that overlap an earlier one of the list."""
    taken: list[Mention] = []
    for mention in found:
        k = bisect_left(taken, mention[:1])
        if (k == 0 or taken[k - 1][1] <= mention[0]) and (k == len(taken) or mention[1] <= taken[k][0]):
            taken.insert(k, mention)
    return taken


class _Stream:
    """Numbers below a bound, drawn from an HMAC of what names the entity."""

    def __init__(self, key: bytes, *parts: str):
        self.key, self.seed, self.turn, self.pool = key, "\x00".join(parts).encode(), 0, b""

    def below(self, bound: int) -> int:
        if len(self.pool) < 4:
            self.pool += hmac.new(self.key, self.seed + self.turn.to_bytes(4, "big"), hashlib.sha256).digest()
            self.turn += 1
        number, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return number % bound

    def pick(self, items):
        return items[self.below(len(items))]

    def like(self, text: str) -> str:
        """Letters for letters of the same script and case, digits for digits, everything else as it is."""
        out = []
        for c in text:
            if c.isdigit():
                out.append(str(self.below(10)))
            elif c.isalpha():
                other = self.pick(ALPHABETS[script(c)])
                out.append(other.upper() if c.isupper() else other)
            else:
                out.append(c)
        return "".join(out)


def _luhn(digits: str) -> int:
    doubled = [int(d) * (2 - k % 2) if k % 2 == 0 else int(d) for k, d in enumerate(reversed(digits + "0"), 1)]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10


def _valid_card(digits: str) -> bool:
    return (_luhn(digits[:-1]) + int(digits[-1])) % 10 == 0


def surrogate(key: bytes, kind: str, entity: str, attempt: int = 0) -> str:
    """The replacement of a canonical form, itself canonical."""
    stream = _Stream(key, kind, entity, str(attempt))
    longer = max(0, attempt - WIDEN + 1)
    if kind == "mail":
        local, _, domain = entity.rpartition("@")
        labels = domain.split(".")
        near = _Stream(key, "domain", domain, "0" if attempt < 8 else str(attempt))
        return stream.like(local + "a" * longer) + "@" + ".".join([near.like(label) for label in labels[:-1]] + labels[-1:])
    if kind == "ip":
        octets = entity.split(".")
        kept = 0 if longer else 1 if octets[0] in ("10", "127") else 2 if octets[:2] == ["192", "168"] or octets[0] == "172" and 16 <= int(octets[1]) < 32 else 0
        fresh = [str(1 + stream.below(254)) for _ in octets[kept:]]
        if not kept and fresh[0] in ("10", "127", "172", "192"):
            fresh[0] = "11"
        return ".".join(octets[:kept] + fresh)
    if kind == "card":
        body = entity[0] + "".join(str(stream.below(10)) for _ in entity[2:])
        last = -_luhn(body) % 10
        return body + str(last if _valid_card(entity) else (last + 1 + stream.below(9)) % 10)
    if kind == "phone":
        digits = entity.lstrip("+")
        kept = (len(digits) - 10 if len(digits) > 10 else 1) if entity[0] == "+" else 0
        body = digits[kept:]
        fresh = "".join(str(2 + stream.below(8)) if k == 0 and d != "0" else str(stream.below(10)) for k, d in enumerate(body))
        return ("+" if entity[0] == "+" else "") + digits[:kept] + fresh + "".join(str(stream.below(10)) for _ in range(longer))
    if kind == "secret":
        if re.fullmatch(r"[0-9a-f]+", entity):
            return "".join(stream.pick("0123456789abcdef") for _ in entity)
        return stream.like(entity + "a" * longer)
    place = script(entity)
    if kind == "family":
        names = FAMILY.get(place, [])
    else:
        gender = kind.partition("_")[2] or stream.pick("mf")
        names = GIVEN.get((gender, place), [])
    name = stream.pick(names).lower() if names and attempt < 3 else stream.like("a" * (max(6, len(entity)) + longer) if place == "latin" else entity * (2 + longer))
    # Given names keep their gender's usual ending where they are made up.
    return name if attempt < 3 or kind != "given_f" else name + {"latin": "a", "cyrillic": "а", "greek": "α"}[place]


def render(mention: str, kind: str, replacement: str) -> str:
    """A replacement in the format of a mention: its separators, and its letter case."""
    if kind in ("card", "phone"):
        digits = iter(_digits(replacement))
        return "".join([*(next(digits) if c.isdigit() else c for c in mention), *digits])
    if kind in ("secret", "ip"):
        return replacement
    if mention.isupper() and len(mention) > 1:
        return replacement.upper()
    return replacement[:1].upper() + replacement[1:] if mention[:1].isupper() else replacement


def _mentions(text: Column) -> Column:
    kind = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("kind", pa.string()), ("entity", pa.string())]))

    @F.arrow_udf("array<struct<s: int, e: int, kind: string, entity: string>>")
    def find(texts: pa.Array) -> pa.Array:
        return pa.array([[dict(zip(("s", "e", "kind", "entity"), m, strict=True)) for m in detect(t)] if t else [] for t in values(texts)], kind)

    return find(text)


def _settled(entities: DataFrame) -> DataFrame:
    """``base, entity, made`` for distinct ``entities(kind, entity)``: given names are one ``base``, made by one gender each over the corpus.

    A listed name has its listed gender, another one that of its titles; without title or with titles of both, the key decides.
    """
    def listed(gender: str) -> Column:
        return F.col("entity").isin([n.lower() for (g, _), names in GIVEN.items() if g == gender for n in names])

    is_given = F.col("kind").startswith("given_")
    m, f = (F.max((F.col("kind") == f"given_{g}").cast("int")) == 1 for g in "mf")
    given = entities.where(is_given).groupBy("entity").agg(m.alias("m"), f.alias("f"))
    gender = (
        F.when(listed("m") & ~listed("f"), "m").when(listed("f") & ~listed("m"), "f")
        .when(F.col("m") & ~F.col("f"), "m").when(F.col("f") & ~F.col("m"), "f").otherwise(""))
    given = given.select(F.lit("given").alias("base"), "entity", F.concat(F.lit("given_"), gender).alias("made"))
    return entities.where(~is_given).select(F.col("kind").alias("base"), "entity", F.col("kind").alias("made")).unionByName(given)


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """``kind, entity, surrogate`` for distinct ``entities(kind, entity)``: no two of a kind share one, and none is an entity.

    Given names are one kind here, whatever gender their titles tell: a name has one replacement.
    """
    @F.arrow_udf("string")
    def make(kinds: pa.Array, names: pa.Array, attempts: pa.Array) -> pa.Array:
        rows = zip(kinds.to_pylist(), names.to_pylist(), attempts.to_pylist(), strict=True)
        return pa.array([surrogate(key, kind, name, attempt) for kind, name, attempt in rows], pa.string())

    table = stored(_settled(entities).withColumn("attempt", F.lit(0)).withColumn("surrogate", make("made", "entity", "attempt")))
    taken = table.select("base", F.col("entity").alias("surrogate"), F.lit(True).alias("taken"))
    held = ["base", "entity", "made", "attempt", "surrogate"]
    while True:
        first = table.groupBy("base", "surrogate").agg(F.min("entity").alias("first"))
        judged = table.join(first, ["base", "surrogate"]).join(taken, ["base", "surrogate"], "left")
        judged = stored(judged.withColumn("clash", F.coalesce("taken", F.lit(False)) | (F.col("entity") != F.col("first"))).select(*held, "clash"))
        if judged.where("clash").isEmpty():
            base = F.when(F.col("kind").startswith("given_"), "given").otherwise(F.col("kind"))
            return entities.withColumn("base", base).join(judged, ["base", "entity"]).select("kind", "entity", "surrogate")
        again = judged.where("clash").withColumn("attempt", F.col("attempt") + 1).withColumn("surrogate", make("made", "entity", "attempt"))
        table = stored(judged.where("not clash").unionByName(again).drop("clash"))


def replace_private(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """``docs`` with their texts' entities replaced, in all their columns."""
    return replaced(docs, key, text_col).select("_row.*")


def replaced(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """``_row`` (the row with its new text) and ``_found``, its mentions' places in the old text, kinds and canonical forms."""
    text = F.col(f"`{text_col}`").cast("string")
    found = docs.select(F.struct("*").alias("_row"), _mentions(text).alias("_found"))
    some = F.size("_found") > 0
    # Rows with mentions are written once, with a number each.
    hits = stored(found.where(some).withColumn("_uid", F.monotonically_increasing_id()))
    each = hits.select("_uid", F.explode(F.array_distinct(F.transform("_found", lambda m: F.struct(m["kind"].alias("kind"), m["entity"].alias("entity"))))).alias("m"))
    each = stored(each.select("_uid", "m.*"))
    known = assign(stored(each.select("kind", "entity").distinct()), key)
    # One document's own entities, gathered by its number.
    own = each.join(known, ["kind", "entity"]).groupBy("_uid").agg(F.collect_list(F.struct("kind", "entity", "surrogate")).alias("_own"))

    @F.arrow_udf("string")
    def rewrite(texts: pa.Array, mentions: pa.Array, pairs: pa.Array) -> pa.Array:
        out = []
        for body, places, known_here in zip(values(texts), values(mentions), values(pairs), strict=True):
            to = {(p["kind"], p["entity"]): p["surrogate"] for p in known_here}
            parts, last = [], 0
            for m in places:
                parts += [body[last:m["s"]], render(body[m["s"]:m["e"]], m["kind"], to[m["kind"], m["entity"]])]
                last = m["e"]
            out.append("".join([*parts, body[last:]]))
        return pa.array(out, pa.string())

    new = hits.join(own, "_uid").withColumn("_new", rewrite(F.col(f"_row.`{text_col}`").cast("string"), "_found", "_own"))
    fields = [(F.col("_new") if c == text_col else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns]
    return new.select(F.struct(*fields).alias("_row"), "_found").unionByName(found.where(~some))
