"""PII: surrogate generation.

Detected entities get keyed replacements of the same type: email addresses, IPv4 and IPv6 addresses, phone numbers, payment
cards, US social security numbers, IBANs, secrets (hexadecimal runs and common key prefixes) and titled personal names.
A surrogate depends on the key and the normalised entity only, so an entity has one surrogate wherever it occurs
(coreference).  It keeps the format: separators, length, case, country, check digits, the script of letters, and for a
name the gender that its title or its given name tells.

Distinctness: the entities of one format are numbers below the count of that format's values, and a keyed permutation
(a Feistel network on those numbers) that moves every one maps them to surrogates, so different entities never share
one and none keeps its own.  Names have no such space: they are drawn from lists, and one that is drawn again gets a
further name of draw + 1 syllables, so names never run out.

Collision checks: the distinct entities of the corpus are aggregated; a surrogate that equals a real entity, or that two
entities share, is drawn again (by another permutation, or with more syllables) until none is left.  Of a format of which
the corpus holds more than a quarter of all values (say all addresses of two letters at hosts of three), draws would
seldom find room: there all values are listed, and the entities get those that no entity has, in a keyed order.  Only
where entities outnumber such values do the rest of them exchange their own among each other, so that none keeps its own.
Entities whose surrogate isn't the first draw are joined to the documents by the texts that hold them.

Defined cases: null texts stay null; text outside entities is unchanged byte for byte; equal texts get equal results;
entities that overlap are taken from the left, the longer first; a name of several words that a text has with a title is
replaced in the same text without one too; an entity of no letter or digit that may change stays; columns called
n_entities or kinds are replaced, all others keep their values, whatever their names.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urbanflow.llm.common import extended, fresh, others, pieces, quoted, tidy, written

#: Given names by gender and script, each list in alphabetical order.
GIVEN = {
    ("f", "latin"): ["Alice", "Anna", "Camille", "Carmen", "Claire", "Elena", "Emma", "Greta", "Helga", "Ines", "Julia", "Laura", "Maria", "Marie", "Nina", "Paula", "Sophie", "Susan", "Teresa", "Vera"],
    ("m", "latin"): ["Albert", "Bruno", "Carlos", "Daniel", "David", "Felix", "Hans", "Henri", "James", "Jean", "John", "Jorge", "Karl", "Louis", "Martin", "Oscar", "Pablo", "Peter", "Thomas", "Victor"],
    ("f", "cyrillic"): ["Анна", "Вера", "Елена", "Ирина", "Мария", "Нина", "Ольга", "Полина", "София", "Татьяна"],
    ("m", "cyrillic"): ["Алексей", "Борис", "Виктор", "Денис", "Иван", "Максим", "Олег", "Павел", "Роман", "Сергей"],
}
FAMILY = {
    "latin": ["Arnold", "Bauer", "Castro", "Dubois", "Ellis", "Fischer", "Garcia", "Hughes", "Ibarra", "Jensen", "Keller", "Lambert", "Moreau", "Navarro", "Olsen", "Perez", "Richter", "Santos", "Turner", "Weber"],
    "cyrillic": ["Белов", "Волков", "Громов", "Данилов", "Ершов", "Зайцев", "Котов", "Лебедев", "Орлов", "Соколов"],
}
#: Syllables of the further name that a drawn-again name gets; one more of them a draw, so the space has no end.
SYLLABLES = {
    "latin": [c + v for c in "bdfgklmnprstvz" for v in "aeiou"],
    "cyrillic": [c + v for c in "бвгдзклмнпрст" for v in "аеиоу"],
}
#: Titles by gender; with those of any gender a given name tells it.
TITLES = {
    "f": "Mrs Ms Miss Mme Madame Mlle Mademoiselle Frau Fräulein Señora Sra Señorita Srta Doña Signora госпожа Госпожа г-жа Г-жа гражданка Гражданка",
    "m": "Mr Herr Herrn Señor Sr Monsieur M. Signor Sir господин Господин г-н Г-н гражданин Гражданин",
    "any": "Dr Doctor Prof Professor доктор Доктор профессор Профессор",
}
TITLE_OF = {word: sex for sex, words in TITLES.items() for word in words.split()}
UPPER, LETTER = "A-ZÀ-ÖØ-ÞŁŚŠŽČА-ЯЁІЇЄ", "A-Za-zÀ-ÖØ-öø-ſА-Яа-яЁёІіЇїЄє"
#: A part of a name: McDonald, O'Neil, Jean-Luc.
NAME = rf"[{UPPER}](?:['’][{UPPER}])?[{LETTER}]+(?:['’-][{UPPER}][{LETTER}]+)*"


def titled() -> str:
    """Branches by first letter, each with what may not stand before it behind that letter, so the engine skips quickly."""
    firsts: dict[str, list[str]] = {}
    for word in sorted(TITLE_OF, key=lambda w: (-len(w), w)):
        firsts.setdefault(word[0], []).append(re.escape(word[1:]) + ("" if word.endswith(".") else r"\.?"))
    return "|".join(rf"{c}(?<!\w{c})(?:{'|'.join(rest)})" for c, rest in sorted(firsts.items()))


#: A name of one text, by its title.
TITLED = re.compile(rf"(?:{titled()}) {NAME}(?: {NAME})?(?!\w)")
EMAIL = re.compile(r"[\w.+-](?<![\w.+-]{2})[\w.+-]*@[\w-]+(?:\.[\w-]+)+")
#: Of texts with a digit only.
NUMBERED = {
    "ip": re.compile(r"[0-9](?<![0-9.][0-9])[0-9]{0,2}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"),
    "phone": re.compile(
        r"\+(?<![0-9]\+)[0-9]{1,3}[ -]?\([0-9]{2,4}\)[ -]?[0-9]{3}[ -]?[0-9]{4}(?![0-9])|\+(?<![0-9]\+)[0-9]{1,3}(?:[ .-]?[0-9]{1,4}){3,6}(?![0-9])"
        r"|\((?<![0-9]\()[0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])|[0-9](?<![0-9.+-][0-9])[0-9]{2}([-.])[0-9]{3}\1[0-9]{4}(?![0-9]|[.-][0-9])|0(?<![0-9.+-]0)[1-9]([ .-])[0-9]{2}(?:\2[0-9]{2}){3}(?![0-9]|[.-][0-9])"
        r"|1(?<![0-9.+-]1)([ .-])[0-9]{3}\3[0-9]{3}\3[0-9]{4}(?![0-9]|[.-][0-9])|0(?<![0-9.+-]0)[1-9][0-9]{1,3} [0-9]{3,4} [0-9]{3,4}(?![0-9]|[ .-][0-9])|\((?<![0-9]\()0[0-9]{1,4}\) ?[0-9]{4,8}(?![0-9]|[ .-][0-9])"),
    "card": re.compile(r"[0-9](?<![0-9][0-9])(?:[0-9]{12,18}|[0-9]{3}(?:[ -][0-9]{4}){3}|[0-9]{3}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"),
    "ssn": re.compile(r"[0-9](?<![0-9-][0-9])[0-9]{2}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"),
    "iban": re.compile(r"[A-Z](?<![0-9A-Za-z][A-Z])[A-Z][0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])"),
    "secret": re.compile(r"[0-9A-Fa-f](?<![0-9A-Za-z][0-9A-Fa-f])[0-9A-Fa-f]{31,}(?![0-9A-Za-z])|AKIA[0-9A-Z]{16}(?![0-9A-Za-z])|sk-[A-Za-z0-9_-]{20,}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[0-9A-Za-z_-]{35}(?![0-9A-Za-z_-])|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    "ipv6": re.compile(r"[0-9A-Fa-f:](?<![0-9A-Za-z:.][0-9A-Fa-f:])[0-9A-Fa-f:]{2,38}(?![0-9A-Za-z:.]*[0-9A-Za-z:])"),
}
DIGIT = re.compile("[0-9]")
PREFIXES = ("AKIA", "AIza", "eyJ", "sk-", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-")
#: Rounds of the permutation, the share of a format's values from which they are listed, and how many a task lists at a time.
ROUNDS, CROWDED, LISTED = 6, 0.25, 50_000
#: Ranks are given to so many rows at a time.
RANKED = 50_000
BATCH_CHARS = 1_000_000
BROADCAST_ROWS = 100_000
ENTITY_DDL = "kind string, entity string, sex string"


# Detection


def luhn(digits: str) -> int:
    """The check digit that follows the digits."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 - i % 2)
        total += n - 9 if n > 9 else n
    return -total % 10


def iban_check(country: str, body: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in f'{body}{country}00')) % 97:02d}"


def normal(kind: str, found: str) -> str | None:
    """What makes two mentions one entity: case of addresses and hexadecimal secrets, and separators of numbers, don't.

    None: it looks like the kind but isn't one.
    """
    if kind == "email":
        return low if len(low := found.lower()) == len(found) else found
    if kind == "ip":
        parts = [int(x) for x in found.split(".")]
        return ".".join(map(str, parts)) if max(parts) < 256 else None
    if kind == "ipv6":
        try:
            return ipaddress.IPv6Address(found).exploded if found.count(":") > 1 else None
        except ValueError:
            return None
    if kind == "phone":
        bare = re.sub(r"[^0-9+]", "", found)
        return bare if 8 <= len(bare.lstrip("+")) <= 15 else None
    if kind == "card":
        bare = re.sub(r"[^0-9]", "", found)
        return bare if len(bare) == 16 or luhn(bare[:-1]) == int(bare[-1]) else None
    if kind == "ssn":
        return found.replace("-", "")
    if kind == "iban":
        bare = found.replace(" ", "")
        return bare if 15 <= len(bare) <= 34 and iban_check(bare[:2], bare[4:]) == bare[2:4] else None
    if kind == "secret":
        if found.startswith(PREFIXES):
            return found
        return found.lower() if DIGIT.search(found) else None
    return found.partition(" ")[2]


def script(word: str) -> str:
    return "cyrillic" if any("Ѐ" <= ch <= "ӿ" for ch in word) else "latin"


def gender(entity: str, title: str = "") -> str:
    sex = TITLE_OF.get(title) or TITLE_OF.get(title.rstrip("."))
    if sex in ("f", "m"):
        return sex
    first = re.split("[ -]", entity)[0]
    return next((g for (g, _), names in GIVEN.items() if first in names), "m")


def entities(text: str | None):
    """(kind, mention, entity, gender, start, end) of each entity from left to right."""
    if not text:
        return []
    hits = [("email", m) for m in EMAIL.finditer(text)] if "@" in text else []
    if DIGIT.search(text):
        hits += [(kind, m) for kind, pattern in NUMBERED.items() for m in pattern.finditer(text)]
    else:  # these need no digit
        hits += [(kind, m) for kind, sign in (("ipv6", "::"), ("secret", "eyJ")) if sign in text for m in NUMBERED[kind].finditer(text)]
    found = [(m.start(), -m.end(), kind, m[0], entity, "") for kind, m in hits if (entity := normal(kind, m[0])) is not None]
    names = {}
    for m in TITLED.finditer(text):
        entity = normal("name", m[0])
        names[entity] = sex = gender(entity, m[0].partition(" ")[0])
        found.append((m.start(), -m.end(), "name", m[0], entity, sex))
    for entity, sex in names.items():
        if " " in entity:
            found += [(m.start(), -m.end(), "name", entity, entity, sex) for m in re.finditer(rf"(?<!\w){re.escape(entity)}(?!\w)", text)]
    out, free = [], 0
    for start, end, kind, mention, entity, sex in sorted(found):
        if start >= free:
            out.append((kind, mention, entity, sex, start, -end))
            free = -end
    return out


# Surrogates


def radices(kind: str, entity: str) -> tuple[str, list[int]]:
    """The entity's format, and the number of values at each of its places: 1 where the character stays."""
    each = lambda s: [10 if c.isascii() and c.isdigit() else 26 if c.isascii() and c.isalpha() else 1 for c in s]
    if kind == "email":
        head, _, last = entity.rpartition(".")
        out = [*each(head), *[1] * (1 + len(last))]
    elif kind == "ip":
        out = [256] * 4
    elif kind == "ipv6":
        out = [16 if c != ":" else 1 for c in entity]
    elif kind == "phone":
        keep = 2 if entity.startswith("+") else 1 if entity.startswith("0") else 0
        out = [*[1] * keep, *each(entity[keep:])]
        out[0] = out[0] if keep else 9  # so it doesn't begin with 0
    elif kind == "card":
        out = [*each(entity[:-1]), 1]
    elif kind == "iban":
        out = [*[1] * 4, *each(entity[4:])]
    elif kind == "secret" and entity.startswith(PREFIXES):
        prefix = next(p for p in PREFIXES if entity.startswith(p))
        out = [*[1] * len(prefix), *each(entity[len(prefix) :])]
    elif kind == "secret":
        out = [16] * len(entity)
    else:
        out = each(entity)
    fixed = "".join(c if r == 1 else "9" if r in (9, 10) else ("A" if c.isupper() else "a") if r == 26 else "x" for c, r in zip(entity if kind != "ip" else "xxxx", out, strict=True))
    if kind == "card":
        fixed = f"{fixed[:-1]}+{(int(entity[-1]) - luhn(entity[:-1])) % 10}"  # how far the last digit is from the check digit
    elif kind == "iban":
        fixed = f"{fixed[:2]}{fixed[4:]}"
    return fixed, out


def number(kind: str, entity: str, places: list[int]) -> int:
    parts = [int(x) for x in entity.split(".")] if kind == "ip" else entity
    n = 0
    for c, r in zip(parts, places, strict=True):
        if r > 1:
            n = n * r + (c if r == 256 else int(c, 16) if r == 16 else int(c) - 10 + r if r < 16 else ord(c.lower()) - 97)
    return n


def spelled(kind: str, entity: str, places: list[int], n: int) -> str:
    """The value number n of the entity's format."""
    out: list = list(entity.split(".") if kind == "ip" else entity)
    for i in range(len(places) - 1, -1, -1):
        if (r := places[i]) > 1:
            n, v = divmod(n, r)
            out[i] = str(v) if r == 256 else f"{v:x}" if r == 16 else str(v + 10 - r) if r < 16 else chr(v + (65 if out[i].isupper() else 97))
    if kind == "card":
        body = "".join(out[:-1])
        return body + str((luhn(body) + int(entity[-1]) - luhn(entity[:-1])) % 10)
    if kind == "iban":
        return entity[:2] + iban_check(entity[:2], "".join(out[4:])) + "".join(out[4:])
    return (".".join if kind == "ip" else "".join)(out)


def feistel(n: int, size: int, tweak: bytes, back: bool) -> int:
    """A keyed permutation of the numbers below size, or its inverse."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask, width = (1 << half) - 1, half // 8 + 1

    def turn(right: int, k: int) -> int:
        return int.from_bytes(hashlib.shake_256(tweak + bytes([k]) + right.to_bytes(width, "big")).digest(width), "big") & mask

    while True:  # walks on until it is below size again: four steps at the most on average
        left, right = n >> half, n & mask
        for k in range(ROUNDS - 1, -1, -1) if back else range(ROUNDS):
            left, right = (right ^ turn(left, k), left) if back else (right, left ^ turn(right, k))
        n = left << half | right
        if n < size:
            return n


def stream(secret: bytes, kind: str, entity: str, draw: int):
    """Endless keyed numbers below a bound: stream(...)(n)."""
    block, n = b"", 0

    def below(bound: int) -> int:
        nonlocal block, n
        if len(block) < 4:
            block += hmac.new(secret, f"{kind}\0{entity}\0{draw}\0{n}".encode(), hashlib.sha256).digest()
            n += 1
        value, block = int.from_bytes(block[:4], "big"), block[4:]
        return value % bound

    return below


@lru_cache(maxsize=100_000)
def plain_surrogate(kind: str, entity: str, secret: bytes, draw: int, sex: str = "m") -> str:
    """The surrogate of a normalised entity."""
    if kind == "name":
        below = stream(secret, kind + sex, entity, draw)
        parts = entity.split(" ")
        kindred = [FAMILY[script(p)] if i == len(parts) - 1 else GIVEN[sex, script(p)] for i, p in enumerate(parts)]
        drawn = [names[below(len(names))] for names in kindred]
        more = SYLLABLES[script(parts[-1])]
        return " ".join(drawn) + ("" if draw == 0 else "-" + "".join(more[below(len(more))] for _ in range(draw + 1)).capitalize())
    fixed, places = radices(kind, entity)
    size = 1
    for r in places:
        size *= r
    if size == 1:
        return entity
    tweak = hmac.new(secret, f"{kind}\0{fixed}\0{draw}".encode(), hashlib.sha256).digest()
    # One step on a cycle through all values: distinct for distinct entities, and never the entity itself.
    on = (feistel(number(kind, entity, places), size, tweak, False) + 1) % size
    return spelled(kind, entity, places, feistel(on, size, tweak, True))


def dressed(kind: str, found: str, surrogate: str) -> str:
    """The surrogate in the format of the mention: separators, case and title."""
    if kind in ("phone", "card", "ssn", "iban"):
        rest = iter(surrogate)
        return "".join(next(rest) if c.isalnum() or c == "+" else c for c in found)
    if kind == "ipv6":
        own = surrogate if ":" in found and "::" not in found and len(found) == 39 else ipaddress.IPv6Address(surrogate).compressed
        return own.upper() if found.upper() == found and found.lower() != found else own
    if found.upper() == found and kind in ("email", "secret") and not found.startswith(PREFIXES):
        return surrogate.upper()
    if kind == "email" or kind == "secret" and not found.startswith(PREFIXES):
        return "".join(s.upper() if f.isupper() else s for f, s in zip(found, surrogate, strict=True))
    if kind == "name" and (found.partition(" ")[0] in TITLE_OF or found.partition(" ")[0].rstrip(".") in TITLE_OF):
        return f"{found.partition(' ')[0]} {surrogate}"
    return surrogate


# Over the corpus


def found_entities(docs: DataFrame, secret: bytes, text: str) -> DataFrame:
    """Distinct kind, entity, sex, first surrogate, format and `room` (the number of the format's values) of the corpus."""

    def run(batches):
        for batch in batches:
            seen = {(k, e, g) for t in batch.column(0).to_pylist() for k, _, e, g, _, _ in entities(t)}
            rows = []
            for k, e, g in sorted(seen):
                fixed, room = None, float("inf")
                if k != "name":
                    fixed, places = radices(k, e)
                    room = 1.0
                    for r in places:
                        room = min(room * r, 1e300)
                rows.append((k, e, g, plain_surrogate(k, e, secret, 0, g), fixed, room))
            if rows:
                cols = zip(zip(*rows, strict=True), (*[pa.string()] * 5, pa.float64()), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in cols], names=["kind", "entity", "sex", "surrogate", "format", "room"])

    return docs.select(quoted(text)).mapInArrow(tidy(run), f"{ENTITY_DDL}, surrogate string, format string, room double").distinct()


def ranked(df: DataFrame, secret: bytes, value: str) -> DataFrame:
    """df (kind, format, ...) with rank: a keyed order of each format's rows from 0.  No window holds more than about RANKED rows."""
    hashed = df.withColumn("h", F.sha2(F.concat(F.lit(secret.hex()), "kind", F.col(value)), 256))
    sizes = df.groupBy("kind", "format").agg(F.count("*").alias("size"))
    place = F.conv(F.substring("h", 1, 8), 16, 10).cast("double") / 2**32
    dealt = hashed.join(sizes, ["kind", "format"]).withColumn("bucket", F.floor(place * F.ceil(F.col("size") / RANKED)))
    counts = dealt.groupBy("kind", "format", "bucket").agg(F.count("*").alias("k"))
    before = Window.partitionBy("kind", "format").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("kind", "format", "bucket", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("kind", "format", "bucket").orderBy("h", value)
    out = dealt.withColumn("nth", F.row_number().over(inside)).join(counts, ["kind", "format", "bucket"])
    return out.withColumn("rank", F.col("base") + F.col("nth") - 1).drop("h", "bucket", "nth", "base")


def listed(formats: DataFrame) -> DataFrame:
    """kind, format, surrogate: all values of formats (kind, format, template - one entity of it -, room)."""

    def run(batches):
        for batch in batches:
            for kind, fixed, template, first, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                places = radices(kind, template)[1]
                values = pa.array([spelled(kind, template, places, n) for n in range(first, end)], pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([kind] * len(values)), pa.array([fixed] * len(values)), values], names=["kind", "format", "surrogate"])

    room = F.col("room").cast("bigint")
    parts = formats.select("kind", "format", "template", room.alias("room"), F.explode(F.sequence(F.lit(0), F.ceil(room / LISTED) - 1)).alias("part"))
    parts = parts.select("kind", "format", "template", (F.col("part") * LISTED).alias("first"), F.least((F.col("part") + 1) * LISTED, "room").alias("end"))
    return parts.repartition("kind", "format", "first").mapInArrow(tidy(run), "kind string, format string, surrogate string")


def matched(crowded: DataFrame, formats: DataFrame, secret: bytes) -> DataFrame:
    """kind, entity, sex, surrogate of entities of formats that are nearly full.

    The entity of rank r gets the free value of rank r.  Those beyond the free values take each other's, the next one's
    by rank; a single one takes the free value of rank 0 and leaves its own to that rank's entity.
    """
    mine = written(ranked(crowded.select("kind", "format", "entity", "sex"), secret, "entity"), "mine")
    free = listed(formats).join(crowded.select("kind", F.col("entity").alias("surrogate")), ["kind", "surrogate"], "left_anti").select("kind", "format", "surrogate")
    free = written(ranked(free, secret, "surrogate"), "free")
    room = free.groupBy("kind", "format").agg(F.count("*").alias("n_free"))
    rows = mine.join(room, ["kind", "format"], "left").fillna(0, ["n_free"])
    r, f, m = F.col("rank"), F.col("n_free"), F.col("size")
    one = (m - f == 1) & (f > 0)
    # takes: the rank of the free value; else gives: the rank of the entity whose value it takes.
    takes = F.when(one & (r == f), 0).when((r < f) & ~(one & (r == 0)), r)
    gives = F.when(one & (r == 0), f).when(r >= f, F.when(r + 1 < m, r + 1).otherwise(f))
    rows = rows.select("kind", "format", "entity", "sex", takes.alias("takes"), F.when(takes.isNull(), gives).alias("gives"))
    got = rows.where("takes is not null").join(free.select("kind", "format", F.col("rank").alias("takes"), "surrogate"), ["kind", "format", "takes"])
    swapped = rows.where("takes is null").join(mine.select("kind", "format", F.col("rank").alias("gives"), F.col("entity").alias("surrogate")), ["kind", "format", "gives"])
    return got.select("kind", "entity", "sex", "surrogate").unionByName(swapped.select("kind", "entity", "sex", "surrogate"))


def redrawn(found: DataFrame, secret: bytes) -> DataFrame:
    """kind, entity, sex, surrogate of the entities whose first surrogate doesn't stand.

    The first surrogates are written once; each round draws again for those that clash, and keeps what nobody has.
    Rounds end: at most half of a format's values are taken, so each leaves about half of its clashes, and names get longer.
    """
    found = written(found, "entities")
    formats = found.where("format is not null").groupBy("kind", "format").agg(F.count("*").alias("k"), F.max("room").alias("room"), F.min("entity").alias("template"))
    formats = written(formats.where((F.col("k") > CROWDED * F.col("room")) & (F.col("room") > 1)).select("kind", "format", "template", "room"), "crowded")
    if full := not formats.isEmpty():
        key = F.broadcast(formats.select("kind", "format")) if formats.count() <= BROADCAST_ROWS else formats.select("kind", "format")
        crowded, found = (found.join(key, ["kind", "format"], how) for how in ("left_semi", "left_anti"))
        crowded, found = written(crowded, "full"), written(found, "roomy")
    done = [written(matched(crowded, formats, secret), "matched")] if full else []

    taken = found.select("kind", "surrogate").unionByName(found.select("kind", F.col("entity").alias("surrogate")))
    shared = found.groupBy("kind", "surrogate").agg(F.count("*").alias("n"), F.min(F.struct("entity", "sex")).alias("keeps")).where("n > 1")
    losers = found.join(shared, ["kind", "surrogate"]).where(F.struct("entity", "sex") != F.col("keeps")).select("kind", "entity", "sex")
    unreal = found.join(found.select("kind", F.col("entity").alias("surrogate")).distinct(), ["kind", "surrogate"], "left_semi").where("surrogate <> entity or kind = 'name'").select("kind", "entity", "sex")
    clash, draw = written(losers.unionByName(unreal).distinct(), "clash"), 0
    while not clash.isEmpty():
        draw += 1

        def again(batches, draw=draw):
            for b in batches:
                ks, es, gs = (c.to_pylist() for c in b.columns)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([plain_surrogate(k, e, secret, draw, g) for k, e, g in zip(ks, es, gs, strict=True)], pa.string())], names=["kind", "entity", "sex", "surrogate"])

        drawn = written(clash.mapInArrow(again, f"{ENTITY_DDL}, surrogate string"), "drawn")
        gone = taken.join(drawn.select("kind", "surrogate").distinct(), ["kind", "surrogate"], "left_semi").distinct()
        best = drawn.join(gone, ["kind", "surrogate"], "left_anti").groupBy("kind", "surrogate").agg(F.min(F.struct("entity", "sex")).alias("e"))
        kept = written(best.select("kind", "e.entity", "e.sex", "surrogate"), "kept")
        taken = taken.unionByName(kept.select("kind", "surrogate"))
        done.append(kept)
        clash = written(clash.join(kept, ["kind", "entity", "sex"], "left_anti"), "clash")
    out = found.limit(0).select("kind", "entity", "sex", "surrogate")
    for part in done:
        out = out.unionByName(part)
    return out


def pseudonymize(docs: DataFrame, secret: bytes, text: str = "text") -> DataFrame:
    """docs with surrogates in `text`, and n_entities and kinds (sorted, of the entities found)."""
    late = redrawn(found_entities(docs, secret, text), secret)
    docs = docs.select(*(quoted(c) for c in others(docs, "n_entities", "kinds")))
    few = late.limit(BROADCAST_ROWS + 1).collect()
    if len(few) > BROADCAST_ROWS:
        return replaced(*joined_surrogates(docs, late, text), secret, text, {})
    return replaced(docs, None, secret, text, {(r["kind"], r["entity"], r["sex"]): r["surrogate"] for r in few})


def joined_surrogates(docs: DataFrame, late: DataFrame, text: str) -> tuple[DataFrame, str]:
    """docs with a map entity -> surrogate of their own late entities, and its name; for more of them than may be broadcast."""
    version, draws, own = fresh(docs, "version", "draws", "own")
    rows = docs.withColumn(version, F.sha2(F.coalesce(quoted(text), F.lit("")), 256))

    def run(batches):
        for b in batches:
            out = sorted({(v, k, e, g) for v, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for k, _, e, g, _, _ in entities(t)})
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out, strict=True)], names=["version", "kind", "entity", "sex"])

    held = rows.select(version, quoted(text)).mapInArrow(tidy(run), f"version string, {ENTITY_DDL}").distinct()
    held = held.join(late, ["kind", "entity", "sex"]).groupBy(F.col("version").alias(own)).agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws("\0", "kind", "entity", "sex"), "surrogate"))).alias(draws))
    return rows.join(held, F.col(version) == F.col(own), "left").drop(version, own), draws


def replaced(docs: DataFrame, draws_in: str | None, secret: bytes, text: str, draws: dict) -> DataFrame:
    """docs with surrogates.  draws_in: the column with each row's own late surrogates, which goes; draws: those of all rows."""
    kept = [c for c in docs.columns if c != draws_in]
    at, n = kept.index(text), len(kept)
    rows = docs.select(*(quoted(c) for c in kept), *([quoted(draws_in)] if draws_in else []))
    schema = extended(docs.select(*(quoted(c) for c in kept)), "n_entities int, kinds array<string>")

    def one(t, own):
        if t is None:
            return None, 0, []
        out, pos, kinds = [], 0, []
        for kind, found, entity, sex, a, b in entities(t):
            late = own.get(f"{kind}\0{entity}\0{sex}") if own else draws.get((kind, entity, sex))
            out += [t[pos:a], dressed(kind, found, plain_surrogate(kind, entity, secret, 0, sex) if late is None else late)]
            pos = b
            kinds.append(kind)
        return ("".join(out) + t[pos:] if out else t), len(kinds), sorted(set(kinds))

    def run(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for a, b in pieces([len(t or "") + 200 for t in texts], BATCH_CHARS):
                part = batch.slice(a, b - a)
                owns = part.column(n).to_pylist() if draws_in else [None] * (b - a)
                done = [one(t, dict(own) if own else None) for t, own in zip(texts[a:b], owns, strict=True)]
                cols = [*part.columns[:n], pa.array([x[1] for x in done], pa.int32()), pa.array([x[2] for x in done], pa.list_(pa.string()))]
                cols[at] = pa.array([x[0] for x in done], pa.string())
                yield pa.RecordBatch.from_arrays(cols, names=[*kept, "n_entities", "kinds"])

    return rows.mapInArrow(tidy(run), schema)
