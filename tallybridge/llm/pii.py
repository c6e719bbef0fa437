"""Personal data replaced by keyed surrogates of the same kind, format, script and gender.

An entity is a kind and a plain form, such as the digits of a telephone number or one word of a name;
every mention of it in the corpus gets the same surrogate, written as the mention was.
Surrogates come from a keyed hash of the entity and an attempt number. A surrogate that another
entity also got, or that is itself an entity of the corpus, is refused and drawn again, so
different entities stay different and no surrogate points at a real one.
"""

from __future__ import annotations

import bisect
import hashlib
import hmac
import ipaddress
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import all_columns, by_batch, clear_of, stored
from .features import utf8

# Attempts after which a surrogate may be longer than its entity: the entity's own format is
# then taken to be nearly used up in the corpus.
TIGHT_ATTEMPTS = 16

PATTERNS = {
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)*\.[A-Za-z]{2,}"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])"),
    "ipv6": re.compile(
        r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"
        r"|(?<![\w:.])(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::(?:(?:[0-9A-Fa-f]{1,4}:){0,6}(?:[0-9A-Fa-f]{1,4}|(?:[0-9]{1,3}\.){3}[0-9]{1,3}))?(?![\w:]|\.[0-9])"
    ),
    "ip": re.compile(r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"),
    "ssn": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "card": re.compile(r"(?<![0-9.,+-])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9-]|[.,][0-9])"),
    "phone": re.compile(
        r"(?<![0-9A-Za-z.+-])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])?[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z-]|[.,][0-9])|(?<![0-9A-Za-z.])\+[0-9]{8,15}(?![0-9A-Za-z])"
        r"|(?<![0-9A-Za-z.+-])(?:\+[0-9](?:(?:[ .-]|[ .-]?\(|\)[ .-]?)?[0-9]){6,14}|0[0-9](?P<sep>[ .-])[0-9]{2}(?:(?P=sep)[0-9]{2}){3}|\(?0[0-9]{1,4}\)?[ /-][0-9]{5,8})(?![0-9A-Za-z-]|[.,][0-9])"
    ),
}
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏͰ-ϿЀ-ӿ'’-"
# Titles that a name follows, by the gender they tell.
TITLES = {
    "f": ["Mrs", "Ms", "Miss", "Mme", "Mlle", "Madame", "Mademoiselle", "Frau", "Señora", "Señorita", "Sra", "Srta", "Doña", "г-жа", "госпожа", "Κυρία"],
    "m": ["Mr", "Mister", "M", "Monsieur", "Herr", "Señor", "Sr", "Don", "г-н", "господин", "Κύριος"],
    "u": ["Dr", "Prof", "Professor", "Mx"],
}
# Common given names, by gender.
GIVEN = {
    "f": "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Emma Olivia Sophia Anna Maria Laura Julia Marie Claire Camille Sophie Katharina Ursula Sabine Carmen Lucía Isabel Elena Анна Мария Елена Ольга Ελένη Μαρία".split(),
    "m": "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Peter Paul Hans Klaus Jürgen Stefan Pierre Jean Louis Michel Carlos José Juan Luis Miguel Antonio Иван Александр Дмитрий Сергей Γιώργος Νίκος".split(),
}
WORD = rf"[{LETTERS}]+"
WORDS, PIECES, POSSESSIVE = re.compile(WORD), re.compile(r"[^'’-]+"), re.compile(r"(?:['’]s)?['’-]*$")
NAMED = re.compile(rf"(?<![{LETTERS}])(?P<title>{'|'.join(sorted((t for v in TITLES.values() for t in v), key=len, reverse=True))})(?P<gap>\.? )(?P<names>{WORD}(?: {WORD}){{0,2}})")
FULL = re.compile(rf"(?<![{LETTERS}])(?P<given>{'|'.join(sorted((g for v in GIVEN.values() for g in v), key=len, reverse=True))}) (?P<family>{WORD})(?![{LETTERS}])")
TITLE_GENDER = {t: g for g, v in TITLES.items() for t in v}
GIVEN_GENDER = {n.casefold(): g for g, v in GIVEN.items() for n in v}
HINTS = {t.encode() + end for v in TITLES.values() for t in v for end in (b" ", b". ")} | {g.encode() + b" " for v in GIVEN.values() for g in v}
# The first four bytes of each, or as many as it has, by the mask that selects them.
HEADS = {
    0xFFFFFFFF << 8 * (4 - size) & 0xFFFFFFFF: np.unique([int.from_bytes(h[:size].ljust(4, b"\0"), "big") for h in HINTS if min(len(h), 4) == size]).astype(np.uint32)
    for size in (2, 3, 4)
}
# Parts that surrogate names are built of, by script: openings, vowels, middle
# consonants, and the ends of female, male and other given names and of family names.
PARTS = {
    "latin": (list("bcdfghjklmnprstvw"), list("aeiou"), list("lmnrst"), {"f": ["a", "ina", "elle"], "m": ["o", "an", "ert"], "u": ["is", "en"], "family": ["son", "er", "ard", "etti"]}),
    "cyrillic": (list("бвгдзклмнпрст"), list("аеиоу"), list("лмнрст"), {"f": ["а", "ина"], "m": ["ан", "ор"], "u": ["ис"], "family": ["енко", "ко"]}),
    "greek": (list("βγδζκλμνπρστ"), list("αειο"), list("λμνρσ"), {"f": ["α", "ινα"], "m": ["ος", "ης"], "u": ["ις"], "family": ["ίδης", "άκης"]}),
}

Mention = tuple[int, int, str, str]  # start, end, kind, plain form


# ---- finding ---------------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for n, d in enumerate(reversed(digits)):
        d = int(d) * (1 + n % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def iban_holds(plain: str) -> bool:
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def plain_form(kind: str, text: str) -> str | None:
    """What all mentions of one entity share; None if the text is no such entity."""
    if kind == "email":
        return text.lower()
    if kind == "iban":
        plain = text.replace(" ", "")
        return plain if iban_holds(plain) else None
    if kind == "ip":
        parts = text.split(".")
        good = all(int(p) <= 255 and str(int(p)) == p for p in parts)
        return text if good else None
    if kind == "ipv6":
        # A short form without digits, such as a::b, is more likely code than an address.
        if "::" in text and not any(c.isdigit() for c in text) and text.count(":") < 4:
            return None
        try:
            whole = ipaddress.IPv6Address(text).exploded
        except ValueError:
            return None
        return ":".join(p.lstrip("0") or "0" for p in whole.split(":"))
    digits = re.sub("[^0-9]", "", text)
    if kind == "phone":
        return ("+" if text.startswith("+") else "") + digits if 7 <= len(digits) <= 15 else None
    return digits


def script_of(word: str) -> str:
    first = ord(word[0])
    return "greek" if 0x370 <= first <= 0x3FF else "cyrillic" if 0x400 <= first <= 0x4FF else "latin"


def named(text: str) -> Iterator[Mention]:
    """Words of names: those that start with a capital after a title or a known given name."""

    def kind(word: str, place: int, count: int, gender: str) -> str:
        known = GIVEN_GENDER.get(word.casefold())
        if count > 1 and place < count - 1 or known and place < count - 1:
            return f"given:{known or gender}:{script_of(word)}"
        return f"family:{script_of(word)}"

    for match in NAMED.finditer(text):
        words, at = [], match.start("names")
        for word in match["names"].split(" "):
            trimmed = POSSESSIVE.sub("", word)
            if not trimmed or not trimmed[0].isupper():
                break
            words.append((at, trimmed))
            at += len(word) + 1
            if trimmed != word:
                break
        gender = TITLE_GENDER[match["title"]]
        for place, (start, word) in enumerate(words):
            yield start, start + len(word), kind(word, place, len(words), gender), word.casefold()
    for match in FULL.finditer(text):
        word = POSSESSIVE.sub("", match["family"])
        if word and word[0].isupper():
            given = match["given"]
            yield match.start(), match.end("given"), f"given:{GIVEN_GENDER[given.casefold()]}:{script_of(given)}", given.casefold()
            yield match.start("family"), match.start("family") + len(word), f"family:{script_of(word)}", word.casefold()


def bare(text: str, names: dict[str, tuple[str, str]]) -> Iterator[Mention]:
    """Words with a capital that are among ``names``, whole or as a part of a compound."""
    for match in WORDS.finditer(text):
        word = POSSESSIVE.sub("", match[0])
        if word.casefold() in names:
            pieces = [(match.start(), word)]
        else:
            pieces = [(match.start() + p.start(), p[0]) for p in PIECES.finditer(word)] if len(word) > 1 else []
        for at, piece in pieces:
            name = names.get(piece.casefold())
            if name and piece[0].isupper():
                yield at, at + len(piece), *name


def mentions(text: str) -> list[Mention]:
    """All mentions in order, none overlapping: of two that do, the earlier kind in PATTERNS stays.

    A name that a title or a known given name introduces is found wherever the text has it.
    """
    found: list[Mention] = []
    taken: list[tuple[int, int]] = []  # in order; spans do not overlap, so the last one before an end is enough

    def free(start: int, end: int) -> bool:
        n = bisect.bisect_left(taken, (end,))
        return not n or taken[n - 1][1] <= start

    for kind, pattern in PATTERNS.items():
        for match in pattern.finditer(text):
            plain = plain_form(kind, match[0])
            if plain and free(*match.span()):
                found.append((match.start(), match.end(), kind, plain))
        taken = sorted((a, b) for a, b, _, _ in found)
    names: dict[str, tuple[str, str]] = {}
    for mention in named(text):
        if free(*mention[:2]):
            found.append(mention)
            bisect.insort(taken, mention[:2])
            if mention[1] - mention[0] > 1:  # an initial stands for too many words
                names.setdefault(mention[3], mention[2:])
    if names:
        found += [mention for mention in bare(text, names) if free(*mention[:2])]
    return sorted(found)


def worth_reading(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which rows hold an at sign, two digits in a row, seven colons or two in a row, or a title or given name."""
    rows = np.zeros(len(offsets) - 1, bool)
    if not len(data):
        return rows
    digit = (data >= 48) & (data <= 57)
    places = [np.flatnonzero(data == 64), np.flatnonzero(digit[:-1] & digit[1:]), np.flatnonzero(digit & (np.append(data[1:], 0) == 46))]
    for at in places:
        rows[np.searchsorted(offsets, at, side="right") - 1] = True
    colon = np.flatnonzero(data == 58)
    rows[np.searchsorted(offsets, colon[:-1][np.diff(colon) == 1], side="right") - 1] = True
    near = np.bincount(np.searchsorted(offsets, colon, side="right") - 1, minlength=len(rows))
    rows |= near >= 7
    # Words that start like a title or a given name: a capital, or a Greek or Cyrillic letter.
    padded = np.concatenate([data, np.zeros(4, np.uint8)])
    start = ((data >= 65) & (data <= 90)) | ((data >= 0xC3) & (data <= 0xD1))
    inside = np.zeros(len(data), bool)
    inside[1:] = ((data[:-1] | 32) - np.uint8(97) < 26) | (data[:-1] >= 0x80)
    inside[offsets[:-1][offsets[:-1] < len(data)]] = False
    start &= ~inside
    at = np.flatnonzero(start)
    head = sum(padded[at + n].astype(np.uint32) << np.uint32(24 - 8 * n) for n in range(4)) if len(at) else at
    for mask, heads in HEADS.items():
        rows[np.searchsorted(offsets, at[np.isin(head & np.uint32(mask), heads)], side="right") - 1] = True
    return rows


# ---- surrogates ------------------------------------------------------------------


class Draw:
    """Numbers from a keyed hash of an entity and an attempt, as many as asked for."""

    def __init__(self, key: bytes, kind: str, plain: str, attempt: int):
        self.seed = hmac.new(key, f"{kind}\0{plain}\0{attempt}".encode("utf-8", "surrogatepass"), hashlib.sha256).digest()
        self.pool, self.blocks = b"", 0

    def below(self, bound: int) -> int:
        if len(self.pool) < 8:
            self.pool += hashlib.sha256(self.seed + self.blocks.to_bytes(4, "big")).digest()
            self.blocks += 1
        value, self.pool = int.from_bytes(self.pool[:8], "big"), self.pool[8:]
        return value % bound

    def like(self, text: str) -> str:
        """Letters for letters, digits for digits, all else as it is."""
        return "".join(
            chr(97 + self.below(26)) if c.islower() else chr(65 + self.below(26)) if c.isupper() else str(self.below(10)) if c.isdigit() else c
            for c in text
        )

    def pick(self, values: list[str]) -> str:
        return values[self.below(len(values))]


def surrogate(key: bytes, kind: str, plain: str, attempt: int) -> str:
    """The plain form of a surrogate: same kind, length and checksums as ``plain`` has."""
    draw, spare = Draw(key, kind, plain, attempt), max(0, attempt - TIGHT_ATTEMPTS + 1)
    if kind == "email":
        local, _, host = plain.rpartition("@")
        labels = host.split(".")
        place = Draw(key, "host", host, 0)  # mentions of one host stay together
        return draw.like(local + "a" * spare) + "@" + ".".join([*(place.like(x) for x in labels[:-1]), labels[-1]])
    if kind == "ip":
        octets = [int(x) for x in plain.split(".")]
        fixed = 1 if octets[0] in (10, 127) else 2 if octets[:2] == [192, 168] or octets[0] == 172 and 16 <= octets[1] < 32 else 0
        if fixed and spare:  # its block is nearly used up: first any address of 10/8, then any public one
            octets, fixed = [10], int(attempt < 2 * TIGHT_ATTEMPTS)
        if attempt >= 4 * TIGHT_ATTEMPTS:  # no four octets are left: a unique local address of eight groups
            return ":".join(f"{draw.below(1 << 16) if n else 0xFD00 + draw.below(256):x}" for n in range(8))
        while True:
            new = octets[:fixed] + [1 + draw.below(223) if n == 0 else draw.below(256) for n in range(fixed, 4)]
            if fixed or not ipaddress.ip_address(bytes(new)).is_private:
                return ".".join(map(str, new))
    if kind == "ipv6":
        return ":".join(f"{draw.below(1 << 16):x}" for _ in range(8))
    if kind == "iban":
        body = "".join(chr(65 + draw.below(26)) if c.isalpha() else str(draw.below(10)) for c in plain[4:]) + "0" * spare
        rest = int("".join(str(int(c, 36)) for c in body + plain[:2] + "00")) % 97
        return f"{plain[:2]}{98 - rest:02d}{body}"
    if kind == "card":
        body = "".join(str(draw.below(10)) for _ in range(len(plain) - 1 + spare))
        checks = [d for d in "0123456789" if luhn(body + d)]
        return body + checks[0] if luhn(plain) else body + str((int(checks[0]) + 1 + draw.below(9)) % 10)
    if kind == "phone":
        head = 2 if plain.startswith("+") else 0  # the plus sign and the first digit of the country
        return plain[:head] + "".join(str(draw.below(10)) for _ in range(len(plain) - head + spare))
    if kind == "ssn":
        return "".join(str(draw.below(10)) for _ in range(len(plain) + spare))
    role, *rest = kind.split(":")
    opening, vowels, middle, ends = PARTS[rest[-1]]
    syllables = 1 + draw.below(2) + attempt // 2 + (role == "family")
    stem = draw.pick(opening) + "".join(draw.pick(vowels) + draw.pick(middle) for _ in range(syllables))
    return stem + draw.pick(ends["family" if role == "family" else rest[0]])


def written(kind: str, mention: str, plain: str) -> str:
    """``plain`` in the way ``mention`` is written: its case, signs and grouping."""
    if kind == "email":
        if mention.isupper():
            return plain.upper()
        return "".join(c.upper() if n < len(mention) and mention[n].isupper() else c for n, c in enumerate(plain))
    if kind == "ip":
        return plain
    if kind == "ipv6":
        return plain.upper() if any(c.isupper() for c in mention) else plain
    if ":" in kind:
        return plain.upper() if mention.isupper() and len(mention) > 1 else plain[0].upper() + plain[1:]
    signs, out = iter(plain.lstrip("+")), []
    for c in mention:
        out.append(next(signs, "") if c.isalnum() else c)
    return "".join(out) + "".join(signs)


def replaced(text: str, found: list[Mention], key: bytes, attempts: dict[tuple[str, str], int]) -> str:
    out, at = [], 0
    for start, end, kind, plain in found:
        out.append(text[at:start])
        out.append(written(kind, text[start:end], surrogate(key, kind, plain, attempts.get((kind, plain), 0))))
        at = end
    return "".join([*out, text[at:]])


# ---- the corpus ------------------------------------------------------------------


def _found(texts: pa.Array) -> Iterator[tuple[int, list[Mention]]]:
    for n in np.flatnonzero(worth_reading(*utf8(texts))).tolist():
        found = mentions(texts[n].as_py())
        if found:
            yield n, found


def of_one_kind(entities: DataFrame) -> DataFrame:
    """(kind, plain, own): ``own`` is one kind for all mentions of a given name.

    Titles tell different genders of a name that is not in GIVEN: of those the one that occurs
    beside u counts, and u if both do.
    """
    parts = F.split("kind", ":")
    given = entities.filter(F.col("kind").startswith("given:")).select("plain", parts[1].alias("gender"), parts[2].alias("script"))
    has = lambda g: F.max(F.col("gender") == g)
    told = F.when(has("f") & ~has("m"), "f").when(has("m") & ~has("f"), "m").otherwise("u")
    one = given.groupBy("plain", "script").agg(told.alias("told")).select("plain", "told", F.concat(F.lit("given:"), "told", F.lit(":"), "script").alias("one"))
    same = F.col("kind").startswith("given:") & (F.element_at(F.split("kind", ":"), -1) == F.element_at(F.split("one", ":"), -1))
    joined = entities.join(one.withColumnRenamed("plain", "name"), (F.col("plain") == F.col("name")) & same, "left")
    return joined.select("kind", "plain", F.coalesce("one", "kind").alias("own"))


def settle(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, plain, attempt) of the entities whose first surrogate was refused.

    ``entities`` are distinct (kind, plain). Of those that drew one surrogate the one with the
    smallest plain form keeps it; a surrogate that is an entity, or that was accepted in an
    earlier round, is refused to all. Ends when none is refused: the surrogates of later attempts
    become longer without end. Those of ip keep to their private block at first, then to 10/8,
    then to public addresses, and at last become ipv6 addresses, of which no corpus holds half.
    """
    spark = entities.sparkSession
    schema = "kind string, plain string, attempt int, drawn string"

    def drawn(rows: DataFrame, attempt: int) -> DataFrame:
        def run(batch: pa.RecordBatch) -> Iterator[dict]:
            kinds, plains = batch.column(0), batch.column(1)
            values = [surrogate(key, k, p, attempt) for k, p in zip(kinds.to_pylist(), plains.to_pylist(), strict=True)]
            yield {"kind": kinds, "plain": plains, "attempt": [attempt] * len(values), "drawn": values}

        return by_batch(rows.select("kind", "plain"), schema, run)

    accepted, waiting, attempt = spark.createDataFrame([], schema), entities, 0
    real = entities.select("kind", F.col("plain").alias("drawn"))
    while True:
        tried = stored(drawn(waiting, attempt), "drawn")
        free = tried.join(real, ["kind", "drawn"], "left_anti")
        if attempt:
            free = free.join(accepted, ["kind", "drawn"], "left_anti")
        kept = stored(free.groupBy("kind", "drawn").agg(F.min("plain").alias("plain")), "surrogates")
        waiting = stored(tried.join(kept, ["kind", "plain"], "left_anti").select("kind", "plain"), "refused")
        accepted = accepted.unionByName(kept.select("kind", "plain", F.lit(attempt).alias("attempt"), "drawn"))
        if waiting.isEmpty():
            return accepted.filter("attempt > 0").select("kind", "plain", "attempt")
        attempt += 1


def pseudonymise(
    docs: DataFrame, key: bytes, *, id_column: str = "doc_id", text_column: str = "text",
    entities_column: str = "entities",
) -> DataFrame:
    """``docs`` with every mention in ``text_column`` replaced, and the array ``entities`` of (kind, start,
    end) of the mentions in the old text, in code points.

    The distinct entities of the whole corpus are drawn and checked first. Texts are then read
    again and written anew where they stand; only what the few refused surrogates and given names
    of several kinds became travels, to the documents that mention them. Null texts stay null, texts without
    mentions stay as they are, repeated rows are treated alike, all columns are kept.
    """
    text = F.col(text_column).cast("string")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))

    def find(batch: pa.RecordBatch) -> Iterator[dict]:
        out: dict[str, list] = {k: [] for k in ("doc_id", "text_hash", "kind", "plain")}
        for n, found in _found(batch.column(2)):
            for kind, plain in sorted({m[2:] for m in found}):
                for column, value in zip(out, (batch.column(0)[n].as_py(), batch.column(1)[n].as_py(), kind, plain), strict=True):
                    out[column].append(value)
        yield out

    found = stored(by_batch(rows, "doc_id long, text_hash long, kind string, plain string", find), "mentions")
    known = stored(of_one_kind(found.select("kind", "plain").distinct()), "entities")
    refused = settle(stored(known.select(F.col("own").alias("kind"), "plain").distinct(), "kinds"), key)
    refused = known.join(refused.withColumnRenamed("kind", "own"), ["own", "plain"], "left").filter("attempt IS NOT NULL OR own <> kind")
    refused = stored(refused.select("kind", "plain", "own", F.coalesce("attempt", F.lit(0)).alias("attempt")), "refused")
    names = [clear_of(docs, n) for n in ("own_id", "own_hash", "refused", entities_column)]
    again = found.join(refused, ["kind", "plain"]).groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("kind", "plain", "own", "attempt")).alias(names[2]))
    again = stored(again.withColumnsRenamed({"doc_id": names[0], "text_hash": names[1]}), "redrawn")
    here = F.col(id_column).cast("long").eqNullSafe(F.col(names[0])) & (F.xxhash64(text) == F.col(names[1]))
    joined = docs.join(again, here, "left").select(*all_columns(docs), names[2])
    at, more = docs.columns.index(text_column), len(docs.columns)
    mention = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType([*docs.schema.fields, T.StructField(names[3], mention)])

    def rewrite(batch: pa.RecordBatch) -> Iterator[dict]:
        texts = batch.column(at)
        new, spans, done = [], [[]] * batch.num_rows, 0
        for n, mentioned in _found(texts):
            changed = batch.column(more)[n].as_py() or ()
            own = {(x["kind"], x["plain"]): x["own"] for x in changed}
            mentioned = [(a, b, own.get((k, p), k), p) for a, b, k, p in mentioned]
            attempts = {(x["own"], x["plain"]): x["attempt"] for x in changed}
            new += [texts.slice(done, n - done), pa.array([replaced(texts[n].as_py(), mentioned, key, attempts)], texts.type)]
            spans[n] = [{"kind": k.split(":")[0], "start": a, "end": b} for a, b, k, _ in mentioned]
            done = n + 1
        new.append(texts.slice(done))
        columns = {c: batch.column(i) for i, c in enumerate(docs_columns)}
        yield columns | {text_column: pa.concat_arrays(new), names[3]: spans}

    docs_columns = list(docs.columns)
    return by_batch(joined, schema, rewrite)
